"""All registered queries, by section."""

from importlib import import_module

SECTIONS = ("metrics", "models", "telemetry", "governance", "lifecycle", "tenancy", "incremental")


def _merged(attribute: str) -> dict:
    out: dict = {}
    for section in SECTIONS:
        part = getattr(import_module(f"workloads.{section}"), attribute)
        clash = out.keys() & part.keys()
        if clash:
            raise ValueError(f"registered twice: {sorted(clash)}")
        out.update(part)
    return out


def queries() -> dict:
    return _merged("QUERIES")


def oracle_sql() -> dict:
    return _merged("ORACLE")
