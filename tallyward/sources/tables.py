"""Reading and writing governed tables as Parquet.

Logs are appended, states are published as new versions, facts are clustered by date. A path
that a job reads is never overwritten by the same job.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates as D
from . import schemas

# --- Fixed values: columns that a table fills by itself when a row is inserted
_ROW_IDS = {
    "governance.semantic.certification_audit": "audit_id",
    "governance.devops.change_log": "change_id",
    "governance.operating_model.metric_catalog": "metric_id",
    "governance.operating_model.domain_registry": "domain_id",
    "multi_tenant.semantic.api_request_log": "request_id",
}
_ROW_TIMES = {
    "governance.semantic.certification_audit": "action_date",
    "governance.devops.change_log": "deployed_at",
    "multi_tenant.semantic.api_request_log": "requested_at",
}


def _path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table.replace('.', '/')}"


def align(df: DataFrame, table: str, as_of: datetime) -> DataFrame:
    """The rows with the table's columns and types: missing ids and times are filled, other missing
    columns are NULL, unknown columns are refused."""
    declared = schemas.schema(table)
    unknown = set(df.columns) - set(declared.names)
    if unknown:
        raise ValueError(f"{table} has no columns {sorted(unknown)}")

    def column(field):
        if field.name in df.columns:
            value = F.col(field.name)
        elif _ROW_IDS.get(table) == field.name:
            value = F.uuid()
        elif _ROW_TIMES.get(table) == field.name:
            value = D.lit_ts(as_of)
        else:
            value = F.lit(None)
        return value.cast(field.dataType).alias(field.name)

    return df.select(*[column(f) for f in declared])


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The table with its declared schema: nothing is inferred."""
    return spark.read.schema(schemas.schema(table)).parquet(_path(root, table))


def append_rows(df: DataFrame, root: str, table: str, as_of: datetime) -> None:
    """Appends log rows, such as the ``log`` of a control-plane outcome."""
    align(df, table, as_of).write.mode("append").parquet(_path(root, table))


def publish_state(df: DataFrame, root: str, table: str, version: int) -> None:
    """Writes a whole new version next to the ones being read; a repeated job replaces its own."""
    df.write.mode("overwrite").parquet(f"{_path(root, table)}/version={version}")


def read_state(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The newest published version. The version is a partition, so older files are not read."""
    versions = spark.read.parquet(_path(root, table))
    newest = versions.agg(F.max("version")).scalar()
    return versions.filter(F.col("version") == newest).drop("version")


def write_clustered(df: DataFrame, path: str, day: str = "recognized_date", key: str = "customer_id", files: int = 200) -> None:
    """Facts laid out for the metric queries: contiguous date ranges, sorted by customer inside a day.

    Range partitioning splits a busy day or customer over several files, and the min/max statistics
    of each file let a date filter skip the others.
    """
    (
        df.repartitionByRange(files, F.col(day), F.col(key))
        .sortWithinPartitions(day, key)
        .write.mode("overwrite")
        .parquet(path)
    )
