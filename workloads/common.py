"""Shared plumbing of the registered queries and their SQL twins."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyward.context import configure

from .oracle_tables import TABLES

Query = Callable[[SparkSession, str], DataFrame]


def comparable(df: DataFrame) -> DataFrame:
    """Wide types for the comparison: decimals as double, integers as bigint, zone-free timestamps,
    string arrays as text."""

    def widen(field: T.StructField):
        col = F.col(f"`{field.name}`")
        kind = field.dataType
        if isinstance(kind, (T.DecimalType, T.FloatType)):
            return col.cast("double").alias(field.name)
        if isinstance(kind, (T.IntegerType, T.ShortType, T.ByteType)):
            return col.cast("bigint").alias(field.name)
        if isinstance(kind, T.TimestampType):
            return col.cast("timestamp_ntz").alias(field.name)
        if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.ArrayType):
            return F.array_join(F.transform(col, lambda a: F.array_join(a, ",")), "|").alias(field.name)
        if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StringType):
            return F.array_join(col, "|").alias(field.name)
        return col

    return df.select(*[widen(f) for f in df.schema.fields])


def query(build: Query) -> Query:
    """Registered form of an operator call: session settings first, comparable types last."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        configure(spark)
        return comparable(build(spark, folder))

    return run


def oracle(body: str) -> str:
    """The body preceded by the derived tables it names, dependencies first."""
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name, sql in TABLES.items():
            if name not in ordered and re.search(rf"\b{name}\b", text):
                visit(sql)
                if name not in ordered:
                    ordered.append(name)

    visit(body)
    ctes = [f"{name} AS ({TABLES[name].strip()})" for name in ordered]
    body = body.strip()
    if not ctes:
        return body
    if body.upper().startswith("WITH RECURSIVE"):
        return "WITH RECURSIVE " + ",\n".join(ctes) + ",\n" + body[14:].lstrip()
    if body.upper().startswith("WITH "):
        return "WITH " + ",\n".join(ctes) + ",\n" + body[4:].lstrip()
    return "WITH " + ",\n".join(ctes) + "\n" + body


def rounded(numerator: str, denominator: str, digits: int = 1) -> str:
    """Exact half-up ROUND(numerator / denominator, digits) of two whole numbers, as a double."""
    num, den = f"CAST({numerator} AS HUGEINT)", f"NULLIF(CAST({denominator} AS HUGEINT), 0)"
    top = f"(abs({num}) * {2 * 10 ** digits} + {den})"
    return f"(sign({num}) * CAST({top} // (2 * {den}) AS DOUBLE) / {10 ** digits})"


def share(part: str, whole: str, digits: int = 1) -> str:
    return rounded(f"({part}) * 100", whole, digits)
