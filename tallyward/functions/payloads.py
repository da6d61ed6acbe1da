"""Free-form columns as Spark's Variant type.

A payload is text that may or may not be JSON. Broken text is not an error: it has no value and is
counted. A field that is missing, null, or cannot be read as the type asked for is NULL; a number or
date written as a string is read as what it says.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def payload(text: Column) -> Column:
    """The text as a Variant; NULL where it is null or not JSON."""
    return F.try_parse_json(text)


def broken(text: Column) -> Column:
    return text.isNotNull() & F.try_parse_json(text).isNull()


def field(value: Column, path: str, kind: str) -> Column:
    """The field at a path such as ``$.a[0].b``, as the type asked for, else NULL."""
    return F.try_variant_get(value, path, kind)


def payload_fields(rows: DataFrame, column: str, by: list[str]) -> DataFrame:
    """What the payloads of each group hold: for each top-level key and type of its value, how many rows, and the sum of its numbers.

    Payloads that are no objects have no keys; broken ones are listed under the key NULL with the type ``BROKEN``.
    """
    parsed = rows.select(*by, F.col(column).alias("_text")).withColumn("_value", payload(F.col("_text")))
    view = parsed.filter(F.col("_value").isNotNull())
    listed = view.lateralJoin(view.sparkSession.tvf.variant_explode(F.col("_value").outer())).filter(F.col("key").isNotNull())
    kind = F.schema_of_variant("value")
    # The type's name without its details: DECIMAL(3,1) and DECIMAL(4,2) are one type, and so are objects of any shape.
    kind = F.when(F.is_variant_null("value"), "NULL").otherwise(F.regexp_extract(kind, "^[A-Z]+", 0))
    number = F.when(kind.isin("BIGINT", "DECIMAL", "DOUBLE"), field(F.col("value"), "$", "double"))
    found = listed.select(*by, "key", kind.alias("value_type"), number.alias("_number")).groupBy(*by, "key", "value_type").agg(F.count(F.lit(1)).alias("rows"), F.sum("_number").alias("total"))
    bad = parsed.filter(broken(F.col("_text"))).groupBy(*by).agg(F.count(F.lit(1)).alias("rows"))
    return found.unionByName(bad.select(*by, F.lit(None).cast("string").alias("key"), F.lit("BROKEN").alias("value_type"), "rows", F.lit(None).cast("double").alias("total")))
