"""What has changed between published versions of a table, without being told.

A version is written in buckets of its key, with a checksum of each bucket: the number of rows and
two sums of row hashes, which do not depend on the rows' order and count repeated rows. Versions are
compared by their checksums; only buckets that differ are read. A consumer remembers the version it
has handled, so "is there anything new" is answered from a few checksums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .parts import child_folders

BUCKETS = 64
_EXACT = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def _path(root: str, table: str, kind: str) -> str:
    return f"{root.rstrip('/')}/{table.replace('.', '/')}/{kind}"


def _whole(columns: list[str]) -> Column:
    """A row as text. A hash of the columns alone would not tell which of them is null."""
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in sorted(columns)]), _EXACT)


def publish_version(df: DataFrame, root: str, table: str, version: int, keys: list[str], buckets: int = BUCKETS) -> None:
    """Writes a version in buckets of its keys, then its checksums, which publish it. A repeated job replaces its own."""
    spark, columns = df.sparkSession, df.columns
    place = F.pmod(F.xxhash64(*[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]), F.lit(buckets)).cast("int")
    data = f"{_path(root, table, 'data')}/version={version}"
    df.withColumn("bucket", place).hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(data)
    written = spark.read.schema(T.StructType([*df.schema, T.StructField("bucket", T.IntegerType())])).parquet(data).withColumn("_row", _whole(columns))
    first, second = F.xxhash64("_row"), F.xxhash64(F.lit("second"), "_row")
    sums = written.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(first.cast("decimal(38,0)")).alias("first"), F.sum(second.cast("decimal(38,0)")).alias("second")
    )
    whole = sums.unionByName(spark.createDataFrame([(-1, 0, None, None)], "bucket int, rows bigint, first decimal(38,0), second decimal(38,0)"))  # an empty table is a version too
    whole.coalesce(1).write.mode("overwrite").parquet(f"{_path(root, table, 'sums')}/version={version}")


def _sums(spark: SparkSession, root: str, table: str) -> DataFrame:
    return spark.read.schema("bucket int, rows bigint, first decimal(38,0), second decimal(38,0), version int").parquet(_path(root, table, "sums"))


def newest_version(spark: SparkSession, root: str, table: str) -> int:
    return _sums(spark, root, table).agg(F.max("version").alias("version")).first().version


def read_version(spark: SparkSession, root: str, table: str, version: int | None = None, buckets: list[int] | None = None) -> DataFrame:
    """A version, the newest by default; with ``buckets`` those alone. Folders of other buckets are not opened."""
    version = newest_version(spark, root, table) if version is None else version
    rows = spark.read.parquet(f"{_path(root, table, 'data')}/version={version}")
    return (rows if buckets is None else rows.filter(F.col("bucket").isin(buckets))).drop("bucket")


def changed_buckets(spark: SparkSession, root: str, table: str, old: int, new: int) -> list[int]:
    """The buckets in which two versions differ: at most as many as a version has."""
    sums = _sums(spark, root, table).filter(F.col("version").isin(old, new))
    seen = sums.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), *[F.count_distinct(c).alias(c) for c in ("rows", "first", "second")])
    differs = (F.col("n") == 1) | (F.col("rows") > 1) | (F.col("first") > 1) | (F.col("second") > 1)
    return sorted(r.bucket for r in seen.filter(differs & (F.col("bucket") >= 0)).collect()) if old != new else []


def has_changed(spark: SparkSession, root: str, table: str, old: int, new: int) -> bool:
    """From the checksums alone."""
    return bool(changed_buckets(spark, root, table, old, new))


def changed_keys(spark: SparkSession, root: str, table: str, old: int, new: int, keys: list[str]) -> DataFrame:
    """The keys whose rows differ: change (added, removed, changed), rows_before, rows_after. Repeated rows count as often as they
    are there. Rows of the differing buckets are compared whole."""
    buckets = changed_buckets(spark, root, table, old, new)

    def side(version: int, sign: int) -> DataFrame:
        rows = read_version(spark, root, table, version, buckets)
        return rows.select(*keys, _whole(rows.columns).alias("_row"), F.lit(sign).alias("_sign"))

    rows = side(old, -1).unionByName(side(new, 1))
    by_row = rows.groupBy(*keys, "_row").agg(F.sum("_sign").alias("_sum"), F.count_if(F.col("_sign") < 0).alias("_old"), F.count_if(F.col("_sign") > 0).alias("_new"))
    by_key = by_row.groupBy(*keys).agg(F.sum("_old").alias("rows_before"), F.sum("_new").alias("rows_after"), F.sum(F.abs("_sum")).alias("_differ"))
    change = F.when(F.col("rows_before") == 0, "added").when(F.col("rows_after") == 0, "removed").otherwise("changed")
    return by_key.filter("_differ > 0").select(*keys, change.alias("change"), "rows_before", "rows_after")


class Consumer:
    """A named reader of a table's versions that knows which it has handled."""

    def __init__(self, spark: SparkSession, root: str, table: str, name: str):
        self.spark, self.root, self.table = spark, root, table
        self.path = f"{_path(root, table, 'read')}/{name}"

    def handled(self) -> int | None:
        done = [int(f.split("=")[1]) for f in child_folders(self.spark, self.path)]
        return max(done, default=None)

    def has_data(self) -> bool:
        """Whether the newest version differs from the one handled last. Before the first, everything is new."""
        last = self.handled()
        return last is None or has_changed(self.spark, self.root, self.table, last, newest_version(self.spark, self.root, self.table))

    def advance(self, version: int) -> None:
        """Remembers that this version has been handled."""
        self.spark.range(1).write.mode("overwrite").parquet(f"{self.path}/version={version}")
