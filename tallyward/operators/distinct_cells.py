"""Exact distinct counts that merge.

Customers are numbered once, densely, and keep their numbers. A cell holds the numbers it has seen
as bitmaps, one for each range of 32,768 numbers, so cells of different months, segments or regions
merge by OR, and the distinct count of any merger is the number of bits: no fact row is read again.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..context import cut_lineage

TASK_IDS = 8192  # a quarter of a bitmap's range


def read_numbering(spark: SparkSession, path: str) -> DataFrame:
    """(id, number), empty before the first batch."""
    try:
        return spark.read.schema("id string, number bigint, batch bigint").parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], "id string, number bigint, batch bigint")
        raise


def extend_numbering(ids: DataFrame, path: str, batch: int) -> DataFrame:
    """Numbers the ids (a column ``id``) that have none yet, after those that do, and returns the whole numbering.

    Each batch writes a folder of its own, so a repeated batch gives its ids out again. Null is no id. The new ids are
    numbered in place: only the sizes of their partitions meet in one task.
    """
    spark = ids.sparkSession
    known = read_numbering(spark, path).filter(F.col("batch") < batch)
    fresh = ids.select(F.col("id").cast("string").alias("id")).filter(F.col("id").isNotNull()).distinct().join(known, "id", "left_anti")
    in_part = F.monotonically_increasing_id()
    placed = cut_lineage(fresh.select("id", in_part.alias("at")))  # numbers must not change when a task runs again
    part, place = F.shiftright("at", 33), F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("part", before.alias("offset"))
    last = known.agg(F.coalesce(F.max("number"), F.lit(0)).alias("last")).first().last
    numbered = placed.withColumn("part", part).join(offsets, "part").select("id", (F.lit(last + 1) + F.col("offset") + place).alias("number"))
    numbered.write.mode("overwrite").parquet(f"{path}/batch={batch}")
    return read_numbering(spark, path).select("id", "number")


def tasks_for(numbering: DataFrame) -> int:
    """In how many tasks rows of these ids are sorted and joined: the rows of a task do not grow with the number of ids."""
    return 1 + (numbering.agg(F.max("number").alias("last")).first().last or 0) // TASK_IDS


def distinct_cells(rows: DataFrame, numbering: DataFrame, keys: dict[str, Column], id_column: str) -> DataFrame:
    """Cells of the keys: for each range of numbers a bitmap of the ids seen. Rows are reduced to distinct ids of a cell
    before they meet the numbering, so a busy customer is one row for each cell. The numbers of a cell meet as they are
    and become one bitmap where they meet: bitmaps of each task's share, 4 KB for a few ids, would be as many for each task."""
    tasks = tasks_for(numbering)
    seen = rows.select(*[c.alias(name) for name, c in keys.items()], F.col(id_column).cast("string").alias("id")).filter(F.col("id").isNotNull()).distinct()
    return (
        seen.join(numbering.hint("shuffle_hash"), "id")
        .select(*keys, F.bitmap_bucket_number("number").alias("bucket"), F.bitmap_bit_position("number").alias("bit"))
        .repartition(tasks, *keys, "bucket")
        .groupBy(*keys, "bucket")
        .agg(F.bitmap_construct_agg("bit").alias("bits"))
    )


def merged_cells(cells: DataFrame, keys: dict[str, Column]) -> DataFrame:
    """Coarser cells: the keys are columns over the cells' own keys."""
    return cells.select(*[c.alias(name) for name, c in keys.items()], "bucket", "bits").groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def distinct_count(cells: DataFrame, keys: dict[str, Column], name: str = "distinct_count") -> DataFrame:
    """The exact number of ids of each merger of cells."""
    return merged_cells(cells, keys).groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).alias(name))
