"""The monthly revenue cells as a table that is refreshed by partition."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates as D
from ..operators import metrics


def refresh_revenue_cells(
    rev: DataFrame, cust: DataFrame, out: str, as_of: date, months: int = 24, recent_months: int | None = None
) -> None:
    """Rebuilds month partitions of the cells under ``out``; other months are not touched.

    Without ``recent_months`` all months of the window are built. With it only those newest months
    are, with what is dated after ``as_of``, plus the oldest one, which the moving window cuts mid-month. The month filter reaches the
    scan, so a refresh reads little more than it rewrites.
    """
    start = D.shift_months(as_of, -months)
    wanted = F.col("recognized_date") >= D.lit_date(start)
    if recent_months is not None:
        oldest_end = D.shift_months(D.month_start(start), 1)
        newest_start = D.shift_months(D.month_start(as_of), -(recent_months - 1))
        wanted = wanted & (
            (F.col("recognized_date") < D.lit_date(oldest_end)) | (F.col("recognized_date") >= D.lit_date(newest_start))
        )
    cells = metrics.revenue_cells(rev.filter(wanted), cust)
    (
        cells.repartition("metric_month")
        .sortWithinPartitions("metric_month", "segment", "region")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("metric_month")
        .parquet(out)
    )


def read_revenue_cells(spark: SparkSession, out: str, as_of: date, months: int = 24) -> DataFrame:
    """The cells inside the window; older month partitions are pruned."""
    oldest = D.month_start(D.shift_months(as_of, -months))
    return spark.read.parquet(out).filter(F.col("metric_month") >= D.lit_date(oldest))
