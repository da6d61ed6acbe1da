"""Monthly revenue cells kept up to date by signed deltas.

A delta is a set of fact lines with a sign: +1 for a line that is new, -1 for one that is withdrawn,
both for a correction. The ledger keeps, for each day and customer, how many lines there are and
what they add up to. A batch finds the months that its lines belong to, in whatever order they
arrive, merges those months only, and derives their cells again from the merged lines: a distinct
customer is one whose lines do not cancel out. Months that the batch does not name are not read.

A line withdrawn before it arrived leaves a negative count until it does. Lines without a date are
left out, as every window does. Batches have rising numbers; one that is repeated after a failure
goes on where it stopped, one that is known is not applied again.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates as D
from ..sources.parts import PartTable, remove_folder

_LINES = "recognized_date date, customer_id string, lines bigint, amount decimal(38,4), recurring decimal(38,4)"
_CELLS = "segment string, region string, total_revenue decimal(38,4), recurring_revenue decimal(38,4), customer_count bigint"
_SUMS = ["lines", "amount", "recurring"]
TASK_LINES = 250_000  # about as many lines as a task merges at once, however large the ledger is


def signed(rows: DataFrame, sign: int) -> DataFrame:
    """Fact lines as a delta that adds (+1) or withdraws (-1) them."""
    return rows.select("recognized_date", "customer_id", "amount_usd", "is_recurring").withColumn("sign", F.lit(sign))


def cells_of(lines: DataFrame, cust: DataFrame, rows: int) -> DataFrame:
    """Month x segment x region of this many ledger lines.

    A customer has one line a day at most, so lines meet by customer alone: one shuffle serves their sums and the join.
    """
    by_customer = lines.repartition(1 + rows // TASK_LINES, "customer_id").groupBy("metric_month", "customer_id").agg(*[F.sum(c).alias(c) for c in _SUMS])
    return (
        by_customer.join(cust.select("customer_id", "segment", "region").hint("shuffle_hash"), "customer_id")
        .groupBy("metric_month", "segment", "region")
        .agg(
            F.sum("amount").cast("decimal(38,4)").alias("total_revenue"),
            F.sum("recurring").cast("decimal(38,4)").alias("recurring_revenue"),
            F.count_if(F.col("lines") > 0).alias("customer_count"),
        )
        .filter((F.col("customer_count") > 0) | (F.col("total_revenue") != 0))
    )


class RevenueLedger:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.deltas = spark, f"{root}/deltas"
        self.lines = PartTable(spark, f"{root}/lines", "metric_month", _LINES)
        self.cells = PartTable(spark, f"{root}/cells", "metric_month", _CELLS)

    def apply(self, delta: DataFrame, cust: DataFrame, batch: int) -> list[date]:
        """Merges a delta (recognized_date, customer_id, amount_usd, is_recurring, sign); returns the months it touched."""
        if (self.lines.newest() or 0) < batch:
            sign, staged = F.col("sign"), f"{self.deltas}/batch={batch}"
            (
                delta.filter(F.col("recognized_date").isNotNull())
                .groupBy("recognized_date", "customer_id")
                .agg(
                    F.sum(sign).cast("bigint").alias("lines"),
                    F.sum(sign * F.col("amount_usd")).cast("decimal(38,4)").alias("amount"),
                    F.sum(F.when(F.col("is_recurring"), sign * F.col("amount_usd")).otherwise(0)).cast("decimal(38,4)").alias("recurring"),
                )
                .withColumn("metric_month", F.trunc("recognized_date", "month"))
                .write.mode("overwrite").parquet(staged)
            )
            reduced = self.spark.read.schema(f"{_LINES}, metric_month date").parquet(staged)
            added = {r.metric_month: r.n for r in reduced.groupBy("metric_month").agg(F.count(F.lit(1)).alias("n")).collect()}  # as many as the calendar has
            self._merge(reduced, added, batch)
            remove_folder(self.spark, staged)
        if (self.cells.newest() or 0) < batch:
            self.derive([month for month, (by, _) in self.lines.manifest().items() if by == batch], cust, batch)
        return sorted(month for month, (by, _) in self.cells.manifest().items() if by == batch)

    def _merge(self, reduced: DataFrame, added: dict[date, int], batch: int) -> None:
        """Publishes the months of a reduced delta, with the number of its lines in each, merged with the lines that they hold.

        Lines meet by month and a piece of its customers and are written as they lie, so one shuffle serves the sums and the files.
        """
        held = {month: rows for month, (_, rows) in self.lines.manifest().items() if month in added and rows}
        most = {month: n + held.get(month, 0) for month, n in added.items()}
        pieces = 1 + max(most.values(), default=0) // TASK_LINES
        piece = F.pmod(F.xxhash64("customer_id"), F.lit(pieces)).alias("piece")
        lying = (self.lines.read(held).unionByName(reduced) if held else reduced).select("*", piece).repartition(1 + sum(most.values()) // TASK_LINES, "metric_month", "piece")
        if held:
            lying = lying.groupBy("metric_month", "piece", "recognized_date", "customer_id").agg(*[F.sum(c).alias(c) for c in _SUMS])
        merged = (
            lying.filter((F.col("lines") != 0) | (F.col("amount") != 0) | (F.col("recurring") != 0))
            .withColumns({c: F.col(c).cast("decimal(38,4)") for c in _SUMS[1:]})
        )
        self.lines.replace(merged, added, batch, arranged=True)

    def derive(self, months: Iterable[date], cust: DataFrame, batch: int) -> None:
        """The cells of these months again, from the lines as they stand."""
        months = list(months)
        self.cells.replace(cells_of(self.lines.read(months), cust, self._rows(months)), months, batch)

    def _rows(self, months: Iterable[date]) -> int:
        listed = self.lines.manifest()
        return sum(listed[month][1] for month in months if month in listed)

    def months_of(self, customers: DataFrame) -> list[date]:
        """The months that hold lines of these customers: those to derive again when their segment or region has changed."""
        held = self.lines.read().select("metric_month", "customer_id").join(customers.select("customer_id"), "customer_id", "left_semi")
        return sorted(r.metric_month for r in held.select("metric_month").distinct().collect())

    def read(self, cust: DataFrame, as_of: date, months: int = 24) -> DataFrame:
        """The cells of the window. It begins inside a month: that month's cells come from the days that are left of it."""
        since = D.shift_months(as_of, -months)
        first = D.month_start(since)
        listed = self.cells.manifest()
        if since == first:
            return self.cells.read(m for m in listed if m >= first)
        cut = self.lines.read([first]).filter(F.col("recognized_date") >= D.lit_date(since))
        return self.cells.read(m for m in listed if m > first).unionByName(cells_of(cut, cust, self._rows([first])))
