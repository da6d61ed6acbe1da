"""Page metrics from a stream that accounts for every event.

Each micro-batch is written as value counts of its minutes, in folders by day, next to a side table of
the events that came too late: behind the watermark, which is the newest event time of the earlier
batches less the allowed delay. Its progress row, written last, publishes the batch and says how many
events came in, how many counted and how many were late; the two add up. Counts are additive, so no
state is kept between batches and a repeated batch replaces its own folders.

A day that lies wholly behind the watermark is closed: no event can reach it any more. ``compact``
rewrites closed days as one folder each and publishes them by a manifest; readers open that folder,
and the batch folders of open days only.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..functions import dates as D
from ..sources.parts import PartTable, child_folders, remove_folder
from . import page_loads

_COUNTS = "metric_minute timestamp_ntz, tenant_id string, page_name string, load_time_ms int, n bigint"
_PROGRESS = "rows_in bigint, rows_on_time bigint, rows_late bigint, newest_event timestamp_ntz, watermark timestamp_ntz, days array<date>, batch_id bigint"


class PageLedger:
    def __init__(self, spark: SparkSession, root: str, delay: timedelta = timedelta(hours=24)):
        self.spark, self.root, self.delay = spark, root, delay
        self.days = PartTable(spark, f"{root}/days", "metric_date", _COUNTS)

    # ---------------------------------------------------------------- writing

    def start(self, events: DataFrame, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
        """Follows a stream of page events; ``trigger`` defaults to one minute."""
        return (
            events.writeStream.foreachBatch(self.writer())
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "1 minute"}))
            .start()
        )

    def writer(self) -> Callable[[DataFrame, int], None]:
        """Writes one micro-batch. It remembers the newest event of the batches it has written; what earlier runs wrote it reads once."""
        before = [(r.batch_id, r.newest_event) for r in self.progress().select("batch_id", "newest_event").collect()]

        def newest(batch_id: int) -> datetime | None:
            return max((t for b, t in before if b < batch_id and t is not None), default=None)

        def write(batch: DataFrame, batch_id: int) -> None:
            seen = newest(batch_id)
            last = self._write(batch, batch_id, seen - self.delay if seen else None)
            # A batch may be repeated right after, so its own newest event stays apart from those before it.
            before[:] = [(batch_id - 1, seen), (batch_id, last)]

        return write

    def _write(self, batch: DataFrame, batch_id: int, watermark: datetime | None) -> datetime | None:
        batch = batch.withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp_ntz")).persist()
        behind = F.col("event_timestamp").isNull()  # without a time it belongs to no minute
        if watermark is not None:
            behind = behind | (F.col("event_timestamp") < D.lit_ts(watermark))
        minute = D.trunc_minute(F.col("event_timestamp"))
        (
            batch.filter(~behind)
            .groupBy(minute.alias("metric_minute"), "tenant_id", "page_name", "load_time_ms")
            .agg(F.count(F.lit(1)).alias("n"))
            .withColumn("metric_date", F.col("metric_minute").cast("date"))
            .hint("rebalance", "metric_date")
            .write.mode("overwrite").partitionBy("metric_date").parquet(f"{self.root}/counts/batch_id={batch_id}")
        )
        batch.filter(behind).write.mode("overwrite").parquet(f"{self.root}/late/batch_id={batch_id}")
        totals = batch.agg(
            F.count(F.lit(1)).alias("rows_in"),
            F.count_if(~behind).alias("rows_on_time"),
            F.count_if(behind).alias("rows_late"),
            F.max("event_timestamp").alias("newest_event"),
            D.lit_ts(watermark).alias("watermark") if watermark else F.lit(None).cast("timestamp_ntz").alias("watermark"),
            F.coalesce(F.collect_set(F.when(~behind, F.col("event_timestamp").cast("date"))), F.array()).cast("array<date>").alias("days"),
        )
        totals.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/progress/batch_id={batch_id}")
        batch.unpersist()
        return self.spark.read.schema(_PROGRESS.rsplit(",", 1)[0]).parquet(f"{self.root}/progress/batch_id={batch_id}").first().newest_event

    # ---------------------------------------------------------------- accounts

    def _stored(self, kind: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.root}/{kind}")
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return self.spark.createDataFrame([], schema)
            raise

    def progress(self) -> DataFrame:
        """One row per published batch, and one for all batches that a vacuum has folded together."""
        folded = self._stored("folded", _PROGRESS.replace("batch_id", "through") + ", batch_id bigint")
        last = folded.agg(F.max("through").alias("through")).first().through
        rows = self._stored("progress", _PROGRESS)
        if last is None:
            return rows
        whole = folded.filter(F.col("through") == last).drop("batch_id").withColumnRenamed("through", "batch_id")
        return rows.filter(F.col("batch_id") > last).unionByName(whole)

    def accounting(self) -> DataFrame:
        """Events in, counted and late, over all batches."""
        return self.progress().agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("rows_in", "rows_on_time", "rows_late")])

    def watermark(self) -> datetime | None:
        newest = self.progress().agg(F.max("newest_event").alias("t")).first().t
        return newest - self.delay if newest else None

    def late_events(self, columns: str) -> DataFrame:
        """The events that came too late (their ``columns`` as DDL), with the batch that brought them. Kept until someone decides."""
        known = self.progress().agg(F.max("batch_id").alias("b")).first().b
        return self._stored("late", f"{columns}, batch_id bigint").filter(F.col("batch_id") <= F.lit(-1 if known is None else known))

    # ---------------------------------------------------------------- compaction and expiry

    def _open_folders(self, since: date | None = None) -> list[str]:
        """Folders of published batches with days that are not compacted."""
        closed = self.days.manifest()
        rows = self.progress().select("batch_id", F.explode("days").alias("day")).collect()  # batches since the last vacuum
        return [f"{self.root}/counts/batch_id={r.batch_id}/metric_date={r.day}" for r in sorted(rows) if r.day not in closed and (since is None or r.day >= since)]

    def _counts(self, folders: list[str]) -> DataFrame:
        schema = f"{_COUNTS}, metric_date date"
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(f"{schema}, batch_id bigint").option("basePath", f"{self.root}/counts").parquet(*folders).drop("batch_id")

    def compact(self) -> list[date]:
        """Rewrites the days that closed since the last time; returns them. A crash before the manifest is published changes nothing."""
        mark = self.watermark()
        if mark is None:
            return []
        folders = [f for f in self._open_folders() if date.fromisoformat(f.rsplit("=", 1)[1]) < mark.date()]
        days = sorted({date.fromisoformat(f.rsplit("=", 1)[1]) for f in folders})
        if days:
            merged = self._counts(folders).groupBy("metric_date", *page_loads.KEYS, "load_time_ms").agg(F.sum("n").alias("n"))
            self.days.replace(merged, days, (self.days.newest() or 0) + 1)
        return days

    def expire(self, before: date) -> list[date]:
        """Takes compacted days before this one out of the table; their files go with the next vacuum. Their events stay accounted for."""
        old = [day for day, (_, rows) in self.days.manifest().items() if day < before and rows]
        if old:  # an expired day stays listed, without rows, so that its batch folders stay out of sight
            empty = self.spark.createDataFrame([], f"{_COUNTS}, metric_date date")
            self.days.replace(empty, old, (self.days.newest() or 0) + 1)
        return old

    def vacuum(self) -> list[str]:
        """Deletes folders that no reader opens any more, and folds the progress of the batches that are compacted whole into one row."""
        gone, closed = self.days.vacuum() if self.days.newest() else [], self.days.manifest()
        rows = sorted(self.progress().collect(), key=lambda r: r.batch_id)
        whole = []
        for r in rows[:-1]:  # the newest batch stays as it is
            if not all(day in closed for day in r.days):
                break
            whole.append(r)
        if len(whole) > 1:
            through = whole[-1].batch_id
            newest = [r.newest_event for r in whole if r.newest_event is not None]
            one = (sum(r.rows_in for r in whole), sum(r.rows_on_time for r in whole), sum(r.rows_late for r in whole), max(newest, default=None), whole[-1].watermark, [])
            self.spark.createDataFrame([one], _PROGRESS.rsplit(",", 1)[0]).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/folded/through={through}")
            gone += [f"{self.root}/{kind}/{f}" for kind in ("counts", "progress") for f in child_folders(self.spark, f"{self.root}/{kind}") if int(f.split("=")[1]) <= through]
            gone += [f"{self.root}/folded/{f}" for f in child_folders(self.spark, f"{self.root}/folded") if int(f.split("=")[1]) < through]
            for folder in gone:
                remove_folder(self.spark, folder)
        return gone

    # ---------------------------------------------------------------- reading

    def read(self, as_of: datetime, hours: int = 24, slow_ms: int = 3000) -> DataFrame:
        """The metrics of the minutes of the last hours, from at most one folder for each closed day."""
        since = as_of - timedelta(hours=hours)
        closed = [day for day in self.days.manifest() if day >= since.date()]
        counts = self.days.read(closed).unionByName(self._counts(self._open_folders(since.date()))).drop("metric_date")
        # The first minute of the window may be cut; the events before it are no longer told apart, so it counts whole.
        return page_loads.metrics_of_counts(counts.filter(F.col("metric_minute") >= D.lit_ts(since.replace(second=0, microsecond=0))), slow_ms)


class StreamTotals(StreamingQueryListener):
    """Adds up the progress of every batch of every query, however many there are: batches, rows in, rows dropped by the watermark."""

    def __init__(self):
        self.of: dict[str, dict[str, int]] = {}

    def onQueryStarted(self, event) -> None:
        self.of.setdefault(str(event.runId), {"batches": 0, "rows_in": 0, "rows_dropped": 0})

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        totals = self.of.setdefault(str(progress.runId), {"batches": 0, "rows_in": 0, "rows_dropped": 0})
        totals["batches"] += 1
        totals["rows_in"] += progress.numInputRows
        totals["rows_dropped"] += sum(s.numRowsDroppedByWatermark for s in progress.stateOperators)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
