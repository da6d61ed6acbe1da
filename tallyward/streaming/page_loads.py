"""Minute-level page metrics, as a batch and as a stream, and how fresh they are."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import dates as D
from ..functions import measures as M
from ..sources.parts import PartTable, child_folders, remove_folder

KEYS = ["metric_minute", "tenant_id", "page_name"]
_VALUES = (
    "metric_minute timestamp, tenant_id string, page_name string, page_views bigint, avg_load_time_ms double,"
    " p95_load_time_ms double, p99_load_time_ms double, slow_loads bigint"
)
_STORED = f"{_VALUES}, metric_date date, batch_id bigint"
#: A compaction's number is the last micro-batch it covers times this, plus a count of the compactions that cover as much.
_ROUNDS = 1 << 20


def page_load_metrics(events: DataFrame, as_of: datetime, hours: int = 24, slow_ms: int = 3000) -> DataFrame:
    """Views, average, 95th and 99th percentile of load time and slow loads, by minute, tenant and page.

    Loads are first counted by value. The exact percentiles then merge value counts, so a page that
    takes a third of all views costs no more than its distinct load times.
    """
    recent = events.filter(F.col("event_timestamp") >= D.lit_ts(as_of - timedelta(hours=hours)))
    counted = recent.groupBy(
        D.trunc_minute(F.col("event_timestamp")).alias("metric_minute"), "tenant_id", "page_name", "load_time_ms"
    ).agg(F.count(F.lit(1)).alias("n"))
    return metrics_of_counts(counted, slow_ms)


def metrics_of_counts(counted: DataFrame, slow_ms: int = 3000) -> DataFrame:
    """The metrics from load times and how often each was seen (``n``). A load time may come in several rows."""
    load, n = F.col("load_time_ms"), F.col("n")
    return counted.groupBy(*KEYS).agg(
        F.sum("n").alias("page_views"),
        M.mean(F.sum(load.cast("bigint") * n), F.sum("n")).alias("avg_load_time_ms"),
        F.percentile(load, 0.95, n).alias("p95_load_time_ms"),
        F.percentile(load, 0.99, n).alias("p99_load_time_ms"),
        F.coalesce(F.sum(F.when(load > slow_ms, n)), F.lit(0)).alias("slow_loads"),
    )


def _stream_aggregate(events: DataFrame, watermark: str, slow_ms: int) -> DataFrame:
    load = F.col("load_time_ms")
    return (
        events.withWatermark("event_timestamp", watermark)
        .groupBy(F.window("event_timestamp", "1 minute"), "tenant_id", "page_name")
        .agg(
            F.count(F.lit(1)).alias("page_views"),
            F.sum(load.cast("bigint")).alias("_total"),
            F.percentile(load, 0.95).alias("p95_load_time_ms"),
            F.percentile(load, 0.99).alias("p99_load_time_ms"),
            M.count_when(load > slow_ms).alias("slow_loads"),
        )
        .select(
            F.col("window.start").alias("metric_minute"),
            "tenant_id",
            "page_name",
            "page_views",
            M.mean(F.col("_total"), F.col("page_views")).alias("avg_load_time_ms"),
            "p95_load_time_ms",
            "p99_load_time_ms",
            "slow_loads",
        )
    )


def start_page_load_stream(
    events: DataFrame,
    out: str,
    checkpoint: str,
    watermark: str = "24 hours",
    trigger: dict | None = None,
    slow_ms: int = 3000,
    files_per_day: int = 8,
) -> StreamingQuery:
    """Keeps the minute aggregates of an event stream up to date under ``out``.

    Update mode emits each window whenever it changes, so the newest minutes do not wait for the
    watermark. The watermark is how late an event may be, behind the newest one seen; an event later than that is dropped, so it is no
    shorter than the 24 hours that readers look back: nothing inside them is lost, in whatever order files arrive. What is dropped beyond is
    counted (``late_rows``). Output is partitioned by day, for pruning and retention,
    and by micro-batch: a batch that is repeated after a failure replaces its own partitions. Each day
    of a batch is written as ``files_per_day`` files; raise it with the number of pages.
    ``compact_page_loads`` and ``vacuum_page_loads`` keep the number of folders down. ``trigger`` defaults to one minute.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        (
            batch.withColumn("metric_date", F.col("metric_minute").cast("date"))
            .withColumn("batch_id", F.lit(batch_id))
            .repartition("metric_date", F.pmod(F.hash("tenant_id", "page_name"), F.lit(files_per_day)))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("metric_date", "batch_id")
            .parquet(out)
        )

    # The table exists from the start, so readers need not wait for the first batch.
    events.sparkSession.createDataFrame([], _STORED).write.mode("append").partitionBy("metric_date", "batch_id").parquet(out)
    return (
        _stream_aggregate(events, watermark, slow_ms)
        .writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 minute"}))
        .foreachBatch(write)
        .start()
    )


def late_rows(stream: StreamingQuery) -> int:
    """Rows that came too late for the watermark and were dropped, as far as the query's kept progress goes. Rows of a task that share
    window, tenant and page count as one, as they are combined before they meet the state."""
    return sum(s["numRowsDroppedByWatermark"] for p in stream.recentProgress for s in p["stateOperators"])


def _emitted_folders(spark: SparkSession, out: str) -> dict[date, list[int]]:
    """For each day under ``out``, the micro-batches that have a folder there."""
    names = [n for n in child_folders(spark, out) if n.startswith("metric_date=") and not n.endswith("__")]
    return {date.fromisoformat(n.split("=")[1]): [int(b.split("=")[1]) for b in child_folders(spark, f"{out}/{n}") if b.startswith("batch_id=")] for n in names}


def _compacted(spark: SparkSession, out: str) -> PartTable:
    return PartTable(spark, f"{out}/_compacted", "metric_date", f"{_VALUES}, batch_id bigint")


def _covered(spark: SparkSession, out: str) -> dict[date, int]:
    """For each compacted day, the last micro-batch that its rows include."""
    return {day: number // _ROUNDS for day, (number, _) in _compacted(spark, out).manifest().items()}


def _emitted(spark: SparkSession, out: str, folders: list[tuple[date, int]]) -> DataFrame:
    paths = [f"{out}/metric_date={day}/batch_id={batch}" for day, batch in folders]
    # Without folders the table itself is read, so that a path that does not exist is an error all the same.
    rows = spark.read.schema(_STORED).option("basePath", out).parquet(*(paths or [out]))
    return rows if paths else rows.filter(F.lit(False))


def _newest(emitted: DataFrame) -> DataFrame:
    """The newest version of each minute, with the micro-batch that emitted it."""
    values = [c for c in emitted.columns if c not in KEYS]
    return emitted.groupBy(*KEYS).agg(F.max_by(F.struct(*values), "batch_id").alias("_newest")).select(*KEYS, "_newest.*")


def _replace_days(spark: SparkSession, out: str, before: date, keep: bool) -> list[date]:
    """Publishes the days before ``before`` with the newest version of each minute, or empty. The newest micro-batch may still be
    writing, so it is left out; all before it are complete."""
    table, emitted, covered = _compacted(spark, out), _emitted_folders(spark, out), _covered(spark, out)
    newest = max((b for batches in emitted.values() for b in batches), default=0)
    last = max([newest - 1, *covered.values()])
    fresh = [(day, b) for day, batches in sorted(emitted.items()) if day < before for b in batches if covered.get(day, -1) < b <= last]
    days = {day for day, _ in fresh}
    if not keep:
        days |= {day for day, (_, rows) in table.manifest().items() if day < before and rows}
    if not days:
        return []
    both = _emitted(spark, out, fresh).unionByName(table.read(days))
    rows = _newest(both) if keep else both.filter(F.lit(False))
    table.replace(rows, days, max(last * _ROUNDS, (table.newest() or 0) + 1))
    return sorted(days)


def compact_page_loads(spark: SparkSession, out: str, before: date) -> list[date]:
    """Rewrites the days before ``before`` to one version of each minute, in one folder a day; returns the days that had something new.

    A compacted day lists which micro-batches it covers. A later micro-batch that still changes one of its minutes is read beside it
    until the next compaction, so nothing depends on the day being over. Readers find the days by a manifest: a crash before it is
    published changes nothing. One compaction or expiry runs at a time; the stream need not stop. Micro-batches are known by their
    numbers, so ``out`` belongs to one checkpoint: a stream with a new one needs a new ``out``.
    """
    return _replace_days(spark, out, before, keep=True)


def expire_page_loads(spark: SparkSession, out: str, before: date) -> list[date]:
    """Empties the days before ``before``. Their files go with the next vacuum; micro-batches that come later are seen again."""
    return _replace_days(spark, out, before, keep=False)


def vacuum_page_loads(spark: SparkSession, out: str) -> list[str]:
    """Deletes the folders that compacted or expired days have replaced. For when no reader that began before is left."""
    table, covered = _compacted(spark, out), _covered(spark, out)
    if not covered:
        return []
    gone = [f"{out}/metric_date={day}/batch_id={b}" for day, batches in sorted(_emitted_folders(spark, out).items()) for b in batches if b <= covered.get(day, -1)]
    for folder in gone:
        remove_folder(spark, folder)
    return gone + table.vacuum()


def read_page_load_metrics(spark: SparkSession, out: str, as_of: datetime, hours: int = 24) -> DataFrame:
    """The newest version of each minute of the last hours: one folder for each compacted day, and the folders of the micro-batches
    since. Folders of older days are not opened."""
    since = as_of - timedelta(hours=hours)
    covered = _covered(spark, out)
    open_ = [(day, b) for day, batches in sorted(_emitted_folders(spark, out).items()) if day >= since.date() for b in batches if b > covered.get(day, -1)]
    emitted = _emitted(spark, out, open_).unionByName(_compacted(spark, out).read([day for day in covered if day >= since.date()]))
    recent = emitted.withColumn("metric_minute", F.col("metric_minute").cast("timestamp_ntz")).filter(F.col("metric_minute") >= D.lit_ts(since))
    return _newest(recent).drop("batch_id", "metric_date")


def freshness_status(age: Column) -> Column:
    return F.when(age <= 60, "LIVE").when(age <= 300, "RECENT").when(age <= 900, "DELAYED").otherwise("STALE")


def page_load_with_freshness(metrics: DataFrame, as_of: datetime) -> DataFrame:
    age = D.age_seconds(F.col("metric_minute"), as_of)
    return metrics.withColumn("data_age_seconds", age).withColumn(
        "freshness_status", freshness_status(F.col("data_age_seconds"))
    )


def freshness_distribution(aged: DataFrame) -> DataFrame:
    return aged.groupBy("freshness_status").agg(
        F.count(F.lit(1)).alias("records"),
        F.min("data_age_seconds").alias("min_age_sec"),
        F.max("data_age_seconds").alias("max_age_sec"),
    )


def freshness_sla(aged: DataFrame, tiers: DataFrame) -> DataFrame:
    """Data age against the latency its freshness tier promises; rows carry their ``tier_name``. A row of a tier that nobody
    declared stays, with neither a promise nor an answer."""
    allowed = tiers.select("tier_name", "max_latency_seconds", "cost_multiplier")
    return aged.join(allowed, "tier_name", "left").withColumn(
        "within_sla", F.col("data_age_seconds") <= F.col("max_latency_seconds")
    )


def catalog_freshness(cat: DataFrame, as_of: datetime) -> DataFrame:
    """Hours since a metric was last refreshed against its own freshness promise."""
    age = D.boundary_hours(F.col("updated_at"), D.lit_ts(as_of))
    return cat.select(
        "metric_fqn",
        "freshness_sla_hours",
        age.alias("age_hours"),
        F.when(age <= F.col("freshness_sla_hours"), "FRESH").otherwise("STALE").alias("freshness_status"),
    )
