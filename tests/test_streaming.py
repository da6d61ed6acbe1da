"""The page stream equals the batch, also over many files, restarts and repeated batches."""

from datetime import date
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from frames import rows
from tallyward.operators import metrics
from tallyward.sources import testdata as t
from tallyward.streaming import page_loads, revenue_refresh

NOW = t.EVENT_TIME


def _stream(spark, source, folder):
    schema = spark.read.parquet(source).schema
    raw = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    events = raw.withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp"))
    return page_loads.start_page_load_stream(
        events, f"{folder}/out", f"{folder}/ckpt", watermark="60 days", trigger={"availableNow": True}
    )


def _as_rows(df):
    return rows(df.withColumns({c: F.round(c, 6) for c in ("avg_load_time_ms", "p95_load_time_ms", "p99_load_time_ms")}), *sorted(df.columns))


def test_many_batches_and_a_restart_equal_the_batch(spark, sf, folder):
    events = t.page_events(spark, sf)
    source = f"{folder}/in"
    # one hour's rows land in several files, so windows are updated by later batches
    first, second = events.randomSplit([0.5, 0.5], seed=3)
    first.repartition(3).write.parquet(source)
    _stream(spark, source, folder).awaitTermination()
    second.repartition(2).write.mode("append").parquet(source)
    _stream(spark, source, folder).awaitTermination()
    for hours in (24, 24 * 40):
        got = page_loads.read_page_load_metrics(spark, f"{folder}/out", NOW, hours)
        assert _as_rows(got) == _as_rows(page_loads.page_load_metrics(events, NOW, hours))


def test_default_settings_lose_nothing_inside_the_day(spark, sf, folder):
    events = t.page_events(spark, sf)
    events.orderBy(F.hash("event_id")).repartition(6).write.parquet(f"{folder}/in")
    raw = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    zoned = raw.withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp"))
    stream = page_loads.start_page_load_stream(zoned, f"{folder}/out", f"{folder}/ckpt", trigger={"availableNow": True})
    stream.awaitTermination()
    got = page_loads.read_page_load_metrics(spark, f"{folder}/out", NOW)
    assert _as_rows(got) == _as_rows(page_loads.page_load_metrics(events, NOW))
    assert page_loads.late_rows(stream) > 0  # a month in six unordered files: what is older than a day behind is counted


def test_rerunning_without_new_files_changes_nothing(spark, sf, folder):
    t.page_events(spark, sf).coalesce(1).write.parquet(f"{folder}/in")
    _stream(spark, f"{folder}/in", folder).awaitTermination()
    before = _as_rows(page_loads.read_page_load_metrics(spark, f"{folder}/out", NOW))
    _stream(spark, f"{folder}/in", folder).awaitTermination()
    assert _as_rows(page_loads.read_page_load_metrics(spark, f"{folder}/out", NOW)) == before


def test_a_stream_without_rows_reads_empty(spark, sf, folder):
    t.page_events(spark, sf).limit(0).write.parquet(f"{folder}/in")
    _stream(spark, f"{folder}/in", folder).awaitTermination()
    assert page_loads.read_page_load_metrics(spark, f"{folder}/out", NOW).isEmpty()


def test_partition_refresh_equals_the_full_query(spark, sf, folder):
    rev, cust, out = t.fct_revenue(spark, sf), t.dim_customer(spark, sf), f"{folder}/cells"
    revenue_refresh.refresh_revenue_cells(rev, cust, out, date(2001, 5, 20))
    for day in (date(2001, 6, 20), t.FINANCE_DAY):
        revenue_refresh.refresh_revenue_cells(rev, cust, out, day, recent_months=2)
    got = revenue_refresh.read_revenue_cells(spark, out, t.FINANCE_DAY)
    expected = metrics.daily_revenue_metrics(rev, cust, t.FINANCE_DAY)
    assert rows(got.select(sorted(got.columns))) == rows(expected.select(sorted(expected.columns)))


def test_refresh_touches_only_its_months(spark, sf, folder):
    rev, cust, out = t.fct_revenue(spark, sf), t.dim_customer(spark, sf), f"{folder}/cells"
    revenue_refresh.refresh_revenue_cells(rev, cust, out, date(2001, 6, 20))
    files = lambda: {f: f.split("metric_month=")[1][:10] for f in spark.read.parquet(out).inputFiles()}
    before = files()
    revenue_refresh.refresh_revenue_cells(rev, cust, out, t.FINANCE_DAY, recent_months=1)
    kept = set(before) & set(files())
    replaced = {before[f] for f in set(before) - kept}
    assert all(m == "1999-07-01" or m >= "2001-07-01" for m in replaced)  # revenue dated ahead has later months


def _open_batches(folder):
    return sum(len(list(day.glob("batch_id=*"))) for day in Path(f"{folder}/out").glob("metric_date=*"))


def test_compacted_days_equal_the_batch_before_and_after_late_batches(spark, sf, folder):
    events = t.page_events(spark, sf)
    first, second = events.randomSplit([0.5, 0.5], seed=5)
    first.repartition(3).write.parquet(f"{folder}/in")
    _stream(spark, f"{folder}/in", folder).awaitTermination()
    out, far = f"{folder}/out", date(2100, 1, 1)
    read = lambda: _as_rows(page_loads.read_page_load_metrics(spark, out, NOW, 24 * 40))
    before, folders = read(), _open_batches(folder)
    days = page_loads.compact_page_loads(spark, out, far)
    assert len(days) > 20 and read() == before
    assert page_loads.compact_page_loads(spark, out, far) == []  # nothing new since
    page_loads.vacuum_page_loads(spark, out)
    assert read() == before and _open_batches(folder) <= len(days) < folders / 2  # the newest batch alone is left

    # Batches that change minutes of compacted days are read beside them, and go in with the next compaction.
    second.repartition(3).write.mode("append").parquet(f"{folder}/in")
    _stream(spark, f"{folder}/in", folder).awaitTermination()
    expected = _as_rows(page_loads.page_load_metrics(events, NOW, 24 * 40))
    assert read() == expected
    page_loads.compact_page_loads(spark, out, days[5])  # twice without a new batch between: neither replaces the other's folders
    page_loads.compact_page_loads(spark, out, far)
    page_loads.vacuum_page_loads(spark, out)
    assert read() == expected and len(_compacted_folders(spark, out)) <= len(days) + 1


def _compacted_folders(spark, out):
    return page_loads._compacted(spark, out).folders()


def test_a_compaction_that_dies_before_its_manifest_changes_nothing(spark, sf, folder, monkeypatch):
    t.page_events(spark, sf).repartition(3).write.parquet(f"{folder}/in")
    _stream(spark, f"{folder}/in", folder).awaitTermination()
    out = f"{folder}/out"
    before = _as_rows(page_loads.read_page_load_metrics(spark, out, NOW))

    def die(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(page_loads.PartTable, "_publish", die)
        with pytest.raises(RuntimeError):
            page_loads.compact_page_loads(spark, out, date(2100, 1, 1))
    assert _as_rows(page_loads.read_page_load_metrics(spark, out, NOW)) == before
    assert page_loads.vacuum_page_loads(spark, out) == []
    assert page_loads.compact_page_loads(spark, out, date(2100, 1, 1)) and _as_rows(page_loads.read_page_load_metrics(spark, out, NOW)) == before


def test_expired_days_are_empty_and_stay_so(spark, sf, folder):
    events = t.page_events(spark, sf)
    events.repartition(3).write.parquet(f"{folder}/in")
    _stream(spark, f"{folder}/in", folder).awaitTermination()
    out = f"{folder}/out"
    compacted = page_loads.compact_page_loads(spark, out, NOW.date())
    cut = compacted[len(compacted) // 2]
    last = max(b for batches in page_loads._emitted_folders(spark, out).values() for b in batches)
    assert all(day < cut for day in page_loads.expire_page_loads(spark, out, cut))
    assert page_loads.expire_page_loads(spark, out, cut) == []
    for _ in range(2):
        got = page_loads.read_page_load_metrics(spark, out, NOW, 24 * 40)
        whole = page_loads.page_load_metrics(events, NOW, 24 * 40)
        kept = F.col("metric_minute").cast("date") >= F.lit(cut)
        assert _as_rows(got.filter(kept)) == _as_rows(whole.filter(kept))
        newest = spark.read.schema(page_loads._STORED).parquet(out).filter(F.col("batch_id") == last)
        seen = {r.metric_minute for r in newest.filter(F.col("metric_date") < F.lit(cut)).select("metric_minute").collect()}
        assert {r.metric_minute for r in got.filter(~kept).select("metric_minute").collect()} == seen  # the newest batch may still be writing
        page_loads.vacuum_page_loads(spark, out)


def test_compacting_a_sink_without_rows_or_batches(spark, sf, folder):
    t.page_events(spark, sf).limit(0).write.parquet(f"{folder}/in")
    _stream(spark, f"{folder}/in", folder).awaitTermination()
    for job in (page_loads.compact_page_loads, page_loads.expire_page_loads):
        assert job(spark, f"{folder}/out", date(2100, 1, 1)) == []
    assert page_loads.vacuum_page_loads(spark, f"{folder}/out") == []
    with pytest.raises(AnalysisException):
        page_loads.read_page_load_metrics(spark, f"{folder}/no such", NOW).collect()
