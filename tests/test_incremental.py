"""Ledgers, mergeable states, published versions, payloads and SQL functions against whole recomputation."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from frames import rows
from plan_audit import physical_plan
from tallyward.context import Principal
from tallyward.functions import payloads
from tallyward.operators import access, distinct_cells, lifecycle, metrics
from tallyward.plans.daily import CATALOG, governance_daily, governance_daily_published
from tallyward.sources import changes, seeds, sql_functions
from tallyward.sources import testdata as t
from tallyward.sources.parts import PartTable
from tallyward.streaming import page_loads, quantile_states
from tallyward.streaming.page_ledger import PageLedger, StreamTotals
from tallyward.streaming.revenue_ledger import RevenueLedger, signed
from workloads import registry

LINE = "recognized_date date, customer_id string, amount_usd decimal(12,4), is_recurring boolean"
AS_OF = date(2001, 7, 15)


# ---------------------------------------------------------------- parts


def test_parts_are_replaced_alone_and_published_last(spark, folder):
    table = PartTable(spark, folder, "day", "k string, v decimal(12,2)")
    days = [date(2001, 1, d) for d in (1, 2, 3)]
    assert table.read().collect() == [] and table.newest() is None

    def of(batch, *keep):
        return spark.createDataFrame([(f"b{batch}", batch, d) for d in keep], "k string, v int, day date").select("k", F.col("v").cast("decimal(12,2)").alias("v"), "day")

    table.replace(of(1, *days), days, 1)
    first = set(table.read().inputFiles())
    table.replace(of(2, days[1]), [days[1], days[2]], 2)  # the third day has no rows left
    assert sorted((r.day, r.k) for r in table.read().collect()) == [(days[0], "b1"), (days[1], "b2")]
    assert table.read([days[2]]).collect() == [] and len(set(table.read().inputFiles()) & first) == 1
    # A batch that ends before its manifest changes nothing, and repeating it replaces what it left.
    of(9, *days).write.partitionBy("day").parquet(f"{folder}/data/batch=3")
    assert sorted(r.k for r in table.read().collect()) == ["b1", "b2"]
    table.replace(of(3, days[0]), [days[0]], 3)
    table.replace(of(3, days[0]), [days[0]], 3)
    assert sorted(r.k for r in table.read().collect()) == ["b2", "b3"]
    before = rows(table.read())
    assert table.vacuum() and rows(table.read()) == before and table.vacuum() == []
    table.drop([days[1]], 4)
    assert [r.k for r in table.read().collect()] == ["b3"]


# ---------------------------------------------------------------- signed deltas


def some_lines(n, seed, first=date(1999, 6, 20), days=190):
    rng = random.Random(seed)
    return [(first + timedelta(days=rng.randrange(days)) if rng.random() > 0.02 else None, rng.choice(["C1", "C2", "C3", "C4", "hot", "hot", "hot", None, "unknown"]), f"{rng.randrange(1, 99999) / 100:.2f}", rng.choice([True, False, None])) for _ in range(n)]


def lines(spark, values):
    loose = "recognized_date date, customer_id string, amount_usd string, is_recurring boolean"
    return spark.createDataFrame(values, loose).withColumn("amount_usd", F.col("amount_usd").cast("decimal(12,4)"))


@pytest.fixture(scope="module")
def customers(spark):
    return spark.createDataFrame([("C1", "SMB", "EU"), ("C2", "SMB", "EU"), ("C3", "Enterprise", "US"), ("C4", None, "US"), ("hot", "SMB", "US")], "customer_id string, segment string, region string")


def whole(rev, cust, as_of=AS_OF):
    return {(r.metric_month, r.segment, r.region): (float(r.total_revenue), float(r.recurring_revenue or 0), r.customer_count) for r in metrics.daily_revenue_metrics(rev, cust, as_of).collect()}


def kept(ledger, cust, as_of=AS_OF):
    return {(r.metric_month, r.segment, r.region): (float(r.total_revenue), float(r.recurring_revenue), r.customer_count) for r in ledger.read(cust, as_of).collect()}


def test_deltas_equal_the_full_rebuild(spark, customers, folder):
    ledger = RevenueLedger(spark, folder)
    first = some_lines(300, 1)
    ledger.apply(signed(lines(spark, first), 1), customers, 1)
    assert kept(ledger, customers) == whole(lines(spark, first), customers)

    # Late, corrected and deleted lines, all in three months in the middle.
    middle = [date(1999, 9, 3), date(1999, 10, 31), date(1999, 11, 1)]
    late = [(d, c, "10.50", True) for d in middle for c in ("C1", "C4", "hot")]
    gone = [x for x in first if x[0] and (x[0].year, x[0].month) in {(1999, 9), (1999, 10)}][:7]
    fixed = [x for x in first if x[0] and (x[0].year, x[0].month) == (1999, 11)][:5]
    better = [(d, "C2", "77.00", False) for d, *_ in fixed]
    before = set(ledger.lines.folders()) | set(ledger.cells.folders())
    read = []
    plain = PartTable.read

    def spy(self, parts=None):
        got = plain(self, parts)
        read.extend(got.inputFiles())
        return got

    PartTable.read = spy
    try:
        delta = signed(lines(spark, late + better), 1).unionByName(signed(lines(spark, gone + fixed), -1))
        months = ledger.apply(delta, customers, 2)
    finally:
        PartTable.read = plain
    assert months == [date(1999, 9, 1), date(1999, 10, 1), date(1999, 11, 1)]
    assert {f.split("metric_month=")[1][:10] for f in read} == {str(m) for m in months}  # no other month is read
    assert len(before & (set(ledger.lines.folders()) | set(ledger.cells.folders()))) == len(before) - 6
    now = [x for x in first if x not in gone and x not in fixed] + late + better
    assert kept(ledger, customers) == whole(lines(spark, now), customers)
    assert kept(ledger, customers, date(2001, 8, 1)) == whole(lines(spark, now), customers, date(2001, 8, 1))


def test_a_repeated_or_broken_batch_counts_once(spark, customers, folder):
    ledger, values = RevenueLedger(spark, folder), some_lines(60, 2)
    delta = signed(lines(spark, values), 1)
    derive, ledger.derive = ledger.derive, lambda *_: (_ for _ in ()).throw(RuntimeError("lost"))
    with pytest.raises(RuntimeError):
        ledger.apply(delta, customers, 1)  # the lines are published, the cells are not
    ledger.derive = derive
    for _ in range(2):
        ledger.apply(delta, customers, 1)
    assert kept(ledger, customers) == whole(lines(spark, values), customers)


def test_withdrawn_before_it_arrives_and_empty_months(spark, customers, folder):
    ledger, one = RevenueLedger(spark, folder), [(date(2000, 3, 3), "C1", "5.00", True)]
    assert ledger.apply(signed(lines(spark, one), -1), customers, 1) == [date(2000, 3, 1)]
    assert all(v[2] == 0 for v in kept(ledger, customers).values())
    ledger.apply(signed(lines(spark, one), 1), customers, 2)
    assert kept(ledger, customers) == {} and ledger.lines.folders() == []
    assert ledger.apply(signed(lines(spark, one), 1).limit(0), customers, 3) == []
    ledger.apply(signed(lines(spark, one * 3), 1), customers, 4)
    assert kept(ledger, customers) == {(date(2000, 3, 1), "SMB", "EU"): (15.0, 15.0, 1)}


def test_a_customer_that_moves_takes_its_months_along(spark, customers, folder):
    ledger, values = RevenueLedger(spark, folder), some_lines(80, 3)
    ledger.apply(signed(lines(spark, values), 1), customers, 1)
    moved = customers.withColumn("segment", F.when(F.col("customer_id") == "C1", "Enterprise").otherwise(F.col("segment")))
    months = ledger.months_of(moved.filter("customer_id = 'C1'"))
    assert months == sorted({d.replace(day=1) for d, c, *_ in values if c == "C1" and d})
    ledger.derive(months, moved, 2)
    assert kept(ledger, moved) == whole(lines(spark, values), moved)


# ---------------------------------------------------------------- distinct counts that merge


def test_numbers_are_dense_and_stay(spark, folder):
    def ids(*names):
        return spark.createDataFrame([(n,) for n in names], "id string").repartition(3)

    first = {r.id: r.number for r in distinct_cells.extend_numbering(ids("a", "b", "b", None, "c"), folder, 1).collect()}
    assert sorted(first) == ["a", "b", "c"] and sorted(first.values()) == [1, 2, 3]
    second = {r.id: r.number for r in distinct_cells.extend_numbering(ids("b", "d", "e"), folder, 2).collect()}
    assert {k: second[k] for k in first} == first and sorted(second.values()) == [1, 2, 3, 4, 5]
    again = {r.id: r.number for r in distinct_cells.extend_numbering(ids("b", "d", "e"), folder, 2).collect()}
    assert sorted(again.values()) == [1, 2, 3, 4, 5] and {k: again[k] for k in first} == first
    assert distinct_cells.extend_numbering(ids(), folder, 3).count() == 5


def test_merged_cells_equal_count_distinct(spark, folder):
    n = 70_000  # more than one range of numbers
    ids = spark.range(n).select(F.concat(F.lit("u"), "id").alias("id"))
    numbering = distinct_cells.extend_numbering(ids, folder, 1)
    facts = spark.range(200_000).select(
        F.concat(F.lit("u"), F.pmod(F.col("id") * 7919, F.lit(n))).alias("user"), F.pmod(F.col("id"), F.lit(12)).alias("month"), F.when(F.col("id") % 3 > 0, F.pmod(F.hash("id"), F.lit(2))).alias("side")
    )
    facts = facts.unionByName(spark.createDataFrame([(None, 1, 1), ("nobody", 1, 1), ("u5", None, None)], facts.schema))
    cells = distinct_cells.distinct_cells(facts, numbering, {"month": F.col("month"), "side": F.col("side")}, "user")
    for keys in ({"month": F.col("month"), "side": F.col("side")}, {"quarter": F.floor(F.col("month") / 3)}, {"side": F.col("side")}, {}):
        known = facts.filter("user IS NULL OR user <> 'nobody'").groupBy(*[c.alias(k) for k, c in keys.items()]).agg(F.count_distinct("user").alias("distinct_count"))
        assert rows(distinct_cells.distinct_count(cells, keys)) == rows(known.filter("distinct_count > 0"))
    # Months merged to quarters first, then to all: the same.
    quarters = distinct_cells.merged_cells(cells, {"quarter": F.floor(F.col("month") / 3)})
    assert rows(distinct_cells.distinct_count(quarters, {})) == rows(distinct_cells.distinct_count(cells, {}))


def test_a_rollup_reads_no_fact(spark, sf):
    plan = physical_plan(registry.queries()["customer_count_rollup"](spark, sf))
    assert "lineitem" not in plan and "orders" not in plan and "cells" in plan


# ---------------------------------------------------------------- versions


def test_only_differing_buckets_are_read(spark, folder):
    rows_ = [(i, f"v{i}" if i % 5 else None, "" if i % 7 else None, [1, i] if i % 2 else None) for i in range(500)]
    old = spark.createDataFrame(rows_, "k int, a string, b string, c array<int>")
    rows_[10] = (10, "", None, [1])
    rows_[20:22] = []
    rows_ += [(700, None, None, None), (30, *rows_[28][1:]), (30, *rows_[28][1:])]
    new = spark.createDataFrame(rows_, old.schema)
    changes.publish_version(old.repartition(5), folder, "a.t", 1, ["k"])
    changes.publish_version(old.orderBy(F.desc("k")), folder, "a.t", 2, ["k"])
    changes.publish_version(new, folder, "a.t", 3, ["k"])
    assert not changes.has_changed(spark, folder, "a.t", 1, 2) and changes.changed_keys(spark, folder, "a.t", 1, 2, ["k"]).isEmpty()
    got = changes.changed_keys(spark, folder, "a.t", 2, 3, ["k"])
    assert sorted(tuple(r) for r in got.collect()) == [(10, "changed", 1, 1), (20, "removed", 1, 0), (21, "removed", 1, 0), (30, "changed", 1, 3), (700, "added", 0, 1)]
    buckets = changes.changed_buckets(spark, folder, "a.t", 2, 3)
    assert 1 <= len(buckets) <= 5 < changes.BUCKETS
    part = changes.read_version(spark, folder, "a.t", 3, buckets)
    assert "PartitionFilters: [isnotnull(bucket" in physical_plan(part) or "PartitionFilters: [bucket" in physical_plan(part)
    read = {f.split("bucket=")[1].split("/")[0] for f in (r.f for r in part.select(F.input_file_name().alias("f")).distinct().collect())}
    assert read <= {str(b) for b in buckets}
    assert rows(changes.read_version(spark, folder, "a.t")) == rows(new)


def test_nulls_are_not_empty_text(spark, folder):
    for version, value in ((1, (1, None, "x")), (2, (1, "x", None)), (3, (1, "x", ""))):
        changes.publish_version(spark.createDataFrame([value], "k int, a string, b string"), folder, "t", version, ["k"])
    assert changes.has_changed(spark, folder, "t", 1, 2) and changes.has_changed(spark, folder, "t", 2, 3)
    changes.publish_version(spark.createDataFrame([], "k int, a string, b string"), folder, "t", 4, ["k"])
    assert changes.newest_version(spark, folder, "t") == 4 and changes.has_changed(spark, folder, "t", 3, 4)


def test_a_consumer_knows_what_is_new(spark, folder):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    changes.publish_version(df, folder, "t", 1, ["k"])
    consumer = changes.Consumer(spark, folder, "t", "one")
    assert consumer.has_data()
    consumer.advance(1)
    assert not consumer.has_data() and changes.Consumer(spark, folder, "t", "two").has_data()
    changes.publish_version(df, folder, "t", 2, ["k"])
    assert not consumer.has_data()  # published again, the same rows
    changes.publish_version(df.unionByName(df), folder, "t", 3, ["k"])
    assert consumer.has_data()


def test_the_daily_cycle_finds_out_by_itself(spark, sf, folder):
    cat, parts = t.metric_catalog(spark, sf), [t.domain_registry(spark, sf), t.query_history(spark, sf), t.incident_log(spark, sf), t.change_log(spark, sf), seeds.alert_rules(spark)]
    tuesday = t.FINANCE_MONDAY + timedelta(days=1)
    changes.publish_version(cat, folder, CATALOG, 1, ["metric_fqn"])
    columns = ["metric_fqn", "certification_status", "tags", "updated_at"]
    first = governance_daily_published(spark, folder, *parts, tuesday)
    expected = governance_daily(cat, *parts, tuesday, catalog_changed=True).catalog
    assert rows(first.catalog.select(columns)) == rows(expected.select(columns)) == rows(changes.read_version(spark, folder, CATALOG).select(columns))
    published = changes.read_version(spark, folder, CATALOG)
    later = tuesday + timedelta(days=1)
    second = governance_daily_published(spark, folder, *parts, later)  # nothing but its own update since
    assert rows(second.catalog.select(columns)) == rows(governance_daily(published, *parts, later, catalog_changed=False).catalog.select(columns))


# ---------------------------------------------------------------- the page ledger

EVENT = "event_id bigint, tenant_id string, user_id string, page_name string, load_time_ms int, event_timestamp timestamp_ntz"


def test_every_event_is_counted_or_late(spark, folder):
    """Unordered batches, some written twice or by another driver."""
    rng, start = random.Random(4), datetime(2024, 1, 1)
    ledger = PageLedger(spark, folder)
    write, newest, on_time, late, n = ledger.writer(), None, [], [], 0
    batches = []
    for b in range(8):
        around = start + timedelta(hours=26 * b)
        batches.append([(n + i, f"T{i % 2}", "U", "/a", rng.randrange(100, 5000), around - timedelta(minutes=rng.randrange(0, 60 * 40))) for i in range(25)])
        n += 25
    batches[3].append((n, "T0", "U", "/a", 5, None))
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        for b, batch in enumerate(batches):
            mark = newest - timedelta(hours=24) if newest else None
            for e in batch:
                (late if e[5] is None or (mark and e[5] < mark) else on_time).append(e)
            newest = max([e[5] for e in batch if e[5]] + ([newest] if newest else []))
            if b == 2:
                write = ledger.writer()  # another driver goes on
            write(spark.createDataFrame(batch, EVENT), b)
            if b == 5:
                write(spark.createDataFrame(batch, EVENT), b)  # a batch that is repeated
            if b == 3:
                ledger.compact()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert late and tuple(ledger.accounting().first()) == (len(on_time) + len(late), len(on_time), len(late))
    assert sorted(r.event_id for r in ledger.late_events(EVENT).collect()) == sorted(e[0] for e in late)
    now = newest + timedelta(hours=1)

    def equal(hours):
        expected = page_loads.page_load_metrics(spark.createDataFrame(on_time, EVENT), now.replace(second=0), hours)
        assert rows(ledger.read(now.replace(second=0), hours)) == rows(expected)

    equal(24 * 400)
    # A compaction that ends before its manifest changes nothing; then a closed day is one folder.
    publish, PartTable._publish = PartTable._publish, lambda *_: (_ for _ in ()).throw(RuntimeError("lost"))
    with pytest.raises(RuntimeError):
        ledger.compact()
    PartTable._publish = publish
    equal(24 * 400)
    assert ledger.compact()
    equal(24 * 400)
    equal(24)
    closed = ledger.days.manifest()
    assert set(closed) == {e[5].date() for e in on_time if e[5].date() < ledger.watermark().date()}
    assert len(ledger.days.folders()) == len(closed) and not [f for f in ledger._open_folders() if date.fromisoformat(f.rsplit("=", 1)[1]) in closed]
    # Old batch folders go, their events stay accounted for.
    assert ledger.vacuum()
    assert tuple(ledger.accounting().first()) == (len(on_time) + len(late), len(on_time), len(late)) and ledger.progress().count() < 7
    equal(24 * 400)
    # So do expired days.
    limit = min(closed) + timedelta(days=3)
    assert ledger.expire(limit) == [d for d in sorted(closed) if d < limit]
    left = ledger.read(now, 24 * 400)
    assert left.agg(F.min("metric_minute")).first()[0].date() >= limit
    assert ledger.accounting().first().rows_in == len(on_time) + len(late)


def test_totals_of_more_batches_than_a_query_remembers(spark, folder):
    schema = "k int, at timestamp"
    for i in range(13):
        spark.createDataFrame([(i, datetime(2024, 1, 1) + timedelta(hours=i if i % 4 else 0))], schema).coalesce(1).write.mode("append").parquet(folder)
    totals, kept_batches = StreamTotals(), spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "5")
    spark.streams.addListener(totals)
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        events = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder).withWatermark("at", "2 hours")
        stream = events.groupBy("at").count().writeStream.outputMode("update").format("noop").trigger(availableNow=True).start()
        stream.awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", kept_batches)
        spark.streams.removeListener(totals)
    mine = totals.of[str(stream.runId)]
    assert mine["rows_in"] == 13 and mine["batches"] >= 13 and len(stream.recentProgress) < 13
    assert mine["rows_dropped"] == 3  # the fifth, ninth and last event go back to the beginning


# ---------------------------------------------------------------- sketches, payloads, SQL functions


def test_merged_sketches_stay_within_their_error(spark):
    events = spark.range(60_000).select(
        F.lit("T").alias("tenant_id"), F.when(F.col("id") % 3 > 0, "/hot").otherwise("/a").alias("page_name"),
        F.when(F.col("id") % 11 > 0, (F.pmod(F.hash("id"), F.lit(100_000)) * F.pmod(F.hash("id"), F.lit(7))).cast("int")).alias("load_time_ms"),
        F.timestamp_seconds(1_704_067_200 + F.col("id") % 86_400 * 2).cast("timestamp_ntz").alias("event_timestamp"),
    )
    day = F.col("metric_minute").cast("date")
    states = quantile_states.minute_states(events, 200)
    hours = quantile_states.merged_states(states, F.date_trunc("hour", "metric_minute").cast("timestamp_ntz"), "metric_minute", 200)
    for merged in (quantile_states.merged_states(states, day, "metric_day", 200), quantile_states.merged_states(hours, day, "metric_day", 200)):
        named = quantile_states.quantiles(merged, {"p50": 0.5, "p99": 0.99})
        assert named.agg(F.max(F.length("state"))).first()[0] < 20_000
        for name, q in (("p50", 0.5), ("p99", 0.99)):
            ranks = quantile_states.rank_bounds(events, named, F.col("event_timestamp").cast("date"), "metric_day", name).collect()
            assert len(ranks) == 4 and all(r.rank_from <= q + quantile_states.rank_error(200) and r.rank_to >= q - quantile_states.rank_error(200) for r in ranks)


def test_payloads_of_any_kind(spark):
    texts = ['{"k": 1}', '{"k": "2"}', '{"k": 2.5}', '{"k": [3]}', '{"k": null}', "{}", '{"k": "x"}', "5", "[1]", "null", '{"k": 1', "", None, '{"k": true}', '{"k": 99999999999999999999}']
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, text string")
    value = payloads.payload(F.col("text"))
    got = {r.i: (r.k, r.bad) for r in df.select("i", payloads.field(value, "$.k", "bigint").alias("k"), payloads.broken(F.col("text")).alias("bad")).collect()}
    assert [got[i][0] for i in range(15)] == [1, 2, 2, None, None, None, None, None, None, None, None, None, None, 1, None]
    assert [i for i in range(15) if got[i][1]] == [10, 11]
    fields = {(r.key, r.value_type): (r.rows, r.total) for r in payloads.payload_fields(df, "text", []).collect()}
    assert fields[("k", "STRING")] == (2, None) and fields[("k", "BIGINT")] == (1, 1.0) and fields[("k", "NULL")] == (1, None) and fields[(None, "BROKEN")] == (2, None)
    assert fields[("k", "ARRAY")][0] == fields[("k", "BOOLEAN")][0] == 1


def test_sql_functions_are_the_same_joins(spark, sf):
    users, member = t.tenant_users(spark, sf), Principal("user101@example.com", "ANALYST")
    sql_functions.install_tenant_rows(spark, "my_usage", t.tenant_usage(spark, sf), users)
    by_sql = spark.sql("SELECT * FROM my_usage('user101@example.com')")
    expected = access.tenant_isolation(t.tenant_usage(spark, sf), users, member)
    assert rows(by_sql) == rows(expected.select(by_sql.columns)) and not by_sql.isEmpty()
    assert "LeftSemi" in by_sql._jdf.queryExecution().optimizedPlan().toString()
    assert spark.sql("SELECT * FROM my_usage(NULL)").isEmpty()
    sql_functions.install_access_check(spark, {"tenants": t.tenants(spark, sf), "tenant_users": users}, "may_read")
    t.access_requests(spark, sf).createOrReplaceTempView("asked")
    asked = spark.sql("SELECT *, may_read(user_email, metric_name) AS can_access FROM asked")
    assert rows(asked) == rows(access.can_access_metric(t.access_requests(spark, sf), t.tenants(spark, sf), users).select(asked.columns))
    assert [r[0] for r in spark.sql("SELECT may_read('nobody', 'x'), may_read(NULL, NULL)").collect()] == [False]
