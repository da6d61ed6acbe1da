"""Dates, empty inputs, NULLs, zero denominators, ties and hot keys."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from frames import frame, one, rows
from tallyward.context import Principal
from tallyward.functions import dates as D
from tallyward.functions import measures as M
from tallyward.operators import access, federation, governance, metrics, quality, telemetry

REV = (
    "contract_id bigint, customer_id string, product_id string, recognized_date date, amount_usd decimal(18,4),"
    " revenue_type string, is_recurring boolean"
)
CUST = (
    "customer_id string, segment string, region string, health_score bigint, contract_status string, account_type string,"
    " last_login_date date, last_engagement_date date"
)
DAY = date(2025, 3, 31)


def rev(spark, rows_):
    return frame(spark, REV, rows_)


def line(customer, day, amount, recurring=True, product="P1"):
    return (1, customer, product, day, amount, "subscription" if recurring else "one_time", recurring)


# ------------------------------------------------------------------ dates


def test_month_shift_keeps_the_last_day():
    assert D.shift_months(date(2025, 3, 31), -1) == date(2025, 2, 28)
    assert D.shift_months(date(2024, 2, 29), 12) == date(2025, 2, 28)
    assert D.shift_months(datetime(2025, 1, 15, 3), -13) == datetime(2023, 12, 15, 3)


@pytest.mark.parametrize(
    "day, calendar, fiscal",
    [
        (date(2025, 1, 31), date(2025, 1, 1), date(2024, 11, 1)),
        (date(2025, 2, 1), date(2025, 1, 1), date(2025, 2, 1)),
        (date(2025, 7, 15), date(2025, 7, 1), date(2025, 5, 1)),
        (date(2025, 12, 31), date(2025, 10, 1), date(2025, 11, 1)),
        (date(2025, 3, 31), date(2025, 1, 1), date(2025, 2, 1)),
    ],
)
def test_quarter_starts(spark, day, calendar, fiscal):
    assert (D.quarter_start(day), D.quarter_start(day, fiscal=True)) == (calendar, fiscal)
    row = spark.range(1).select(
        D.trunc_date(D.lit_date(day), "quarter").alias("c"), D.trunc_date(D.lit_date(day), "quarter", True).alias("f")
    ).first()
    assert (row.c, row.f) == (calendar, fiscal)


def test_hours_count_boundaries(spark):
    a, b = datetime(2025, 1, 1, 0, 59), datetime(2025, 1, 1, 1, 1)
    got = spark.range(1).select(D.boundary_hours(D.lit_ts(a), D.lit_ts(b)), D.boundary_hours(D.lit_ts(b), D.lit_ts(a))).first()
    assert tuple(got) == (1, -1)


def test_ratio_and_percent_without_a_denominator(spark):
    row = spark.range(1).select(
        M.pct(F.lit(1), F.lit(0)).alias("p"), M.mean(F.lit(1), F.lit(0)).alias("m"), M.pct(F.lit(1), F.lit(8), 1).alias("half")
    ).first()
    assert row.p is None and row.m is None and row.half == Decimal("12.5")


def test_percent_rounds_half_up_exactly(spark):
    # 1/16 = 6.25 %, 3/16 = 18.75 %: doubles and decimals must not part ways at the tie
    got = spark.range(1).select(M.pct(F.lit(1), F.lit(16)), M.pct(F.lit(3), F.lit(16)), M.pct(F.lit(23), F.lit(200))).first()
    assert tuple(got) == (Decimal("6.3"), Decimal("18.8"), Decimal("11.5"))


# ------------------------------------------------------------------ empty and NULL


def test_empty_revenue(spark):
    empty = rev(spark, [line("C1", DAY, 1)]).limit(0)
    assert one(metrics.mrr(empty, DAY)).mrr == 0
    assert one(metrics.arr(empty, DAY)).arr == 0
    assert metrics.total_revenue(empty, DAY).isEmpty()
    assert one(metrics.profile_fact_grain(empty)).total_rows == 0
    assert one(quality.orphan_check(empty, empty.select("customer_id"), "customer_id")).orphan_records == 0


def test_empty_log_is_critical(spark):
    ddl = "normalized_question string, answer_summary string, metrics_used array<string>, escalated boolean, created_at timestamp_ntz"
    empty = frame(spark, ddl, [("q", "a", ["m"], False, datetime(2020, 1, 1))]).limit(0)
    now = datetime(2025, 1, 1)
    row = one(telemetry.grounding_rate(empty, now))
    assert (row.grounded, row.total, row.pct, row.status) == (0, 0, None, "CRITICAL")
    assert one(telemetry.consistency_score(empty, now)).status == "CRITICAL"
    assert one(telemetry.escalation_rate(empty, now)).status == "CRITICAL: Too many escalations"


def test_unknown_health_has_no_tier_but_thrives_in_arr(spark):
    cust = frame(spark, CUST, [("C1", "SMB", "EU", None, "active", "customer", DAY, DAY)])
    facts = rev(spark, [line("C1", date(2025, 2, 3), 10)])
    assert one(metrics.health_tier_distribution(cust)).health_tier is None
    assert one(metrics.arr_by_health_tier(facts, cust, DAY)).health_tier == "Thriving"
    assert one(metrics.arr_by_health_tier(facts, cust, DAY)).arr_by_health_tier == 120


def test_null_keys_are_orphans(spark):
    facts = rev(spark, [line(None, DAY, 1), line("C1", DAY, 1), line("C2", DAY, 1), line("C2", DAY, 1)])
    dim = frame(spark, "customer_id string", [("C1",), (None,)])
    assert one(quality.orphan_check(facts, dim, "customer_id")).orphan_records == 3


def test_duplicate_usage_rows_fail_instead_of_doubling(spark):
    cust = frame(spark, CUST, [("C1", "SMB", "EU", 10, "active", "customer", DAY, DAY)])
    facts = rev(spark, [line("C1", date(2025, 2, 3), 10)])
    usage = frame(spark, "customer_id string, usage_month date, usage_trend_pct bigint", [("C1", date(2025, 2, 1), 4)])
    row = one(metrics.arr_at_risk(facts, cust, usage, DAY))
    assert (row.arr_at_risk, row.avg_usage_trend_pct) == (120, Decimal("4.0"))
    with pytest.raises(PySparkException, match="more than one usage row"):
        metrics.arr_at_risk(facts, cust, usage.union(usage), DAY).collect()


def test_customers_without_usage_do_not_pull_the_average(spark):
    cust = frame(spark, CUST, [(c, "SMB", "EU", 10, "active", "customer", DAY, DAY) for c in ("C1", "C2")])
    facts = rev(spark, [line("C1", date(2025, 2, 3), 10), line("C1", date(2024, 2, 3), 10), line("C2", date(2025, 2, 3), 10)])
    usage = frame(spark, "customer_id string, usage_month date, usage_trend_pct bigint", [("C1", date(2025, 2, 1), 4)])
    row = one(metrics.arr_at_risk(facts, cust, usage, DAY))
    assert (row.customer_count, row.arr_at_risk, row.avg_usage_trend_pct) == (2, 240, Decimal("4.0"))


def test_materiality_bands(spark):
    values = frame(spark, "v decimal(18,2)", [(10_049_999.0,), (10_000_000.0,), (1_004_999.0,), (999_999.99,), (-12_345_678.0,)])
    got = [r.rounded for r in metrics.materiality_round(values, "v").orderBy("v").collect()]
    assert got == [-12_300_000, Decimal("999999.99"), 1_000_000, 10_000_000, 10_000_000]


def test_material_changes(spark):
    series = frame(
        spark,
        "k string, p int, v bigint",
        [("a", 1, 100), ("a", 2, 105), ("a", 3, 111), ("b", 1, 100_000_000), ("b", 2, 101_000_001), ("b", 3, 101_000_002)],
    )
    got = rows(metrics.material_changes(series, ["k"], "p", "v"), "k", "p")
    assert got == [("a", 3), ("b", 2)]


def test_version_bumps(spark):
    ddl = "metric_name string, technical_definition string, business_definition string"
    old = frame(spark, ddl, [("same", "t", "b"), ("gone", "t", "b"), ("logic", "t", "b"), ("words", "t", "b"), ("nulls", None, "b")])
    new = frame(spark, ddl, [("same", "t", "b"), ("new", "t", "b"), ("logic", "t2", "b2"), ("words", "t", "b2"), ("nulls", None, "b")])
    got = dict(rows(quality.semantic_version_diff(old, new), "metric_name", "version_bump"))
    assert got == {"gone": "MAJOR", "new": "MINOR", "logic": "MAJOR", "words": "PATCH"}


def test_constraint_violations_count_extra_rows(spark):
    table = frame(spark, "a int, b string", [(1, "x"), (1, "x"), (1, None), (2, None)])
    got = dict(rows(quality.constraint_violations(table, ["a"], ["b"]), "constraint_name", "violations"))
    assert got == {"unique(a)": 2, "not_null(b)": 2}


def test_single_day_has_no_volatility(spark):
    ddl = "timestamp timestamp_ntz, agent_name string, resolved_metric string, confidence_score decimal(4,2), grounded boolean"
    log = frame(spark, ddl, [(datetime(2025, 1, 1, h), "a", "m", 0.5, True) for h in range(3)])
    row = one(telemetry.confidence_drift(log, datetime(2025, 1, 2), minimum_days=1))
    assert row.confidence_volatility is None and row.drift_status == "STABLE"


def test_top_k_ties_are_ordered_by_key(spark):
    ddl = "agent_name string, escalation_reason string, escalation_gate string, led_to_new_metric boolean, created_at timestamp_ntz"
    log = frame(spark, ddl, [("a", f"r{i:02d}", "g", None, datetime(2025, 1, 1)) for i in reversed(range(30))])
    got = [r.escalation_reason for r in telemetry.escalation_improvements(log, datetime(2025, 1, 2)).collect()]
    assert got == [f"r{i:02d}" for i in range(20)]


def test_region_policy(spark):
    data = frame(spark, "region string, v int", [("EU", 1), ("US", 2), ("ALL", 3), (None, 4)])
    mapping = frame(spark, "user_name string, allowed_region string", [("ann", "EU"), ("ann", "EU"), ("bob", "US")])
    assert rows(access.region_access(data, mapping, Principal("ann", "ANALYST")), "v") == [(1,), (3,)]
    assert rows(access.region_access(data, mapping, Principal("eve", "ANALYST")), "v") == [(3,)]
    boss = Principal("eve", "ANALYST", frozenset({"executive_agent_role"}))
    assert access.region_access(data, mapping, boss).count() == 4


def test_glossary_with_one_version(spark):
    versions = frame(spark, "version_id int, term string, canonical_definition string", [(1, "a", "x"), (2, "b", "y"), (5, "b", "z")])
    got = rows(federation.glossary_latest(versions), "term", "version_id", "supersedes_version", "canonical_definition")
    assert got == [("a", 1, None, "x"), ("b", 5, 2, "z")]


def test_domain_without_completed_steps(spark):
    dom = frame(spark, "domain_name string", [("new",), ("old",)])
    ddl = "onboarding_type string, step_order int, blocking boolean"
    checklist = frame(spark, ddl, [("domain", 1, True), ("domain", 2, True), ("domain", 3, False), ("consumer", 4, True)])
    done = frame(spark, "domain_name string, step_order int", [("old", 1), ("old", 2), ("old", 2)])
    got = {r.domain_name: r for r in governance.onboarding_progress(dom, checklist, done).collect()}
    assert (got["new"].steps_left, got["new"].next_blocking_step, got["new"].ready) == (3, 1, False)
    assert (got["old"].steps_done, got["old"].blocking_left, got["old"].ready) == (2, 0, True)


# ------------------------------------------------------------------ hot keys


def test_one_customer_with_most_rows(spark):
    """A customer that owns nearly all rows changes nothing in the results, with or without broadcasts."""
    hot = spark.range(30_000).selectExpr(
        "id AS contract_id",
        "CASE WHEN id % 10 < 9 THEN 'HOT' ELSE concat('C', id % 97) END AS customer_id",
        "concat('P', id % 7) AS product_id",
        "date_sub(DATE'2025-03-30', CAST(id % 700 AS INT)) AS recognized_date",
        "CAST(id % 13 AS DECIMAL(18,4)) AS amount_usd",
        "'usage' AS revenue_type",
        "id % 2 = 0 AS is_recurring",
    )
    cust = hot.select("customer_id").distinct().selectExpr(
        "customer_id", "CASE WHEN customer_id = 'HOT' THEN 'Enterprise' ELSE 'SMB' END AS segment", "'EU' AS region"
    )
    expected = rows(
        hot.join(cust, "customer_id")
        .filter(F.col("recognized_date") >= F.lit("2023-03-31").cast("date"))
        .groupBy(F.trunc("recognized_date", "month").alias("metric_month"), "segment", "region")
        .agg(F.sum("amount_usd"), F.sum(F.expr("CASE WHEN is_recurring THEN amount_usd ELSE 0 END")), F.count_distinct("customer_id"))
    )
    assert rows(metrics.daily_revenue_metrics(hot, cust, DAY)) == expected
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert rows(metrics.daily_revenue_metrics(hot, cust, DAY)) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
