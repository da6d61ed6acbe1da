"""Cases that earlier fixtures did not hold."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallyward.operators import access, binding, certification, federation, lifecycle, telemetry
from tallyward.plans.models import MODELS
from tallyward.sources import seeds
from tallyward.sources import testdata as t
from tallyward.streaming import page_loads

NOW = datetime(2001, 7, 15)


@pytest.mark.parametrize("adapter, source", [("fct_revenue", "lineitem"), ("fct_costs", "lineitem"), ("revenue_data", "lineitem"), ("tenant_revenue", "lineitem"), ("business_glossary", "part"), ("dim_customer", "customer"), ("metric_catalog", "part"), ("page_events", "events"), ("api_request_log", "events"), ("change_log", "orders")])
def test_adapters_keep_every_row(spark, sf, adapter, source):
    assert getattr(t, adapter)(spark, sf).count() == t.table(spark, sf, source).count()


def test_a_star_grants_what_is_due_and_is_itself_in_excess(spark):
    tenants = spark.createDataFrame([("a", "free", ["*"]), ("b", "enterprise", ["*", "x"]), ("c", "free", ["active_users", "y"]), ("d", "free", None)], "tenant_id string, tier string, metrics_enabled array<string>")
    got = {(r.tenant_id, r.metric_name): r.entitlement for r in access.tier_entitlements(tenants, seeds.tier_metrics(spark)).collect()}
    assert got == {
        ("a", "*"): "EXCESS", ("a", "active_users"): "GRANTED", ("a", "total_sessions"): "GRANTED",
        ("b", "*"): "GRANTED", ("b", "x"): "GRANTED",
        ("c", "active_users"): "GRANTED", ("c", "total_sessions"): "MISSING", ("c", "y"): "EXCESS",
        ("d", "active_users"): "MISSING", ("d", "total_sessions"): "MISSING",
    }


def test_an_audit_event_keeps_its_own_time(spark):
    kind = "metric_name string, action_date timestamp_ntz"
    audit = spark.createDataFrame([], kind)
    events = spark.createDataFrame([("a", datetime(2001, 1, 1)), ("b", None)], kind)
    got = {r.metric_name: r.action_date for r in certification.record_certification_event(audit, events, NOW).collect()}
    assert got == {"a": datetime(2001, 1, 1), "b": NOW}
    assert certification.record_certification_event(audit, events.drop("action_date"), NOW).filter("action_date IS NULL").isEmpty()


def test_a_delta_keeps_repeated_rows(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 1), ("b", 5), ("c", None)], "k string, v int")
    assert lifecycle.update_where(rows, F.col("v") < 5, {"v": F.lit(2)}, only_changed=True).count() == 2
    assert lifecycle.update_where(rows, F.col("v") == 5, {"v": F.lit(5)}, only_changed=True).isEmpty()
    assert lifecycle.changed(rows, lifecycle.update_where(rows, F.col("v") < 5, {"v": F.lit(2)})).count() == 2


def test_unknown_tenants_are_audited(spark):
    log = spark.createDataFrame([("ghost", NOW), (None, NOW)], "tenant_id string, requested_at timestamp_ntz")
    tenants = spark.createDataFrame([("a", "free")], "tenant_id string, tier string")
    limits = spark.createDataFrame([("free", 10, 100)], "tier string, max_requests_per_minute int, max_requests_per_hour int")
    got = access.rate_limit_audit(log, tenants, limits).collect()
    assert {(r.tenant_id, r.tier, r.window_kind, r.requests, r.allowed) for r in got} == {(i, None, k, 1, 0) for i in ("ghost", None) for k in ("minute", "hour")}


def test_every_binding_target_is_declared():
    for b in binding.BINDINGS:
        assert b.metric in {m.name for m in MODELS[b.view].metrics}, (b.view, b.metric)


def test_latest_versions_of_a_term(spark):
    versions = spark.createDataFrame([("a", 1, "x"), ("a", 3, "z"), ("a", 3, "z"), ("a", 2, "y"), ("b", 7, "q")], "term string, version_id int, canonical_definition string")
    got = {r.term: tuple(r)[1:] for r in federation.glossary_latest(versions).collect()}
    assert got == {"a": (3, "z", 2, 4), "b": (7, "q", None, 1)}


def test_inherited_roles_with_cycles(spark):
    grants = spark.createDataFrame([("a", "b"), ("b", "c"), ("a", "c"), ("c", "a"), ("d", "a"), ("d", "d")], "role string, granted_role string")
    got = {(r.role, r.granted_role): r.distance for r in access.effective_roles(grants).collect()}
    assert got == {("a", "b"): 1, ("b", "c"): 1, ("a", "c"): 1, ("c", "a"): 1, ("d", "a"): 1, ("b", "a"): 2, ("c", "b"): 2, ("d", "b"): 2, ("d", "c"): 2}


@pytest.mark.parametrize("edges", [[(i, i + 1) for i in range(19)] + [(19, 5)], [(i, j) for i in range(9) for j in (2 * i + 1, 2 * i + 2, i + 3)] + [(17, 0)], []])
def test_inherited_roles_equal_a_search_from_each_role(spark, edges):
    want = {}
    for start in {a for a, _ in edges}:
        seen, front, distance = {start}, {start}, 0
        while front:
            distance += 1
            front = {b for a, b in edges if a in front} - seen
            seen |= front
            want |= {(f"r{start}", f"r{b}"): distance for b in front}
    grants = spark.createDataFrame([(f"r{a}", f"r{b}") for a, b in edges] + [("x", None), (None, "y")], "role string, granted_role string")
    got = [tuple(r) for r in access.effective_roles(grants).collect()]
    assert {(a, b): d for a, b, d in got} == want and len(got) == len(want)


def test_answers_of_inconsistent_questions_as_rows(spark):
    kind = "normalized_question string, answer_summary string, metrics_used array<string>, created_at timestamp_ntz"
    rows = [("q", "a", ["m"], NOW), ("q", "a", ["m"], NOW), ("q", "b", None, NOW), ("q", None, [], NOW), ("same", "a", ["m"], NOW), ("same", "a", ["n"], NOW), ("same", None, [], NOW), (None, "x", [], NOW), (None, "y", [], NOW)]
    log = spark.createDataFrame([*rows, ("old", "a", [], datetime(2001, 1, 1)), ("old", "b", [], datetime(2001, 1, 1))], kind)
    got = {(r.normalized_question, r.answer_summary): r.times_given for r in telemetry.answer_variants(log, NOW).collect()}
    assert got == {("q", "a"): 2, ("q", "b"): 1, ("q", None): 1}
    assert telemetry.answer_variants(log.limit(0), NOW).isEmpty()


def test_escalated_questions_as_rows(spark):
    rows = [("a", "r", "why?", NOW), ("a", "r", "why?", NOW), ("a", "r", "x" * 200, NOW), ("b", "r", None, NOW)]
    asked = spark.createDataFrame(rows, "agent_name string, escalation_reason string, user_question string, created_at timestamp_ntz")
    got = {(r.agent_name, r.user_question): r.times_asked for r in telemetry.escalation_questions(asked, NOW).collect()}
    assert got == {("a", "why?"): 2, ("a", "x" * 200): 1, ("b", None): 1}


def test_names_with_and_without_blanks_are_found(spark):
    texts = ["SELECT * FROM DB.Sales_View", "select 1 from odd  view", "pre_db.sales_view_post x", "odd view", None, ""]
    history = spark.createDataFrame([(i, f"u{i % 2}", q, NOW, "SUCCESS") for i, q in enumerate(texts)], "query_id long, user_name string, query_text string, start_time timestamp_ntz, execution_status string")

    def found(*names):
        views = spark.createDataFrame([(n,) for n in names], "semantic_view_fqn string")
        return {r.name: r.query_count for r in lifecycle.view_usage(views, history, NOW).collect()}

    assert found("db.sales_view", "Odd  View", None, "", "unused") == {"db.sales_view": 2, "odd  view": 1}
    assert found("db.sales_view") == {"db.sales_view": 2} and found("odd view") == {"odd view": 1} and found() == {}


def test_building_the_usage_query_runs_no_job(spark, sf):
    tracker, group = spark.sparkContext.statusTracker(), "usage-build"
    spark.sparkContext.setJobGroup(group, group)
    try:
        lifecycle.refresh_usage_stats(t.metric_catalog(spark, sf), t.query_history(spark, sf), NOW)
        started = len(tracker.getJobIdsForGroup(group))
        t.metric_catalog(spark, sf), t.query_history(spark, sf)  # reading the files' schemas alone
        assert len(tracker.getJobIdsForGroup(group)) - started == started
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_rows_of_an_undeclared_tier_stay(spark):
    aged = spark.createDataFrame([("batch", 5), ("nobody's", 5)], "tier_name string, data_age_seconds long")
    got = {r.tier_name: r.within_sla for r in page_loads.freshness_sla(aged, seeds.freshness_tiers(spark)).collect()}
    assert got == {"batch": True, "nobody's": None}
