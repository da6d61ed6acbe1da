"""Alert conditions stored as text: what may run, what is refused, and what they answer."""

import re
from datetime import datetime

import pytest

from plan_audit import physical_plan
from tallyward.operators import alert_texts, control
from tallyward.sources import seeds
from tallyward.sources import testdata as t

NOW = datetime(2001, 7, 15)
KIND = "rule_name string, relation string, row_filter string, condition string"


@pytest.fixture(scope="module")
def relations(spark, sf):
    return {"metric_catalog": t.metric_catalog(spark, sf), "domain_registry": t.domain_registry(spark, sf), "incident_log": t.incident_log(spark, sf), "change_log": t.change_log(spark, sf)}


def answers(spark, relations, *rules):
    frame = spark.createDataFrame([(str(i), *r) for i, r in enumerate(rules)], KIND)
    got = {int(r.rule_name): (r.condition_met, r.refused) for r in alert_texts.stored_conditions(frame, relations, NOW).collect()}
    return [got[i] for i in range(len(rules))]


@pytest.mark.parametrize("now", [NOW, datetime(1995, 3, 1), datetime(1998, 8, 2, 1, 30)])
def test_stored_texts_equal_the_registry(spark, relations, now):
    got = {r.rule_name: (r.condition_met, r.refused) for r in alert_texts.stored_conditions(seeds.alert_texts(spark), relations, now).collect()}
    frames = [relations[n] for n in ("metric_catalog", "domain_registry", "incident_log", "change_log")]
    want = {r.rule_name: (r.condition_met, None) for r in control.alert_conditions(*frames, now).collect()}
    assert got == want and len(got) == 6


@pytest.mark.parametrize(
    "row_filter, condition, named",
    [
        (None, "exists (select 1 from secrets)", "exists, from, secrets, select"),
        (None, "count(*) > (SELECT 1)", "select"),
        (None, "java_method('java.lang.System', 'exit') = '1'", "java_method"),
        ("reflect('a', 'b') = '1'", "count(*) > 0", "reflect"),
        ("domain (1) = 1", "count(*) > 0", "domain"),
        (None, "current_user() = 'x'", "current_user"),
        (None, "max(no_such_column) > 1", "no_such_column"),
    ],
)
def test_what_a_text_may_not_name(spark, relations, row_filter, condition, named):
    assert answers(spark, relations, ("metric_catalog", row_filter, condition)) == [(False, f"may not name {named}")]


@pytest.mark.parametrize("condition", ["count(*) > 0 -- x", "count(*) /* x */ > 0", "count(`domain`) > 0", "count(*) > 0; drop table x", "max(domain) = 'x", "max(domain) = r'\\' or 1 = '1'", 'max(domain) = "x"', "count(*) > :p", "count(*) > 0 ; 1"])
def test_what_a_text_may_not_hold(spark, relations, condition):
    (met, refused), = answers(spark, relations, ("metric_catalog", None, condition))
    assert not met and refused is not None and not refused.startswith("not valid")


def test_refusals_leave_the_other_rules_alone(spark, relations):
    got = answers(
        spark,
        relations,
        ("metric_catalog", None, "count(*) > 0"),
        ("elsewhere", None, "count(*) > 0"),
        (None, None, "count(*) > 0"),
        ("metric_catalog", None, None),
        ("metric_catalog", None, "count(*)"),
        ("metric_catalog", None, "domain = 'x'"),
        ("metric_catalog", None, "count(*) >"),
        ("metric_catalog", "count(*) > 0", "count(*) > 0"),
        ("metric_catalog", "domain", "count(*) > 0"),
        ("metric_catalog", None, "max(domain) = 'it''s (select'"),
        ("metric_catalog", "domain IN ('no such')", "max(domain) <> 'a'"),
        ("metric_catalog", None, "count(*) filter (where domain is null) = 0"),
    )
    assert got[0] == (True, None) and got[1] == (False, "relation elsewhere is not offered") and got[2] == (False, "relation null is not offered")
    assert got[3] == (False, "no condition") and got[4] == (False, "not a truth value: bigint")
    assert all(not met and refused.startswith("not valid") for met, refused in got[5:9])
    assert got[9] == (False, None) and got[10] == (False, None) and got[11] == (True, None)


def test_no_rules_and_too_many(spark, relations):
    none = spark.createDataFrame([], KIND)
    assert alert_texts.stored_conditions(none, relations, NOW).isEmpty()
    twice = spark.createDataFrame([("a", "change_log", None, "count(*) > 0")] * 2, KIND)
    assert [tuple(r) for r in alert_texts.stored_conditions(twice, relations, NOW).collect()] == [("a", True, None)] * 2
    with pytest.raises(ValueError):
        alert_texts.stored_conditions(twice, relations, NOW, max_rules=1)


def test_filters_of_texts_reach_the_scan(spark, relations):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        plan = physical_plan(alert_texts.stored_conditions(seeds.alert_texts(spark), relations, NOW))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert len(re.findall(r"PushedFilters: \[[^\]]*Than[A-Za-z]*\(o_orderdate,", plan)) >= 2
