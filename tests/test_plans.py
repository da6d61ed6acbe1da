"""What the physical plans must not do, and what must reach the scans."""

import re

import pytest
from pyspark.sql import functions as F

from tallyward.operators import tenancy
from tallyward.sources import testdata as t
from workloads import registry
from plan_audit import physical_plan

WRITERS = {"daily_revenue_metrics_deltas", "customer_count_rollup", "catalog_changes", "page_event_accounting", "page_ledger_metrics", "page_load_metrics_stream", "page_load_metrics_compacted", "daily_revenue_metrics_incremental", "effective_roles", "appended_request_log", "published_catalog"}
PLAIN = sorted(n for n in registry.queries() if n not in WRITERS and not n.startswith("governance_daily"))


@pytest.fixture(scope="module")
def plans(spark, sf):
    """Plans as for tables too large to broadcast."""
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.maxMetadataStringLength": "2000"}
    saved = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    queries = registry.queries()
    yield {name: physical_plan(queries[name](spark, sf)) for name in PLAIN}
    for k, v in saved.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("name", PLAIN)
def test_no_pairwise_joins_and_no_python(plans, name):
    assert not re.search(r"CartesianProduct|NestedLoopJoin", plans[name])
    assert not re.search(r"PythonUDF|EvalPython|InPandas|InArrow", plans[name])


@pytest.mark.parametrize(
    "name, column",
    [
        ("total_revenue", "l_shipdate"),
        ("mrr", "l_shipdate"),
        ("nrr_by_segment", "l_shipdate"),
        ("daily_revenue_metrics", "l_shipdate"),
        ("agent_health_dashboard", "ts"),
        ("grounding_rate", "ts"),
        ("confidence_drift", "ts"),
        ("page_load_metrics", "ts"),
        ("change_velocity", "o_orderdate"),
        ("sox_evidence", "o_orderdate"),
        ("incident_sla_compliance", "o_orderdate"),
    ],
)
def test_time_bounds_reach_the_scan(plans, name, column):
    assert re.search(rf"PushedFilters: \[[^\]]*Than[A-Za-z]*\({column},", plans[name])


@pytest.mark.parametrize("name", ["total_revenue", "mrr", "arr", "qoq_growth", "services_revenue", "orphan_check_product"])
def test_revenue_without_customers_reads_no_orders(plans, name):
    assert "orders.parquet" not in plans[name]


@pytest.mark.parametrize("name, most", [("region_access", 1), ("glossary_latest", 2), ("flag_zombies_changed", 1)])
def test_scans_of_the_input(plans, name, most):
    biggest = {"region_access": "customer", "glossary_latest": "nation", "flag_zombies_changed": "part"}[name]
    assert plans[name].count(f"{biggest}.parquet") <= most


def test_an_update_knows_its_delta_without_a_shuffle(plans):
    assert "Exchange" not in plans["flag_zombies_changed"]


def test_versions_of_a_term_are_limited_before_they_meet(plans):
    assert re.search(r"WindowGroupLimit.*Exchange.*WindowGroupLimit", plans["glossary_latest"], re.DOTALL)


@pytest.mark.parametrize("name", ["bi_revenue_summary", "bi_tenant_totals", "gdpr_safe_aggregates", "k_anonymity_check"])
def test_raw_tenant_lines_are_shuffled_once(plans, name):
    """Going up from the scan of the lines, one exchange comes before the first aggregate, a partial one: the one by order."""
    tree = plans[name].splitlines()
    depth = lambda line: len(re.match(r"[ :+-]*", line).group())
    scan = next(i for i, line in enumerate(tree) if "lineitem.parquet" in line)
    above, at = [], depth(tree[scan])
    for line in reversed(tree[:scan]):
        if depth(line) < at:
            at = depth(line)
            above.append(line)
    first_sum = next(i for i, line in enumerate(above) if "HashAggregate" in line)
    exchanges = [line for line in above[:first_sum] if "Exchange" in line]
    assert len(exchanges) == 1 and "hashpartitioning(order_key" in exchanges[0]


def test_cells_of_lines_equal_cells_of_rows(spark, sf):
    lines = t.tenant_lines(spark, sf).withColumn("order_key", F.expr("if(order_key % 7 = 0, null, order_key)"))
    lines = lines.withColumn("product_key", F.expr("if(product_key % 5 = 0, -product_key, product_key)"))
    buyers, products = t.tenant_buyers(spark, sf), t.tenant_products(spark, sf)
    rows = lines.join(buyers, "order_key", "left").join(products, "product_key", "left")
    for unit in ("day", "month"):
        want = tenancy.customer_cells(rows, unit)
        got = tenancy.customer_cells_of_lines(lines, buyers, products, unit).select(*want.columns)
        assert want.count() == got.count() and want.exceptAll(got).isEmpty()
        assert got.filter("customer_id IS NULL").count() and got.filter("product_line IS NULL").count()
