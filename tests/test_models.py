"""Declared models answer like the hand-written metrics, and refuse what is not declared."""

import pytest
from pyspark.sql import functions as F

from frames import rows
from tallyward.operators import metrics
from tallyward.plans.model import multi_domain_query
from tallyward.plans.models import CUSTOMER_HEALTH, FINANCE_REVENUE, MODELS
from tallyward.sources import testdata as t

DAY = t.FINANCE_DAY


@pytest.fixture(scope="module")
def star(spark, sf):
    frames = {
        "fct_revenue": t.fct_revenue(spark, sf).cache(),
        "dim_customer": t.dim_customer(spark, sf).cache(),
        "dim_product": t.dim_product(spark, sf).cache(),
    }
    yield frames
    for frame in frames.values():
        frame.unpersist()  # plans of later tests must show their own scans


def _year():
    return F.col("recognized_date") >= F.lit("2000-07-15").cast("date")


@pytest.mark.parametrize(
    "metric, hand_written",
    [
        ("total_revenue", metrics.total_revenue),
        ("recurring_revenue", metrics.recurring_revenue),
        ("services_revenue", metrics.services_revenue),
        ("customer_count", metrics.customer_count),
        ("arpc", metrics.average_revenue_per_customer),
    ],
)
def test_model_equals_hand_written(star, metric, hand_written):
    by_model = FINANCE_REVENUE.query(star, [metric], grain="month", fact_filter=_year())
    assert rows(by_model) == rows(hand_written(star["fct_revenue"], DAY))


def test_dimension_metrics_add_up(star):
    whole = FINANCE_REVENUE.query(star, ["total_revenue"]).first()[0]
    parts = FINANCE_REVENUE.query(star, ["total_revenue"], ["segment", "product_line"])
    assert parts.agg(F.sum("total_revenue")).first()[0] == whole


def test_undeclared_names_are_refused(star):
    for bad in (
        lambda: FINANCE_REVENUE.query(star, ["gross_margin"]),
        lambda: FINANCE_REVENUE.query(star, ["total_revenue"], ["shoe_size"]),
        lambda: FINANCE_REVENUE.query(star, ["total_revenue"], grain="decade"),
    ):
        with pytest.raises(ValueError):
            bad()


def test_two_domains_do_not_multiply_each_other(spark, sf, star):
    health = {"customer_health_data": t.customer_health_data(spark, sf)}
    both = multi_domain_query(
        [(FINANCE_REVENUE, star, ["total_revenue"]), (CUSTOMER_HEALTH, health, ["health_score"])], ["customer_id"]
    )
    assert both.count() == star["dim_customer"].count()
    assert both.agg(F.sum("total_revenue")).first()[0] == FINANCE_REVENUE.query(star, ["total_revenue"]).first()[0]


def test_five_models_are_declared():
    assert len(MODELS) == 5
