"""Revenue, retention and customer metrics over the revenue star.

Facts are aggregated by their join key before they meet a dimension. A customer that owns a
third of all rows is then one row at the join, and the dimension is broadcast or shuffled by
Spark's own size check.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import measures as M


def profile_fact_grain(rev: DataFrame, approx: bool = False) -> DataFrame:
    """Rows, distinct customers, products and months, and the date range of the fact table.

    One aggregate: each task reduces its rows to its own distinct values before anything is shuffled.
    ``approx`` counts customers and products with a sketch of fixed size instead.
    """
    distinct = F.approx_count_distinct if approx else F.count_distinct
    return rev.agg(
        F.count(F.lit(1)).alias("total_rows"),
        distinct("customer_id").alias("distinct_customers"),
        distinct("product_id").alias("distinct_products"),
        F.min("recognized_date").alias("earliest_date"),
        F.max("recognized_date").alias("latest_date"),
        F.count_distinct(F.trunc("recognized_date", "month")).alias("months_of_data"),
    )


def _trailing(rev: DataFrame, as_of: date, months: int) -> DataFrame:
    return rev.filter(F.col("recognized_date") >= D.lit_date(D.shift_months(as_of, -months)))


def _in_month(start: date, end: date) -> Column:
    return (F.col("recognized_date") >= D.lit_date(start)) & (F.col("recognized_date") < D.lit_date(end))


def total_revenue(rev: DataFrame, as_of: date, grain: str = "month", fiscal: bool = False) -> DataFrame:
    period = D.trunc_date(F.col("recognized_date"), grain, fiscal).alias(f"period_{grain}")
    return _trailing(rev, as_of, 12).groupBy(period).agg(F.sum("amount_usd").alias("total_revenue"))


def recurring_revenue(rev: DataFrame, as_of: date) -> DataFrame:
    return _monthly(rev, as_of, M.sum_when(F.col("is_recurring"), F.col("amount_usd")).alias("recurring_revenue"))


def services_revenue(rev: DataFrame, as_of: date) -> DataFrame:
    services = F.col("revenue_type") == "professional_services"
    return _monthly(rev, as_of, M.sum_when(services, F.col("amount_usd")).alias("services_revenue"))


def customer_count(rev: DataFrame, as_of: date) -> DataFrame:
    return _monthly(rev, as_of, F.count_distinct("customer_id").alias("customer_count"))


def average_revenue_per_customer(rev: DataFrame, as_of: date) -> DataFrame:
    month = F.trunc("recognized_date", "month").alias("period_month")
    by_customer = _trailing(rev, as_of, 12).groupBy(month, "customer_id").agg(F.sum("amount_usd").alias("amount"))
    return by_customer.groupBy("period_month").agg(
        M.mean(F.sum("amount"), F.count("customer_id")).alias("arpc")
    )


def _monthly(rev: DataFrame, as_of: date, measure: Column) -> DataFrame:
    return _trailing(rev, as_of, 12).groupBy(F.trunc("recognized_date", "month").alias("period_month")).agg(measure)


def mrr(rev: DataFrame, as_of: date, name: str = "mrr", factor: int = 1) -> DataFrame:
    """Recurring revenue of the last complete month. The month is a scan filter; without any
    matching row the result is 0, as for the unfiltered conditional sum."""
    start, end = D.last_complete_month(as_of)
    month = rev.filter(_in_month(start, end) & F.col("is_recurring"))
    return month.agg((F.coalesce(F.sum("amount_usd"), F.lit(0)) * factor).alias(name))


def arr(rev: DataFrame, as_of: date) -> DataFrame:
    return mrr(rev, as_of, "arr", 12)


# ---------------------------------------------------------------- active customers


def _active(cust: DataFrame, condition: Column, name: str) -> DataFrame:
    """Distinct customers under a condition; the filter prunes rows before the distinct count."""
    return cust.filter(condition).agg(F.count_distinct("customer_id").alias(name))


def _logged_in(as_of: date, days: int) -> Column:
    return F.datediff(D.lit_date(as_of), F.col("last_login_date")) <= days


def active_customers_canonical(cust: DataFrame, as_of: date, login_days: int = 30) -> DataFrame:
    condition = (
        _logged_in(as_of, login_days) & (F.col("contract_status") == "active") & (F.col("account_type") != "internal")
    )
    return _active(cust, condition, "active_customers_canonical")


def active_customers_product(cust: DataFrame, as_of: date) -> DataFrame:
    return _active(cust, _logged_in(as_of, 30), "active_customers_product")


def active_customers_glossary(cust: DataFrame, as_of: date) -> DataFrame:
    """The business glossary's wording: a login in 90 days and an active contract."""
    condition = _logged_in(as_of, 90) & (F.col("contract_status") == "active")
    return _active(cust, condition, "active_customers_glossary")


def active_customers_finance(rev: DataFrame, as_of: date, fiscal: bool = False) -> DataFrame:
    since = D.lit_date(D.quarter_start(as_of, fiscal))
    return _active(rev, F.col("recognized_date") >= since, "active_customers_finance")


def active_customers_sales(cust: DataFrame) -> DataFrame:
    return _active(cust, F.col("contract_status") == "active", "active_customers_sales")


def active_customers_cs(cust: DataFrame, as_of: date) -> DataFrame:
    engaged = F.datediff(D.lit_date(as_of), F.col("last_engagement_date")) < 60
    return _active(cust, (F.col("health_score") > 40) & engaged, "active_customers_cs")


# ---------------------------------------------------------------- growth, cohorts, tiers


def qoq_growth(rev: DataFrame, as_of: date, fiscal: bool = False) -> DataFrame:
    """Quarterly revenue, the prior quarter and growth in percent, over eight quarters. The window
    runs over at most nine aggregated rows."""
    since = D.shift_months(as_of, -24)
    quarters = (
        rev.filter(F.col("recognized_date") >= D.lit_date(since))
        .groupBy(D.trunc_date(F.col("recognized_date"), "quarter", fiscal).alias("fiscal_quarter"))
        .agg(F.sum("amount_usd").alias("quarterly_revenue"))
        .withColumn("prior_quarter_revenue", F.lag("quarterly_revenue").over(Window.orderBy("fiscal_quarter")))
    )
    prior = F.col("prior_quarter_revenue")
    change = (F.col("quarterly_revenue") - prior).cast("decimal(24,4)") * 100
    growth = change / F.nullif(prior.cast("decimal(24,4)"), F.lit(0).cast("decimal(24,4)"))
    return quarters.withColumn("qoq_growth_pct", F.round(growth, 2))


def nrr_by_segment(rev: DataFrame, cust: DataFrame, as_of: date) -> DataFrame:
    """Net revenue retention: what last year's recurring customers pay now, by segment.

    Only the two months that matter are read; the fact table shrinks to one row per customer
    before it joins the dimension.
    """
    now_start, now_end = D.last_complete_month(as_of)
    then_start, then_end = (D.shift_months(d, -12) for d in (now_start, now_end))
    then, now = _in_month(then_start, then_end), _in_month(now_start, now_end)
    cohort = (
        rev.filter(F.col("is_recurring") & (then | now))
        .groupBy("customer_id")
        .agg(
            M.sum_when(then, F.col("amount_usd")).alias("revenue_12_months_ago"),
            M.sum_when(now, F.col("amount_usd")).alias("revenue_current_month"),
        )
        .filter("revenue_12_months_ago > 0")
    )
    by_segment = (
        cohort.join(cust.select("customer_id", "segment"), "customer_id")
        .groupBy("segment")
        .agg(
            F.sum("revenue_current_month").alias("current_revenue_from_cohort"),
            F.sum("revenue_12_months_ago").alias("original_cohort_revenue"),
        )
    )
    share = F.col("current_revenue_from_cohort").cast("decimal(24,4)") * 100 / F.nullif(
        F.col("original_cohort_revenue").cast("decimal(24,4)"), F.lit(0).cast("decimal(24,4)")
    )
    return by_segment.withColumn("nrr_pct", F.round(share, 1))


# --- Fixed values: health tiers by upper bound of the score; the rest is Thriving
_HEALTH_STEPS = [(20, "Critical"), (40, "At Risk"), (70, "Healthy")]


def health_tier(score: Column) -> Column:
    """Tier of a health score; an unknown score has no tier."""
    return F.when(score.isNotNull(), M.under(score, _HEALTH_STEPS, "Thriving"))


def health_tier_distribution(cust: DataFrame) -> DataFrame:
    """Active customers by tier and their share. The share's window sees one row per tier."""
    tiers = (
        cust.filter(F.col("contract_status") == "active")
        .groupBy(health_tier(F.col("health_score")).alias("health_tier"))
        .agg(F.count_distinct("customer_id").alias("customer_count"))
    )
    whole = F.sum("customer_count").over(Window.partitionBy())
    return tiers.withColumn("pct_of_total", M.pct(F.col("customer_count"), whole))


def _customer_revenue(rev: DataFrame, as_of: date) -> DataFrame:
    """Per customer: recurring revenue of the last complete month and the number of fact rows."""
    recurring = F.col("is_recurring") & _in_month(*D.last_complete_month(as_of))
    return rev.groupBy("customer_id").agg(
        M.sum_when(recurring, F.col("amount_usd")).alias("mrr"), F.count(F.lit(1)).alias("fact_rows")
    )


def arr_by_health_tier(rev: DataFrame, cust: DataFrame, as_of: date) -> DataFrame:
    """Customers and ARR by tier. Here an unknown score counts as Thriving, as the metric is defined;
    customers are counted over their whole history, so no month filter is possible."""
    active = cust.filter(F.col("contract_status") == "active").select("customer_id", "health_score")
    tier = M.under(F.col("health_score"), _HEALTH_STEPS, "Thriving").alias("health_tier")
    return (
        _customer_revenue(rev, as_of)
        .join(active, "customer_id")
        .groupBy(tier)
        .agg(F.count("customer_id").alias("customer_count"), (F.sum("mrr") * 12).alias("arr_by_health_tier"))
    )


def arr_at_risk(rev: DataFrame, cust: DataFrame, usage: DataFrame, as_of: date) -> DataFrame:
    """ARR, customers and average usage trend of the active customers below health 40.

    The average weighs every fact row, so customer totals carry their row count. Usage must hold
    one row per customer and month: a second one would double the money, and fails the job.
    """
    previous = D.lit_date(D.last_complete_month(as_of)[0])
    trend = (
        usage.filter(F.col("usage_month") == previous)
        .groupBy("customer_id")
        .agg(F.count(F.lit(1)).alias("n"), F.first("usage_trend_pct").alias("usage_trend_pct"))
        .withColumn(
            "usage_trend_pct",
            F.when(F.col("n") == 1, F.col("usage_trend_pct")).otherwise(
                F.raise_error(F.lit("more than one usage row for a customer and month")).cast("bigint")
            ),
        )
        .drop("n")
    )
    weak = cust.filter((F.col("contract_status") == "active") & (F.col("health_score") < 40)).select(
        "customer_id", "health_score"
    )
    tier = M.under(F.col("health_score"), [(20, "1-Critical"), (40, "2-At Risk")], "3-Healthy").alias("health_tier")
    known = F.col("usage_trend_pct").isNotNull()
    return (
        _customer_revenue(rev, as_of)
        .join(weak, "customer_id")
        .join(trend, "customer_id", "left")
        .groupBy(tier)
        .agg(
            F.count("customer_id").alias("customer_count"),
            (F.sum("mrr") * 12).alias("arr_at_risk"),
            M.mean(F.sum(F.col("usage_trend_pct") * F.col("fact_rows")), F.sum(F.when(known, F.col("fact_rows"))), 1).alias(
                "avg_usage_trend_pct"
            ),
        )
    )


def revenue_vs_churn(rev: DataFrame, churn: DataFrame, as_of: date) -> DataFrame:
    since = D.lit_date(D.shift_months(as_of, -12))
    revenue = (
        rev.filter(F.col("recognized_date") >= since)
        .groupBy(F.trunc("recognized_date", "month").alias("metric_month"))
        .agg(
            F.sum("amount_usd").alias("total_revenue"),
            (M.sum_when(F.col("is_recurring"), F.col("amount_usd")) * 12).alias("arr_run_rate"),
        )
    )
    churned = churn.filter(F.col("churn_month") >= since).select(
        F.col("churn_month").alias("metric_month"),
        "churned_customer_count",
        M.pct(F.col("churned_customer_count"), F.col("active_customers_start_of_month"), 2).alias("churn_rate_pct"),
    )
    return revenue.join(churned, "metric_month", "left")


def daily_revenue_metrics(rev: DataFrame, cust: DataFrame, as_of: date, months: int = 24) -> DataFrame:
    """Month x segment x region: revenue, recurring revenue and paying customers.

    Facts are first reduced to one row per month and customer; the dimension's key is unique, so
    counting those rows is the distinct customer count.
    """
    since = D.lit_date(D.shift_months(as_of, -months))
    return revenue_cells(rev.filter(F.col("recognized_date") >= since), cust)


def revenue_cells(rev: DataFrame, cust: DataFrame) -> DataFrame:
    by_customer = rev.groupBy(F.trunc("recognized_date", "month").alias("metric_month"), "customer_id").agg(
        F.sum("amount_usd").alias("amount"),
        M.sum_when(F.col("is_recurring"), F.col("amount_usd")).alias("recurring"),
    )
    return (
        by_customer.join(cust.select("customer_id", "segment", "region"), "customer_id")
        .groupBy("metric_month", "segment", "region")
        .agg(
            F.sum("amount").alias("total_revenue"),
            F.sum("recurring").alias("recurring_revenue"),
            F.count("customer_id").alias("customer_count"),
        )
    )


# ---------------------------------------------------------------- migrated and derived metrics


def bot_filtered_users(activity: DataFrame, type_column: str = "activity_type", bot: str = "bot") -> DataFrame:
    return activity.filter(F.col(type_column) != bot).agg(F.count_distinct("user_id").alias("users"))


def net_recognized_revenue(rev: DataFrame) -> DataFrame:
    """Recognised recurring revenue minus refund credits, in one pass."""
    earned = F.col("revenue_type").isin("subscription", "usage") & (F.col("recognition_status") == "recognized")
    return rev.agg(
        (
            M.sum_when(earned, F.col("amount_usd"))
            - M.sum_when(F.col("credit_type") == "refund", F.col("credit_amount_usd"))
        ).alias("net_recognized_revenue")
    )


def derive_segment(rev: DataFrame, as_of: date) -> DataFrame:
    """Customer segment by ARR: Enterprise from 100,000, Mid-Market from 25,000, else SMB."""
    value = F.col("mrr") * 12
    return _customer_revenue(rev, as_of).select(
        "customer_id",
        value.alias("arr"),
        M.bands(value, [(100000, "Enterprise"), (25000, "Mid-Market")], "SMB").alias("segment"),
    )


def derive_is_recurring(rev: DataFrame) -> DataFrame:
    return rev.withColumn("is_recurring", F.col("revenue_type").isin("subscription", "usage"))


def weighted_health_score(components: DataFrame) -> DataFrame:
    """Composite health: usage 30 %, support 20 %, NPS 20 %, contract timeline 30 %."""
    weights = {"usage_score": 30, "support_score": 20, "nps_score": 20, "contract_score": 30}
    total = sum((F.col(name) * weight for name, weight in weights.items()), F.lit(0))
    return components.withColumn("weighted_health_score", total / 100)


def materiality_round(df: DataFrame, column: str, out: str = "rounded") -> DataFrame:
    """Nearest 100,000 above 10 million, nearest 10,000 from 1 million, exact below."""
    value = F.col(column)
    return df.withColumn(
        out,
        F.when(F.abs(value) > 10_000_000, F.round(value, -5))
        .when(F.abs(value) >= 1_000_000, F.round(value, -4))
        .otherwise(value),
    )


def material_changes(series: DataFrame, keys: list[str], period: str, value: str) -> DataFrame:
    """Period-over-period changes above 5 % or above 1 million."""
    previous = F.lag(value).over(Window.partitionBy(*keys).orderBy(period))
    change = F.col(value) - F.col("previous_value")
    return (
        series.withColumn("previous_value", previous)
        .withColumn("change", change)
        .filter(
            (F.abs(F.col("change")) > 1_000_000)
            | (F.abs(F.col("change")) * 100 > F.abs(F.col("previous_value")) * 5)
        )
    )
