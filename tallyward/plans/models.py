"""The declared models. Definitions live here and nowhere else."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .model import Dimension, Metric, Relationship, SemanticModel, TimeDimension

FINANCE_REVENUE = SemanticModel(
    name="finance_revenue",
    fact="fct_revenue",
    time=TimeDimension("recognized_date"),
    relationships=(
        Relationship("dim_customer", "customer_id", "customer_id"),
        Relationship("dim_product", "product_id", "product_id"),
    ),
    dimensions=(
        Dimension("customer_id", "customer_id"),
        Dimension("revenue_type", "revenue_type"),
        Dimension("segment", "segment", "dim_customer"),
        Dimension("region", "region", "dim_customer"),
        Dimension("industry", "industry", "dim_customer"),
        Dimension("product_line", "product_line", "dim_product"),
    ),
    metrics=(
        Metric("total_revenue", "sum", "amount_usd", description="Recognised revenue in USD"),
        Metric("recurring_revenue", "sum", "amount_usd", "is_recurring", description="Subscription and usage revenue"),
        Metric("services_revenue", "sum", "amount_usd", "revenue_type = 'professional_services'"),
        Metric("customer_count", "count_distinct", "customer_id"),
        Metric("event_count", "count", "amount_usd"),
        Metric("arpc", "ratio", numerator="total_revenue", denominator="customer_count"),
    ),
)

REVENUE_METRICS = SemanticModel(
    name="revenue_metrics_v2",
    fact="revenue_data",
    time=TimeDimension("transaction_date"),
    relationships=(Relationship("dim_customer", "customer_id", "customer_id"),),
    dimensions=(
        Dimension("region", "region", "dim_customer"),
        Dimension("customer_id", "customer_id"),
        Dimension("product_line", "product_line"),
        Dimension("transaction_date", "transaction_date"),
    ),
    metrics=(
        Metric("recognized_revenue", "sum", "recognized_revenue"),
        Metric("annual_recurring_revenue", "sum", "annual_recurring_revenue"),
        Metric("net_dollar_retention", "avg", "net_dollar_retention"),
    ),
)

PIPELINE_METRICS = SemanticModel(
    name="pipeline_metrics",
    fact="deals",
    time=TimeDimension("deal_date"),
    relationships=(Relationship("dim_customer", "customer_id", "customer_id"),),
    dimensions=(
        Dimension("deal_date", "deal_date"),
        Dimension("region", "region", "dim_customer"),
        Dimension("stage", "stage"),
        Dimension("rep_name", "rep_name"),
        Dimension("customer_id", "customer_id"),
    ),
    metrics=(
        Metric("total_bookings", "sum", "total_bookings"),
        Metric("pipeline_value", "sum", "pipeline_value"),
        Metric("deal_count", "count", "1"),
        Metric("won_deals", "count", "1", "stage = 'closed_won'"),
        Metric("win_rate", "ratio", numerator="won_deals", denominator="deal_count"),
        Metric("deal_size", "ratio", numerator="total_bookings", denominator="deal_count"),
    ),
)

CUSTOMER_HEALTH = SemanticModel(
    name="customer_health",
    fact="customer_health_data",
    time=TimeDimension("last_activity_date"),
    dimensions=(
        Dimension("customer_id", "customer_id"),
        Dimension("segment", "segment"),
        Dimension("last_activity_date", "last_activity_date"),
    ),
    metrics=(
        Metric("health_score", "avg", "health_score"),
        Metric("nps_score", "avg", "nps_score"),
        Metric("churn_risk", "avg", "churn_risk"),
        Metric("at_risk_customers", "count_distinct", "customer_id", "churn_risk > 0.7"),
        Metric("churned_customer_count", "count_distinct", "customer_id", "contract_status = 'churned'"),
    ),
)

SUPPORT_METRICS = SemanticModel(
    name="support_metrics",
    fact="support_data",
    time=TimeDimension("created_date"),
    dimensions=(
        Dimension("ticket_id", "ticket_id"),
        Dimension("created_date", "created_date"),
        Dimension("customer_id", "customer_id"),
        Dimension("category", "category"),
        Dimension("priority", "priority"),
    ),
    metrics=(
        Metric("resolution_time_hours", "avg", "resolution_time_hours"),
        Metric("csat_score", "avg", "csat_score"),
        Metric("ticket_count", "count", "ticket_id"),
    ),
)

MODELS = {m.name: m for m in (FINANCE_REVENUE, REVENUE_METRICS, PIPELINE_METRICS, CUSTOMER_HEALTH, SUPPORT_METRICS)}


def declared_metrics(spark: SparkSession) -> DataFrame:
    """(model, metric) for every metric that a model declares."""
    return spark.createDataFrame([(m.name, x.name) for m in MODELS.values() for x in m.metrics], "model string, metric string")
