"""Queries through the declared semantic models."""

from pyspark.sql import functions as F

from tallyward.plans.model import multi_domain_query, pass_through
from tallyward.plans.models import (
    PIPELINE_METRICS,
    CUSTOMER_HEALTH,
    FINANCE_REVENUE,
    REVENUE_METRICS,
    SUPPORT_METRICS,
)
from tallyward.sources import testdata as t

from .common import oracle, query


def _star(s, d, customer=True):
    return {
        "fct_revenue": t.fct_revenue(s, d, customer=customer),
        "dim_customer": t.dim_customer(s, d),
        "dim_product": t.dim_product(s, d),
    }


QUERIES = {
    "model_finance_revenue": query(
        lambda s, d: FINANCE_REVENUE.query(
            _star(s, d), ["total_revenue", "recurring_revenue", "customer_count", "arpc"], ["segment", "region"], "quarter", True
        )
    ),
    "model_finance_revenue_product": query(
        lambda s, d: FINANCE_REVENUE.query(
            _star(s, d, customer=False),
            ["total_revenue", "services_revenue", "event_count"],
            ["product_line", "revenue_type"],
            "month",
            fact_filter=F.col("recognized_date") >= F.lit("2000-01-01").cast("date"),
            dimension_filter=F.col("product_line") != "PROMO",
        )
    ),
    "model_finance_revenue_total": query(
        lambda s, d: FINANCE_REVENUE.query(_star(s, d), ["total_revenue", "customer_count"])
    ),
    "model_revenue_metrics_v2": query(
        lambda s, d: REVENUE_METRICS.query(
            {"revenue_data": t.revenue_data(s, d), "dim_customer": t.dim_customer(s, d)},
            ["recognized_revenue", "annual_recurring_revenue", "net_dollar_retention"],
            ["product_line", "region"],
            "year",
        )
    ),
    "model_pipeline_metrics": query(
        lambda s, d: PIPELINE_METRICS.query(
            {"deals": t.customer_orders(s, d), "dim_customer": t.dim_customer(s, d)},
            ["total_bookings", "pipeline_value", "win_rate", "deal_size"],
            ["rep_name", "region"],
            "quarter",
        )
    ),
    "model_customer_health": query(
        lambda s, d: CUSTOMER_HEALTH.query(
            {"customer_health_data": t.customer_health_data(s, d)},
            ["health_score", "nps_score", "churn_risk", "at_risk_customers", "churned_customer_count"],
            ["segment"],
            "month",
        )
    ),
    "model_support_metrics": query(
        lambda s, d: SUPPORT_METRICS.query(
            {"support_data": t.support_data(s, d)},
            ["resolution_time_hours", "csat_score", "ticket_count"],
            ["priority", "category"],
            "week",
        )
    ),
    "finance_revenue_view": query(
        lambda s, d: pass_through(
            t.fct_revenue(s, d),
            ["contract_id", "customer_id", "product_id", "recognized_date", "amount_usd", "revenue_type", "is_recurring"],
        )
    ),
    "finance_costs_view": query(lambda s, d: pass_through(t.fct_costs(s, d))),
    "multi_domain_query": query(
        lambda s, d: multi_domain_query(
            [
                (FINANCE_REVENUE, _star(s, d), ["total_revenue", "event_count"]),
                (CUSTOMER_HEALTH, {"customer_health_data": t.customer_health_data(s, d)}, ["health_score", "churn_risk"]),
                (PIPELINE_METRICS, {"deals": t.customer_orders(s, d)}, ["total_bookings", "deal_count"]),
            ],
            ["customer_id"],
        )
    ),
}

_FISCAL = "CAST(date_trunc('quarter', {c} - INTERVAL 1 MONTH) + INTERVAL 1 MONTH AS DATE)"

ORACLE = {
    "model_finance_revenue": f"""
SELECT segment, region, {_FISCAL.format(c="recognized_date")} AS period_quarter,
       CAST(sum(amount_usd) AS DOUBLE) AS total_revenue,
       CAST(coalesce(sum(amount_usd) FILTER (WHERE is_recurring), 0) AS DOUBLE) AS recurring_revenue,
       count(DISTINCT r.customer_id) AS customer_count,
       CAST(sum(amount_usd) AS DOUBLE) / count(DISTINCT r.customer_id) AS arpc
FROM fct_revenue r JOIN dim_customer c ON r.customer_id = c.customer_id GROUP BY 1, 2, 3""",
    "model_finance_revenue_product": """
SELECT product_line, revenue_type, CAST(date_trunc('month', recognized_date) AS DATE) AS period_month,
       CAST(sum(amount_usd) AS DOUBLE) AS total_revenue,
       CAST(coalesce(sum(amount_usd) FILTER (WHERE revenue_type = 'professional_services'), 0) AS DOUBLE) AS services_revenue,
       count(amount_usd) AS event_count
FROM fct_revenue r JOIN dim_product p ON r.product_id = p.product_id
WHERE recognized_date >= DATE '2000-01-01' AND product_line <> 'PROMO' GROUP BY 1, 2, 3""",
    "model_finance_revenue_total": """
SELECT CAST(sum(amount_usd) AS DOUBLE) AS total_revenue, count(DISTINCT customer_id) AS customer_count FROM fct_revenue""",
    "model_revenue_metrics_v2": """
SELECT product_line, region, CAST(date_trunc('year', transaction_date) AS DATE) AS period_year,
       CAST(sum(recognized_revenue) AS DOUBLE) AS recognized_revenue,
       CAST(sum(annual_recurring_revenue) AS DOUBLE) AS annual_recurring_revenue,
       CAST(sum(net_dollar_retention) AS DOUBLE) / count(net_dollar_retention) AS net_dollar_retention
FROM revenue_data r LEFT JOIN dim_customer c ON r.customer_id = c.customer_id GROUP BY 1, 2, 3""",
    "model_pipeline_metrics": """
SELECT rep_name, region, CAST(date_trunc('quarter', deal_date) AS DATE) AS period_quarter,
       CAST(sum(total_bookings) AS DOUBLE) AS total_bookings, CAST(sum(pipeline_value) AS DOUBLE) AS pipeline_value,
       CAST(count(*) FILTER (WHERE stage = 'closed_won') AS DOUBLE) / count(*) AS win_rate,
       CAST(sum(total_bookings) AS DOUBLE) / count(*) AS deal_size
FROM customer_orders o LEFT JOIN dim_customer c ON o.customer_id = c.customer_id GROUP BY 1, 2, 3""",
    "model_customer_health": """
SELECT segment, CAST(date_trunc('month', last_activity_date) AS DATE) AS period_month,
       CAST(sum(health_score) AS DOUBLE) / count(health_score) AS health_score,
       CAST(sum(nps_score) AS DOUBLE) / count(nps_score) AS nps_score,
       CAST(sum(churn_risk) AS DOUBLE) / count(churn_risk) AS churn_risk,
       count(DISTINCT customer_id) FILTER (WHERE churn_risk > 0.7) AS at_risk_customers,
       count(DISTINCT customer_id) FILTER (WHERE contract_status = 'churned') AS churned_customer_count
FROM customer_health_data GROUP BY 1, 2""",
    "model_support_metrics": """
SELECT priority, category, CAST(date_trunc('week', created_date) AS DATE) AS period_week,
       CAST(sum(resolution_time_hours) AS DOUBLE) / count(*) AS resolution_time_hours,
       CAST(sum(csat_score) AS DOUBLE) / count(*) AS csat_score, count(ticket_id) AS ticket_count
FROM support_data GROUP BY 1, 2, 3""",
    "finance_revenue_view": """
SELECT contract_id, customer_id, product_id, recognized_date, CAST(amount_usd AS DOUBLE) AS amount_usd, revenue_type, is_recurring
FROM fct_revenue""",
    "finance_costs_view": "SELECT cost_date, cost_category, CAST(amount_usd AS DOUBLE) AS amount_usd FROM fct_costs",
    "multi_domain_query": """
WITH r AS (SELECT customer_id, sum(amount_usd) AS total_revenue, count(*) AS event_count FROM fct_revenue GROUP BY 1),
     b AS (SELECT customer_id, sum(total_bookings) AS total_bookings, count(*) AS deal_count FROM customer_orders GROUP BY 1),
     h AS (SELECT customer_id, CAST(sum(health_score) AS DOUBLE) / count(health_score) AS health_score,
                  CAST(sum(churn_risk) AS DOUBLE) / count(churn_risk) AS churn_risk FROM customer_health_data GROUP BY 1)
SELECT customer_id, CAST(total_revenue AS DOUBLE) AS total_revenue, event_count, health_score, churn_risk,
       CAST(total_bookings AS DOUBLE) AS total_bookings, deal_count
FROM r FULL OUTER JOIN h USING (customer_id) FULL OUTER JOIN b USING (customer_id)""",
}
ORACLE = {name: oracle(sql) for name, sql in ORACLE.items()}
