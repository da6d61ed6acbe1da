"""Business tables derived from the driver's Parquet tables.

Each function takes ``(spark, folder)`` and returns one table in the shape the operators
expect. Whole tables are projected and joined. Dimensions with holes and views of one kind of row say so in their
docstrings; facts, dimensions and catalogs keep every row. Integer and
decimal arithmetic keeps every value reproducible by another engine. Columns that a query
does not touch are pruned from the scan.
"""

from __future__ import annotations

from datetime import date, datetime
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The fixtures' "today": finance and governance rows end in 2001, events in January 2024.
FINANCE_DAY = date(2001, 7, 15)
FINANCE_TIME = datetime(2001, 7, 15)
FINANCE_MONDAY = datetime(2001, 7, 16)
EVENT_TIME = datetime(2024, 1, 31)

_DAY = f"DATE'{FINANCE_DAY}'"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# ---------------------------------------------------------------- revenue star


def fct_revenue(spark: SparkSession, folder: str, customer: bool = True) -> DataFrame:
    """One row per recognised line. The order (unique by key) only supplies the customer, so
    queries that never look at the customer skip that join and its shuffle altogether."""
    lines = table(spark, folder, "lineitem").selectExpr(
        "l_orderkey AS contract_id",
        "concat('P', l_partkey) AS product_id",
        "CAST(l_shipdate AS DATE) AS recognized_date",
        "CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS amount_usd",
        """CASE l_linenumber % 4 WHEN 0 THEN 'subscription' WHEN 1 THEN 'usage'
             WHEN 2 THEN 'professional_services' ELSE 'one_time' END AS revenue_type""",
        "l_linenumber % 4 IN (0, 1) AS is_recurring",
        "CASE l_linestatus WHEN 'F' THEN 'recognized' ELSE 'deferred' END AS recognition_status",
        "CASE l_returnflag WHEN 'R' THEN 'refund' WHEN 'A' THEN 'adjustment' ELSE 'none' END AS credit_type",
        "CAST(l_tax AS DECIMAL(4,2)) * CAST(l_extendedprice AS DECIMAL(12,2)) AS credit_amount_usd",
    )
    return with_customer(spark, folder, lines) if customer else lines


def with_customer(spark: SparkSession, folder: str, lines: DataFrame) -> DataFrame:
    """Lines with the customer of their order."""
    buyers = table(spark, folder, "orders").selectExpr(
        "o_orderkey AS contract_id", "concat('C', o_custkey) AS customer_id"
    )
    return lines.join(buyers, "contract_id", "left")


def dim_customer(spark: SparkSession, folder: str) -> DataFrame:
    nations = table(spark, folder, "nation").join(
        table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    ).select("n_nationkey", "r_name")
    return (
        table(spark, folder, "customer")
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .selectExpr(
            "concat('C', c_custkey) AS customer_id",
            "c_name AS customer_name",
            "CASE c_custkey % 3 WHEN 0 THEN 'Enterprise' WHEN 1 THEN 'Mid-Market' ELSE 'SMB' END AS segment",
            "r_name AS region",
            "c_mktsegment AS industry",
            "CASE WHEN c_custkey % 50 <> 1 THEN (c_custkey * 37) % 101 END AS health_score",
            "CASE WHEN c_custkey % 10 = 0 THEN 'churned' ELSE 'active' END AS contract_status",
            "CASE WHEN c_custkey % 17 = 0 THEN 'internal' ELSE 'customer' END AS account_type",
            f"date_sub({_DAY}, CAST(c_custkey % 120 AS INT)) AS last_login_date",
            f"date_sub({_DAY}, CAST(c_custkey % 90 AS INT)) AS last_engagement_date",
            "c_acctbal AS account_balance",
        )
    )


def dim_customer_holes(spark: SparkSession, folder: str) -> DataFrame:
    """The customer dimension without overdrawn accounts: a dimension that misses rows."""
    return dim_customer(spark, folder).filter("account_balance >= 0")


def dim_product(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").selectExpr(
        "concat('P', p_partkey) AS product_id", "p_name AS product_name", "p_type AS product_line"
    )


def fct_product_usage(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").selectExpr(
        "concat('C', c_custkey) AS customer_id",
        "DATE'2001-06-01' AS usage_month",
        "c_custkey % 41 - 20 AS usage_trend_pct",
    )


def agg_monthly_churn(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "orders")
        .groupBy(F.trunc(F.col("o_orderdate").cast("date"), "month").alias("churn_month"))
        .agg(
            F.count_distinct(F.when(F.col("o_orderstatus") == "P", F.col("o_custkey"))).alias("churned_customer_count"),
            F.count_distinct("o_custkey").alias("active_customers_start_of_month"),
        )
    )


def fct_costs(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").join(
        table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"), "left"
    ).selectExpr(
        "CAST(l_shipdate AS DATE) AS cost_date",
        "p_type AS cost_category",
        "CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)) AS amount_usd",
    )


def monthly_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Finance's own ARR by month: agrees in even months, is 5 dollars off in odd ones."""
    return (
        fct_revenue(spark, folder, customer=False)
        .groupBy(F.trunc("recognized_date", "month").alias("metric_month"))
        .agg(F.sum(F.expr("CASE WHEN is_recurring THEN amount_usd ELSE 0 END")).alias("recurring"))
        .selectExpr("metric_month", "recurring * 12 + 5 * (month(metric_month) % 2) AS arr_reported")
    )


def metric_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """Two certified snapshots of monthly revenue; the newer one is 1.00 off in March 2001."""
    months = (
        fct_revenue(spark, folder, customer=False)
        .groupBy(F.trunc("recognized_date", "month").alias("month"))
        .agg(
            F.sum("amount_usd").alias("total"),
            F.sum(F.expr("CASE WHEN is_recurring THEN amount_usd ELSE 0 END")).alias("recurring"),
        )
    )
    return months.selectExpr(
        "'finance_revenue' AS semantic_view",
        "month",
        """inline(array(
             struct(DATE'2001-06-15' AS snapshot_date, total + 7 AS total_revenue, recurring + 7 AS recurring_revenue),
             struct(DATE'2001-07-14' AS snapshot_date,
                    total + CASE WHEN month = DATE'2001-03-01' THEN 1 ELSE 0 END AS total_revenue,
                    recurring + 0 AS recurring_revenue)))""",
    )


def semantic_view_consumers(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").selectExpr(
        "CASE c_custkey % 3 WHEN 0 THEN 'dashboard' WHEN 1 THEN 'agent' ELSE 'application' END AS consumer_type",
        "c_name AS consumer_name",
        "CASE WHEN c_custkey % 2 = 0 THEN 'finance_revenue' ELSE 'finance_costs' END AS semantic_view_name",
        "CASE WHEN c_custkey % 5 < 3 THEN 'gross_revenue' ELSE 'total_revenue' END AS metric_name",
        f"date_sub({_DAY}, CAST(c_custkey % 180 AS INT)) AS last_query_date",
        "(c_custkey * 7) % 500 AS query_count_30d",
    )


def customer_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Deals in the shape of the bookings model: one row per order."""
    return table(spark, folder, "orders").selectExpr(
        "CAST(o_orderdate AS DATE) AS deal_date",
        "CASE o_orderstatus WHEN 'F' THEN 'closed_won' WHEN 'P' THEN 'closed_lost' ELSE 'open' END AS stage",
        "concat('rep_', o_custkey % 23) AS rep_name",
        "concat('C', o_custkey) AS customer_id",
        "CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(18,2)) ELSE 0 END AS total_bookings",
        "CASE WHEN o_orderstatus = 'O' THEN CAST(o_totalprice AS DECIMAL(18,2)) ELSE 0 END AS pipeline_value",
    )


def revenue_data(spark: SparkSession, folder: str) -> DataFrame:
    return fct_revenue(spark, folder).join(dim_product(spark, folder), "product_id", "left").selectExpr(
        "recognized_date AS transaction_date",
        "amount_usd AS recognized_revenue",
        "CASE WHEN is_recurring THEN amount_usd * 12 ELSE 0 END AS annual_recurring_revenue",
        "CAST(0.8 + contract_id % 50 * 0.01 AS DECIMAL(10,4)) AS net_dollar_retention",
        "customer_id",
        "product_line",
    )


def customer_health_data(spark: SparkSession, folder: str) -> DataFrame:
    return dim_customer(spark, folder).selectExpr(
        "customer_id",
        "CAST(health_score AS DECIMAL(5,2)) AS health_score",
        "CAST(substr(customer_id, 2) AS BIGINT) % 11 AS nps_score",
        "CAST((CAST(substr(customer_id, 2) AS BIGINT) * 7) % 100 * 0.01 AS DECIMAL(5,4)) AS churn_risk",
        "segment",
        "last_engagement_date AS last_activity_date",
        "contract_status",
    )


def support_data(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").selectExpr(
        "concat('T', o_orderkey) AS ticket_id",
        "CAST(o_orderdate AS DATE) AS created_date",
        "CAST(o_orderkey % 96 AS DECIMAL(10,2)) AS resolution_time_hours",
        "CAST(1 + o_orderkey % 5 AS DECIMAL(3,1)) AS csat_score",
        "o_orderstatus AS category",
        "o_orderpriority AS priority",
        "concat('C', o_custkey) AS customer_id",
    )


# ---------------------------------------------------------------- certification


def metric_certifications(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").selectExpr(
        "concat('metric_', p_partkey) AS metric_name",
        "concat('view_', p_partkey % 50) AS semantic_view",
        "replace(p_brand, '#', ' ') AS domain",
        "concat('steward_', p_partkey % 9) AS certified_by",
        f"date_sub({_DAY}, CAST(p_partkey % 90 AS INT)) AS certification_date",
        f"date_add({_DAY}, p_size - 25) AS next_review_date",
        """CASE p_partkey % 4 WHEN 2 THEN 'draft' WHEN 3 THEN 'deprecated' ELSE 'certified' END AS status""",
    )


def certification_audit(spark: SparkSession, folder: str) -> DataFrame:
    return metric_certifications(spark, folder).selectExpr(
        "metric_name",
        "semantic_view",
        "'certified' AS action",
        "certified_by AS performed_by",
        "CAST(certification_date AS TIMESTAMP_NTZ) AS action_date",
        "'initial review' AS reason",
    )


def certification_events(spark: SparkSession, folder: str) -> DataFrame:
    return metric_certifications(spark, folder).selectExpr(
        "metric_name",
        "semantic_view",
        "CASE status WHEN 'deprecated' THEN 'deprecated' ELSE 'reviewed' END AS action",
        "concat('reviewer_', length(domain)) AS performed_by",
        # Reviews of drafts were noted with their own time, the others get the time of recording.
        "CASE WHEN status = 'draft' THEN TIMESTAMP_NTZ'2001-01-01 00:00:00' END AS action_date",
        "concat('status is ', status) AS reason",
    )


# ---------------------------------------------------------------- answer telemetry


def answer_log(spark: SparkSession, folder: str) -> DataFrame:
    """Telemetry of generated answers, one row per event."""
    return table(spark, folder, "events").selectExpr(
        "event_id AS interaction_id",
        "ts AS timestamp",
        """CASE user_id % 4 WHEN 0 THEN 'finance_agent' WHEN 1 THEN 'sales_agent'
             WHEN 2 THEN 'cs_agent' ELSE 'executive_agent' END AS agent_name""",
        "concat('U', user_id) AS user_id",
        "CASE user_id % 3 WHEN 0 THEN 'ANALYST' WHEN 1 THEN 'MANAGER' ELSE 'AGENT_USER' END AS user_role",
        "concat('view_', event_type) AS resolved_semantic_view",
        "event_type AS resolved_metric",
        "CAST((40 + (event_id * 13) % 61) * 0.01 AS DECIMAL(4,2)) AS confidence_score",
        "event_id % 900 AS response_time_ms",
        "event_type <> 'error' AS grounded",
        "value < 1 AS escalated",
    )


def governance_log(spark: SparkSession, folder: str) -> DataFrame:
    """Full audit trail of answers, one row per event."""
    return table(spark, folder, "events").selectExpr(
        "event_id AS audit_id",
        "concat('U', user_id) AS user_id",
        "CASE user_id % 3 WHEN 0 THEN 'ANALYST' WHEN 1 THEN 'MANAGER' ELSE 'AGENT_USER' END AS user_role",
        """CASE user_id % 4 WHEN 0 THEN 'finance_agent' WHEN 1 THEN 'sales_agent'
             WHEN 2 THEN 'cs_agent' ELSE 'executive_agent' END AS agent_name""",
        "concat('Question ', event_id % 97, '?') AS original_question",
        "CASE WHEN event_id % 53 <> 0 THEN concat('q', event_id % 97) END AS normalized_question",
        "CASE WHEN event_type = 'error' THEN CAST(array() AS ARRAY<STRING>) ELSE array(event_type) END AS metrics_used",
        "CAST((40 + (event_id * 13) % 61) * 0.01 AS DECIMAL(4,2)) AS resolution_confidence",
        "event_id % 9 = 0 AS disambiguation_applied",
        "event_id % 700 AS execution_time_ms",
        "concat('a', (event_id div 97) % (1 + (event_id % 97) % 3)) AS answer_summary",
        "event_id % 41 <> 0 AS provenance_disclosed",
        "CASE WHEN user_id % 4 = 0 THEN CAST(array() AS ARRAY<STRING>) ELSE array('region') END AS rls_policies_applied",
        "CASE WHEN user_id % 5 = 0 THEN array('email') ELSE CAST(array() AS ARRAY<STRING>) END AS masking_policies_applied",
        "value < 1 AS escalated",
        "ts AS created_at",
    )


def escalations(spark: SparkSession, folder: str) -> DataFrame:
    """Every escalated answer; serves both the analytics and the governance side."""
    return table(spark, folder, "events").filter("value < 1").selectExpr(
        """CASE user_id % 4 WHEN 0 THEN 'finance_agent' WHEN 1 THEN 'sales_agent'
             WHEN 2 THEN 'cs_agent' ELSE 'executive_agent' END AS agent_name""",
        "event_type AS escalation_reason",
        "concat('g', event_id % 3) AS escalation_gate",
        "concat('question ', event_id % 97) AS user_question",
        "CAST((40 + (event_id * 13) % 61) * 0.01 AS DECIMAL(4,2)) AS confidence_score",
        "event_id % 3 = 0 AS led_to_new_metric",
        "ts AS created_at",
    )


def answer_tests(spark: SparkSession, folder: str) -> DataFrame:
    """Resolution test cases, one per order."""
    return table(spark, folder, "orders").selectExpr(
        """CASE o_orderkey % 5 WHEN 0 THEN 'resolution' WHEN 1 THEN 'disambiguation' WHEN 2 THEN 'boundary'
             WHEN 3 THEN 'cross_domain' ELSE 'escalation' END AS test_category""",
        """CASE o_custkey % 4 WHEN 0 THEN 'finance_agent' WHEN 1 THEN 'sales_agent'
             WHEN 2 THEN 'cs_agent' ELSE 'executive_agent' END AS agent_name""",
        "concat('metric_', o_custkey) AS expected_metric",
        "CASE o_orderkey % 5 WHEN 2 THEN 'REFUSE' WHEN 3 THEN 'MULTI_VIEW_ANSWER' ELSE 'ANSWER' END AS expected_behavior",
        "CASE o_orderstatus WHEN 'F' THEN 'PASS' WHEN 'O' THEN 'FAIL' END AS last_result",
        "o_orderpriority <> '5-LOW' AS is_active",
    )


def questions(spark: SparkSession, folder: str) -> DataFrame:
    """One natural-language question per event."""
    return table(spark, folder, "events").selectExpr(
        "event_id AS question_id",
        """CASE user_id % 4 WHEN 0 THEN 'finance_agent' WHEN 1 THEN 'sales_agent'
             WHEN 2 THEN 'cs_agent' ELSE 'executive_agent' END AS agent_name""",
        """concat('Show me ', CASE event_id % 12 WHEN 0 THEN 'revenue' WHEN 1 THEN 'our ARR'
             WHEN 2 THEN 'the revenue run rate' WHEN 3 THEN 'subscription revenue' WHEN 4 THEN 'pipeline'
             WHEN 5 THEN 'Bookings' WHEN 6 THEN 'health score' WHEN 7 THEN 'NPS' WHEN 8 THEN 'the CFO salary'
             WHEN 9 THEN 'churn risk by region' WHEN 10 THEN 'weather' ELSE 'net retention' END,
             ' after ', event_type, ' ', user_id) AS question""",
        "CAST((40 + (event_id * 13) % 61) * 0.01 AS DECIMAL(4,2)) AS confidence",
    )


# ---------------------------------------------------------------- governance


def metric_catalog(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").selectExpr(
        "concat('M', p_partkey) AS metric_id",
        "concat(lower(replace(p_brand, '#', '_')), '.semantic.metric_', p_partkey) AS metric_fqn",
        "replace(p_brand, '#', ' ') AS domain",
        "p_type AS sub_domain",
        "concat('metric_', p_partkey) AS metric_name",
        "concat('Definition of ', p_name) AS business_definition",
        "concat('analytics.semantic.sales_v', p_partkey % 50) AS semantic_view_fqn",
        "CASE WHEN p_partkey % 2 = 0 THEN 'SUM' ELSE 'AVG' END AS aggregation_method",
        "CASE WHEN p_partkey % 3 = 0 THEN 'monthly' ELSE 'daily' END AS time_grain",
        "CASE WHEN p_partkey % 29 <> 0 THEN concat('OWNER_', p_partkey % 7) END AS owner_role",
        "concat('STEWARD_', p_partkey % 5) AS steward_role",
        """CASE p_partkey % 5 WHEN 2 THEN 'PENDING' WHEN 3 THEN 'DRAFT' WHEN 4 THEN 'EXPIRED'
             ELSE 'CERTIFIED' END AS certification_status""",
        f"date_sub({_DAY}, CAST(p_partkey % 90 AS INT)) AS certification_date",
        f"date_add({_DAY}, p_size - 25) AS recertification_due",
        f"""CASE WHEN p_partkey % 7 <> 0 THEN
             CAST(date_sub({_DAY}, CAST(p_partkey % 240 AS INT)) AS TIMESTAMP_NTZ) END AS last_queried_at""",
        "CASE WHEN p_partkey % 3 = 0 THEN 0 ELSE (p_partkey * 7) % 300 END AS query_count_30d",
        "p_partkey % 12 AS consumer_count_30d",
        "p_partkey % 4 AS agent_count_using",
        "CAST(90 + p_partkey % 11 AS DECIMAL(5,2)) AS data_quality_score",
        "1 + p_partkey % 48 AS freshness_sla_hours",
        "p_partkey % 6 = 0 AS has_verified_query",
        "CASE WHEN p_partkey % 31 = 0 THEN array('ZOMBIE_CANDIDATE') END AS tags",
        f"CAST(date_sub({_DAY}, CAST(p_partkey % 700 AS INT)) AS TIMESTAMP_NTZ) AS created_at",
        f"CAST(date_sub({_DAY}, CAST(p_partkey % 5 AS INT)) AS TIMESTAMP_NTZ) AS updated_at",
    )


def domain_registry(spark: SparkSession, folder: str) -> DataFrame:
    brands = table(spark, folder, "part").select("p_brand").distinct()
    return brands.selectExpr("p_brand", "CAST(substr(p_brand, 7) AS BIGINT) AS n").selectExpr(
        "concat('D', n) AS domain_id",
        "replace(p_brand, '#', ' ') AS domain_name",
        "concat('DOMAIN_STEWARD_', n) AS steward_role",
        "concat('steward_', n) AS steward_user",
        "n * 3 AS metric_count",
        "n % 5 AS semantic_view_count",
        "CASE WHEN n % 9 <> 5 THEN n % 4 END AS agent_count",
        "CAST((n * 37) % 101 AS DECIMAL(5,2)) AS certification_rate",
        "CASE WHEN n % 7 <> 3 THEN CAST(85 + n % 15 AS DECIMAL(5,2)) END AS avg_data_quality",
        """CASE n % 4 WHEN 0 THEN 'FOUNDATION' WHEN 1 THEN 'GROWTH' WHEN 2 THEN 'SCALE'
             ELSE 'ENTERPRISE' END AS governance_maturity""",
        f"date_sub({_DAY}, CAST(n AS INT)) AS last_governance_review",
        f"date_add({_DAY}, CAST(n - 12 AS INT)) AS next_review_due",
        "n % 6 <> 0 AS is_active",
    )


def change_log(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").selectExpr(
        "concat('CH', o_orderkey) AS change_id",
        """CASE o_orderpriority WHEN '1-URGENT' THEN 'metric' WHEN '2-HIGH' THEN 'semantic_view'
             WHEN '3-MEDIUM' THEN 'agent' ELSE 'table' END AS asset_type""",
        "concat('analytics.semantic.sales_v', o_custkey % 50) AS asset_fqn",
        "concat('U', o_custkey % 7) AS requested_by",
        """CASE WHEN o_orderkey % 23 = 0 THEN CAST(array() AS ARRAY<STRING>)
             ELSE array(concat('U', o_orderkey % 7)) END AS approved_by""",
        "o_orderdate - make_dt_interval(0, CAST(o_orderkey % 400 AS INT), 30) AS approval_timestamp",
        "o_orderdate AS deployed_at",
        "o_orderpriority = '1-URGENT' AS is_breaking_change",
        "CASE o_orderstatus WHEN 'F' THEN 'DEPLOYED' WHEN 'P' THEN 'ROLLED_BACK' ELSE 'PENDING' END AS status",
    )


def incident_log(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").selectExpr(
        "concat('I', o_orderkey) AS incident_id",
        "1 + o_orderkey % 4 AS severity",
        "array(concat('metric_', o_custkey)) AS affected_metrics",
        "o_orderdate AS detected_at",
        "CASE WHEN o_orderstatus = 'F' THEN 'RESOLVED' ELSE 'OPEN' END AS status",
        "o_custkey % 60 AS time_to_detect_minutes",
        "(o_custkey * 7) % 3000 AS time_to_mitigate_minutes",
        "CASE WHEN o_orderstatus = 'F' THEN (o_custkey * 7) % 3000 + o_orderkey % 600 END AS time_to_resolve_minutes",
    )


def metric_requests(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").selectExpr(
        "concat('R', o_orderkey) AS request_id",
        "CASE o_orderstatus WHEN 'F' THEN 'APPROVED' WHEN 'P' THEN 'REJECTED' ELSE 'SUBMITTED' END AS status",
        "CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'URGENT' ELSE 'STANDARD' END AS urgency",
        "o_orderdate AS submitted_at",
        "o_orderdate + INTERVAL '72' HOUR AS sla_deadline",
        """CASE WHEN o_orderstatus <> 'O' THEN
             o_orderdate + make_dt_interval(0, CAST(o_custkey % 120 AS INT)) END AS decision_date""",
    )


def query_history(spark: SparkSession, folder: str) -> DataFrame:
    """Queries against the views, moved back by a fixed number of days to the finance calendar."""
    return table(spark, folder, "events").selectExpr(
        "event_id AS query_id",
        "concat('U', user_id) AS user_name",
        "concat('select * from Analytics.Semantic.Sales_V', event_id % 40, ' where k = ', user_id) AS query_text",
        "ts - INTERVAL '8240' DAY AS start_time",
        "CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS execution_status",
    )


def business_glossary(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").selectExpr(
        "concat('metric_', p_partkey) AS term",
        "concat('Definition of ', p_name) AS canonical_definition",
        "concat('Default to ', p_brand) AS disambiguation_rules",
        "array(p_name, p_type) AS commonly_confused_with",
    )


def raci_matrix(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").selectExpr(
        "concat(p_name, ' ', p_partkey) AS operation_name",
        "p_type AS operation_category",
        "p_size AS sla_hours",
        "p_partkey % 3 <> 0 AS requires_approval",
    )


def gate_table(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "supplier").selectExpr(
        "concat('gate ', s_suppkey) AS gate_name",
        "CASE WHEN s_suppkey % 2 = 0 THEN 'DEV' ELSE 'STAGING' END AS from_environment",
        "CASE WHEN s_suppkey % 2 = 0 THEN 'STAGING' ELSE 'PRODUCTION' END AS to_environment",
        "CASE s_suppkey % 3 WHEN 0 THEN 'automated' WHEN 1 THEN 'manual_approval' ELSE 'sla_check' END AS gate_type",
        "CASE WHEN s_suppkey % 4 = 0 THEN 'WARN' ELSE 'BLOCK' END AS failure_action",
        "s_suppkey % 7 <> 0 AS is_active",
    )


def regulatory_controls(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").selectExpr(
        "concat('control_', p_partkey) AS governance_control",
        "CASE p_partkey % 4 WHEN 0 THEN 'SOX' WHEN 1 THEN 'GDPR' WHEN 2 THEN 'HIPAA' ELSE 'EU_AI_ACT' END AS regulation",
        """CASE p_size % 4 WHEN 0 THEN 'daily' WHEN 1 THEN 'weekly' WHEN 2 THEN 'monthly'
             ELSE 'quarterly' END AS validation_frequency""",
        f"""CASE WHEN p_partkey % 11 <> 0 THEN
             CAST(date_sub({_DAY}, CAST(p_partkey % 120 AS INT)) AS TIMESTAMP_NTZ) END AS last_validated""",
    )


def agent_bindings(spark: SparkSession, folder: str) -> DataFrame:
    """Metric names that answering agents refer to; some exist in no catalog."""
    return table(spark, folder, "orders").selectExpr(
        "concat('agent_', o_custkey % 40) AS agent_name", "concat('metric_', o_orderkey % 2500) AS metric_name"
    )


def named_assets(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").selectExpr(
        """CASE p_partkey % 6 WHEN 0 THEN 'semantic_view' WHEN 1 THEN 'metric' WHEN 2 THEN 'agent'
             WHEN 3 THEN 'role' WHEN 4 THEN 'table' ELSE 'test_case' END AS asset_type""",
        """CASE p_partkey % 12 WHEN 0 THEN concat('finance_revenue_v', p_partkey) WHEN 1 THEN concat('metric_', p_partkey)
             WHEN 2 THEN 'finance_agent' WHEN 3 THEN 'domain_steward_finance' WHEN 4 THEN concat('fct_revenue_', p_partkey)
             WHEN 5 THEN concat('finance_resolution_', p_partkey) ELSE concat(p_name, p_partkey) END AS asset_name""",
    )


def role_grants(spark: SparkSession, folder: str) -> DataFrame:
    """A role tree over all customers: role k inherits roles 2k and 2k + 1."""
    return table(spark, folder, "customer").filter("c_custkey > 1").selectExpr(
        "concat('role_', c_custkey div 2) AS role", "concat('role_', c_custkey) AS granted_role"
    )


def onboarding_done(spark: SparkSession, folder: str) -> DataFrame:
    """Completed checklist steps by domain, one row per completed task."""
    return table(spark, folder, "part").selectExpr(
        "replace(p_brand, '#', ' ') AS domain_name",
        "1 + (p_size * CAST(substr(p_brand, 7) AS INT)) % 8 AS step_order",
    )


# ---------------------------------------------------------------- request batches

_SUBMITTED = "TIMESTAMP_NTZ'2001-07-14 00:00:00'"


def onboarding_requests(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "supplier").selectExpr(
        "s_suppkey AS request_id",
        """CASE s_suppkey % 4 WHEN 0 THEN concat('Domain ', s_suppkey % 24) WHEN 1 THEN s_name
             WHEN 2 THEN concat('BRAND ', s_suppkey % 37) ELSE concat('Region_', s_nationkey) END AS domain_name""",
        "concat('About ', s_name) AS description",
        "concat('lead_', s_suppkey % 5) AS steward_user",
        "concat('backup_', s_suppkey % 3) AS backup_steward",
        "concat('U', s_suppkey % 6) AS requested_by",
        f"{_SUBMITTED} + make_dt_interval(0, 0, 0, CAST(s_suppkey % 1000 AS INT)) AS submitted_at",
    )


def registration_requests(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").selectExpr(
        "c_custkey AS request_id",
        "concat('Brand ', 1 + c_custkey % 30) AS domain",
        """CASE c_custkey % 5 WHEN 0 THEN concat('metric_', c_custkey) WHEN 1 THEN concat('Bad Name ', c_custkey)
             WHEN 2 THEN concat('new_metric_', c_custkey % 40) WHEN 3 THEN 'x'
             ELSE concat('fresh_metric_', c_custkey) END AS metric_name""",
        "concat('Definition by ', c_name) AS business_definition",
        "concat('analytics.semantic.sales_v', c_custkey % 50) AS semantic_view_fqn",
        "'NUMBER' AS data_type",
        "'SUM' AS aggregation_method",
        "'daily' AS time_grain",
        "concat('OWNER_', c_custkey % 7) AS owner_role",
        "24 AS freshness_sla_hours",
        f"{_SUBMITTED} + make_dt_interval(0, 0, 0, CAST(c_custkey % 5000 AS INT)) AS submitted_at",
    )


def certification_requests(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").selectExpr(
        "c_custkey AS request_id",
        """concat('brand_', 1 + c_custkey % 25, '.semantic.metric_', c_custkey % 1200) AS metric_fqn""",
        "CASE WHEN c_custkey % 19 <> 0 THEN CAST(92 + c_custkey % 9 AS DECIMAL(5,2)) END AS data_quality_score",
        "concat('U', c_custkey % 6) AS requested_by",
        "concat('U', c_custkey % 4) AS approver",
        f"{_SUBMITTED} + make_dt_interval(0, 0, 0, CAST(c_custkey % 5000 AS INT)) AS submitted_at",
    )


def promotion_requests(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").selectExpr(
        "o_orderkey AS request_id",
        """CASE o_orderkey % 3 WHEN 0 THEN concat('analytics.semantic.sales_v', o_custkey % 60)
             WHEN 1 THEN concat('analytics.agents.', lower(o_orderstatus), 'inance_agent')
             ELSE concat('analytics.semantic.View', o_custkey % 60) END AS asset_fqn""",
        "CASE o_orderkey % 3 WHEN 1 THEN 'agent' ELSE 'semantic_view' END AS asset_type",
        "CASE WHEN o_orderstatus = 'F' THEN 'STAGING' ELSE 'PRODUCTION' END AS target_environment",
        "concat('sha', o_orderkey) AS git_commit_sha",
        "concat('Promote ', o_orderpriority) AS change_description",
        "concat('U', o_custkey % 7) AS requested_by",
    )


# ---------------------------------------------------------------- tenancy, interface, streams


def tenant_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Raw revenue lines: order, product, day and amount."""
    return table(spark, folder, "lineitem").selectExpr(
        "l_orderkey AS order_key",
        "l_partkey AS product_key",
        "CAST(l_shipdate AS DATE) AS revenue_date",
        "CAST(l_extendedprice AS DECIMAL(12,2)) AS amount_usd",
    )


def tenant_buyers(spark: SparkSession, folder: str) -> DataFrame:
    """Tenant, region and customer of each order."""
    regions = (
        table(spark, folder, "customer")
        .join(table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select("c_custkey", "r_name")
    )
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return orders.join(regions, F.col("o_custkey") == F.col("c_custkey"), "left").selectExpr(
        "o_orderkey AS order_key",
        "concat('TNT-', lpad(CAST(1 + o_custkey % 3 AS STRING), 6, '0')) AS tenant_id",
        "r_name AS region",
        "concat('C', o_custkey) AS customer_id",
    )


def tenant_products(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").selectExpr("p_partkey AS product_key", "p_type AS product_line")


def tenant_revenue(spark: SparkSession, folder: str) -> DataFrame:
    """Revenue of three tenants; a tenant holds a third of all rows. A line whose order, customer or part is unknown stays,
    with what it lacks left null."""
    return (
        tenant_lines(spark, folder)
        .join(tenant_buyers(spark, folder), "order_key", "left")
        .join(tenant_products(spark, folder), "product_key", "left")
        .select("tenant_id", "revenue_date", "product_line", "region", "amount_usd", "customer_id")
    )


_EVENT_TENANT = "concat('TNT-', lpad(CAST(1 + user_id % 3 AS STRING), 6, '0')) AS tenant_id"


def tenant_usage(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").selectExpr(
        "event_id",
        _EVENT_TENANT,
        "CAST(ts AS DATE) AS event_date",
        "concat('U', user_id) AS user_id",
        "event_type AS feature_name",
        "event_id % 3600 AS session_duration_seconds",
    )


PAGE_EVENT_COLUMNS = [
    "event_id",
    _EVENT_TENANT,
    "concat('U', user_id) AS user_id",
    "concat('/', event_type) AS page_name",
    "CAST(100 + (event_id * 37) % 4900 AS INT) AS load_time_ms",
    "ts AS event_timestamp",
]


def page_events(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").selectExpr(*PAGE_EVENT_COLUMNS)


def page_event_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The same rows as an unbounded file stream. Event time must be a zoned timestamp."""
    schema = table(spark, folder, "events").schema
    # A pattern, because a stream accepts a single file only through one.
    raw = spark.readStream.schema(schema).parquet(f"{folder}/events.parquet*")
    return raw.selectExpr(*PAGE_EVENT_COLUMNS).withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp"))


def tenants(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "supplier").selectExpr(
        "concat('TNT-', lpad(CAST(s_suppkey + 1 AS STRING), 6, '0')) AS tenant_id",
        "s_name AS tenant_name",
        """CASE s_suppkey % 4 WHEN 0 THEN 'enterprise' WHEN 1 THEN 'professional' WHEN 2 THEN 'free'
             ELSE 'starter' END AS tier""",
        """CASE s_suppkey % 4 WHEN 0 THEN array('*')
             WHEN 1 THEN array('view', 'click', concat('metric_', s_suppkey), 'net_dollar_retention')
             WHEN 2 THEN CASE s_suppkey % 8 WHEN 6 THEN array('*') ELSE array('active_users', 'view', concat('metric_', s_suppkey * 5)) END
             ELSE CAST(array() AS ARRAY<STRING>) END AS metrics_enabled""",
        "s_suppkey % 7 <> 6 AS is_active",
    )


def tenant_users(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").selectExpr(
        "concat('user', c_custkey, '@example.com') AS user_email",
        "concat('TNT-', lpad(CAST(1 + c_custkey % 100 AS STRING), 6, '0')) AS tenant_id",
        "CASE c_custkey % 3 WHEN 0 THEN 'admin' WHEN 1 THEN 'analyst' ELSE 'viewer' END AS role_within_tenant",
    )


def access_requests(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").selectExpr(
        "event_id AS request_id",
        "concat('user', user_id, '@example.com') AS user_email",
        "event_type AS metric_name",
    )


def metric_api_requests(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").selectExpr(
        "event_id AS request_id",
        "concat('metric_', event_id % 2500) AS metric_name",
        "concat('TNT-', lpad(CAST(1 + user_id % 130 AS STRING), 6, '0')) AS tenant_id",
    )


def api_request_log(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").selectExpr(
        "event_id AS request_id",
        "event_type AS metric_requested",
        # Some requests come from a tenant that is not registered.
        "CASE WHEN user_id % 50 = 7 THEN 'TNT-UNKNOWN' ELSE concat('TNT-', lpad(CAST(1 + user_id % 3 AS STRING), 6, '0')) END AS tenant_id",
        "CASE event_id % 10 WHEN 0 THEN 404 WHEN 1 THEN 403 ELSE 200 END AS response_status",
        "ts AS requested_at",
    )


def user_region_mapping(spark: SparkSession, folder: str) -> DataFrame:
    """Regions each account manager may see."""
    return table(spark, folder, "nation").join(
        table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    ).selectExpr("concat('manager_', n_nationkey % 10) AS user_name", "r_name AS allowed_region")


def glossary_versions(spark: SparkSession, folder: str) -> DataFrame:
    """Published definitions: a term gets a new version with every part of its size."""
    return table(spark, folder, "part").selectExpr(
        "p_partkey + 1 AS version_id",
        "concat('term_', p_size) AS term",
        "concat('Definition ', p_partkey, ' of ', p_name) AS canonical_definition",
    )


def spokes(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "supplier").selectExpr("s_name AS spoke", "s_suppkey * 21 AS local_version")


def resolve_requests(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").selectExpr(
        "event_id AS request_id", "concat('metric_', event_id % 2500) AS metric_name"
    )


# ---------------------------------------------------------------- what arrives late, twice or broken


def revenue_deliveries(spark: SparkSession, folder: str) -> list[tuple[DataFrame, int]]:
    """The fact lines as they are delivered: a list of batches of signed lines that add up to ``fct_revenue``.

    One-time lines arrive late. Adjusted lines first arrive without their discount and are corrected. Refunded
    subscriptions arrive twice, and one of the two is withdrawn. Each of these touches every month.
    """
    lines, columns = fct_revenue(spark, folder, customer=False), fct_revenue(spark, folder).columns
    late, adjusted = F.col("revenue_type") == "one_time", F.col("credit_type") == "adjustment"
    twice = (F.col("credit_type") == "refund") & (F.col("revenue_type") == "subscription")
    right, wrong = F.col("amount_usd"), F.col("amount_usd") + 1
    wide = lines.select(wrong).schema[0].dataType

    def delivered(*copies) -> DataFrame:
        """Each line once for every condition it meets, with that amount and sign, before it meets its order: a delivery is one pass."""
        def of(values: list, otherwise) -> Column:
            return reduce(lambda rest, k: F.when(F.col("copy") == k, values[k]).otherwise(rest), range(len(values) - 1), otherwise)

        met, amounts, signs = zip(*copies, strict=True)
        which = F.explode(F.array(*[F.when(c, F.lit(k)) for k, c in enumerate(met)]))
        rows = lines.filter(reduce(or_, met)).withColumn("copy", which).filter(F.col("copy").isNotNull())
        rows = rows.withColumns({"amount_usd": of([a.cast(wide) for a in amounts], amounts[-1].cast(wide)), "sign": of([F.lit(x) for x in signs], F.lit(signs[-1]))})
        return with_customer(spark, folder, rows).select(*columns, "sign")

    return [
        (delivered((~late & ~adjusted, right, 1), (twice, right, 1), (adjusted & ~late, wrong, 1)), 1),
        (delivered((late & F.col("is_recurring").isNotNull(), right, 1), (adjusted & ~late, wrong, -1), (adjusted & ~late, right, 1)), 2),
        (delivered((twice, right, -1)), 3),
    ]


def arriving_page_events(spark: SparkSession, folder: str) -> DataFrame:
    """Page events with the wave they arrive in: errors are reported six days late, signups half a day; a wave takes ten days."""
    delay = "CASE page_name WHEN '/error' THEN INTERVAL '144' HOUR WHEN '/signup' THEN INTERVAL '12' HOUR ELSE INTERVAL '0' HOUR END"
    return page_events(spark, folder).selectExpr("*", f"CAST(floor(datediff(CAST(event_timestamp + {delay} AS DATE), DATE'2024-01-01') / 10) AS INT) AS wave")


def event_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """Payloads of all events as different senders write them: as a number, as text, nested, without the key, and cut off."""
    return table(spark, folder, "events").selectExpr(
        "event_id",
        "event_type",
        """CASE event_type WHEN 'view' THEN replace(replace(props, ': ', ': "'), '}', '"}') WHEN 'signup' THEN concat('{"detail": ', props, ', "k": null}')
             WHEN 'purchase' THEN '{"amount": 1.5, "items": [1, 2]}' WHEN 'error' THEN substr(props, 1, length(props) - 1) ELSE props END AS payload""",
    )
