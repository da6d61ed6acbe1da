"""The derived business tables once more, as SQL over the driver's tables."""

_FINANCE = {
    "fct_revenue": """
SELECT l_orderkey AS contract_id, concat('C', o_custkey) AS customer_id, concat('P', l_partkey) AS product_id,
       CAST(l_shipdate AS DATE) AS recognized_date,
       CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS amount_usd,
       CASE l_linenumber % 4 WHEN 0 THEN 'subscription' WHEN 1 THEN 'usage'
         WHEN 2 THEN 'professional_services' ELSE 'one_time' END AS revenue_type,
       l_linenumber % 4 IN (0, 1) AS is_recurring,
       CASE l_linestatus WHEN 'F' THEN 'recognized' ELSE 'deferred' END AS recognition_status,
       CASE l_returnflag WHEN 'R' THEN 'refund' WHEN 'A' THEN 'adjustment' ELSE 'none' END AS credit_type,
       CAST(l_tax AS DECIMAL(4,2)) * CAST(l_extendedprice AS DECIMAL(12,2)) AS credit_amount_usd
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey""",
    "dim_customer": """
SELECT concat('C', c_custkey) AS customer_id, c_name AS customer_name,
       CASE c_custkey % 3 WHEN 0 THEN 'Enterprise' WHEN 1 THEN 'Mid-Market' ELSE 'SMB' END AS segment,
       r_name AS region, c_mktsegment AS industry,
       CASE WHEN c_custkey % 50 <> 1 THEN (c_custkey * 37) % 101 END AS health_score,
       CASE WHEN c_custkey % 10 = 0 THEN 'churned' ELSE 'active' END AS contract_status,
       CASE WHEN c_custkey % 17 = 0 THEN 'internal' ELSE 'customer' END AS account_type,
       DATE '2001-07-15' - CAST(c_custkey % 120 AS INTEGER) AS last_login_date,
       DATE '2001-07-15' - CAST(c_custkey % 90 AS INTEGER) AS last_engagement_date,
       c_acctbal AS account_balance
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "dim_customer_holes": "SELECT * FROM dim_customer WHERE account_balance >= 0",
    "dim_product": "SELECT concat('P', p_partkey) AS product_id, p_name AS product_name, p_type AS product_line FROM part",
    "fct_product_usage": """
SELECT concat('C', c_custkey) AS customer_id, DATE '2001-06-01' AS usage_month, c_custkey % 41 - 20 AS usage_trend_pct
FROM customer""",
    "agg_monthly_churn": """
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS churn_month,
       count(DISTINCT o_custkey) FILTER (WHERE o_orderstatus = 'P') AS churned_customer_count,
       count(DISTINCT o_custkey) AS active_customers_start_of_month
FROM orders GROUP BY 1""",
    "fct_costs": """
SELECT CAST(l_shipdate AS DATE) AS cost_date, p_type AS cost_category,
       CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)) AS amount_usd
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey""",
    "monthly_metrics": """
SELECT CAST(date_trunc('month', recognized_date) AS DATE) AS metric_month,
       coalesce(sum(amount_usd) FILTER (WHERE is_recurring), 0) * 12
         + 5 * (month(min(recognized_date)) % 2) AS arr_reported
FROM fct_revenue GROUP BY 1""",
    "metric_snapshots": """
SELECT 'finance_revenue' AS semantic_view, s.snapshot_date, m.month,
       m.total + s.shift + CASE WHEN s.shift = 0 AND m.month = DATE '2001-03-01' THEN 1 ELSE 0 END AS total_revenue,
       m.recurring + s.shift AS recurring_revenue
FROM (SELECT CAST(date_trunc('month', recognized_date) AS DATE) AS month, sum(amount_usd) AS total,
             coalesce(sum(amount_usd) FILTER (WHERE is_recurring), 0) AS recurring
      FROM fct_revenue GROUP BY 1) m,
     (VALUES (DATE '2001-06-15', 7), (DATE '2001-07-14', 0)) s(snapshot_date, shift)""",
    "semantic_view_consumers": """
SELECT CASE c_custkey % 3 WHEN 0 THEN 'dashboard' WHEN 1 THEN 'agent' ELSE 'application' END AS consumer_type,
       c_name AS consumer_name,
       CASE WHEN c_custkey % 2 = 0 THEN 'finance_revenue' ELSE 'finance_costs' END AS semantic_view_name,
       CASE WHEN c_custkey % 5 < 3 THEN 'gross_revenue' ELSE 'total_revenue' END AS metric_name,
       DATE '2001-07-15' - CAST(c_custkey % 180 AS INTEGER) AS last_query_date,
       (c_custkey * 7) % 500 AS query_count_30d
FROM customer""",
    "customer_orders": """
SELECT CAST(o_orderdate AS DATE) AS deal_date,
       CASE o_orderstatus WHEN 'F' THEN 'closed_won' WHEN 'P' THEN 'closed_lost' ELSE 'open' END AS stage,
       concat('rep_', o_custkey % 23) AS rep_name, concat('C', o_custkey) AS customer_id,
       CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(18,2)) ELSE 0 END AS total_bookings,
       CASE WHEN o_orderstatus = 'O' THEN CAST(o_totalprice AS DECIMAL(18,2)) ELSE 0 END AS pipeline_value
FROM orders""",
    "revenue_data": """
SELECT recognized_date AS transaction_date, amount_usd AS recognized_revenue,
       CASE WHEN is_recurring THEN amount_usd * 12 ELSE 0 END AS annual_recurring_revenue,
       CAST(0.8 + contract_id % 50 * 0.01 AS DECIMAL(10,4)) AS net_dollar_retention, customer_id, product_line
FROM fct_revenue LEFT JOIN dim_product USING (product_id)""",
    "customer_health_data": """
SELECT concat('C', c_custkey) AS customer_id, CASE WHEN c_custkey % 50 <> 1 THEN (c_custkey * 37) % 101 END AS health_score,
       c_custkey % 11 AS nps_score, CAST((c_custkey * 7) % 100 * 0.01 AS DECIMAL(5,4)) AS churn_risk,
       CASE c_custkey % 3 WHEN 0 THEN 'Enterprise' WHEN 1 THEN 'Mid-Market' ELSE 'SMB' END AS segment,
       DATE '2001-07-15' - CAST(c_custkey % 90 AS INTEGER) AS last_activity_date,
       CASE WHEN c_custkey % 10 = 0 THEN 'churned' ELSE 'active' END AS contract_status
FROM customer""",
    "support_data": """
SELECT concat('T', o_orderkey) AS ticket_id, CAST(o_orderdate AS DATE) AS created_date,
       CAST(o_orderkey % 96 AS DECIMAL(10,2)) AS resolution_time_hours,
       CAST(1 + o_orderkey % 5 AS DECIMAL(3,1)) AS csat_score, o_orderstatus AS category,
       o_orderpriority AS priority, concat('C', o_custkey) AS customer_id
FROM orders""",
    "metric_certifications": """
SELECT concat('metric_', p_partkey) AS metric_name, concat('view_', p_partkey % 50) AS semantic_view,
       replace(p_brand, '#', ' ') AS domain, concat('steward_', p_partkey % 9) AS certified_by,
       DATE '2001-07-15' - CAST(p_partkey % 90 AS INTEGER) AS certification_date,
       DATE '2001-07-15' + (p_size - 25) AS next_review_date,
       CASE p_partkey % 4 WHEN 2 THEN 'draft' WHEN 3 THEN 'deprecated' ELSE 'certified' END AS status
FROM part""",
}

_AGENT = """CASE user_id % 4 WHEN 0 THEN 'finance_agent' WHEN 1 THEN 'sales_agent'
         WHEN 2 THEN 'cs_agent' ELSE 'executive_agent' END AS agent_name"""
_CONFIDENCE = "CAST((40 + (event_id * 13) % 61) * 0.01 AS DECIMAL(4,2))"

_TELEMETRY = {
    "answer_log": f"""
SELECT event_id AS interaction_id, ts AS "timestamp", {_AGENT}, concat('U', user_id) AS user_id,
       CASE user_id % 3 WHEN 0 THEN 'ANALYST' WHEN 1 THEN 'MANAGER' ELSE 'AGENT_USER' END AS user_role,
       concat('view_', event_type) AS resolved_semantic_view, event_type AS resolved_metric,
       {_CONFIDENCE} AS confidence_score, event_id % 900 AS response_time_ms,
       event_type <> 'error' AS grounded, value < 1 AS escalated
FROM events""",
    "governance_log": f"""
SELECT event_id AS audit_id, concat('U', user_id) AS user_id,
       CASE user_id % 3 WHEN 0 THEN 'ANALYST' WHEN 1 THEN 'MANAGER' ELSE 'AGENT_USER' END AS user_role, {_AGENT},
       concat('Question ', event_id % 97, '?') AS original_question,
       CASE WHEN event_id % 53 <> 0 THEN concat('q', event_id % 97) END AS normalized_question,
       CASE WHEN event_type = 'error' THEN CAST([] AS VARCHAR[]) ELSE [event_type] END AS metrics_used,
       {_CONFIDENCE} AS resolution_confidence, event_id % 9 = 0 AS disambiguation_applied,
       event_id % 700 AS execution_time_ms,
       concat('a', (event_id // 97) % (1 + (event_id % 97) % 3)) AS answer_summary,
       event_id % 41 <> 0 AS provenance_disclosed,
       CASE WHEN user_id % 4 = 0 THEN CAST([] AS VARCHAR[]) ELSE ['region'] END AS rls_policies_applied,
       CASE WHEN user_id % 5 = 0 THEN ['email'] ELSE CAST([] AS VARCHAR[]) END AS masking_policies_applied,
       value < 1 AS escalated, ts AS created_at
FROM events""",
    "escalations": f"""
SELECT {_AGENT}, event_type AS escalation_reason, concat('g', event_id % 3) AS escalation_gate,
       concat('question ', event_id % 97) AS user_question, {_CONFIDENCE} AS confidence_score,
       event_id % 3 = 0 AS led_to_new_metric, ts AS created_at
FROM events WHERE value < 1""",
    "answer_tests": """
SELECT CASE o_orderkey % 5 WHEN 0 THEN 'resolution' WHEN 1 THEN 'disambiguation' WHEN 2 THEN 'boundary'
         WHEN 3 THEN 'cross_domain' ELSE 'escalation' END AS test_category,
       CASE o_custkey % 4 WHEN 0 THEN 'finance_agent' WHEN 1 THEN 'sales_agent'
         WHEN 2 THEN 'cs_agent' ELSE 'executive_agent' END AS agent_name,
       concat('metric_', o_custkey) AS expected_metric,
       CASE o_orderkey % 5 WHEN 2 THEN 'REFUSE' WHEN 3 THEN 'MULTI_VIEW_ANSWER' ELSE 'ANSWER' END AS expected_behavior,
       CASE o_orderstatus WHEN 'F' THEN 'PASS' WHEN 'O' THEN 'FAIL' END AS last_result,
       o_orderpriority <> '5-LOW' AS is_active
FROM orders""",
    "questions": f"""
SELECT event_id AS question_id, {_AGENT},
       concat('Show me ', CASE event_id % 12 WHEN 0 THEN 'revenue' WHEN 1 THEN 'our ARR'
         WHEN 2 THEN 'the revenue run rate' WHEN 3 THEN 'subscription revenue' WHEN 4 THEN 'pipeline'
         WHEN 5 THEN 'Bookings' WHEN 6 THEN 'health score' WHEN 7 THEN 'NPS' WHEN 8 THEN 'the CFO salary'
         WHEN 9 THEN 'churn risk by region' WHEN 10 THEN 'weather' ELSE 'net retention' END,
         ' after ', event_type, ' ', user_id) AS question,
       {_CONFIDENCE} AS confidence
FROM events""",
}

_GOVERNANCE = {
    "metric_catalog": """
SELECT concat('M', p_partkey) AS metric_id,
       concat(lower(replace(p_brand, '#', '_')), '.semantic.metric_', p_partkey) AS metric_fqn,
       replace(p_brand, '#', ' ') AS domain, p_type AS sub_domain, concat('metric_', p_partkey) AS metric_name,
       concat('Definition of ', p_name) AS business_definition,
       concat('analytics.semantic.sales_v', p_partkey % 50) AS semantic_view_fqn,
       CASE WHEN p_partkey % 2 = 0 THEN 'SUM' ELSE 'AVG' END AS aggregation_method,
       CASE WHEN p_partkey % 3 = 0 THEN 'monthly' ELSE 'daily' END AS time_grain,
       CASE WHEN p_partkey % 29 <> 0 THEN concat('OWNER_', p_partkey % 7) END AS owner_role,
       concat('STEWARD_', p_partkey % 5) AS steward_role,
       CASE p_partkey % 5 WHEN 2 THEN 'PENDING' WHEN 3 THEN 'DRAFT' WHEN 4 THEN 'EXPIRED'
         ELSE 'CERTIFIED' END AS certification_status,
       DATE '2001-07-15' - CAST(p_partkey % 90 AS INTEGER) AS certification_date,
       DATE '2001-07-15' + (p_size - 25) AS recertification_due,
       CASE WHEN p_partkey % 7 <> 0 THEN
         CAST(DATE '2001-07-15' - CAST(p_partkey % 240 AS INTEGER) AS TIMESTAMP) END AS last_queried_at,
       CASE WHEN p_partkey % 3 = 0 THEN 0 ELSE (p_partkey * 7) % 300 END AS query_count_30d,
       p_partkey % 12 AS consumer_count_30d, p_partkey % 4 AS agent_count_using,
       CAST(90 + p_partkey % 11 AS DECIMAL(5,2)) AS data_quality_score, 1 + p_partkey % 48 AS freshness_sla_hours,
       p_partkey % 6 = 0 AS has_verified_query,
       CASE WHEN p_partkey % 31 = 0 THEN ['ZOMBIE_CANDIDATE'] END AS tags,
       CAST(DATE '2001-07-15' - CAST(p_partkey % 700 AS INTEGER) AS TIMESTAMP) AS created_at,
       CAST(DATE '2001-07-15' - CAST(p_partkey % 5 AS INTEGER) AS TIMESTAMP) AS updated_at
FROM part""",
    "domain_registry": """
SELECT concat('D', n) AS domain_id, concat('Brand ', n) AS domain_name, concat('DOMAIN_STEWARD_', n) AS steward_role,
       concat('steward_', n) AS steward_user, n * 3 AS metric_count, n % 5 AS semantic_view_count,
       CASE WHEN n % 9 <> 5 THEN n % 4 END AS agent_count,
       CAST((n * 37) % 101 AS DECIMAL(5,2)) AS certification_rate, CASE WHEN n % 7 <> 3 THEN CAST(85 + n % 15 AS DECIMAL(5,2)) END AS avg_data_quality,
       CASE n % 4 WHEN 0 THEN 'FOUNDATION' WHEN 1 THEN 'GROWTH' WHEN 2 THEN 'SCALE' ELSE 'ENTERPRISE' END AS governance_maturity,
       DATE '2001-07-15' - CAST(n AS INTEGER) AS last_governance_review,
       DATE '2001-07-15' + CAST(n - 12 AS INTEGER) AS next_review_due, n % 6 <> 0 AS is_active
FROM (SELECT DISTINCT CAST(substr(p_brand, 7) AS BIGINT) AS n FROM part)""",
    "change_log": """
SELECT concat('CH', o_orderkey) AS change_id,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'metric' WHEN '2-HIGH' THEN 'semantic_view'
         WHEN '3-MEDIUM' THEN 'agent' ELSE 'table' END AS asset_type,
       concat('analytics.semantic.sales_v', o_custkey % 50) AS asset_fqn, concat('U', o_custkey % 7) AS requested_by,
       CASE WHEN o_orderkey % 23 = 0 THEN CAST([] AS VARCHAR[]) ELSE [concat('U', o_orderkey % 7)] END AS approved_by,
       o_orderdate - to_minutes(CAST((o_orderkey % 400) * 60 + 30 AS INTEGER)) AS approval_timestamp,
       o_orderdate AS deployed_at, o_orderpriority = '1-URGENT' AS is_breaking_change,
       CASE o_orderstatus WHEN 'F' THEN 'DEPLOYED' WHEN 'P' THEN 'ROLLED_BACK' ELSE 'PENDING' END AS status
FROM orders""",
    "incident_log": """
SELECT concat('I', o_orderkey) AS incident_id, 1 + o_orderkey % 4 AS severity,
       [concat('metric_', o_custkey)] AS affected_metrics, o_orderdate AS detected_at,
       CASE WHEN o_orderstatus = 'F' THEN 'RESOLVED' ELSE 'OPEN' END AS status,
       o_custkey % 60 AS time_to_detect_minutes, (o_custkey * 7) % 3000 AS time_to_mitigate_minutes,
       CASE WHEN o_orderstatus = 'F' THEN (o_custkey * 7) % 3000 + o_orderkey % 600 END AS time_to_resolve_minutes
FROM orders""",
    "metric_requests": """
SELECT concat('R', o_orderkey) AS request_id,
       CASE o_orderstatus WHEN 'F' THEN 'APPROVED' WHEN 'P' THEN 'REJECTED' ELSE 'SUBMITTED' END AS status,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'URGENT' ELSE 'STANDARD' END AS urgency,
       o_orderdate AS submitted_at, o_orderdate + INTERVAL 72 HOUR AS sla_deadline,
       CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + to_hours(CAST(o_custkey % 120 AS INTEGER)) END AS decision_date
FROM orders""",
    "query_history": """
SELECT event_id AS query_id, concat('U', user_id) AS user_name,
       concat('select * from Analytics.Semantic.Sales_V', event_id % 40, ' where k = ', user_id) AS query_text,
       ts - INTERVAL 8240 DAY AS start_time, CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS execution_status
FROM events""",
    "business_glossary": """
SELECT concat('metric_', p_partkey) AS term, concat('Definition of ', p_name) AS canonical_definition,
       concat('Default to ', p_brand) AS disambiguation_rules, [p_name, p_type] AS commonly_confused_with
FROM part""",
    "raci_matrix": """
SELECT concat(p_name, ' ', p_partkey) AS operation_name, p_type AS operation_category, p_size AS sla_hours,
       p_partkey % 3 <> 0 AS requires_approval
FROM part""",
    "gate_table": """
SELECT concat('gate ', s_suppkey) AS gate_name,
       CASE WHEN s_suppkey % 2 = 0 THEN 'DEV' ELSE 'STAGING' END AS from_environment,
       CASE WHEN s_suppkey % 2 = 0 THEN 'STAGING' ELSE 'PRODUCTION' END AS to_environment,
       CASE s_suppkey % 3 WHEN 0 THEN 'automated' WHEN 1 THEN 'manual_approval' ELSE 'sla_check' END AS gate_type,
       CASE WHEN s_suppkey % 4 = 0 THEN 'WARN' ELSE 'BLOCK' END AS failure_action, s_suppkey % 7 <> 0 AS is_active
FROM supplier""",
    "regulatory_controls": """
SELECT concat('control_', p_partkey) AS governance_control,
       CASE p_partkey % 4 WHEN 0 THEN 'SOX' WHEN 1 THEN 'GDPR' WHEN 2 THEN 'HIPAA' ELSE 'EU_AI_ACT' END AS regulation,
       CASE p_size % 4 WHEN 0 THEN 'daily' WHEN 1 THEN 'weekly' WHEN 2 THEN 'monthly' ELSE 'quarterly' END AS validation_frequency,
       CASE WHEN p_partkey % 11 <> 0 THEN
         CAST(DATE '2001-07-15' - CAST(p_partkey % 120 AS INTEGER) AS TIMESTAMP) END AS last_validated
FROM part""",
    "agent_bindings": """
SELECT concat('agent_', o_custkey % 40) AS agent_name, concat('metric_', o_orderkey % 2500) AS metric_name FROM orders""",
    "named_assets": """
SELECT CASE p_partkey % 6 WHEN 0 THEN 'semantic_view' WHEN 1 THEN 'metric' WHEN 2 THEN 'agent'
         WHEN 3 THEN 'role' WHEN 4 THEN 'table' ELSE 'test_case' END AS asset_type,
       CASE p_partkey % 12 WHEN 0 THEN concat('finance_revenue_v', p_partkey) WHEN 1 THEN concat('metric_', p_partkey)
         WHEN 2 THEN 'finance_agent' WHEN 3 THEN 'domain_steward_finance' WHEN 4 THEN concat('fct_revenue_', p_partkey)
         WHEN 5 THEN concat('finance_resolution_', p_partkey) ELSE concat(p_name, p_partkey) END AS asset_name
FROM part""",
    "role_grants": """
SELECT concat('role_', c_custkey // 2) AS role, concat('role_', c_custkey) AS granted_role FROM customer WHERE c_custkey > 1""",
    "onboarding_done": """
SELECT replace(p_brand, '#', ' ') AS domain_name, 1 + (p_size * CAST(substr(p_brand, 7) AS INTEGER)) % 8 AS step_order FROM part""",
    "onboarding_requests": """
SELECT s_suppkey AS request_id,
       CASE s_suppkey % 4 WHEN 0 THEN concat('Domain ', s_suppkey % 24) WHEN 1 THEN s_name
         WHEN 2 THEN concat('BRAND ', s_suppkey % 37) ELSE concat('Region_', s_nationkey) END AS domain_name,
       concat('About ', s_name) AS description, concat('lead_', s_suppkey % 5) AS steward_user,
       concat('backup_', s_suppkey % 3) AS backup_steward, concat('U', s_suppkey % 6) AS requested_by,
       TIMESTAMP '2001-07-14 00:00:00' + to_seconds(s_suppkey % 1000) AS submitted_at
FROM supplier""",
    "registration_requests": """
SELECT c_custkey AS request_id, concat('Brand ', 1 + c_custkey % 30) AS domain,
       CASE c_custkey % 5 WHEN 0 THEN concat('metric_', c_custkey) WHEN 1 THEN concat('Bad Name ', c_custkey)
         WHEN 2 THEN concat('new_metric_', c_custkey % 40) WHEN 3 THEN 'x'
         ELSE concat('fresh_metric_', c_custkey) END AS metric_name,
       concat('Definition by ', c_name) AS business_definition,
       concat('analytics.semantic.sales_v', c_custkey % 50) AS semantic_view_fqn,
       concat('OWNER_', c_custkey % 7) AS owner_role,
       TIMESTAMP '2001-07-14 00:00:00' + to_seconds(c_custkey % 5000) AS submitted_at
FROM customer""",
    "certification_requests": """
SELECT c_custkey AS request_id,
       concat('brand_', 1 + c_custkey % 25, '.semantic.metric_', c_custkey % 1200) AS metric_fqn,
       CASE WHEN c_custkey % 19 <> 0 THEN CAST(92 + c_custkey % 9 AS DECIMAL(5,2)) END AS data_quality_score,
       concat('U', c_custkey % 6) AS requested_by, concat('U', c_custkey % 4) AS approver,
       TIMESTAMP '2001-07-14 00:00:00' + to_seconds(c_custkey % 5000) AS submitted_at
FROM customer""",
    "promotion_requests": """
SELECT o_orderkey AS request_id,
       CASE o_orderkey % 3 WHEN 0 THEN concat('analytics.semantic.sales_v', o_custkey % 60)
         WHEN 1 THEN concat('analytics.agents.', lower(o_orderstatus), 'inance_agent')
         ELSE concat('analytics.semantic.View', o_custkey % 60) END AS asset_fqn,
       CASE o_orderkey % 3 WHEN 1 THEN 'agent' ELSE 'semantic_view' END AS asset_type,
       CASE WHEN o_orderstatus = 'F' THEN 'STAGING' ELSE 'PRODUCTION' END AS target_environment,
       concat('sha', o_orderkey) AS git_commit_sha, concat('Promote ', o_orderpriority) AS change_description,
       concat('U', o_custkey % 7) AS requested_by
FROM orders""",
}

_TENANT = "concat('TNT-', lpad(CAST(1 + user_id % 3 AS VARCHAR), 6, '0')) AS tenant_id"

_TENANCY = {
    "tenant_revenue": """
SELECT concat('TNT-', lpad(CAST(1 + o_custkey % 3 AS VARCHAR), 6, '0')) AS tenant_id,
       CAST(l_shipdate AS DATE) AS revenue_date, p_type AS product_line, r_name AS region,
       CAST(l_extendedprice AS DECIMAL(12,2)) AS amount_usd, concat('C', o_custkey) AS customer_id
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN part ON l_partkey = p_partkey
  LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""",
    "tenant_usage": f"""
SELECT event_id, {_TENANT}, CAST(ts AS DATE) AS event_date, concat('U', user_id) AS user_id,
       event_type AS feature_name, event_id % 3600 AS session_duration_seconds
FROM events""",
    "page_events": f"""
SELECT event_id, {_TENANT}, concat('U', user_id) AS user_id, concat('/', event_type) AS page_name,
       CAST(100 + (event_id * 37) % 4900 AS INTEGER) AS load_time_ms, ts AS event_timestamp
FROM events""",
    "tenants": """
SELECT concat('TNT-', lpad(CAST(s_suppkey + 1 AS VARCHAR), 6, '0')) AS tenant_id, s_name AS tenant_name,
       CASE s_suppkey % 4 WHEN 0 THEN 'enterprise' WHEN 1 THEN 'professional' WHEN 2 THEN 'free' ELSE 'starter' END AS tier,
       CASE s_suppkey % 4 WHEN 0 THEN ['*']
         WHEN 1 THEN ['view', 'click', concat('metric_', s_suppkey), 'net_dollar_retention']
         WHEN 2 THEN CASE s_suppkey % 8 WHEN 6 THEN ['*'] ELSE ['active_users', 'view', concat('metric_', s_suppkey * 5)] END
         ELSE CAST([] AS VARCHAR[]) END AS metrics_enabled,
       s_suppkey % 7 <> 6 AS is_active
FROM supplier""",
    "tenant_users": """
SELECT concat('user', c_custkey, '@example.com') AS user_email,
       concat('TNT-', lpad(CAST(1 + c_custkey % 100 AS VARCHAR), 6, '0')) AS tenant_id,
       CASE c_custkey % 3 WHEN 0 THEN 'admin' WHEN 1 THEN 'analyst' ELSE 'viewer' END AS role_within_tenant
FROM customer""",
    "access_requests": """
SELECT event_id AS request_id, concat('user', user_id, '@example.com') AS user_email, event_type AS metric_name FROM events""",
    "metric_api_requests": """
SELECT event_id AS request_id, concat('metric_', event_id % 2500) AS metric_name,
       concat('TNT-', lpad(CAST(1 + user_id % 130 AS VARCHAR), 6, '0')) AS tenant_id
FROM events""",
    "api_request_log": f"""
SELECT event_id AS request_id, event_type AS metric_requested,
       CASE WHEN user_id % 50 = 7 THEN 'TNT-UNKNOWN' ELSE concat('TNT-', lpad(CAST(1 + user_id % 3 AS VARCHAR), 6, '0')) END AS tenant_id,
       CASE event_id % 10 WHEN 0 THEN 404 WHEN 1 THEN 403 ELSE 200 END AS response_status, ts AS requested_at
FROM events""",
    "user_region_mapping": """
SELECT concat('manager_', n_nationkey % 10) AS user_name, r_name AS allowed_region
FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "glossary_versions": """
SELECT p_partkey + 1 AS version_id, concat('term_', p_size) AS term,
       concat('Definition ', p_partkey, ' of ', p_name) AS canonical_definition
FROM part""",
    "spokes": "SELECT s_name AS spoke, s_suppkey * 21 AS local_version FROM supplier",
    "resolve_requests": "SELECT event_id AS request_id, concat('metric_', event_id % 2500) AS metric_name FROM events",
}

TABLES = {**_FINANCE, **_TELEMETRY, **_GOVERNANCE, **_TENANCY}
