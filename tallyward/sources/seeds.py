"""Fixed reference rows: policies, gates, controls, tiers and grants.

The values are fixed by the governance model; results depend on them literally. None of these
tables grows with the data. They reach Spark as local relations with known size, so its own
broadcast threshold applies to them.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

_STR, _INT, _BOOL, _LIST = pa.string(), pa.int32(), pa.bool_(), pa.list_(pa.string())


def literal_frame(spark: SparkSession, columns: list[tuple[str, pa.DataType]], rows: list[tuple]) -> DataFrame:
    """Rows as a local relation (a list of Python tuples would become an unsized RDD scan)."""
    arrays = [pa.array([row[i] for row in rows], kind) for i, (_, kind) in enumerate(columns)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, [name for name, _ in columns]))


# --- Fixed values: naming conventions (asset type, pattern, level, valid and invalid example)
NAMING_RULES = [
    ("semantic_view", "^[a-z]+_[a-z]+(_v[0-9]+)?$", "BLOCK", "finance_revenue_v2", "RevenueMetrics"),
    ("metric", "^[a-z][a-z0-9_]{2,50}$", "BLOCK", "recognized_revenue", "Rev $"),
    ("agent", "^[a-z]+_(agent|assistant)$", "BLOCK", "finance_agent", "FinanceBot"),
    (
        "role",
        "^[a-z]+_(steward|owner|consumer|admin|developer|officer|reviewer|service)(_[a-z]+)?$",
        "WARN",
        "domain_steward_finance",
        "TeamRole",
    ),
    ("table", "^(fct|dim|agg|stg|raw)_[a-z][a-z0-9_]+$", "WARN", "fct_revenue", "Revenue_Table_Final_v2_FIXED"),
    (
        "test_case",
        "^[a-z]+_(resolution|boundary|disambiguation|escalation|cross_domain)_[0-9]+$",
        "SUGGEST",
        "finance_resolution_001",
        "test1",
    ),
]


def naming_rules(spark: SparkSession) -> DataFrame:
    columns = [
        ("asset_type", _STR),
        ("pattern_regex", _STR),
        ("enforcement_level", _STR),
        ("valid_example", _STR),
        ("invalid_example", _STR),
        ("is_active", _BOOL),
    ]
    return literal_frame(spark, columns, [(*row, True) for row in NAMING_RULES])


# --- Fixed values: responsibility matrix (operation, category, responsible, accountable, SLA hours,
#     escalation path, needs approval, minimum approvers)
RACI = [
    ("New metric definition", "creation", "METRIC_OWNER", "DOMAIN_STEWARD", 72, "GOVERNANCE_COUNCIL_ADMIN", True, 1),
    ("New semantic view", "creation", "SEMANTIC_DEVELOPER", "SEMANTIC_PLATFORM_ADMIN", 48, "GOVERNANCE_COUNCIL_ADMIN", True, 2),
    ("New AI agent", "creation", "SEMANTIC_DEVELOPER", "SEMANTIC_PLATFORM_ADMIN", 120, "GOVERNANCE_COUNCIL_ADMIN", True, 3),
    ("Metric definition change (non-breaking)", "change", "METRIC_OWNER", "DOMAIN_STEWARD", 48, "GOVERNANCE_COUNCIL_ADMIN", True, 1),
    ("Metric definition change (breaking)", "change", "METRIC_OWNER", "GOVERNANCE_COUNCIL_ADMIN", 168, "CDO_DIRECT", True, 3),
    ("Agent instruction update", "change", "SEMANTIC_DEVELOPER", "SEMANTIC_PLATFORM_ADMIN", 48, "GOVERNANCE_COUNCIL_ADMIN", True, 2),
    ("Semantic view promotion to production", "deployment", "SEMANTIC_DEVELOPER", "SEMANTIC_PLATFORM_ADMIN", 24, "GOVERNANCE_COUNCIL_ADMIN", True, 2),
    ("Agent deployment to production", "deployment", "SEMANTIC_DEVELOPER", "SEMANTIC_PLATFORM_ADMIN", 24, "GOVERNANCE_COUNCIL_ADMIN", True, 2),
    ("Initial metric certification", "certification", "METRIC_OWNER", "DOMAIN_STEWARD", 120, "GOVERNANCE_COUNCIL_ADMIN", True, 2),
    ("Quarterly recertification", "certification", "METRIC_OWNER", "DOMAIN_STEWARD", 168, "GOVERNANCE_COUNCIL_ADMIN", True, 1),
    ("Metric deprecation", "deprecation", "DOMAIN_STEWARD", "GOVERNANCE_COUNCIL_ADMIN", 720, "CDO_DIRECT", True, 2),
    ("Wrong number reported by agent", "incident", "SEMANTIC_PLATFORM_ADMIN", "DOMAIN_STEWARD", 4, "GOVERNANCE_COUNCIL_ADMIN", False, 0),
    ("Semantic view data quality failure", "incident", "SEMANTIC_DEVELOPER", "SEMANTIC_PLATFORM_ADMIN", 8, "GOVERNANCE_COUNCIL_ADMIN", False, 0),
]


def raci_seed(spark: SparkSession) -> DataFrame:
    columns = [
        ("operation_name", _STR),
        ("operation_category", _STR),
        ("responsible_role", _STR),
        ("accountable_role", _STR),
        ("sla_hours", _INT),
        ("escalation_path", _STR),
        ("requires_approval", _BOOL),
        ("minimum_approvers", _INT),
    ]
    return literal_frame(spark, columns, RACI)


# --- Fixed values: promotion gates (from, to, name, type, what it demands, on failure, asset types)
PROMOTION_GATES = [
    ("DEV", "STAGING", "Schema Validation", "automated", "YAML parses correctly and references valid base tables", "BLOCK", ["semantic_view", "agent"]),
    ("DEV", "STAGING", "Metric Existence Check", "automated", "All metrics referenced in agent instructions exist in semantic views", "BLOCK", ["agent"]),
    ("DEV", "STAGING", "Test Coverage Minimum", "automated", "At least 3 test cases per metric (resolution, disambiguation, boundary)", "BLOCK", ["semantic_view", "agent"]),
    ("DEV", "STAGING", "No PII in Metric Definitions", "automated", "Metric definitions do not expose PII columns without masking policy reference", "BLOCK", ["semantic_view"]),
    ("STAGING", "PRODUCTION", "Full Test Suite Pass", "automated", "All test cases for this asset pass in staging environment", "BLOCK", ["semantic_view", "agent"]),
    ("STAGING", "PRODUCTION", "Smoke Test with Production Data", "automated", "Agent returns grounded answers for top-10 historical questions", "BLOCK", ["agent"]),
    ("STAGING", "PRODUCTION", "Domain Steward Approval", "manual_approval", "Domain steward confirms metric definitions match business intent", "BLOCK", ["semantic_view", "metric"]),
    ("STAGING", "PRODUCTION", "Compliance Review", "manual_approval", "Compliance officer confirms no regulatory exposure", "BLOCK", ["semantic_view", "agent"]),
    ("STAGING", "PRODUCTION", "Breaking Change Window", "sla_check", "Breaking changes require 7-day notice to downstream consumers", "BLOCK", ["semantic_view", "metric"]),
    ("STAGING", "PRODUCTION", "Rollback Plan Documented", "manual_approval", "Rollback procedure documented and validated in staging", "WARN", ["semantic_view", "agent"]),
]


def promotion_gates(spark: SparkSession) -> DataFrame:
    columns = [
        ("from_environment", _STR),
        ("to_environment", _STR),
        ("gate_name", _STR),
        ("gate_type", _STR),
        ("gate_description", _STR),
        ("failure_action", _STR),
        ("applies_to_asset_types", _LIST),
        ("is_active", _BOOL),
    ]
    return literal_frame(spark, columns, [(*row, True) for row in PROMOTION_GATES])


# --- Fixed values: regulatory controls (regulation, section, control, type, validated how often, risk, SLA hours)
CONTROLS = [
    ("SOX", "302 - CEO/CFO Certification", "Metric certification + quarterly recertification workflow", "preventive", "quarterly", "HIGH", 72),
    ("SOX", "404 - Internal Control Assessment", "Semantic view change log + promotion gates + audit trail", "detective", "quarterly", "HIGH", 168),
    ("SOX", "404 - Change Management", "DevOps pipeline with breaking change gates and 7-day notice window", "preventive", "monthly", "HIGH", 24),
    ("SOX", "404 - Segregation of Duties", "RACI matrix enforcement: metric_owner != domain_steward for approval", "preventive", "monthly", "HIGH", 48),
    ("GDPR", "Art. 5(1)(b) - Purpose Limitation", "Agent boundary rules + domain-scoped semantic views", "preventive", "weekly", "HIGH", 24),
    ("GDPR", "Art. 5(1)(c) - Data Minimisation", "Semantic views expose aggregates only; masking policies on PII columns", "preventive", "weekly", "HIGH", 24),
    ("GDPR", "Art. 13/14 - Transparency", "Agent provenance disclosure + audit log of all AI-generated answers", "detective", "daily", "HIGH", 4),
    ("GDPR", "Art. 22 - Automated Decision-Making", "Agent escalation protocol + human-in-the-loop for decisions > $10M", "preventive", "weekly", "MEDIUM", 48),
    ("HIPAA", "164.502 - Minimum Necessary Standard", "Row access policies + column masking + role-scoped semantic views", "preventive", "daily", "HIGH", 4),
    ("HIPAA", "164.312 - Audit Controls", "Full audit trail: question -> resolution -> query -> result -> user", "detective", "daily", "HIGH", 4),
    ("EU_AI_ACT", "Art. 13 - Transparency", "Grounded inference with provenance: metric source, definition, freshness", "preventive", "weekly", "HIGH", 48),
    ("EU_AI_ACT", "Art. 14 - Human Oversight", "Escalation protocol + agent suspension capability + audit dashboard", "preventive", "weekly", "HIGH", 24),
    ("EU_AI_ACT", "Art. 9 - Risk Management", "Agent monitoring KPIs + drift detection + weekly signals report", "detective", "weekly", "MEDIUM", 72),
]


def regulatory_mapping(spark: SparkSession) -> DataFrame:
    columns = [
        ("regulation", _STR),
        ("regulation_section", _STR),
        ("governance_control", _STR),
        ("control_type", _STR),
        ("validation_frequency", _STR),
        ("risk_if_missing", _STR),
        ("remediation_sla_hours", _INT),
        ("last_validated", pa.timestamp("us")),
    ]
    return literal_frame(spark, columns, [(*row, None) for row in CONTROLS])


# --- Fixed values: operating cadences (name, frequency, minutes, automated, owner, escalation trigger)
CADENCES = [
    ("Agent Health Check", "daily", 0, True, "SEMANTIC_PLATFORM_ADMIN", "Grounding rate < 90% OR confidence < 70% OR error rate > 5%"),
    ("Data Quality Monitor", "daily", 0, True, "SEMANTIC_PLATFORM_ADMIN", "Any certified metric source table fails freshness SLA"),
    ("Semantic Signals Triage", "weekly", 30, False, "SEMANTIC_PLATFORM_ADMIN", "Escalation rate > 15% OR same question escalated 5+ times"),
    ("Pipeline Review", "weekly", 30, False, "SEMANTIC_PLATFORM_ADMIN", "Breaking change pending > 3 days without approval"),
    ("Domain Health Review", "monthly", 60, False, "DOMAIN_STEWARD", "Certification rate < 80% OR >20% of metrics unused for 60 days"),
    ("Compliance Checkpoint", "monthly", 60, False, "COMPLIANCE_OFFICER", "Any HIGH-risk control validated as NON-COMPLIANT"),
    ("Governance Council", "quarterly", 120, False, "GOVERNANCE_COUNCIL_ADMIN", "Cross-domain metric conflict unresolved > 30 days"),
    ("Recertification Cycle", "quarterly", 0, True, "DOMAIN_STEWARD", "Metric not recertified within 7 days of due date -> auto-decertify"),
    ("Operating Model Review", "annual", 240, False, "GOVERNANCE_COUNCIL_ADMIN", "N/A - scheduled"),
]


def operating_cadences(spark: SparkSession) -> DataFrame:
    columns = [
        ("cadence_name", _STR),
        ("frequency", _STR),
        ("duration_minutes", _INT),
        ("is_automated", _BOOL),
        ("owner_role", _STR),
        ("escalation_trigger", _STR),
    ]
    return literal_frame(spark, columns, CADENCES)


# --- Fixed values: business glossary (term, definition, owner, rules, often confused with, cross-domain)
GLOSSARY = [
    ("revenue", "Total recognized revenue per ASC 606 standards. Includes all product lines. USD only.", "Finance", 'Default to ASC 606 recognized. If "run rate" -> ARR. If "bookings" -> redirect to Sales.', ["bookings", "billings", "ARR", "MRR"], True),
    ("active customer", "Customer with at least one login in trailing 90 days AND an active contract.", "Customer Success", 'Always 90-day window. "Current customers" = same. "Paying customers" = active + contract_value > 0.', ["registered user", "paying customer", "licensed user"], True),
    ("pipeline", "Total weighted value of open opportunities in stages 2-5. Excludes closed-won and closed-lost.", "Sales", 'Default to current open pipeline. "Historical pipeline" must specify date.', ["forecast", "bookings", "quota"], True),
    ("churn", "Customer with zero platform activity for 90+ consecutive days AND contract not renewed.", "Customer Success", 'Always logo churn unless stated. "At risk" = churn_risk > 0.7 (not churned yet).', ["at-risk", "inactive", "lapsed"], True),
    ("cost", "Actual incurred expense recognized in the period. Excludes capitalized dev costs.", "Finance", 'Default to current month. "Burn rate" = trailing 3mo avg. "COGS" = hosting+support+implementation.', ["spend", "burn", "COGS", "OPEX"], False),
]


def glossary_seed(spark: SparkSession) -> DataFrame:
    columns = [
        ("term", _STR),
        ("canonical_definition", _STR),
        ("domain_owner", _STR),
        ("disambiguation_rules", _STR),
        ("commonly_confused_with", _LIST),
        ("is_cross_domain", _BOOL),
    ]
    return literal_frame(spark, columns, GLOSSARY)


# --- Fixed values: onboarding checklist (kind, order, step, validated how, blocking, hours)
CHECKLIST = [
    ("domain", 1, "Register domain in registry", "automated_query", True, 1),
    ("domain", 2, "Define 3-5 initial metrics", "automated_query", True, 4),
    ("domain", 3, "Create semantic view (dev)", "automated_test", True, 4),
    ("domain", 4, "Write test cases", "automated_query", True, 2),
    ("domain", 5, "Pass promotion gates", "automated_test", True, 8),
    ("domain", 6, "Certify initial metrics", "manual", True, 2),
    ("domain", 7, "Deploy domain agent", "automated_test", False, 8),
    ("domain", 8, "Register terms in glossary", "automated_query", False, 2),
    ("consumer", 1, "Assign consumer role", "automated_query", True, 1),
    ("consumer", 2, "Verify semantic view access", "automated_test", True, 1),
    ("consumer", 3, "Verify agent access", "automated_test", True, 1),
]


def onboarding_checklist(spark: SparkSession) -> DataFrame:
    columns = [
        ("onboarding_type", _STR),
        ("step_order", _INT),
        ("step_name", _STR),
        ("validation_method", _STR),
        ("blocking", _BOOL),
        ("typical_duration_hours", _INT),
    ]
    return literal_frame(spark, columns, CHECKLIST)


# --- Fixed values: alert rules (name, severity, channel, recipients, cooldown hours)
ALERT_RULES = [
    ("Certification Below 80%", "WARNING", "email", ["data-governance@company.com", "cdo@company.com"], 24),
    ("SEV-1 Incident Opened", "CRITICAL", "email", ["cdo@company.com", "platform-oncall@company.com", "data-governance@company.com"], 1),
    ("Metric Expired - Action Required", "WARNING", "email", ["data-governance@company.com"], 24),
    ("Promotion Gate Failure", "INFO", "email", ["platform-team@company.com"], 4),
    ("Domain Review Overdue", "WARNING", "email", ["data-governance@company.com"], 168),
    ("High Rollback Rate (>15%)", "CRITICAL", "email", ["platform-team@company.com", "cdo@company.com"], 24),
]


def alert_rules(spark: SparkSession) -> DataFrame:
    columns = [
        ("rule_name", _STR),
        ("severity", _STR),
        ("notification_channel", _STR),
        ("recipients", _LIST),
        ("cooldown_hours", _INT),
        ("last_fired", pa.timestamp("us")),
        ("is_active", _BOOL),
    ]
    return literal_frame(spark, columns, [(*row, None, True) for row in ALERT_RULES])


# --- Fixed values: conditions of the alert rules (rule, relation, rows looked at, condition over them)
ALERT_TEXTS = [
    ("Certification Below 80%", "metric_catalog", None, "round(count_if(certification_status = 'CERTIFIED') * 100.0 / nullif(count(*), 0), 1) < 80"),
    ("SEV-1 Incident Opened", "incident_log", "severity = 1 and status = 'OPEN' and detected_at > as_of - interval 1 hour", "count(*) > 0"),
    ("Metric Expired - Action Required", "metric_catalog", "certification_status = 'EXPIRED' and updated_at > as_of - interval 24 hours", "count(*) > 0"),
    ("Promotion Gate Failure", "change_log", "status = 'BLOCKED' and deployed_at > as_of - interval 1 hour", "count(*) > 0"),
    ("Domain Review Overdue", "domain_registry", "is_active and next_review_due < to_date(as_of)", "count(*) > 0"),
    ("High Rollback Rate (>15%)", "change_log", "deployed_at > as_of - interval 7 days", "round(count_if(status = 'ROLLED_BACK') * 100.0 / nullif(count(*), 0), 1) > 15"),
]


def alert_texts(spark: SparkSession) -> DataFrame:
    columns = [("rule_name", _STR), ("relation", _STR), ("row_filter", _STR), ("condition", _STR)]
    return literal_frame(spark, columns, ALERT_TEXTS)


# --- Fixed values: tenants (id, name, tier, region, metrics, views), users and the metrics of each tier
TENANTS = [
    ("TNT-001", "Acme Corp", "enterprise", "us-west-2", ["*"], ["*"]),
    ("TNT-002", "Globex Industries", "professional", "us-west-2", ["active_users", "total_sessions", "feature_adoption_rate", "session_duration_p50", "churn_risk_score", "net_dollar_retention"], ["product_usage", "cs_health"]),
    ("TNT-003", "Initech", "free", "eu-west-1", ["active_users", "total_sessions"], ["product_usage"]),
]
TENANT_USERS = [
    ("analyst@acme.com", "TNT-001", "analyst"),
    ("manager@globex.com", "TNT-002", "admin"),
    ("viewer@globex.com", "TNT-002", "viewer"),
    ("user@initech.com", "TNT-003", "admin"),
]
TIER_METRICS = {
    "free": ["active_users", "total_sessions"],
    "starter": ["active_users", "total_sessions", "feature_adoption_rate", "session_duration_p50"],
    "professional": ["active_users", "total_sessions", "feature_adoption_rate", "session_duration_p50", "churn_risk_score", "net_dollar_retention"],
    "enterprise": ["*"],
}


def tenants_seed(spark: SparkSession) -> DataFrame:
    columns = [
        ("tenant_id", _STR),
        ("tenant_name", _STR),
        ("tier", _STR),
        ("data_region", _STR),
        ("metrics_enabled", _LIST),
        ("semantic_views_accessible", _LIST),
        ("is_active", _BOOL),
    ]
    return literal_frame(spark, columns, [(*row, True) for row in TENANTS])


def tenant_users_seed(spark: SparkSession) -> DataFrame:
    return literal_frame(spark, [("user_email", _STR), ("tenant_id", _STR), ("role_within_tenant", _STR)], TENANT_USERS)


def tier_metrics(spark: SparkSession) -> DataFrame:
    rows = [(tier, metric, True) for tier, metrics in TIER_METRICS.items() for metric in metrics]
    return literal_frame(spark, [("tier", _STR), ("metric_name", _STR), ("is_included", _BOOL)], rows)


# --- Fixed values: freshness tiers (name, seconds of latency allowed, source pattern, cost multiplier)
FRESHNESS_TIERS = [
    ("batch", 14400, "scheduled ETL (4h)", 1.0),
    ("near_real_time", 900, "micro-batch (15 min)", 2.5),
    ("streaming", 30, "streaming ingest + refreshed aggregate", 5.0),
    ("real_time", 5, "materialized view on stream", 10.0),
]


def freshness_tiers(spark: SparkSession) -> DataFrame:
    columns = [("tier_name", _STR), ("max_latency_seconds", _INT), ("source_pattern", _STR), ("cost_multiplier", pa.float64())]
    return literal_frame(spark, columns, FRESHNESS_TIERS)


# --- Fixed values: interface limits (tier, per minute, per hour, concurrent, rows, cache seconds)
RATE_LIMITS = [
    ("free", 10, 100, 2, 1000, 300),
    ("starter", 30, 500, 5, 10000, 120),
    ("professional", 100, 5000, 20, 100000, 60),
    ("enterprise", 500, 50000, 100, 1000000, 30),
]


def rate_limits(spark: SparkSession, rows: list[tuple] | None = None) -> DataFrame:
    columns = [
        ("tier", _STR),
        ("max_requests_per_minute", _INT),
        ("max_requests_per_hour", _INT),
        ("max_concurrent_queries", _INT),
        ("max_rows_per_response", _INT),
        ("cache_ttl_seconds", _INT),
    ]
    return literal_frame(spark, columns, rows or RATE_LIMITS)


# --- Fixed values: the 17 roles' direct grants (holder -> roles granted to it)
ROLE_GRANTS = {
    "governance_council_admin": ["domain_steward_finance", "domain_steward_sales", "domain_steward_cs", "domain_steward_product", "domain_steward_hr", "semantic_platform_admin", "compliance_officer"],
    "semantic_platform_admin": ["semantic_developer"],
    "compliance_officer": ["audit_reviewer"],
    "domain_steward_finance": ["metric_consumer_full"],
    "domain_steward_sales": ["metric_consumer_full"],
    "domain_steward_cs": ["metric_consumer_full"],
    "domain_steward_product": ["metric_consumer_full"],
    "domain_steward_hr": ["metric_consumer_full"],
    "metric_consumer_full": ["metric_consumer_internal"],
    "metric_consumer_internal": ["metric_consumer_restricted"],
    "agent_service_executive": ["metric_consumer_full"],
    "agent_service_finance": ["metric_consumer_internal"],
    "agent_service_sales": ["metric_consumer_internal"],
    "agent_service_cs": ["metric_consumer_internal"],
}


def role_grants_seed(spark: SparkSession) -> DataFrame:
    rows = [(holder, role) for holder, roles in ROLE_GRANTS.items() for role in roles]
    return literal_frame(spark, [("role", _STR), ("granted_role", _STR)], rows)


# --- Fixed values: first published glossary versions (version, term, definition)
GLOSSARY_VERSIONS = [
    (1, "revenue", "Total recognized revenue per ASC 606. All product lines. USD."),
    (2, "active_users", "Unique users with at least 1 meaningful action per day."),
    (3, "churn", "Zero activity 90+ days AND contract not renewed at term end."),
]


def glossary_versions_seed(spark: SparkSession) -> DataFrame:
    return literal_frame(spark, [("version_id", _INT), ("term", _STR), ("canonical_definition", _STR)], GLOSSARY_VERSIONS)
