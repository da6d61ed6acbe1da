"""Declared schemas of the tables that jobs append to or publish, and of the event stream.

``!`` after a name marks a column that must not be NULL. Parquet keeps no such rule, so
``operators.quality.constraint_violations`` checks it. Tables that are only read bring their
schema with their Parquet files.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: table name -> columns, in order
TABLES: dict[str, str] = {
    "governance.semantic.certification_audit": (
        "audit_id string, metric_name! string, semantic_view! string, action! string, performed_by! string, "
        "action_date timestamp, previous_definition string, new_definition string, reason string"
    ),
    "governance.devops.change_log": (
        "change_id string, asset_type! string, asset_fqn! string, change_type! string, "
        "source_environment! string, target_environment string, git_commit_sha string, git_branch string, "
        "git_pr_number int, yaml_before string, yaml_after string, change_description! string, "
        "requested_by! string, approved_by array<string>, approval_timestamp timestamp, deployed_at timestamp, "
        "rollback_of string, validation_results variant, is_breaking_change boolean, impact_assessment string, "
        "status string"
    ),
    "governance.operating_model.metric_catalog": (
        "metric_id string, metric_fqn! string, domain! string, sub_domain string, metric_name! string, "
        "business_definition! string, technical_definition string, semantic_view_fqn! string, data_type! string, "
        "aggregation_method string, time_grain string, owner_role! string, steward_role! string, "
        "certification_status string, certification_date date, recertification_due date, "
        "last_queried_at timestamp, query_count_30d int, consumer_count_30d int, agent_count_using int, "
        "data_quality_score decimal(5,2), freshness_sla_hours int, has_verified_query boolean, "
        "tags array<string>, created_at timestamp, updated_at timestamp"
    ),
    "governance.operating_model.domain_registry": (
        "domain_id string, domain_name! string, domain_description string, steward_role! string, "
        "steward_user! string, backup_steward string, metric_count int, semantic_view_count int, "
        "agent_count int, certification_rate decimal(5,2), avg_data_quality decimal(5,2), "
        "governance_maturity string, onboarding_date date, last_governance_review date, next_review_due date, "
        "is_active boolean"
    ),
    "multi_tenant.streaming.page_events": (
        "event_id string, tenant_id! string, user_id! string, page_name! string, load_time_ms! int, "
        "event_timestamp timestamp"
    ),
    "multi_tenant.semantic.api_request_log": (
        "request_id string, endpoint! string, method! string, metric_requested string, "
        "dimensions_requested array<string>, filters_applied variant, tenant_id string, api_key_hash string, "
        "response_status int, response_time_ms int, rows_returned int, served_from string, "
        "data_freshness_seconds int, requested_at timestamp"
    ),
}


def _columns(table: str) -> list[tuple[str, str, bool]]:
    text, depth, part, parts = TABLES[table], 0, "", []
    for ch in text:
        depth += (ch in "<(") - (ch in ">)")
        if ch == "," and depth == 0:
            parts.append(part)
            part = ""
        else:
            part += ch
    pairs = [p.strip().split(" ", 1) for p in [*parts, part]]
    return [(name.rstrip("!"), kind, name.endswith("!")) for name, kind in pairs]


def schema(table: str) -> T.StructType:
    """Explicit schema for reading. Free-form columns are JSON text; times are zone-free."""
    types = {"variant": "string", "timestamp": "timestamp_ntz"}
    return T.StructType.fromDDL(", ".join(f"`{name}` {types.get(kind, kind)}" for name, kind, _ in _columns(table)))


def required(table: str) -> list[str]:
    """Columns that must not be NULL."""
    return [name for name, _, needed in _columns(table) if needed]
