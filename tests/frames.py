"""Literal tables for the scenarios."""

from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

NOW = datetime(2025, 11, 17, 12, 0)  # a Monday
DAY = NOW.date()


def ago(**kw):
    return NOW - timedelta(**kw)


def frame(spark, ddl, rows):
    """Rows under a DDL schema; timestamps become zone-free, like the stored columns."""
    names = [part.strip().split(" ", 1)[0] for part in _split(ddl)]
    kinds = [part.strip().split(" ", 1)[1] for part in _split(ddl)]
    text = [tuple(_text(v, k) for v, k in zip(row, kinds)) for row in rows]
    loose = ", ".join(f"{n} {'string' if _textual(k) else k}" for n, k in zip(names, kinds))
    df = spark.createDataFrame(text, loose)
    return df.select(*[F.col(n).cast(k) if _textual(k) else F.col(n) for n, k in zip(names, kinds)])


def _textual(kind):
    return kind.startswith(("timestamp", "date", "decimal"))


def _text(value, kind):
    if value is None or not _textual(kind):
        return value
    return value.isoformat(sep=" ") if isinstance(value, datetime) else value.isoformat() if isinstance(value, date) else str(value)


def _split(ddl):
    depth, part, out = 0, "", []
    for ch in ddl:
        depth += (ch in "<(") - (ch in ">)")
        if ch == "," and depth == 0:
            out.append(part)
            part = ""
        else:
            part += ch
    return [*out, part]


def domains(spark):
    ddl = (
        "domain_id string, domain_name string, steward_role string, steward_user string, metric_count bigint,"
        " semantic_view_count bigint, agent_count bigint, certification_rate decimal(5,2), avg_data_quality decimal(5,2),"
        " governance_maturity string, last_governance_review date, next_review_due date, is_active boolean"
    )
    return frame(
        spark,
        ddl,
        [
            ("D1", "Marketing", "DOMAIN_STEWARD_MARKETING", "SARAH_CHEN", 5, 1, 1, 80.0, 97.5, "GROWTH", None, date(2025, 12, 17), True),
            ("D2", "Finance", "DOMAIN_STEWARD_FINANCE", "JAMES_WONG", 12, 3, 2, 95.0, 99.2, "ENTERPRISE", None, date(2026, 1, 17), True),
        ],
    )


CATALOG_DDL = (
    "metric_id string, metric_fqn string, domain string, sub_domain string, metric_name string, business_definition string,"
    " semantic_view_fqn string, aggregation_method string, time_grain string, owner_role string, steward_role string,"
    " certification_status string, certification_date date, recertification_due date, last_queried_at timestamp_ntz,"
    " query_count_30d bigint, consumer_count_30d bigint, agent_count_using bigint, data_quality_score decimal(5,2),"
    " freshness_sla_hours bigint, has_verified_query boolean, tags array<string>, created_at timestamp_ntz, updated_at timestamp_ntz"
)


def catalog_row(n, name, view, status, due, queried, queries, consumers, agents, quality, domain="Marketing", tags=None, **over):
    row = {
        "metric_id": f"M{n}",
        "metric_fqn": f"{domain.lower()}.semantic.{name}",
        "domain": domain,
        "sub_domain": None,
        "metric_name": name,
        "business_definition": f"Definition of {name}",
        "semantic_view_fqn": view,
        "aggregation_method": "AVG",
        "time_grain": "monthly",
        "owner_role": "METRIC_OWNER_MARKETING",
        "steward_role": "DOMAIN_STEWARD_MARKETING",
        "certification_status": status,
        "certification_date": None,
        "recertification_due": due,
        "last_queried_at": queried,
        "query_count_30d": queries,
        "consumer_count_30d": consumers,
        "agent_count_using": agents,
        "data_quality_score": quality,
        "freshness_sla_hours": 4,
        "has_verified_query": status == "CERTIFIED",
        "tags": tags,
        "created_at": ago(days=10),
        "updated_at": ago(days=10),
    }
    row.update(over)
    return tuple(row.values())


def catalog(spark, extra=()):
    demand, campaigns = "analytics.semantic.marketing_demand", "analytics.semantic.marketing_campaigns"
    rows = [
        catalog_row(1, "customer_acquisition_cost", demand, "CERTIFIED", DAY + timedelta(60), ago(hours=2), 847, 34, 2, 98.5),
        catalog_row(2, "conversion_rate", demand, "CERTIFIED", DAY + timedelta(60), ago(hours=1), 523, 28, 2, 99.1),
        catalog_row(3, "pipeline_sourced", demand, "CERTIFIED", DAY + timedelta(75), ago(hours=3), 312, 22, 1, 97.8),
        catalog_row(4, "campaign_roi", campaigns, "PENDING", None, ago(days=5), 45, 8, 0, 94.2),
        catalog_row(5, "email_engagement", campaigns, "DRAFT", None, None, 0, 0, 0, None),
    ]
    return frame(spark, CATALOG_DDL, [*rows, *extra])


LOG_DDL = (
    "change_id string, asset_type string, asset_fqn string, requested_by string, approved_by array<string>,"
    " approval_timestamp timestamp_ntz, deployed_at timestamp_ntz, is_breaking_change boolean, status string"
)


def change_log(spark, extra=()):
    rows = [
        ("C1", "semantic_view", "analytics.semantic.marketing_demand", "SARAH_CHEN", ["JAMES_PLATFORM_ADMIN", "SARAH_CHEN"], ago(hours=48), NOW, False, "DEPLOYED"),
        ("C2", "agent", "analytics.agents.marketing_agent", "SARAH_CHEN", ["JAMES_PLATFORM_ADMIN", "SARAH_CHEN", "COMPLIANCE_TEAM"], ago(hours=24), NOW, False, "DEPLOYED"),
    ]
    return frame(spark, LOG_DDL, [*rows, *extra])


INCIDENT_DDL = (
    "incident_id string, severity bigint, affected_metrics array<string>, detected_at timestamp_ntz, status string,"
    " time_to_detect_minutes bigint, time_to_mitigate_minutes bigint, time_to_resolve_minutes bigint"
)


def incidents(spark, extra=()):
    return frame(
        spark, INCIDENT_DDL, [("I1", 2, ["customer_acquisition_cost"], ago(hours=8), "RESOLVED", 15, 120, 360), *extra]
    )


def requests(spark):
    ddl = (
        "request_id string, status string, urgency string, submitted_at timestamp_ntz, sla_deadline timestamp_ntz,"
        " decision_date timestamp_ntz"
    )
    return frame(spark, ddl, [("R1", "SUBMITTED", "STANDARD", NOW, NOW + timedelta(hours=72), None)])


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=str)


def one(df):
    found = df.collect()
    assert len(found) == 1, found
    return found[0]
