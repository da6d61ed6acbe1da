"""Tenancy, metric interface, streams and federation with their SQL twins."""

from datetime import date

from pyspark.sql import functions as F

from tallyward.context import Principal, scratch_path
from tallyward.operators import access, federation, tenancy
from tallyward.sources import seeds, tables
from tallyward.sources import testdata as t
from tallyward.streaming import page_loads, revenue_refresh

from .common import oracle, query
from .metrics import ORACLE as METRICS_ORACLE

DAY, NOW, EVENT_TIME = t.FINANCE_DAY, t.FINANCE_TIME, t.EVENT_TIME
ADMIN = Principal("root", "ACCOUNTADMIN")
MEMBER = Principal("user101@example.com", "ANALYST")


def _limits(s):
    """Two requests a minute and six an hour for every tier: the fixture's traffic is thin."""
    return seeds.rate_limits(s, [(tier, 2, 6, 1, 1000, 60) for tier in ("free", "starter", "professional", "enterprise")])


def _decisions(s, d):
    return access.query_metric_batch(t.metric_api_requests(s, d), t.metric_catalog(s, d), t.tenants(s, d), seeds.rate_limits(s))


def _cells(s, d, unit):
    return tenancy.customer_cells_of_lines(t.tenant_lines(s, d), t.tenant_buyers(s, d), t.tenant_products(s, d), unit)


def _summary(s, d):
    return tenancy.bi_summary_of_cells(_cells(s, d, "day"), NOW)


def _safe(s, d):
    return tenancy.safe_aggregates_of_cells(_cells(s, d, "month"))


def _page_loads(s, d):
    return page_loads.page_load_metrics(t.page_events(s, d), EVENT_TIME)


def _rounded(df):
    return df.withColumns({c: F.round(c, 3) for c in df.columns if c.startswith("p9")})


def _aged(s, d):
    return page_loads.page_load_with_freshness(_page_loads(s, d), EVENT_TIME)


def _page_load_stream(s, d):
    out = scratch_path(s, "page-loads")
    stream = page_loads.start_page_load_stream(
        t.page_event_stream(s, d), f"{out}/data", f"{out}/checkpoint", trigger={"availableNow": True}
    )
    stream.awaitTermination()
    return _rounded(page_loads.read_page_load_metrics(s, f"{out}/data", EVENT_TIME))


def _page_load_compacted(s, d):
    """The stream's table after three waves of events, each with events of all days, its days compacted after each wave."""
    root, events = scratch_path(s, "page-loads-compacted"), t.page_events(s, d)
    for wave in range(3):
        events.filter(F.pmod(F.hash("event_id"), F.lit(3)) == wave).write.mode("append").parquet(f"{root}/in")
        arriving = s.readStream.schema(events.schema).parquet(f"{root}/in")
        zoned = arriving.withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp"))
        page_loads.start_page_load_stream(
            zoned, f"{root}/data", f"{root}/checkpoint", watermark="60 days", trigger={"availableNow": True}
        ).awaitTermination()
        page_loads.compact_page_loads(s, f"{root}/data", EVENT_TIME.date())
        page_loads.vacuum_page_loads(s, f"{root}/data")
    return _rounded(page_loads.read_page_load_metrics(s, f"{root}/data", EVENT_TIME, hours=24 * 31))


LOGGED = ["endpoint", "method", "metric_requested", "tenant_id", "response_status", "response_time_ms", "served_from"]


def _appended_log(s, d):
    """The request log as it reads after being appended to its table."""
    root, name = scratch_path(s, "log"), "multi_tenant.semantic.api_request_log"
    tables.append_rows(access.request_log_rows(_decisions(s, d)).select(LOGGED), root, name, NOW)
    return tables.read_table(s, root, name).select(LOGGED)


def _incremental(s, d):
    out = scratch_path(s, "revenue-cells")
    rev, cust = t.fct_revenue(s, d), t.dim_customer(s, d)
    revenue_refresh.refresh_revenue_cells(rev, cust, out, date(2001, 6, 15))
    revenue_refresh.refresh_revenue_cells(rev, cust, out, DAY, recent_months=2)
    return revenue_refresh.read_revenue_cells(s, out, DAY)


def _sla(s, d):
    tier = F.when(F.col("page_name") == "/error", "batch").when(F.col("page_name") == "/view", "streaming").when(F.col("page_name") == "/signup", "undeclared")
    return page_loads.freshness_sla(
        _aged(s, d).withColumn("tier_name", tier.otherwise("near_real_time")), seeds.freshness_tiers(s)
    ).select("metric_minute", "tenant_id", "page_name", "tier_name", "data_age_seconds", "max_latency_seconds", "within_sla")


def _inventory(s, d):
    return tenancy.platform_inventory(
        {
            "Tenants": t.tenants(s, d),
            "Tenant Users": t.tenant_users(s, d),
            "Revenue Rows": t.tenant_revenue(s, d),
            "Streaming Events": t.page_events(s, d),
            "Aggregate Records": _page_loads(s, d),
            "Glossary Versions": t.glossary_versions(s, d),
        }
    )


QUERIES = {
    "tenant_isolation": query(lambda s, d: access.tenant_isolation(t.tenant_revenue(s, d), t.tenant_users(s, d), MEMBER)),
    "tenant_isolation_usage": query(lambda s, d: access.tenant_isolation(t.tenant_usage(s, d), t.tenant_users(s, d), MEMBER)),
    "tenant_row_counts_admin": query(
        lambda s, d: access.tenant_row_counts(t.tenant_revenue(s, d), t.tenant_users(s, d), ADMIN)
    ),
    "tenant_row_counts_member": query(
        lambda s, d: access.tenant_row_counts(t.tenant_revenue(s, d), t.tenant_users(s, d), MEMBER)
    ),
    "can_access_metric": query(
        lambda s, d: access.can_access_metric(t.access_requests(s, d), t.tenants(s, d), t.tenant_users(s, d))
    ),
    "tier_entitlements": query(lambda s, d: access.tier_entitlements(t.tenants(s, d), seeds.tier_metrics(s))),
    "query_metric_batch": query(_decisions),
    "query_metric_log": query(lambda s, d: access.request_log_rows(_decisions(s, d))),
    "appended_request_log": query(_appended_log),
    "rate_limit_audit": query(lambda s, d: access.rate_limit_audit(t.api_request_log(s, d), t.tenants(s, d), _limits(s))),
    "api_status_summary": query(lambda s, d: access.api_status_summary(t.api_request_log(s, d))),
    "bi_revenue_summary": query(_summary),
    "bi_tenant_totals": query(lambda s, d: tenancy.bi_tenant_totals(_summary(s, d))),
    "gdpr_safe_aggregates": query(_safe),
    "k_anonymity_check": query(lambda s, d: tenancy.k_anonymity_check(_safe(s, d))),
    "platform_inventory": query(_inventory),
    "page_load_metrics": query(lambda s, d: _rounded(_page_loads(s, d))),
    "page_load_metrics_all_days": query(
        lambda s, d: _rounded(page_loads.page_load_metrics(t.page_events(s, d), EVENT_TIME, hours=24 * 31))
    ),
    "page_load_metrics_stream": query(_page_load_stream),
    "page_load_metrics_compacted": query(_page_load_compacted),
    "page_load_with_freshness": query(lambda s, d: _rounded(_aged(s, d))),
    "freshness_distribution": query(lambda s, d: page_loads.freshness_distribution(_aged(s, d))),
    "freshness_sla": query(_sla),
    "catalog_freshness": query(lambda s, d: page_loads.catalog_freshness(t.metric_catalog(s, d), NOW)),
    "daily_revenue_metrics_incremental": query(_incremental),
    "glossary_latest": query(lambda s, d: federation.glossary_latest(t.glossary_versions(s, d))),
    "spoke_resolve_metrics": query(lambda s, d: federation.spoke_resolve_metrics(t.resolve_requests(s, d), t.metric_catalog(s, d))),
    "glossary_sync": query(lambda s, d: federation.glossary_sync(t.spokes(s, d), t.glossary_versions(s, d))),
    "federation_health": query(
        lambda s, d: federation.federation_health(
            t.metric_catalog(s, d), t.domain_registry(s, d), t.business_glossary(s, d), t.glossary_versions(s, d)
        )
    ),
}

_MEMBER = "tenant_id IN (SELECT tenant_id FROM tenant_users WHERE user_email = 'user101@example.com')"
_RATE = ", ".join(f"('{r[0]}', {r[1]})" for r in seeds.RATE_LIMITS)


def _page_sql(since="TIMESTAMP '2024-01-30 00:00:00'"):
    return f"""
SELECT date_trunc('minute', event_timestamp) AS metric_minute, tenant_id, page_name, count(*) AS page_views,
       CAST(sum(load_time_ms) AS DOUBLE) / count(*) AS avg_load_time_ms,
       round(quantile_cont(load_time_ms, 0.95), 3) AS p95_load_time_ms,
       round(quantile_cont(load_time_ms, 0.99), 3) AS p99_load_time_ms,
       count(*) FILTER (WHERE load_time_ms > 3000) AS slow_loads
FROM page_events WHERE event_timestamp >= {since} GROUP BY 1, 2, 3"""


_AGED = f"""
SELECT *, CASE WHEN data_age_seconds <= 60 THEN 'LIVE' WHEN data_age_seconds <= 300 THEN 'RECENT'
               WHEN data_age_seconds <= 900 THEN 'DELAYED' ELSE 'STALE' END AS freshness_status
FROM (SELECT *, date_diff('second', metric_minute, TIMESTAMP '2024-01-31 00:00:00') AS data_age_seconds FROM ({_page_sql()}))"""
_SUMMARY = """
SELECT revenue_date AS date, tenant_id, product_line, region, CAST(sum(amount_usd) AS DOUBLE) AS total_revenue,
       count(DISTINCT customer_id) AS customer_count, count(*) AS transaction_count, 'finance_revenue' AS source_semantic_view,
       'CERTIFIED' AS certification_status, TIMESTAMP '2001-07-15 00:00:00' AS query_timestamp
FROM tenant_revenue GROUP BY 1, 2, 3, 4"""
_SAFE = """
SELECT CAST(date_trunc('month', revenue_date) AS DATE) AS period, tenant_id, region, product_line,
       CAST(sum(amount_usd) AS DOUBLE) AS total_revenue, count(DISTINCT customer_id) AS customer_count,
       CAST(sum(amount_usd) AS DOUBLE) / count(*) AS avg_transaction_value, 'AGGREGATE' AS data_classification,
       'multi_tenant.semantic.fct_revenue' AS source_table
FROM tenant_revenue GROUP BY 1, 2, 3, 4 HAVING count(DISTINCT customer_id) >= 5"""
_DECIDE = f"""
limits(tier, rpm) AS (VALUES {_RATE}),
x AS (SELECT r.*, CASE WHEN NOT EXISTS (SELECT 1 FROM metric_catalog c WHERE c.metric_name = r.metric_name
                                          AND certification_status = 'CERTIFIED') THEN 404
                       WHEN NOT EXISTS (SELECT 1 FROM tenants n WHERE n.tenant_id = r.tenant_id AND n.is_active
                              AND (list_contains(n.metrics_enabled, r.metric_name) OR list_contains(n.metrics_enabled, '*'))) THEN 403
                       ELSE 200 END AS status, n.tier, l.rpm
      FROM metric_api_requests r LEFT JOIN tenants n ON n.tenant_id = r.tenant_id LEFT JOIN limits l ON l.tier = n.tier)"""

_TIERS = ", ".join(f"('{tier}', '{metric}')" for tier, metrics in seeds.TIER_METRICS.items() for metric in metrics)

ORACLE = {
    "tenant_isolation": f"""
SELECT tenant_id, revenue_date, product_line, region, CAST(amount_usd AS DOUBLE) AS amount_usd, customer_id
FROM tenant_revenue WHERE {_MEMBER}""",
    "tenant_isolation_usage": f"""
SELECT tenant_id, event_id, event_date, user_id, feature_name, session_duration_seconds FROM tenant_usage WHERE {_MEMBER}""",
    "tenant_row_counts_admin": "SELECT tenant_id, count(*) AS total_rows FROM tenant_revenue GROUP BY 1",
    "tenant_row_counts_member": f"SELECT tenant_id, count(*) AS total_rows FROM tenant_revenue WHERE {_MEMBER} GROUP BY 1",
    "can_access_metric": """
SELECT r.*, EXISTS (SELECT 1 FROM tenants n JOIN tenant_users u ON n.tenant_id = u.tenant_id
                    WHERE u.user_email = r.user_email AND n.is_active
                      AND (list_contains(n.metrics_enabled, r.metric_name) OR list_contains(n.metrics_enabled, '*'))) AS can_access
FROM access_requests r""",
    "tier_entitlements": f"""
WITH tm(tier, metric_name) AS (VALUES {_TIERS}),
     e AS (SELECT DISTINCT tenant_id, tier, unnest(metrics_enabled) AS metric_name FROM tenants),
     due AS (SELECT n.tenant_id, n.tier, tm.metric_name FROM tenants n JOIN tm ON n.tier = tm.tier)
SELECT tenant_id, tier, metric_name,
       CASE WHEN e.tenant_id IS NULL AND NOT EXISTS (SELECT 1 FROM e a WHERE a.tenant_id = due.tenant_id AND a.metric_name = '*') THEN 'MISSING'
            WHEN due.tenant_id IS NULL AND NOT EXISTS (SELECT 1 FROM tm WHERE tm.tier = e.tier AND tm.metric_name = '*') THEN 'EXCESS'
            ELSE 'GRANTED' END AS entitlement
FROM e FULL OUTER JOIN due USING (tenant_id, tier, metric_name)""",
    "query_metric_batch": f"""
WITH {_DECIDE}
SELECT request_id, metric_name AS metric, tenant_id, CAST(status AS BIGINT) AS status,
       CASE status WHEN 404 THEN 'METRIC_NOT_FOUND_OR_NOT_CERTIFIED' WHEN 403 THEN 'ACCESS_DENIED' END AS error,
       CASE WHEN status = 200 THEN tier END AS tier, CAST(CASE WHEN status = 200 THEN rpm END AS BIGINT) AS rate_limit_rpm,
       CASE WHEN status = 200 THEN 'CERTIFIED' END AS certification, CASE WHEN status = 200 THEN 'live' END AS freshness,
       CASE status WHEN 404 THEN 'Metric ' || metric_name || ' is not available. Only certified metrics can be queried via API.'
                   WHEN 403 THEN 'Your plan does not include access to metric: ' || metric_name END AS message,
       CASE WHEN status = 200 THEN 'Production implementation returns actual metric data from semantic view.' END AS note,
       CASE WHEN status = 403 THEN 'https://yourcompany.com/pricing' END AS upgrade_url
FROM x""",
    "query_metric_log": f"""
WITH {_DECIDE}
SELECT request_id, '/v1/metrics/' || metric_name AS endpoint, 'GET' AS method, metric_name AS metric_requested, tenant_id,
       CAST(status AS BIGINT) AS response_status, CAST(CASE WHEN status = 200 THEN 45 END AS BIGINT) AS response_time_ms,
       CASE WHEN status = 200 THEN 'live_query' ELSE 'rejected' END AS served_from
FROM x""",
    "rate_limit_audit": """
WITH m AS (SELECT tenant_id, 'minute' AS window_kind, date_trunc('minute', requested_at) AS window_start, count(*) AS requests,
                  CASE WHEN tenant_id <> 'TNT-UNKNOWN' THEN 2 ELSE 0 END AS allowed FROM api_request_log GROUP BY 1, 2, 3
           UNION ALL
           SELECT tenant_id, 'hour', date_trunc('hour', requested_at), count(*), CASE WHEN tenant_id <> 'TNT-UNKNOWN' THEN 6 ELSE 0 END FROM api_request_log GROUP BY 1, 2, 3)
SELECT m.tenant_id, n.tier, window_kind, window_start, requests, CAST(allowed AS BIGINT) AS allowed
FROM m LEFT JOIN tenants n ON m.tenant_id = n.tenant_id WHERE requests > allowed""",
    "api_status_summary": """
SELECT CAST(response_status AS BIGINT) AS response_status, count(*) AS request_count FROM api_request_log GROUP BY 1""",
    "bi_revenue_summary": _SUMMARY,
    "bi_tenant_totals": """
SELECT tenant_id, count(*) AS days_of_data, CAST(sum(v) AS DOUBLE) AS total
FROM (SELECT tenant_id, sum(amount_usd) AS v FROM tenant_revenue GROUP BY revenue_date, tenant_id, product_line, region) GROUP BY 1""",
    "gdpr_safe_aggregates": _SAFE,
    "k_anonymity_check": f"SELECT count(*) AS aggregate_rows, min(customer_count) AS min_k_anonymity FROM ({_SAFE})",
    "platform_inventory": " UNION ALL ".join(
        [
            f"SELECT '{label}' AS category, CAST((SELECT count(*) FROM {source}) AS VARCHAR) AS value"
            for label, source in [
                ("Tenants", "tenants"),
                ("Tenant Users", "tenant_users"),
                ("Revenue Rows", "tenant_revenue"),
                ("Streaming Events", "page_events"),
                ("Aggregate Records", f"({_page_sql()})"),
                ("Glossary Versions", "glossary_versions"),
            ]
        ]
        + [f"SELECT '{k}', '{v}'" for k, v in tenancy.CONFIGURED.items()]
    ),
    "page_load_metrics": _page_sql(),
    "page_load_metrics_all_days": _page_sql("TIMESTAMP '2023-12-31 00:00:00'"),
    "page_load_metrics_stream": _page_sql(),
    "page_load_metrics_compacted": _page_sql("TIMESTAMP '2023-12-31 00:00:00'"),
    "page_load_with_freshness": _AGED,
    "freshness_distribution": f"""
SELECT freshness_status, count(*) AS records, min(data_age_seconds) AS min_age_sec, max(data_age_seconds) AS max_age_sec
FROM ({_AGED}) GROUP BY 1""",
    "freshness_sla": f"""
WITH a AS (SELECT *, CASE page_name WHEN '/error' THEN 'batch' WHEN '/view' THEN 'streaming' WHEN '/signup' THEN 'undeclared' ELSE 'near_real_time' END AS tier_name
           FROM ({_AGED})),
     l(tier_name, s) AS (VALUES ('batch', 14400), ('near_real_time', 900), ('streaming', 30), ('real_time', 5))
SELECT metric_minute, tenant_id, page_name, a.tier_name, data_age_seconds, CAST(s AS BIGINT) AS max_latency_seconds,
       data_age_seconds <= s AS within_sla
FROM a LEFT JOIN l ON a.tier_name = l.tier_name""",
    "catalog_freshness": """
SELECT metric_fqn, freshness_sla_hours, date_diff('hour', updated_at, TIMESTAMP '2001-07-15 00:00:00') AS age_hours,
       CASE WHEN date_diff('hour', updated_at, TIMESTAMP '2001-07-15 00:00:00') <= freshness_sla_hours
            THEN 'FRESH' ELSE 'STALE' END AS freshness_status
FROM metric_catalog""",
    "glossary_latest": """
WITH v AS (SELECT *, row_number() OVER (PARTITION BY term ORDER BY version_id DESC) AS k,
                  lead(version_id) OVER (PARTITION BY term ORDER BY version_id DESC) AS supersedes_version,
                  count(*) OVER (PARTITION BY term) AS versions
           FROM glossary_versions)
SELECT term, version_id, canonical_definition, supersedes_version, versions FROM v WHERE k = 1""",
    "spoke_resolve_metrics": """
SELECT r.request_id, r.metric_name, CASE WHEN c.metric_name IS NULL THEN 'NOT_FOUND' ELSE 'RESOLVED' END AS status,
       'hub_direct' AS source, CAST(CASE WHEN c.metric_name IS NOT NULL THEN 0 END AS BIGINT) AS replica_lag_seconds,
       c.certification_status, c.domain, c.business_definition, c.semantic_view_fqn, c.certification_date, CAST(c.data_quality_score AS DOUBLE) AS data_quality_score
FROM resolve_requests r LEFT JOIN metric_catalog c ON c.metric_name = r.metric_name AND c.certification_status = 'CERTIFIED'""",
    "glossary_sync": """
WITH h AS (SELECT max(version_id) AS hub_version FROM glossary_versions)
SELECT spoke, local_version, hub_version, CASE WHEN hub_version > local_version THEN 'OUT_OF_SYNC' ELSE 'IN_SYNC' END AS status,
       CASE WHEN hub_version > local_version THEN hub_version - local_version ELSE 0 END AS versions_behind
FROM spokes CROSS JOIN h""",
    "federation_health": """
SELECT 'HUB' AS node, 'governance' AS database_name,
       (SELECT count(*) FROM metric_catalog WHERE certification_status = 'CERTIFIED') AS certified_metrics,
       (SELECT count(*) FROM domain_registry WHERE is_active) AS active_domains,
       (SELECT count(*) FROM business_glossary) AS glossary_terms,
       (SELECT max(version_id) FROM glossary_versions) AS glossary_version,
       CAST(0 AS BIGINT) AS replication_lag_seconds, 'PRIMARY' AS replication_role""",
}
ORACLE["appended_request_log"] = f"WITH {_DECIDE.strip()}, y AS ({ORACLE['query_metric_log'].split(_DECIDE)[1]}) SELECT {', '.join(LOGGED)} FROM y"
ORACLE = {name: oracle(sql) for name, sql in ORACLE.items()}
ORACLE["daily_revenue_metrics_incremental"] = METRICS_ORACLE["daily_revenue_metrics"]
