"""Registered queries of the incremental forms: ledgers, mergeable states, published versions, payloads and SQL functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyward.context import scratch_path
from tallyward.functions import dates as D
from tallyward.functions import payloads
from tallyward.operators import distinct_cells, lifecycle
from tallyward.sources import changes, sql_functions
from tallyward.sources import testdata as t
from tallyward.streaming import quantile_states
from tallyward.streaming.page_ledger import PageLedger
from tallyward.streaming.revenue_ledger import RevenueLedger, signed

from .common import oracle, query
from .lifecycle import ORACLE as LIFECYCLE_ORACLE
from .metrics import ORACLE as METRICS_ORACLE
from .tenancy import MEMBER
from .tenancy import ORACLE as TENANCY_ORACLE
from .tenancy import _rounded as rounded_loads

DAY, EVENT_TIME = t.FINANCE_DAY, t.EVENT_TIME
CATALOG = "governance.operating_model.metric_catalog"


def _ledger(s, d):
    ledger, cust = RevenueLedger(s, scratch_path(s, "revenue-ledger")), t.dim_customer(s, d)
    for delta, batch in t.revenue_deliveries(s, d):
        ledger.apply(delta, cust, batch)
    return ledger


def _cells(s, d):
    """Monthly cells of distinct customers, stored once; what follows reads only them."""
    path = scratch_path(s, "customer-cells")
    cust, rev = t.dim_customer(s, d), t.fct_revenue(s, d)
    numbering = distinct_cells.extend_numbering(cust.select(F.col("customer_id").alias("id")), f"{path}/numbering", 1)
    tasks = distinct_cells.tasks_for(numbering)
    by_month = rev.select(F.trunc("recognized_date", "month").alias("month"), "customer_id").repartition(tasks, "month", "customer_id").distinct()
    rows = by_month.repartition(tasks, "customer_id").join(cust.select("customer_id", "segment", "region").hint("shuffle_hash"), "customer_id")
    keys = {"month": F.col("month"), "segment": F.col("segment"), "region": F.col("region")}
    distinct_cells.distinct_cells(rows, numbering, keys, "customer_id").write.parquet(f"{path}/cells")
    return s.read.parquet(f"{path}/cells")


def _customer_rollup(s, d):
    cells = _cells(s, d)
    parts = []
    for grain in ("quarter", "year"):
        for level, names in (("segment and region", ["segment", "region"]), ("segment", ["segment"]), ("all", [])):
            keys = {"period": F.trunc("month", grain)} | {n: F.col(n) for n in names}
            counted = distinct_cells.distinct_count(cells, keys, "customer_count")
            for n in ("segment", "region"):
                counted = counted.withColumn(n, F.col(n) if n in names else F.lit(None).cast("string"))
            parts.append(counted.select(F.lit(grain).alias("grain"), F.lit(level).alias("level"), "period", "segment", "region", "customer_count"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _catalog_versions(s, d):
    """Two published versions of the catalog: the second has zombies flagged, deprecated metrics gone and certified ones twice."""
    root = scratch_path(s, "catalog-versions")
    cat = t.metric_catalog(s, d)
    changes.publish_version(cat, root, CATALOG, 1, ["metric_fqn"])
    flagged = lifecycle.flag_zombies(cat, DAY).filter(F.col("certification_status") != "DEPRECATED")
    changes.publish_version(flagged.unionByName(flagged.filter(F.col("certification_status") == "CERTIFIED")), root, CATALOG, 2, ["metric_fqn"])
    return root


def _page_ledger(s, d):
    """The ledger after all waves of events, one micro-batch each, with closed days compacted."""
    root = scratch_path(s, "page-ledger")
    arriving, ledger = t.arriving_page_events(s, d), PageLedger(s, f"{root}/ledger")
    schema = arriving.drop("wave").schema
    for wave in range(4):
        arriving.filter(F.col("wave") == wave).drop("wave").write.mode("append").parquet(f"{root}/in")
        stream = s.readStream.schema(schema).parquet(f"{root}/in")
        ledger.start(stream, f"{root}/checkpoint", {"availableNow": True}).awaitTermination()
        ledger.compact()
    return ledger, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)


def _accounting(s, d):
    ledger, columns = _page_ledger(s, d)
    late = ledger.late_events(columns).groupBy(F.col("event_timestamp").cast("date").alias("metric_date")).agg(F.count(F.lit(1)).alias("rows_late"))
    on_time = ledger.read(EVENT_TIME, 24 * 31).groupBy(F.col("metric_minute").cast("date").alias("metric_date")).agg(F.sum("page_views").alias("rows_on_time"))
    return on_time.join(late, "metric_date", "full_outer").select("metric_date", F.coalesce("rows_on_time", F.lit(0)).alias("rows_on_time"), F.coalesce("rows_late", F.lit(0)).alias("rows_late"))


def _quantiles(s, d):
    """Whether the ranks of the merged sketches' p95 and p99 of each hour lie within the stated error."""
    events, hour = t.page_events(s, d), F.date_trunc("hour", "metric_minute").cast("timestamp_ntz")
    merged = quantile_states.merged_states(quantile_states.minute_states(events), hour, "metric_hour")
    named = quantile_states.quantiles(merged, {"p95": 0.95, "p99": 0.99}).drop("state")
    true_hour, error = F.date_trunc("hour", "event_timestamp").cast("timestamp_ntz"), quantile_states.rank_error()
    out = named.select("metric_hour", "tenant_id", "page_name", "page_views")
    for name, q in (("p95", 0.95), ("p99", 0.99)):
        ranks = quantile_states.rank_bounds(events, named, true_hour, "metric_hour", name)
        within = ((F.col("rank_from") <= q + error) & (F.col("rank_to") >= q - error)).alias(f"{name}_within")
        out = out.join(ranks.select("metric_hour", "tenant_id", "page_name", within), ["metric_hour", "tenant_id", "page_name"])
    return out


def _payload_values(s, d):
    value = payloads.payload(F.col("payload"))
    return t.event_payloads(s, d).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if(payloads.broken(F.col("payload"))).alias("broken"),
        F.sum(payloads.field(value, "$.k", "bigint")).alias("k"),
        F.sum(payloads.field(value, "$.detail.k", "bigint")).alias("detail_k"),
        F.sum(payloads.field(value, "$.items[1]", "bigint")).alias("second_item"),
        F.sum(payloads.field(value, "$.amount", "double")).alias("amount"),
    )


def _tenant_rows_sql(s, d):
    sql_functions.install_tenant_rows(s, "visible_revenue", t.tenant_revenue(s, d), t.tenant_users(s, d))
    return s.sql(f"SELECT * FROM visible_revenue('{MEMBER.user}')")


def _access_sql(s, d):
    sql_functions.install_access_check(s, {"tenants": t.tenants(s, d), "tenant_users": t.tenant_users(s, d)}, "may_read_metric")
    t.access_requests(s, d).createOrReplaceTempView("asked_access")
    return s.sql("SELECT *, may_read_metric(user_email, metric_name) AS can_access FROM asked_access")


QUERIES = {
    "daily_revenue_metrics_deltas": query(lambda s, d: _ledger(s, d).read(t.dim_customer(s, d), DAY)),
    "customer_count_rollup": query(_customer_rollup),
    "catalog_changes": query(lambda s, d: changes.changed_keys(s, _catalog_versions(s, d), CATALOG, 1, 2, ["metric_fqn"])),
    "page_ledger_metrics": query(lambda s, d: rounded_loads(_page_ledger(s, d)[0].read(EVENT_TIME, 24 * 31))),
    "page_event_accounting": query(_accounting),
    "page_quantile_states": query(_quantiles),
    "event_payload_values": query(_payload_values),
    "event_payload_fields": query(lambda s, d: payloads.payload_fields(t.event_payloads(s, d), "payload", ["event_type"])),
    "tenant_isolation_sql": query(_tenant_rows_sql),
    "can_access_metric_sql": query(_access_sql),
}

_ROLLUP = " UNION ALL ".join(
    f"""SELECT '{grain}' AS grain, '{level}' AS level, CAST(date_trunc('{grain}', recognized_date) AS DATE) AS period, {segment} AS segment, {region} AS region,
       count(DISTINCT r.customer_id) AS customer_count FROM fct_revenue r JOIN dim_customer c ON r.customer_id = c.customer_id GROUP BY 3, 4, 5"""
    for grain in ("quarter", "year")
    for level, segment, region in (("segment and region", "segment", "region"), ("segment", "segment", "CAST(NULL AS VARCHAR)"), ("all", "CAST(NULL AS VARCHAR)", "CAST(NULL AS VARCHAR)"))
)
_WAVES = """
a AS (SELECT *, date_diff('day', DATE '2024-01-01', CAST(event_timestamp + to_hours(CASE page_name WHEN '/error' THEN 144 WHEN '/signup' THEN 12 ELSE 0 END) AS DATE)) // 10 AS wave
      FROM page_events),
m AS (SELECT wave, max(event_timestamp) AS newest FROM a GROUP BY 1),
w AS (SELECT wave, max(newest) OVER (ORDER BY wave ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 24 HOUR AS mark FROM m),
e AS (SELECT a.*, coalesce(event_timestamp < mark, FALSE) AS late FROM a JOIN w USING (wave))"""
_PAYLOAD = """
p AS (SELECT event_id, event_type,
             CASE event_type WHEN 'view' THEN '{"k": "' || json_extract_string(props, '$.k') || '"}' WHEN 'signup' THEN '{"detail": ' || props || ', "k": null}'
                             WHEN 'purchase' THEN '{"amount": 1.5, "items": [1, 2]}' WHEN 'error' THEN NULL ELSE props END AS j FROM events)"""

ORACLE = {
    "daily_revenue_metrics_deltas": METRICS_ORACLE["daily_revenue_metrics"],
    "customer_count_rollup": oracle(_ROLLUP),
    "catalog_changes": LIFECYCLE_ORACLE["flag_zombies"].rsplit("SELECT", 1)[0]
    + """, y AS (SELECT metric_fqn, x.tags, x.updated_at, CASE WHEN certification_status = 'CERTIFIED' THEN 2 ELSE 1 END AS n FROM x WHERE certification_status <> 'DEPRECATED')
SELECT c.metric_fqn, CASE WHEN y.metric_fqn IS NULL THEN 'removed' ELSE 'changed' END AS change, CAST(1 AS BIGINT) AS rows_before, CAST(coalesce(n, 0) AS BIGINT) AS rows_after
FROM metric_catalog c LEFT JOIN y ON y.metric_fqn = c.metric_fqn
WHERE y.metric_fqn IS NULL OR n = 2 OR y.tags IS DISTINCT FROM c.tags OR y.updated_at IS DISTINCT FROM c.updated_at""",
    "page_event_accounting": oracle(
        f"WITH {_WAVES} SELECT CAST(event_timestamp AS DATE) AS metric_date, count(*) FILTER (NOT late) AS rows_on_time, count(*) FILTER (late) AS rows_late FROM e GROUP BY 1"
    ),
    "page_ledger_metrics": oracle(
        f"""WITH {_WAVES}
SELECT date_trunc('minute', event_timestamp) AS metric_minute, tenant_id, page_name, count(*) AS page_views, round(avg(load_time_ms), 6) AS avg_load_time_ms,
       round(quantile_cont(load_time_ms, 0.95), 6) AS p95_load_time_ms, round(quantile_cont(load_time_ms, 0.99), 6) AS p99_load_time_ms,
       count(*) FILTER (load_time_ms > 3000) AS slow_loads
FROM e WHERE NOT late GROUP BY 1, 2, 3"""
    ),
    "page_quantile_states": oracle(
        """SELECT date_trunc('hour', event_timestamp) AS metric_hour, tenant_id, page_name, count(*) AS page_views, TRUE AS p95_within, TRUE AS p99_within
FROM page_events GROUP BY 1, 2, 3"""
    ),
    "event_payload_values": f"""
WITH {_PAYLOAD}
SELECT event_type, count(*) AS events, count(*) FILTER (j IS NULL) AS broken, CAST(sum(TRY_CAST(json_extract_string(j, '$.k') AS BIGINT)) AS BIGINT) AS k,
       CAST(sum(TRY_CAST(json_extract_string(j, '$.detail.k') AS BIGINT)) AS BIGINT) AS detail_k, CAST(sum(TRY_CAST(json_extract_string(j, '$.items[1]') AS BIGINT)) AS BIGINT) AS second_item,
       sum(TRY_CAST(json_extract_string(j, '$.amount') AS DOUBLE)) AS amount
FROM p GROUP BY 1""",
    "event_payload_fields": f"""
WITH {_PAYLOAD}, f AS (SELECT event_type, j, unnest(json_keys(j)) AS key FROM p WHERE j IS NOT NULL),
k AS (SELECT event_type, key, json_type(j, '$.' || key) AS kind, json_extract_string(j, '$.' || key) AS v FROM f),
n AS (SELECT event_type, key, v, CASE kind WHEN 'UBIGINT' THEN 'BIGINT' WHEN 'DOUBLE' THEN 'DECIMAL' WHEN 'VARCHAR' THEN 'STRING' ELSE kind END AS value_type FROM k)
SELECT event_type, key, value_type, count(*) AS rows, sum(CASE WHEN value_type IN ('BIGINT', 'DECIMAL') THEN CAST(v AS DOUBLE) END) AS total FROM n GROUP BY 1, 2, 3
UNION ALL SELECT event_type, NULL, 'BROKEN', count(*), NULL FROM p WHERE j IS NULL GROUP BY 1""",
    "tenant_isolation_sql": TENANCY_ORACLE["tenant_isolation"],
    "can_access_metric_sql": TENANCY_ORACLE["can_access_metric"],
}
