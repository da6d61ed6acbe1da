"""Row policies, role inheritance, entitlements and the metric interface's decisions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..context import Principal, cut_lineage

# --- Fixed values: messages of the metric interface, around the metric's name
NOT_FOUND = ("Metric ", " is not available. Only certified metrics can be queried via API.")
DENIED = "Your plan does not include access to metric: "
NOTE = "Production implementation returns actual metric data from semantic view."
UPGRADE_URL = "https://yourcompany.com/pricing"


def audit_access(tel: DataFrame, principal: Principal) -> DataFrame:
    """Auditors and admins see the whole log, others the rows logged under their current role."""
    if principal.has_role("AGENT_AUDITOR", "AGENT_ADMIN"):
        return tel
    return tel.filter(F.col("user_role") == principal.role)


def region_access(df: DataFrame, mapping: DataFrame, principal: Principal, column: str = "region") -> DataFrame:
    """Rows of the regions mapped to the user, and rows marked ALL; executives and admins see all."""
    if principal.role.upper() in ("ACCOUNTADMIN", "SYSADMIN") or principal.has_role("EXECUTIVE_AGENT_ROLE"):
        return df
    mine = mapping.filter(F.col("user_name") == principal.user).select(F.col("allowed_region").alias(column)).distinct()
    everywhere = df.sparkSession.createDataFrame([("ALL",)], f"{column} string")
    return df.join(mine.unionByName(everywhere), column, "left_semi")


def tenant_isolation(df: DataFrame, tenant_users: DataFrame, principal: Principal) -> DataFrame:
    """Rows of the user's own tenants. A semi join, so a user listed twice duplicates nothing."""
    if principal.role.upper() in ("ACCOUNTADMIN", "SEMANTIC_PLATFORM_ADMIN"):
        return df
    mine = tenant_users.filter(F.col("user_email") == principal.user).select("tenant_id")
    return df.join(mine, "tenant_id", "left_semi")


def tenant_row_counts(df: DataFrame, tenant_users: DataFrame, principal: Principal) -> DataFrame:
    """Rows the principal can see, by tenant."""
    return tenant_isolation(df, tenant_users, principal).groupBy("tenant_id").agg(F.count(F.lit(1)).alias("total_rows"))


def effective_roles(grants: DataFrame) -> DataFrame:
    """Every role a role inherits, directly or through others, with the shortest distance.

    Each round doubles the distance covered: a shortest way of more than ``reach`` grants is one of exactly ``reach``, found
    in the round before, and a known one after it. So rounds are as many as the logarithm of the hierarchy's depth, and cycles
    end as soon as nothing is found at the full reach. Each round is checkpointed: the plan stays short and a lost executor
    costs one round at most.
    """
    edges = grants.select("role", "granted_role").distinct().filter(F.col("role") != F.col("granted_role"))
    rounds, reach = [cut_lineage(edges.withColumn("distance", F.lit(1)))], 1
    while True:
        known = reduce(DataFrame.unionByName, rounds)
        farthest = rounds[-1].filter(F.col("distance") == reach).select("role", F.col("granted_role").alias("via"))
        if farthest.isEmpty():
            return known
        longer = (
            farthest.join(known.withColumnRenamed("role", "via"), "via")
            .filter(F.col("role") != F.col("granted_role"))
            .groupBy("role", "granted_role")
            .agg((F.min("distance") + reach).alias("distance"))
        )
        rounds.append(cut_lineage(longer.join(known, ["role", "granted_role"], "left_anti")))
        reach *= 2


def _entitlements(tenants: DataFrame) -> DataFrame:
    """One row per active tenant and enabled metric; ``*`` stands for every metric."""
    return (
        tenants.filter("is_active")
        .select("tenant_id", F.explode("metrics_enabled").alias("metric_name"))
        .distinct()
    )


def can_access_metric(requests: DataFrame, tenants: DataFrame, tenant_users: DataFrame) -> DataFrame:
    """For each requested (user, metric): does an active tenant of the user enable it?

    It starts from what is asked: each distinct (user, metric), the user's tenants, and whether one of them enables that
    metric or ``*``. The lookup has unique keys, so requests are never multiplied.
    """
    keys = ["user_email", "metric_name"]
    asked = requests.select(*keys).distinct()
    held = asked.join(tenant_users.select("user_email", "tenant_id").distinct(), "user_email")
    names = held.withColumn("_name", F.explode(F.array_distinct(F.array("metric_name", F.lit("*")))))
    enabled = _entitlements(tenants).withColumnRenamed("metric_name", "_name")
    granted = names.join(enabled, ["tenant_id", "_name"], "left_semi").select(*keys).distinct().withColumn("_granted", F.lit(True))
    return requests.join(granted, keys, "left").select(*requests.columns, F.col("_granted").isNotNull().alias("can_access"))


def tier_entitlements(tenants: DataFrame, tier_metrics: DataFrame) -> DataFrame:
    """Each tenant's enabled metrics against its tier's list: GRANTED, MISSING or EXCESS.

    A tenant that holds ``*`` misses nothing, and ``*`` itself is in excess where the tier does not list it. A tier that
    lists ``*`` makes every enabled metric a granted one.
    """
    listed = tier_metrics.filter("is_included").select("tier", "metric_name").distinct()
    open_tiers = listed.filter("metric_name = '*'").select("tier", F.lit(True).alias("_tier_all"))
    holders = (
        tenants.withColumn("_has_all", F.coalesce(F.array_contains("metrics_enabled", "*"), F.lit(False)))
        .join(open_tiers, "tier", "left")
        .select("tenant_id", "tier", "metrics_enabled", "_has_all", F.coalesce("_tier_all", F.lit(False)).alias("_tier_all"))
    )
    enabled = holders.select("tenant_id", "tier", F.explode("metrics_enabled").alias("metric_name"), "_tier_all").distinct()
    due = holders.select("tenant_id", "tier", "_has_all").distinct().join(listed, "tier")
    keys = ["tenant_id", "tier", "metric_name"]
    joined = enabled.withColumn("_on", F.lit(True)).join(due.withColumn("_due", F.lit(True)), keys, "full_outer")
    missing = F.col("_on").isNull() & ~F.col("_has_all")
    excess = F.col("_due").isNull() & ~F.col("_tier_all")
    state = F.when(missing, "MISSING").when(excess, "EXCESS").otherwise("GRANTED")
    return joined.select(*keys, state.alias("entitlement"))


def query_metric_batch(requests: DataFrame, catalog: DataFrame, tenants: DataFrame, limits: DataFrame) -> DataFrame:
    """Decision for each metric request: 404 if not certified, then 403 if not entitled, else 200.

    Every lookup is reduced to one row per key. A metric name certified in two domains is still
    one certified name; the answer carries the tenant's tier and rate limit.
    """
    certified = (
        catalog.filter(F.col("certification_status") == "CERTIFIED")
        .select("metric_name")
        .distinct()
        .withColumn("_certified", F.lit(True))
    )
    exact = _entitlements(tenants).withColumn("_exact", F.lit(True))
    plan = tenants.join(limits.select("tier", "max_requests_per_minute"), "tier", "left").select(
        "tenant_id",
        F.col("tier").alias("_tier"),
        F.col("max_requests_per_minute").alias("_rpm"),
        (F.col("is_active") & F.array_contains("metrics_enabled", "*")).alias("_all"),
    )
    allowed = F.col("_exact").isNotNull() | F.coalesce("_all", F.lit(False))
    status = F.when(F.col("_certified").isNull(), 404).when(~allowed, 403).otherwise(200)
    decided = (
        requests.join(certified, "metric_name", "left")
        .join(exact, ["tenant_id", "metric_name"], "left")
        .join(plan, "tenant_id", "left")
        .withColumn("status", status)
    )
    ok = F.col("status") == 200
    return decided.select(
        "request_id",
        F.col("metric_name").alias("metric"),
        "tenant_id",
        "status",
        F.when(F.col("status") == 404, "METRIC_NOT_FOUND_OR_NOT_CERTIFIED")
        .when(F.col("status") == 403, "ACCESS_DENIED")
        .alias("error"),
        F.when(F.col("status") == 404, F.concat(F.lit(NOT_FOUND[0]), "metric_name", F.lit(NOT_FOUND[1])))
        .when(F.col("status") == 403, F.concat(F.lit(DENIED), "metric_name"))
        .alias("message"),
        F.when(ok, F.col("_tier")).alias("tier"),
        F.when(ok, F.col("_rpm")).alias("rate_limit_rpm"),
        F.when(ok, "CERTIFIED").alias("certification"),
        F.when(ok, "live").alias("freshness"),
        F.when(ok, NOTE).alias("note"),
        F.when(F.col("status") == 403, UPGRADE_URL).alias("upgrade_url"),
    )


def request_log_rows(decisions: DataFrame) -> DataFrame:
    """The log rows to append for a batch of decisions, one per request."""
    ok = F.col("status") == 200
    return decisions.select(
        "request_id",
        F.concat(F.lit("/v1/metrics/"), "metric").alias("endpoint"),
        F.lit("GET").alias("method"),
        F.col("metric").alias("metric_requested"),
        "tenant_id",
        F.col("status").alias("response_status"),
        F.when(ok, 45).alias("response_time_ms"),
        F.when(ok, "live_query").otherwise("rejected").alias("served_from"),
    )


def rate_limit_audit(api_log: DataFrame, tenants: DataFrame, limits: DataFrame) -> DataFrame:
    """Tenant minutes and hours with more requests than the tier allows.

    Hours are summed from the minute counts: the log is shuffled once. A tenant or tier that nobody knows is allowed
    nothing, so each of its windows is reported, without a tier.
    """
    minute = F.date_trunc("minute", "requested_at").cast("timestamp_ntz")
    minutes = api_log.groupBy("tenant_id", minute.alias("window_start")).agg(F.count(F.lit(1)).alias("requests"))
    hours = minutes.groupBy(
        "tenant_id", F.date_trunc("hour", "window_start").cast("timestamp_ntz").alias("window_start")
    ).agg(F.sum("requests").alias("requests"))
    plan = tenants.join(limits, "tier", "left").select("tenant_id", "tier", "max_requests_per_minute", "max_requests_per_hour")

    def over(windows: DataFrame, kind: str, limit: str) -> DataFrame:
        return (
            windows.join(plan, "tenant_id", "left")
            .withColumn("allowed", F.coalesce(limit, F.lit(0)))
            .filter(F.col("requests") > F.col("allowed"))
            .select("tenant_id", "tier", F.lit(kind).alias("window_kind"), "window_start", "requests", "allowed")
        )

    return over(minutes, "minute", "max_requests_per_minute").unionByName(over(hours, "hour", "max_requests_per_hour"))


def api_status_summary(api_log: DataFrame) -> DataFrame:
    return api_log.groupBy("response_status").agg(F.count(F.lit(1)).alias("request_count"))
