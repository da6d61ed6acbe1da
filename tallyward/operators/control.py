"""Self-service control plane over whole batches of requests.

Each function answers every request and yields the tables after the batch, as if the requests
had been handled one by one in order of submission. The first of several requests for one key
is found with a min aggregate, which combines on the map side; no window ever sorts all
requests of a key in one task.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import measures as M
from .governance import one_row
from .lifecycle import update_where

# --- Fixed values: name patterns, each for the whole name
DOMAIN_NAME = "[A-Za-z][A-Za-z0-9_ ]+"
METRIC_NAME = "[a-z][a-z0-9_]{2,50}"
SEMANTIC_VIEW_FQN = ".*\\.[a-z]+_[a-z]+.*"
AGENT_FQN = ".*[a-z]+_(agent|assistant)"

# --- Fixed values: answers to refused requests, before the name or value they concern
BAD_DOMAIN_NAME = (
    "Domain name must start with a letter and contain only alphanumeric characters, spaces, or underscores."
)
DOMAIN_TAKEN = "Domain already registered: "
BAD_METRIC_NAME = "Metric name must be lowercase, start with letter, 3-51 chars. Got: "
NO_SUCH_DOMAIN = ("Domain not found or inactive: ", ". Register domain first.")
METRIC_TAKEN = "Metric already exists in domain: "
NO_SUCH_METRIC = "Metric not found: "
LOW_QUALITY = ("Data quality score must be >= ", " for certification. Got: ")
LOW_QUALITY_ADVICE = "Investigate and fix data quality issues before certifying."
SELF_APPROVED = "Segregation of duties violation: approver cannot be the same as requester."
SELF_APPROVED_ADVICE = "Ask your domain steward to approve."
BLOCKED = "Validation gates failed. Fix issues before promoting."

# --- Fixed values: what follows an accepted request
AFTER_ONBOARDING = (
    "Define 3-5 initial metrics using governance.operating_model.register_metric()",
    "Create semantic view YAML in DEV environment",
    "Run CALL governance.devops.promote_asset() to move through pipeline",
)
AFTER_REGISTRATION = (
    "Add metric to semantic view YAML",
    "Write 3 test cases (resolution, disambiguation, boundary)",
    "Run CALL governance.operating_model.certify_metric() when ready",
)

# --- Fixed values: gates (name, detail when passed, detail when failed)
NAMING_GATE = ("Naming Convention", "Naming convention validated", "Asset name does not match pattern for ")
OWNERSHIP_GATE = (
    "Ownership Coverage",
    "All metrics have owner and steward assigned",
    "Some metrics missing owner_role or steward_role",
)
REGISTRATION_GATE = ("Metric Registration", "Metrics registered: ", "Metrics registered: ")
CERTIFICATION_GATE = ("Certification Status", "All metrics certified or pending", " metrics not yet certified")

# --- Fixed values: alert rules and the condition each one watches
ALERT_CONDITIONS = [
    ("Certification Below 80%", "certification"),
    ("SEV-1 Incident Opened", "incident"),
    ("Metric Expired - Action Required", "expired"),
    ("Promotion Gate Failure", "blocked"),
    ("Domain Review Overdue", "review"),
    ("High Rollback Rate (>15%)", "rollback"),
]


@dataclass(frozen=True)
class Outcome:
    """Answers to the requests, the rows to append to the change log, and the tables afterwards."""

    results: DataFrame
    log: DataFrame | None = None
    domains: DataFrame | None = None
    catalog: DataFrame | None = None


def _turn() -> Column:
    return F.struct(F.col("submitted_at"), F.col("request_id"))


def _first_wins(checked: DataFrame, keys: list[str]) -> DataFrame:
    """Adds ``_first``: is this the earliest request without an error for its key?"""
    winners = checked.filter(F.col("error").isNull()).groupBy(*keys).agg(F.min(_turn()).alias("_winner"))
    return checked.join(winners, keys, "left").withColumn(
        "_first", F.col("error").isNull() & (F.col("_winner") == _turn())
    )


def _log(df: DataFrame, as_of: datetime, **columns: Column) -> DataFrame:
    return df.select(*[value.alias(name) for name, value in columns.items()], D.lit_ts(as_of).alias("deployed_at"))


def onboard_domains(requests: DataFrame, dom: DataFrame, as_of: datetime) -> Outcome:
    """New domains with their steward role, at FOUNDATION, first review in a month."""
    name = F.col("domain_name")
    known = dom.select(F.upper("domain_name").alias("_key")).distinct().withColumn("_known", F.lit(True))
    exists = F.concat(F.lit(DOMAIN_TAKEN), name)
    checked = (
        requests.withColumn("_key", F.upper(name))
        .join(known, "_key", "left")
        .withColumn(
            "error",
            F.when(~M.whole_match(name, DOMAIN_NAME), BAD_DOMAIN_NAME).when(F.col("_known"), exists),
        )
    )
    decided = _first_wins(checked, ["_key"]).withColumn(
        "error", F.when(F.col("error").isNotNull(), F.col("error")).when(~F.col("_first"), exists)
    )
    role = F.concat(F.lit("DOMAIN_STEWARD_"), F.upper(F.replace(name, F.lit(" "), F.lit("_"))))
    ok = F.col("error").isNull()
    results = decided.select(
        "request_id",
        "domain_name",
        F.when(ok, "SUCCESS").otherwise("FAILED").alias("status"),
        "error",
        F.when(ok, role).alias("steward_role"),
        F.when(ok, F.col("steward_user")).alias("steward_user"),
        F.when(ok, F.array(*map(F.lit, AFTER_ONBOARDING))).alias("next_steps"),
    )
    accepted = decided.filter(ok)
    added = accepted.select(
        "domain_name",
        F.col("description").alias("domain_description"),
        role.alias("steward_role"),
        "steward_user",
        "backup_steward",
        F.lit("FOUNDATION").alias("governance_maturity"),
        D.lit_date(D.shift_months(D.as_date(as_of), 1)).alias("next_review_due"),
        F.lit(True).alias("is_active"),
        F.lit(0).cast("bigint").alias("metric_count"),
    )
    log = _log(
        accepted,
        as_of,
        asset_type=F.lit("domain"),
        asset_fqn=name,
        change_type=F.lit("create"),
        source_environment=F.lit("PRODUCTION"),
        change_description=F.concat(F.lit("Self-service domain onboarding: "), name),
        requested_by=F.col("requested_by"),
        approved_by=F.array("requested_by"),
        status=F.lit("DEPLOYED"),
    )
    return Outcome(results, log, domains=dom.unionByName(added, allowMissingColumns=True))


def register_metrics(requests: DataFrame, dom: DataFrame, cat: DataFrame, as_of: datetime) -> Outcome:
    """New metrics as DRAFT under their domain's steward; the domain's metric count follows."""
    name, domain = F.col("metric_name"), F.col("domain")
    active = dom.filter("is_active").select(
        F.col("domain_name").alias("domain"), F.col("steward_role").alias("_steward"), F.lit(True).alias("_active")
    )
    known = cat.select("domain", "metric_name").distinct().withColumn("_known", F.lit(True))
    exists = F.concat(F.lit(METRIC_TAKEN), domain, F.lit("."), name)
    checked = (
        requests.join(active, "domain", "left")
        .join(known, ["domain", "metric_name"], "left")
        .withColumn(
            "error",
            F.when(~M.whole_match(name, METRIC_NAME), F.concat(F.lit(BAD_METRIC_NAME), name))
            .when(F.col("_active").isNull(), F.concat(F.lit(NO_SUCH_DOMAIN[0]), domain, F.lit(NO_SUCH_DOMAIN[1])))
            .when(F.col("_known"), exists),
        )
    )
    decided = _first_wins(checked, ["domain", "metric_name"]).withColumn(
        "error", F.when(F.col("error").isNotNull(), F.col("error")).when(~F.col("_first"), exists)
    )
    ok = F.col("error").isNull()
    fqn = F.concat(F.lower(F.replace(domain, F.lit(" "), F.lit("_"))), F.lit(".semantic."), name)
    results = decided.select(
        "request_id",
        "domain",
        "metric_name",
        F.when(ok, "SUCCESS").otherwise("FAILED").alias("status"),
        "error",
        F.when(ok, fqn).alias("metric_fqn"),
        F.when(ok, "DRAFT").alias("certification_status"),
        F.when(ok, F.array(*map(F.lit, AFTER_REGISTRATION))).alias("next_steps"),
    )
    added = decided.filter(ok).select(
        fqn.alias("metric_fqn"),
        "domain",
        "metric_name",
        "business_definition",
        "semantic_view_fqn",
        "aggregation_method",
        "time_grain",
        "owner_role",
        F.col("_steward").alias("steward_role"),
        F.lit("DRAFT").alias("certification_status"),
        F.col("freshness_sla_hours").cast("bigint").alias("freshness_sla_hours"),
        F.lit(0).cast("bigint").alias("query_count_30d"),
        D.lit_ts(as_of).alias("created_at"),
        D.lit_ts(as_of).alias("updated_at"),
    )
    growth = added.groupBy(F.col("domain").alias("domain_name")).agg(F.count(F.lit(1)).alias("_new"))
    domains = update_where(
        dom.join(growth, "domain_name", "left"),
        F.col("_new").isNotNull(),
        {"metric_count": F.col("metric_count") + F.col("_new")},
    ).select(*dom.columns)
    return Outcome(results, domains=domains, catalog=cat.unionByName(added, allowMissingColumns=True))


def certify_metrics(
    requests: DataFrame, cat: DataFrame, dom: DataFrame, as_of: datetime, threshold: float = 95.0
) -> Outcome:
    """Certification for 90 days, given the quality threshold and an approver other than the requester.

    An unknown quality is not below the threshold and passes, as in three-valued logic. Repeated
    requests for a metric all succeed; the last one sets the stored quality.
    """
    current = cat.select("metric_fqn", F.col("certification_status").alias("_status"), "domain").filter(
        F.col("_status").isNotNull()
    )
    score = F.col("data_quality_score")
    missing, poor = F.col("_status").isNull(), score < threshold
    own = F.col("approver") == F.col("requested_by")
    got = F.concat(F.lit(f"{LOW_QUALITY[0]}{threshold}{LOW_QUALITY[1]}"), score.cast("string"))
    decided = requests.join(current, "metric_fqn", "left").withColumns(
        {
            "error": F.when(missing, F.concat(F.lit(NO_SUCH_METRIC), "metric_fqn"))
            .when(poor, got)
            .when(own, SELF_APPROVED),
            "recommendation": F.when(~missing & poor, LOW_QUALITY_ADVICE).when(~missing & own, SELF_APPROVED_ADVICE),
        }
    )
    ok = F.col("error").isNull()
    day = D.as_date(as_of)
    due = D.lit_date(D.shift_days(day, 90))
    results = decided.select(
        "request_id",
        "metric_fqn",
        F.when(ok, "SUCCESS").otherwise("FAILED").alias("status"),
        "error",
        "recommendation",
        F.when(ok, "CERTIFIED").alias("certification_status"),
        F.when(ok, due).alias("recertification_due"),
        F.when(ok, score).alias("data_quality_score"),
    )
    accepted = decided.filter(ok)
    last = accepted.groupBy("metric_fqn").agg(
        F.max(F.struct("submitted_at", "request_id", "data_quality_score")).alias("_last")
    )
    catalog = update_where(
        cat.join(last, "metric_fqn", "left"),
        F.col("_last").isNotNull(),
        {
            "certification_status": F.lit("CERTIFIED"),
            "certification_date": D.lit_date(day),
            "recertification_due": due,
            "data_quality_score": F.col("_last.data_quality_score"),
            "updated_at": D.lit_ts(as_of),
        },
    ).select(*cat.columns)
    touched = accepted.select(F.col("domain").alias("domain_name")).distinct()
    rates = (
        catalog.groupBy(F.col("domain").alias("domain_name"))
        .agg(M.pct(M.count_when(F.col("certification_status") == "CERTIFIED"), F.count(F.lit(1))).alias("_rate"))
        .join(touched, "domain_name", "left_semi")
    )
    domains = update_where(
        dom.join(rates, "domain_name", "left"), F.col("_rate").isNotNull(), {"certification_rate": F.col("_rate")}
    ).select(*dom.columns)
    log = _log(
        accepted,
        as_of,
        asset_type=F.lit("metric"),
        asset_fqn=F.col("metric_fqn"),
        change_type=F.lit("certify"),
        source_environment=F.lit("PRODUCTION"),
        change_description=F.concat(F.lit("Metric certified with quality score "), score.cast("string")),
        requested_by=F.col("requested_by"),
        approved_by=F.array("approver"),
        status=F.lit("DEPLOYED"),
    )
    return Outcome(results, log, domains=domains, catalog=catalog)


def run_validation_suite(assets: DataFrame, cat: DataFrame) -> DataFrame:
    """Gate results of each distinct (asset, type, target): naming, ownership, registered metrics and,
    for PRODUCTION, certification. Types other than semantic view and agent have no valid name."""
    keys = ["asset_fqn", "asset_type", "target_environment"]
    by_view = cat.groupBy(F.col("semantic_view_fqn").alias("asset_fqn")).agg(
        F.count(F.lit(1)).alias("_metrics"),
        M.count_when(F.col("owner_role").isNull() | F.col("steward_role").isNull()).alias("_unowned"),
        M.count_when(~F.col("certification_status").isin("CERTIFIED", "PENDING")).alias("_uncertified"),
    )

    def count(column: str) -> Column:
        return F.coalesce(F.col(column), F.lit(0))

    is_view = F.col("asset_type") == "semantic_view"
    named = (is_view & M.whole_match(F.col("asset_fqn"), SEMANTIC_VIEW_FQN)) | (
        (F.col("asset_type") == "agent") & M.whole_match(F.col("asset_fqn"), AGENT_FQN)
    )
    owned = count("_unowned") == 0
    registered = (count("_metrics") > 0) | ~is_view
    certified = count("_uncertified") == 0
    production = F.col("target_environment") == "PRODUCTION"

    def gate(label: str, passed: Column, good: Column, bad: Column) -> Column:
        return F.struct(
            F.lit(label).alias("gate"),
            F.when(passed, "PASS").otherwise("FAIL").alias("status"),
            F.when(passed, good).otherwise(bad).alias("detail"),
        )

    number = F.concat(F.lit(REGISTRATION_GATE[1]), count("_metrics").cast("string"))
    always = [
        gate(NAMING_GATE[0], named, F.lit(NAMING_GATE[1]), F.concat(F.lit(NAMING_GATE[2]), "asset_type")),
        gate(OWNERSHIP_GATE[0], owned, F.lit(OWNERSHIP_GATE[1]), F.lit(OWNERSHIP_GATE[2])),
        gate(REGISTRATION_GATE[0], registered, number, number),
    ]
    left = F.concat(count("_uncertified").cast("string"), F.lit(CERTIFICATION_GATE[2]))
    certification = gate(CERTIFICATION_GATE[0], certified, F.lit(CERTIFICATION_GATE[1]), left)
    gates = F.when(production, F.array(*always, certification)).otherwise(F.array(*always))
    passed = F.forall("results", lambda g: g["status"] == "PASS")
    return (
        assets.select(*keys)
        .distinct()
        .join(by_view, "asset_fqn", "left")
        .select(*keys, gates.alias("results"))
        .select(
            *keys,
            F.when(passed, "PASS").otherwise("FAIL").alias("overall_status"),
            F.array_size("results").alias("gates_evaluated"),
            "results",
            F.when(passed, "Ready for promotion").otherwise("Fix failures before promoting").alias("action"),
        )
    )


def promote_assets(requests: DataFrame, cat: DataFrame, as_of: datetime) -> Outcome:
    """Requests whose asset passes its gates are deployed and logged; the others are blocked."""
    keys = ["asset_fqn", "asset_type", "target_environment"]
    suite = run_validation_suite(requests, cat).select(*keys, "overall_status", "gates_evaluated")
    checked = requests.join(suite, keys)
    passed = F.col("overall_status") == "PASS"
    results = checked.select(
        "request_id",
        *keys,
        F.when(passed, "SUCCESS").otherwise("BLOCKED").alias("status"),
        F.when(~passed, BLOCKED).alias("reason"),
        F.when(passed, F.col("git_commit_sha")).alias("git_sha"),
    )
    target = F.col("target_environment")
    log = _log(
        checked.filter(passed),
        as_of,
        asset_type=F.col("asset_type"),
        asset_fqn=F.col("asset_fqn"),
        change_type=F.lit("promote"),
        source_environment=F.when(target == "STAGING", "DEV").when(target == "PRODUCTION", "STAGING"),
        target_environment=target,
        git_commit_sha=F.col("git_commit_sha"),
        change_description=F.col("change_description"),
        requested_by=F.col("requested_by"),
        approved_by=F.array("requested_by"),
        approval_timestamp=D.lit_ts(as_of),
        is_breaking_change=F.lit(False),
        status=F.lit("DEPLOYED"),
    )
    return Outcome(results, log)


def alert_conditions(cat: DataFrame, dom: DataFrame, inc: DataFrame, log: DataFrame, as_of: datetime) -> DataFrame:
    """Whether each alert rule's condition holds. One aggregate per table, six rows out."""

    def hours_ago(column: str, hours: int) -> Column:
        return F.col(column) > D.lit_ts(D.as_datetime(as_of) - timedelta(hours=hours))

    certified_rate = M.pct(M.count_when(F.col("certification_status") == "CERTIFIED"), F.count(F.lit(1)))
    recent = hours_ago("deployed_at", 7 * 24)
    rollback_rate = M.pct(M.count_when(recent & (F.col("status") == "ROLLED_BACK")), M.count_when(recent))
    expired = (F.col("certification_status") == "EXPIRED") & hours_ago("updated_at", 24)
    facts = [
        cat.agg((certified_rate < 80).alias("certification"), F.bool_or(expired).alias("expired")),
        inc.filter((F.col("severity") == 1) & (F.col("status") == "OPEN") & hours_ago("detected_at", 1)).agg(
            (F.count(F.lit(1)) > 0).alias("incident")
        ),
        log.filter(recent).agg(
            F.bool_or((F.col("status") == "BLOCKED") & hours_ago("deployed_at", 1)).alias("blocked"),
            (rollback_rate > 15).alias("rollback"),
        ),
        dom.filter("is_active").agg(
            F.bool_or(F.col("next_review_due") < D.lit_date(D.as_date(as_of))).alias("review")
        ),
    ]
    entries = [
        F.struct(F.lit(label).alias("rule_name"), F.coalesce(F.col(column), F.lit(False)).alias("condition_met"))
        for label, column in ALERT_CONDITIONS
    ]
    return one_row(*facts).select(F.inline(F.array(*entries)))


def evaluate_alerts(rules: DataFrame, conditions: DataFrame, as_of: datetime) -> DataFrame:
    """The rules after evaluation: an active rule out of its cooldown whose condition holds fires now."""
    now = D.lit_ts(as_of)
    cooled = F.col("last_fired").isNull() | (
        F.timestamp_add("HOUR", F.col("cooldown_hours"), F.col("last_fired")) <= now
    )
    fired = F.col("is_active") & cooled & F.coalesce(F.col("condition_met"), F.lit(False))
    return rules.join(conditions, "rule_name", "left").select(
        "rule_name",
        "severity",
        "notification_channel",
        "recipients",
        "cooldown_hours",
        F.when(fired, now).otherwise(F.col("last_fired")).alias("last_fired"),
        "is_active",
        fired.alias("fired"),
    )
