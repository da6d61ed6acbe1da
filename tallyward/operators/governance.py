"""Scorecards and evidence over the catalog, the domains and the governance logs."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import measures as M


def _rows() -> Column:
    return F.count(F.lit(1))


def _since_months(df: DataFrame, column: str, as_of: datetime, months: int = 3) -> DataFrame:
    return df.filter(F.col(column) >= D.lit_ts(D.shift_months(D.as_datetime(as_of), -months)))


def one_row(*frames: DataFrame) -> DataFrame:
    """One-row aggregates side by side: stacked, then folded by ``max``, which ignores the NULLs."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def governance_health_scorecard(cat: DataFrame, dom: DataFrame, as_of: date) -> DataFrame:
    """Certification, ownership, usage and domain maturity in one row; one pass per table."""
    status = F.col("certification_status")
    certified = status == "CERTIFIED"
    kept = status != "DEPRECATED"
    owned = F.col("owner_role").isNotNull() & F.col("steward_role").isNotNull()
    catalog = cat.agg(
        _rows().alias("total_metrics"),
        M.count_when(certified).alias("certified"),
        M.count_when(certified & (F.col("recertification_due") < D.lit_date(as_of))).alias("overdue"),
        M.count_when(kept).alias("kept"),
        M.count_when(kept & owned).alias("owned"),
        M.count_when(F.col("query_count_30d") > 0).alias("active"),
        M.count_when(certified & (F.col("query_count_30d") == 0)).alias("zombies"),
    )
    domains = dom.filter("is_active").agg(
        _rows().alias("total_domains"),
        M.count_when(F.col("governance_maturity").isin("SCALE", "ENTERPRISE")).alias("mature_domains"),
        M.mean(F.sum("certification_rate"), F.count("certification_rate"), 1).alias("avg_rate"),
    )

    def health(part: str, whole: str, good: int, fair: int) -> Column:
        scaled, total = F.col(part) * 100, F.col(whole)
        reached = [(total > 0) & (scaled >= total * bound) for bound in (good, fair)]
        return F.when(reached[0], "HEALTHY").when(reached[1], "WARNING").otherwise("CRITICAL")

    return one_row(catalog, domains).select(
        M.pct(F.col("certified"), F.col("total_metrics")).alias("certification_coverage_pct"),
        F.col("overdue").alias("overdue_recertifications"),
        health("certified", "total_metrics", 90, 70).alias("certification_health"),
        M.pct(F.col("owned"), F.col("kept")).alias("ownership_coverage_pct"),
        health("owned", "kept", 95, 80).alias("ownership_health"),
        F.col("active").alias("active_metrics"),
        F.col("zombies").alias("zombie_metrics"),
        "total_domains",
        "mature_domains",
        F.col("avg_rate").alias("avg_domain_certification_rate"),
        F.col("total_metrics").alias("total_metric_count"),
    )


def change_velocity(log: DataFrame, as_of: datetime) -> DataFrame:
    hours = D.boundary_hours(F.col("approval_timestamp"), F.col("deployed_at"))
    rolled_back = M.count_when(F.col("status") == "ROLLED_BACK")
    return (
        _since_months(log, "deployed_at", as_of)
        .groupBy(D.trunc_date(F.col("deployed_at"), "week").alias("week"), "asset_type")
        .agg(
            _rows().alias("changes_deployed"),
            M.mean(F.sum(hours), F.count(hours)).alias("avg_hours_approval_to_deploy"),
            M.count_when(F.col("is_breaking_change")).alias("breaking_changes"),
            rolled_back.alias("rollbacks"),
            M.pct(rolled_back, _rows()).alias("rollback_rate_pct"),
        )
    )


def request_pipeline_health(requests: DataFrame, as_of: datetime) -> DataFrame:
    """Metric requests by status and urgency. An undecided request counts as breached even before
    its deadline, as the definition has it."""
    decided = F.coalesce(F.col("decision_date"), D.lit_ts(as_of))
    hours = D.boundary_hours(F.col("submitted_at"), decided)
    breached = (F.col("submitted_at") < F.col("sla_deadline")) & (
        F.col("decision_date").isNull() | (F.col("decision_date") > F.col("sla_deadline"))
    )
    return (
        _since_months(requests, "submitted_at", as_of)
        .groupBy("status", "urgency")
        .agg(
            _rows().alias("request_count"),
            M.mean(F.sum(hours), F.count(hours)).alias("avg_hours_in_status"),
            M.count_when(breached).alias("sla_breached"),
        )
    )


def domain_maturity_assessment(dom: DataFrame, as_of: date) -> DataFrame:
    rate, quality, metrics = F.col("certification_rate"), F.col("avg_data_quality"), F.col("metric_count")
    recommended = (
        F.when((rate >= 90) & (quality >= 95) & (F.col("agent_count") >= 2) & (metrics >= 50), "ENTERPRISE")
        .when((rate >= 80) & (quality >= 90) & (metrics >= 20), "SCALE")
        .when((rate >= 60) & (metrics >= 5), "GROWTH")
        .otherwise("FOUNDATION")
    )
    overdue = F.coalesce(F.col("next_review_due") < D.lit_date(as_of), F.lit(False))
    return dom.filter("is_active").select(
        "domain_name",
        "steward_user",
        "metric_count",
        "semantic_view_count",
        "agent_count",
        F.round(rate, 1).alias("certification_rate_pct"),
        F.round(quality, 1).alias("avg_quality_score"),
        F.col("governance_maturity").alias("current_maturity"),
        recommended.alias("recommended_maturity"),
        "last_governance_review",
        "next_review_due",
        overdue.alias("review_overdue"),
    )


# --- Fixed values: minutes to mitigate an incident, by severity
MITIGATION_MINUTES = {1: 240, 2: 480, 3: 2880, 4: 1440}


def incident_sla_compliance(inc: DataFrame, as_of: datetime) -> DataFrame:
    within = reduce(
        lambda a, b: a | b,
        [
            (F.col("severity") == severity) & (F.col("time_to_mitigate_minutes") <= minutes)
            for severity, minutes in MITIGATION_MINUTES.items()
        ],
    )

    def average(column: str) -> Column:
        return M.mean(F.sum(column), F.count(column))

    return (
        _since_months(inc, "detected_at", as_of)
        .groupBy("severity")
        .agg(
            _rows().alias("total_incidents"),
            average("time_to_detect_minutes").alias("avg_detect_minutes"),
            average("time_to_mitigate_minutes").alias("avg_mitigate_minutes"),
            average("time_to_resolve_minutes").alias("avg_resolve_minutes"),
            M.count_when(within).alias("within_sla"),
            M.pct(M.count_when(within), _rows()).alias("sla_compliance_pct"),
        )
    )


def quarterly_program_metrics(cat: DataFrame, dom: DataFrame) -> DataFrame:
    """Catalog totals by quarter of creation; a registered domain counts whether active or not."""
    domains = dom.select(F.col("domain_name").alias("domain"), "domain_id")
    return (
        cat.groupBy(D.trunc_date(F.col("created_at"), "quarter").alias("quarter"), "domain")
        .agg(
            F.count_distinct("metric_id").alias("metrics"),
            F.count_distinct(F.when(F.col("certification_status") == "CERTIFIED", F.col("metric_id"))).alias("certified"),
            F.sum("query_count_30d").alias("queries"),
            F.sum("consumer_count_30d").alias("consumers"),
            F.sum("agent_count_using").alias("agents"),
            F.sum("data_quality_score").alias("quality"),
            F.count("data_quality_score").alias("rated"),
        )
        .join(domains, "domain", "left")
        .groupBy("quarter")
        .agg(
            F.sum("metrics").alias("total_metrics"),
            F.sum("certified").alias("certified_metrics"),
            F.count_distinct("domain_id").alias("active_domains"),
            F.sum("queries").alias("total_metric_queries"),
            F.sum("consumers").alias("total_consumers"),
            F.sum("agents").alias("total_agent_bindings"),
            M.mean(F.sum("quality"), F.sum("rated")).alias("avg_quality_score"),
        )
    )


def metric_discovery(cat: DataFrame, dom: DataFrame, glossary: DataFrame) -> DataFrame:
    """What consumers may use: certified and pending metrics, whom to ask, and how terms differ."""
    contacts = dom.select(F.col("domain_name").alias("domain"), F.col("steward_user").alias("domain_contact"))
    terms = glossary.select(F.col("term").alias("metric_name"), "disambiguation_rules", "commonly_confused_with")
    return (
        cat.filter(F.col("certification_status").isin("CERTIFIED", "PENDING"))
        .join(contacts, "domain", "left")
        .join(terms, "metric_name", "left")
        .select(
            "metric_name",
            "domain",
            "sub_domain",
            "business_definition",
            "aggregation_method",
            "time_grain",
            "certification_status",
            "certification_date",
            "data_quality_score",
            "freshness_sla_hours",
            "semantic_view_fqn",
            "has_verified_query",
            "tags",
            "domain_contact",
            "disambiguation_rules",
            "commonly_confused_with",
        )
    )


def metric_discovery_projection(discovery: DataFrame) -> DataFrame:
    return discovery.select("metric_name", "domain", "certification_status", "data_quality_score", "domain_contact")


def glossary_lookup(glossary: DataFrame, term: str) -> DataFrame:
    return glossary.filter(F.col("term") == term).select(
        "term", "canonical_definition", "disambiguation_rules", "commonly_confused_with"
    )


def governance_inventory(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of each governance table. Parquet answers each count from its footers."""
    counts = [df.agg(_rows().alias("count")).select(F.lit(label).alias("category"), "count") for label, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def raci_coverage(raci: DataFrame) -> DataFrame:
    return raci.groupBy("operation_category").agg(
        _rows().alias("operations_defined"),
        M.mean(F.sum("sla_hours"), F.count("sla_hours")).alias("avg_sla_hours"),
        M.count_when(F.col("requires_approval")).alias("requiring_approval"),
    )


def gate_coverage(gates: DataFrame) -> DataFrame:
    path = F.concat_ws(" -> ", "from_environment", "to_environment").alias("promotion_path")
    return (
        gates.filter("is_active")
        .groupBy(path)
        .agg(
            _rows().alias("gate_count"),
            M.count_when(F.col("gate_type") == "automated").alias("automated_gates"),
            M.count_when(F.col("gate_type") == "manual_approval").alias("manual_gates"),
            M.count_when(F.col("failure_action") == "BLOCK").alias("blocking_gates"),
        )
    )


def sox_evidence(log: DataFrame, as_of: datetime) -> DataFrame:
    """Change management and segregation of duties over the last quarter, from one pass.

    Unapproved deployments break the first control; only the first approver is compared for the
    second. An empty log proves nothing: its sum is NULL, hence NON-COMPLIANT.
    """
    deployed = F.col("status") == "DEPLOYED"
    unapproved = F.sum(F.when(deployed & (F.array_size("approved_by") == 0), 1).otherwise(0))
    own_approval = deployed & (F.col("requested_by") == F.get("approved_by", F.lit(0)))
    counts = _since_months(log, "deployed_at", as_of).agg(
        _rows().alias("total"),
        F.sum(F.when(deployed, 1).otherwise(0)).alias("deployed"),
        unapproved.alias("unapproved"),
        M.count_when(deployed).alias("separable"),
        M.count_when(own_approval).alias("self_approved"),
    )

    def text(column: str) -> Column:
        return F.col(column).cast("string")

    rows = F.array(
        F.struct(
            F.lit("Change Management").alias("control_area"),
            F.lit("Promotion records").alias("evidence_type"),
            F.concat(F.lit("Total promotions: "), text("total"), F.lit(", Approved: "), text("deployed")).alias("finding"),
            F.when(F.col("unapproved") == 0, "COMPLIANT").otherwise("NON-COMPLIANT").alias("status"),
        ),
        F.struct(
            F.lit("Segregation of Duties").alias("control_area"),
            F.lit("Approval separation").alias("evidence_type"),
            F.concat(F.lit("Changes where requester != approver: "), text("separable")).alias("finding"),
            F.when(F.col("self_approved") == 0, "COMPLIANT").otherwise("FINDING").alias("status"),
        ),
    )
    return counts.select(F.inline(rows))


def check_promotion_readiness(requests: DataFrame, gates: DataFrame) -> DataFrame:
    """The active gates on each request's path, all still to be passed."""
    path = ["from_environment", "to_environment"]
    active = gates.filter("is_active").select(*path, "gate_name", "gate_type", F.col("gate_description").alias("detail"))
    return requests.join(active, path).select(
        *requests.columns, "gate_name", "gate_type", F.lit("PENDING").alias("status"), "detail"
    )


def with_source_environment(requests: DataFrame, target: str = "target_environment") -> DataFrame:
    """Promotion path of each request: DEV before STAGING, STAGING before PRODUCTION."""
    source = F.when(F.col(target) == "STAGING", "DEV").when(F.col(target) == "PRODUCTION", "STAGING")
    return requests.withColumn("from_environment", source).withColumn("to_environment", F.col(target))


def validate_agent_bindings(bindings: DataFrame, cat: DataFrame) -> DataFrame:
    """PASS or FAIL per agent: does every metric it refers to exist in the catalog?"""
    used = bindings.select("agent_name", "metric_name").distinct()
    known = cat.select("metric_name").distinct().withColumn("_known", F.lit(True))
    missing = M.count_when(F.col("_known").isNull())
    return (
        used.join(known, "metric_name", "left")
        .groupBy("agent_name")
        .agg(_rows().alias("metrics_referenced"), missing.alias("metrics_missing"))
        .withColumn("status", F.when(F.col("metrics_missing") == 0, "PASS").otherwise("FAIL"))
    )


# --- Fixed values: days between validations of a control
VALIDATION_DAYS = {"daily": 1, "weekly": 7, "monthly": 31, "quarterly": 92}


def control_validation_status(controls: DataFrame, as_of: date) -> DataFrame:
    """Is each control's evidence current for the frequency it must be validated with?"""
    allowed = F.coalesce(
        *[F.when(F.col("validation_frequency") == name, days) for name, days in VALIDATION_DAYS.items()]
    )
    age = F.datediff(D.lit_date(as_of), F.col("last_validated").cast("date"))
    status = (
        F.when(F.col("last_validated").isNull(), "NOT_YET_VALIDATED").when(age > allowed, "OVERDUE").otherwise("CURRENT")
    )
    return controls.select(
        "governance_control", "regulation", "validation_frequency", age.alias("days_since_validation"), status.alias("validation_status")
    )


def domain_certification_list(dom: DataFrame) -> DataFrame:
    return (
        dom.filter("is_active")
        .select("domain_name", "certification_rate", "governance_maturity", "metric_count")
        .orderBy(F.desc("certification_rate"), "domain_name")
    )


def test_coverage_gate(tests: DataFrame, cat: DataFrame, minimum: int = 3) -> DataFrame:
    """Every catalog metric needs a minimum number of test cases."""
    cases = tests.groupBy(F.col("expected_metric").alias("metric_name")).agg(_rows().alias("test_cases"))
    covered = F.coalesce(F.col("test_cases"), F.lit(0))
    return (
        cat.select("metric_fqn", "metric_name")
        .join(cases, "metric_name", "left")
        .select(
            "metric_fqn",
            covered.alias("test_cases"),
            F.when(covered >= minimum, "PASS").otherwise("FAIL").alias("status"),
        )
    )


def breaking_change_notice(log: DataFrame, days: int = 7) -> DataFrame:
    """Breaking changes and whether consumers had a full notice window between approval and deployment."""
    notice = F.datediff(F.col("deployed_at").cast("date"), F.col("approval_timestamp").cast("date"))
    return log.filter("is_breaking_change").select(
        "change_id",
        "asset_fqn",
        notice.alias("notice_days"),
        F.when(F.coalesce(notice, F.lit(0)) >= days, "PASS").otherwise("BLOCK").alias("status"),
    )


def cadence_triggers(tel: DataFrame, cat: DataFrame, tel_as_of: datetime, as_of: date) -> DataFrame:
    """Which measured figures breach the cadences' escalation triggers."""
    telemetry = tel.filter(F.col("timestamp") >= D.lit_ts(D.shift_days(tel_as_of, -7))).agg(
        M.pct(M.count_when(F.col("grounded")), _rows()).alias("grounding"),
        M.mean(F.sum("confidence_score") * 100, F.count("confidence_score"), 1).alias("confidence"),
        M.pct(M.count_when(F.col("escalated")), _rows()).alias("escalation"),
    )
    idle = F.col("last_queried_at").isNull() | (F.col("last_queried_at") < D.lit_ts(D.shift_days(as_of, -60)))
    catalog = cat.agg(
        M.pct(M.count_when(F.col("certification_status") == "CERTIFIED"), _rows()).alias("certification"),
        M.pct(M.count_when(idle), _rows()).alias("unused"),
    )
    triggers = [
        ("Agent Health Check", "Grounding rate < 90%", "grounding", lambda v: v < 90),
        ("Agent Health Check", "Confidence < 70%", "confidence", lambda v: v < 70),
        ("Semantic Signals Triage", "Escalation rate > 15%", "escalation", lambda v: v > 15),
        ("Domain Health Review", "Certification rate < 80%", "certification", lambda v: v < 80),
        ("Domain Health Review", "Unused for 60 days > 20%", "unused", lambda v: v > 20),
    ]
    entries = [
        F.struct(
            F.lit(cadence).alias("cadence_name"),
            F.lit(label).alias("escalation_trigger"),
            F.col(column).cast("double").alias("measured"),
            test(F.col(column)).alias("breached"),
        )
        for cadence, label, column, test in triggers
    ]
    return one_row(telemetry, catalog).select(F.inline(F.array(*entries)))


def onboarding_progress(dom: DataFrame, checklist: DataFrame, done: DataFrame, kind: str = "domain") -> DataFrame:
    """Steps done and left for each domain, and the next blocking step.

    Completed steps are reduced to one set per domain, which can hold no more entries than the
    fixed checklist has steps, and compared with that checklist.
    """
    steps = checklist.filter(F.col("onboarding_type") == kind)
    plan = steps.agg(
        F.array_sort(F.collect_list("step_order")).alias("all_steps"),
        F.array_sort(F.collect_list(F.when(F.col("blocking"), F.col("step_order")))).alias("blocking_steps"),
    )
    completed = (
        done.select("domain_name", "step_order").distinct().groupBy("domain_name").agg(F.collect_list("step_order").alias("done"))
    )
    nothing = F.array().cast("array<int>")
    return (
        dom.select("domain_name")
        .join(completed, "domain_name", "left")
        .withColumn("done", F.coalesce(F.col("done"), nothing))
        .withColumn("all_steps", plan.select("all_steps").scalar())
        .withColumn("left_blocking", F.array_except(plan.select("blocking_steps").scalar(), F.col("done")))
        .select(
            "domain_name",
            F.array_size(F.array_intersect("all_steps", "done")).alias("steps_done"),
            F.array_size(F.array_except("all_steps", "done")).alias("steps_left"),
            F.array_size("left_blocking").alias("blocking_left"),
            F.array_min("left_blocking").alias("next_blocking_step"),
            (F.array_size("left_blocking") == 0).alias("ready"),
        )
    )
