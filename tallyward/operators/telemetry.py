"""Analytics of the answer telemetry: grounding, consistency, confidence, drift, escalation.

Distinct counts and samples are taken from deduplicated pairs, so a question or an agent that
holds a third of the log is reduced on the map side first. Lists are collected only for the
groups that survive a top-k.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import measures as M

# --- Fixed values: indicator bands, best first, and what is left below them
GROUNDING_BANDS = [(95, "HEALTHY"), (85, "WARNING")]
CONSISTENCY_BANDS = [(99, "HEALTHY"), (95, "WARNING")]
BELOW_BANDS = "CRITICAL"
ESCALATION_BAND = (2, 10)
ESCALATION_STATES = ("HEALTHY", "WARNING: Too permissive?", "CRITICAL: Too many escalations")
DRIFT_BANDS = [(0.1, "HIGH DRIFT - INVESTIGATE"), (0.05, "MODERATE DRIFT - MONITOR")]
NO_DRIFT = "STABLE"
LOW_CONFIDENCE, ESCALATED = "Low Confidence Questions", "Escalation Patterns"


def _since(df: DataFrame, column: str, as_of: datetime, days: int) -> DataFrame:
    return df.filter(F.col(column) >= D.lit_ts(D.shift_days(as_of, -days)))


def _rows() -> Column:
    return F.count(F.lit(1))


def agent_health_dashboard(tel: DataFrame, as_of: datetime, days: int = 7) -> DataFrame:
    """Volume, grounding, confidence, escalation, latency and users by agent."""
    by_user = (
        _since(tel, "timestamp", as_of, days)
        .groupBy("agent_name", "user_id")
        .agg(
            _rows().alias("n"),
            M.count_when(F.col("grounded")).alias("grounded"),
            M.count_when(F.col("escalated")).alias("escalated"),
            F.sum("confidence_score").alias("confidence"),
            F.count("confidence_score").alias("rated"),
            F.sum("response_time_ms").alias("ms"),
            F.count("response_time_ms").alias("timed"),
        )
    )
    return (
        by_user.groupBy("agent_name")
        .agg(
            F.sum("n").alias("total_interactions"),
            M.pct(F.sum("grounded"), F.sum("n")).alias("grounding_rate_pct"),
            M.mean(F.sum("confidence") * 100, F.sum("rated"), 1).alias("avg_confidence_pct"),
            M.pct(F.sum("escalated"), F.sum("n")).alias("escalation_rate_pct"),
            M.mean(F.sum("ms"), F.sum("timed"), 0).alias("avg_response_ms"),
            F.count("user_id").alias("unique_users"),
        )
        .orderBy(F.desc("total_interactions"), "agent_name")
    )


def test_pass_rate(tests: DataFrame) -> DataFrame:
    passed = M.count_when(F.col("last_result") == "PASS")
    return (
        tests.filter("is_active")
        .groupBy("test_category")
        .agg(
            _rows().alias("total_tests"),
            passed.alias("passed"),
            M.count_when(F.col("last_result") == "FAIL").alias("failed"),
            M.pct(passed, _rows()).alias("pass_rate"),
        )
        .orderBy("pass_rate", "test_category")
    )


def _kpi(label: str, counts: DataFrame, hits: str, total: str, pct: str, status: Column) -> DataFrame:
    """One KPI row. An empty log has no rate, which no healthy band accepts."""
    rated = counts.withColumn(pct, M.pct(F.col(hits), F.col(total)))
    return rated.select(F.lit(label).alias("kpi"), hits, total, pct, status.alias("status"))


def grounding_rate(log: DataFrame, as_of: datetime, days: int = 7) -> DataFrame:
    counts = _since(log, "created_at", as_of, days).agg(
        M.count_when(F.array_size("metrics_used") > 0).alias("grounded"), _rows().alias("total")
    )
    status = M.bands(F.col("pct"), GROUNDING_BANDS, BELOW_BANDS)
    return _kpi("Grounding Rate", counts, "grounded", "total", "pct", status)


def _answers(log: DataFrame, as_of: datetime, days: int) -> DataFrame:
    """One row per question and distinct answer (NULL answers form a row that counts as none)."""
    asked = _since(log, "created_at", as_of, days).filter(F.col("normalized_question").isNotNull())
    return asked.groupBy("normalized_question", "answer_summary").agg(
        _rows().alias("n"), F.min("created_at").alias("first_asked"), F.max("created_at").alias("last_asked")
    )


def consistency_score(log: DataFrame, as_of: datetime, days: int = 30, minimum_asked: int = 3) -> DataFrame:
    """Share of repeated questions that always got the same answer."""
    by_question = (
        _answers(log, as_of, days)
        .groupBy("normalized_question")
        .agg(F.count("answer_summary").alias("distinct_answers"), F.sum("n").alias("times_asked"))
        .filter(F.col("times_asked") >= minimum_asked)
    )
    counts = by_question.agg(
        M.count_when(F.col("distinct_answers") == 1).alias("consistent"), _rows().alias("total_questions")
    )
    status = M.bands(F.col("consistency_pct"), CONSISTENCY_BANDS, BELOW_BANDS)
    return _kpi("Consistency Score", counts, "consistent", "total_questions", "consistency_pct", status)


def escalation_rate(log: DataFrame, as_of: datetime, days: int = 7) -> DataFrame:
    counts = _since(log, "created_at", as_of, days).agg(
        M.count_when(F.col("escalated")).alias("escalated"), _rows().alias("total")
    )
    rate = F.col("escalation_pct")
    inside, low, high = ESCALATION_STATES
    status = F.when(rate.between(*ESCALATION_BAND), inside).when(rate < ESCALATION_BAND[0], low).otherwise(high)
    return _kpi("Escalation Rate", counts, "escalated", "total", "escalation_pct", status)


def confidence_by_agent(log: DataFrame, as_of: datetime, days: int = 7, low: float = 0.6) -> DataFrame:
    """Average and 10th percentile of confidence, and the count of very low ones.

    Scores are first counted by value, so the exact percentile merges value counts (scores have two
    decimals) rather than holding every row of an agent.
    """
    score = F.col("resolution_confidence")
    by_score = (
        _since(log, "created_at", as_of, days).groupBy("agent_name", "resolution_confidence").agg(_rows().alias("n"))
    )
    rated = F.when(score.isNotNull(), F.col("n"))
    return (
        by_score.groupBy("agent_name")
        .agg(
            M.mean(F.sum(score * F.col("n")) * 100, F.sum(rated), 1).alias("avg_confidence_pct"),
            F.round(F.percentile("resolution_confidence", 0.1, F.col("n")) * 100, 1).alias("p10_confidence"),
            F.sum("n").alias("query_count"),
            F.coalesce(F.sum(F.when(score < low, F.col("n"))), F.lit(0)).alias("very_low_confidence_count"),
        )
        .orderBy("avg_confidence_pct", "agent_name")
    )


def confidence_drift(tel: DataFrame, as_of: datetime, days: int = 30, minimum_days: int = 5) -> DataFrame:
    """Volatility of the daily mean confidence of each agent and metric."""
    daily = (
        _since(tel, "timestamp", as_of, days)
        .filter("grounded")
        .groupBy(D.trunc_date(F.col("timestamp"), "day").alias("query_date"), "agent_name", "resolved_metric")
        .agg(M.mean(F.sum("confidence_score"), F.count("confidence_score")).alias("daily_confidence"))
    )
    stats = (
        daily.groupBy("agent_name", "resolved_metric")
        .agg(
            F.avg("daily_confidence").alias("overall"),
            F.stddev_samp("daily_confidence").alias("volatility"),
            F.count("query_date").alias("days_active"),
        )
        .filter(F.col("days_active") >= minimum_days)
    )
    drift = F.coalesce(*[F.when(F.col("volatility") > bound, label) for bound, label in DRIFT_BANDS], F.lit(NO_DRIFT))
    return stats.orderBy(F.desc("volatility"), "agent_name", "resolved_metric").select(
        "agent_name",
        "resolved_metric",
        F.round("overall", 3).alias("avg_confidence"),
        F.round("volatility", 3).alias("confidence_volatility"),
        "days_active",
        drift.alias("drift_status"),
    )


def answer_inconsistencies(log: DataFrame, as_of: datetime, days: int = 30, k: int = 20) -> DataFrame:
    """Questions with more than one answer, worst first. The lists are built for the top k only, but hold all distinct answers
    of a question: one value of a row, so 2 GB at most. ``answer_variants`` has them as rows, without that limit."""
    worst = (
        _answers(log, as_of, days)
        .groupBy("normalized_question")
        .agg(
            F.min("first_asked").alias("first_asked"),
            F.max("last_asked").alias("last_asked"),
            F.count("answer_summary").alias("distinct_answers"),
        )
        .filter(F.col("distinct_answers") > 1)
        .orderBy(F.desc("distinct_answers"), "normalized_question")
        .limit(k)
    )
    variants = (
        _since(log, "created_at", as_of, days)
        .select("normalized_question", "answer_summary", "metrics_used")
        .join(worst.select("normalized_question"), "normalized_question", "left_semi")
        .distinct()
        .groupBy("normalized_question")
        .agg(
            F.array_sort(F.collect_set("answer_summary")).alias("all_answers"),
            F.array_sort(F.collect_set("metrics_used")).alias("metrics_used_variations"),
        )
    )
    return worst.join(variants, "normalized_question").orderBy(F.desc("distinct_answers"), "normalized_question")


def answer_variants(log: DataFrame, as_of: datetime, days: int = 30) -> DataFrame:
    """One row per answer and set of metrics that an inconsistent question got: the form to store.

    All inconsistent questions are covered and nothing is collected into lists. A question is inconsistent if its smallest
    answer differs from its largest, which combines on the map side however often it was asked.
    """
    asked = _since(log, "created_at", as_of, days).filter(F.col("normalized_question").isNotNull())
    variants = asked.groupBy("normalized_question", "answer_summary", "metrics_used").agg(
        _rows().alias("times_given"), F.min("created_at").alias("first_given"), F.max("created_at").alias("last_given")
    )
    several = (
        variants.groupBy("normalized_question")
        .agg(F.min("answer_summary").alias("least"), F.max("answer_summary").alias("most"))
        .filter(F.col("least") < F.col("most"))
    )
    return variants.join(several.select("normalized_question"), "normalized_question", "left_semi")


def escalation_questions(
    escalations: DataFrame, as_of: datetime, days: int = 30, keys: tuple[str, ...] = ("agent_name", "escalation_reason")
) -> DataFrame:
    """One row per escalated question of each group, with how often it was asked: the form to store. Whole texts, all groups."""
    return (
        _since(escalations, "created_at", as_of, days)
        .groupBy(*keys, "user_question")
        .agg(_rows().alias("times_asked"), F.max("created_at").alias("last_asked"))
    )


def _samples(df: DataFrame, keys: list[str], text: Column) -> DataFrame:
    """Distinct sample texts of each group, sorted and joined with bars: one value of a row, so 2 GB at most.
    ``escalation_questions`` has the questions as rows, without that limit."""
    return (
        df.select(*keys, text.alias("sample"))
        .distinct()
        .groupBy(*keys)
        .agg(F.coalesce(F.array_join(F.array_sort(F.collect_list("sample")), " | "), F.lit("")).alias("sample_questions"))
    )


def weekly_signals(log: DataFrame, escalations: DataFrame, as_of: datetime, k: int = 20) -> DataFrame:
    """What to improve: questions asked twice or more with low confidence, and escalation topics."""
    low = (
        _since(log, "created_at", as_of, 7)
        .filter(F.col("resolution_confidence") < 0.7)
        .groupBy("original_question")
        .agg(_rows().alias("frequency"), F.sum("resolution_confidence").alias("confidence"))
        .filter(F.col("frequency") >= 2)
    )
    percent = M.mean(F.col("confidence") * 100, F.col("frequency"), 0).cast("bigint").cast("string")
    questions = low.select(
        F.lit(LOW_CONFIDENCE).alias("improvement_type"),
        F.col("original_question").alias("topic"),
        "frequency",
        F.concat(percent, F.lit("% confidence")).alias("severity"),
    )
    recent = _since(escalations, "created_at", as_of, 7)
    topics = (
        recent.groupBy("escalation_reason")
        .agg(_rows().alias("frequency"))
        .filter(F.col("frequency") >= 2)
        .select(
            F.lit(ESCALATED).alias("improvement_type"),
            F.col("escalation_reason").alias("topic"),
            "frequency",
            F.concat(F.lit("Escalated "), F.col("frequency").cast("string"), F.lit(" times")).alias("severity"),
        )
    )
    top = questions.unionByName(topics).orderBy(F.desc("frequency"), "improvement_type", "topic").limit(k)
    wanted = top.filter(F.col("improvement_type") == ESCALATED).select(
        F.col("topic").alias("escalation_reason")
    )
    samples = _samples(
        recent.join(wanted, "escalation_reason", "left_semi"),
        ["escalation_reason"],
        F.substring("user_question", 1, 60),
    ).select(
        F.lit(ESCALATED).alias("improvement_type"), F.col("escalation_reason").alias("topic"), "sample_questions"
    )
    detail = F.when(
        F.col("improvement_type") == ESCALATED, F.concat("topic", F.lit(": "), "sample_questions")
    ).otherwise(F.col("topic"))
    return (
        top.join(samples, ["improvement_type", "topic"], "left")
        .orderBy(F.desc("frequency"), "improvement_type", "topic")
        .select("improvement_type", detail.alias("detail"), "frequency", "severity")
    )


def escalation_improvements(escalations: DataFrame, as_of: datetime, k: int = 20) -> DataFrame:
    keys = ["agent_name", "escalation_reason", "escalation_gate"]
    return (
        escalations.filter(F.col("created_at") >= D.lit_ts(D.shift_months(as_of, -1)))
        .groupBy(*keys)
        .agg(_rows().alias("occurrences"), M.count_when(F.col("led_to_new_metric")).alias("led_to_improvements"))
        .orderBy(F.desc("occurrences"), *keys)
        .limit(k)
    )


def security_compliance(log: DataFrame, as_of: datetime, days: int = 7) -> DataFrame:
    """Agents and roles with answers that hid their provenance, or without any row policy."""
    by_user = (
        _since(log, "created_at", as_of, days)
        .groupBy("agent_name", "user_role", "user_id")
        .agg(
            _rows().alias("n"),
            M.count_when(F.array_size("rls_policies_applied") > 0).alias("rls"),
            M.count_when(F.array_size("masking_policies_applied") > 0).alias("masked"),
            M.count_when(~F.col("provenance_disclosed")).alias("gaps"),
        )
    )
    return (
        by_user.groupBy("agent_name", "user_role")
        .agg(
            F.sum("n").alias("total_queries"),
            F.count("user_id").alias("unique_users"),
            F.sum("rls").alias("rls_enforced_count"),
            F.sum("masked").alias("masking_enforced_count"),
            F.sum("gaps").alias("provenance_gaps"),
        )
        .filter((F.col("provenance_gaps") > 0) | (F.col("rls_enforced_count") == 0))
        .orderBy(F.desc("total_queries"), "agent_name", "user_role")
    )


def grounding_verification(tel: DataFrame, as_of: datetime, days: int = 7, k: int = 20) -> DataFrame:
    keys = ["agent_name", "resolved_semantic_view", "resolved_metric"]
    return (
        _since(tel, "timestamp", as_of, days)
        .filter("grounded")
        .groupBy(*keys)
        .agg(
            _rows().alias("usage_count"),
            M.mean(F.sum("confidence_score"), F.count("confidence_score"), 3).alias("avg_confidence"),
        )
        .orderBy(F.desc("usage_count"), *keys)
        .limit(k)
    )


def resolution_patterns(log: DataFrame, as_of: datetime, k: int = 30) -> DataFrame:
    """How often each combination of metrics needed disambiguation or a human."""
    return (
        _since(log, "created_at", as_of, 7)
        .groupBy("agent_name", "metrics_used")
        .agg(
            _rows().alias("query_count"),
            M.mean(F.sum("resolution_confidence"), F.count("resolution_confidence")).alias("avg_confidence"),
            M.mean(F.sum("execution_time_ms"), F.count("execution_time_ms")).alias("avg_execution_ms"),
            M.count_when(F.col("disambiguation_applied")).alias("disambiguation_count"),
            M.count_when(F.col("escalated")).alias("escalation_count"),
        )
        .orderBy(F.desc("query_count"), "agent_name", "metrics_used")
        .limit(k)
    )


def escalation_analysis(escalations: DataFrame, as_of: datetime, days: int = 30, k: int = 20) -> DataFrame:
    keys = ["agent_name", "escalation_reason"]
    recent = _since(escalations, "created_at", as_of, days)
    top = (
        recent.groupBy(*keys)
        .agg(
            _rows().alias("escalation_count"),
            M.mean(F.sum("confidence_score"), F.count("confidence_score"), 3).alias("avg_confidence"),
        )
        .orderBy(F.desc("escalation_count"), *keys)
        .limit(k)
    )
    samples = _samples(recent.join(top.select(*keys), keys, "left_semi"), keys, F.left("user_question", F.lit(80)))
    return top.join(samples, keys, "left").orderBy(F.desc("escalation_count"), *keys)


def test_inventory(tests: DataFrame) -> DataFrame:
    """Active cases by agent, category and expected behaviour."""
    keys = ["agent_name", "test_category", "expected_behavior"]
    return tests.filter("is_active").groupBy(*keys).agg(_rows().alias("test_count"))


def test_inventory_governance(tests: DataFrame) -> DataFrame:
    """The governance side counts every case, active or not."""
    keys = ["agent_name", "test_category", "expected_behavior"]
    return tests.groupBy(*keys).agg(_rows().alias("total_tests"))


def test_run_status(tests: DataFrame) -> DataFrame:
    return (
        tests.filter("is_active")
        .groupBy("agent_name", "test_category")
        .agg(
            _rows().alias("test_count"),
            M.count_when(F.col("last_result") == "PASS").alias("passed"),
            M.count_when(F.col("last_result") == "FAIL").alias("failed"),
            M.count_when(F.col("last_result").isNull()).alias("not_yet_run"),
        )
    )
