"""Deterministic binding of a question to a governed metric.

The phrase rules are declared configuration, so they enter the plan as one constant array that
is filtered per question: no join, no UDF, and the whole question is matched word by word.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Binding:
    agent: str
    phrase: str
    metric: str
    view: str


@dataclass(frozen=True)
class Boundary:
    agent: str
    phrase: str
    behavior: str  # REFUSE, REDIRECT or ESCALATE
    boundary_type: str


_REVENUE, _BOOKINGS, _HEALTH, _SUPPORT = "revenue_metrics_v2", "pipeline_metrics", "customer_health", "support_metrics"

# --- Fixed values: phrases of each domain and the metric they mean
_FINANCE_PHRASES = [
    ("revenue", "recognized_revenue", _REVENUE),
    ("growth", "recognized_revenue", _REVENUE),
    ("arr", "annual_recurring_revenue", _REVENUE),
    ("run rate", "annual_recurring_revenue", _REVENUE),
    ("revenue run rate", "annual_recurring_revenue", _REVENUE),
    ("recurring revenue", "annual_recurring_revenue", _REVENUE),
    ("subscription revenue", "annual_recurring_revenue", _REVENUE),
    ("net retention", "net_dollar_retention", _REVENUE),
    ("bookings", "total_bookings", _BOOKINGS),  # the view that declares it
]
_SALES_PHRASES = [
    ("pipeline", "pipeline_value", _BOOKINGS),
    ("forecast", "pipeline_value", _BOOKINGS),
    ("bookings", "total_bookings", _BOOKINGS),
    ("deal size", "total_bookings", _BOOKINGS),
    ("win rate", "win_rate", _BOOKINGS),
]
_SERVICE_PHRASES = [
    ("health", "health_score", _HEALTH),
    ("health score", "health_score", _HEALTH),
    ("health scores", "health_score", _HEALTH),
    ("nps", "nps_score", _HEALTH),
    ("churn risk", "churn_risk", _HEALTH),
    ("at risk", "churn_risk", _HEALTH),
    ("churned", "churned_customer_count", _HEALTH),
    ("resolution time", "resolution_time_hours", _SUPPORT),
    ("csat", "csat_score", _SUPPORT),
    ("satisfaction", "csat_score", _SUPPORT),
]
_EXECUTIVE_PHRASES = [
    *[p for p in _FINANCE_PHRASES if p[0] != "growth"],
    *[p for p in _SALES_PHRASES if p[0] != "bookings"],
    *_SERVICE_PHRASES,
    ("renewal rates", "net_dollar_retention", _REVENUE),
    ("support tickets", "resolution_time_hours", _SUPPORT),
]

# --- Fixed values: what each agent must not answer
_PAY = [("salary", "REFUSE", "compensation"), ("compensation", "REFUSE", "compensation"), ("commission", "REFUSE", "compensation")]
_FUTURE = [
    ("next quarter", "REFUSE", "forward_looking"),
    ("next year", "REFUSE", "forward_looking"),
    ("guidance", "REFUSE", "forward_looking"),
    ("projection", "REFUSE", "forward_looking"),
    ("projections", "REFUSE", "forward_looking"),
]
_FINANCE_LIMITS = [
    *_PAY,
    *_FUTURE,
    ("compare to", "REFUSE", "competitor"),
    ("competitor", "REFUSE", "competitor"),
    ("churn", "REDIRECT", "out_of_scope"),
    ("nps", "REDIRECT", "out_of_scope"),
    ("health score", "REDIRECT", "out_of_scope"),
    ("reorg", "ESCALATE", "org_change"),
]
_SALES_LIMITS = [*_PAY, ("will close", "REFUSE", "forward_looking"), ("revenue", "REDIRECT", "out_of_scope")]
_SERVICE_LIMITS = [("contract value", "REFUSE", "contract_value"), ("revenue", "REDIRECT", "out_of_scope")]
_EXECUTIVE_LIMITS = [*_PAY, *_FUTURE]

BINDINGS = [
    Binding(agent, *phrase)
    for agent, phrases in (
        ("finance_agent", _FINANCE_PHRASES),
        ("sales_agent", _SALES_PHRASES),
        ("cs_agent", _SERVICE_PHRASES),
        ("executive_agent", _EXECUTIVE_PHRASES),
    )
    for phrase in phrases
]
BOUNDARIES = [
    Boundary(agent, *limit)
    for agent, limits in (
        ("finance_agent", _FINANCE_LIMITS),
        ("sales_agent", _SALES_LIMITS),
        ("cs_agent", _SERVICE_LIMITS),
        ("executive_agent", _EXECUTIVE_LIMITS),
    )
    for limit in limits
]


def _rule_table(entries: Sequence, fields: Sequence[str]) -> Column:
    """The rules as one constant array of structs: longest phrase first when sorted, ties by phrase."""

    def quoted(text: str) -> str:
        return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"

    rows = [
        f"named_struct('size', {len(e.phrase)}, 'phrase', {quoted(e.phrase)}, 'padded', {quoted(f' {e.phrase} ')}, "
        f"'agent', {quoted(e.agent)}, "
        + ", ".join(f"'{f}', {quoted(getattr(e, f))}" for f in fields)
        + ")"
        for e in entries
    ]
    return F.expr(f"array({', '.join(rows)})")


def _matching(rules: Column) -> Column:
    return F.filter(rules, lambda r: (r["agent"] == F.col("agent_name")) & F.contains(F.col("_words"), r["padded"]))


def bind_questions(
    questions: DataFrame,
    bindings: Sequence[Binding] = tuple(BINDINGS),
    boundaries: Sequence[Boundary] = tuple(BOUNDARIES),
    minimum_confidence: float = 0.8,
) -> DataFrame:
    """Metric, view and behaviour for each question of an agent.

    A boundary phrase wins. Otherwise the longest metric phrase binds; phrases from several views
    make it a multi-view answer; no phrase escalates; low confidence asks back first.
    """
    words = F.concat(F.lit(" "), F.regexp_replace(F.lower("question"), "[^a-z0-9]+", " "), F.lit(" "))
    bound = (
        questions.withColumn("_words", words)
        .withColumn("_hits", _matching(_rule_table(bindings, ("metric", "view"))))
        .withColumn("_stops", _matching(_rule_table(boundaries, ("behavior", "boundary_type"))))
        .withColumn("_hit", F.array_max("_hits"))
        .withColumn("_stop", F.array_max("_stops"))
        .withColumn("_views", F.array_size(F.array_distinct(F.transform("_hits", lambda h: h["view"]))))
    )
    behavior = (
        F.when(F.col("_stop").isNotNull(), F.col("_stop.behavior"))
        .when(F.col("_hit").isNull(), "ESCALATE")
        .when(F.col("confidence") < minimum_confidence, "CLARIFY")
        .when(F.col("_views") > 1, "MULTI_VIEW_ANSWER")
        .otherwise("ANSWER")
    )
    free = F.col("_stop").isNull()
    return bound.select(
        *questions.columns,
        F.when(free, F.col("_hit.metric")).alias("resolved_metric"),
        F.when(free, F.col("_hit.view")).alias("resolved_view"),
        F.coalesce("_stop.phrase", "_hit.phrase").alias("matched_phrase"),
        F.col("_stop.boundary_type").alias("boundary_type"),
        behavior.alias("behavior"),
    )


def bound_targets(bound: DataFrame, declared: DataFrame) -> DataFrame:
    """Questions by resolved view and metric, and whether a model declares that pair (``model``, ``metric``)."""
    known = declared.select(F.col("model").alias("resolved_view"), F.col("metric").alias("resolved_metric")).distinct()
    counts = bound.filter(F.col("resolved_metric").isNotNull()).groupBy("resolved_view", "resolved_metric").agg(F.count(F.lit(1)).alias("questions"))
    return counts.join(known.withColumn("_known", F.lit(True)), ["resolved_view", "resolved_metric"], "left").select(
        "resolved_view", "resolved_metric", "questions", F.coalesce("_known", F.lit(False)).alias("declared")
    )
