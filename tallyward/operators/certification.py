"""Certification records: review urgency, health of the layer, audit trail."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import measures as M


def certification_review_urgency(certs: DataFrame, as_of: date) -> DataFrame:
    due = F.col("next_review_date")
    urgency = (
        F.when(due < D.lit_date(as_of), "OVERDUE")
        .when(due < D.lit_date(D.shift_days(as_of, 14)), "DUE SOON")
        .otherwise("CURRENT")
    )
    return certs.filter(F.col("status") == "certified").select(
        "semantic_view",
        "metric_name",
        "status",
        "certified_by",
        "certification_date",
        "next_review_date",
        urgency.alias("review_urgency"),
    )


def semantic_layer_scorecard(certs: DataFrame, as_of: date) -> DataFrame:
    """Three indicators from one pass over the certifications."""
    certified = F.col("status") == "certified"
    counts = certs.agg(
        F.count(F.lit(1)).alias("total"),
        M.count_when(certified).alias("certified"),
        M.count_when(certified & (F.col("next_review_date") >= D.lit_date(as_of))).alias("current"),
        M.count_when(F.col("status") == "deprecated").alias("deprecated"),
    )
    kpis = [
        ("Certified Metrics", "certified", "total"),
        ("Reviews Current", "current", "certified"),
        ("Deprecated (Pending Removal)", "deprecated", "total"),
    ]
    entries = [
        F.struct(F.lit(label).alias("kpi"), F.col(part).alias("certified_count"), F.col(whole).alias("total_count"))
        for label, part, whole in kpis
    ]
    return counts.select(F.inline(F.array(*entries))).withColumn(
        "pct", M.pct(F.col("certified_count"), F.col("total_count"))
    )


def record_certification_event(audit: DataFrame, events: DataFrame, as_of: datetime) -> DataFrame:
    """Audit trail after the events are appended; an event without a time gets ``as_of``."""
    own = F.col("action_date") if "action_date" in events.columns else F.lit(None)
    stamped = events.withColumn("action_date", F.coalesce(own.cast("timestamp_ntz"), D.lit_ts(as_of)))
    return audit.unionByName(stamped)
