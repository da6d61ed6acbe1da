"""Tests of facts and metrics: keys, relationships, systems of record, snapshots, names."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import measures as M
from . import metrics


def orphan_check(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Fact rows, NULL keys included, without a dimension row. Facts are counted by key first, so a
    key with a third of the rows is one row at the join."""
    by_key = fact.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    missing = by_key.join(dim.select(key), key, "left_anti")
    return missing.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("orphan_records"))


def relationship_integrity(
    relationships: Mapping[str, tuple[DataFrame, DataFrame, str]], as_of: date, date_column: str = "recognized_date"
) -> DataFrame:
    """PASS or FAIL per declared relationship ``label -> (fact, dimension, key)`` over the last year."""
    since = D.lit_date(D.shift_months(as_of, -12))
    rows = [
        orphan_check(fact.filter(F.col(date_column) >= since), dim, key).select(
            F.lit(label).alias("relationship"),
            F.col("orphan_records").alias("orphan_count"),
            F.when(F.col("orphan_records") == 0, "PASS")
            .otherwise(F.concat(F.lit("FAIL: "), F.col("orphan_records").cast("string"), F.lit(" orphans found")))
            .alias("test_result"),
        )
        for label, (fact, dim, key) in relationships.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def arr_reconciliation(rev: DataFrame, reported: DataFrame, as_of: date, tolerance: float = 1.0) -> DataFrame:
    """ARR from the facts next to each reported figure for the last complete month."""
    month = D.lit_date(D.last_complete_month(as_of)[0])
    semantic = metrics.arr(rev, as_of).scalar()
    compared = reported.filter(F.col("metric_month") == month).select(
        semantic.alias("semantic_arr"), F.col("arr_reported").alias("finance_arr")
    )
    variance = F.abs(F.col("semantic_arr") - F.col("finance_arr"))
    return compared.withColumn("variance", variance).withColumn(
        "validation_result",
        F.when(F.col("variance") <= tolerance, "PASS").otherwise("FAIL: Investigate variance"),
    )


def snapshot_regression(
    rev: DataFrame, snapshots: DataFrame, start: date, end: date, view: str = "finance_revenue", tolerance: float = 0.01
) -> DataFrame:
    """Monthly revenue against the newest certified snapshot; months missing on a side drop out."""
    certified = snapshots.filter(F.col("semantic_view") == view)
    newest = certified.agg(F.max("snapshot_date")).scalar()
    snap = certified.filter(F.col("snapshot_date") == newest).select(
        "month", F.col("total_revenue").alias("snap_total"), F.col("recurring_revenue").alias("snap_recurring")
    )
    current = (
        rev.filter((F.col("recognized_date") >= D.lit_date(start)) & (F.col("recognized_date") < D.lit_date(end)))
        .groupBy(F.trunc("recognized_date", "month").alias("month"))
        .agg(
            F.sum("amount_usd").alias("total"),
            M.sum_when(F.col("is_recurring"), F.col("amount_usd")).alias("recurring"),
        )
    )

    def check(now: str, then: str, name: str):
        drifted = F.abs(F.col(now) - F.col(then)) > tolerance
        return F.when(drifted, f"FAIL: {name} drifted").otherwise("PASS").alias(f"{name}_check")

    return current.join(snap, "month").select(
        "month", check("total", "snap_total", "total_revenue"), check("recurring", "snap_recurring", "recurring_revenue")
    )


def metric_consumers(consumers: DataFrame, view: str, metric: str, as_of: date, days: int = 90) -> DataFrame:
    """Who used a metric lately, heaviest users first: the list to warn before a change."""
    return (
        consumers.filter(
            (F.col("semantic_view_name") == view)
            & (F.col("metric_name") == metric)
            & (F.col("last_query_date") >= D.lit_date(D.shift_days(as_of, -days)))
        )
        .select("consumer_type", "consumer_name", "last_query_date", "query_count_30d")
        .orderBy(F.desc("query_count_30d"), "consumer_type", "consumer_name")
    )


def constraint_violations(df: DataFrame, keys: list[str], not_null: list[str]) -> DataFrame:
    """Rows that break the declared key and NOT NULL rules, one result row per rule.

    Parquet enforces neither. Duplicates are the rows beyond the first of each key.
    """
    by_key = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in not_null]
    )
    totals = by_key.agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("dup"),
        *[F.coalesce(F.sum(f"null_{c}"), F.lit(0)).alias(f"null_{c}") for c in not_null],
    )
    rules = [("unique(" + ", ".join(keys) + ")", "dup")] + [(f"not_null({c})", f"null_{c}") for c in not_null]
    entries = [
        F.struct(F.lit(label).alias("constraint_name"), F.col(column).alias("violations")) for label, column in rules
    ]
    return totals.select(F.inline(F.array(*entries))).withColumn(
        "status", F.when(F.col("violations") == 0, "PASS").otherwise("FAIL")
    )


def naming_conventions_check(assets: DataFrame, rules: DataFrame) -> DataFrame:
    """Every asset name against the active pattern of its type; the level says what a miss means. An asset of a type without a
    rule stays, with neither a level nor a result."""
    active = rules.filter("is_active").select("asset_type", "pattern_regex", "enforcement_level")
    matches = M.whole_match(F.col("asset_name"), F.col("pattern_regex"))
    return assets.join(active, "asset_type", "left").select(
        "asset_type",
        "asset_name",
        "enforcement_level",
        F.when(F.col("pattern_regex").isNotNull() & matches, "PASS").otherwise(F.col("enforcement_level")).alias("result"),
    )


def semantic_version_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """Version bump of every metric that differs between two catalogs.

    A new metric is MINOR; a removed one, or one computed differently, is MAJOR; a change of the
    wording alone is PATCH.
    """
    columns = ["metric_name", "technical_definition", "business_definition"]
    a = old.select(*columns, F.lit(True).alias("present")).alias("a")
    b = new.select(*columns, F.lit(True).alias("present")).alias("b")
    joined = a.join(b, F.col("a.metric_name") == F.col("b.metric_name"), "full_outer")
    change = (
        F.when(F.col("a.present").isNull(), "added")
        .when(F.col("b.present").isNull(), "removed")
        .when(~F.col("a.technical_definition").eqNullSafe(F.col("b.technical_definition")), "definition changed")
        .when(~F.col("a.business_definition").eqNullSafe(F.col("b.business_definition")), "description clarified")
    )
    bump = (
        F.when(F.col("change") == "added", "MINOR")
        .when(F.col("change") == "description clarified", "PATCH")
        .otherwise("MAJOR")
    )
    return (
        joined.select(F.coalesce("a.metric_name", "b.metric_name").alias("metric_name"), change.alias("change"))
        .filter("change IS NOT NULL")
        .withColumn("version_bump", bump)
    )
