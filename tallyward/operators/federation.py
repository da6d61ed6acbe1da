"""Hub and spokes: published definitions, resolution and synchronisation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import measures as M
from .governance import one_row


def glossary_latest(versions: DataFrame) -> DataFrame:
    """The current definition of each term and the version it supersedes.

    Distinct version numbers are few next to the rows that repeat them: they are reduced where the rows are read, and Spark keeps only the two
    newest of a term in each task before a term's versions meet (a group limit on the rank). Counts combine the same way.
    """
    place = F.row_number().over(Window.partitionBy("term").orderBy(F.desc_nulls_last("version_id")))
    numbered = versions.groupBy("term", "version_id").agg(F.max("canonical_definition").alias("canonical_definition"))
    newest = (
        numbered.withColumn("_place", place).filter("_place <= 2").groupBy("term").agg(
            F.max(F.when(F.col("_place") == 1, F.struct("version_id", "canonical_definition"))).alias("_latest"),
            F.max(F.when(F.col("_place") == 2, F.col("version_id"))).alias("supersedes_version"),
        )
    )
    counts = versions.groupBy("term").agg(F.count(F.lit(1)).alias("versions"))
    return newest.join(counts, "term").select(
        "term",
        F.col("_latest.version_id").alias("version_id"),
        F.col("_latest.canonical_definition").alias("canonical_definition"),
        "supersedes_version",
        "versions",
    )


def spoke_resolve_metrics(requests: DataFrame, cat: DataFrame) -> DataFrame:
    """Certified definition of each requested metric, or NOT_FOUND.

    A name certified in several domains resolves to the first by full name, never to two rows.
    """
    fields = ["domain", "business_definition", "semantic_view_fqn", "certification_date", "data_quality_score"]
    certified = (
        cat.filter(F.col("certification_status") == "CERTIFIED")
        .groupBy("metric_name")
        .agg(F.min_by(F.struct(*fields), "metric_fqn").alias("_definition"))
    )
    found = F.col("_definition").isNotNull()
    return requests.join(certified, "metric_name", "left").select(
        *requests.columns,
        F.when(found, "RESOLVED").otherwise("NOT_FOUND").alias("status"),
        F.lit("hub_direct").alias("source"),
        F.when(found, 0).alias("replica_lag_seconds"),
        F.when(found, "CERTIFIED").alias("certification_status"),
        *[F.col(f"_definition.{f}").alias(f) for f in fields],
    )


def glossary_sync(spokes: DataFrame, versions: DataFrame) -> DataFrame:
    """How far each spoke is behind the hub's newest version."""
    hub = versions.agg(F.max("version_id")).scalar()
    behind = F.col("hub_version") > F.col("local_version")
    return spokes.withColumn("hub_version", hub).select(
        "spoke",
        "local_version",
        "hub_version",
        F.when(behind, "OUT_OF_SYNC").otherwise("IN_SYNC").alias("status"),
        F.when(behind, F.col("hub_version") - F.col("local_version")).otherwise(0).alias("versions_behind"),
    )


def federation_health(cat: DataFrame, dom: DataFrame, glossary: DataFrame, versions: DataFrame) -> DataFrame:
    counts = one_row(
        cat.agg(M.count_when(F.col("certification_status") == "CERTIFIED").alias("certified_metrics")),
        dom.agg(M.count_when(F.col("is_active")).alias("active_domains")),
        glossary.agg(F.count(F.lit(1)).alias("glossary_terms")),
        versions.agg(F.max("version_id").alias("glossary_version")),
    )
    return counts.select(
        F.lit("HUB").alias("node"),
        F.lit("governance").alias("database_name"),
        "*",
        F.lit(0).alias("replication_lag_seconds"),
        F.lit("PRIMARY").alias("replication_role"),
    )
