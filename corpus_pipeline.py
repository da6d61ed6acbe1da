"""The corpus pipeline: language, exact copies, near copies, benchmark passages, packing.

Each stage reads all documents that its predecessor kept and returns documents with the same
columns; the last returns packed pieces. Decisions are made for rows, so repeated ids stay apart.

Edge cases: documents with a null or empty text, or without a letter, have no language and go in
the first stage, and so do all documents where nothing is labelled with a language; of repeated
rows one stays after exact dedup; an empty table gives empty stages; extra columns are carried along,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.context import cut_lineage, scratch_path
from tallyward.llm import decontaminate, exact_dedup, language_id, packing, simhash
from tallyward.llm.common import free_name, numbered, table


def _numbered(spark: SparkSession, docs: DataFrame) -> tuple[DataFrame, str]:
    """The numbered rows, written once: a second evaluation may number them otherwise, as scan partitions follow the cores there are."""
    rows, row = numbered(docs)
    path = scratch_path(spark, "pipeline-numbered")
    rows.write.parquet(path)
    return spark.read.parquet(path), row


def _without(rows: DataFrame, drop: DataFrame, row: str) -> DataFrame:
    """The rows without the numbers to drop, which are few."""
    return rows.join(cut_lineage(drop.select(row)), row, "left_anti").drop(row)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the network finds; the rest is rejected."""
    return language_id.accepted(docs, language_id.fit(docs))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    rows, row = _numbered(spark, docs)
    return _without(rows, exact_dedup.exact_duplicates(rows, row=row).filter(~F.col("kept")), row)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each component of near duplicates."""
    rows, row = _numbered(spark, docs)
    found = cut_lineage(simhash.near_duplicates(rows, row=row))
    # A component whose ids are all null is known by its fingerprints; each of them keeps one document then.
    group = [F.col("component_id"), F.when(F.col("component_id").isNull(), F.col("fingerprint"))]
    first = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col(row)))[row]
    return _without(rows, found.join(found.groupBy(*group).agg(first.alias(row)), row, "left_anti"), row)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of words with the benchmark. Only the text decides, so rows are known by their id and a
    hash of their text, and need no numbers."""
    mark = free_name(docs, "mark")
    marked = docs.withColumn(mark, F.xxhash64(F.coalesce("text", F.lit(""))))
    found = decontaminate.contamination(marked, table(spark, sf_dir, "benchmark"), row=mark).filter("contaminated")
    hit = cut_lineage(found.select(F.col("doc_id").alias("hit_id"), F.col(mark).alias("hit_mark")).distinct())
    return marked.join(hit, marked[mark].eqNullSafe(hit["hit_mark"]) & marked["doc_id"].eqNullSafe(hit["hit_id"]), "left_anti").drop(mark)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in sequences of tokens."""
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", identify_language),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("decontaminate", drop_benchmark),
    ("pack", pack),
]

#: A trained network, XXH64 and a tokenizer have no SQL twin; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
