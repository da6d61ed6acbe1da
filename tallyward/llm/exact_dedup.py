"""Exact duplicates by a content sort.

Normalised texts are range-partitioned at sampled splitters and sorted inside each partition, so
equal texts stand next to each other; Spark compares each with its neighbour in full and numbers
the rows of a run. The sort key starts with a short prefix and a 64-bit hash of the text, which
keeps the sampled splitters small, and ends with a shard of the row's id: the copies of one text
spread over up to ``shards`` runs, each in its own place of the range, so a text that a third of
all rows share does not end in one task. A row that differs from its neighbour begins a run; a run is
counted as what it is, and its first row is its best. Only runs meet by length and SHA-256, one for each
shard of a text. Texts cross the network once; everything after carries digests.

Built from DataFrame functions only.

Edge cases: a null text counts as empty, and all empty texts are one group. A null id loses ties
against any id. Of repeated rows (same id, same text) exactly one is kept. An empty table gives an
empty result. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyward.context import cut_lineage

from .common import SPACES

PREFIX = 48
#: What names a run of equal texts: its place in the order, and its number there.
RUN = ["prefix", "hash", "shard", "run"]


def exact_duplicates(docs: DataFrame, shards: int = 32, row: str | None = None) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, and the ``row`` column if named.

    Texts are equal when identical without ASCII white space. Of a group stays the row with the
    longest original text, then the smallest doc_id.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    number = F.col(row) if row else F.lit(None).cast("long")
    rows = (
        docs.select("doc_id", number.alias("number"), F.translate(text, SPACES, "").alias("body"), F.char_length(text).alias("n"))
        .withColumn("prefix", F.substring("body", 1, PREFIX))
        .withColumn("hash", F.xxhash64("body"))
        .withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int"))
    )
    # The range partitioning on (prefix, hash, shard) already holds each window's rows together: no second shuffle.
    place = Window.partitionBy("prefix", "hash", "shard").orderBy("body", F.desc("n"), F.asc_nulls_last("doc_id"))
    before = F.lag("body").over(place)
    sorted_ = rows.repartitionByRange("prefix", "hash", "shard").withColumn("leads", before.isNull() | (before != F.col("body")))
    thin = cut_lineage(
        sorted_.withColumn("run", F.sum(F.col("leads").cast("int")).over(place.rowsBetween(Window.unboundedPreceding, Window.currentRow)).cast("int"))
        .select("doc_id", "number", "n", *RUN, "leads", F.length("body").alias("length"), F.unhex(F.sha2("body", 256)).alias("sha"))
    )
    best = F.struct((-F.col("n")).alias("n"), F.col("doc_id").isNull().alias("absent"), "doc_id")
    runs = thin.groupBy(*RUN).agg(F.count("*").alias("size"), F.min(F.when(F.col("leads"), F.struct("length", "sha", best.alias("best")))).alias("first"))
    groups = (
        runs.groupBy("first.length", "first.sha")
        .agg(F.sum("size").alias("group_size"), F.min("first.best").alias("best"), F.collect_list(F.struct(*RUN)).alias("runs"))
        .filter(F.col("group_size") > 1)
        .select("group_size", F.col("best.doc_id").alias("keep_id"), F.lit(True).alias("many"), F.inline("runs"))
    )
    # Only texts with copies join back, a row for each of their runs: a hot group is spread by its shards.
    joined = thin.join(groups, RUN, "left")
    many = F.col("many").isNotNull()
    return joined.select(
        "doc_id",
        F.when(many, F.col("keep_id")).otherwise(F.col("doc_id")).alias("keep_id"),
        F.when(many, F.col("group_size")).otherwise(F.lit(1)).cast("long").alias("group_size"),
        (~many | (F.col("leads") & F.col("doc_id").eqNullSafe(F.col("keep_id")))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
        *([F.col("number").alias(row)] if row else []),
    )
