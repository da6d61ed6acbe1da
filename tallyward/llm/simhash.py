"""Near duplicates by SimHash, with a segment-popcount embedding for the search.

A fingerprint's 64 bits are cut into 32 segments of two bits; a fingerprint becomes the vector of
its segments' bit counts. The Manhattan distance of two such vectors is never above the Hamming
distance of the fingerprints, so pairs within Manhattan distance 3 contain all links. The vector's
coordinates form eight groups of four; a pair within distance 3 differs in at most three groups, so
it agrees in five of them: for each of the 56 choices of five groups, a grid cell holds the vectors
that agree there, and a pair is sought in the cells that both share (no cell is capped; Spark
splits a large one). Candidates pass the Manhattan bound, then the exact bit distance.

Only distinct fingerprints are compared: copies and equal fingerprints are one point, however many
there are. A point has at most 43,744 others within three bits, whatever the size of the corpus.
Components come from alternating large-star and small-star rounds, each cut by a checkpoint;
minima are written before they are joined back, so Spark can split the rows of a large star.

Edge cases: null and blank texts have fingerprint zero and are linked like any other; a text of
fewer words than a shingle is one shingle; of repeated rows and repeated ids each row gets its row;
a null id never names a component unless all ids of it are null. An empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.context import cut_lineage

SHINGLE, DISTANCE, SEED = 3, 3, 42
GROUPS = 8
#: Shingles whose bits are counted in one step.
STEP = 1 << 14


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """SimHash of the text's word shingles, repeats included; 0 without words."""
    words = text.encode().lower().split()  # on bytes: lower-cases A-Z only, and splits at ASCII white space
    if not words:
        return 0
    width, digest = min(shingle, len(words)), xxhash.xxh64_intdigest
    n, counts = len(words) - width + 1, np.zeros(64, np.int64)
    for first in range(0, n, STEP):
        parts = words[first : min(first + STEP, n) + width - 1]
        spans = parts if width == 1 else map(b" ".join, zip(*(parts[i:] for i in range(width))))
        hashes = np.array([digest(s, SEED) for s in spans], "<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, row: str | None = None) -> DataFrame:
    """(doc_id, print) of each row, and ``row`` if named; the 64 bits as a signed long."""
    ids = ["doc_id", *([row] if row else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t or "", shingle) for t in batch.column(0).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(prints.view(np.int64))], [*ids, "print"])

    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in ids)
    return docs.select("text", *ids).mapInArrow(run, f"{kinds}, print long")


def embedded(value: Column) -> Column:
    """The bit count of each two-bit segment, written in unary (00, 01, 11): bits that differ between two embeddings add up to
    the Manhattan distance of their counts."""
    low, high = F.lit(0x5555555555555555), F.lit(-0x5555555555555556)
    either = (value.bitwiseOR(F.shiftrightunsigned(value, 1))).bitwiseAND(low)
    both = (value.bitwiseAND(F.shiftleft(value, 1))).bitwiseAND(high)
    return either.bitwiseOR(both)


def cells(points: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(cell, print): a point lies in one cell for each choice of groups that a link must leave equal."""
    width, places = 64 // GROUPS, []
    for i, chosen in enumerate(combinations(range(GROUPS), GROUPS - distance)):
        mask = sum(((1 << width) - 1) << (width * g) for g in chosen)
        free = next(g for g in range(GROUPS) if g not in chosen)  # its bits hold the choice, so choices don't meet
        label = i << (width * free)
        signed = [x - (1 << 64) if x >> 63 else x for x in (mask, label)]
        places.append(F.col("vector").bitwiseAND(F.lit(signed[0]).cast("long")).bitwiseOR(F.lit(signed[1]).cast("long")))
    return points.withColumn("vector", embedded(F.col("print"))).select(F.explode(F.array(*places)).alias("cell"), "print")


def links(points: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Pairs (a, b), a < b, of distinct fingerprints at most ``distance`` bits apart."""
    placed = cells(points, distance)
    left, right = placed.withColumnRenamed("print", "a"), placed.withColumnRenamed("print", "b")
    manhattan = F.bit_count(embedded(F.col("a")).bitwiseXOR(embedded(F.col("b"))))
    hamming = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    near = (F.col("a") < F.col("b")) & (manhattan <= distance) & (hamming <= distance)
    return left.join(right, "cell").filter(near).select("a", "b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b): the smallest node of its component."""

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    edges = cut_lineage(edges.select("a", "b"))
    seen = None
    while (now := state(edges)) != seen and now[0]:
        seen = now
        # Large star: every larger neighbour of a node joins the node's smallest neighbour (or itself).
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = cut_lineage(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("root")))
        large = both.filter(F.col("b") > F.col("a")).join(least, "a").select(F.col("root").alias("a"), "b").filter("a < b").distinct()
        # Small star: the smaller neighbours of a node, and the node, join the smallest of them.
        large = cut_lineage(large)
        low = cut_lineage(large.groupBy("b").agg(F.min("a").alias("root")))
        small = large.join(low, "b")
        stars = small.select(F.col("root").alias("a"), F.col("a").alias("b")).unionAll(low.select(F.col("root").alias("a"), "b"))
        edges = cut_lineage(stars.filter("a < b").distinct())
    return edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root")).unionAll(edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, row: str | None = None) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id (the smallest doc_id reachable by links), and ``row`` if named."""
    prints = cut_lineage(fingerprints(docs, shingle, row))
    points = cut_lineage(prints.groupBy("print").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n")))
    rooted = components(links(points.select("print"), distance))
    joined = points.join(rooted, points["print"] == rooted["node"], "left").select("print", "first_id", F.coalesce("root", "print").alias("root"))
    names = cut_lineage(joined.groupBy("root").agg(F.min("first_id").alias("component_id")))  # a table of its own, so that Spark can split a large component
    classes = cut_lineage(joined.join(names, "root").select("print", "component_id"))
    return prints.join(classes, "print", "left").select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id", *([row] if row else []))
