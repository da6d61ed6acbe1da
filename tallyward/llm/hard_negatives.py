"""Hard-negative mining with segment summaries.

Vectors become whole numbers and are stored in blocks together with summaries: for 1, 4 and 16
segments, each segment's mean and deviation. Of two vectors, a segment of length n contributes
n * (product of the means) to their inner product, give or take n * (product of the deviations), so
summaries bound a score from both sides. A pair is looked at with one segment first; only pairs
that the bounds do not decide go on to finer segments, and only what is left is scored exactly.

Anchors are a stated query set against all rows. Spark lays both out as a grid: a cell holds a
group of anchors and a group of blocks, of bounded size each, so no task sees all anchors or all
rows. A cell keeps the best of each anchor it has found so far; a pair whose upper bound lies below
the worst of a full list cannot enter it. First every anchor's positives are found this way, then
the negatives inside the score bands that the positives open. The cells' lists are merged by a
window over at most (cells of a row group) x (list length) rows for each anchor.

Edge cases: rows with a null id, label or vector, or any null or non-finite component take no part.
Vectors of different lengths have no score with each other; empty vectors score 0. Ties go to the
smaller id. Rows that repeat an id are partners of their own, but never of the anchor with that id;
of several anchors with one id the one with the smallest label, then vector, asks. Anchors without
positives, and positives without negatives, give no rows. Scores beyond a long count as its ends.
An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyward.context import cut_lineage

POSITIVES, NEGATIVES = 5, 10
#: A negative's score lies between these percents of the positive's.
BAND = (30, 90)
SEGMENTS = (1, 4, 16)
#: Rows of a block, blocks and anchors of a cell.
BLOCK, CELL_BLOCKS, CELL_ANCHORS = 1024, 64, 2048
#: Pairs scored one by one in a step; where more of a block is open than one in so many, it is scored whole.
STEP, DENSE = 1 << 16, 4
NONE, MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max


def usable(rows: DataFrame) -> Column:
    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))

    return F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & F.forall("embedding", finite)


def codes(vector: Column) -> Column:
    """Whole numbers of the components; beyond a long they count as its ends."""
    return F.transform(vector, lambda x: F.floor(F.lit(256.0) * x.cast("double")))


def summaries(vectors: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(means, deviations) for each number of segments, both times the root of the segment's length."""
    dim, values, out = vectors.shape[1], vectors.astype(np.float64), []
    for n in SEGMENTS:
        if n > dim:
            break
        cuts = np.arange(n + 1) * dim // n
        lengths = np.diff(cuts)
        means = np.add.reduceat(values, cuts[:-1], axis=1) / lengths
        spread = values - np.repeat(means, lengths, axis=1)
        deviations = np.sqrt(np.add.reduceat(spread * spread, cuts[:-1], axis=1) / lengths)
        out.append((means * np.sqrt(lengths), deviations * np.sqrt(lengths)))
    return out


def exact_scores(anchors: np.ndarray, rows: np.ndarray, open_: np.ndarray) -> np.ndarray:
    """Inner products of the open pairs, ``NONE`` elsewhere."""
    out = np.full(open_.shape, NONE, np.int64)
    top = [int(max(abs(int(x.max())), abs(int(x.min())))) if x.size else 0 for x in (anchors, rows)]
    if top[0] * top[1] * max(1, anchors.shape[1]) >= 1 << 53:  # beyond what a double holds exactly
        for i, j in zip(*np.nonzero(open_)):
            out[i, j] = max(-MOST, min(MOST, sum(a * b for a, b in zip(anchors[i].tolist(), rows[j].tolist()))))
        return out
    a, b = anchors.astype(np.float64), rows.astype(np.float64)
    if open_.sum() * DENSE > open_.size:
        return np.where(open_, (a @ b.T).astype(np.int64), NONE)
    i, j = np.nonzero(open_)
    for first in range(0, len(i), STEP):
        x, y = i[first : first + STEP], j[first : first + STEP]
        out[x, y] = np.einsum("ij,ij->i", a[x], b[y]).astype(np.int64)
    return out


class Lists:
    """The best ``k`` (score, id) of each of ``n`` lists so far: higher scores first, then smaller ids."""

    def __init__(self, n: int, k: int):
        self.k, self.worst = k, np.full(n, NONE, np.int64)
        self.list = self.score = self.id = np.zeros(0, np.int64)

    def add(self, which: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """``scores`` has a row for each list in ``which`` and a column for each id."""
        if scores.shape[1] > self.k:
            reach = np.partition(scores, -self.k, axis=1)[:, -self.k]
            self.worst[which] = np.maximum(self.worst[which], reach)
        i, j = np.nonzero((scores >= self.worst[which, None]) & (scores > NONE))
        at, score, id_ = np.append(self.list, which[i]), np.append(self.score, scores[i, j]), np.append(self.id, ids[j])
        order = np.lexsort((id_, -score, at))
        at, score, id_ = at[order], score[order], id_[order]
        place = np.arange(len(at)) - np.searchsorted(at, at)
        full = place == self.k - 1
        self.worst[at[full]] = np.maximum(self.worst[at[full]], score[full])
        keep = place < self.k
        self.list, self.score, self.id = at[keep], score[keep], id_[keep]


def undecided(anchors: list, rows: list, scale: np.ndarray, open_: np.ndarray, least: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Of the open pairs those whose score, by the bounds, may lie between ``least`` and ``most`` of their anchor."""
    for (mean_a, dev_a), (mean_b, dev_b) in zip(anchors, rows):
        if not open_.any():
            break
        if open_.sum() * DENSE > open_.size:
            middle, radius = mean_a @ mean_b.T, dev_a @ dev_b.T + scale
            open_ = open_ & ~(middle + radius < least[:, None]) & ~(middle - radius > most[:, None])
            continue
        open_, (i, j) = open_.copy(), np.nonzero(open_)
        for first in range(0, len(i), STEP):
            x, y = i[first : first + STEP], j[first : first + STEP]
            middle = np.einsum("ij,ij->i", mean_a[x], mean_b[y])
            radius = np.einsum("ij,ij->i", dev_a[x], dev_b[y]) + scale[x, y]
            open_[x, y] = ~(middle + radius < least[x]) & ~(middle - radius > most[x])
    return open_


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packs rows of one length into blocks: ids, labels, numbers and summaries as bytes."""
    serial = TaskContext.get().partitionId() << 33
    waiting: dict[int, list[tuple]] = {}

    def packed(dim: int) -> pa.RecordBatch:
        nonlocal serial
        ids, labels, vectors = zip(*waiting.pop(dim))
        matrix = np.array(vectors, np.int64).reshape(len(ids), dim)
        small = matrix.astype(np.int16) if not matrix.size or -32768 <= matrix.min() and matrix.max() <= 32767 else matrix
        parts = [p.astype("<f4").tobytes() for pair in summaries(matrix) for p in pair]
        serial += 1
        return pa.RecordBatch.from_pydict(
            {"block": [serial], "dim": pa.array([dim], pa.int32()), "ids": [np.array(ids, "<i8").tobytes()], "labels": [np.array(labels, "<i8").tobytes()],
             "width": pa.array([small.dtype.itemsize], pa.int32()), "codes": [small.tobytes()], "parts": pa.array([parts], pa.list_(pa.binary()))}
        )

    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(3))):
            waiting.setdefault(len(row[2]), []).append(row)
            if len(waiting[len(row[2])]) == BLOCK:
                yield packed(len(row[2]))
    for dim in list(waiting):
        yield packed(dim)


def stored_blocks(rows: DataFrame) -> DataFrame:
    """The usable rows (vec_id, label, codes) as blocks with their summaries, written once."""
    schema = "block long, dim int, ids binary, labels binary, width int, codes binary, parts array<binary>"
    return cut_lineage(rows.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), "codes").mapInArrow(_blocks, schema))


def _unpacked(block: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, list]:
    ids, labels = np.frombuffer(block["ids"], "<i8"), np.frombuffer(block["labels"], "<i8")
    matrix = np.frombuffer(block["codes"], f"<i{block['width']}").reshape(len(ids), block["dim"]).astype(np.int64)
    parts = [np.frombuffer(p, "<f4").reshape(len(ids), -1).astype(np.float64) for p in block["parts"]]
    return ids, labels, matrix, list(zip(parts[::2], parts[1::2]))


def _cell(k: int, band: tuple[int, int] | None):
    """Searches one cell: for each anchor the best of its label, or with a ``band`` for each positive the best of other labels."""

    def run(key, blocks: pa.Table, asking: pa.Table) -> pa.Table:
        by_dim: dict[int, list[dict]] = {}
        for row in asking.select(["anchor_id", "label", "codes", "positives"]).to_pylist():
            by_dim.setdefault(len(row["codes"]), []).append(row)
        prepared, out = {}, []
        for dim, rows in by_dim.items():
            matrix = np.array([r["codes"] for r in rows], np.int64).reshape(len(rows), dim)
            bands = [(i, p["place"], -(-band[0] * p["score"] // 100), band[1] * p["score"] // 100) for i, r in enumerate(rows) for p in r["positives"] or ()] if band else [(i, 0, -MOST, MOST) for i in range(len(rows))]
            owner, place, low, high = (np.array(x, np.int64) for x in zip(*bands)) if bands else (np.zeros(0, np.int64),) * 4
            prepared[dim] = (np.array([r["anchor_id"] for r in rows], np.int64), np.array([r["label"] for r in rows], np.int64), matrix, summaries(matrix), owner, place, low, high, Lists(len(owner), k))
        for i in range(blocks.num_rows):
            block = blocks.slice(i, 1).to_pylist()[0]
            if block["dim"] not in prepared:
                continue
            ids, labels, matrix, parts = _unpacked(block)
            anchor_ids, anchor_labels, asked, asked_parts, owner, _, low, high, lists = prepared[block["dim"]]
            if not len(owner):
                continue
            same = anchor_labels[:, None] == labels
            open_ = (~same if band else same) & (anchor_ids[:, None] != ids)
            # What a score must reach to enter any of its anchor's lists, and what it may reach at most.
            least, most = np.full(len(asked), MOST, np.float64), np.full(len(asked), -MOST, np.float64)
            np.minimum.at(least, owner, np.maximum(low, lists.worst).astype(np.float64))
            np.maximum.at(most, owner, high.astype(np.float64))
            norms = [np.sqrt((x.astype(np.float64) ** 2).sum(1)) for x in (asked, matrix)]
            slack = 1e-5 * norms[0][:, None] * norms[1] + 1  # the stored summaries are single floats
            scores = exact_scores(asked, matrix, undecided(asked_parts, parts, slack, open_, least, most))
            for first in range(0, len(owner), CELL_ANCHORS):
                which = np.arange(first, min(first + CELL_ANCHORS, len(owner)))
                mine = scores[owner[which]]
                lists.add(which, np.where((mine >= low[which, None]) & (mine <= high[which, None]), mine, NONE), ids)
        for anchor_ids, *_, owner, place, _, _, lists in prepared.values():
            out.append((anchor_ids[owner[lists.list]], place[lists.list], lists.id, lists.score))
        columns = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 4
        return pa.table([pa.array(columns[0]), pa.array(columns[1], pa.int32()), pa.array(columns[2]), pa.array(columns[3])], ["anchor_id", "place", "partner_id", "score"])

    return run


def _best(blocks: DataFrame, asking: DataFrame, cells: tuple[int, int], k: int, band: tuple[int, int] | None) -> DataFrame:
    """(anchor_id, place, partner_id, score, rank): the best ``k`` of each anchor, or of each of its positives."""
    row_groups, anchor_groups = cells
    left = blocks.select(
        F.pmod(F.xxhash64("block"), F.lit(row_groups)).alias("g"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(anchor_groups - 1).cast("long"))).alias("a"), *blocks.columns
    )
    right = asking.select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(row_groups - 1).cast("long"))).alias("g"), F.pmod(F.xxhash64("anchor_id"), F.lit(anchor_groups)).alias("a"), *asking.columns
    )
    found = left.groupBy("g", "a").cogroup(right.groupBy("g", "a")).applyInArrow(_cell(k, band), "anchor_id long, place int, partner_id long, score long")
    order = Window.partitionBy("anchor_id", "place").orderBy(F.desc("score"), "partner_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(rows: DataFrame, anchors: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, band: tuple[int, int] = BAND) -> DataFrame:
    """Hard negatives of the rows (vec_id, label, embedding) that ``anchors`` picks: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    An anchor's positives are its best rows of the same label; a positive's negatives are the best rows of other labels
    whose score lies between ``band`` percents of the positive's.
    """
    ready = rows.filter(usable(rows)).select("vec_id", "label", "embedding").withColumn("codes", codes(F.col("embedding")))
    blocks = stored_blocks(ready)
    first = F.min(F.struct(F.col("label").cast("long").alias("label"), "codes")).alias("first")
    asking = cut_lineage(ready.filter(anchors).groupBy(F.col("vec_id").cast("long").alias("anchor_id")).agg(first).select("anchor_id", "first.*"))
    n_blocks, n_anchors = blocks.count(), asking.count()
    wide = rows.sparkSession.sparkContext.defaultParallelism
    cells = max(1, -(-n_blocks // CELL_BLOCKS), min(n_blocks, 2 * wide)), max(1, -(-n_anchors // CELL_ANCHORS))
    nobody = F.lit(None).cast("array<struct<place: int, id: long, score: long>>")
    near = _best(blocks, asking.withColumn("positives", nobody), cells, positives, None)
    found = cut_lineage(near.select("anchor_id", F.col("rank").alias("place"), F.col("partner_id").alias("positive_id"), F.col("score").alias("positive_score")))
    opened = found.groupBy("anchor_id").agg(F.collect_list(F.struct("place", F.col("positive_id").alias("id"), F.col("positive_score").alias("score"))).alias("positives"))
    far = _best(blocks, asking.join(opened, "anchor_id"), cells, negatives, band)
    return far.join(found, ["anchor_id", "place"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("partner_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
