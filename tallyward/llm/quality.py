"""Quality scores from a generalised additive model with pairwise interactions.

Features are counts over the whole text, taken from its bytes in vectorised steps. Each feature is
cut into bins; the model is a lookup table per feature, and one per pair for the pairs that explain
most of what single features leave. Boosting goes round the features in turn: each round fits a
shallow tree to the gradient summed per bin and adds a small part of its leaves to the table. A
score is the sum of the bins' table entries through a logistic curve.

Training uses a bounded sample of the labelled documents (``SAMPLE``, a parameter): ids chosen by a
hash among those that are not held out. Their features, not their texts, reach the driver. Labels,
languages, sources and ids are never inputs of a score.

Edge cases: null and empty texts have all counts zero and get the score of such texts; a label whose
document is missing teaches nothing, repeated labels count as often as they occur, null labels not
at all; without any label all scores are 0.5. Repeated rows each get a row. An empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, learnable, sampled, text_chunks

SAMPLE, THRESHOLD = 20_000, 0.3
BINS, PAIR_BINS, PAIRS, ROUNDS, PAIR_ROUNDS, RATE, LEAVES, LEAST = 32, 8, 8, 200, 100, 0.1, 4, 10

FEATURES = (
    "log_length", "upper_of_letters", "digits", "marks", "odd_marks", "spaces", "newlines", "non_ascii", "mean_word",
    "long_words", "doubled_marks", "capital_words", "mark_words", "one_letter_words", "repeated_lines", "distinct_words", "log_longest_word",
)

_B = np.arange(256)
_UPPER, _LOWER, _DIGIT = (_B >= 65) & (_B <= 90), (_B >= 97) & (_B <= 122), (_B >= 48) & (_B <= 57)
_SPACE, _HIGH = (_B == 32) | ((_B >= 9) & (_B <= 13)), _B >= 128
_MARK = ~(_UPPER | _LOWER | _DIGIT | _SPACE | _HIGH)
_ODD = _MARK & ~np.isin(_B, list(b".,;:'\"()-?"))
_CLASSES = np.stack([_UPPER, _LOWER, _DIGIT, _MARK, _ODD, _SPACE, _B == 10, _B >= 192]).astype(bool)


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of the values between neighbouring bounds."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of FEATURES for each text that lies in ``data``."""
    n = np.diff(offsets)
    upper, lower, digit, mark, odd, space, newline, high = (_sums(c[data], offsets) for c in _CLASSES)
    chars, letters = np.maximum(1, n - _sums((data & 0xC0) == 0x80, offsets)), np.maximum(1, upper + lower + high)
    inside = ~_SPACE[data]
    opens, first = inside.copy(), offsets[:-1][n > 0]
    opens[1:] &= ~inside[:-1]
    opens[first] = inside[first]
    starts = np.flatnonzero(opens)
    closes = inside.copy()
    if len(closes):
        closes[:-1] &= ~inside[1:] | opens[1:]
    ends = np.flatnonzero(closes) + 1
    sizes, cut = ends - starts, np.searchsorted(starts, offsets)
    words = np.maximum(1, np.diff(cut))
    is_mark, is_letter = _MARK[data], (_UPPER | _LOWER | _HIGH)[data]
    doubled = is_mark.copy()
    doubled[:1] = False
    doubled[1:] &= data[1:] == data[:-1]
    marks_before = np.concatenate([[0], np.cumsum(_ODD[data], dtype=np.int64)])
    letters_before = np.concatenate([[0], np.cumsum(is_letter, dtype=np.int64)])
    with_mark = marks_before[ends] > marks_before[starts]
    only_one = letters_before[ends] - letters_before[starts] <= 1
    longest = np.zeros(len(n))
    busy = np.diff(cut) > 0
    if busy.any():
        longest[busy] = np.maximum.reduceat(sizes, cut[:-1][busy])
    repeated, distinct = np.zeros(len(n)), np.zeros(len(n))
    raw = data.tobytes()
    for i in range(len(n)):
        text = raw[offsets[i] : offsets[i + 1]]
        lines, tokens = [x for x in text.split(b"\n") if x.strip()], text.split()
        repeated[i] = 1 - len(set(lines)) / len(lines) if lines else 0
        # The share of distinct words falls with length by itself: compare with the square root law.
        distinct[i] = len(set(tokens)) / len(tokens) ** 0.9 if tokens else 0
    return np.stack([
        np.log1p(n), (upper / letters), digit / chars, mark / chars, odd / chars, space / chars, newline / chars, high / letters,
        _sums(sizes, cut) / words, _sums(sizes > 15, cut) / words, _sums(doubled, offsets) / chars, _sums(_UPPER[data[starts]], cut) / words,
        _sums(with_mark, cut) / words, _sums(only_one, cut) / words, repeated, distinct, np.log1p(longest),
    ], axis=1)


@dataclass
class Model:
    intercept: float
    edges: list[np.ndarray] = field(default_factory=list)  # bin bounds of each feature
    coarse: list[np.ndarray] = field(default_factory=list)  # the same for pairs
    single: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        if self.edges and len(x):
            for values, edges, table in zip(x.T, self.edges, self.single):
                total += table[np.searchsorted(edges, values)]
            rough = [np.searchsorted(e, values) for values, e in zip(x.T, self.coarse)]
            for i, j, table in self.pairs:
                total += table[rough[i], rough[j]]
        return 1 / (1 + np.exp(-total))


def _cells(gradient: np.ndarray, weight: np.ndarray, shape: tuple[int, ...], leaves: int) -> tuple[np.ndarray, float]:
    """A shallow tree over the cells of a table (one or two axes): at each step the box and cut that gain most. Leaf values and gain."""
    boxes, out, gained = [tuple((0, n) for n in shape)], np.zeros(shape), 0.0
    g, w = gradient.reshape(shape), weight.reshape(shape)

    def best(box):
        a, b = g[tuple(slice(*s) for s in box)], w[tuple(slice(*s) for s in box)]
        found = (1e-9, None, None)
        whole = a.sum() ** 2 / (b.sum() + 1)
        for axis in range(len(shape)):
            other = tuple(k for k in range(len(shape)) if k != axis)
            ca, cb = np.cumsum(a.sum(axis=other))[:-1], np.cumsum(b.sum(axis=other))[:-1]
            if len(ca):
                ra, rb = a.sum() - ca, b.sum() - cb
                gain = np.where((cb >= LEAST / 4) & (rb >= LEAST / 4), ca**2 / (cb + 1) + ra**2 / (rb + 1) - whole, 0)
                if gain.max() > found[0]:
                    found = (gain.max(), axis, int(gain.argmax()) + 1)
        return found

    open_ = [(best(boxes[0]), boxes[0])]
    done = []
    while open_ and len(open_) + len(done) < leaves:
        k = max(range(len(open_)), key=lambda i: open_[i][0][0])
        (gain, axis, at), box = open_.pop(k)
        if axis is None:
            done.append(box)
            continue
        gained += gain
        cut = box[axis][0] + at
        for part in ((box[axis][0], cut), (cut, box[axis][1])):
            child = tuple(part if k == axis else s for k, s in enumerate(box))
            open_.append((best(child), child))
    for box in [*done, *(b for _, b in open_)]:
        where = tuple(slice(*s) for s in box)
        out[where] = g[where].sum() / (w[where].sum() + 1)
    return out, gained


def train(x: np.ndarray, y: np.ndarray) -> Model:
    """Cyclic boosting: single features in turn, then pairs on what is left."""
    mean = np.clip(y.mean(), 1e-3, 1 - 1e-3) if len(y) else 0.5
    model = Model(float(np.log(mean / (1 - mean))))
    if len(y) < 2 * LEAST:
        return model
    model.edges = [np.unique(np.quantile(v, np.linspace(0, 1, BINS + 1)[1:-1])) for v in x.T]
    model.coarse = [np.unique(np.quantile(v, np.linspace(0, 1, PAIR_BINS + 1)[1:-1])) for v in x.T]
    fine = [np.searchsorted(e, v) for e, v in zip(model.edges, x.T)]
    rough = [np.searchsorted(e, v) for e, v in zip(model.coarse, x.T)]
    model.single = [np.zeros(len(e) + 1) for e in model.edges]
    total = np.full(len(y), model.intercept)

    def summed(cells: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return np.bincount(cells, y - p, size), np.bincount(cells, p * (1 - p), size)

    for _ in range(ROUNDS):
        for cells, table in zip(fine, model.single):
            step, _ = _cells(*summed(cells, len(table)), (len(table),), LEAVES)
            table += RATE * step
            total += RATE * step[cells]
    found = []
    for i, j in combinations(range(x.shape[1]), 2):
        shape = (len(model.coarse[i]) + 1, len(model.coarse[j]) + 1)
        cells = rough[i] * shape[1] + rough[j]
        found.append((_cells(*summed(cells, shape[0] * shape[1]), shape, LEAVES)[1], i, j, shape, cells))
    chosen = sorted(found, key=lambda f: -f[0])[:PAIRS]
    model.pairs = [(i, j, np.zeros(shape)) for _, i, j, shape, _ in chosen]
    for _ in range(PAIR_ROUNDS):
        for (_, _, _, shape, cells), (_, _, table) in zip(chosen, model.pairs):
            step, _ = _cells(*summed(cells, shape[0] * shape[1]), shape, LEAVES)
            table += RATE * step
            total += RATE * step.ravel()[cells]
    return model


def featured(docs: DataFrame) -> DataFrame:
    """(doc_id, x) with the features of each text, for the rows of a sample."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(data, offsets) for _, _, data, offsets in text_chunks(batch.column(1))]
            x = np.concatenate(found) if found else np.zeros((0, len(FEATURES)))
            lists = pa.ListArray.from_arrays(np.arange(0, x.size + 1, len(FEATURES), dtype=np.int32), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["doc_id", "x"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, x array<double>")


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from at most ``sample`` labelled documents that are not held out."""
    usable = labels.select("doc_id", "quality").filter(learnable() & F.col("quality").isNotNull())
    n = usable.count()
    # At most `sample` small rows (an id and a label), so they may be sent to every task; documents stay where they are.
    picked = usable.filter(sampled(F.col("doc_id"), sample / max(1, n))).orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(sample)
    rows = docs.select("doc_id", "text").join(F.broadcast(picked.select("doc_id").distinct()), "doc_id", "left_semi")
    # Of a repeated id, one text: a label belongs to an id.
    seen = featured(rows).groupBy("doc_id").agg(F.min("x").alias("x")).join(picked, "doc_id").select("x", "quality").orderBy("x", "quality").limit(sample).collect()
    x = np.array([r["x"] for r in seen]).reshape(-1, len(FEATURES))
    return train(x, np.array([float(r["quality"]) for r in seen]))


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.score(features(data, offsets)) for _, _, data, offsets in text_chunks(batch.column(1))]
            s = np.concatenate(found) if found else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(s), pa.array((s >= threshold).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return docs.select("doc_id", "text", held_out().alias("held_out")).mapInArrow(run, f"doc_id {id_type}, held_out boolean, score double, predicted int")
