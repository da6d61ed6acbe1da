"""Language identification with a byte convolutional network, trained here in numpy.

A text is cut into windows of ``WINDOW`` bytes, all of it, the last window filled with zeros. A
window's bytes (ASCII letters in lower case) become embeddings; filters of several widths slide
over them, each filter keeps its largest response, and a softmax over these gives the window's
languages. A text's scores are the mean over its windows, weighted by their bytes. Since the
embedding and the filters are linear in the byte, scoring adds one table row per byte and filter
offset instead of multiplying.

Training takes a window from the middle of each text of a bounded sample: at most ``SAMPLE``
documents (a parameter), an equal share for each language, chosen by a hash of the id from all rows
that have an id, a language and a letter and are not held out. Only these windows reach the driver.

Edge cases: a text that is null or has no letter is ``und`` with score 0, and so is every text if
there is nothing to learn from; repeated rows each get a row; with one language all texts with
letters get it. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, learnable, sampled, text_bytes

UNKNOWN = "und"
SAMPLE, WINDOW, WIDTHS, FILTERS, EMBEDDING = 12_000, 256, (2, 3, 4), 16, 8
#: Windows seen in training, over at least two epochs; batch; Adam's first rate.
SEEN, BATCH, RATE = 48_000, 64, 3e-3
#: Windows scored in one step.
STEP = 256

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 32
_FOLD[[9, 10, 11, 12, 13]] = 32


def folded(data: np.ndarray) -> np.ndarray:
    """Lower case of ASCII letters and of the letters of Latin-1 (0xC3 and a second byte); white space as blanks."""
    out = _FOLD[data]
    upper = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)
    out[1:][upper] += 32
    return out


@dataclass
class Network:
    languages: list[str]
    embedding: np.ndarray  # 256 x EMBEDDING
    filters: list[np.ndarray]  # for each width: width x EMBEDDING x FILTERS
    bias: np.ndarray  # all filters
    dense: np.ndarray  # all filters x languages
    offset: np.ndarray  # languages

    def tables(self) -> list[np.ndarray]:
        """For each offset, the response of every filter that reaches it to each byte. Wider filters come first."""
        return [np.concatenate([self.embedding @ f[j] for f in self.filters if len(f) > j], axis=1) for j in range(len(self.filters[0]))]

    def pooled(self, windows: np.ndarray, tables: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Largest response of each filter in each window, and where it begins."""
        n, length = windows.shape
        responses = tables[0][windows].reshape(n, length, -1)
        for j, table in enumerate(tables[1:], 1):
            responses[:, :-j, : table.shape[1]] += table[windows[:, j:]]
            # a filter does not reach past the window
        for i, f in enumerate(self.filters):
            if len(f) > 1:
                responses[:, length - len(f) + 1 :, i * f.shape[2] : (i + 1) * f.shape[2]] = -np.inf
        at = responses.argmax(axis=1)
        return np.take_along_axis(responses, at[:, None], axis=1)[:, 0], at

    def largest(self, windows: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
        """As ``pooled``, without the places: filter widths one by one, which keeps the arrays small."""
        out, first = [], 0
        for f in self.filters:
            last, n = first + f.shape[2], windows.shape[1] - len(f) + 1
            responses = tables[0][:, first:last][windows[:, :n]]
            for j in range(1, len(f)):
                responses += tables[j][:, first:last][windows[:, j : j + n]]
            out.append(responses.max(axis=1))
            first = last
        return np.concatenate(out, axis=1)

    def chances(self, pooled: np.ndarray) -> np.ndarray:
        x = np.maximum(pooled + self.bias, 0) @ self.dense + self.offset
        x = np.exp(x - x.max(axis=1, keepdims=True))
        return x / x.sum(axis=1, keepdims=True)


def train(windows: np.ndarray, labels: np.ndarray, languages: list[str], seed: int = 7) -> Network:
    """Adam on the cross entropy; gradients flow through the place of each filter's largest response."""
    rng = np.random.default_rng(seed)
    widths = sorted(WIDTHS, reverse=True)

    def normal(scale: float, *shape: int) -> np.ndarray:
        return rng.normal(0, scale, shape).astype(np.float32)

    net = Network(
        languages, normal(0.5, 256, EMBEDDING), [normal((w * EMBEDDING) ** -0.5, w, EMBEDDING, FILTERS) for w in widths],
        np.zeros(FILTERS * len(widths), np.float32), normal(0.2, FILTERS * len(widths), len(languages)), np.zeros(len(languages), np.float32),
    )
    params = [net.embedding, *net.filters, net.bias, net.dense, net.offset]
    first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    share = np.bincount(labels, minlength=len(languages)) / max(1, len(labels))
    epochs = max(2, round(SEEN / len(windows)))
    for epoch in range(epochs):
        order = rng.permutation(len(windows))
        for start in range(0, len(order), BATCH):
            rows = order[start : start + BATCH]
            x, y = windows[rows].copy(), labels[rows]
            for i in np.flatnonzero(rng.random(len(x)) < 0.3):  # short texts have few bytes
                x[i, rng.integers(16, WINDOW) :] = 0
            pooled, at = net.pooled(x, net.tables())
            hidden = np.maximum(pooled + net.bias, 0)
            wrong = net.chances(pooled)
            wrong[np.arange(len(y)), y] -= 1
            wrong *= (1 / (len(languages) * share[y] * len(y)))[:, None]
            back = (wrong @ net.dense.T) * (hidden > 0)
            d_embedding, d_filters = np.zeros_like(net.embedding), []
            for i, f in enumerate(net.filters):
                span = slice(i * FILTERS, (i + 1) * FILTERS)
                g, d = back[:, span], np.zeros_like(f)
                for j in range(len(f)):
                    seen = np.take_along_axis(x, at[:, span] + j, axis=1)
                    d[j] = np.einsum("nfe,nf->ef", net.embedding[seen], g)
                    np.add.at(d_embedding, seen, g[:, :, None] * f[j].T[None])
                d_filters.append(d)
            step += 1
            rate = RATE * (1 - epoch / epochs)
            for p, g, a, b in zip(params, [d_embedding, *d_filters, back.sum(0), hidden.T @ wrong, wrong.sum(0)], first, second):
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                p -= rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)
    return net


def cut(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of the texts in ``data``, the text of each, and its bytes. Empty texts have none."""
    lengths = np.diff(offsets)
    counts = -(-lengths // WINDOW)
    row = np.repeat(np.arange(len(lengths)), counts)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    begin = offsets[row] + nth * WINDOW
    sizes = np.minimum(WINDOW, offsets[row + 1] - begin)
    places = begin[:, None] + np.arange(WINDOW)
    windows = np.where(np.arange(WINDOW) < sizes[:, None], folded(data)[np.minimum(places, max(0, len(data) - 1))], 0) if len(row) else np.zeros((0, WINDOW), np.uint8)
    return windows.astype(np.uint8), row, sizes


def fit(docs: DataFrame, sample: int = SAMPLE) -> Network | None:
    """A network from a bounded sample of the labelled documents; None without any."""
    labelled = docs.select("doc_id", "text", "lang").filter(learnable() & F.col("lang").isNotNull() & has_letter())
    counts = {r[0]: r[1] for r in labelled.groupBy("lang").count().collect()}  # one row per language
    if not counts:
        return None
    each = max(1, sample // len(counts))
    chosen = F.lit(False)
    for lang, n in counts.items():
        chosen = chosen | ((F.col("lang") == lang) & sampled(F.col("doc_id"), each / n))
    # The middle of the text: a window of WINDOW characters is at least as many bytes.
    begin = F.greatest(F.lit(1), F.floor((F.char_length("text") - WINDOW) / 2).cast("int"))
    part = F.substring(F.col("text"), begin, F.lit(WINDOW))
    rows = labelled.filter(chosen).select("doc_id", "lang", part.alias("part")).orderBy(F.xxhash64("doc_id"), "doc_id", "part").limit(sample).collect()
    languages = sorted(counts)
    if not rows:
        return None
    data = b"".join(r["part"].encode()[:WINDOW].ljust(WINDOW, b"\0") for r in rows)
    windows = folded(np.frombuffer(data, np.uint8)).reshape(-1, WINDOW)
    return train(windows, np.array([languages.index(r["lang"]) for r in rows]), languages)


def has_letter():
    return F.coalesce(F.col("text"), F.lit("")).rlike(r"\p{L}")


def guesses(texts: pa.Array, letters: pa.Array, network: Network) -> tuple[pa.Array, pa.Array]:
    """Language and score of each text."""
    data, offsets = text_bytes(texts)
    tables, rows = network.tables(), np.arange(len(texts))
    total = np.zeros((len(texts), len(network.languages)))
    for first in range(0, len(texts), 16):
        o = offsets[first : first + 17]
        windows, row, sizes = cut(data[o[0] : o[-1]], o - o[0])
        for s in range(0, len(row), STEP):
            got = network.chances(network.largest(windows[s : s + STEP], tables)) * sizes[s : s + STEP, None]
            np.add.at(total, first + row[s : s + STEP], got)
    total /= np.maximum(1, np.diff(offsets))[:, None]
    best = total.argmax(axis=1)
    known = letters.to_numpy(zero_copy_only=False) & (np.diff(offsets) > 0)
    langs = [network.languages[b] if k else UNKNOWN for b, k in zip(best, known)]
    return pa.array(langs, pa.string()), pa.array(np.where(known, np.clip(total[rows, best], 0, 1), 0.0))


def identify(docs: DataFrame, network: Network | None) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score."""
    rows = docs.select("doc_id", held_out().alias("held_out"), "text", has_letter().alias("letters"))
    if network is None:
        return rows.select("doc_id", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *guesses(*batch.columns[2:], network)], ["doc_id", "held_out", "lang_pred", "score"])

    return rows.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, held_out boolean, lang_pred string, score double")


def accepted(docs: DataFrame, network: Network | None) -> DataFrame:
    """The documents whose language is found, with all their columns, in one pass: those that are ``und`` go."""
    if network is None:
        return docs.limit(0)
    names, text = docs.columns, docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, _ = guesses(batch.column(text), batch.columns[-1], network)
            keep = pa.array(langs.to_numpy(zero_copy_only=False) != UNKNOWN)
            yield pa.RecordBatch.from_arrays([c.filter(keep) for c in batch.columns[:-1]], names)

    return docs.select("*", has_letter().alias("letters")).mapInArrow(run, docs.schema)
