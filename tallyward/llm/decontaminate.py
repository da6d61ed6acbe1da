"""Benchmark decontamination by winnowing.

A window is ``window`` consecutive words of a benchmark item. Words are runs of ASCII letters and
digits and of all non-ASCII characters, ASCII letters in lower case. Each window is represented by
the smallest hash among its k-grams: two equal windows always have the same smallest hash, so every
shared span of ``window`` words shares a fingerprint at the same place (no misses), while a chance
hit needs an equal k-gram first. Documents probe a filter of the benchmark's fingerprints, sized by
their number up to 64 MB (some 16 million of them; beyond, more passes by chance); what passes is joined with the
benchmark by fingerprint and by the words of the window, so a hit is exact and brings no pairs of rows.
Windows that stand in the same items are one class, and a document meets the items of a class once.
Overlapping hits extend to spans. Items shorter than a window are windows of their own length, found through the hash of all
their words.

Edge cases: null texts have no words; documents and items without words match nothing and the
documents still get a row. Repeated rows and repeated ids are separate documents; items that share
an id count once. An empty benchmark leaves every document clean, and no documents give no rows.
Other columns are ignored. Ids of items are compared as text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.context import cut_lineage

from .common import text_chunks

WINDOW, KGRAM = 10, 8
#: Bits of the filter for each fingerprint of the benchmark, bits that one sets, exponent of the largest filter (64 MB).
FILTER_BITS, PROBES, LARGEST = 32, 3, 29

CLASS = ["class0", "class1", "class2"]

_BYTE = np.arange(256, dtype=np.uint8)
#: A-Z to a-z, other bytes as they are; 0 for what separates words.
FOLD = np.where((_BYTE >= 0x41) & (_BYTE <= 0x5A), _BYTE + 32, _BYTE).astype(np.uint8)
IS_WORD = ((_BYTE >= 0x30) & (_BYTE <= 0x39)) | ((FOLD >= 0x61) & (FOLD <= 0x7A)) | (_BYTE >= 0x80)
_BASE, _STEP = np.uint64(0x9E3779B97F4A7C15 | 1), np.uint64(0xC2B2AE3D27D4EB4F)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def _mixed(h: np.ndarray) -> np.ndarray:
    """Spreads the bits of a 64-bit hash."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of the texts that lie one after the other in ``data``: start, end and hash of each, and the first word of each text."""
    folded = FOLD[data]
    inside = IS_WORD[data]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    at_text = offsets[:-1][offsets[:-1] < len(data)]
    opens[at_text] = inside[at_text]
    starts = np.flatnonzero(opens)
    # A word ends before the next byte outside a word, or where the next word or text begins.
    closes = inside.copy()
    closes[:-1] &= ~inside[1:] | opens[1:]
    ends = np.flatnonzero(closes) + 1
    powers = np.full(len(data) + 1, _BASE)
    powers[0] = 1
    powers = np.cumprod(powers, dtype=np.uint64)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((folded.astype(np.uint64) + np.uint64(1)) * powers[:-1], out=sums[1:])
    inverse = np.full(len(data) + 1, _INVERSE)
    inverse[0] = 1
    inverse = np.cumprod(inverse, dtype=np.uint64)
    hashes = _mixed((sums[ends] - sums[starts]) * inverse[starts])
    return starts, ends, hashes, np.searchsorted(starts, offsets)


def gram_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each position on."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, np.uint64(k))
    for i in range(k):
        out = out * _STEP + hashes[i : i + n]
    return _mixed(out)


def window_prints(hashes: np.ndarray, window: int, k: int) -> np.ndarray:
    """The smallest k-gram hash of the window that begins at each position."""
    grams = gram_hashes(hashes, k)
    n = len(hashes) - window + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = grams[:n].copy()
    for i in range(1, window - k + 1):
        np.minimum(out, grams[i : i + n], out=out)
    return out


def _lengths(window: int, k: int, short: list[int]) -> list[tuple[int, int]]:
    """(window, k-gram) for whole windows and for each length of a short item."""
    return [(window, k), *((n, n) for n in sorted(short))]


def _span(folded: bytes, starts: np.ndarray, ends: np.ndarray, first: int, n: int) -> str:
    return b" ".join(folded[a:b] for a, b in zip(starts[first : first + n].tolist(), ends[first : first + n].tolist())).decode()


def _item_windows(window: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, (out_id, out_print, out_words) = batch.column(0).to_pylist(), ([], [], [])
            for first, last, data, offsets in text_chunks(batch.column(1)):
                starts, ends, hashes, cut = words(data, offsets)
                folded = FOLD[data].tobytes()
                for row in range(last - first):
                    a, b = int(cut[row]), int(cut[row + 1])
                    n = min(window, b - a)
                    if n == 0:
                        continue
                    prints = window_prints(hashes[a:b], n, k if n == window else n)
                    for i, value in enumerate(prints.view(np.int64).tolist()):
                        out_id.append(ids[first + row])
                        out_print.append(value)
                        out_words.append(_span(folded, starts, ends, a + i, n))
            yield pa.RecordBatch.from_arrays([pa.array(out_id, pa.string()), pa.array(out_print, pa.int64()), pa.array(out_words, pa.string())], ["item_id", "print", "words"])

    return run


def _slots(prints: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    """The places of the fingerprints in a filter of 2^bits."""
    for i in range(PROBES):
        yield _mixed(prints + np.uint64(i) * _STEP) >> np.uint64(64 - bits)


def _document_windows(lengths: list[tuple[int, int]], shared, bits: int):
    def listed(prints: np.ndarray) -> np.ndarray:
        filled, found = shared.value, np.ones(len(prints), bool)
        for slot in _slots(prints, bits):
            found &= (filled[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & np.uint8(1) != 0
        return found

    hit_type = pa.list_(pa.struct([("print", pa.int64()), ("at", pa.int32()), ("length", pa.int32()), ("words", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        serial = TaskContext.get().partitionId() << 33
        for batch in batches:
            n_words, hits = np.zeros(batch.num_rows, np.int64), [[] for _ in range(batch.num_rows)]
            for first, last, data, offsets in text_chunks(batch.column(0)):
                starts, ends, hashes, cut = words(data, offsets)
                n_words[first:last] = np.diff(cut)
                folded = None
                for window, k in lengths:
                    prints = window_prints(hashes, window, k)
                    at = np.flatnonzero(listed(prints))
                    row = np.searchsorted(cut, at, side="right") - 1
                    inside = at + window <= cut[row + 1]
                    folded = folded or (FOLD[data].tobytes() if inside.any() else None)
                    for i, r in zip(at[inside].tolist(), row[inside].tolist()):
                        hits[first + r].append({"print": int(prints[i : i + 1].view(np.int64)[0]), "at": i - int(cut[r]), "length": window, "words": _span(folded, starts, ends, i, window)})
            rows = np.arange(serial, serial + batch.num_rows)
            serial += batch.num_rows
            yield pa.RecordBatch.from_arrays([pa.array(rows), *batch.columns[1:], pa.array(n_words), pa.array(hits, hit_type)], ["row", *(f"id{i}" for i in range(batch.num_columns - 1)), "n_words", "hits"])

    return run


def _filter_words(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The bytes of the filter that the batch's fingerprints set, and their bits."""
        for batch in batches:
            prints = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            slots = np.concatenate([*_slots(prints, bits)])
            yield pa.RecordBatch.from_arrays([pa.array((slots >> np.uint64(3)).astype(np.int64)), pa.array((1 << (slots & np.uint64(7))).astype(np.int32))], ["at", "bits"])

    return run


def _filter(prints: DataFrame, bits: int) -> np.ndarray:
    """The filter of the fingerprints. Spark ORs the bits of each byte, so at most 2^bits / 8 rows arrive, as columns."""
    found = prints.select("print").distinct().mapInArrow(_filter_words(bits), "at long, bits int").groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(1 << (bits - 3), np.uint8)
    out[found["at"].to_numpy()] = found["bits"].to_numpy().astype(np.uint8)
    return out


def filter_bits(n: int) -> int:
    """The exponent of the size of a filter for n fingerprints."""
    return max(16, min(LARGEST, (FILTER_BITS * n).bit_length()))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, k: int = KGRAM, bits: int | None = None, row: str | None = None) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, and the ``row`` column if named."""
    items = cut_lineage(
        benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").mapInArrow(_item_windows(window, k), "item_id string, print long, words string").distinct()
    )
    n_words = F.size(F.split("words", " "))
    short = [r[0] for r in items.select(n_words.alias("n")).filter(F.col("n") < window).distinct().collect()]  # fewer than `window` values
    bits = bits or filter_bits(items.count())
    shared = docs.sparkSession.sparkContext.broadcast(_filter(items, bits))  # 2^LARGEST bits at most
    ids = ["doc_id", *([row] if row else [])]
    kinds = ", ".join(f"id{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(ids))
    schema = f"row long, {kinds}, n_words long, hits array<struct<print: long, at: int, length: int, words: string>>"
    base = cut_lineage(docs.select("text", *ids).mapInArrow(_document_windows(_lengths(window, k, short), shared, bits), schema))
    # One benchmark row for each fingerprint and window: the join brings at most one row for each window of a document.
    # Its class is known by the number of its items and two sums of their hashes.
    sums = [F.sum(F.xxhash64(F.lit(i), "item_id").cast("decimal(38,0)")).alias(f"class{i}") for i in (1, 2)]
    known = cut_lineage(items.groupBy("print", "words").agg(F.count("*").alias("class0"), *sums))
    members = items.join(known, ["print", "words"]).select(*CLASS, "item_id").distinct()
    found = base.select("row", F.explode("hits").alias("h")).select("row", "h.*").join(known, ["print", "words"])
    spans = (
        found.groupBy("row")
        .agg(F.size(F.array_distinct(F.flatten(F.collect_list(F.sequence("at", F.col("at") + F.col("length") - 1))))).cast("long").alias("n_hit"))
    )
    listed = (
        found.select("row", *CLASS).distinct().join(members, CLASS).select("row", "item_id").distinct()
        .groupBy("row").agg(F.array_sort(F.collect_list("item_id")).alias("items"))
    )
    return (
        base.drop("hits").join(spans, "row", "left").join(listed, "row", "left")
        .select(
            F.col("id0").alias("doc_id"),
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
            F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
            (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
            *([F.col("id1").alias(row)] if row else []),
        )
    )
