"""Line dedup with two Bloom filters.

A line's key is the line without ASCII white space at both ends, A-Z in lower case. A first scan
builds two filters, of the key hashes seen once and of those seen twice. A task emits its two
filters cut into segments, compressed; the segments of all tasks meet, a segment at a time, and
merge: a bit belongs to the second filter where a task had it there, or where two tasks had it in
the first. So every key of two documents passes the second filter, while a key seen once passes
only if all its bits happen to be set twice. A second scan probes the second filter, and only lines
that it suspects are shuffled: one row per document and key, as a SHA-256 of the key. They are
counted exactly; a key found in enough documents loses its lines everywhere but in the document
with the largest id. The line numbers to drop then join the texts.

The filter has ``BITS`` bits for each line, at most 2^``LARGEST``, which bounds what is sent to the
tasks (64 MB). Where a corpus has more lines, the filter fills up and more lines are suspected than
repeat. The result is the same: what passes is always counted exactly.

A document is a doc_id. Rows are told apart by id and a hash of the text; their lines are dropped
alike where both are equal.

Edge cases: null and empty texts are one empty line. A null id is one document, below all others.
Repeated rows of one id are one document. An empty table gives an empty result; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.context import cut_lineage

from .common import SPACES

#: Shorter keys (code points) stay, and keys of fewer documents.
LEAST_CHARS, LEAST_DOCUMENTS = 20, 3
#: Bits of a filter per line, bits set by a key, exponent of the largest filter, exponent of a segment.
BITS, PROBES, LARGEST, SEGMENT = 8, 2, 29, 20
#: Hashes that a task gathers before it combines them.
GATHERED = 1 << 21


def line_keys(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The document of each line (as a number in the batch), and the keys of the lines."""
    lists = pc.split_pattern(texts.fill_null(""), "\n")
    keys = pc.ascii_lower(pc.utf8_trim(pc.list_flatten(lists), characters=SPACES))
    return pc.list_parent_indices(lists).to_numpy(zero_copy_only=False), keys


def _long_keys(texts: pa.Array, least: int) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Document, line number in the batch and bytes of each key that is long enough."""
    parents, keys = line_keys(texts)
    long = np.flatnonzero(pc.greater_equal(pc.utf8_length(keys), least).to_numpy(zero_copy_only=False))
    return parents, long, keys.take(pa.array(long, pa.int64())).cast(pa.binary()).to_pylist()


def _hashes(keys: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter(map(digest, keys), np.uint64, len(keys))


def places(hashes: np.ndarray, bits: int) -> list[np.ndarray]:
    """The bits of each hash in a filter of 2^bits."""
    step = (hashes >> np.uint64(32)) | np.uint64(1)
    return [((hashes + np.uint64(i) * step) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits) for i in range(PROBES)]


def _segments(hashes: np.ndarray, bits: int) -> Iterator[tuple[int, bytes]]:
    """The non-empty segments of the filter that holds these hashes."""
    at = np.unique(np.concatenate(places(hashes, bits))) if len(hashes) else np.zeros(0, np.uint64)
    width = min(bits, SEGMENT)
    segment = (at >> np.uint64(width)).astype(np.int64)
    cuts = np.flatnonzero(np.diff(segment)) + 1
    compress = zstandard.ZstdCompressor(level=1).compress
    for first, last in zip([0, *cuts.tolist()], [*cuts.tolist(), len(at)]):
        if first < last:
            flags = np.zeros(1 << width, np.uint8)
            flags[(at[first:last] & np.uint64((1 << width) - 1)).astype(np.int64)] = 1
            yield int(segment[first]), compress(np.packbits(flags).tobytes())


def _task_filters(bits: int, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice, fresh, waiting = np.zeros(0, np.uint64), np.zeros(0, np.uint64), [], 0

        def combined() -> None:
            nonlocal once, twice, fresh, waiting
            seen, count = np.unique(np.concatenate([once, *fresh]), return_counts=True)
            once, twice, fresh, waiting = seen, np.union1d(twice, seen[count > 1]), [], 0

        for batch in batches:
            parents, long, keys = _long_keys(batch.column(0), least)
            if keys:
                # A key counts once in a document, however often the document has it.
                pairs = np.unique(np.stack([parents[long].astype(np.uint64), _hashes(keys)]), axis=1)
                fresh.append(pairs[1])
                waiting += pairs.shape[1]
                if waiting > GATHERED:
                    combined()
        combined()
        for kind, hashes in ((1, once), (2, twice)):
            for segment, data in _segments(hashes, bits):
                yield pa.RecordBatch.from_pydict({"segment": [segment], "kind": pa.array([kind], pa.int32()), "bits": [data]})

    return run


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The second filter's segments, from a partition sorted by segment: one segment is held at a time."""
    decompress = zstandard.ZstdDecompressor().decompress
    segment = once = twice = None

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"segment": pa.array([segment], pa.int64()), "bits": [twice.tobytes()]})

    for batch in batches:
        for at, kind, data in zip(*(batch.column(i).to_pylist() for i in range(3))):
            bits = np.frombuffer(decompress(data), np.uint8)
            if at != segment:
                if segment is not None:
                    yield done()
                segment, once, twice = at, np.zeros_like(bits), np.zeros_like(bits)
            if kind == 1:
                twice |= once & bits
                once |= bits
            else:
                twice |= bits
    if segment is not None:
        yield done()


def twice_seen(docs: DataFrame, bits: int, least: int = LEAST_CHARS) -> bytes:
    """The second filter, of 2^bits bits."""
    parts = docs.select("text").mapInArrow(_task_filters(bits, least), "segment long, kind int, bits binary")
    merged = parts.repartition("segment").sortWithinPartitions("segment").mapInArrow(_merged, "segment long, bits binary")
    width = min(bits, SEGMENT)
    out = np.zeros(1 << (bits - 3), np.uint8)
    for segment, data in merged.collect():  # 2^bits bits at most
        out[segment << (width - 3) : (segment + 1) << (width - 3)] = np.frombuffer(data, np.uint8)
    return out.tobytes()


def _suspects(shared, bits: int, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        twice = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            parents, long, keys = _long_keys(batch.column(0), least)
            listed = np.ones(len(keys), bool)
            for at in places(_hashes(keys), bits):
                listed &= (twice[at >> np.uint64(3)] >> (np.uint8(7) - (at & np.uint64(7)).astype(np.uint8))) & 1 != 0
            begins = np.searchsorted(parents, np.arange(batch.num_rows))
            lines: dict[tuple[int, bytes], list[int]] = {}
            for i in np.flatnonzero(listed).tolist():
                row = int(parents[long[i]])
                lines.setdefault((row, hashlib.sha256(keys[i]).digest()), []).append(int(long[i] - begins[row]))
            rows = pa.array([row for row, _ in lines], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(1).take(rows), batch.column(2).take(rows), pa.array([sha for _, sha in lines], pa.binary()), pa.array(list(lines.values()), pa.list_(pa.int32()))],
                ["doc_id", "print", "sha", "lines"],
            )

    return run


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_lines, n_dropped, shas, kept = [], [], [], []
        for i in range(batch.num_rows):
            text, drop = batch.column(1)[i].as_py() or "", batch.column(2)[i].as_py()
            lines = text.split("\n")
            n_lines.append(len(lines))
            gone = {n for part in drop or () for n in part}
            n_dropped.append(len(gone))
            kept.append("\n".join(line for n, line in enumerate(lines) if n not in gone) if gone else text)
            shas.append(hashlib.sha256(kept[-1].encode()).hexdigest())
        out = [batch.column(0), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(shas, pa.string()), pa.array(kept, pa.string())]
        yield pa.RecordBatch.from_arrays(out, ["doc_id", "n_lines", "n_dropped", "kept_sha256", "kept_text"])


def filter_bits(docs: DataFrame) -> int:
    """The exponent of a filter's size: about ``BITS`` bits for each line of the corpus, 2^``LARGEST`` at most."""
    text = F.coalesce("text", F.lit(""))
    lines = docs.agg(F.sum(F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).alias("n")).first().n or 1
    return max(16, min(LARGEST, (BITS * int(lines) - 1).bit_length()))


def repeated_lines(docs: DataFrame, least_chars: int = LEAST_CHARS, least_documents: int = LEAST_DOCUMENTS, bits: int | None = None) -> DataFrame:
    """(doc_id, print, lines): the numbers of the lines, from 0, that each document loses; ``print`` is a hash of its text."""
    if least_documents < 2:
        raise ValueError("a line repeats in two documents at least")
    bits = bits or filter_bits(docs)
    shared = docs.sparkSession.sparkContext.broadcast(twice_seen(docs, bits, least_chars))  # 2^LARGEST bits at most
    id_type = docs.schema["doc_id"].dataType.simpleString()
    found = cut_lineage(
        docs.select("text", "doc_id", F.xxhash64("text").alias("print")).mapInArrow(_suspects(shared, bits, least_chars), f"doc_id {id_type}, print long, sha binary, lines array<int>")
    )
    # Two steps, each combined before its shuffle: a line of all documents is spread by their ids, then a row per task.
    counted = found.select("sha", "doc_id").distinct().groupBy("sha").agg(F.count(F.lit(1)).alias("documents"), F.max("doc_id").alias("stays"))
    # A table of its own, so that Spark can split the rows of a frequent line in the join.
    confirmed = cut_lineage(counted.filter(F.col("documents") >= least_documents).select("sha", "stays"))
    lost = found.join(confirmed, "sha").filter(~F.col("doc_id").eqNullSafe(F.col("stays")))
    # Repeated rows give the same lines again: the set holds them once.
    return lost.groupBy("doc_id", "print").agg(F.collect_set("lines").alias("lines"))


def drop_repeated_lines(docs: DataFrame, least_chars: int = LEAST_CHARS, least_documents: int = LEAST_DOCUMENTS, bits: int | None = None) -> DataFrame:
    """One row per document row: doc_id, n_lines, n_dropped, kept_sha256, kept_text."""
    lost = repeated_lines(docs, least_chars, least_documents, bits).withColumnsRenamed({"doc_id": "lost_id", "print": "lost_print"})
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("print"))
    joined = texts.join(lost, texts["doc_id"].eqNullSafe(lost["lost_id"]) & (texts["print"] == lost["lost_print"]), "left")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return joined.select("doc_id", "text", "lines").mapInArrow(_without, f"doc_id {id_type}, n_lines long, n_dropped long, kept_sha256 string, kept_text string")
