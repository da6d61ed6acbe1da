"""Fill-in-the-middle texts by secondary sort.

A text is cut at two code points chosen by a hash of its id. Its prefix, middle and suffix leave
the reader as chunks of at most ``CHUNK`` code points, keyed by the document and their position in
the output. Spark partitions the chunks by document and sorts them inside each partition (one
shuffle), and a task streams them into the digest of the output: however long a text is, a task
holds one batch of chunks. What the stream says is then taken apart again from the output and its
form alone: the marks found in it name the parts, the parts' chunks are sorted once more inside the
same partition, now in the order of the text, and stream into the digest of the restored text.

A text that holds a mark stays plain, so the first mark of each kind in an output is never text.

Edge cases: a null text counts as empty, and an empty text is plain. A null id is hashed as empty
text. Repeated rows and repeated ids are documents of their own, alike where id and text are. An
empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

#: Code points of a chunk.
CHUNK = 4096
# The marks, and the order in which the text has the parts that they open.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLACE = {PREFIX: 0, MIDDLE: 1, SUFFIX: 2}
FORMS = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}


@dataclass(frozen=True)
class Rates:
    """Of a hundred texts, how many are rearranged, and how many of those have the suffix first; ``seed`` is hashed with the id."""

    rearranged: int = 90
    suffix_first: int = 20
    seed: str = "1"


def plan(doc_id, text: str, rates: Rates = Rates()) -> tuple[str, int, int]:
    """Form of the text's output, and where its prefix and its middle end."""
    digest = hashlib.sha256(f"{rates.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in range(0, 32, 8))
    first, second = sorted((h1 % (len(text) + 1), h2 % (len(text) + 1)))
    if not text or any(mark in text for mark in PLACE) or h3 % 100 >= rates.rearranged:
        return "plain", 0, 0
    return "spm" if h4 % 100 < rates.suffix_first else "psm", first, second


def chunks(text: str, form: str, first: int, second: int, size: int = CHUNK) -> Iterator[str]:
    """The output in order. A mark stands before the first chunk of its part."""
    parts = [("", 0, len(text))]
    if form != "plain":
        spans = {PREFIX: (0, first), MIDDLE: (first, second), SUFFIX: (second, len(text))}
        parts = [(mark, *spans[mark]) for mark in FORMS[form]]
    for mark, start, end in parts:
        yield mark + text[start : min(end, start + size)]
        for at in range(start + size, end, size):
            yield text[at : min(end, at + size)]


class Restorer:
    """Takes an output apart as it streams by: ``feed`` gives (place of the part in the text, chunk of the part)."""

    def __init__(self, form: str):
        self.marks = list(FORMS.get(form, ()))
        self.place, self.rest = 0, ""

    def feed(self, chunk: str, last: bool = False) -> Iterator[tuple[int, str]]:
        data, self.rest = self.rest + chunk, ""
        while self.marks and (at := data.find(self.marks[0])) >= 0:
            if at:
                yield self.place, data[:at]
            self.place, data = PLACE[self.marks[0]], data[at + len(self.marks[0]) :]
            self.marks.pop(0)
        if self.marks and not last:  # a mark may begin at the end of this chunk
            data, self.rest = data[: max(0, len(data) - 2)], data[max(0, len(data) - 2) :]
        if data:
            yield self.place, data


_HEAD = "doc_id {id}, n long, form string, prefix_chars long, middle_chars long"


def _cut(rates: Rates, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        serial = TaskContext.get().partitionId() << 33
        for batch in batches:
            id_type = batch.column(0).type
            names = ["row", "place", "chunk", "doc_id", "n", "form", "prefix_chars", "middle_chars"]
            kinds = [pa.int64(), pa.int64(), pa.string(), id_type, pa.int64(), pa.string(), pa.int64(), pa.int64()]
            out, held = [], 0
            for i in range(batch.num_rows):
                doc_id, text = batch.column(0)[i].as_py(), batch.column(1)[i].as_py() or ""
                form, first, second = plan(doc_id, text, rates)
                head = (doc_id, len(text), form, *((None, None) if form == "plain" else (first, second - first)))
                for place, chunk in enumerate(chunks(text, form, first, second, size)):
                    out.append((serial, place, chunk, *(head if place == 0 else (None,) * 5)))
                    held += len(chunk)
                    if held > 1 << 22:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
                        out, held = [], 0
                serial += 1
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    return run


def output_chunks(docs: DataFrame, rates: Rates = Rates(), size: int = CHUNK) -> DataFrame:
    """The outputs as chunks: row, place, chunk, and on a document's first chunk doc_id, n, form, prefix_chars, middle_chars.

    A document's chunks lie in one partition, in the order of the output: write them one after the other.
    """
    head = _HEAD.format(id=docs.schema["doc_id"].dataType.simpleString())
    return docs.select("doc_id", "text").mapInArrow(_cut(rates, size), f"row long, place long, chunk string, {head}").repartition("row").sortWithinPartitions("row", "place")


def _digest_outputs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The restored parts of each output, then (place 3) its document with the output's digest."""
    names = ["row", "place", "serial", "chunk", "doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256"]
    row = digest = restorer = head = None
    serial = 0

    def parts(out: list, chunk: str, last: bool = False) -> None:
        nonlocal serial
        for place, text in restorer.feed(chunk, last):
            out.append((row, place, serial, text, None, None, None, None, None, None))
            serial += 1

    def done(out: list) -> None:
        if row is not None:
            parts(out, "", last=True)
            out.append((row, 3, 0, None, *head, digest.hexdigest()))

    kinds = None

    def made(out: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    for batch in batches:
        kinds = kinds or [pa.int64(), pa.int64(), pa.int64(), pa.string(), *(batch.schema.field(c).type for c in names[4:9]), pa.string()]
        out: list = []
        heads = list(zip(*(batch.column(i).to_pylist() for i in range(3, 8))))
        for i, (at, chunk) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist())):
            if at != row:
                done(out)
                row, digest, head, serial = at, hashlib.sha256(), heads[i], 0
                restorer = Restorer(head[2])
            digest.update(chunk.encode())
            parts(out, chunk)
        if out:
            yield made(out)
    out = []
    done(out)
    if out:
        yield made(out)


def _digest_restored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per document, from its parts in the order of the text."""
    digest = hashlib.sha256()
    for batch in batches:
        ends, restored = [], []
        for i, (place, chunk) in enumerate(zip(batch.column(1).to_pylist(), batch.column(3).to_pylist())):
            if place < 3:
                digest.update(chunk.encode())
            else:
                ends.append(i)
                restored.append(digest.hexdigest())
                digest = hashlib.sha256()
        rows = batch.take(pa.array(ends, pa.int64()))
        yield pa.RecordBatch.from_arrays([*rows.columns[4:], pa.array(restored, pa.string())], [*rows.schema.names[4:], "restored_sha256"])


def fill_in_middle(docs: DataFrame, rates: Rates = Rates(), size: int = CHUNK) -> DataFrame:
    """One row per document: doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256."""
    head = _HEAD.format(id=docs.schema["doc_id"].dataType.simpleString()) + ", output_sha256 string"
    parts = output_chunks(docs, rates, size).mapInArrow(_digest_outputs, f"row long, place long, serial long, chunk string, {head}")
    # The documents are whole in their partitions already: this sort brings no second shuffle.
    return parts.sortWithinPartitions("row", "place", "serial").mapInArrow(_digest_restored, f"{head}, restored_sha256 string")
