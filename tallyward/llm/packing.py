"""Sequence packing in bounded space.

Each partition reads its documents once, tokenises them and keeps a fixed number of open windows.
A document's full windows leave at once; its remainder goes to the open window that it fits best;
where none fits, the fullest window is filled from the remainder's front and emitted. At the end of
a partition its open windows are poured together, which leaves at most one partial window; the
partial windows of up to ``MERGE`` partitions then meet in one small task and are poured together
the same way. What is left there is cut into sequences whose lengths are powers of two, which need
no padding. Memory is the open windows, one chunk of texts and a bounded cache of word ids,
whatever the size of the input. The packed pieces are checkpointed, so nothing is tokenised twice
and a lost executor repeats its own partitions only.

Edge cases: null and empty texts are the end id alone; a very long text fills windows of its own;
repeated rows and ids are packed as they come. An empty table gives an empty result. Other columns
are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from struct import pack

import pandas as pd
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyward.context import cut_lineage

TOKENIZER, END_ID = public_tokenizers.path("word_bpe_49k.json"), 2
SEQUENCE, OPEN_WINDOWS = 4096, 32
#: A gap shorter than this is padded, not filled by cutting a document.
LEAST_PIECE = 8
#: Partitions whose last partial windows meet in one task: at most MERGE x SEQUENCE ids.
MERGE = 128
#: Words whose ids a task keeps; beyond, it starts anew.
CACHE_WORDS = 1_200_000

SPECIAL = ("<|startoftext|>", "<|endoftext|>")
#: Characters for which lower case, NFC and character classes agree between Python and the tokenizer; other texts go to it whole.
_OTHER = re.compile("[^\t-\r\x20-\x7e\xa1-\xb1\xb4-\xb8\xba\xbb\xbf-\u012f\u0131-\u017f]")
#: The tokenizer's own split into words, for those characters.
_WORDS = re.compile(r"[^\W\d_]+|'s|'t|'re|'ve|'m|'ll|'d|\d|(?:[^\s\w]|_)+")


#: Byte-level symbols: a printable byte is itself, the others follow from U+0100 on, in order.
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTE_SYMBOLS = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}


class WordIds(dict):
    """Ids of words, and of texts, as little-endian unsigned 32-bit bytes. A word is tokenised when first asked for."""

    def __init__(self, path: str):
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model

    def __missing__(self, word: str) -> bytes:
        """Ids of a word of the tokenizer's split: its model merges the word's bytes."""
        symbols = word if word.isascii() else word.encode().decode("latin-1").translate(_BYTE_SYMBOLS)
        ids = [t.id for t in self.model.tokenize(symbols)]
        self[word] = data = pack(f"<{len(ids)}I", *ids)
        return data

    def text(self, text: str) -> bytes:
        if _OTHER.search(text) or any(s in text for s in SPECIAL):
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
            return pack(f"<{len(ids)}I", *ids)
        if len(self) > CACHE_WORDS:
            self.clear()
        return b"".join(map(self.__getitem__, _WORDS.findall(text.lower())))


class Packer:
    """Open windows of one partition. A piece is (doc_id, start, ids as bytes, ids of its document)."""

    def __init__(self, size: int, most_open: int, first_sequence: int):
        self.size, self.most_open, self.next = size, most_open, first_sequence
        self.open: list[list] = []  # [free, pieces]
        self.out: list[tuple] = []

    def close(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc_id, start, ids, tokens in pieces:
            n = len(ids) // 4
            self.out.append((doc_id, start, n, zlib.crc32(ids), tokens, self.next, offset, None))
            offset += n
        self.next += 1

    def add(self, doc_id, ids: bytes) -> None:
        tokens, at = len(ids) // 4, 0
        while tokens - at >= self.size:
            self.close([(doc_id, at, ids[4 * at : 4 * (at + self.size)], tokens)])
            at += self.size
        while at < tokens:
            rest = tokens - at
            fits = min((w for w in self.open if w[0] >= rest), key=lambda w: w[0], default=None)
            if fits is None and len(self.open) < self.most_open:
                self.open.append(fits := [self.size, []])
            if fits is None:
                fullest = min(self.open, key=lambda w: w[0])
                self.open.remove(fullest)
                if fullest[0] >= LEAST_PIECE:
                    fullest[1].append((doc_id, at, ids[4 * at : 4 * (at + fullest[0])], tokens))
                    at += fullest[0]
                self.close(fullest[1])
                continue
            fits[1].append((doc_id, at, ids[4 * at :], tokens))
            fits[0] -= rest
            at = tokens
            if fits[0] == 0:
                self.open.remove(fits)
                self.close(fits[1])

    def pour(self, pieces: list[tuple]) -> list[tuple]:
        """Full windows from the pieces in order, cutting where a window ends; returns the last, partial one."""
        window, free = [], self.size
        for doc_id, start, ids, tokens in pieces:
            while len(ids) // 4 >= free:
                window.append((doc_id, start, ids[: 4 * free], tokens))
                self.close(window)
                start, ids, window, free = start + free, ids[4 * free :], [], self.size
            if ids:
                window.append((doc_id, start, ids, tokens))
                free -= len(ids) // 4
        return window


FIELDS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]


def _batch(rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
    kinds = [id_type, *[pa.int64()] * 6, pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], FIELDS)


_word_ids: dict[str, WordIds] = {}


def _pack_partition(path: str, end_id: int, size: int, most_open: int):
    end = pack("<I", end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _word_ids:
            _word_ids[path] = WordIds(path)
        words, packer, id_type = _word_ids[path], Packer(size, most_open, TaskContext.get().partitionId() << 32), pa.int64()
        for batch in batches:
            ids, texts, id_type = batch.column(0).to_pylist(), batch.column(1), batch.column(0).type
            for first in range(0, batch.num_rows, 256):
                for doc_id, text in zip(ids[first:], texts.slice(first, 256).to_pylist()):
                    packer.add(doc_id, words.text(text or "") + end)
                yield _batch(packer.out, id_type)
                packer.out = []
        partial = packer.pour([p for w in sorted(packer.open, key=lambda w: w[0]) for p in w[1]])
        packer.out += [(d, start, len(data) // 4, None, tokens, None, None, data) for d, start, data, tokens in partial]
        yield _batch(packer.out, id_type)

    return run


def _merge(size: int):
    def run(key: tuple, pieces: pd.DataFrame) -> pd.DataFrame:
        packer = Packer(size, 1, (1 << 62) + (int(key[0]) << 32))
        pieces = pieces.sort_values(["part", "place"])
        rest = packer.pour(list(zip(pieces["doc_id"], pieces["start"], pieces["ids"], pieces["doc_tokens"])))
        left = sum(len(p[2]) // 4 for p in rest)
        while left:  # the last window: powers of two, the largest first
            packer.size = 1 << (left.bit_length() - 1)
            rest = packer.pour(rest)
            left -= packer.size
        return pd.DataFrame(packer.out, columns=FIELDS)[FIELDS[:-1]].astype({"doc_id": pieces["doc_id"].dtype})

    return run


def pack_documents(docs: DataFrame, path: str = TOKENIZER, end_id: int = END_ID, size: int = SEQUENCE, most_open: int = OPEN_WINDOWS) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    numbers = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    first = docs.select("doc_id", "text").mapInArrow(_pack_partition(path, end_id, size, most_open), f"doc_id {id_type}, {numbers}, ids binary")
    first = cut_lineage(first.withColumn("part", F.spark_partition_id()).withColumn("place", F.monotonically_increasing_id()))
    done = first.filter(F.col("ids").isNull()).select(FIELDS[:-1])
    partial = first.filter(F.col("ids").isNotNull())
    # A null id would turn a pandas column of longs into doubles, so ids travel as text.
    merged = (
        partial.withColumn("doc_id", F.col("doc_id").cast("string"))
        .groupBy(F.floor(F.col("part") / MERGE).alias("group"))
        .applyInPandas(_merge(size), f"doc_id string, {numbers}")
        .withColumn("doc_id", F.col("doc_id").cast(id_type))
    )
    return done.unionByName(merged)
