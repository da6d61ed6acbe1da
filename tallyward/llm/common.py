"""What several text operators share: Arrow texts as byte chunks, the held-out rule, seeded samples."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, `[\x20\x09-\x0D]`.
SPACES = " \t\n\x0b\x0c\r"
#: Bytes of text that a task looks at in one vectorised step; one longer text is a step of its own.
CHUNK_BYTES = 1 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def held_out(doc_id: str = "doc_id") -> Column:
    """True where crc32 of the id as text is divisible by 5. A null id is never held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learnable(doc_id: str = "doc_id") -> Column:
    """Rows a model may learn from: not held out, and with an id."""
    return F.col(doc_id).isNotNull() & ~held_out(doc_id)


def sampled(key: Column, rate: float) -> Column:
    """A repeatable sample of about this rate, by a hash of the key."""
    grain = 1 << 30
    return F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(grain)) < F.lit(min(grain, round(rate * grain)))


def free_name(docs: DataFrame, name: str) -> str:
    """The name, or one made of it that no column has."""
    while name.lower() in {c.lower() for c in docs.columns}:
        name = f"_{name}"
    return name


def numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """The rows with a number of their own, and its column, a name that no other has; repeated rows and repeated ids
    stay apart by it. Each evaluation numbers anew, and otherwise where the scan is cut otherwise: store the rows before a second use."""
    name = free_name(docs, "row")
    return docs.withColumn(name, F.monotonically_increasing_id()), name


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column, and the offsets of its rows in them; null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, bounds, data = column.buffers()
    offsets = np.frombuffer(bounds, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    bytes_ = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return bytes_[offsets[0] : offsets[-1]], offsets - offsets[0]


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Whole texts in chunks of about ``limit`` bytes: first row, row after the last, bytes, offsets from 0."""
    data, offsets = text_bytes(column)
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1)
        last = min(last, first + 4096)
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last
