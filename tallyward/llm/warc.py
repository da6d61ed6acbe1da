"""WARC archives as a Spark data source, for reading and writing.

Reading plans the archive files into partitions of bounded size. In each record the headers are
parsed first; a record that the wanted types or header values exclude is skipped without decoding
its payload (uncompressed files jump over it, compressed ones inflate past it without keeping
it). Header names count in any case, a compressed member may hold any number of records, and a
record that breaks off is an error whether its payload is wanted or not. Predicates reach the reader as options, and through Spark's filter pushdown where the session
enables it. Writing gives each task files of its own, one gzip member for each record, and a
manifest of the committed files, so that a repeated or lost task leaves no records that count.

Paths are URIs that pyarrow's file systems open (local, HDFS, object stores) and that all executors
reach.

Edge cases: a null or empty html is a record with an empty payload, and all empty payloads are
equal; a null url has no target header and reads back as null; rows that repeat the largest page_id
of a payload are all responses; a null page_id is written as an empty id and never names a
response unless all copies are null. An empty table gives archives without records and an empty
result. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In, InputPartition, WriterCommitMessage

from tallyward.context import cut_lineage

SCHEMA = "record_type string, record_id string, target_uri string, payload_digest string, refers_to string, payload_length long, verified boolean, payload binary"
#: Columns that predicates may name, and the header that holds each.
HEADERS = {
    "record_type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "target_uri": "WARC-Target-URI",
    "payload_digest": "WARC-Payload-Digest",
    "refers_to": "WARC-Refers-To",
}
LENGTH_HEADER = "X-Payload-Length"
READ, BATCH, PARTITION, FILE = 1 << 20, 4 << 20, 16 << 20, 64 << 20
URN = "<urn:page:{}>"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


class _Records:
    """Records of one archive: headers first, then the payload if asked for, else it is passed over."""

    def __init__(self, source, compressed: bool):
        self.source, self.compressed = source, compressed
        self.raw, self.member, self.ended = b"", None, False

    def _more(self) -> bytes:
        """The next bytes of the archive, across the members of a compressed one; empty at its end only."""
        while True:
            if not self.raw and not self.ended:
                self.raw = self.source.read(READ)
                self.ended = not self.raw
            if not self.compressed:
                data, self.raw = self.raw, b""
                return data
            if self.member is None or self.member.eof:
                if not self.raw:
                    return b""
                self.member = zlib.decompressobj(31)
            data = self.member.decompress(self.raw, READ)
            self.raw = self.member.unused_data if self.member.eof else self.member.unconsumed_tail
            if data:
                return data
            if self.ended and not self.member.eof:
                raise ValueError("a compressed WARC member ends early")

    def __iter__(self) -> Iterator[tuple[dict[str, str], object]]:
        """(headers with names in lower case, a call that gives the payload) of each record, however records share members."""
        left = b""
        while True:
            left = left.lstrip(b"\r\n")
            while (end := left.find(b"\r\n\r\n")) < 0:
                data = self._more()
                if not data:
                    if left.strip():
                        raise ValueError("a WARC record without the end of its headers")
                    return
                left = (left + data).lstrip(b"\r\n")
            first, *lines = left[:end].decode("utf-8", "replace").replace("\r\n ", " ").replace("\r\n\t", " ").split("\r\n")
            if not first.startswith("WARC/"):
                raise ValueError(f"not a WARC record: {first[:40]!r}")
            headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
            if not headers.get("content-length", "").isdigit():
                raise ValueError(f"a WARC record without a length: {headers.get('warc-record-id')}")
            left, length, taken = left[end + 4 :], int(headers["content-length"]), False

            def payload() -> bytes:
                nonlocal left, taken
                parts, need = [left[:length]], length - len(left)
                left = left[length:]
                while need > 0:
                    data = self._more()
                    if not data:
                        raise ValueError("a WARC payload ends early")
                    parts.append(data[:need])
                    left, need = data[need:], need - len(data)
                taken = True
                return b"".join(parts)

            yield headers, payload
            if not taken:
                left = left[length:] if len(left) >= length else self._passed(length - len(left))

    def _passed(self, rest: int) -> bytes:
        """Passes over the rest of a payload; returns what was read beyond it."""
        if not self.compressed:
            if rest > len(self.raw):  # jump, but not past the end
                to = self.source.tell() + rest - len(self.raw)
                if to > self.source.size():
                    raise ValueError("a WARC payload ends early")
                self.source.seek(to)
                rest = len(self.raw)
            self.raw = self.raw[rest:]
            return b""
        while rest > 0:
            data = self._more()
            if not data:
                raise ValueError("a WARC payload ends early")
            if len(data) > rest:
                return data[rest:]
            rest -= len(data)
        return b""


@dataclass
class _Files(InputPartition):
    paths: list[str]


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.payload = options["path"], options.get("payload", "true") == "true"
        self.wanted: dict[str, list[str]] = json.loads(options.get("wanted", "{}"))

    def partitions(self):
        system, root = _opened(self.path)
        found = {f.path: f.size for f in system.get_file_info(fs.FileSelector(root, recursive=True)) if f.is_file}
        manifests = [p for p in found if p.rsplit("/", 1)[-1].startswith("_committed-")]
        if manifests:  # written here: what no manifest names was left by a lost task
            names = [n for m in manifests for n in json.loads(system.open_input_stream(m).read())]
            files = [f"{root.rstrip('/')}/{n}" for n in names]
        else:
            files = [p for p in found if p.endswith((".warc", ".warc.gz"))]
        parts, size = [[]], 0
        for p in sorted(files):
            if parts[-1] and size + found[p] > PARTITION:
                parts.append([])
                size = 0
            parts[-1].append(p)
            size += found[p]
        return [_Files(p) for p in parts]

    def read(self, partition: _Files) -> Iterator[pa.RecordBatch]:
        system, _ = _opened(self.path)
        rows, size = [], 0
        for path in partition.paths:
            with system.open_input_file(path) as source:
                for headers, payload in _Records(source, path.endswith(".gz")):
                    row = {c: headers.get(h.lower()) for c, h in HEADERS.items()}
                    for c in ("record_id", "refers_to"):
                        row[c] = row[c][1:-1].rsplit(":", 1)[-1] if row[c] else None
                    if row["target_uri"] is not None:
                        row["target_uri"] = unquote(row["target_uri"])
                    if row["payload_digest"]:
                        row["payload_digest"] = row["payload_digest"].removeprefix("sha1:")
                    if any(row[c] not in values for c, values in self.wanted.items()):
                        continue
                    row["payload_length"] = int(headers.get(LENGTH_HEADER.lower(), headers["content-length"]))
                    row["payload"] = payload() if self.payload and row["record_type"] != "revisit" else None
                    row["verified"] = None if row["payload"] is None else base32_sha1(row["payload"]) == row["payload_digest"]
                    rows.append(row)
                    size += 500 + len(row["payload"] or b"")
                    if size > BATCH:
                        yield _record_batch(rows)
                        rows, size = [], 0
        yield _record_batch(rows)


class PushingWarcReader(WarcReader):
    """For sessions with `spark.sql.python.filterPushdown.enabled`: equality on a header column prunes records as they are read."""

    def pushFilters(self, filters):
        for f in filters:
            name = f.attribute[0] if getattr(f, "attribute", None) and len(f.attribute) == 1 else None
            values = [f.value] if isinstance(f, EqualTo) else list(f.value) if isinstance(f, In) else None
            if name in HEADERS and values is not None:
                self.wanted[name] = [v for v in values if v in self.wanted.get(name, values)]
            else:
                yield f


def _record_batch(rows: list[dict]) -> pa.RecordBatch:
    kinds = {"payload_length": pa.int64(), "verified": pa.bool_(), "payload": pa.binary()}
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], kinds.get(n, pa.string())) for n in names], names)


@dataclass
class _Written(WriterCommitMessage):
    names: list[str]


class WarcWriter(DataSourceArrowWriter):
    """Rows (record_type, record_id, target_uri, refers_to, payload_length, payload_sha1, payload) to archives."""

    def __init__(self, options: dict):
        self.path = options["path"]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Written:
        system, root = _opened(self.path)
        system.create_dir(root, recursive=True)
        names, sink, written = [], None, 0
        for batch in iterator:
            for row in batch.to_pylist():
                if sink is None or written > FILE:
                    if sink:
                        sink.close()
                    names.append(f"part-{uuid.uuid4().hex}.warc.gz")
                    sink, written = system.open_output_stream(f"{root.rstrip('/')}/{names[-1]}", compression=None), 0
                member = zlib.compressobj(6, zlib.DEFLATED, 31)
                data = member.compress(_record(row)) + member.flush()
                sink.write(data)
                written += len(data)
        if sink:
            sink.close()
        return _Written(names)

    def commit(self, messages) -> None:
        system, root = _opened(self.path)
        system.create_dir(root, recursive=True)
        with system.open_output_stream(f"{root.rstrip('/')}/_committed-{uuid.uuid4().hex}.json") as out:
            out.write(json.dumps([n for m in messages if m for n in m.names]).encode())

    def abort(self, messages) -> None:
        """Files without a manifest are never read."""


def _record(row: dict) -> bytes:
    payload = row["payload"] or b"" if row["record_type"] != "revisit" else b""
    headers = {
        "WARC-Type": row["record_type"],
        "WARC-Record-ID": URN.format("" if row["record_id"] is None else row["record_id"]),
        "WARC-Date": "1970-01-01T00:00:00Z",
        "WARC-Target-URI": None if row["target_uri"] is None else quote(row["target_uri"], safe="/:?#[]@!$&'()*+,;=-._~"),
        "WARC-Payload-Digest": f"sha1:{base64.b32encode(row['payload_sha1']).decode()}",
        LENGTH_HEADER: row["payload_length"],
        "WARC-Refers-To": None if row["refers_to"] is None else URN.format(row["refers_to"]),
        "WARC-Profile": "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest" if row["record_type"] == "revisit" else None,
        "Content-Type": "text/html",
        "Content-Length": len(payload),
    }
    head = "WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers.items() if v is not None) + "\r\n"
    return head.encode() + payload + b"\r\n\r\n"


class WarcDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        options = dict(self.options)
        return (PushingWarcReader if options.get("pushdown") == "true" else WarcReader)(options)

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(dict(self.options))


def read_archives(spark: SparkSession, path: str, payload: bool = True, **wanted: str | list[str]) -> DataFrame:
    """Records of the archives under ``path``; ``wanted`` gives the values that a header column may have."""
    spark.dataSource.register(WarcDataSource)
    values = {c: [v] if isinstance(v, str) else list(v) for c, v in wanted.items()}
    if odd := values.keys() - HEADERS.keys():
        raise ValueError(f"no header column: {sorted(odd)}")
    pushes = spark.conf.get("spark.sql.python.filterPushdown.enabled", "false")
    return spark.read.format("warc").option("payload", str(payload).lower()).option("wanted", json.dumps(values)).option("pushdown", pushes).load(path)


def write_archives(pages: DataFrame, path: str, least_bytes: int = 0) -> None:
    """Archives of the pages (page_id, url, html), one record each.

    Of pages with equal payloads of ``least_bytes`` or more, the one with the largest page_id is a response and the others revisit it;
    smaller payloads are all responses. Which pages are revisits is found on digests alone; the texts then join their record's kind by page.
    """
    spark = pages.sparkSession
    spark.dataSource.register(WarcDataSource)
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = (
        pages.select("page_id", "url", payload.alias("payload"))
        .withColumn("payload_sha1", F.unhex(F.sha1("payload")))
        .withColumn("payload_length", F.length("payload").cast("long"))
        .withColumn("content", F.unhex(F.sha2("payload", 256)))  # SHA-1 is what the format wants; it does not prove equality
    )
    thin = cut_lineage(rows.select("page_id", "content", "payload_length"))
    # Written on its own, so that Spark can split the pages of a frequent payload.
    last = cut_lineage(
        thin.filter(F.col("payload_length") >= least_bytes).groupBy("content", "payload_length").agg(F.max("page_id").alias("last_id"), F.count("*").alias("n")).filter("n > 1").drop("n")
    )
    revisits = thin.join(last, ["content", "payload_length"]).filter(~F.col("page_id").eqNullSafe(F.col("last_id")))
    revisits = cut_lineage(revisits.select(F.col("page_id").alias("revisit_id"), F.col("content").alias("revisit_content"), "last_id").distinct())
    bodies = rows.join(revisits, F.col("page_id").eqNullSafe(F.col("revisit_id")) & (F.col("content") == F.col("revisit_content")), "left")
    revisit = F.col("revisit_content").isNotNull()
    (
        bodies.select(
            F.when(revisit, "revisit").otherwise("response").alias("record_type"),
            F.col("page_id").cast("string").alias("record_id"),
            F.col("url").alias("target_uri"),
            F.col("last_id").cast("string").alias("refers_to"),
            "payload_length",
            "payload_sha1",
            F.when(~revisit, F.col("payload")).alias("payload"),
        )
        .write.format("warc").mode("append").save(path)
    )
