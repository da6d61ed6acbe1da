"""Secrets in texts, also behind nested encodings.

A worklist starts with the text and scans every layer for the three kinds. From each layer it
unwraps: percent escapes, Unicode and character escapes (each gives the whole layer with the
escapes replaced), runs of base64 (each a layer of its own; where bytes of it are not readable, and at the
three other alignments, each readable stretch) and compressed bytes found in them
(gzip, zlib, bzip2, xz). It goes on until no layer brings a new one; a layer whose content was seen
at the same place is not entered again, so cycles end. Every character of a layer knows the span of
the original text that it comes from; what is found in a layer is reported at that span.

Bytes of a percent run that are not UTF-8 become one replacement character each, so that they hide nothing
around them. The members of a compressed layer are read as one text, up to ``MAX_LAYER`` bytes, as a guard
against decompression bombs; a document with a longer layer says so (``partly_scanned``).

Edge cases: null and empty texts have no spans; ids, repeated rows and ties pass through, one row
per input row. Other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import bz2
import hashlib
import lzma
import re
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

MAX_LAYER = 1 << 26
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
#: Maximal runs: the same as `[0-9a-f]+` with its short matches dropped.
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
ESCAPE = re.compile(r"\\u\{([0-9A-Fa-f]{1,6})\}|\\U([0-9A-Fa-f]{8})|((?:\\u[0-9A-Fa-f]{4})+)|\\x([0-9A-Fa-f]{2})|&#[xX]([0-9A-Fa-f]{1,6});|&#([0-9]{1,7});")
_B64 = "[A-Za-z0-9+/_-]"
#: A run over any number of lines, and a shorter last line, which may as well be a word of the text.
BASE64 = re.compile(rf"(?<!{_B64})({_B64}{{14,}}(?:\r?\n{_B64}{{14,}})*={{0,2}})((?<!=)\r?\n{_B64}{{1,13}}(?!{_B64})={{0,2}})?")
#: UTF-8 without control characters, as long as the shortest secret.
READABLE = re.compile(
    rb"(?:[\x09-\x0d\x20-\x7e]|[\xc2-\xdf][\x80-\xbf]|\xe0[\xa0-\xbf][\x80-\xbf]|[\xe1-\xec\xee\xef][\x80-\xbf]{2}|\xed[\x80-\x9f][\x80-\xbf]"
    rb"|\xf0[\x90-\xbf][\x80-\xbf]{2}|[\xf1-\xf3][\x80-\xbf]{3}|\xf4[\x80-\x8f][\x80-\xbf]{2}){12,}"
)
#: The first bytes of compressed data, and what reads it.
MAGIC = ((b"\x1f\x8b", lambda: zlib.decompressobj(31)), (b"BZh", bz2.BZ2Decompressor), (b"\xfd7zXZ\x00", lzma.LZMADecompressor), (b"x\x01", zlib.decompressobj), (b"x\x5e", zlib.decompressobj), (b"x\x9c", zlib.decompressobj), (b"x\xda", zlib.decompressobj))
MAGICS = re.compile(b"|".join(re.escape(m) for m, _ in MAGIC))
_CONTROL = re.compile("[\x00-\x08\x0e-\x1f\x7f]")


def matches(text: str) -> Iterator[tuple[str, int, int]]:
    """The base rule: (kind, start, end) of leftmost matches, kind by kind, without those that are too short."""
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        yield from (("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6)
    if "AKIA" in text:
        yield from (("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= 20)
    yield from (("hex", *m.span()) for m in HEX.finditer(text))


class Layer:
    """A text and, for each of its characters, the span of the original it comes from. ``at`` is (starts, ends); one
    pair of numbers where all characters come from the same span; None where the layer is the original."""

    def __init__(self, text: str, at=None):
        self.text, self.at = text, at

    def span(self, start: int, end: int) -> tuple[int, int]:
        if self.at is None:
            return start, end
        if isinstance(self.at[0], int):
            return self.at
        return int(self.at[0][start]), int(self.at[1][end - 1])

    def cut(self, start: int, end: int) -> tuple[np.ndarray, np.ndarray]:
        if self.at is None:
            return np.arange(start, end), np.arange(start + 1, end + 1)
        if isinstance(self.at[0], int):
            return np.full(end - start, self.at[0]), np.full(end - start, self.at[1])
        return self.at[0][start:end], self.at[1][start:end]

    def place(self):
        return self.at if self.at is None or isinstance(self.at[0], int) else (int(self.at[0][0]), int(self.at[1][-1])) if len(self.at[0]) else (0, 0)

    def replaced(self, parts: list[tuple[int, int, str, list[tuple[int, int]]]]) -> Layer:
        """The layer with some spans replaced: (start, end, new text, the span in this layer of each new character)."""
        texts, starts, ends, last = [], [], [], 0
        flat = self.at is not None and isinstance(self.at[0], int)
        for start, end, new, froms in [*parts, (len(self.text), len(self.text), "", [])]:
            texts += [self.text[last:start], new]
            if not flat:
                a, b = self.cut(last, start)
                starts.append(a)
                ends.append(b)
                if new:
                    own = [self.span(*f) for f in froms]
                    starts.append(np.array([x[0] for x in own]))
                    ends.append(np.array([x[1] for x in own]))
            last = end
        return Layer("".join(texts), self.at if flat else (np.concatenate(starts), np.concatenate(ends)))


def inflated(data: bytes, cut: list | None = None) -> tuple[str, int]:
    """The text that the bytes hold compressed, of all members one after another, and the bytes that it took; empty if none.
    Where there is more than ``MAX_LAYER``, ``cut`` gets an entry."""
    parts, rest, room = [], data, MAX_LAYER
    while room > 0 and (reader := next((r for m, r in MAGIC if rest.startswith(m)), None)):
        try:
            member = reader()
            parts.append(member.decompress(rest, room))
        except (zlib.error, OSError, ValueError, EOFError, lzma.LZMAError):
            break
        room -= len(parts[-1])
        if cut is not None and room <= 0 and (not member.eof or member.unused_data):
            cut.append(True)
        rest = member.unused_data if member.eof else b""
    return b"".join(parts).decode("utf-8", "replace"), len(data) - len(rest)


def _utf8(data: bytes) -> str | None:
    try:
        text = data.decode("utf-8")
    except UnicodeDecodeError:
        return None
    return None if _CONTROL.search(text) else text


def _widths(text: str) -> list[int]:
    return [1 if c < "\x80" else 2 if c < "\u0800" else 3 if c < "\U00010000" else 4 for c in text]


def _replaced_bytes(data: bytes) -> tuple[str, list[int]]:
    """The bytes as text, and how many bytes each character takes; a byte that belongs to no UTF-8 character is a character of its own."""
    text, widths, at = [], [], 0
    while at < len(data):
        try:
            part, bad = data[at:].decode("utf-8"), 0
        except UnicodeDecodeError as error:
            part, bad = data[at : at + error.start].decode("utf-8"), 1
        text.append(part + "\ufffd" * bad)
        widths += [*_widths(part), *[1] * bad]
        at += len(part.encode()) + bad
    return "".join(text), widths


def percent_layers(layer: Layer, cut: list | None = None) -> Iterator[Layer]:
    if "%" not in layer.text:
        return
    parts = []
    for m in PERCENT.finditer(layer.text):
        data = bytes.fromhex(m[0].replace("%", ""))
        text, widths = _replaced_bytes(data)
        froms, at = [], m.start()
        for w in widths:
            froms.append((at, at := at + 3 * w))
        parts.append((m.start(), m.end(), text, froms))
        end = 0
        for magic in MAGICS.finditer(data):
            if magic.start() < end:
                continue
            inner, taken = inflated(data[magic.start() :], cut)
            if inner:
                end = magic.start() + taken
                yield Layer(inner, layer.span(m.start() + 3 * magic.start(), m.start() + 3 * end))
    if parts:
        yield layer.replaced(parts)


def escape_layers(layer: Layer, cut: list | None = None) -> Iterator[Layer]:
    if "\\" not in layer.text and "&#" not in layer.text:
        return
    parts = []
    for m in ESCAPE.finditer(layer.text):
        if m[3]:
            units = bytes.fromhex(m[3].replace("\\u", ""))
            text = units.decode("utf-16-be", "ignore")
            froms, at = [], m.start()
            for c in text:
                froms.append((at, at := at + (12 if c > "\uffff" else 6)))
        else:
            value = int(m[6]) if m[6] else int(m[1] or m[2] or m[4] or m[5], 16)
            text, froms = chr(value) if value < 0x110000 and not 0xD800 <= value < 0xE000 else "", [m.span()]
        if text:
            parts.append((m.start(), m.end(), text, froms[: len(text)]))
    if parts:
        yield layer.replaced(parts)


def base64_layers(layer: Layer, cut: list | None = None) -> Iterator[Layer]:
    for run in BASE64.finditer(layer.text):
        whole = run[1]
        tries = [(run.start(), whole)]
        if run[2]:
            tries.append((run.start(), run[0]))
        if "\n" in whole:
            tries += [(run.start() + m.start(), m[0]) for m in re.finditer(rf"{_B64}+={{0,2}}", whole)]
        for start, coded in tries:
            chars = [i for i, c in enumerate(coded) if c not in "\r\n="] if "\n" in coded else None
            body = re.sub("[\r\n=]", "", coded).translate({45: 43, 95: 47})

            def part(text: str, shift: int, first: int) -> Layer:
                # Three bytes come from four characters.
                widths = np.array(_widths(text))
                stops = first + np.cumsum(widths)
                a, b = shift + 4 * ((stops - widths) // 3), np.minimum(shift + 4 * ((stops - 1) // 3) + 4, len(body)) - 1
                if chars:
                    index = np.array(chars)
                    a, b = index[a], index[b]
                spans = [layer.span(start + int(x), start + int(y) + 1) for x, y in zip(a, b)]
                return Layer(text, (np.array([s[0] for s in spans]), np.array([s[1] for s in spans])))

            # The run may begin before its payload, with any of its characters: one of four alignments is the payload's.
            for shift in range(4):
                left = body[shift:]
                if len(left) % 4 == 1:
                    left = left[:-1]
                data = base64.b64decode(left + "=" * (-len(left) % 4))
                if not shift and (text := _utf8(data)):
                    if text.strip():
                        yield part(text, 0, 0)
                else:
                    for m in READABLE.finditer(data):
                        yield part(m[0].decode("utf-8"), shift, m.start())
                end = 0
                for m in MAGICS.finditer(data):
                    if m.start() < end:
                        continue
                    text, taken = inflated(data[m.start() :], cut)
                    if text:
                        end = m.start() + taken
                        at = shift + 4 * (m.start() // 3)
                        yield Layer(text, layer.span(start + (chars[at] if chars else at), start + len(coded)))


def scanned(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]], bool]:
    """Base spans and all spans of a text, as sorted (start, kind, end), and whether a layer was too long to be read whole."""
    base, found, seen, work, cut = set(), set(), {(None, text)}, deque([Layer(text)]), []
    while work:
        layer = work.popleft()
        for kind, start, end in matches(layer.text):
            where = layer.span(start, end)
            found.add((where[0], KINDS.index(kind), where[1]))
            if layer.at is None:
                base.add((start, KINDS.index(kind), end))
        for unwrap in (percent_layers, escape_layers, base64_layers):
            for inner in unwrap(layer, cut):
                key = (inner.place(), inner.text)
                if inner.text and key not in seen:
                    seen.add(key)
                    work.append(inner)
    return sorted(base), sorted(found), bool(cut)


def scan(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans and all spans of a text."""
    return scanned(text)[:2]


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def secrets(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans, partly_scanned."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[], [], [], [], [], []]
            for text in batch.column(1):
                base, found, partly = scanned(text.as_py() or "")
                for i in range(3):
                    columns[i].append(sum(s[1] == i for s in base))
                columns[3].append(hashlib.sha256(listed(base).encode()).hexdigest())
                columns[4].append(listed(found))
                columns[5].append(partly)
            kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.bool_()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, columns, kinds)], ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "partly_scanned"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, partly_scanned boolean")
