"""Fill-in-middle, line dedup and hard negatives against brute force, and on awkward tables."""

import collections
import hashlib
import math
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyward.llm import chat, decontaminate, exact_dedup, fill_middle, hard_negatives, html_text, line_dedup, secret_scan, warc
from tallyward.llm import queries as registered
from tallyward.llm.common import table

from test_text_operators import LONG, awkward, documents


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# 13 Fill in the middle


def whole_output(doc_id, text):
    """The contract's output, written without chunks."""
    digest = sha(f"1:{'' if doc_id is None else doc_id}")
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(text) + 1), h[1] % (len(text) + 1)))
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        return "plain", text
    if h[3] % 100 < 20:
        return "spm", f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}"
    return "psm", f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}"


def assert_filled(rows, texts):
    assert len(rows) == len(texts)
    for r, (doc_id, text) in zip(sorted(rows, key=lambda r: (r.doc_id is None, r.doc_id or 0, r.n)), sorted(texts, key=lambda t: (t[0] is None, t[0] or 0, len(t[1])))):
        form, output = whole_output(doc_id, text)
        assert (r.doc_id, r.n, r.form, r.output_sha256, r.restored_sha256) == (doc_id, len(text), form, sha(output), sha(text))
        assert (r.prefix_chars is None) == (r.middle_chars is None) == (form == "plain")


@pytest.mark.parametrize("size", [3, fill_middle.CHUNK])
def test_fill_in_middle_equals_whole_texts(spark, size):
    texts = [(i, t) for i, t in enumerate(["", "a", "<", "a<P>b", "x<M", "<<S", "ab" * 50, "🙂é\x00ü" * 40, "line\nline\n" * 9, "P>S>M>"] * 12)]
    texts += [(7, "the same"), (7, "the same"), (None, "without id"), (10_000, LONG)]
    docs = spark.createDataFrame([(i, t, "x", 0) for i, t in texts], "doc_id long, text string, form string, row int").repartition(5)
    rows = fill_middle.fill_in_middle(docs, size=size).collect()
    assert_filled(rows, texts)
    assert {r.form for r in rows} == {"plain", "psm", "spm"}


def test_fill_in_middle_of_awkward_rows(spark):
    rows = fill_middle.fill_in_middle(awkward(spark)).collect()
    assert_filled(rows, [(r.doc_id, r.text or "") for r in awkward(spark).collect()])
    assert fill_middle.fill_in_middle(awkward(spark).limit(0)).count() == 0


def test_output_chunks_lie_in_order_and_are_the_output(spark):
    docs = documents(spark, [(i, f"text {i} " * 30, None) for i in range(40)])
    parts = [[(r.row, r.place, r.chunk, r.doc_id) for r in p] for p in fill_middle.output_chunks(docs, size=16).rdd.glom().collect()]
    seen = set()
    for part in parts:
        assert [x[:2] for x in part] == sorted(x[:2] for x in part)
        got, ids = collections.defaultdict(str), {}
        for row, place, chunk, doc_id in part:
            got[row] += chunk
            ids.setdefault(row, doc_id)
        assert not seen & set(got)
        seen |= set(got)
        for row, output in got.items():
            assert output == whole_output(ids[row], f"text {ids[row]} " * 30)[1]
    assert len(seen) == 40


def test_texts_cross_the_network_once(spark, sf):
    plan = registered.op13_fill_middle(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression") == 1 and plan.count("Sort [") == 2


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="<PSM>ab", max_size=30), st.integers(0, 10**6), st.integers(1, 7))
def test_restorer_gives_the_text_back(text, doc_id, size):
    form, first, second = fill_middle.plan(doc_id, text)
    reader, parts = fill_middle.Restorer(form), []
    for chunk in [*fill_middle.chunks(text, form, first, second, size)]:
        parts += reader.feed(chunk)
    parts += reader.feed("", last=True)
    assert "".join(t for _, t in sorted(parts, key=lambda p: p[0])) == text


# 12 Line dedup


def without_repeats(rows, least_chars=20, least_documents=3):
    """(doc_id, lines, dropped, sha) of each row, by counting whole keys."""
    def key(line):
        return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))

    holds = collections.defaultdict(set)
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= least_chars:
                holds[key(line)].add(doc_id)
    stays = {k: max(i for i in ids if i is not None) for k, ids in holds.items() if len(ids) >= least_documents}
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key(x) not in stays or stays[key(x)] == doc_id]
        out.append((doc_id, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return out


def some_documents():
    rng = np.random.default_rng(3)
    pool = [f"{'A common line of this corpus' if i % 2 else 'ein üblicher Satz dieses Korpus'} no. {i}" for i in range(60)]
    rows = [(i, "\n".join([*(pool[j] for j in rng.integers(0, 60, rng.integers(0, 9))), f"only here {i} " * 3])) for i in range(150)]
    rows += [(200, "  \tA COMMON line of this corpus no. 1\r\nshort\nshort"), (201, "short\n\n"), (202, "x" * 19 + "\n" + "y" * 20), (203, "Y" * 20), (204, "y" * 20 + "\n" + "y" * 20)]
    return rows


def found_lines(docs, **options):
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in line_dedup.drop_repeated_lines(docs, **options).collect()), key=str)


@pytest.mark.parametrize("bits", [None, 16, 8])
def test_repeated_lines_equal_brute_force(spark, bits):
    """Also where the filter is far too small: then more lines are counted, and the result is the same."""
    rows = some_documents()
    docs = documents(spark, [(*r, None) for r in rows]).repartition(7)
    assert found_lines(docs, bits=bits) == sorted(without_repeats(rows), key=str)


def test_repeated_lines_of_awkward_rows(spark):
    line = "this line is long enough to count"
    rows = [(1, None), (2, ""), (3, "\n"), (4, f"{line}\n{LONG}"), (5, f"{line}\nthen more"), (6, line.upper()), (6, line.upper()), (6, f"{line}\n🙂"), (None, f"{line}\n \x00"), (None, None)]
    docs = spark.createDataFrame([(i, t, 1, "x", True) for i, t in rows], "doc_id long, text string, print int, lines string, sha boolean")
    assert found_lines(docs) == sorted(without_repeats(rows), key=str)
    assert found_lines(docs.limit(0)) == []
    # Two rows of one id are one document.
    twice = spark.createDataFrame([(1, line), (1, line), (2, line)], "doc_id long, text string")
    assert all(r[2] == 0 for r in found_lines(twice))


def test_only_suspected_lines_leave_the_scan(spark):
    rows = [(i, f"this line stands in one document only: {i}\nand this one in all the documents") for i in range(400)]
    docs = documents(spark, [(*r, None) for r in rows]).repartition(4)
    bits = line_dedup.filter_bits(docs)
    shared = spark.sparkContext.broadcast(line_dedup.twice_seen(docs, bits))
    suspects = docs.select("text", "doc_id", F.xxhash64("text")).mapInArrow(line_dedup._suspects(shared, bits, 20), "doc_id long, print long, sha binary, lines array<int>")
    shas = collections.Counter(bytes(r.sha) for r in suspects.collect())
    assert shas[hashlib.sha256(b"and this one in all the documents").digest()] == 400 and len(shas) < 20


@settings(max_examples=50, deadline=None)
@given(st.lists(st.sets(st.integers(0, 300), max_size=60), min_size=2, max_size=6))
def test_no_hash_seen_twice_is_missed(tasks):
    """Filters of tasks merge so that what two tasks have seen passes."""
    import pyarrow as pa

    bits, parts = 10, []
    hashes = lambda s: np.sort(line_dedup._hashes([str(x).encode() for x in s]))
    for task in tasks:
        parts += [(segment, 1, data) for segment, data in line_dedup._segments(hashes(task), bits)]
    batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*sorted(parts)), (pa.int64(), pa.int32(), pa.binary()))], ["segment", "kind", "bits"]) if parts else None
    merged = b"".join(b.column(1)[0].as_py() for b in line_dedup._merged([batch])) if parts else bytes(1 << (bits - 3))
    twice = np.unpackbits(np.frombuffer(merged, np.uint8))
    repeated = [x for x, n in collections.Counter(x for t in tasks for x in t).items() if n > 1]
    for at in line_dedup.places(hashes(repeated), bits) if repeated else ():
        assert twice[at.astype(int)].all()


# 11 Hard negatives

VECTORS = "vec_id long, embedding array<float>, label int, score double, place string"


def vectors(spark, rows):
    return spark.createDataFrame([(*r, 0.0, "x") for r in rows], VECTORS)


def mined(rows, anchors, positives=5, negatives=10):
    """The contract by loops over whole lists."""
    usable = [(i, [math.floor(256 * float(np.float32(x))) for x in v], label) for i, v, label in rows if i is not None and v is not None and label is not None and all(x is not None and math.isfinite(x) for x in v)]
    out, asked = [], {}
    for i, v, label in usable:
        if anchors(i):
            asked[i] = min(asked.get(i, (label, v)), (label, v))
    for i, (label, v) in asked.items():
        scored = sorted((-max(-hard_negatives.MOST, min(hard_negatives.MOST, sum(a * b for a, b in zip(v, w)))), j, other) for j, w, other in usable if j != i and len(w) == len(v))
        near = [(-s, j) for s, j, other in scored if other == label][:positives]
        for p, j in near:
            fits = [(-s, k) for s, k, other in scored if other != label and 30 * p <= -100 * s <= 90 * p][:negatives]
            out += [(i, j, rank, k, p, s) for rank, (s, k) in enumerate(fits, 1)]
    return sorted(out)


def found_negatives(rows, anchors):
    return sorted(tuple(r) for r in hard_negatives.mine(rows, anchors).collect())


@pytest.mark.parametrize("smooth", [False, True])
def test_hard_negatives_equal_brute_force(spark, smooth, monkeypatch):
    rng = np.random.default_rng(5)
    walk = rng.normal(size=(700, 40)).cumsum(axis=1) / 12 if smooth else rng.normal(size=(700, 40)) / 4
    rows = [(i, [float(x) for x in np.float32(v)], int(i % 3)) for i, v in enumerate(walk)]
    expected = mined(rows, lambda i: i % 50 == 0)
    assert expected and found_negatives(vectors(spark, rows).repartition(6), F.col("vec_id") % 50 == 0) == expected
    # Any layout of the grid gives the same.
    for name, value in (("BLOCK", 32), ("CELL_BLOCKS", 2), ("CELL_ANCHORS", 3), ("STEP", 16), ("DENSE", 1)):
        monkeypatch.setattr(hard_negatives, name, value)
    assert found_negatives(vectors(spark, rows).repartition(3), F.col("vec_id") % 50 == 0) == expected


def test_hard_negatives_of_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 1.0], 1), (1, [1.0, 1.0], 1), (2, [0.5, 0.5], 2), (3, [0.5, 0.5], 2), (4, [0.5, 0.5], None), (5, None, 2), (6, [0.5, None], 2), (7, [0.5, nan], 2), (8, [inf, 0.5], 2), (None, [0.5, 0.5], 2)]
    rows += [(9, [0.5, 0.5, 0.0], 2), (10, [], 1), (11, [], 1), (12, [], 2), (1, [1.0, 1.0], 1), (0, [1.0, 1.0], 1), (13, [-1.0, -1.0], 1), (20, [1e38, 1.0], 4), (21, [1e38, 0.0], 4), (22, [5e15, 0.0], 5)]
    expected = mined(rows, lambda i: i % 10 == 0)
    got = found_negatives(vectors(spark, rows), F.col("vec_id") % 10 == 0)
    assert got == expected and {r[0] for r in got} == {0, 10} and got.count((0, 1, 1, 2, 131072, 65536)) == 2
    empty = vectors(spark, rows).limit(0)
    assert found_negatives(empty, F.col("vec_id") % 10 == 0) == []
    assert found_negatives(vectors(spark, rows), F.lit(False)) == []


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 40), st.integers(0, 2**32), st.sampled_from([1, 50, 10**6]))
def test_bounds_hold(dim, seed, size):
    rng = np.random.default_rng(seed)
    a, b = rng.integers(-size, size + 1, (4, dim)), rng.integers(-size, size + 1, (6, dim))
    exact = a @ b.T
    slack = 1e-5 * np.sqrt((a.astype(float) ** 2).sum(1))[:, None] * np.sqrt((b.astype(float) ** 2).sum(1)) + 1
    stored = [tuple(p.astype("<f4").astype(float) for p in pair) for pair in hard_negatives.summaries(b)]
    for i in range(4):
        for j in range(6):
            least, most = np.full(4, float(exact[i, j])), np.full(4, float(exact[i, j]))
            assert hard_negatives.undecided(hard_negatives.summaries(a), stored, slack, np.ones((4, 6), bool), least, most)[i, j]


def test_bounds_spare_most_exact_scores(spark, monkeypatch):
    """Vectors that a few segments describe well are decided by their summaries."""
    rng = np.random.default_rng(9)
    values = np.repeat(rng.normal(size=(900, 4)), 16, axis=1) + rng.normal(size=(900, 64)) * 0.01
    matrix = np.floor(256 * values).astype(np.int64)
    asked, rest = matrix[:20], matrix[20:]
    scores = asked @ rest.T
    tenth = np.sort(scores, axis=1)[:, -10].astype(float)
    slack = 1e-5 * np.sqrt((asked**2.0).sum(1))[:, None] * np.sqrt((rest**2.0).sum(1)) + 1
    open_ = hard_negatives.undecided(hard_negatives.summaries(asked), hard_negatives.summaries(rest), slack, np.ones(scores.shape, bool), tenth, np.full(20, np.inf))
    assert open_[scores >= tenth[:, None]].all() and open_.mean() < 0.05


def test_hard_negatives_query_flips_labels(spark, sf):
    rows = table(spark, sf, "embeddings").collect()
    flipped = [(r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label) for r in rows]
    assert sorted(tuple(r) for r in registered.op11_hard_negatives(spark, sf).collect()) == mined(flipped, lambda i: i % 100 == 0)


# Mended operators of earlier rounds


def mixed_hosts():
    """Pages of one host in several layouts, with boilerplate that has no telling names: (layouts, html, article)."""
    def page(kind, i, article):
        return f"<body><div class='q{kind} top'><p>Free delivery for everyone {i % 3}</p></div>{article}<div class='z{kind}'><p>Read what others bought, and more of that kind</p></div></body>"

    text = "The article goes on for a while, sentence after sentence, with words. " * 6 + "It ends at"
    for layouts in (2, 4, 10):
        yield [(page(i % layouts, i, f"<div class='l{'abcdefghij'[i % layouts]}'><p>{text} {i}</p></div>"), f"{text} {i}") for i in range(80)]
    for share in (10, 30, 45):
        yield [(page("", i, f"<article class='cat-{'x' if i % 100 < share else 'y'}'><p>{text} {i}</p></article>"), f"{text} {i}") for i in range(100)]
    yield [(page("", i, f"<article class='cat-{'abcdefghij'[i % 10]}'><p>{text} {i}</p></article>"), f"{text} {i}") for i in range(100)]


def test_mixed_hosts_leak_nothing(spark):
    rows, wanted = [], {}
    for h, pages in enumerate(mixed_hosts()):
        for i, (html, text) in enumerate(pages):
            rows.append((1000 * h + i, f"http://h{h}.org/{i}", html))
            wanted[1000 * h + i] = text
    found = html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in found} == wanted


def test_consensus_beats_one_odd_page(spark):
    """A page whose longest container is not the host's article takes the article; a container of few pages outdoes nothing."""
    wide = "<body><div class='t{}'><p>{}</p></div><div class='story'><p>{}</p></div></body>"
    rows = [(i, "http://a.org/x", wide.format(i, "short", "the long article text " * 5)) for i in range(30)]
    rows += [(99, "http://a.org/y", wide.format("zz", "a long teaser, this once " * 9, "the article")), (100, "http://b.org", "<body><p>only text</p><div><p>x</p></div></body>")]
    found = {r.page_id: r.text for r in html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert found[99] == "the article" and found[100] == "only text\n\nx"


def test_deep_pages_take_little_memory():
    import tracemalloc

    for source in ("<div>" * 40_000 + "end", "<div><p>" * 20_000 + "</b>" * 20_000 + "end", "<ul><li><div>" * 13_000 + "end"):
        tracemalloc.start()
        page = html_text.Page(source)
        assert page.text({}) == "end"
        assert tracemalloc.get_traced_memory()[1] < 200 << 20
        tracemalloc.stop()


def test_all_articles_of_a_larger_table(spark):
    folder = "/root/testdata/sf0.01"
    for r in html_text.main_text(table(spark, folder, "pages")).join(table(spark, folder, "pages").select("page_id", "html"), "page_id").collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.DOTALL)[1]
        blocks = [" ".join(html_text.entities.unescape(re.sub("<br>", " ", re.sub("</?b>", "", b))).split()) for b in re.split("</?(?:p|h1)>", inner)]
        assert r.text == "\n\n".join(b for b in blocks if b)


KEY = "AKIA" + "Q2W3E4R5T6Y7U8I9"


@pytest.mark.parametrize("text", ["%FF" + KEY.replace("A", "%41"), "%00%00" + "".join(f"%{ord(c):02x}" for c in KEY), "".join(f"%{ord(c):02X}" for c in KEY) + "%C3", "%E9%FF%41" + KEY[1:], "caf%E9%20" + "".join(f"%{b:02x}" for b in b"token=abcdef123")])
def test_bad_bytes_hide_no_secret(text):
    base, found, partly = secret_scan.scanned(text)
    assert not partly and any(kind in (0, 1) for _, kind, _ in found), found
    start, _, end = found[0]
    assert 0 <= start < end <= len(text)


def test_mixed_bytes_keep_their_spans():
    text = "x%FF" + "".join(f"%{ord(c):02x}" for c in KEY) + "%FE y"
    assert secret_scan.scan(text)[1] == [(4, 1, 4 + 3 * len(KEY))]


def test_a_layer_that_is_too_long_says_so(spark, monkeypatch):
    import base64
    import gzip

    monkeypatch.setattr(secret_scan, "MAX_LAYER", 1000)
    long, short = (base64.b64encode(gzip.compress((KEY + " " + "x" * n).encode())).decode() for n in (5000, 10))
    assert secret_scan.scanned(long)[2] and not secret_scan.scanned(short)[2] and secret_scan.scan(long)[1]
    monkeypatch.undo()
    docs = documents(spark, [(1, long, None), (2, None, None)])
    assert {r.doc_id: r.partly_scanned for r in secret_scan.secrets(docs).collect()} == {1: False, 2: False}


def test_archives_through_the_query(spark, folder):
    pages = [(1, "u", "x"), (None, "u", "x"), (None, "u", "only here"), (3, None, None), (2, "w", "x")]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{folder}/pages.parquet")
    got = sorted(((r.page_id, r.record_type, r.refers_to) for r in registered.op7_warc(spark, folder).collect()), key=str)
    assert got == sorted([(1, "revisit", 2), (2, "response", None), (3, "response", None), (None, "response", None), (None, "revisit", 2)], key=str)


def test_archives_of_other_writers(spark, folder):
    import gzip
    import os
    import zlib

    def record(i, body, names=str):
        headers = {"WARC-Type": "response", "WARC-Record-ID": f"<urn:page:{i}>", "Content-Length": str(len(body))}
        return b"WARC/1.0\r\n" + "".join(f"{names(k)}: {v}\r\n" for k, v in headers.items()).encode() + b"\r\n" + body + b"\r\n\r\n"

    bodies = [os.urandom(3_000_000), b"", b"WARC/1.0\r\n\r\n", b"y" * 70_000, b"\r\n\r\nend"]
    records = b"".join(record(i, b, str.lower if i % 2 else str) for i, b in enumerate(bodies))
    os.makedirs(f"{folder}/one")
    with open(f"{folder}/one/a.warc.gz", "wb") as f:
        f.write(gzip.compress(records))  # one member
    with open(f"{folder}/one/b.warc.gz", "wb") as f:
        f.write(gzip.compress(records[:100]) + gzip.compress(records[100:]))  # members end anywhere
    with open(f"{folder}/one/c.warc", "wb") as f:
        f.write(records)
    for payload in (True, False):
        got = warc.read_archives(spark, f"{folder}/one", payload=payload).collect()
        assert sorted((r.record_id, r.payload_length) for r in got) == sorted((str(i), len(b)) for i, b in enumerate(bodies) for _ in range(3))
        assert not payload or all(bytes(r.payload) == bodies[int(r.record_id)] for r in got)
    # What breaks off is an error, whether it is read or passed over.
    packed = zlib.compressobj(6, zlib.DEFLATED, 31)
    for n, (name, data) in enumerate([("c.warc", records[:-40]), ("d.warc", records[:1_000_000]), ("e.warc.gz", gzip.compress(records)[:-9]), ("f.warc.gz", gzip.compress(records[:-40])), ("g.warc", b"WARC/1.0\r\nWARC-Type: x\r\n\r\n")]):
        os.makedirs(f"{folder}/bad{n}")
        with open(f"{folder}/bad{n}/{name}", "wb") as f:
            f.write(data)
        for payload in (True, False):
            with pytest.raises(Exception, match="early|without"):
                warc.read_archives(spark, f"{folder}/bad{n}", payload=payload).collect()


def test_the_machine_stands_in_the_query(spark, sf):
    plan = registered.op9_chat_format(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    assert "start" in plan and "assistant" in plan
    turns = [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (2, 0, "assistant", "x"), (2, 1, "user", "y"), (3, 0, ">\nodd|>", "<|end|>\n␛1"), (3, 1, "user", "z"), (4, 0, "system", ""), (4, 1, "user", None)]
    out = {r.conv_id: r for r in chat.format_conversations(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")).withColumn("turns", chat.read_back(F.col("formatted"))).collect()}
    assert {i: (r.valid, r.bad_position) for i, r in out.items()} == {1: (True, None), 2: (False, 0), 3: (False, 0), 4: (False, 2)}
    assert [(t.role, t.text) for t in out[3].turns] == [(">\nodd|>", "<|end|>\n␛1"), ("user", "z")]
    assert [s.text for s in out[2].segments if s.loss] == ["x"] and [s.text for s in out[1].segments if s.loss] == ["b"]
    # A machine with other moves gives other answers: nothing but its table decides.
    free = chat.Template(follows={"start": ("assistant",), "assistant": ("user",)}, ends=("user",), loss=("user",))
    other = {r.conv_id: r for r in chat.format_conversations(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"), free).collect()}
    assert other[2].valid and not other[1].valid and [s.text for s in other[2].segments if s.loss] == ["y"]


def test_groups_come_from_neighbours(spark, monkeypatch):
    docs = documents(spark, [(i, f"text {i // 3}", None) for i in range(30)])
    want = sorted((r.doc_id, r.keep_id, r.group_size) for r in exact_dedup.exact_duplicates(docs).collect())
    assert want == [(i, i // 3 * 3, 3) for i in range(30)]
    hot = documents(spark, [(i, "same  text" if i % 2 else "sametext", None) for i in range(500)])
    got = exact_dedup.exact_duplicates(hot, shards=4).collect()
    assert {(r.keep_id, r.group_size) for r in got} == {(1, 500)} and [r.doc_id for r in got if r.kept] == [1]
    # Without the comparison of neighbours every row is its own run's member, and groups differ.
    monkeypatch.setattr(exact_dedup.F, "lag", lambda c: F.first(c))
    off = sorted((r.doc_id, r.keep_id, r.group_size) for r in exact_dedup.exact_duplicates(docs, shards=1).collect())
    assert off != want


def test_a_large_benchmark_lets_little_through(spark):
    """Windows that pass the filter by chance are fewer than one in a hundred, whatever the benchmark's size."""
    words = lambda seed, n: " ".join(f"w{x}" for x in np.random.default_rng(seed).integers(0, 5000, n))
    items = spark.createDataFrame([(f"i{i}", words(i, 400)) for i in range(250)], "item_id string, text string")
    docs = spark.createDataFrame([(i, words(10_000 + i, 2000)) for i in range(40)] + [(99, words(3, 400)[:300])], "doc_id long, text string")
    found = items.mapInArrow(decontaminate._item_windows(10, 8), "item_id string, print long, words string")
    bits = decontaminate.filter_bits(found.count())
    shared = spark.sparkContext.broadcast(decontaminate._filter(found, bits))
    schema = "row long, id0 long, n_words long, hits array<struct<print: long, at: int, length: int, words: string>>"
    passed = docs.filter("doc_id < 99").select("text", "doc_id").mapInArrow(decontaminate._document_windows([(10, 8)], shared, bits), schema)
    assert passed.agg(F.sum(F.size("hits"))).first()[0] < 0.01 * 40 * 1990
    got = {r.doc_id: r.n_items for r in decontaminate.contamination(docs, items).collect()}
    assert got[99] == 1 and sum(got.values()) == 1
    # A filter far too small changes nothing.
    assert sorted(map(str, decontaminate.contamination(docs, items, bits=8).collect())) == sorted(map(str, decontaminate.contamination(docs, items).collect()))


def test_shared_windows_are_one_class(spark):
    shared = " ".join(f"s{i}" for i in range(60))
    items = spark.createDataFrame([(f"i{i}", f"own{i} {shared}") for i in range(50)] + [("i3", f"own3 {shared}")], "item_id string, text string")
    docs = spark.createDataFrame([(1, f"x {shared} y"), (2, f"own7 {shared}"), (3, "nothing")], "doc_id long, text string")
    got = {r.doc_id: (r.n_hit, r.n_items) for r in decontaminate.contamination(docs, items).collect()}
    assert got == {1: (60, 50), 2: (61, 50), 3: (0, 0)}
