"""The corpus pipeline against a brute-force version of its filters, and on awkward tables."""

import collections
import os
import re

import numpy as np
import pytest

import corpus_pipeline
from tallyward.llm import language_id, packing, simhash
from tallyward.llm.common import table

from test_text_operators import assert_packed, brute_contamination


def through(spark, docs, folder, last=4):
    for _, stage in corpus_pipeline.STAGES[:last]:
        docs = stage(spark, docs, folder)
    return docs


def without_spaces(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text)


def test_stages_equal_brute_force(spark, sf):
    docs = table(spark, sf, "documents")
    rows = {r.doc_id: r for r in docs.collect()}
    found = language_id.identify(docs, language_id.fit(docs)).collect()
    left = {r.doc_id for r in found if r.lang_pred != "und"}
    assert {r.doc_id for r in through(spark, docs, sf, 1).collect()} == left

    groups = collections.defaultdict(list)
    for i in left:
        groups[without_spaces(rows[i].text)].append(i)
    left = {min(g, key=lambda i: (-len(rows[i].text), i)) for g in groups.values()}
    assert {r.doc_id for r in through(spark, docs, sf, 2).collect()} == left

    ids = sorted(left)
    prints, root = np.array([simhash.fingerprint(rows[i].text) for i in ids], np.uint64), list(range(len(ids)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(len(ids)):
        for b in np.flatnonzero(np.bitwise_count(prints ^ prints[a]) <= 3):
            x, y = sorted((find(a), find(int(b))))
            root[y] = x
    left = {ids[a] for a in range(len(ids)) if find(a) == a}
    assert {r.doc_id for r in through(spark, docs, sf, 3).collect()} == left

    items = [(r.item_id, r.text) for r in table(spark, sf, "benchmark").collect()]
    ids = sorted(left)
    left = {i for i, got in zip(ids, brute_contamination([rows[i].text for i in ids], items)) if not got[-1]}
    kept = through(spark, docs, sf, 4)
    assert {r.doc_id for r in kept.collect()} == left and kept.columns == docs.columns

    assert_packed(corpus_pipeline.run(spark, sf).collect(), {i: rows[i].text for i in left})


def test_awkward_documents(spark, sf, folder):
    rows = [(1, None), (2, ""), (3, "the same text in both"), (4, "the same  text in both"), (4, "the same  text in both"), (None, "another text, quite different words"), (5, "123"), (6, "word " * 30_000)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or ""), "x", True) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, row string, kept boolean")
    os.makedirs(f"{folder}/t")
    docs.write.parquet(f"{folder}/t/documents.parquet")
    table(spark, sf, "benchmark").write.parquet(f"{folder}/t/benchmark.parquet")
    kept = through(spark, table(spark, f"{folder}/t", "documents"), f"{folder}/t").collect()
    assert sorted((r.doc_id or 0) for r in kept) == [0, 4, 6] and set(kept[0].asDict()) == set(docs.columns)
    pieces = corpus_pipeline.run(spark, f"{folder}/t").collect()
    assert {r.doc_id for r in pieces} == {None, 4, 6} and sum(r.length for r in pieces if r.doc_id == 6) == 30_001


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES])
def test_empty_documents(spark, sf, stage):
    assert stage(spark, table(spark, sf, "documents").limit(0), sf).count() == 0


def test_sequences_are_padded_to_the_stated_size():
    assert packing.SEQUENCE == 4096 and [n for n, _ in corpus_pipeline.STAGES][-1] == "pack"


def test_row_numbers_outlast_another_cut_of_the_scan(spark, folder):
    """The numbers that a stage's operator saw are those that its rows are picked by, however the files are packed by then."""
    for part in range(6):
        rows = [(i, f"text {i // 2} of these documents", "en", "s", 20) for i in range(part * 10, part * 10 + 10)]
        spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.mode("append").parquet(folder)
    names = ["spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum"]
    try:
        spark.conf.set(names[0], "0")
        spark.conf.set(names[1], "1")
        kept = corpus_pipeline.drop_copies(spark, spark.read.parquet(folder), folder)
        spark.conf.set(names[1], "6")
        texts = [r.text for r in kept.collect()]
    finally:
        for name in names:
            spark.conf.unset(name)
    assert len(texts) == 30 and len(set(texts)) == 30


def test_near_copies_of_awkward_rows(spark):
    long = " ".join(f"w{i}" for i in range(400))
    rows = [(0, None), (1, ""), (2, " "), (3, "a b"), (None, "A  b"), (4, "a b c"), (5, long), (6, f"{long} end"), (6, f"{long} end"), (None, "of no id"), (None, "of no id")]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, component_id string")
    assert bin(simhash.fingerprint(long) ^ simhash.fingerprint(f"{long} end")).count("1") <= 3
    kept = corpus_pipeline.drop_near_copies(spark, docs, "")
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [(False, 0), (False, 3), (False, 4), (False, 5), (True, 0)] and kept.columns == docs.columns


def test_benchmark_passages_in_repeated_rows(spark, sf):
    passage = next(r.text for r in table(spark, sf, "benchmark").collect() if len(r.text.split()) > 12)
    rows = [(1, passage), (1, "a clean text of the same id"), (2, "another clean text"), (2, "another clean text"), (None, f"so: {passage}"), (None, None)]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, mark string, hit_id int")
    kept = corpus_pipeline.drop_benchmark(spark, docs, sf)
    assert sorted((str(r.doc_id), str(r.text)) for r in kept.collect()) == sorted([("1", "a clean text of the same id"), ("2", "another clean text"), ("2", "another clean text"), ("None", "None")])
    assert kept.columns == docs.columns
