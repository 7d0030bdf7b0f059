"""The registered queries and the pipeline on the smallest tables."""

from __future__ import annotations

import collections
import os
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from changefeed.llm import pii, registry

DIRECTORY = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(DIRECTORY), reason="needs the test tables")


@needs_tables
@pytest.mark.parametrize("name", registry.QUERIES)
def test_query(spark, name):
    docs = spark.read.parquet(f"{DIRECTORY}/documents.parquet").count()
    df = registry.QUERIES[name](spark, DIRECTORY)
    rows = df.collect()
    assert "doc_id" in df.columns
    if name in ("op3_suffix_dedup", "op5_packing", "op13_hierarchical_packing"):
        assert rows
    else:
        assert len({r["doc_id"] for r in rows}) == len(rows) == docs


HARD = [(1, None), (2, ""), (2, ""), (3, "few words only"), (None, None)]


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES[:-1])
def test_stage_takes_hard_rows_and_clashing_columns(spark, tmp_path, name, stage):
    spark.createDataFrame([(1, "a b c")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    schema = "doc_id long, text string, n_chars long, rules string, overlap string, row_key string, spans string, place string"
    docs = spark.createDataFrame([(i, t, 1, "r", "o", "k", "s", "p") for i, t in HARD], schema)
    for frame in (docs, docs.limit(0)):
        out = stage(spark, frame, str(tmp_path))
        assert out.columns == docs.columns
        assert all(r["rules"] == "r" and r["spans"] == "s" for r in out.collect())


def test_first_rows_where_texts_share_an_id(spark):
    a, b, c, d = (" ".join(f"{x}{k}" for k in range(30)) for x in "abcd")
    rows = [(1, a), (5, a), (5, b), (5, b), (6, c), (6, d), (None, a), (None, "n " + d[:20]), (None, "n " + d[:20]), (7, ""), (7, ""), (8, b + " end"), (None, None), (None, None), (9, None), (9, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in corpus_pipeline.keep_first(spark, docs, "").collect()]
    want = [(1, a), (5, b), (6, c), (6, d), (None, "n " + d[:20]), (7, ""), (None, None), (None, None), (9, None), (9, "")]
    assert collections.Counter(got) == collections.Counter(want)


def plain_stages(docs, items):
    """docs after deduplication and decontamination, from the definitions."""
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for i, t in docs.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", t.translate(low))
        sets[i] = {tuple(w[j : j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)}
    group = {i: i for i in docs}
    ids = sorted(docs)
    for a in ids:
        for b in ids:
            if b < a and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = group[a], group[b]
                group = {k: min(x, y) if g in (x, y) else g for k, g in group.items()}
    kept = [i for i in ids if group[i] == i]
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    grams = set()
    for t in items:
        w = word.findall(t.translate(low))
        n = min(13, len(w))
        grams |= {tuple(w[j : j + n]) for j in range(len(w) - n + 1)} if w else set()
    sizes = {len(g) for g in grams}
    clean = []
    for i in kept:
        w = word.findall(docs[i].translate(low))
        hit = {k for n in sizes for j in range(len(w) - n + 1) if tuple(w[j : j + n]) in grams for k in range(j, j + n)}
        if not hit or 20 * len(hit) < len(w):
            clean.append(i)
    return kept, clean


@needs_tables
def test_pipeline(spark):
    docs = spark.read.parquet(f"{DIRECTORY}/documents.parquet")
    items = [r["text"] for r in spark.read.parquet(f"{DIRECTORY}/benchmark.parquet").collect()]
    good = corpus_pipeline.keep_good(spark, docs, DIRECTORY)
    texts = {r["doc_id"]: r["text"] for r in good.collect()}
    kept, clean = plain_stages(texts, items)
    first = corpus_pipeline.keep_first(spark, good, DIRECTORY)
    assert sorted(r["doc_id"] for r in first.select("doc_id").collect()) == kept
    left = corpus_pipeline.drop_benchmark(spark, first, DIRECTORY)
    assert sorted(r["doc_id"] for r in left.select("doc_id").collect()) == clean
    hidden = {r["doc_id"]: r for r in corpus_pipeline.hide_personal_data(spark, left, DIRECTORY).collect()}
    assert sorted(hidden) == clean
    for i, r in hidden.items():
        assert not re.search(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+\.[A-Za-z0-9-]+", r["text"])
        assert r["n_chars"] == len(r["text"])
        if "<" not in r["text"]:
            assert r["text"] == texts[i]
    packed = corpus_pipeline.run(spark, DIRECTORY).collect()
    assert {r["doc_id"] for r in packed} == set(clean)
    sums = collections.Counter()
    for r in packed:
        sums[r["sequence_id"]] += r["length"]
    assert max(sums.values()) <= 4096


@needs_tables
def test_pii_of_the_pipeline_is_jvm_only(spark):
    docs = spark.read.parquet(f"{DIRECTORY}/documents.parquet")
    plan = pii.extract(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert pii.extract(docs).where(F.size("base") > 0).count() > 0
