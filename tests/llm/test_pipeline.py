"""The corpus pipeline against plain-Python versions of its stages."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerline.llm import queries, toxicity
from ledgerline.llm.common import written
from tests.llm import brute

SF = "/root/testdata/sf0.001"


def _clean(texts, items):
    grams = [(brute.shingles(i), i) for i in items]
    out = []
    for t in texts:
        own = brute.shingles(t)
        out.append(not any(own & g and brute.leaks(t, i) >= 0.75 for g, i in grams))
    return out


def _expected(rows, items):
    """(doc_id, text) that stay after exact copies, near copies and leaks."""
    last = {}
    for d, t in rows:
        h = brute.sha(t)
        if h not in last or d > last[h][0]:
            last[h] = (d, t)
    rows = sorted(last.values())
    roots = brute.components([t for _, t in rows])
    rows = [r for i, r in enumerate(rows) if roots[i] == i or not brute.shingles(r[1])]
    keep = _clean([t for _, t in rows], items)
    return [r for r, k in zip(rows, keep) if k]


def test_pipeline_query_equals_its_stages_by_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = toxicity.fitted(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    calm = toxicity.scored(spark, docs, model).filter("score < 0.5").select("doc_id", "text").collect()
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = _expected([(r.doc_id, r.text) for r in calm], items)
    assert 0 < len(want) < len(calm) < docs.count() + 1
    ids = brute.ids_of([t for _, t in want], 2, queries.vocabulary())
    pieces = []
    for (d, _), own in zip(want, ids):
        first = len(own) % 1024 or 1024
        edges = [0, *range(first, len(own) + 1, 1024)]
        pieces += [(d, k, a, b - a, brute.crc(own[a:b])) for k, (a, b) in enumerate(zip(edges, edges[1:]))]
    got = corpus_pipeline.run(spark, SF)
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got.collect()) == sorted(pieces)


@pytest.fixture(scope="module")
def edge(spark):
    rows = [(1, None), (2, ""), (3, None), (4, "one two three"), (4, "one two three"), (5, "ONE two three"), (None, "no id"), (6, "x " * 3000),
            (7, "a b c d e f g h i j k l m n o p q r s t u v w x y z"), (8, "a b c d e f g h i j k l m n o p q r s t u v w x y zz")]
    df = spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    return written(spark, df, "edge-pipeline")


def test_stages_keep_columns_and_defined_rows(spark, edge):
    docs, seen = edge, []
    for name, stage in corpus_pipeline.STAGES:
        out = written(spark, stage(spark, docs, SF), f"test-{name}")
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == edge.columns, name
        seen.append(sorted(((r.doc_id is None, r.doc_id or 0) for r in out.select("doc_id").distinct().collect())))
        docs = out
    # nulls and the empty text are equal, and so are ids 4 and 5; 7 and 8 are near copies
    assert [d for _, d in seen[1]] == [3, 5, 6, 7, 8, 0] and [d for _, d in seen[2]] == [3, 5, 6, 7, 0]
    assert docs.filter("doc_id = 3").count() == 1 and docs.agg(F.max("length")).first()[0] <= 1024


def test_columns_of_clashing_names_pass_the_stages(spark):
    rows = [(1, "calm words of one text", 7, "a", 1.5, True), (2, "other words " * 40_000, None, "b", 2.5, False)]
    docs = written(spark, spark.createDataFrame(rows, "doc_id long, text string, row int, score string, _toxicity_probability double, key boolean"), "clash")
    out = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = written(spark, stage(spark, out, SF), f"clash-{name}")
        assert out.columns == docs.columns, name
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, docs.collect()))


def test_stages_on_an_empty_table(spark, edge):
    docs = edge.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = written(spark, stage(spark, docs, SF), f"empty-{name}")
        assert docs.count() == 0
