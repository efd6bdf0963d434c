"""The toxicity machine learns from every labelled row outside the held-out fold, of any length and number."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow.parquet as pq
import pytest

from ledgerline.llm import labelled, toxicity
from ledgerline.llm.labelled import logistic, logistic_of, training_rows
from ledgerline.llm.common import BATCH_BYTES, small_batches, written
from pyspark.sql import functions as F

WORDS = "river stone window market paper garden winter letter bridge copper".split()


def _rows(many: int, words: int) -> list[tuple]:
    rnd = random.Random(11)
    out = []
    for d in range(many):
        w = [rnd.choice(WORDS) for _ in range(words)]
        if d % 3 == 0:
            w[rnd.randrange(words)] = "scoundrel"
        out.append((d, ". ".join(" ".join(w[i : i + 8]) for i in range(0, words, 8)), int(d % 3 == 0)))
    return out


def _tables(spark, rows):
    return (spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"),
            spark.createDataFrame([(d, y) for d, _, y in rows], "doc_id long, toxic int"))


def test_long_texts_are_learned_from(spark):
    """Every labelled text has over 20,000 characters; they were left out, and all rows got one score."""
    rows = _rows(30, 3600)
    assert min(len(t) for _, t, _ in rows) > 20_000
    found = toxicity.score_documents(spark, *_tables(spark, rows)).collect()
    assert {r.doc_id: r.predicted for r in found} == {d: y for d, _, y in rows}


def test_every_labelled_row_is_a_training_row(spark):
    rows = _rows(7000, 9)
    train = training_rows(spark, *_tables(spark, rows), "toxic")
    want = [(t, y) for d, t, y in rows if zlib.crc32(str(d).encode()) % 5 != 0]
    assert len(want) > 5000 and Counter((r.text, r.y) for r in train.collect()) == Counter(want)
    counts = {bytes(r.letters): (r.toxic, r.clean) for r in toxicity.word_counts(train).collect()}
    for word in (*WORDS, "scoundrel"):
        own = [y for t, y in want if word in t.replace(".", "").split()]
        assert counts[word.encode()] == (sum(own), len(own) - sum(own)), word


def test_newton_sums_and_curve_equal_plain_ones(spark):
    rng = np.random.default_rng(3)
    k, y = rng.random((40, 5)).astype("<f2"), rng.integers(0, 2, 40)
    half, v, weight = rng.standard_normal((5, 5)), rng.standard_normal(6), {0: 0.7, 1: 1.5}
    parts = [(y[a : a + 8].astype(np.int8).tobytes(), k[a : a + 8].tobytes()) for a in range(0, 40, 8)]
    grad, hess = toxicity.hinge_sums(spark.createDataFrame(parts, "y binary, kernel binary").repartition(3), half, v, weight)
    a = np.column_stack([k.astype(float) @ half, np.ones(40)])
    s, c = np.where(y == 1, 1.0, -1.0), np.where(y == 1, 1.5, 0.7)
    gap = np.maximum(0, 1 - s * (a @ v))
    assert np.allclose(grad, -2 * a.T @ (c * s * gap)) and np.allclose(hess, 2 * (a[gap > 0] * c[gap > 0, None]).T @ a[gap > 0])
    x, y = rng.standard_normal((60, 2)), np.arange(60) % 2
    table = written(spark, spark.createDataFrame([(*map(float, r), int(t)) for r, t in zip(x, y)], "a double, b double, y int"), "curve")
    assert logistic_of(table, ["a", "b"], F.lit(1.0)) == pytest.approx(logistic(x, y), abs=1e-6)


def test_best_sentences_equal_a_plain_choice(spark):
    rng = np.random.default_rng(4)
    k, owner, w = rng.standard_normal((30, 4)).astype("<f2"), np.sort(rng.integers(0, 9, 30)), rng.standard_normal(4).astype(np.float32)
    table = spark.createDataFrame([(bytes(9), owner.astype("<u4").tobytes(), k.tobytes())], "y binary, owner binary, kernel binary")
    got = np.frombuffer(toxicity.best_sentences(spark, table, w).first()["kernel"], "<f2").reshape(9, 4)
    for d in range(9):
        own = [np.zeros(4, "<f2"), *k[owner == d]]
        assert (got[d] == max(own, key=lambda r: float(r.astype(np.float32) @ w))).all()


def test_texts_without_a_label_are_not_shuffled(spark, monkeypatch):
    """Ids are sieved before the join, which is the same at every size; the texts of all rows were shuffled to it."""
    planned = []
    monkeypatch.setattr(labelled, "written", lambda spark, df, *a: planned.append(df) or df)
    docs = spark.createDataFrame([(i % 400 if i else None, f"text {i}") for i in range(800)], "doc_id long, text string")
    known = [(d, int(d % 3 == 0)) for d in range(0, 400, 40)] + [(40, 1), (None, 1), (8, 7), (9999, 1)]
    found = training_rows(spark, docs, spark.createDataFrame(known, "doc_id long, toxic int"), "toxic").collect()
    want = [(f"text {i}", y) for i in range(1, 800) for d, y in known if d == i % 400 and y in (0, 1) and zlib.crc32(str(d).encode()) % 5]
    assert len(want) > 10 and Counter((r.text, r.y) for r in found) == Counter(want)
    plan = planned[0]._jdf.queryExecution().executedPlan().toString()
    texts = plan[plan.index("SortMergeJoin"):]
    assert "BroadcastHashJoin" not in plan and texts.index("Exchange") < texts.index("doubtful")


@pytest.mark.parametrize("keep", [4, 12, 1 << 10])
def test_remembered_vectors_equal_fresh_ones(keep):
    """Words are computed once while they are remembered, also if more than ``keep`` come; each run of texts computed its own."""
    rnd = random.Random(5)
    some = [f"{a[:5]}{b}{c}" for a in WORDS for b in WORDS[:3] for c in ("", "x" * 40)] + ["a", "to"]
    letters = np.array([[toxicity._LETTER[b] for b in w.encode().ljust(toxicity.WIDTH, b".")] for w in ("river", "scoundrel", "aaaa")], np.int16)
    marks = toxicity.Landmarks(letters)
    asked = []
    kernel = marks.kernel
    marks.kernel = lambda rows: asked.append(len(rows)) or kernel(rows)
    vectors = toxicity.WordVectors(marks, keep)
    for _ in range(20):
        words = toxicity.split_words([" ".join(rnd.choices(some, k=30)).encode() for _ in range(3)])
        each, back = vectors.of(words)
        plain = np.zeros((len(words.start), 3), np.float32)
        for row, own in toxicity.windows(words, np.arange(len(words.start))):
            hit, k = kernel(own)
            np.add.at(plain, row[hit], k)
        assert np.allclose(each[back], plain, atol=1e-6) and len(vectors.known) <= keep
        assert (np.diff(vectors.known.astype(object)) > 0).all()
    assert keep < 100 or sum(asked) < 400


def test_large_rows_are_stored_and_read_a_few_at_a_time(spark, monkeypatch):
    """Sentence kernels are rows of about a megabyte; a task held the whole file several times, in the executor and in its worker."""
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    before, seen, paths = spark.conf.get(setting), {}, {}

    def noted(name, run):
        def call(*args):
            seen.setdefault(name or args[2], set()).add(int(spark.conf.get(setting).rstrip("b")))
            out = run(*args)
            paths[name or args[2]] = out.inputFiles() if name is None else []
            return out
        return call

    monkeypatch.setattr(toxicity, "written", noted(None, toxicity.written))
    monkeypatch.setattr(toxicity, "hinge_sums", noted("sums", toxicity.hinge_sums))
    rows = _rows(40, 36000)  # over 9 MB of text, a run a text
    found = toxicity.score_documents(spark, *_tables(spark, rows)).collect()
    assert {r.doc_id: r.predicted for r in found} == {d: y for d, _, y in rows}
    assert set(seen) == {"word-strengths", "sentence-kernels", "best-sentences", "sums", "text-features"}
    assert set.union(*seen.values()) == {BATCH_BYTES} and spark.conf.get(setting) == before
    files = [pq.ParquetFile(p.removeprefix("file://").removeprefix("file:")) for p in paths["sentence-kernels"]]
    assert max(f.metadata.num_rows for f in files) > toxicity.RUNS
    assert max(f.metadata.row_group(i).num_rows for f in files for i in range(f.num_row_groups)) <= toxicity.RUNS


def test_small_batches_hold_few_large_rows_and_end_with_an_error(spark):
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(setting)
    table = written(spark, spark.range(0, 24, 1, 1).select(F.expr("cast(repeat('x', 1000000) as binary)").alias("kernel")), "large-rows")
    sizes = table.coalesce(1).mapInPandas(lambda batches: (pd.DataFrame({"n": [len(b)]}) for b in batches), "n int")
    with pytest.raises(KeyError), small_batches(spark):
        many = [r.n for r in sizes.select("n").collect()]
        raise KeyError
    assert sum(many) == 24 and max(many) <= -(-BATCH_BYTES // 1_000_000) and spark.conf.get(setting) == before
