"""The automaton scan against a plain-Python ranking on edge tables, in one block and in many."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest

from ledgerline.llm import lexical_search as L
from ledgerline.llm.common import written

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def _terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def _ranked(docs, items, top):
    """Rows (item_id, rank, doc_id, score); rows of equal id and score are alike."""
    held = [(d, Counter(_terms(t))) for d, t in docs]
    n = [sum(c.values()) for _, c in held]
    n_docs, total = sum(x > 0 for x in n), sum(n)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item_id, text in items:
        found = []
        for (d, c), own in zip(held, n):
            score = 0
            for t in set(_terms(text)) & set(c):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * (10 + 90 * own * n_docs // total)))
            if score > 0:
                found.append((-score, d is None, d or 0, d))
        out += [(item_id, k + 1, d, -s) for k, (s, _, _, d) in enumerate(sorted(found, key=lambda f: f[:3])[:top])]
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def tables(spark):
    rnd = random.Random(8)
    pool = "alpha Beta GAMMA delta2 épée 日本 x y z9 beta-alpha don't the THE of".split()
    docs = [(i, " ".join(rnd.choice(pool) for _ in range(rnd.randrange(1, 40)))) for i in range(120)]
    docs += [(1, None), (2, ""), (3, " .,- "), (None, "alpha beta gamma"), (None, "alpha beta gamma"), (7, docs[7][1]), (200, docs[9][1]),
             (300, "the of " * 40_000 + "alpha"), (301, "ALPHAbeta alpha_beta alpha\x00beta"), (302, "a b ﻿alpha Ⓐ")]
    items = [(0, "Alpha beta?"), (1, None), (2, ""), (3, "nothing here matches qqq"), (4, "THE the of of"), (4, "日本 épée x"),
             (None, "gamma gamma alpha"), (5, "don't t"), (6, "a b Ⓐ")] + [(10 + i, " ".join(rnd.sample(pool, 4))) for i in range(20)]
    d = spark.createDataFrame([(i, t, "s", 1, 2.0) for i, t in docs], "doc_id long, text string, term string, item int, score double").repartition(5)
    q = spark.createDataFrame([(i, t, 3, 4) for i, t in items], "item_id long, text string, rank int, doc_id int")
    return docs, items, written(spark, d, "lex-docs"), written(spark, q, "lex-items")


def _rows(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=repr)


def test_edge_rows_rank_as_by_brute_force(spark, tables):
    docs, items, d, q = tables
    got = L.search(spark, d, q)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert _rows(got) == _ranked(docs, items, 10)
    assert _rows(L.search(spark, d, q, top=3)) == _ranked(docs, items, 3)


def test_many_blocks_and_small_chunks_change_nothing(spark, tables, monkeypatch):
    docs, items, d, q = tables
    monkeypatch.setattr(L, "TERMS", 9)
    monkeypatch.setattr(L, "ITEMS", 11)
    monkeypatch.setattr(L, "CELLS", 40)
    assert len(list(L.blocks(q))) > 2
    assert all(len(b.terms) <= 9 or len(b.ids) == 1 for b in L.blocks(q))
    assert _rows(L.search(spark, d, q)) == _ranked(docs, items, 10)


def test_empty_tables(spark, tables):
    _, _, d, q = tables
    assert L.search(spark, d.limit(0), q).collect() == []
    assert L.search(spark, d, q.limit(0)).collect() == []


def test_neighbouring_equal_terms_all_count():
    find = L.automaton(["a", "a b", "b"][:1])
    _, _, tf, n = L._counts(find, ["a a  a,A;b a"], 1)
    assert tf.tolist() == [5] and n.tolist() == [6]
