"""The training-data operators on hand-made edge tables, against plain-Python versions or exact round trips."""

from __future__ import annotations

import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from ledgerline.llm import (
    decontamination, exact_dedup, language_model, license_scan, ngram_join, packing, quality, queries, token_files,
    toxicity, warc,
)
from ledgerline.llm.common import written
from tests.llm import brute

SF = "/root/testdata/sf0.001"
VOCABULARY = queries.vocabulary()


def _texts() -> list[tuple]:
    """(doc_id, text): nulls, empties, repeated rows, ties, near copies, a very long text, licence lines, odd characters."""
    rnd = random.Random(4)
    base = " ".join(rnd.choice("alpha beta gamma delta epsilon zeta eta theta iota".split()) + str(rnd.randrange(40)) for _ in range(120))
    near = base.split()
    near[60] = "changed"
    far = base.split()
    far[::9] = ["other"] * len(far[::9])
    item = "One two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen."
    long = " ".join(f"w{rnd.randrange(5000)}" for _ in range(60_000))
    rows = [
        (1, base), (2, base.upper()), (3, " ".join(near)), (4, " ".join(far)), (5, None), (6, ""), (7, " \t\n "),
        (8, "one two"), (9, "One  TWO"), (10, "a"), (11, long), (12, long + " tail"), (13, base), (13, base), (14, "dup id"),
        (14, "another text of the same id"), (None, "no id at all"), (None, base), (15, "intro words here " + item + " and more after"),
        (16, item.replace("seven", "six-and-a-half")), (17, "ÀÉ İstanbul ß ǅ CAFÉ"), (18, "àé istanbul ß ǆ café"),
        (19, "Licensed under CC BY-NC 4.0. All rights reserved. cc by cc by general public license"),
        (20, "x" * 70_000), (21, "don't we'll  x\n\n y\t z ²³ 日本 <|endoftext|> é"), (22, "released under the the mit license"),
        (23, "you are an i.d.i.o.t and a m o r o n"),
    ]
    return rows + [(100 + i, " ".join(f"v{i}{j % 7}" for j in range(rnd.randrange(1, 9)))) for i in range(30)]


ROWS = _texts()


@pytest.fixture(scope="module")
def docs(spark):
    rows = [Row(doc_id=d, text=t, lang="en", source="s", n_chars=len(t or ""), score="x", kept=1, row=2, key="k", block=3,
                sequence_id="q", component=0, n_shingles=9, start=5, n=6, node=7, _id=8, bucket="b", sha="h") for d, t in ROWS]
    schema = ("doc_id long, text string, lang string, source string, n_chars long, score string, kept int, row int, key string, block int, "
              "sequence_id string, component int, n_shingles int, start int, n int, node int, _id int, bucket string, sha string")
    return written(spark, spark.createDataFrame(rows, schema).repartition(3), "edge-docs")


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


LABELS = "doc_id long, quality int, toxic int"


def _sorted(rows):
    return sorted(rows, key=repr)


def test_packing_plan_equals_its_rules():
    rnd = random.Random(1)
    for _ in range(200):
        cap = rnd.choice([10, 64, 1024])
        lengths = [rnd.choice([rnd.randint(1, cap), cap, max(1, cap // rnd.randint(1, 9))]) for _ in range(rnd.choice([0, 1, 5, 200]))]
        histogram = {n: lengths.count(n) for n in set(lengths)}
        runs, bins = packing.plan(histogram, cap)
        held: dict[int, list] = {}
        for n, count in histogram.items():
            own = sorted(r for r in runs if r[0] == n)
            for rank in range(count):
                _, first, per, b, offset = [r for r in own if r[1] <= rank][-1]
                held.setdefault(b + (rank - first) // per, []).append((offset + (rank - first) % per * n, n))
        assert sorted(held) == list(range(bins))
        gaps = []
        for placed in held.values():
            edge = 0
            for offset, n in sorted(placed):
                assert offset == edge
                edge += n
            assert edge <= cap and sum(3 * n > cap for _, n in placed) <= 2
            gaps.append(cap - edge)
        if gaps:  # at most one bin can be so empty that its pieces fit elsewhere
            smallest = min(lengths)
            assert sum(cap - g <= cap // 2 and 3 * smallest <= cap for g in gaps) <= max(1, sum(3 * n > cap for n in lengths))


def test_op1_pieces_and_places(spark, docs):
    got = packing.pack(spark, docs, VOCABULARY).collect()
    ids = brute.ids_of([t for _, t in ROWS], 2, VOCABULARY)
    want = []
    for (doc, _), own in zip(ROWS, ids):
        first = len(own) % 1024 or 1024
        edges = [0, *range(first, len(own) + 1, 1024)]
        want += [(doc, k, a, b - a, brute.crc(own[a:b])) for k, (a, b) in enumerate(zip(edges, edges[1:]))]
    assert _sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == _sorted(want)
    bins: dict[int, list] = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for placed in bins.values():
        edge = 0
        for offset, n in sorted(placed):
            assert offset == edge
            edge += n
        assert edge <= 1024
    total = sum(r.length for r in got)
    assert len(bins) <= -(-total // 1024) + 2


def test_op1_sequences_hold_the_ids(spark, docs):
    found = written(spark, packing.pieces(docs.filter("doc_id < 20"), VOCABULARY), "pieces")
    placed = packing.place(spark, found)
    held = {r.sequence_id: r for r in packing.sequences(placed).collect()}
    for r in placed.collect():
        s = held[r.sequence_id]
        assert bytes(s.ids)[4 * r.offset : 4 * (r.offset + r.length)] == bytes(r.ids)


def test_op2_archive_round_trip(spark):
    page = "<p>" + "long page " * 30 + "</p>"
    rows = [(5, "https://News.Example.org:8080/a b?x#y", page), (3, "http://example.org/", page), (9, "http://example.org/", page),
            (4, None, None), (1, "", ""), (2, "not a url\n", "short"), (6, "http://example.org/", "short"), (7, "HTTP://u@EXAMPLE.org", "é" * 60),
            (8, "http://b.example.org/", "é" * 60), (None, "http://n.org/", page)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, digest string")
    captures = warc.write_archive(spark, pages)
    manifest = warc.build_index(spark, captures, per_block=2)
    got = warc.read_records(spark, warc.lookup(spark, manifest, pages.select("url"))).collect()
    import hashlib

    want = []
    for i, _, html in rows:
        raw = (html or "").encode()
        same = [j for j, _, h in rows if (h or "").encode() == raw and j is not None]
        first = min(same, default=None)
        again = len(raw) >= 100 and i != first
        want.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", first if again else None))
    assert _sorted(map(tuple, got)) == _sorted(want)
    some = warc.lookup(spark, manifest, spark.createDataFrame([("http://EXAMPLE.org/",), ("http://nowhere.org/",)], "url string")).collect()
    assert sorted(r.page_id for r in some) == [3, 6, 9]
    empty = pages.limit(0)
    assert warc.lookup(spark, warc.build_index(spark, warc.write_archive(spark, empty)), empty.select("url")).count() == 0


def _by_doc(rows):
    out: dict = {}
    for r in rows:
        out.setdefault(r[0], []).append(r)
    return {k: sorted(v, key=repr) for k, v in out.items()}


def _want_components(rows):
    ordered = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    texts = [t for _, t in ordered]
    roots = brute.components(texts)
    return [(d, len(brute.shingles(t)), ordered[r][0] if brute.shingles(t) else d) for (d, t), r in zip(ordered, roots)]


def test_op3_components(spark, docs):
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.join(spark, docs).collect()]
    assert _sorted(got) == _sorted(_want_components(ROWS))


@pytest.mark.parametrize("heavy,block", [(8, 6), (7, 6), (32, 128)])
def test_op3_heavy_grams_and_large_blocks(spark, monkeypatch, heavy, block):
    """Many variants of one text, many texts with one passage: every gram of theirs is met by pivots."""
    rnd = random.Random(8)
    base = [f"w{rnd.randrange(60)}" for _ in range(60)]
    rows = []
    for i in range(240):
        own = list(base)
        for _ in range(rnd.randrange(1, 6)):
            own[rnd.randrange(60)] = f"x{rnd.randrange(1000)}"
        rows.append((i, " ".join(own)))
    passage = " ".join(f"p{j}" for j in range(12))
    rows += [(1000 + i, " ".join(f"q{rnd.randrange(400)}" for _ in range(rnd.randrange(0, 6))) + " " + passage) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    monkeypatch.setattr(ngram_join, "HEAVY", heavy)
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.join(spark, docs).collect()]
    assert _sorted(got) == _sorted(_want_components(rows))


def test_op3_keeps_one_of_each_group(spark, docs):
    stay = [r.doc_id for r in ngram_join.keep_one(spark, docs).collect()]
    want, seen = [], set()
    for d, n, c in sorted(_want_components(ROWS), key=lambda r: (r[0] is None, r[0] or 0)):
        if n == 0:
            want.append(d)
        elif (c, "c") not in seen and d == c:
            seen.add((c, "c"))
            want.append(d)
        elif c != d and d == 14:
            pass
    # id 14 names two texts that are components of their own, and so does the missing id
    assert sorted(x for x in stay if x not in (None, 14)) == sorted(x for x in want if x not in (None, 14))
    assert stay.count(14) == 2 and stay.count(None) == 1


def test_op5_round_trip_and_random_access(spark, docs):
    manifest = token_files.write_shards(spark, docs, VOCABULARY, per_block=64)
    got = token_files.read_documents(spark, manifest).orderBy("start").collect()
    ids = brute.ids_of([t for _, t in ROWS], 0, VOCABULARY)
    assert _sorted((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == _sorted((d, len(x), brute.crc(x)) for (d, _), x in zip(ROWS, ids))
    edge = 0
    for r in got:
        assert r.start == edge
        edge += r.n_tokens
    order = [r.doc_id for r in got]
    assert order == sorted(order, key=lambda d: (d is not None, d or 0))
    for m in manifest.collect():
        reader = token_files.ShardReader(m.uri)
        for i in (0, len(reader.doc_ids) - 1):
            own = reader.document(i)
            assert own[-1] == 0 and len(own) == reader.starts[i + 1] - reader.starts[i]


def test_bit_packing_of_every_width():
    rng = np.random.default_rng(3)
    for bits in range(1, 33):
        ids = rng.integers(0, 2**bits, 1001, dtype=np.uint64).astype(np.uint32)
        raw = token_files.pack_bits(ids, bits)
        assert len(raw) == -(-1001 * bits // 8) and (token_files.unpack_bits(raw, bits, 1001) == ids).all()


@pytest.mark.parametrize("capacity", [8192, 2])
def test_op6_exact_copies(spark, docs, capacity):
    got = exact_dedup.dedup_index(spark, docs, capacity).collect()
    groups: dict = {}
    for d, t in ROWS:
        groups.setdefault(brute.sha(t), []).append(d)
    want = []
    for h, ids in groups.items():
        keep = max((d for d in ids if d is not None), default=None)
        left = True
        for d in ids:
            want.append((d, keep, len(ids), d == keep and left, h))
            left = left and d != keep
    assert _sorted((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got) == _sorted(want)
    stay = exact_dedup.keep_one(spark, docs, capacity)
    assert stay.columns == docs.columns and _sorted(r.doc_id for r in stay.collect()) == _sorted(w[0] for w in want if w[3])


def test_op7_counts_and_base(spark, docs):
    got = language_model.score(spark, docs).collect()
    want = brute.unigram_base(ROWS)
    key = lambda r: (repr(r[0]), r[1:5], round(r[5], 5))
    a = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got), key=key)
    b = sorted(((d, *w) for (d, _), w in zip(ROWS, want)), key=key)
    assert [x[:5] for x in a] == [x[:5] for x in b]
    assert all(math.isclose(x[5], y[5], rel_tol=1e-9, abs_tol=1e-6) for x, y in zip(a, b))
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)


def test_op7_is_a_distribution_and_beats_the_unigram_base(spark):
    got = language_model.score(spark, spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).filter("held_out").agg(
        F.sum("score"), F.sum("base_score")).first()
    assert got[0] > got[1]
    rng = np.random.default_rng(5)
    m = language_model.Model(100, 10, np.ones((2, language_model.TAILS), np.int64), np.arange(10, dtype=np.uint64),
                             np.full(10, 10), np.zeros(10, np.uint8))
    m.weights = rng.standard_normal(m.weights.shape).astype(np.float32)
    rows = tuple(np.zeros(language_model.CLASSES, np.int32) + i * language_model.ROWS for i in range(3))
    assert math.isclose((10 ** m.log_classes(rows, np.arange(language_model.CLASSES))).sum(), 1.0, rel_tol=1e-5)


def test_op8_leaks(spark, docs):
    items = [(1, "One two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen."), (2, "one two"), (3, None),
             (4, " "), (5, "a a a a a a a a"), (1, "One two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen.")]
    extra = [(200, "x a a a a a a a a y"), (201, "a a a a a a"), (202, "zero " * 40 + "one two three four five six seven eight nine ten eleven twelve thirteen fourteen")]
    benchmark = spark.createDataFrame([(*i, 0) for i in items], "item_id long, text string, n_words int")
    more = docs.select("doc_id", "text", "score").unionByName(spark.createDataFrame([(*e, "s") for e in extra], "doc_id long, text string, score string"))
    got = {(r.doc_id, r.item_id): r.similarity for r in decontamination.leaks(spark, more, benchmark).collect()}
    want = {}
    for d, t in ROWS + extra:
        for i, item in items:
            s = brute.leaks(t, item)
            if s >= 0.75:
                want[d, i] = max(s, want.get((d, i), 0))
    assert got.keys() == want.keys() and all(math.isclose(got[k], want[k]) for k in want)
    stay = decontamination.clean(spark, docs, benchmark)
    assert stay.columns == docs.columns
    assert _sorted(r.doc_id for r in stay.select("doc_id").collect()) == _sorted(
        d for d, t in ROWS if all(brute.leaks(t, i) < 0.75 for _, i in items))
    assert decontamination.leaks(spark, docs, benchmark.limit(0)).count() == 0


def test_op8_moved_parts(spark):
    """Items whose halves are swapped, at the start, inside and at the end of texts, and whole texts shorter than the item."""
    rnd = random.Random(12)
    word = lambda k: [f"w{rnd.randrange(10**6)}" for _ in range(k)]
    items = [(i, word(rnd.choice([12, 20, 39, 59]))) for i in range(12)] + [(12, ["a", "b"] * 20)]
    rows = []
    for i, q in items:
        h = len(q) // 2
        turned, cut = q[h:] + q[:h], [*q[: len(q) - 2], "changed", q[-1]]
        rows += [(len(rows) + j, " ".join(t)) for j, t in enumerate((
            word(30) + turned + word(30), turned, word(30) + turned, turned + word(30), word(9) + cut + word(9), q[1:], word(9) + q + word(2) + q))]
    benchmark = spark.createDataFrame([(i, " ".join(q)) for i, q in items], "item_id long, text string")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.item_id): (r.similarity, r.first_word) for r in decontamination.leaks(spark, docs, benchmark).collect()}
    want = {(d, i): s for d, t in rows for i, q in items if (s := brute.leaks(t, " ".join(q))) >= 0.75}
    assert len(want) > 50 and got.keys() == want.keys() and all(math.isclose(got[k][0], want[k]) for k in want)
    assert {got[7 * i + j, i][1] for i in range(12) for j in (4, 6) if (7 * i + j, i) in got} == {9}


def test_op10_phrases_and_notices(spark, docs):
    got = [(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in license_scan.scan(spark, docs).collect()]
    assert _sorted(got) == _sorted((d, *brute.phrases(t)) for d, t in ROWS)
    labels = {r.doc_id: r.labels for r in license_scan.scan(spark, docs).collect()}
    assert labels[19] == "cc-by,cc-by-nc-4.0,gpl,reserved" and labels[22] == "mit" and labels[1] == ""


def test_op10_notices_with_words_between(spark):
    rows = [(i, f"licensed under {put} the gnu {name} general public license", label) for i, (put, name, label) in enumerate(
        [("", "lesser", "lgpl"), ("the terms and conditions of", "lesser", "lgpl"), ("the terms and conditions of", "affero", "agpl")])]
    rows.append((9, "licensed under a b c d e f g h i j k l m n o p q r s t u v w x y z general public license", ""))
    got = {r.doc_id: r.labels for r in license_scan.scan(spark, spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")).collect()}
    assert all((label or "lgpl") in got[i].split(",") if label else "lgpl" not in got[i] for i, _, label in rows)


def test_classifiers_on_edge_tables(spark, docs, empty):
    labels = spark.createDataFrame([(d, 0 if "v" in (t or "") else 1, int(d == 23)) for d, t in ROWS if d is not None and d != 8]
                                   + [(8, None, None), (9, 2, 7)], LABELS)
    for op, cut in ((toxicity, 0.5), (quality, 0.3)):
        got = op.score_documents(spark, docs, labels).collect()
        assert len(got) == len(ROWS) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= cut) for r in got)
        for known in (labels.limit(0), labels.filter("toxic = 0 AND quality = 1")):
            got = op.score_documents(spark, docs, known).collect()
            assert len(got) == len(ROWS) and len({r.score for r in got}) == 1
        assert op.score_documents(spark, empty, labels).count() == 0


def _auc(score, label) -> float:
    order = np.argsort(np.argsort(score))
    pos = label.sum()
    return (order[label].sum() - pos * (pos - 1) / 2) / (pos * (len(label) - pos))


@pytest.mark.parametrize("name,label,least", [("op4_quality", "quality", 0.98), ("op9_toxicity", "toxic", 0.9)])
def test_classifiers_on_held_out_rows(spark, name, label, least):
    sf = "/root/testdata/sf0.1"
    known = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", label)
    rows = queries.QUERIES[name](spark, sf).join(known, "doc_id").filter("held_out").toPandas()
    assert len(rows) > 500 and _auc(rows["score"].to_numpy(), rows[label].to_numpy() == 1) >= least


def test_string_kernel_tolerates_gaps():
    def row(word):
        out = np.zeros((1, toxicity.WIDTH), np.int16)
        out[0, : len(word)] = [toxicity._LETTER[b] for b in word.encode()]
        return out

    marks = toxicity.Landmarks(row("pathetic"))

    def kernel(word):
        at, k = marks.kernel(row(word))
        return float(k[0, 0]) if len(at) else 0.0

    assert math.isclose(kernel("pathetic"), 1.0, rel_tol=1e-5) and kernel("pathxetic") > 0.1 > kernel("practical")
    lone = toxicity.split_words([b"a m o r o n x.y.z"])
    assert bytes(lone.letters[lone.start[-1] : lone.start[-1] + lone.size[-1]].astype(np.uint8)) == b"amoron"


@pytest.mark.parametrize("landmark,other,filled", [
    ("moron", "table", ("mxoron", "mxoxron", "moxrxon", "mxoxrxoxn")), ("idiot", "editor", ("idxiot", "idxixot", "ixdxixoxt")),
    ("stupid", "studio", ("stuxpid", "stuxpxid", "sxtxuxpxixd"))])
def test_string_kernel_with_letters_in_several_gaps(landmark, other, filled):
    def row(word):
        return np.array([[toxicity._LETTER[b] for b in word.encode().ljust(toxicity.WIDTH, b".")]], np.int16)

    marks = toxicity.Landmarks(row(landmark))
    values = []
    for word in (*filled, other):
        at, k = marks.kernel(row(word))
        values.append(float(k[0, 0]) if len(at) else 0.0)
    one, *more, far = values
    assert one > max(more) and min(more) > 0.05 and min(more) > far


def test_spaced_words_at_the_edges_of_texts():
    texts = [b"some words a b c", b"i d i o t here", b"m o r", b"", b"x y", b"z w"]

    def spaced(batch):
        w = toxicity.split_words(batch)
        found = [(int(t), bytes(w.letters[a : a + n].astype(np.uint8))) for t, a, n in zip(w.text, w.start, w.size) if n > 1]
        return [x for t, x in sorted(found) if x not in (b"some", b"words", b"here")]

    assert spaced(texts) == [b"abc", b"idiot", b"mor"] == [x for t in texts for x in spaced([t])]


def test_empty_tables(spark, empty):
    assert packing.pack(spark, empty, VOCABULARY).count() == 0
    assert ngram_join.join(spark, empty).count() == 0
    assert token_files.read_documents(spark, token_files.write_shards(spark, empty, VOCABULARY)).count() == 0
    assert exact_dedup.dedup_index(spark, empty).count() == 0 and exact_dedup.keep_one(spark, empty).columns == empty.columns
    assert language_model.score(spark, empty).count() == 0
    assert license_scan.scan(spark, empty).count() == 0
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    assert decontamination.leaks(spark, empty, benchmark).count() == 0


def test_op6_groups_stay_apart_when_all_keys_collide(spark, docs, monkeypatch):
    want = sorted(((r.doc_id is None, r.doc_id or 0, r.group_size, r.kept, r.text_sha256) for r in exact_dedup.dedup_index(spark, docs).collect()))
    keyed = exact_dedup._keyed
    monkeypatch.setattr(exact_dedup, "_keyed", lambda d: keyed(d).withColumn("key", F.lit(7).cast("long")))
    got = exact_dedup.dedup_index(spark, docs, 4)
    assert sorted(((r.doc_id is None, r.doc_id or 0, r.group_size, r.kept, r.text_sha256) for r in got.collect())) == want
    assert got.select("bucket").distinct().count() == 1 and got.select("chain").distinct().count() == len({w[4] for w in want})


def test_op6_answers_from_its_index(spark, docs, monkeypatch):
    whole = exact_dedup.dedup_index(spark, docs, 4).collect()
    bucket = whole[0].bucket
    build = exact_dedup.build_index

    def without(*args):
        index, slots, depth = build(*args)
        return index.filter(F.col("bucket") != bucket), slots, depth

    monkeypatch.setattr(exact_dedup, "build_index", without)
    assert exact_dedup.dedup_index(spark, docs, 4).count() == sum(r.bucket != bucket for r in whole) < len(whole)

    def misled(*args):
        index, slots, depth = build(*args)
        return index, slots.withColumn("bucket", F.lit(bucket)), depth

    monkeypatch.setattr(exact_dedup, "build_index", misled)
    assert exact_dedup.dedup_index(spark, docs, 4).count() == sum(r.bucket == bucket for r in whole)


def test_word_hashes_of_pieces_of_a_long_text(monkeypatch):
    from ledgerline.llm import words

    text = b" ".join(b"w%d" % (i % 977) for i in range(5000)) + b" " + b"z" * 3000 + b" end"
    whole, at = words.word_hashes([b"a b", text, b""], words.WHITE)
    monkeypatch.setattr(words, "STEP", 500)
    cut, at2 = words.word_hashes([b"a b", text, b""], words.WHITE)
    assert (whole == cut).all() and (at == at2).all() and len(whole) == 5004


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_oracle(spark, name):
    from tools.check_oracles import rows_of

    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF)
    cur = con.execute(queries.ORACLES[name])
    names = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(names)
    assert rows_of(df.columns, df.collect()) == rows_of(names, cur.fetchall())


@pytest.mark.parametrize("name", ["op6_exact_dedup", "op8_decontamination"])
def test_native_plans_hold_no_python(spark, name):
    plan = queries.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "MapInPandas", "MapInArrow", "Cartesian"))
