"""Trie BPE against the tokenizers library: ids, decoded texts and the query's digests."""

from __future__ import annotations

import hashlib
import random

import pytest
from tokenizers import Tokenizer

from ledgerline.llm import bpe_trie, queries
from ledgerline.llm.common import written

PATH = queries.vocabulary()
SF = "/root/testdata/sf0.001"
ODD = "aaabbcdehllooprstuvz  \n\t'.,-0123²½日本語éñßИ “”…  😀🏽\x1c\x85"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def _lists(ids, offsets):
    return [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])]


def test_ids_equal_the_librarys(library):
    rnd = random.Random(3)
    texts = ["".join(rnd.choice(ODD) for _ in range(rnd.randrange(60))) + rnd.choice(["", "<|endoftext|>", "  <|endoftext|>  x"])
             for _ in range(3000)]
    texts += ["a" * n for n in range(200)] + [" " * n for n in range(200)] + ["-" * n for n in range(150)] + ["ab" * n for n in range(80)]
    tokens = [library.decode([i]) for i in range(50257)]
    texts += tokens[::7] + ["".join(rnd.choice(tokens) for _ in range(rnd.randrange(1, 6))) for _ in range(4000)]
    trie = bpe_trie.TrieEncoder(PATH)
    want = [e.ids for e in library.encode_batch_fast(texts, add_special_tokens=False)]
    assert _lists(*trie.encode(texts)) == want
    small = bpe_trie.TrieEncoder(PATH, keep=50)  # forgets its words at every call
    assert [_lists(*small.encode([t]))[0] for t in texts[:300]] == want[:300]


def test_states_of_shared_prefixes_are_computed_once(monkeypatch):
    trie = bpe_trie.TrieEncoder(PATH)
    stem = b"abcdefghijklmnopqrstuvwxyz"
    asked = []
    parted = trie.vocabulary.parted
    monkeypatch.setattr(trie.vocabulary, "parted", lambda *a: asked.append(a) or parted(*a))
    trie.walk([stem])
    alone = len(asked)
    trie.pairs.clear()
    asked.clear()
    out = trie.walk([stem + bytes([c]) for c in range(97, 123)] + [stem])
    assert len(out) == 27 and len(asked) < 3 * alone + 200  # not 27 times as many


def test_vocabularies_that_the_rule_does_not_cover_raise(tmp_path):
    import json

    spec = json.load(open(PATH, encoding="utf-8"))
    spec["added_tokens"][0]["lstrip"] = True
    path = tmp_path / "v.json"
    path.write_text(json.dumps(spec))
    with pytest.raises(ValueError):
        bpe_trie.Vocabulary(str(path))


def test_query_on_edge_rows(spark, library):
    texts = [None, "", "  two  spaces ", "x" * 30_000, "word " * 20_000, "same", "same", "日本 <|endoftext|> é", None]
    rows = [(None if i == 3 else i // 2, t, "n", 1, [7]) for i, t in enumerate(texts)]
    df = written(spark, spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, start int, ids array<int>"), "bpe-edge")
    encoded = bpe_trie.encode(spark, df, PATH)
    got = bpe_trie.decode(spark, encoded, PATH).collect()
    want = [(None if i == 3 else i // 2, library.encode(t or "", add_special_tokens=False).ids) for i, t in enumerate(texts)]
    assert sorted(((r.doc_id, r.ids, r.text) for r in got), key=repr) == sorted(
        ((d, e, library.decode(e, skip_special_tokens=False)) for d, e in want), key=repr)
    assert bpe_trie.digests(bpe_trie.decode(spark, bpe_trie.encode(spark, df.limit(0), PATH), PATH)).collect() == []


def test_decoding_of_ids_that_are_no_text(spark, library):
    rows = [(1, [10, 200, 50256]), (2, []), (3, None), (4, [220, 60000, -1, 262]), (5, [None, 262])]
    got = {r.doc_id: r.text for r in bpe_trie.decode(spark, spark.createDataFrame(rows, "doc_id int, ids array<int>"), PATH).collect()}
    assert got == {1: library.decode([10, 200, 50256], skip_special_tokens=False), 2: "", 3: "", 4: "  the", 5: " the"}


def test_query_equals_the_library(spark, library):
    got = sorted((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.op11_bpe_trie(spark, SF).collect())
    want = []
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want.append((r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert got == sorted(want)
