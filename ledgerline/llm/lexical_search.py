"""Ranked lexical search by an Aho-Corasick scan: every item's best documents, without an index of the documents.

Terms are runs of digits, letters and characters beyond ASCII, A-Z lower-cased.  One automaton holds all terms of the items,
each with a space before and after it (a boundary guard: texts get a space for every character that parts terms), and gives
every occurrence in one pass over a text, so the scan costs the length of the text whatever the number of terms.

1. A first scan counts, with partial sums a task, the documents and terms in all (N, L) and each item term's documents (df).
2. The driver makes the terms' weights of these (one number a term of the block).
3. A second scan counts each document's tf, multiplies the sparse (document, term) scores with the (term, item)
   incidence and keeps a task's best ``top`` of each item; two windows, dealt by (item, part) and by item, rank these.

Items are taken in blocks of at most ITEMS rows, TERMS distinct terms and INCIDENCES term-item pairs (an item of more is a
block of its own), so the automaton and what else is broadcast have a bound; more items mean more scans.

Defined cases: null and empty texts, and texts without terms, hold no term and rank nowhere; an item without terms, or whose
terms no document has, gets no rows.  Texts of any length are scanned whole.  Equal scores rank by ascending doc_id, null
last; rows of equal id and score both count, in any order.  Item rows of equal id are ranked apart.  Empty tables give no rows.
Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import only_state, release_memory, written
from ledgerline.llm.tokens import slices
from ledgerline.llm.words import NOT_ALNUM

ITEMS, TERMS, INCIDENCES = 10_000, 50_000, 500_000
CELLS = 2_000_000  # scores (documents x items) held at once
PARTS = 32

_TABLE = bytes(32 if NOT_ALNUM[b] else b + 32 * (65 <= b < 91) for b in range(256))


def spaced(text: str) -> str:
    """The text's UTF-8 bytes as characters, lower case, a space for each that parts terms, and one at both ends."""
    return " " + text.encode("utf-8", "surrogatepass").translate(_TABLE).decode("latin-1") + " "


def term_count(held: str) -> int:
    raw = np.frombuffer(held.encode("latin-1"), np.uint8) != 32
    return int(np.count_nonzero(raw[1:] & ~raw[:-1]))


class Block:
    """Items with their terms; picklable, the automaton is built where it is used."""

    def __init__(self):
        self.ids: list = []
        self.terms: dict[str, int] = {}
        self.pairs: list[tuple[int, int]] = []  # (term, item)

    def fits(self, terms: set[str]) -> bool:
        new = sum(t not in self.terms for t in terms)
        return not self.ids or (len(self.ids) < ITEMS and len(self.terms) + new <= TERMS and len(self.pairs) + len(terms) <= INCIDENCES)

    def add(self, item_id, terms: set[str]) -> None:
        for t in sorted(terms):
            self.pairs.append((self.terms.setdefault(t, len(self.terms)), len(self.ids)))
        self.ids.append(item_id)

    def packed(self) -> dict:
        pairs = np.array(sorted(self.pairs), np.int64).reshape(-1, 2)
        first = np.searchsorted(pairs[:, 0], np.arange(len(self.terms) + 1))
        return {"terms": list(self.terms), "first": first, "items": pairs[:, 1], "n_items": len(self.ids)}


def blocks(items: DataFrame) -> Iterator[Block]:
    """Blocks of items with at least one term; the driver holds one block."""
    block = Block()
    for r in items.select(F.col("item_id"), F.col("text").cast("string").alias("text")).toLocalIterator():
        terms = set(spaced(r["text"] or "").split(" ")) - {""}
        if not terms:
            continue
        if not block.fits(terms):
            yield block
            block = Block()
        block.add(r["item_id"], terms)
    if block.ids:
        yield block


def automaton(terms: list[str]):
    import ahocorasick

    found = ahocorasick.Automaton()
    for i, t in enumerate(terms):
        found.add_word(f" {t} ", i)
    found.make_automaton()
    return found


def _counts(find, texts: list[str], n_terms: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, term, tf) of the item terms in the texts, and every text's number of terms."""
    keys, n = [], np.zeros(len(texts), np.int64)
    for d, text in enumerate(texts):
        held = spaced(text)
        n[d] = term_count(held)
        if n[d]:
            keys.append(np.fromiter((t for _, t in find.iter(held)), np.int64) + d * n_terms)
    key, tf = np.unique(np.concatenate(keys) if keys else np.empty(0, np.int64), return_counts=True)
    return key // n_terms, key % n_terms, tf.astype(np.int64), n


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[str]]]:
    for batch in batches:
        texts = [t or "" for t in batch.column(1).to_pylist()]
        for a, b in slices(texts):
            yield batch.column(0).slice(a, b - a), texts[a:b]


def corpus_counts(docs: DataFrame, held) -> tuple[int, int, np.ndarray]:
    """(N, L, df of the block's terms)."""
    def run(batches):
        only_state()
        try:
            data = held.value
            find, df, total = automaton(data["terms"]), np.zeros(len(data["terms"]), np.int64), np.zeros(2, np.int64)
            for _, texts in _texts(batches):
                _, term, _, n = _counts(find, texts, len(df))
                df += np.bincount(term, minlength=len(df))
                total += (np.count_nonzero(n), n.sum())
            seen = np.flatnonzero(df)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([[-2, -1], seen]), pa.int32()),
                                              pa.array(np.concatenate([total, df[seen]]), pa.int64())], ["term", "n"])
        finally:
            release_memory()

    rows = docs.mapInArrow(run, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    found = {r["term"]: r["n"] for r in rows}
    df = np.array([found.get(i, 0) for i in range(len(held.value["terms"]))], np.int64)
    return found.get(-2, 0), found.get(-1, 0), df


class _Best:
    """The best rows of each item so far, sorted by item, falling score, ascending document (null last)."""

    def __init__(self, n_items: int, top: int):
        self.top = top
        self.bar = np.ones(n_items, np.int64)  # the least score that can still enter
        self.rows = [np.empty(0, np.int64) for _ in range(4)]  # item, score, null, doc

    def add(self, item, score, null, doc) -> None:
        rows = [np.concatenate(p) for p in zip(self.rows, (item, score, null, doc))]
        order = np.lexsort((rows[3], rows[2], -rows[1], rows[0]))
        rows = [x[order] for x in rows]
        rank = np.arange(len(order)) - np.searchsorted(rows[0], rows[0])
        self.rows = [x[rank < self.top] for x in rows]
        last = rank == self.top - 1
        self.bar[rows[0][last]] = rows[1][last]


def _scan(held, top: int, n_docs: int, n_terms: int):
    def run(batches):
        only_state()
        try:
            data = held.value
            find, weight, first, items, width = automaton(data["terms"]), data["weight"], data["first"], data["items"], data["n_items"]
            best, deep = _Best(width, top), max(1, CELLS // width)
            for ids, texts in _texts(batches):
                null = np.asarray(ids.is_null()).astype(np.int64)
                docs = ids.fill_null(0).to_numpy(zero_copy_only=False)
                doc, term, tf, n = _counts(find, texts, len(weight))
                m = np.array([10 + 90 * int(x) * n_docs // n_terms for x in n], np.int64)
                part = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc]))
                for a in range(0, len(texts), deep):
                    lo, hi = np.searchsorted(doc, (a, a + deep))
                    size = first[term[lo:hi] + 1] - first[term[lo:hi]]
                    edge = np.cumsum(size) - size
                    at = np.repeat(first[term[lo:hi]] - edge, size) + np.arange(size.sum())
                    score = np.zeros(min(deep, len(texts) - a) * width, np.int64)
                    np.add.at(score, np.repeat((doc[lo:hi] - a) * width, size) + items[at], np.repeat(part[lo:hi], size))
                    score = score.reshape(-1, width)
                    d, i = np.nonzero(score >= best.bar)
                    if len(d):
                        best.add(i, score[d, i], null[a + d], docs[a + d])
            item, score, null, doc = best.rows
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(doc, pa.int64(), mask=null.astype(bool)),
                                              pa.array(score, pa.int64())], ["item", "doc_id", "score"])
        finally:
            release_memory()

    return run


def search(spark: SparkSession, docs: DataFrame, items: DataFrame, top: int = 10) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` best documents of each item with a score above 0."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    kind = items.schema["item_id"].dataType.simpleString()
    out = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    for k, block in enumerate(blocks(items)):
        data = block.packed()
        held = spark.sparkContext.broadcast(data)
        n_docs, n_terms, df = corpus_counts(docs, held)
        held.destroy()
        data["weight"] = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], np.int64)
        held = spark.sparkContext.broadcast(data)
        found = docs.mapInArrow(_scan(held, top, n_docs, max(n_terms, 1)), "item int, doc_id long, score long")
        order = (F.col("score").desc(), F.col("doc_id").asc_nulls_last())
        found = found.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(PARTS)))
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy("item", "part").orderBy(*order))).filter(F.col("rank") <= top)
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).filter(F.col("rank") <= top)
        found = written(spark, found.select("item", "rank", "doc_id", "score"), "search")
        held.destroy()
        names = spark.createDataFrame(list(enumerate(block.ids)), f"item int, item_id {kind}")
        found = found.join(names, "item").select("item_id", "rank", "doc_id", "score")
        out = found if k == 0 else out.unionByName(found)
    return out

