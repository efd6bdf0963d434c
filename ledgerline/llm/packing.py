"""Best-fit packing of documents into sequences of a fixed number of tokens, by large-item matching.

A document is its token ids and an end id.  Longer ones are cut into pieces of ``capacity`` tokens, the first
piece being the shorter one.  Bins are planned from the histogram of piece lengths (at most ``capacity``
numbers, whatever the size of the corpus):

1. Large pieces (over a third of the capacity) are matched greedily, the longest first, each with the longest
   large piece that still fits: at most two share a bin.
2. Smaller pieces, the longest first, go to the bin with the smallest gap that takes them, or open a bin.

Pieces of equal length are interchangeable, so whole runs of equal bins are planned at once; the plan is the
one that piece-by-piece best fit gives.  It has O(capacity) runs.  Each piece then finds its place from
its rank among the pieces of its length; ranks are counted in hash buckets of the pieces, so no length (the
full pieces may be a third of all) is ever one task's.

Defined cases: null text is empty (its piece is the end id alone); repeated rows are packed each; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ledgerline.llm.common import shuffle_width, text_or_empty, tidied, written
from ledgerline.llm.tokens import encoder, slices

PIECES = "doc_id long, slot long, piece int, start long, length long"


def pieces(docs: DataFrame, vocabulary: str, capacity: int = 1024, end_id: int = 2, with_ids: bool = True) -> DataFrame:
    """One row per piece of each document with its ids (little-endian unsigned 32-bit), or else with their crc32 only."""
    last = "ids" if with_ids else "ids_crc32"
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc, slot = encoder(vocabulary), 0
        for batch in batches:
            texts = batch["text"].tolist()
            for a, b in slices(texts):
                out = []
                for doc, ids in zip(batch["doc_id"].iloc[a:b], enc.ids(texts[a:b])):
                    ids += end
                    n = len(ids) // 4
                    edge = 0
                    for k in range(-(-n // capacity)):
                        to = n - (-(-n // capacity) - 1 - k) * capacity
                        part = ids[4 * edge : 4 * to]
                        out.append((doc, slot, k, edge, to - edge, part if with_ids else zlib.crc32(part)))
                        edge, slot = to, slot + 1
                yield pd.DataFrame(out, columns=["doc_id", "slot", "piece", "start", "length", last]).astype(
                    {"doc_id": "Int64"})

    return docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")).mapInPandas(
        tidied(cut, vocabulary), f"{PIECES}, {last} {'binary' if with_ids else 'long'}")


def plan(histogram: dict[int, int], capacity: int = 1024) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """(runs, number of bins).  A run (length, rank, per_bin, bin, offset) places the pieces of that length from that
    rank on, ``per_bin`` to a bin, side by side from ``offset``, in consecutive bins from ``bin``."""
    left = {s: n for s, n in histogram.items() if n > 0}
    used = dict.fromkeys(left, 0)
    runs: list[tuple[int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap -> runs of bins (first bin, how many)
    order: list[int] = []  # the gaps there are, ascending
    bins = 0

    def put(length: int, per_bin: int, first: int, many: int, gap: int) -> None:
        runs.append((length, used[length], per_bin, first, capacity - gap))
        used[length] += per_bin * many
        left[length] -= per_bin * many
        rest = gap - per_bin * length
        if rest:
            if rest not in gaps:
                gaps[rest] = []
                bisect.insort(order, rest)
            gaps[rest].append((first, many))

    large = sorted(s for s in left if 3 * s > capacity)
    for length in reversed(large):
        while left[length]:
            at = bisect.bisect_right(large, min(capacity - length, length)) - 1
            while at >= 0 and not (left[large[at]] - (large[at] == length) > 0):
                at -= 1
            mate = large[at] if at >= 0 else None
            many = left[length] if mate is None else left[length] // 2 if mate == length else min(left[length], left[mate])
            if mate == length:
                put(length, 2, bins, many, capacity)
            else:
                runs.append((length, used[length], 1, bins, 0))
                used[length] += many
                left[length] -= many
                if mate is not None:
                    put(mate, 1, bins, many, capacity - length)
                elif length < capacity:
                    rest = capacity - length
                    if rest not in gaps:
                        gaps[rest] = []
                        bisect.insort(order, rest)
                    gaps[rest].append((bins, many))
            bins += many
    for length in sorted((s for s in left if 3 * s <= capacity), reverse=True):
        while left[length]:
            at = bisect.bisect_left(order, length)
            if at == len(order):
                first, many, gap = bins, -(-left[length] // (capacity // length)), capacity
                bins += many
            else:
                gap = order[at]
                first, many = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap], order[at]
            fit = gap // length
            whole = min(many, left[length] // fit)
            if whole:
                put(length, fit, first, whole, gap)
            if whole < many:
                rest = left[length]
                if rest:
                    put(length, rest, first + whole, 1, gap)
                    whole += 1
                if whole < many:
                    if gap not in gaps:
                        gaps[gap] = []
                        bisect.insort(order, gap)
                    gaps[gap].append((first + whole, many - whole))
    return runs, bins


def place(spark: SparkSession, found: DataFrame, capacity: int = 1024) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows with ``length`` (1 to capacity) and distinguishing ``doc_id, piece, slot``.

    ``found`` is read three times, so hand in a written table."""
    buckets = shuffle_width(spark)
    rows = found.withColumn("_bucket", F.expr(f"pmod(xxhash64(doc_id, piece, slot), {buckets})"))
    counts = rows.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.withColumn("_before", F.coalesce(F.sum("_n").over(
        W.partitionBy("length").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    inside = F.row_number().over(W.partitionBy("length", "_bucket").orderBy("doc_id", "piece", "slot")) - 1
    ranked = (rows.withColumn("_inside", inside).join(before, ["length", "_bucket"])
              .withColumn("_rank", (F.col("_before") + F.col("_inside")).cast("long")).drop("_bucket", "_before", "_inside"))
    histogram = {r["length"]: r["n"] for r in found.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    runs, _ = plan(histogram, capacity)
    runs.sort()
    at = np.array(runs, np.int64).reshape(-1, 5)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema if f.name != "_rank")

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key = at[:, 0] * (1 << 50) + at[:, 1]
        for batch in batches:
            length, rank = batch["length"].to_numpy(np.int64), batch.pop("_rank").to_numpy(np.int64)
            run = at[np.searchsorted(key, length * (1 << 50) + rank, side="right") - 1]
            nth = rank - run[:, 1]
            yield batch.assign(sequence_id=run[:, 3] + nth // run[:, 2], offset=run[:, 4] + nth % run[:, 2] * length)

    return ranked.mapInPandas(assign, f"{fields}, sequence_id long, offset long")


def sequences(placed: DataFrame) -> DataFrame:
    """The packed sequences themselves: sequence_id, ids (binary) and the documents inside, from placed pieces with ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "piece", "ids")))
    return placed.groupBy("sequence_id").agg(parts.alias("p")).select(
        "sequence_id", F.col("p.doc_id").alias("doc_ids"), F.col("p.offset").alias("offsets"),
        F.expr("unhex(array_join(transform(p, x -> hex(x.ids)), ''))").alias("ids"))


def pack(spark: SparkSession, docs: DataFrame, vocabulary: str, capacity: int = 1024, end_id: int = 2) -> DataFrame:
    """Pieces of all documents with their places; the ids stand in the rows as their crc32."""
    slim = pieces(docs, vocabulary, capacity, end_id, with_ids=False)
    return place(spark, written(spark, slim, "pieces"), capacity).drop("slot")
