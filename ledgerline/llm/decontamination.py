"""Benchmark decontamination by SimHash windows and multi-index Hamming blocks (DataFrame functions only).

Words are runs of non-white bytes after lower-casing A-Z; a gram is ``GRAM`` words (a shorter item is one gram of all its
words).  A leak is a window of a document, as long as an item, whose weighted similarity to the item is at least
``threshold``: grams count as often as they occur, similarity = sum of the smaller counts / sum of the larger ones.

1. Windows: all grams of all texts are joined to the items' grams by hash.  Similarity bounds from below how many of a
   window's grams are the item's; windows with fewer of these hits are dropped.  A window that starts on no hit can be
   moved on by a word without losing similarity, until it starts on one or ends with the text, so the windows are those
   that start on a hit, the last one, and those that line a hit up with its place in the item.
2. Fingerprints: the 64-bit SimHash of a window's and an item's grams.  Fingerprints within ``RADIUS`` bits agree in at
   least one of RADIUS + 1 blocks, so an equi-join on (item, block number, block value) finds all of them.  At a
   similarity of 0.75 a bit differs with probability 0.17 (mean 11 of 64, deviation 3), so a radius of 31 is over six
   deviations away: the radius filters chance matches and leaves the decision to step 3.
3. Verification: the exact weighted similarity of the candidates; the best window of each (document, item) is returned, of
   equal ones one that is lined up with the item, then the first.

The items' tables are broadcast only if they hold at most BROADCAST_ROWS rows; beyond that Spark joins by shuffling.
Defined cases: null texts and items without words match nothing; rows equal in id and text count once; null ids are kept; empty
tables give no rows; other columns are ignored by ``leaks`` and kept by ``clean``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ledgerline.llm.common import LOWER, UPPER, text_or_empty, written

GRAM = 5
RADIUS = 31
BROADCAST_ROWS = 1_000_000
_WHITE = "\t\n\x0b\x0c\r"


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(text, UPPER + _WHITE, LOWER + " " * len(_WHITE)), " "), "")


def _grams(words_sql: str, gram: str) -> str:
    """Hashes of all runs of ``gram`` words; an empty array if there are fewer words."""
    return (f"CASE WHEN size({words_sql}) >= {gram} THEN transform(sequence(1, size({words_sql}) - {gram} + 1), "
            f"i -> xxhash64(slice({words_sql}, i, {gram}))) ELSE array() END")


#: Occurrences numbered, so that a set intersection counts repeated grams.
_NUMBERED = "transform({0}, (x, i) -> xxhash64(x, size(filter(slice({0}, 1, i), y -> y = x))))"
#: Starts of the windows of ``held`` grams that hold at least ``need`` of the sorted hits ``at``: from each hit back to the one before.
_DENSE = ("flatten(transform(slice(at, 1, greatest(0, size(at) - need + 1)), (x, i) -> aggregate(array(greatest(IF(i = 0, 0, "
          "get(at, i - 1) + 1), get(at, i + need - 1) - held + 1)), CAST(array() AS ARRAY<INT>), "
          "(s, a) -> IF(a <= least(x, last), sequence(a, least(x, last)), s))))")
#: Bit b is set if more grams have it than not.
_SIMHASH = ("aggregate(transform(sequence(0, 63), b -> IF(aggregate({0}, 0, (s, h) -> s + CAST(shiftright(h, b) & 1L AS INT)) * 2 "
            "> size({0}), shiftleft(1L, b), 0L)), 0L, (s, v) -> s | v)")


def _blocks(fingerprint: str) -> Column:
    """(block number, block value) of each of the RADIUS + 1 blocks of a fingerprint."""
    n = RADIUS + 1
    cut = [64 * i // n for i in range(n + 1)]
    return F.array(*[F.struct(F.lit(i).alias("block"), F.expr(
        f"shiftrightunsigned({fingerprint}, {a}) & {(1 << (b - a)) - 1}L").alias("value"))
        for i, (a, b) in enumerate(zip(cut, cut[1:]))])


def _bounded(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def prepared_items(spark: SparkSession, benchmark: DataFrame) -> DataFrame:
    """Written table: item_id, n_words, gram (words a gram), grams, numbered, fingerprint."""
    items = benchmark.select("item_id", words(text_or_empty()).alias("w")).filter("size(w) > 0")
    items = items.withColumn("n_words", F.size("w")).withColumn("gram", F.least(F.lit(GRAM), F.col("n_words")))
    items = items.withColumn("grams", F.expr(_grams("w", "gram"))).drop("w").distinct()
    return written(spark, items.withColumn("numbered", F.expr(_NUMBERED.format("grams")))
                   .withColumn("item_print", F.expr(_SIMHASH.format("grams"))), "benchmark-items")


def _texts(docs: DataFrame) -> DataFrame:
    text = text_or_empty()
    return docs.select(F.col("doc_id").alias("doc_id"), F.xxhash64(text).alias("text_key"), words(text).alias("w"))


def leaks(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, threshold: float = 0.75) -> DataFrame:
    """One row per leaking (document, item): doc_id, item_id, first_word, n_words, similarity, hamming, text_key."""
    items = prepared_items(spark, benchmark)
    n_items, n_grams = items.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("grams")), F.lit(0))).first()
    sizes = sorted(r["gram"] for r in items.select("gram").distinct().collect())  # at most GRAM numbers
    texts = _texts(docs)
    places = items.select("item_id", "gram", F.col("n_words").alias("item_words"), F.posexplode("grams").alias("place", "hash"))
    near = None
    for gram in sizes:
        found = texts.select("doc_id", "text_key", F.size("w").alias("n"), F.posexplode(F.expr(_grams("w", str(gram)))).alias("pos", "hash"))
        found = found.join(_bounded(places.filter(F.col("gram") == gram).drop("gram"), n_grams), "hash").drop("hash")
        near = found if near is None else near.unionByName(found)
    if near is None:
        return spark.createDataFrame([], docs.select("doc_id").schema).select(
            "doc_id", *[F.lit(None).cast(t).alias(c) for c, t in (
                ("item_id", benchmark.schema["item_id"].dataType), ("first_word", "int"), ("n_words", "int"),
                ("similarity", "double"), ("hamming", "int"), ("text_key", "long"))])
    near = near.withColumn("last", F.greatest(F.lit(0), F.col("n") - F.col("item_words")))  # start of a text's last window
    start = F.greatest(F.lit(0), F.least(F.col("pos") - F.col("place"), F.col("last")))
    hits = near.groupBy("doc_id", "text_key", "item_id", "n", "item_words", "last").agg(
        F.array_sort(F.collect_set("pos")).alias("at"), F.collect_set(start).alias("aligned"))
    own, held = (F.col("item_words") - F.least(F.lit(GRAM), F.col("item_words")) + 1,
                 F.least("n", "item_words") - F.least(F.lit(GRAM), F.col("item_words")) + 1)  # grams of the item, of a window
    hits = hits.withColumn("held", held).withColumn("need", F.greatest(
        F.lit(1), F.ceil((own + held) * (threshold / (1 + threshold)) - 1e-9).cast("int"))).filter("size(at) >= need")
    hits = hits.withColumn("dense", F.expr(_DENSE)).withColumn("lined", F.array_intersect("dense", "aligned"))
    other = F.array_except(F.array_intersect("dense", F.array_append("at", F.col("last"))), "lined")
    windows = hits.select("doc_id", "text_key", "item_id", F.explode(F.concat(
        F.transform("lined", lambda x: F.struct(x.alias("first_word"), F.lit(True).alias("aligned"))),
        F.transform(other, lambda x: F.struct(x.alias("first_word"), F.lit(False).alias("aligned"))))).alias("x"))
    windows = written(spark, windows.select("doc_id", "text_key", "item_id", "x.*"), "leak-windows")

    per_text = windows.groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("item_id", "first_word", "aligned")).alias("at"))
    hit = texts.withColumnRenamed("doc_id", "_doc").withColumnRenamed("text_key", "_key").join(
        per_text, F.col("_doc").eqNullSafe(F.col("doc_id")) & (F.col("_key") == F.col("text_key")))
    hit = hit.select("doc_id", "text_key", "w", F.explode("at").alias("x")).select("doc_id", "text_key", "w", "x.*")
    hit = hit.join(_bounded(items.select("item_id", "n_words", "gram"), n_items), "item_id")
    hit = hit.withColumn("w", F.expr("slice(w, first_word + 1, n_words)")).withColumn("found", F.expr(_grams("w", "gram"))).drop("w", "gram")
    prints = written(spark, hit.distinct().withColumn("print", F.expr(_SIMHASH.format("found"))), "leak-prints")

    of_windows = prints.select("doc_id", "text_key", "item_id", "first_word", "print", F.explode(_blocks("print")).alias("b"))
    of_items = items.select("item_id", "item_print", F.explode(_blocks("item_print")).alias("b"))
    near = of_windows.join(_bounded(of_items, n_items * (RADIUS + 1)), ["item_id", "b"])
    near = near.filter(F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= RADIUS).select(
        "doc_id", "text_key", "item_id", "first_word", F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))).alias("hamming")).distinct()

    kept = [F.col(f"near.{c}").eqNullSafe(F.col(f"prints.{c}")) for c in ("doc_id", "text_key", "item_id", "first_word")]
    both = near.alias("near").join(prints.alias("prints"), kept[0] & kept[1] & kept[2] & kept[3]).select("prints.*", "near.hamming")
    both = both.join(_bounded(items.select("item_id", "numbered"), n_items), "item_id")
    shared = F.size(F.array_intersect("numbered", F.expr(_NUMBERED.format("found"))))
    both = both.withColumn("shared", shared).withColumn(
        "similarity", F.col("shared") / (F.size("numbered") + F.size("found") - F.col("shared")))
    best = both.filter(F.col("similarity") >= threshold).groupBy("doc_id", "text_key", "item_id").agg(
        F.max(F.struct("similarity", "aligned", (-F.col("first_word")).alias("back"), "n_words", "hamming")).alias("b"))
    return best.select("doc_id", "item_id", (-F.col("b.back")).alias("first_word"), "b.n_words", "b.similarity", "b.hamming", "text_key")


def clean(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, threshold: float = 0.75) -> DataFrame:
    """The rows of ``docs`` without a leak, all their columns."""
    found = leaks(spark, docs, benchmark, threshold).select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct()
    found = written(spark, found, "leaking")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").alias("_doc"),
                       F.xxhash64(text_or_empty()).alias("_text"))
    return rows.join(found, F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_key")), "left_anti").select("row.*")
