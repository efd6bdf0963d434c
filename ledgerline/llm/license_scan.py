"""License scan by diagonal voting.

All rolling word k-gram hashes of every text are joined by Spark to the positions of the templates' k-grams (a fixed
table of this module, so the broadcast is bounded).  A hit votes for its diagonal: text position minus template
position.  Votes are counted per (text, template, diagonal); diagonals, which inserted or missing words part, are merged
in order of position while they lie within ``slack`` words of each other, or go on in the template where the one before
stopped, after at most the template's length and ``slack`` words; a merged span is verified by the share of the template's k-grams that it holds, and of overlapping notices the best stands.  A template marked exact stands wherever one diagonal has all its votes.

Words are runs of digits, letters a-z (after lower-casing A-Z) and non-ASCII characters.
Defined cases: null text is empty (no words, no labels, score 0); every row is a text of its own, also when its id repeats or
is null; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ledgerline.llm.common import text_or_empty, tidied
from ledgerline.llm.tokens import slices
from ledgerline.llm.words import NOT_ALNUM, encoded, rolling, word_hashes

#: Exact phrases and their labels.
PHRASES = [
    ("cc by", "cc-by"),
    ("general public license", "gpl"),
    ("all rights reserved", "reserved"),
]

#: Notices as they commonly stand in files, and their labels.
NOTICES = [
    ("released under the mit license", "mit"),
    ("licensed under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit"),
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("licensed under the gnu general public license version 2", "gpl-2.0"),
    ("licensed under the gnu general public license version 3", "gpl-3.0"),
    ("licensed under the gnu lesser general public license", "lgpl"),
    ("licensed under the gnu affero general public license", "agpl"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("licensed under the bsd license", "bsd"),
    ("subject to the terms of the mozilla public license v 2 0", "mpl-2.0"),
    ("licensed under cc by 4 0", "cc-by-4.0"),
    ("licensed under cc by nc 4 0", "cc-by-nc-4.0"),
    ("licensed under cc by sa 4 0", "cc-by-sa-4.0"),
    ("licensed under a creative commons attribution 4 0 international license", "cc-by-4.0"),
    ("this work is dedicated to the public domain", "public-domain"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
]

K = 2
SENTINEL = -1


def templates(k: int = K) -> list[tuple[int, str, bool, int, int, int]]:
    """(template, label, exact, grams in it, place, hash) of every k-gram of every template."""
    out = []
    for t, (text, label, exact) in enumerate([(p, x, True) for p, x in PHRASES] + [(p, x, False) for p, x in NOTICES]):
        grams = rolling(word_hashes([text.encode()], NOT_ALNUM)[0], k).astype("int64").tolist()
        out += [(t, label, exact, len(grams), i, h) for i, h in enumerate(grams)]
    return out


def grams(docs: DataFrame, k: int = K) -> DataFrame:
    """Per text: row (a number of its own), doc_id, n_words, grams (array of rolling k-gram hashes)."""

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            texts = batch["text"].tolist()
            for a, b in slices(texts):
                words, at = word_hashes(encoded(texts[a:b]), NOT_ALNUM)
                found = [rolling(words[i:j], k).view("int64") for i, j in zip(at, at[1:])]
                yield pd.DataFrame({"row": range(row, row + b - a), "doc_id": batch["doc_id"].iloc[a:b].astype("Int64").to_numpy(),
                                    "n_words": at[1:] - at[:-1], "grams": found})
                row += b - a

    return docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")).mapInPandas(
        tidied(hashed), "row long, doc_id long, n_words long, grams array<long>")


def spans(spark: SparkSession, docs: DataFrame, k: int = K, slack: int = 3) -> DataFrame:
    """Merged, unverified spans: row, doc_id, n_words, template, span, label, exact, first_word, last_word, share.

    Every text also has one row with template SENTINEL, so that texts without hits stay."""
    known = spark.createDataFrame([*templates(k)], "template int, label string, exact boolean, n_grams int, place int, gram long")
    hits = grams(docs, k).select("row", "doc_id", "n_words", F.posexplode_outer("grams").alias("pos", "gram"))
    hits = hits.join(F.broadcast(known), "gram", "left")
    first = F.coalesce(F.col("pos"), F.lit(0)) == 0
    kept = hits.filter(first | F.col("template").isNotNull())
    marks = kept.withColumn("x", F.explode(F.array(
        F.struct(F.when(first, F.lit(SENTINEL)).alias("template"), F.lit(None).cast("string").alias("label"),
                 F.lit(False).alias("exact"), F.lit(1).alias("n_grams"), F.lit(0).alias("diagonal")),
        F.struct("template", "label", "exact", "n_grams", (F.col("pos") - F.col("place")).alias("diagonal")))))
    votes = (marks.select("row", "doc_id", "n_words", "pos", "place", "x.*").filter("template IS NOT NULL")
             .groupBy("row", "doc_id", "n_words", "template", "label", "exact", "n_grams", "diagonal")
             .agg(F.min("pos").alias("lo"), F.max("pos").alias("hi"), F.countDistinct("place").alias("votes"),
                  F.collect_set("place").alias("places")))
    # diagonals of one template whose votes stand within a template's length of each other are one span, if they are
    # neighbours or the later one goes on in the template where the one before stopped (words were inserted)
    line = W.partitionBy("row", "template").orderBy("lo", "diagonal")
    near = ((F.abs(F.col("diagonal") - F.lag("diagonal").over(line)) <= slack)
            & (F.col("lo") <= F.lag("lo").over(line) + F.col("n_grams") + slack))
    onward = ((F.col("lo") - F.col("diagonal") >= F.lag(F.col("hi") - F.col("diagonal")).over(line))
              & (F.col("lo") > F.lag("hi").over(line)) & (F.col("lo") <= F.lag("hi").over(line) + F.col("n_grams") + slack))
    apart = F.col("exact") | ~(near | onward)
    runs = votes.withColumn("new", F.coalesce(apart.cast("int"), F.lit(1))).withColumn("span", F.sum("new").over(line))
    return runs.groupBy("row", "doc_id", "n_words", "template", "label", "exact", "n_grams", "span").agg(
        F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.min("diagonal").alias("diagonal"), F.max("votes").alias("votes"),
        F.size(F.array_distinct(F.flatten(F.collect_list("places")))).alias("covered"),
    ).select("row", "doc_id", "n_words", "template", "span", "label", "exact",
             F.when(F.col("exact"), F.col("diagonal")).otherwise(F.col("lo")).alias("first_word"),
             (F.col("hi") + k - 1).alias("last_word"), (F.col("covered") / F.col("n_grams")).alias("share"))


def scan(spark: SparkSession, docs: DataFrame, threshold: float = 0.75, k: int = K) -> DataFrame:
    """Per text: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score (its best verified share)."""
    found = spans(spark, docs, k)
    verified = F.when(F.col("exact"), F.col("share") == 1).otherwise(F.col("share") >= threshold) & (
        F.col("template") != SENTINEL)
    # where verified notices overlap, the ones with the largest share stand
    notice = verified & ~F.col("exact")
    line = W.partitionBy("row", notice).orderBy("first_word", "template", "span")
    before = F.max("last_word").over(line.rowsBetween(W.unboundedPreceding, -1))
    found = found.withColumn("new", F.coalesce((F.col("first_word") > before).cast("int"), F.lit(1)))
    found = found.withColumn("island", F.sum("new").over(line))
    found = found.withColumn("best", F.max("share").over(W.partitionBy("row", notice, "island")))
    base = verified & F.col("exact")
    verified = base | (notice & (F.col("share") == F.col("best")))

    def joined(which):
        return F.array_join(F.array_sort(F.collect_set(F.when(which, F.col("label")))), ",")

    return found.groupBy("row", "doc_id", "n_words").agg(
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("first_word"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("first_word"))).cast("long").alias("last_word"),
        joined(base).alias("base_labels"), joined(verified).alias("labels"),
        F.coalesce(F.max(F.when(verified, F.col("share"))), F.lit(0.0)).alias("score"),
    ).drop("row")
