"""Corpus pipeline: documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor kept, and returns a DataFrame that is
written as Parquet and reread as the next one's docs; all but the last return the columns of documents.

1. toxicity: rows whose toxicity probability is 0.5 or more go.
2. exact_dedup: of texts equal after lower-casing A-Z, the row with the largest id stays.
3. ngram_join: of each group connected by a Jaccard similarity of word 5-grams of at least 0.75, one row stays.
4. decontamination: rows that hold a passage similar to a benchmark item (0.75 or more) go.
5. packing: token pieces with their places in sequences of 1024 tokens.

Defined cases: a null text is the empty text, which is not toxic, equals other empty texts, links with nothing and leaks nothing,
and is packed as the end id alone.  A null doc_id counts below every other.  Rows of equal id and text are copies.  Texts of any length
are read whole.  All columns of documents, whatever their names, pass the first four stages.  An empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import decontamination, exact_dedup, ngram_join, packing, toxicity
from ledgerline.llm.common import table, written
from ledgerline.llm.queries import vocabulary


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fitted(docs, table(spark, sf_dir, "labels"))
    # the row as one column, so that no column of it can clash with the score
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("text"))
    return toxicity.scored(spark, rows, model).filter(F.col("score") < 0.5).select("row.*")


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_one(spark, docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one(spark, docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.clean(spark, docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(spark, docs, vocabulary(), capacity=1024, end_id=2)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("ngram_join", drop_near_copies),
    ("decontamination", drop_benchmark_leaks),
    ("packing", pack_sequences),
]

#: Trained classification and tokens are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(spark, stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
