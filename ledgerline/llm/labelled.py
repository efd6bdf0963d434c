"""Labelled rows for the classifiers: all training rows as a table, or a bounded, deterministic sample of them."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StringType

from ledgerline.llm.common import bloom_filter, bloom_hits, text_or_empty, written


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32(doc_id as text) mod modulus; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def training_rows(spark: SparkSession, docs: DataFrame, labels: DataFrame, label: str, modulus: int = 5, held_out: int = 0) -> DataFrame:
    """Written table (text, y) of every row outside the held-out remainder with a 0/1 label, its whole text.

    Only rows that may have such a label, by a Bloom filter of the ids, are shuffled to the exact join; it is a merge join at
    every size of the labels."""
    known = labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("y")).filter(
        F.col("y").isin(0, 1) & (remainder(F.col("_id"), modulus) != held_out))
    kind = docs.schema["doc_id"].dataType
    rows = docs.select(F.col("doc_id").alias("_doc"), text_or_empty().alias("text"))
    if kind == labels.schema["doc_id"].dataType and isinstance(kind, (IntegralType, StringType)):  # else equal ids may differ in their hash
        held = spark.sparkContext.broadcast(bloom_filter(known.select(F.xxhash64("_id").alias("key")), "key"))

        @F.pandas_udf("boolean")
        def doubtful(key: pd.Series) -> pd.Series:
            return pd.Series(bloom_hits(held.value, key.to_numpy(np.int64).view(np.uint64)))

        rows = rows.filter(doubtful(F.xxhash64("_doc")))
    rows = rows.join(known.hint("merge"), F.col("_doc") == F.col("_id"))
    return written(spark, rows.select("text", "y"), "labelled", "zstd")


def training_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, most_chars: int,
                    modulus: int = 5, held_out: int = 0, most_together: int = 8_000_000) -> tuple[list[str], np.ndarray]:
    """(texts, labels) of at most ``per_class`` training rows of each class, those with the smallest hash of the id.

    Only rows outside the held-out remainder, with a 0/1 label and a text of at most ``most_chars`` characters, count; those
    beyond ``most_together`` characters in all are left out."""
    known = labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("_y")).filter(
        F.col("_y").isin(0, 1) & (remainder(F.col("_id"), modulus) != held_out))
    drawn = [known.filter(F.col("_y") == y).orderBy(F.xxhash64("_id"), "_id").limit(per_class) for y in (0, 1)]
    rows = (docs.select(F.col("doc_id").alias("_doc"), text_or_empty().alias("text"))
            .filter(F.length("text") <= most_chars)
            .join(F.broadcast(drawn[0].unionByName(drawn[1])), F.col("_doc") == F.col("_id"))  # 2 * per_class rows
            .select("_id", "text", "_y").orderBy(F.xxhash64("_id"), "text", "_y").limit(2 * per_class).collect())
    size = np.cumsum([len(r["text"]) for r in rows])
    rows = [r for r, n in zip(rows, size) if n <= most_together]
    return [r["text"] for r in rows], np.array([r["_y"] for r in rows], np.int64)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Weights (the last is the bias) of a ridge logistic regression, by Newton's method."""
    a = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(a.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        h = (a * (p * (1 - p) + 1e-9)[:, None]).T @ a + ridge * np.eye(len(w))
        step = np.linalg.solve(h, a.T @ (p - y) + ridge * w)
        w -= step
        if np.abs(step).max() < 1e-7:
            break
    return w


def logistic_of(rows: DataFrame, names: list[str], weight: Column, ridge: float = 1e-2, steps: int = 50) -> np.ndarray:
    """``logistic`` of a table with the columns ``names`` and y, its rows weighed: one aggregate row a step reaches the driver."""
    x = [*[F.col(n) for n in names], F.lit(1.0)]
    pairs = [(i, j) for i in range(len(x)) for j in range(i, len(x))]
    w = np.zeros(len(x))
    for _ in range(steps):
        z = F.lit(0.0)
        for c, v in zip(x, w.tolist()):
            z = z + c * F.lit(v)
        staged = rows.withColumn("_w", weight).withColumn("_p", 1 / (1 + F.exp(-F.least(F.lit(30.0), F.greatest(F.lit(-30.0), z)))))
        p, u = F.col("_p"), F.col("_w")
        found = staged.agg(*[F.sum(u * (p - F.col("y")) * c) for c in x], *[F.sum(u * (p * (1 - p) + 1e-9) * x[i] * x[j]) for i, j in pairs]).first()
        h = ridge * np.eye(len(x))
        for (i, j), v in zip(pairs, found[len(x) :]):
            h[i, j] += v
            h[j, i] = h[i, j]
        step = np.linalg.solve(h, np.array(found[: len(x)]) + ridge * w)
        w -= step
        if np.abs(step).max() < 1e-7:
            break
    return w
