"""Shared helpers of the training-data operators: normalisation text, written tables, files on shared storage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import scratch_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def text_or_empty(column: str = "text") -> Column:
    """The text column with null read as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def lowered(column: Column) -> Column:
    """Lower-case A-Z only; every other character is left alone."""
    return F.translate(column, UPPER, LOWER)


def written(spark: SparkSession, df: DataFrame, name: str, compression: str | None = None, together: int | None = None) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back (cuts the lineage).

    A reader holds a row group (up to 4,096 rows of it) in memory: tables of large rows get ``together`` rows a group."""
    path = scratch_dir(spark, name)
    df.write.options(**{"parquet.block.row.count.limit": together} if together else {}).parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


BATCH_BYTES = 2 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """What is run inside hands Python workers about BATCH_BYTES at a time (one row at least), not Spark's 64 MB, which a task
    holds several times over in the executor and in the worker; the session's own setting is put back at the end."""
    before = spark.conf.get(_BATCH, None)
    spark.conf.set(_BATCH, BATCH_BYTES)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_BATCH)
        else:
            spark.conf.set(_BATCH, before)


def shuffle_width(spark: SparkSession) -> int:
    """The session's number of shuffle partitions; grows with the cluster and its data."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def file_system(uri: str):
    """(file system, path) of a URI or absolute path; used inside tasks for ranged reads and writes."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def attempt_name(prefix: str, suffix: str) -> str:
    """A file name that no other task attempt uses; only committed manifests name the valid ones."""
    return f"{prefix}-{uuid.uuid4().hex}{suffix}"


BLOOM_WORDS = 1 << 19


def bloom_filter(keys: DataFrame, column: str) -> np.ndarray:
    """A Bloom filter of fixed size (BLOOM_WORDS of 64 bits) over a column of random 64-bit keys.

    It is only ever a first sieve before an exact join: however full it gets, nothing is lost."""
    cut = BLOOM_WORDS - 1
    bits = keys.select(F.explode(F.array(*[
        F.struct(F.expr(f"shiftrightunsigned({column}, {a}) & {cut}").alias("word"),
                 F.expr(f"shiftleft(1L, CAST(shiftrightunsigned({column}, {b}) & 63 AS INT))").alias("bit"))
        for a, b in ((0, 19), (25, 44))])).alias("s")).select("s.*")
    rows = bits.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(BLOOM_WORDS, np.int64)
    out[rows["word"].to_numpy()] = rows["bits"].to_numpy()
    return out.view(np.uint64)


def bloom_hits(bloom: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys (unsigned 64-bit) may be in the filter."""
    hit = np.ones(len(keys), bool)
    for a, b in ((0, 19), (25, 44)):
        words = bloom[(keys >> np.uint64(a)) & np.uint64(BLOOM_WORDS - 1)]
        hit &= (words >> ((keys >> np.uint64(b)) & np.uint64(63))) & np.uint64(1) == 1
    return hit


def drop_rows(spark: SparkSession, docs: DataFrame, named: DataFrame) -> DataFrame:
    """``docs`` (all columns) without the rows named in ``named`` (doc_id, text_key = xxhash64 of the text, once); of rows
    named with ``once``, which are equal in id and text, one stays.

    Only rows that may be named, by a Bloom filter, are shuffled to the exact join; ``named`` should be a written table."""
    held = spark.sparkContext.broadcast(bloom_filter(named, "text_key"))

    @F.pandas_udf("boolean")
    def doubtful(key: pd.Series) -> pd.Series:
        return pd.Series(bloom_hits(held.value, key.to_numpy(np.int64).view(np.uint64)))

    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").alias("_doc"),
                       F.xxhash64(text_or_empty()).alias("_key"))
    rows = rows.withColumn("_in", doubtful("_key"))
    named = named.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_text"), "once")
    same = F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_text"))
    hit = rows.filter("_in").join(named, same, "left")
    out = rows.filter("NOT _in").select("row.*").unionByName(hit.filter("once IS NULL").select("row.*"))
    if named.filter("once").isEmpty():
        return out
    return out.unionByName(hit.filter("once").groupBy("_doc", "_key").agg(F.first("row").alias("row")).select("row.*"))


def release_memory() -> None:
    """Give freed memory of a reused Python worker back to the system, at the end of a task."""
    import ctypes
    import gc

    import pyarrow

    gc.collect()
    pyarrow.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # not glibc
        pass


_STATES: dict = {}


def worker_state(name, make):
    """What the Python worker holds for one use (an encoder and its cache, say) from task to task; made at the first call."""
    if name not in _STATES:
        only_state(name)
        _STATES[name] = make()
    return _STATES[name]


def only_state(name=None) -> None:
    """Drop what the worker holds for other uses: a worker serves the tasks of many stages, but holds one stage's state."""
    others = [n for n in _STATES if n != name]
    for n in others:
        del _STATES[n]
    if others:
        release_memory()


def tidied(run, state=None):
    """A ``mapInPandas`` function that drops other states than its own (``state``) when its task begins, and releases the
    worker's freed memory when it ends."""
    def wrapped(batches):
        only_state(state)
        try:
            yield from run(batches)
        finally:
            release_memory()

    return wrapped
