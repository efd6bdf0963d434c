"""Profiles of Parquet tables from the statistics in their files' footers.

Row counts, non-null counts and the extrema of whole numbers and dates stand in every Parquet footer, so Spark can answer their
aggregates without reading a row group (aggregate pushdown of its newer Parquet source).  The pushdown is planned in a child
session, which leaves the caller's settings alone; where a column's statistics cannot answer (text, whose bounds may be cut,
floating point, whose bounds leave out NaN), it is scanned.  Spark also scans by itself where pushdown does not apply.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_BOUNDED = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType)


def footer_table(spark: SparkSession, path: str) -> DataFrame:
    """The Parquet table in a child session whose plain counts and extrema are answered from footers."""
    child = spark.newSession()
    old = spark.conf.get("spark.sql.sources.useV1SourceList")
    child.conf.set("spark.sql.sources.useV1SourceList", ",".join(s for s in old.split(",") if s != "parquet"))
    child.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    child.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    return child.read.parquet(path)


def null_counts(spark: SparkSession, path: str, cols: Sequence[str] | None = None) -> dict[str, int]:
    """NULLs per column and, under "", the rows; one row of counts comes to the driver, no data row is read."""
    df = footer_table(spark, path)
    cols = list(cols) if cols is not None else df.columns
    found = df.agg(F.count(F.lit(1)).alias("n"), *[F.count(f"`{c}`").alias(f"_{i}") for i, c in enumerate(cols)]).first()
    n = found["n"] or 0  # no row where no file has a row group
    return {"": n, **{c: n - (found[f"_{i}"] or 0) for i, c in enumerate(cols)}}


def _extrema(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple]:
    row = df.agg(*[f(f"`{c}`").alias(f"{f.__name__}{i}") for i, c in enumerate(cols) for f in (F.min, F.max)]).first()
    return {c: (row[f"min{i}"], row[f"max{i}"]) for i, c in enumerate(cols)}


def extrema(spark: SparkSession, path: str, cols: Sequence[str]) -> dict[str, tuple]:
    """(smallest, largest) value per column, (None, None) where there is none; only columns that footers cannot answer for are
    scanned, all in one pass: other types, and columns of which some file holds no bounds (as where all its values are NULL)."""
    df, out = footer_table(spark, path), {}
    held = [c for c in cols if isinstance(df.schema[c].dataType, _BOUNDED)]
    for own in ([held] if held else []) + [[c] for c in held]:
        if len(out) == len(held):
            break
        try:
            out |= _extrema(df, own)
        except Exception as e:
            if "No min/max found" not in str(e):
                raise
    rest = [c for c in cols if c not in out]
    if rest:
        out |= _extrema(spark.read.parquet(path), rest)
    return {c: out[c] for c in cols}


def drop_all_null_columns(spark: SparkSession, path: str) -> DataFrame:
    """The table without the columns that are NULL in every row (of an empty table: all), found from footers alone."""
    nulls = null_counts(spark, path)
    return spark.read.parquet(path).drop(*[c for c, n in nulls.items() if c and n == nulls[""]])
