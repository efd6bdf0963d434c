"""Data-quality profiling that returns DataFrames.

Totals and parts come out of one aggregate; where a share needs the table's
row count it is a scalar subquery (a separate distributed count), never a
window over the whole table.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.skew import skew_join


def _keys(on) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def comparison_label(a: Column, b: Column, left_null: str, right_null: str, unequal: str, other) -> Column:
    lab = (
        F.when(a.isNull() & b.isNull(), "equality")
        .when(a.isNull(), left_null)
        .when(b.isNull(), right_null)
        .when(a == b, "equality")
        .when(a != b, unequal)
    )
    return lab.otherwise(other) if other is not None else lab


def compare_columns_join(
    df_a: DataFrame,
    df_b: DataFrame,
    on,
    col_a: str,
    col_b: str,
    how: str = "inner",
    unequal_only: bool = True,
    skewed: bool = False,
) -> DataFrame:
    """Join two tables on key column(s) and label how ``col_a`` compares to ``col_b``.

    ``skewed``: a few keys hold a large share of ``df_a`` (found by a sketch, then salted).

    Output columns: ``<key>_a``, ``<key>_b`` per key, ``<col_a>_a``,
    ``<col_b>_b``, ``comparison`` (equality, ineq left value is NULL, ineq
    right value is NULL, inequality, ineq for other reason).
    """
    keys = _keys(on)
    a = df_a.select(*[F.col(k).alias(f"{k}_a") for k in keys], F.col(col_a).alias(f"{col_a}_a"))
    b = df_b.select(*[F.col(k).alias(f"{k}_b") for k in keys], F.col(col_b).alias(f"{col_b}_b"))
    if skewed:
        names = [f"_k{i}" for i in range(len(keys))]
        joined = skew_join(a.withColumns({n: F.col(f"{k}_a") for n, k in zip(names, keys)}),
                           b.withColumns({n: F.col(f"{k}_b") for n, k in zip(names, keys)}), names, how)
    else:
        joined = a.join(b, on=[a[f"{k}_a"] == b[f"{k}_b"] for k in keys], how=how)
    lab = comparison_label(
        F.col(f"{col_a}_a"),
        F.col(f"{col_b}_b"),
        "ineq left value is NULL",
        "ineq right value is NULL",
        "inequality",
        "ineq for other reason",
    )
    out = joined.select(
        *[f"{k}_a" for k in keys], *[f"{k}_b" for k in keys], f"{col_a}_a", f"{col_b}_b", lab.alias("comparison")
    )
    return out.filter(F.col("comparison") != "equality") if unequal_only else out


class Comparison(NamedTuple):
    """What a comparison of two tables gives: the unequal rows, their keys, and rows and share per label (equality included)."""

    rows: DataFrame
    keys: DataFrame
    distribution: DataFrame


def compare_two_columns(df_a: DataFrame, df_b: DataFrame, on, col_a: str, col_b: str, how: str = "inner",
                        skewed: bool = False) -> Comparison:
    """``compare_columns_join`` with the keys of the unequal rows (left table's, a row each; a DataFrame, as there may be any
    number) and the distribution of the labels over all joined rows."""
    labelled = compare_columns_join(df_a, df_b, on, col_a, col_b, how, unequal_only=False, skewed=skewed)
    rows = labelled.filter(F.col("comparison") != "equality")
    return Comparison(rows, rows.select(*[f"{k}_a" for k in _keys(on)]), count_distribution(labelled, "comparison"))


def compare_columns(df: DataFrame, col_a: str, col_b: str, keep: Sequence[str] = (), unequal_only: bool = True) -> DataFrame:
    """Label two columns of one table: equality, left/right value is NULL, no equality."""
    lab = comparison_label(F.col(col_a), F.col(col_b), "left value is NULL", "right value is NULL", "no equality", None)
    out = df.select(*keep, col_a, col_b, lab.alias("comparison"))
    return out.filter(F.col("comparison") == "no equality") if unequal_only else out


def row_count(df: DataFrame) -> Column:
    """The table's row count as a scalar-subquery Column."""
    return df.select(F.count(F.lit(1))).scalar()


def count_distribution(df: DataFrame, col: str, sort: bool = True) -> DataFrame:
    """Rows and share (%) per value of ``col``, NULL included, biggest first."""
    out = df.groupBy(col).agg(F.count(F.lit(1)).alias("n_entries"))
    total = out.select(F.sum("n_entries")).scalar()  # over the groups, whose exchange both sides read
    out = out.withColumn("perc_entries", F.col("n_entries") * 100.0 / total)
    return out.orderBy(F.col("n_entries").desc(), F.col(col).asc_nulls_first()) if sort else out


def _distinct_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row: _n rows and ``<column>_cnt`` distinct non-null values, exact.

    Every row becomes narrow (column number, value) pairs, in one field per data type so that values are compared as what they
    are.  A task counts its own pairs before they are dealt by hash, so what is shuffled is a task's distinct pairs at most,
    and no hot value or column is one task's."""
    kinds = {f.name: f.dataType.simpleString() for f in df.select(*[F.col(f"`{c}`") for c in cols]).schema}
    fields = {k: f"v{i}" for i, k in enumerate(dict.fromkeys(kinds.values()))}
    pairs = [F.struct(F.lit(i).alias("_col"), *[(F.col(f"`{c}`") if kinds[c] == k else F.lit(None).cast(k)).alias(v) for k, v in fields.items()])
             for i, c in enumerate(cols)]
    held = df.select(F.inline(F.array(*pairs))).groupBy("_col", *fields.values()).agg(F.count(F.lit(1)).alias("_k"))
    there = F.coalesce(*[F.when(F.col(v).isNotNull(), 1) for v in fields.values()], F.lit(0))
    return held.groupBy().agg(
        F.coalesce(F.sum(F.when(F.col("_col") == 0, F.col("_k"))), F.lit(0)).cast("bigint").alias("_n"),
        *[F.count(F.when((F.col("_col") == i) & (there == 1), 1)).alias(f"{c}_cnt") for i, c in enumerate(cols)])


def distinct_stats(df: DataFrame, cols: Iterable[str], approx: bool = False) -> DataFrame:
    """Distinct non-null values per column and duplicates (n - distinct), with shares (NULL for an empty table).

    ``approx=True`` uses HyperLogLog++ sketches (one pass, nothing but the sketches is shuffled).
    """
    cols = list(cols)
    if approx or not cols:
        base = df.agg(F.count(F.lit(1)).alias("_n"), *[F.approx_count_distinct(c).alias(f"{c}_cnt") for c in cols])
    else:
        base = _distinct_counts(df, cols)
    out = []
    for c in cols:
        cnt = F.col(f"{c}_cnt")
        out += [
            cnt,
            F.try_divide(cnt * 100.0, F.col("_n")).alias(f"{c}_pct"),
            (F.col("_n") - cnt).alias(f"{c}_dup_cnt"),
            F.try_divide((F.col("_n") - cnt) * 100.0, F.col("_n")).alias(f"{c}_dup_pct"),
        ]
    return base.select(F.col("_n").alias("n_rows"), *out)


def distinct_row_stats(df: DataFrame) -> DataFrame:
    """Whole-row distinct and duplicate counts and shares, in one pass."""
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_k"))
    base = groups.agg(F.sum("_k").cast("bigint").alias("n_rows"), F.count(F.lit(1)).alias("n_unique"))
    return base.select(
        "n_rows",
        "n_unique",
        (F.col("n_rows") - F.col("n_unique")).alias("n_duplicate"),
        (F.col("n_unique") * 100.0 / F.col("n_rows")).alias("pct_unique"),
        (F.lit(100.0) - F.col("n_unique") * 100.0 / F.col("n_rows")).alias("pct_duplicate"),
    )


def null_stats(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """NULL count and share per column (all columns when ``cols`` is None), one aggregate."""
    cols = list(cols) if cols is not None else df.columns
    n = F.count(F.lit(1))
    out = []
    for c in cols:
        k = F.sum(F.col(c).isNull().cast("int")).cast("bigint")
        out += [k.alias(f"{c}_n_null"), (k * 100.0 / n).alias(f"{c}_perc")]
    return df.agg(*out)


def column_extrema(df: DataFrame, cols) -> DataFrame:
    cols = _keys(cols)
    return df.agg(*[a for c in cols for a in (F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max"))])


def isolate_keys(df: DataFrame, key: str, values, cols: Sequence[str] = ()) -> DataFrame:
    """Rows whose ``key`` is in ``values`` (a list, or a DataFrame holding the key).

    A list becomes an IN filter (pushed to the scan); a DataFrame becomes a
    left-semi join, which never duplicates rows; Spark broadcasts the keys if
    they are small enough by its own size check.
    """
    proj = [key, *[c for c in cols if c != key]] if cols else df.columns
    if isinstance(values, DataFrame):
        out = df.join(values.select(F.col(key)), on=key, how="left_semi")
    else:
        out = df.filter(F.col(key).isin(list(values)))
    return out.select(*proj).orderBy(key)


def drop_all_null_columns(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """Drop the columns (of ``cols``, default all) that are NULL in every row.

    The output schema depends on the data, so one aggregate row (one count per
    column) comes back to the driver; no data rows do.
    """
    cols = list(cols) if cols is not None else df.columns
    if not cols:
        return df
    counts = df.agg(*[F.count(c).alias(f"_{i}") for i, c in enumerate(cols)]).first()
    empty = [c for i, c in enumerate(cols) if counts[i] == 0]
    return df.drop(*empty)


def pct_dev(old, new) -> Column:
    """(new - old) * 100 / old; 99999 when old is 0."""
    old = F.col(old) if isinstance(old, str) else old
    new = F.col(new) if isinstance(new, str) else new
    return F.when(old == 0, F.lit(99999.0)).otherwise((new - old) * 100.0 / old)


def tolerance_check(df: DataFrame, old: str, new: str, low: float, high: float, label: str | None = None,
                    raise_outside: bool = False) -> DataFrame:
    """Percentage deviation of ``new`` from ``old`` and whether it lies in [low, high].

    ``raise_outside=True`` fails the job on the first row outside the range
    (``raise_error``), like an assertion; otherwise a status column is added.
    """
    dev = pct_dev(old, new)
    inside = (dev >= F.lit(low)) & (dev <= F.lit(high))
    status = F.when(inside, F.lit("within")).otherwise(F.lit("outside"))
    out = df.withColumns({"pct_dev": dev, "tolerance_status": status})
    if raise_outside:
        msg = F.format_string(
            f"%% deviation of %.2f, for '{label or new}', is not within [{low}, {high}]", F.col("pct_dev")
        )
        out = out.withColumn(
            "tolerance_status", F.when(F.col("tolerance_status") == "outside", F.raise_error(msg)).otherwise(F.col("tolerance_status"))
        )
    return out
