"""Month-to-month transition matrices from a wide month-state table.

The wide table (one column per month, oldest first) is turned into
(from, to) pairs with one ``explode`` of an array of structs -- each month
pair is a struct, no self-join and no union of per-pair scans -- and the
pairs are counted with one partial aggregation whose output is at most
buckets x buckets rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def transition_pairs(df: DataFrame, month_cols: Sequence[str], delta_min: int = 0, delta_max: int = 1,
                     outside: str | None = "outside") -> DataFrame:
    """(from_bucket, to_bucket) for every account and month pair (m[i+delta_min], m[i+delta_max]).

    Pairs with a NULL on either side are dropped, and so are pairs starting in
    the ``outside`` bucket.
    """
    n = len(month_cols)
    pairs = []
    for i in range(0, n - delta_max):
        a, b = month_cols[i + delta_min], month_cols[i + delta_max]
        pairs.append(F.struct(F.col(a).cast("string").alias("f"), F.col(b).cast("string").alias("t")))
    ex = df.select(F.explode(F.array(*pairs)).alias("p")).select(F.col("p.f").alias("from_bucket"), F.col("p.t").alias("to_bucket"))
    ex = ex.filter(F.col("from_bucket").isNotNull() & F.col("to_bucket").isNotNull())
    if outside is not None:
        ex = ex.filter(F.col("from_bucket") != outside)
    return ex


def _canon(buckets: Sequence[str], outside: str | None) -> list[str]:
    return [b for b in buckets if outside is None or b.lower() != outside.lower()]


def transition_matrix(df: DataFrame, month_cols: Sequence[str], buckets: Sequence[str], delta_min: int = 0, delta_max: int = 1,
                      outside: str | None = "outside") -> DataFrame:
    """Counts from each canonical bucket to each canonical bucket (``to_<b>``), exits (``to_exit``),
    ``volume`` (canonical destinations) and ``logvol``.  Rows follow the canonical order via ``bucket_order``."""
    canon = _canon(buckets, outside)
    pairs = transition_pairs(df, month_cols, delta_min, delta_max, outside)
    counts = pairs.groupBy("from_bucket", "to_bucket").agg(F.count(F.lit(1)).alias("n"))
    aggs = [F.sum(F.when(F.col("to_bucket") == b, F.col("n"))).cast("bigint").alias(f"to_{b}") for b in canon]
    if outside is not None:
        aggs.append(F.sum(F.when(F.col("to_bucket") == outside, F.col("n"))).cast("bigint").alias("to_exit"))
    mat = counts.filter(F.col("from_bucket").isin(*canon)).groupBy("from_bucket").agg(*aggs)
    volume = None
    for b in canon:
        v = F.coalesce(F.col(f"to_{b}"), F.lit(0))
        volume = v if volume is None else volume + v
    order = F.array_position(F.array(*[F.lit(b) for b in canon]), F.col("from_bucket")).cast("int")
    return mat.withColumns({"volume": volume.cast("bigint"), "bucket_order": order}).withColumn(
        "logvol", F.log10(F.col("volume").cast("double"))
    )


def transition_rates(matrix: DataFrame, buckets: Sequence[str], outside: str | None = "outside", movement: bool = True) -> DataFrame:
    """Row shares (%, 1 dp) per destination and exit; with ``movement``, also cure/mill/worsen counts and rates.

    Cure = destinations below the start bucket, mill = same bucket, worsen = above
    (bucket labels compared as integers).
    """
    canon = _canon(buckets, outside)
    vol = F.col("volume")

    def rate(x: Column) -> Column:
        return F.bround(F.try_divide(F.coalesce(x, F.lit(0)) * 100.0, vol), 1)

    out = {f"to_{b}_rate": rate(F.col(f"to_{b}")) for b in canon}
    if outside is not None:
        out["to_exit_rate"] = rate(F.col("to_exit"))
    if movement:
        start = F.col("from_bucket").cast("int")
        cure = mill = worsen = F.lit(0).cast("bigint")
        for b in canon:
            v = F.coalesce(F.col(f"to_{b}"), F.lit(0))
            cure = cure + F.when(F.lit(int(b)) < start, v).otherwise(0)
            mill = mill + F.when(F.lit(int(b)) == start, v).otherwise(0)
            worsen = worsen + F.when(F.lit(int(b)) > start, v).otherwise(0)
        out.update({"cure": cure, "mill": mill, "worsen": worsen})
    staged = matrix.withColumns(out)
    if movement:
        staged = staged.withColumns({f"{k}_rate": rate(F.col(k)) for k in ("cure", "mill", "worsen")})
    return staged

