"""Equi-joins whose left side may hold a large share of its rows on a few keys.

A frequent-items sketch (one pass over the keys, partial sketches a task, one row to the driver) names the heavy keys; only
these are salted: their left rows are dealt to ``parts`` tasks by a hash of the whole row, and their right rows are repeated
once a part.  All other keys join as usual.  What is named heavy changes the work, never the result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Keys that the sketch tracks; one that holds over 2 / TRACKED of all rows cannot be missed.
TRACKED = 4096
#: The most keys that are salted; more than this cannot each hold the default share.
MOST = 128


def _hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(f"`{k}`") for k in keys])


def heavy_keys(df: DataFrame, keys: Sequence[str], share: float = 1 / 64) -> list[int]:
    """Hashes of the keys that hold at least ``share`` of the rows (NULL is a key like others), by a frequent-items sketch."""
    found = df.select(_hash(keys).alias("_h")).agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(_h, {MOST}, {TRACKED})").alias("top")).first()
    return [t["item"] for t in found["top"] or [] if t["count"] >= max(2, share * found["n"])]


def skew_join(left: DataFrame, right: DataFrame, keys: str | Sequence[str], how: str = "inner", parts: int | None = None,
              heavy: Sequence[int] | None = None) -> DataFrame:
    """``left.join(right, keys, how)`` with the left side's heavy keys salted.

    ``heavy``: what ``heavy_keys`` gave for the left side (found here if None).  ``parts``: tasks a heavy key is dealt to, the
    session's shuffle partitions by default.  Right and full outer joins would repeat unmatched right rows and raise."""
    if how not in ("inner", "left", "left_outer", "leftouter", "left_semi", "leftsemi", "semi", "left_anti", "leftanti", "anti"):
        raise ValueError(f"a {how} join cannot repeat its right side")
    keys = [keys] if isinstance(keys, str) else list(keys)
    heavy = heavy_keys(left, keys) if heavy is None else list(heavy)
    if not heavy:
        return left.join(right, keys, how)
    parts = parts or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = _hash(keys).isin(heavy)
    row = F.xxhash64(*[F.col(f"`{c}`") for c in left.columns])
    dealt = left.withColumn("_salt", F.when(hot, F.pmod(row, F.lit(parts))).otherwise(F.lit(0)).cast("int"))
    salts = F.when(hot, F.sequence(F.lit(0), F.lit(parts - 1))).otherwise(F.array(F.lit(0)))
    return dealt.join(right.withColumn("_salt", F.explode(salts)), [*keys, "_salt"], how).drop("_salt")
