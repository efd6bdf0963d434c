"""Footer profiles against the aggregates that scan."""

import math

from pyspark.sql import functions as F

from ledgerline.operators import quality as Q
from ledgerline.session import scratch_dir
from ledgerline.sources import footers as FT


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_counts_and_extrema_equal_the_scan_and_read_no_row_group(spark):
    path = scratch_dir(spark, "footers")
    df = spark.range(1000).select(
        F.when(F.col("id") % 7 != 0, F.col("id") - 300).alias("i"), F.when(F.col("id") < 10, F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int"))).alias("d"),
        F.concat(F.lit("é" * 90), F.col("id").cast("string")).alias("t"), F.when(F.col("id") == 5, F.lit(float("nan"))).otherwise(F.col("id") / 8).alias("f"),
        F.lit(None).cast("int").alias("none"), F.lit(None).cast("string").alias("blank"))
    df.repartition(3).write.parquet(path)
    cols = df.columns
    want = Q.null_stats(df).first()
    assert FT.null_counts(spark, path) == {"": 1000, **{c: want[f"{c}_n_null"] for c in cols}}
    want = Q.column_extrema(df, cols).first()
    got = FT.extrema(spark, path, cols)
    for c in cols:
        assert all(a == b or (math.isnan(a) and math.isnan(b)) for a, b in zip(got[c], (want[f"{c}_min"], want[f"{c}_max"])) if a is not None or b is not None)
    table = FT.footer_table(spark, path)
    pushed = _plan(table.agg(F.count(F.lit(1)), F.count("t"), F.min("i"), F.max("d")))
    assert "PushedAggregation: [COUNT(*), COUNT(t), MIN(i), MAX(d)]" in pushed
    assert "PushedAggregation" not in _plan(spark.read.parquet(path).agg(F.min("i")))  # the caller's session is as it was
    assert FT.drop_all_null_columns(spark, path).columns == ["i", "d", "t", "f"]


def test_empty_tables(spark):
    path = scratch_dir(spark, "footers")
    spark.createDataFrame([], "a int, b string").write.parquet(path)
    assert FT.null_counts(spark, path) == {"": 0, "a": 0, "b": 0}
    assert FT.extrema(spark, path, ["a", "b"]) == {"a": (None, None), "b": (None, None)}
    assert FT.drop_all_null_columns(spark, path).columns == []
