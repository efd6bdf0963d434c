"""Joins with a third of the rows on one key: same result as the plain join, no task above its share."""

import pytest
from pyspark.sql import functions as F

from ledgerline.functions import skew as S
from ledgerline.operators import applications as A
from ledgerline.operators import quality as Q


@pytest.fixture(scope="module")
def sides(spark):
    n = 30_000
    left = spark.range(n).select(F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 29 == 0, F.lit(None)).otherwise(F.col("id") + 100).cast("int").alias("k"),
                                 (F.col("id") % 5).alias("g"), F.col("id").alias("x"))
    right = spark.range(0, n, 2).select(F.when(F.col("id") < 4, 7).otherwise(F.col("id") + 100).cast("int").alias("k"), F.col("id").alias("y"))
    return left, right


def test_the_sketch_names_the_heavy_keys_only(spark, sides):
    left, right = sides
    hot = left.filter("k = 7").select(F.xxhash64("k")).first()[0]
    null = spark.range(1).select(F.xxhash64(F.lit(None).cast("int"))).first()[0]
    assert set(S.heavy_keys(left, ["k"])) == {hot, null}
    assert S.heavy_keys(right, ["k"]) == [] == S.heavy_keys(left.limit(0), ["k"])


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_joins_equal_plain_ones(sides, how):
    left, right = sides
    a, b = S.skew_join(left, right, "k", how), left.join(right, "k", how)
    assert a.columns == b.columns and a.count() == b.count()
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_outer_joins_of_the_right_side_raise(sides):
    with pytest.raises(ValueError):
        S.skew_join(*sides, "k", "full")


def test_no_task_of_the_join_reads_over_twice_the_median(spark, sides):
    left, right = sides
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        def most(df):
            read = sorted(r["count"] for r in df.groupBy(F.spark_partition_id().alias("t")).agg(F.count("*").alias("count"), F.max("y")).collect())
            return read[-1] / read[len(read) // 2]

        small = right.groupBy("k").agg(F.max("y").alias("y"))
        assert most(left.join(small, "k", "left")) > 3 > 2 > most(S.skew_join(left, small, "k", "left"))
        apps = left.select(F.col("k").alias("app_record_number"), F.col("g").alias("v"), "x")
        other = small.withColumnRenamed("k", "app_record_number").withColumnRenamed("y", "w")
        found = Q.compare_two_columns(apps, other, "app_record_number", "x", "w", "left", skewed=True)
        plain = Q.compare_two_columns(apps, other, "app_record_number", "x", "w", "left")
        assert sorted(map(tuple, found.distribution.collect())) == sorted(map(tuple, plain.distribution.collect()))
        assert found.rows.exceptAll(plain.rows).isEmpty() and found.rows.count() == plain.rows.count()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_matching_skewed_records_equals_plain_matching(spark):
    apps = spark.range(400).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).cast("int").alias("app_record_number"),
                                   F.to_date(F.lit("2024-01-01")).alias("app_date"), F.col("id").alias("row"))
    acts = spark.createDataFrame([(1, "2024-01-05", 1, 11, 21), (1, "2024-02-05", 2, 12, 22), (4, "2024-01-09", 1, 13, 23)],
                                 "app_record_number int, d string, l_linenumber int, account int, subscriber_number int")
    acts = acts.withColumn("con_start_date", F.to_date("d")).drop("d")
    cols = ["app_record_number", "row", "account", "con_start_date", "matched_distance"]
    a = A.match_applications_contracts(apps, acts, skewed=True, fixed=True).select(cols)
    b = A.match_applications_contracts(apps, acts, fixed=True).select(cols)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty() and a.count() > 400
