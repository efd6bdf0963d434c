"""Loads that become visible all at once: failures in between, concurrent loads, versions, expiry, edge values."""

import pytest
from pyspark.sql import functions as F

from ledgerline.session import scratch_dir
from ledgerline.sources import published as P


def _rows(df):
    return sorted(tuple(r) for r in df.select("k", "v", "p").collect())


def _load(spark, rows):
    return spark.createDataFrame(rows, "k int, v string, p string")


def test_a_load_that_fails_before_it_is_published_changes_nothing(spark, monkeypatch):
    target = scratch_dir(spark, "published")
    old = [(1, "a", "x"), (2, "b", "y"), (3, "c", "z")]
    assert P.replace_partitions(_load(spark, old), target, "p") == 0
    real = P._swap
    monkeypatch.setattr(P, "_swap", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        P.replace_partitions(_load(spark, [(9, "n", "x"), (9, "n", "z")]), target, "p")
    assert _rows(P.read(spark, target)) == old
    monkeypatch.setattr(P, "_swap", real)
    for _ in range(2):  # twice is as good as once
        assert P.replace_partitions(_load(spark, [(9, "n", "x"), (9, "n", "z")]), target, "p") == 1
        assert _rows(P.read(spark, target)) == [(2, "b", "y"), (9, "n", "x"), (9, "n", "z")]
    assert _rows(P.read(spark, target, 1)) == old
    assert len(P.expire(spark, target, keep=1)) == 2  # the failed load and the first of the two equal ones; the oldest still holds y
    assert _rows(P.read(spark, target)) == [(2, "b", "y"), (9, "n", "x"), (9, "n", "z")]


def test_loads_published_meanwhile_are_kept(spark, monkeypatch):
    target = scratch_dir(spark, "published")
    P.replace_partitions(_load(spark, [(1, "a", "x"), (2, "b", "y")]), target, "p")
    real, calls = P._swap, []

    def slow(*args):
        calls.append(args[2])
        if len(calls) == 1:  # another load takes the number that this one is about to take
            monkeypatch.setattr(P, "_swap", real)
            P.replace_partitions(_load(spark, [(5, "e", "y")]), target, "p")
            monkeypatch.setattr(P, "_swap", slow)
        return real(*args)

    monkeypatch.setattr(P, "_swap", slow)
    P.replace_partitions(_load(spark, [(4, "d", "x")]), target, "p")
    assert calls == [2, 3]
    assert _rows(P.read(spark, target)) == [(4, "d", "x"), (5, "e", "y")]


def test_edge_values_and_pruning(spark):
    target = scratch_dir(spark, "published")
    with pytest.raises(FileNotFoundError):
        P.read(spark, target)
    empty = _load(spark, []).select("p", "k", "v")
    assert P.replace_partitions(empty, target, ["p"]) == 0 and P.read(spark, target).count() == 0
    rows = [(1, "a", None), (2, None, "a b/c=ü"), (3, "c", "007"), (4, "d", "7")]
    assert P.replace_partitions(_load(spark, rows), target, ["p"]) == 1
    found = P.read(spark, target)
    assert sorted(map(repr, found.select("k", "v", "p").collect())) == sorted(repr(r) for r in _load(spark, rows).collect())
    plan = found.filter(F.col("p") == "7")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(p" in plan
    with pytest.raises(ValueError):
        P.replace_partitions(spark.createDataFrame([(1, "x")], "k long, p string"), target, "p")
    two = scratch_dir(spark, "published")
    df = spark.createDataFrame([(1, 2, 3), (1, 3, 4), (2, 2, 5)], "a int, b int, c int")
    P.replace_partitions(df, two, ["a", "b"])
    P.replace_partitions(df.filter("a = 1 AND b = 2").withColumn("c", F.lit(9)), two, ["a", "b"])
    assert sorted(tuple(r) for r in P.read(spark, two).select("a", "b", "c").collect()) == [(1, 2, 9), (1, 3, 4), (2, 2, 5)]


def test_a_single_gzip_file_is_written_by_many_tasks(spark):
    import gzip

    from ledgerline.sources import io_ops as IO

    df = spark.range(0, 1000, numPartitions=6).select("id", F.concat(F.lit("a|"), F.col("id").cast("string")).alias("t"), F.lit(None).cast("string").alias("n"))
    base = scratch_dir(spark, "exports")
    for rows in (df, df.filter("id < 500")):  # the second replaces the first
        path = IO.export_csv_gz(rows, base, "x.csv.gz", single=True)
        back = spark.read.schema(df.schema).option("header", True).option("sep", "|").csv(path)
        assert sorted(back.collect()) == sorted(rows.collect())
        raw = open(path.removeprefix("file:"), "rb").read()
        lines = gzip.decompress(raw).decode().splitlines()
        assert lines[0] == "id|t|n" and [int(x.split("|")[0]) for x in lines[1:]] == list(range(len(lines) - 1))
        assert raw.count(b"\x1f\x8b\x08") >= 4  # one member a task, and the header's
    assert spark.read.option("header", True).option("sep", "|").csv(IO.export_csv_gz(df.limit(0), base, "e.csv.gz", single=True)).columns == ["id", "t", "n"]


def test_a_month_is_added_to_bucketed_profiles_without_a_shuffle(spark):
    import random

    from ledgerline.operators import profiles as PR
    from ledgerline.sources.bucketed import write_bucketed

    rnd = random.Random(2)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        long, stored = [], None
        for month in range(1, 5):  # the fourth is the newest
            rows = [(a, rnd.choice("0123CP"), rnd.randrange(100)) for a in range(300) if rnd.random() < 0.8]
            long += [(5 - month, *r) for r in rows]
            df = spark.createDataFrame(rows, "account int, age string, mob int").withColumn("mob", PR.encode_value("mob", 2))
            new = write_bucketed(df, f"month_{month}", scratch_dir(spark, "month"), "account", 4)
            if stored is None:
                stored = spark.createDataFrame([], "account int, age_profile string, mob_profile string")
                stored = write_bucketed(stored, "profiles_0", scratch_dir(spark, "profiles"), "account", 4)
            rolled = PR.roll_profiles(stored, new, "account", {"age_profile": ("age", "AGE"), "mob_profile": ("mob", "MOB")})
            plan = rolled._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and "Exchange" not in plan
            stored = write_bucketed(rolled, f"profiles_{month}", scratch_dir(spark, "profiles"), "account", 4, dealt=True)
            assert len(stored.inputFiles()) == 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    form = spark.createDataFrame(long, "idx int, account int, age string, mob int").withColumn("mob", PR.encode_value("mob", 2))
    want = PR.build_profiles_from_months(form, "account", "idx", "age", "AGE", "age_profile").join(
        PR.build_profiles_from_months(form, "account", "idx", "mob", "MOB", "mob_profile"), "account")
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, want.collect())) and stored.count() == 300
