"""Slots of applications: gathered from narrow rows, with the results of plain loops."""

from __future__ import annotations

import random
from datetime import date, timedelta

from pyspark.sql import functions as F

from ledgerline.functions.sequences import ordered_row_number
from ledgerline.operators import applications as A


def _inputs(spark):
    rnd = random.Random(5)
    apps = [(k, date(2024, 1, 1) + timedelta(rnd.randrange(200)) if k != 7 else None) for k in range(30)] + [(3, date(2024, 5, 5)), (None, date(2024, 2, 2))]
    acts = [(rnd.choice([*range(25), 4, 4, 4, None]), rnd.randrange(90), rnd.randrange(9),
             date(2024, 3, 1) + timedelta(rnd.randrange(12)) if rnd.random() < 0.7 else None, rnd.randrange(7)) for _ in range(260)]
    return (spark.createDataFrame(apps, "app_record_number long, app_date date"),
            spark.createDataFrame(acts, "app_record_number long, account long, subscriber_number long, con_start_date date, l_linenumber int"))


def test_slots_equal_plain_loops(spark):
    matched = A.match_applications_contracts(*_inputs(spark), fixed=True).cache()
    got = {r["app_record_number"]: r.asDict() for r in A.applications_slots(matched).collect()}
    want: dict = {}
    for r in matched.collect():
        into = want.setdefault(r["app_record_number"], dict.fromkeys(got[r["app_record_number"]]))
        into["app_record_number"] = r["app_record_number"]
        for c in into:
            if c != "app_record_number" and r[c] is not None:
                into[c] = r[c] if into[c] is None else max(into[c], r[c])
    assert got == want and None in got and any(r["app_subscriber_number5"] is not None for r in want.values())


def test_slots_of_rows_with_several_slots(spark):
    """Rows may hold several slots, or none."""
    matched = A.match_applications_contracts(*_inputs(spark), fixed=True)
    wide = matched.withColumns({"app_account4": F.lit("2"), "app_subscriber_number2": F.col("app_record_number") + 1})
    for r in A.applications_slots(wide).collect():
        assert r["app_account4"] == "2"
        assert r["app_subscriber_number2"] == (None if r["app_record_number"] is None else r["app_record_number"] + 1)


def test_slots_sort_narrow_rows_only(spark):
    """No sort of the plan holds the 31 fields of all slots: it took most of a task's memory."""
    matched = A.match_applications_contracts(*_inputs(spark), fixed=True)
    executed = A.applications_slots(matched)._jdf.queryExecution().executedPlan().executedPlan()
    nodes, width = [executed], []
    while nodes:
        node = nodes.pop()
        nodes += [node.children().apply(i) for i in range(node.children().size())]
        if node.nodeName() == "Sort":
            width.append(node.output().size())
    assert width and max(width) <= 12, width


def test_counted_rows_of_a_key(spark):
    rows = [(k, d, r) for r, (k, d) in enumerate([(1, 1), (1, 1), (1, 2), (1, None), (None, 3), (None, 3), (2, 5)])]
    df = spark.createDataFrame(rows, "k long, d int, rec int")
    got = ordered_row_number(df, ["k"], [("d", True)], [("rec", True)], "rn", {"dated": F.col("d").isNotNull(), "odd": F.col("rec") % 2 == 1})
    assert {(r["rec"], r["rn"], r["dated"], r["odd"]) for r in got.collect()} == {
        (3, 1, 3, 2), (0, 2, 3, 2), (1, 3, 3, 2), (2, 4, 3, 2), (4, 1, 2, 1), (5, 2, 2, 1), (6, 1, 1, 0)}
