"""Subscriber dormancy (gaps and islands over a daily calendar).

Input: activity rows of a subscriber and day with 0/1 flags per channel; a day
may have several rows, or none, and undated rows only name their subscriber.
Output: one row per subscriber and calendar day from ``min_date`` to the latest
activity date of the whole table -- or one per activity row of that day -- with

* ``dormancy_period_<ch>`` – day number within the current run of inactive
  days (0 on active days; a run that starts on ``min_date`` counts from 1);
* ``still_dormant_<ch>``   – 1 when the day is inactive and the channel stays
  inactive up to the last calendar day.

A day is active on a channel if one of its rows is; rows of one day share both.

Plan: rows are first counted per subscriber and day, a counter for each combination
of flags (pre-aggregated, so a subscriber-day may hold any number of rows); one window (same partition
and order for every channel) gives each activity row its last-active date
per channel and the next activity row; each activity row then generates its
own day plus the silent days after it with ``explode(sequence(...))``.  No
distinct-ids cross join, no calendar join, no driver collect: the calendar
end is a scalar subquery.  The window sees one row per subscriber and day, so
it is bounded by the number of calendar days and cannot be skewed by volume.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHANNELS = ("data", "voice", "sms", "any")


def _as_date(value) -> Column:
    if isinstance(value, Column):
        return value
    if isinstance(value, (_dt.date, _dt.datetime)):
        value = value.isoformat()[:10]
    return F.to_date(F.lit(value))


def expand_activity_calendar(
    df: DataFrame,
    min_date,
    id_col: str = "service_number",
    date_col: str = "call_begin_date",
    channels=CHANNELS,
) -> DataFrame:
    """Every subscriber x every day from ``min_date`` to the table's last date.

    Days without activity get 0 in every flag.  Returns columns
    ``id_col, date, active_<ch>...``.
    """
    return _calendar(df, min_date, id_col, date_col, channels, with_dormancy=False)


def dormancy_periods(df: DataFrame, id_col: str = "service_number", channels=CHANNELS) -> DataFrame:
    """Dormancy columns over an already expanded calendar (``id_col, date, active_*``).

    Counts rows, as a day-numbered island would: the period is the row number
    since the last active row (the first row counts as preceded by activity).
    Windows only; all channels share one partitioning and one sort.
    """
    w = Window.partitionBy(id_col).orderBy("date")
    w_all = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    w_run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    staged = df.withColumn("_rn", F.row_number().over(w))
    out = []
    for ch in channels:
        active = F.col(f"active_{ch}") == 1
        last_on = F.coalesce(F.max(F.when(active, F.col("_rn"))).over(w_run), F.lit(0))
        final_on = F.coalesce(F.max(F.when(active, F.col("_rn"))).over(w_all), F.lit(0))
        out.append(F.when(active, F.lit(0)).otherwise(F.col("_rn") - last_on).cast("int").alias(f"dormancy_period_{ch}"))
        out.append(F.when(~active & (final_on < F.col("_rn")), 1).otherwise(0).alias(f"still_dormant_{ch}"))
    return staged.select(*[c for c in df.columns], *out)


def dormancy_report(
    df: DataFrame,
    min_date,
    id_col: str = "service_number",
    date_col: str = "call_begin_date",
    channels=CHANNELS,
) -> DataFrame:
    """Calendar expansion and dormancy in one pass (one shuffle by subscriber)."""
    return _calendar(df, min_date, id_col, date_col, channels, with_dormancy=True)


def _days(df, min_date, id_col, date_col, channels):
    """(start and end of the calendar, one row per subscriber and day with _rows and the day's flags).

    ``_rows`` holds the day's distinct flag rows and how often each occurs: one counter for each combination of flags, so
    any number of activity rows of a day is summed up in the tasks that read them."""
    flags = [f"active_{ch}" for ch in channels]
    start = _as_date(min_date)
    # Last calendar day = latest activity date over the whole table, planned
    # as a scalar subquery (one small aggregate job, no collect, no join).
    end = df.select(F.max(F.col(date_col).cast("date"))).scalar()
    day = F.col(date_col).cast("date")
    # a NULL subscriber never matches its own activity rows in a key join: keep the subscriber, zero the flags;
    # rows before the calendar start generate no day and count as inactive
    counts = F.col(id_col).isNotNull() & (day >= start)
    base = df.select(F.col(id_col), day.alias("_d"), *[F.when(counts & (F.col(d) == 1), 1).otherwise(0).alias(d) for d in flags])
    kind = sum((F.col(d) * (1 << i) for i, d in enumerate(flags)), F.lit(0))
    base = base.withColumn("_kind", kind)
    kinds = range(1 << len(flags))
    base = base.groupBy(id_col, "_d").agg(*[F.sum(F.when(F.col("_kind") == k, 1).otherwise(0)).alias(f"_n{k}") for k in kinds])
    # a NULL subscriber matches no activity row, so its days have one row each
    held = [F.struct(F.when(F.col(id_col).isNull(), F.signum(F.col(f"_n{k}"))).otherwise(F.col(f"_n{k}")).cast("int").alias("_n"),
                     *[F.lit(k >> i & 1).alias(d) for i, d in enumerate(flags)]) for k in kinds]
    rows = F.filter(F.array(*held), lambda x: x["_n"] > 0)
    return start, end, base.select(id_col, "_d", rows.alias("_rows"), *[
        F.when(sum((F.col(f"_n{k}") for k in kinds if k >> i & 1), F.lit(0)) > 0, 1).otherwise(0).alias(d) for i, d in enumerate(flags)])


def _by_day(base, start, id_col, channels) -> DataFrame:
    """``_days`` with, per channel, the last active day before the row's (``_was_``, the eve of the calendar if none) and of
    all (``_on_``), whether the row is its subscriber's first or last, and the further activity rows of its day."""
    w = Window.partitionBy(id_col).orderBy("_d")
    before, whole = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    eve = F.date_sub(start, 1)
    on = {ch: F.when(F.col(f"active_{ch}") == 1, F.col("_d")) for ch in channels}
    return base.select(
        "*", *[F.coalesce(F.max(d).over(before), eve).alias(f"_was_{ch}") for ch, d in on.items()],
        *[F.coalesce(F.max(d).over(whole), eve).alias(f"_on_{ch}") for ch, d in on.items()],
        (F.row_number().over(w) == 1).alias("_first"), F.lead(F.lit(True)).over(w).isNull().alias("_last"),
        F.aggregate("_rows", F.lit(-1), lambda n, r: n + r["_n"]).cast("long").alias("_more"))


def dormancy_runs(df: DataFrame, min_date, id_col: str = "service_number", date_col: str = "call_begin_date",
                  channels=CHANNELS) -> DataFrame:
    """(subscriber, channel, from_date, to_date, open): the runs of days without activity from ``min_date`` to the table's
    last date; ``open`` ones reach that date.  A row a run, however many days it has; no day is generated."""
    start, end, base = _days(df, min_date, id_col, date_col, channels)
    runs = []
    for ch in channels:
        on = F.col(f"active_{ch}") == 1
        runs.append(F.when(on, F.struct(F.lit(ch).alias("channel"), F.date_add(f"_was_{ch}", 1).alias("from_date"),
                                        F.date_sub("_d", 1).alias("to_date"), F.lit(False).alias("open"))))
        runs.append(F.when(F.col("_last"), F.struct(F.lit(ch).alias("channel"), F.date_add(f"_on_{ch}", 1).alias("from_date"),
                                                    end.alias("to_date"), F.lit(True).alias("open"))))
    return _by_day(base, start, id_col, channels).select(id_col, F.inline(F.array(*runs))).filter("from_date <= to_date")


def dormant_counts(df: DataFrame, min_date, id_col: str = "service_number", date_col: str = "call_begin_date",
                   channels=CHANNELS) -> DataFrame:
    """``dormant_counts_by_day`` of the activity's dormancy report without the report: a sweep over the runs.

    A run adds one subscriber on its first day and takes one off after its last (an empty run does both on one day), and a
    day's further activity rows, which the report lists too, add theirs for that day.  These events are summed by channel
    and day in the tasks that find them, and then added up along the calendar, a window of one row a day for each channel."""
    start, end, base = _days(df, min_date, id_col, date_col, channels)

    def event(ch, date, dormant, still):
        return F.struct(F.lit(ch).alias("channel"), date.alias("date"), dormant.cast("long").alias("dormant"), still.cast("long").alias("still_dormant"))

    one, none, more = F.lit(1), F.lit(0), F.col("_more")
    extra = F.col("_d").isNotNull() & (F.col("_d") >= start) & (more > 0)
    events = [F.when(F.col("_first"), event("", start, one, none)), F.when(extra, event("", F.col("_d"), more, none)),
              F.when(extra, event("", F.date_add("_d", 1), -more, none))]
    for ch in channels:
        on, was, final = F.col(f"active_{ch}") == 1, F.col(f"_was_{ch}"), F.col(f"_on_{ch}")
        still = F.when(F.col("_d") > final, more).otherwise(none)
        events += [F.when(on, event(ch, F.date_add(was, 1), one, none)), F.when(on, event(ch, F.col("_d"), -one, none)),
                   F.when(F.col("_last"), event(ch, F.date_add(final, 1), one, one)),
                   F.when(extra & ~on, event(ch, F.col("_d"), more, still)), F.when(extra & ~on, event(ch, F.date_add("_d", 1), -more, -still))]
    events = _by_day(base, start, id_col, channels).select(F.inline(F.array(*events))).filter("date IS NOT NULL")
    # every calendar day once a channel
    last = df.agg(F.max(F.col(date_col).cast("date")).alias("_end"))
    calendar = last.filter(F.col("_end") >= start).select(F.explode(F.sequence(start, "_end")).alias("date"))
    calendar = calendar.select(F.inline(F.array(*[event(ch, F.col("date"), none, none) for ch in [*channels, ""]])))
    swept = events.unionByName(calendar).groupBy("channel", "date").agg(F.sum("dormant").alias("dormant"), F.sum("still_dormant").alias("still_dormant"))
    line = Window.partitionBy("channel").orderBy("date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = swept.select("channel", "date", *[F.sum(c).over(line).alias(c) for c in ("dormant", "still_dormant")]).filter(F.col("date") <= end)

    def of(ch, c):
        return F.max(F.when(F.col("channel") == ch, F.col(c)))

    return swept.groupBy("date").agg(
        *[of(ch, c).alias(f"{c}_{ch}") for ch in channels for c in ("dormant", "still_dormant")], of("", "dormant").alias("subscribers"))


def _calendar(df, min_date, id_col, date_col, channels, with_dormancy):
    flags = [f"active_{ch}" for ch in channels]
    start, end, base = _days(df, min_date, id_col, date_col, channels)

    w = Window.partitionBy(id_col).orderBy("_d")
    w_run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    w_all = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    nxt = F.lead("_d").over(w)
    is_first = F.row_number().over(w) == 1
    cols = [
        F.col(id_col),
        F.col("_d"),
        F.when(is_first, start).otherwise(F.greatest(F.col("_d"), start)).alias("_from"),
        F.least(F.coalesce(F.date_sub(nxt, 1), end), end).alias("_to"),
        F.col("_rows"),
        *[F.col(d) for d in flags],
    ]
    if with_dormancy:
        for ch, d in zip(channels, flags):
            on = F.col(d) == 1
            # last active day up to and including this row, and before it
            cols.append(F.max(F.when(on, F.col("_d"))).over(w_run).alias(f"_la_{ch}"))
            cols.append(F.max(F.when(on, F.col("_d"))).over(w_all).alias(f"_fa_{ch}"))
    staged = base.select(*cols)

    days = staged.select(
        "*",
        F.explode(
            F.when(F.col("_to") >= F.col("_from"), F.sequence(F.col("_from"), F.col("_to"))).otherwise(
                F.array().cast("array<date>")
            )
        ).alias("date"),
    )
    own = F.col("date") == F.col("_d")
    out = [F.col(id_col), F.col("date"), F.when(own, F.col("_rows")).alias("_rows")]
    if with_dormancy:
        before_start = F.date_sub(start, 1)
        for ch, d in zip(channels, flags):
            active = own & (F.col(d) == 1)  # the day, by any of its rows
            # days before this row's own day (leading gap) precede any activity
            last_active = F.when(F.col("date") < F.col("_d"), before_start).otherwise(
                F.coalesce(F.col(f"_la_{ch}"), before_start)
            )
            out.append(F.when(active, 0).otherwise(F.datediff("date", last_active)).alias(f"dormancy_period_{ch}"))
            out.append(
                F.when(~active & (F.coalesce(F.col(f"_fa_{ch}"), before_start) < F.col("date")), 1)
                .otherwise(0)
                .alias(f"still_dormant_{ch}")
            )
    days = days.select(*out)
    silent = F.array(F.struct(F.lit(1).alias("_n"), *[F.lit(0).alias(d) for d in flags]))
    rows = days.select(*[c for c in days.columns if c != "_rows"], F.inline(F.coalesce("_rows", silent)))
    rows = rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), "_n")))
    rest = [c for c in days.columns if c not in (id_col, "date", "_rows")]
    return rows.select(id_col, "date", *flags, *rest)


def dormant_counts_by_day(report: DataFrame, channels=CHANNELS) -> DataFrame:
    """Subscribers dormant / still dormant per calendar day (partial aggregation)."""
    aggs = []
    for ch in channels:
        aggs.append(F.sum(F.when(F.col(f"dormancy_period_{ch}") > 0, 1).otherwise(0)).cast("bigint").alias(f"dormant_{ch}"))
        aggs.append(F.sum(F.col(f"still_dormant_{ch}")).cast("bigint").alias(f"still_dormant_{ch}"))
    aggs.append(F.count(F.lit(1)).alias("subscribers"))
    return report.groupBy("date").agg(*aggs)
