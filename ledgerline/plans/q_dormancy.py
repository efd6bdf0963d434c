"""Dormancy queries over ``fx_activity`` (events -> subscriber x day activity)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.operators import dormancy as D
from ledgerline.plans.catalog import query
from ledgerline.sources.fixtures import fixture, fixture_cte

MIN_DATE = "2024-01-01"

_CAL = f"""
WITH {fixture_cte("fx_activity_rows")},
ids AS (SELECT DISTINCT service_number FROM fx_activity_rows),
days AS (
  SELECT CAST(d AS DATE) AS date
  FROM generate_series(TIMESTAMP '{MIN_DATE} 00:00:00',
                       CAST((SELECT max(call_begin_date) FROM fx_activity_rows) AS TIMESTAMP),
                       INTERVAL 1 DAY) AS t(d)
),
cal AS (
  SELECT i.service_number, d.date,
         CAST(coalesce(a.active_data, 0) AS INTEGER) AS active_data,
         CAST(coalesce(a.active_voice, 0) AS INTEGER) AS active_voice,
         CAST(coalesce(a.active_sms, 0) AS INTEGER) AS active_sms,
         CAST(coalesce(a.active_any, 0) AS INTEGER) AS active_any
  FROM ids i CROSS JOIN days d
  LEFT JOIN fx_activity_rows a ON a.service_number = i.service_number AND a.call_begin_date = d.date
)"""


# one row per subscriber and day: the channel is active if one of the day's rows is
_DAILY = ", daily AS (SELECT service_number, date, " + ", ".join(
    f"max(active_{ch}) AS active_{ch}" for ch in D.CHANNELS) + " FROM cal GROUP BY service_number, date)"


def _channel_sql(src: str, ch: str) -> str:
    """Island numbering exactly as a lag/running-sum/row_number pipeline does it."""
    return f"""
{ch}_s AS (
  SELECT *, CASE WHEN active_{ch} = 0 AND lag(active_{ch}, 1, 1) OVER (PARTITION BY service_number ORDER BY date) = 1
                 THEN 1 ELSE 0 END AS st_{ch}
  FROM {src}),
{ch}_g AS (SELECT *, sum(st_{ch}) OVER (PARTITION BY service_number ORDER BY date) AS g_{ch} FROM {ch}_s),
{ch}_p AS (
  SELECT * EXCLUDE (st_{ch}, g_{ch}),
         CAST(CASE WHEN active_{ch} = 0
                   THEN row_number() OVER (PARTITION BY service_number, g_{ch} ORDER BY date) ELSE 0 END AS INTEGER)
           AS dormancy_period_{ch}
  FROM {ch}_g),
{ch}_d AS (
  SELECT *,
         CASE WHEN active_{ch} = 0
               AND dormancy_period_{ch} + count(date) OVER (PARTITION BY service_number)
                   - row_number() OVER (PARTITION BY service_number ORDER BY date)
                 = last_value(dormancy_period_{ch}) OVER (PARTITION BY service_number ORDER BY date
                     ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
              THEN 1 ELSE 0 END AS still_dormant_{ch}
  FROM {ch}_p)"""


def _report_sql() -> str:
    parts, src = [], "daily"
    for ch in D.CHANNELS:
        parts.append(_channel_sql(src, ch))
        src = f"{ch}_d"
    return _CAL + _DAILY + "," + ",".join(parts), src


_REPORT, _LAST = _report_sql()
_FLAGS = ", ".join(f"active_{ch}" for ch in D.CHANNELS)
_ROWS = f"(SELECT c.*, l.* EXCLUDE (service_number, date, {_FLAGS}) FROM cal c JOIN {_LAST} l ON l.service_number = c.service_number AND l.date = c.date)"


def _activity(spark, sf_dir):
    return fixture(spark, sf_dir, "fx_activity_rows")


@query("expand_activity_calendar", oracle=_CAL + "\nSELECT * FROM cal")
def q_expand_activity_calendar(spark, sf_dir):
    return D.expand_activity_calendar(_activity(spark, sf_dir), MIN_DATE)


@query(
    "dormancy_periods",
    oracle=_REPORT + f"\nSELECT * FROM {_LAST}",
)
def q_dormancy_periods(spark, sf_dir):
    cal = D.expand_activity_calendar(_activity(spark, sf_dir), MIN_DATE)
    daily = cal.groupBy("service_number", "date").agg(*[F.max(f"active_{ch}").alias(f"active_{ch}") for ch in D.CHANNELS])
    return D.dormancy_periods(daily)


@query("dormancy_report", oracle=_REPORT + f"\nSELECT * FROM {_ROWS}")
def q_dormancy_report(spark, sf_dir):
    return D.dormancy_report(_activity(spark, sf_dir), MIN_DATE)


def _counts_sql() -> str:
    cols = []
    for ch in D.CHANNELS:
        cols.append(f"CAST(sum(CASE WHEN dormancy_period_{ch} > 0 THEN 1 ELSE 0 END) AS BIGINT) AS dormant_{ch}")
        cols.append(f"CAST(sum(still_dormant_{ch}) AS BIGINT) AS still_dormant_{ch}")
    cols.append("count(*) AS subscribers")
    return _REPORT + f"\nSELECT date, {', '.join(cols)} FROM {_ROWS} GROUP BY date"


@query("dormant_counts_by_day", oracle=_counts_sql())
def q_dormant_counts_by_day(spark, sf_dir):
    """Dormant subscribers per day and channel, by a sweep over the runs (no day is expanded)."""
    return D.dormant_counts(_activity(spark, sf_dir), MIN_DATE)

