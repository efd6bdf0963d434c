"""Calendar queries over ``fx_applications`` and order/shipment date pairs."""

from __future__ import annotations

from ledgerline.operators import calendar_ops as C
from ledgerline.plans.catalog import query
from ledgerline.sources.fixtures import fixture, fixture_cte, read_table

# Date pairs from orders x lines: NULLs on either side, equal dates and both orders.
DATE_PAIRS_SQL = """
SELECT l.l_orderkey * 10 + l.l_linenumber AS pair_id,
       CASE WHEN l.l_linenumber = 7 THEN NULL
            WHEN l.l_linenumber % 2 = 1 THEN CAST(o.o_orderdate AS DATE) ELSE CAST(l.l_shipdate AS DATE) END AS a,
       CASE WHEN l.l_linenumber = 6 THEN NULL WHEN l.l_linenumber = 5 THEN CAST(o.o_orderdate AS DATE)
            WHEN l.l_linenumber % 2 = 1 THEN CAST(l.l_shipdate AS DATE) ELSE CAST(o.o_orderdate AS DATE) END AS b
FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey
"""


def date_pairs(spark, sf_dir):
    return spark.sql(DATE_PAIRS_SQL, lineitem=read_table(spark, sf_dir, "lineitem"), orders=read_table(spark, sf_dir, "orders"))


_PAIRS_CTE = "pairs AS (" + DATE_PAIRS_SQL.format(lineitem="lineitem", orders="orders") + ")"
_APPS = fixture_cte("fx_applications")

_SHIFT = "CAST(((app_month // 100) * 12 + app_month % 100 - 1 + ({n})) // 12 * 100 + ((app_month // 100) * 12 + app_month % 100 - 1 + ({n})) % 12 + 1 AS INTEGER)"
SHIFTS = {"month_next": 1, "month_back_1": -1, "month_back_13": -13, "month_fwd_25": 25}


@query(
    "month_shift",
    oracle=f"WITH {_APPS} SELECT app_record_number, app_month, "
    + ", ".join(f"{_SHIFT.format(n=n)} AS {k}" for k, n in SHIFTS.items())
    + ", CAST(app_month // 100 AS VARCHAR) AS year_latest, CAST(app_month % 100 AS VARCHAR) AS month_latest"
    + f", CAST({_SHIFT.format(n=-1)} // 100 AS VARCHAR) AS year_prev, CAST({_SHIFT.format(n=-1)} % 100 AS VARCHAR) AS month_prev"
    + " FROM fx_applications",
)
def q_month_shift(spark, sf_dir):
    apps = fixture(spark, sf_dir, "fx_applications").select("app_record_number", "app_month")
    return C.year_month_pairs(C.month_shift(apps, "app_month", SHIFTS), "app_month")


@query(
    "month_spine",
    oracle=f"""WITH {_APPS}, s AS (SELECT app_record_number, app_month, CAST(n AS INTEGER) AS n
    FROM fx_applications, range(1, 7) AS t(n))
    SELECT app_record_number, app_month, n, {_SHIFT.format(n="-(n - 1)")} AS month_id FROM s""",
)
def q_month_spine(spark, sf_dir):
    apps = fixture(spark, sf_dir, "fx_applications").select("app_record_number", "app_month")
    return C.month_spine(apps, "app_month", steps=6)


@query(
    "period_labels",
    oracle=f"""WITH {_APPS}, p AS (SELECT app_record_number, app_month, app_date,
        make_date(CAST(app_month // 100 AS INTEGER), CAST(app_month % 100 AS INTEGER), 1) AS proxy_date FROM fx_applications)
    SELECT app_record_number, app_month, app_date,
      CAST(app_month // 100 AS VARCHAR) || CASE WHEN app_month % 100 IN (1, 2, 3) THEN 'Q1' WHEN app_month % 100 IN (4, 5, 6) THEN 'Q2'
           WHEN app_month % 100 IN (7, 8, 9) THEN 'Q3' WHEN app_month % 100 IN (10, 11, 12) THEN 'Q4' END AS quarter_of_stamp,
      coalesce(CAST(year(app_date) AS VARCHAR) || 'Q' || CAST(quarter(app_date) AS VARCHAR), '') AS quarter_of_date,
      proxy_date,
      upper(strftime(CAST(proxy_date - INTERVAL 1 MONTH AS DATE), '%b%y')) AS tag_prev,
      upper(strftime(proxy_date, '%b%y')) AS tag_this,
      upper(strftime(CAST(proxy_date + INTERVAL 1 MONTH AS DATE), '%b%y')) AS tag_next
    FROM p""",
)
def q_period_labels(spark, sf_dir):
    apps = fixture(spark, sf_dir, "fx_applications").select("app_record_number", "app_month", "app_date")
    return C.period_labels(apps, "app_month", "app_date")


_ELAPSED = """CASE WHEN a IS NULL OR b IS NULL THEN -1
  WHEN b >= a THEN d - CASE WHEN CAST(a + to_months(d) AS DATE) > b THEN 1 ELSE 0 END
  ELSE d + CASE WHEN CAST(a + to_months(d) AS DATE) < b THEN 1 ELSE 0 END END"""


@query(
    "month_differences",
    oracle=f"""WITH {_PAIRS_CTE}, d AS (SELECT *, CAST((year(b) - year(a)) * 12 + month(b) - month(a) AS INTEGER) AS d FROM pairs)
    SELECT pair_id, a, b, d AS months_back, CAST({_ELAPSED} AS INTEGER) AS elapsed_months FROM d""",
)
def q_month_differences(spark, sf_dir):
    return C.month_differences(date_pairs(spark, sf_dir), "a", "b")


@query(
    "reconcile_dates",
    oracle=f"""WITH {_PAIRS_CTE} SELECT pair_id, a, b,
      CASE WHEN a IS NULL AND b IS NOT NULL THEN '1: Only M0M is Null'
           WHEN a IS NOT NULL AND b IS NULL THEN '2: Only M1M is Null'
           WHEN a IS NULL AND b IS NULL THEN '3: Both M0M and M1M are Null'
           WHEN a = b THEN '4: M0M = M1M' WHEN a < b THEN '5: M0M is historic wrt M1M'
           WHEN a > b THEN '6: M0M more recent wrt M1M' ELSE '7: Unaccounted situation' END AS date_comparison,
      CASE WHEN a IS NULL THEN NULL WHEN b IS NULL THEN a WHEN a <= b THEN a ELSE b END AS final_date
    FROM pairs""",
)
def q_reconcile_dates(spark, sf_dir):
    return C.reconcile_dates(date_pairs(spark, sf_dir), "a", "b")
