"""Data-quality queries over the account, bureau, loss-model and ledger fixtures."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.functions import months as M
from ledgerline.operators import quality as Q
from ledgerline.plans.catalog import query
from ledgerline.sources.fixtures import fixture, fixture_cte

_BUREAU, _ECL, _ACC = fixture_cte("fx_bureau"), fixture_cte("fx_ecl"), fixture_cte("fx_accounts")
_TXN, _APPS = fixture_cte("fx_transactions"), fixture_cte("fx_applications")


def _join_inputs(spark, sf_dir):
    a = fixture(spark, sf_dir, "fx_bureau").withColumnRenamed("applicant", "account")
    b = fixture(spark, sf_dir, "fx_ecl")
    return a, b


def _unequal_join(spark, sf_dir):
    a, b = _join_inputs(spark, sf_dir)
    return Q.compare_columns_join(a, b, "account", "num0delq1y", "ttwo", how="left")


_JOIN_SQL = f"""WITH {_BUREAU}, {_ECL},
cmp AS (
  SELECT a.applicant AS account_a, b.account AS account_b, a.num0delq1y AS num0delq1y_a, b.ttwo AS ttwo_b,
    CASE WHEN a.num0delq1y IS NULL AND b.ttwo IS NULL THEN 'equality'
         WHEN a.num0delq1y IS NULL THEN 'ineq left value is NULL'
         WHEN b.ttwo IS NULL THEN 'ineq right value is NULL'
         WHEN a.num0delq1y = b.ttwo THEN 'equality' ELSE 'inequality' END AS comparison
  FROM fx_bureau a LEFT JOIN fx_ecl b ON a.applicant = b.account)"""


@query("compare_columns_join", oracle=_JOIN_SQL + "\nSELECT * FROM cmp WHERE comparison <> 'equality'")
def q_compare_columns_join(spark, sf_dir):
    return _unequal_join(spark, sf_dir)


_CMP_SQL = f"""WITH {_BUREAU},
cmp AS (SELECT applicant, num0delq1y, perc0delq90,
  CASE WHEN num0delq1y IS NULL AND perc0delq90 IS NULL THEN 'equality'
       WHEN num0delq1y IS NULL THEN 'left value is NULL' WHEN perc0delq90 IS NULL THEN 'right value is NULL'
       WHEN num0delq1y = perc0delq90 THEN 'equality' ELSE 'no equality' END AS comparison
  FROM fx_bureau)"""


@query("compare_columns", oracle=_CMP_SQL + "\nSELECT * FROM cmp WHERE comparison = 'no equality'")
def q_compare_columns(spark, sf_dir):
    return Q.compare_columns(fixture(spark, sf_dir, "fx_bureau"), "num0delq1y", "perc0delq90", keep=["applicant"])


@query(
    "count_distribution",
    oracle=_CMP_SQL
    + """
SELECT comparison, count(*) AS n_entries, count(*) * 100e0 / (SELECT count(*) FROM cmp) AS perc_entries
FROM cmp GROUP BY comparison""",
)
def q_count_distribution(spark, sf_dir):
    labelled = Q.compare_columns(
        fixture(spark, sf_dir, "fx_bureau"), "num0delq1y", "perc0delq90", keep=["applicant"], unequal_only=False
    )
    return Q.count_distribution(labelled, "comparison")


_DIST_COLS = ("txn_id", "account", "txn", "rec")


@query(
    "distinct_stats",
    oracle=f"WITH {_TXN}, s AS (SELECT count(*) AS n, "
    + ", ".join(f"count(DISTINCT {c}) AS {c}_cnt" for c in _DIST_COLS)
    + " FROM fx_transactions) SELECT n AS n_rows, "
    + ", ".join(
        f"{c}_cnt, {c}_cnt * 100e0 / n AS {c}_pct, n - {c}_cnt AS {c}_dup_cnt, (n - {c}_cnt) * 100e0 / n AS {c}_dup_pct"
        for c in _DIST_COLS
    )
    + " FROM s",
)
def q_distinct_stats(spark, sf_dir):
    return Q.distinct_stats(fixture(spark, sf_dir, "fx_transactions"), _DIST_COLS)


@query(
    "distinct_row_stats",
    oracle=f"""WITH {_TXN}, g AS (SELECT account, txn, rec, count(*) AS k FROM fx_transactions GROUP BY ALL),
    s AS (SELECT CAST(sum(k) AS BIGINT) AS n_rows, count(*) AS n_unique FROM g)
    SELECT n_rows, n_unique, n_rows - n_unique AS n_duplicate, n_unique * 100e0 / n_rows AS pct_unique,
           100e0 - n_unique * 100e0 / n_rows AS pct_duplicate FROM s""",
)
def q_distinct_row_stats(spark, sf_dir):
    return Q.distinct_row_stats(fixture(spark, sf_dir, "fx_transactions").select("account", "txn", "rec"))


_BUREAU_COLS = ("applicant", "num0delq1y", "percpay2y", "avgmob", "perc0delq90", "trades180", "util_lt10", "percutil", "maxdelq")


@query(
    "null_stats",
    oracle=f"WITH {_BUREAU} SELECT "
    + ", ".join(
        f"CAST(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS {c}_n_null, "
        f"CAST(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) * 100e0 / count(*) AS {c}_perc"
        for c in _BUREAU_COLS
    )
    + " FROM fx_bureau",
)
def q_null_stats(spark, sf_dir):
    return Q.null_stats(fixture(spark, sf_dir, "fx_bureau"))


@query(
    "column_extrema",
    oracle=f"""WITH {_ACC} SELECT min(balance) AS balance_min, max(balance) AS balance_max, min(cd0) AS cd0_min,
      max(cd0) AS cd0_max, min(contact_raw) AS contact_raw_min, max(contact_raw) AS contact_raw_max FROM fx_accounts""",
)
def q_column_extrema(spark, sf_dir):
    return Q.column_extrema(fixture(spark, sf_dir, "fx_accounts"), ["balance", "cd0", "contact_raw"])


@query(
    "isolate_keys",
    oracle=_JOIN_SQL.replace("WITH ", f"WITH {_ACC}, ", 1)
    + """
SELECT account, balance, cust_status FROM fx_accounts
WHERE account IN (SELECT account_a FROM cmp WHERE comparison <> 'equality')""",
)
def q_isolate_keys(spark, sf_dir):
    keys = _unequal_join(spark, sf_dir).select(F.col("account_a").alias("account"))
    return Q.isolate_keys(fixture(spark, sf_dir, "fx_accounts"), "account", keys, ["balance", "cust_status"])


@query(
    "tolerance_check",
    oracle=f"""WITH {_APPS}, m AS (SELECT app_month, count(*) AS n FROM fx_applications GROUP BY app_month),
    p AS (SELECT CAST(((app_month // 100) * 12 + app_month % 100) // 12 * 100 + ((app_month // 100) * 12 + app_month % 100) % 12 + 1 AS INTEGER)
            AS app_month, n AS n_prev FROM m),
    j AS (SELECT m.app_month, p.n_prev, m.n AS n_this FROM m JOIN p ON m.app_month = p.app_month)
    SELECT app_month, n_prev, n_this,
      CASE WHEN n_prev = 0 THEN 99999e0 ELSE (n_this - n_prev) * 100e0 / n_prev END AS pct_dev,
      CASE WHEN (CASE WHEN n_prev = 0 THEN 99999e0 ELSE (n_this - n_prev) * 100e0 / n_prev END) BETWEEN -10e0 AND 10e0
           THEN 'within' ELSE 'outside' END AS tolerance_status
    FROM j""",
)
def q_tolerance_check(spark, sf_dir):
    """Month-on-month change in application volume, checked against +-10 %."""
    apps = fixture(spark, sf_dir, "fx_applications")
    per_month = apps.groupBy("app_month").agg(F.count(F.lit(1)).alias("n"))
    prev = per_month.select(M.shift_stamp("app_month", 1).alias("app_month"), F.col("n").alias("n_prev"))
    pairs = per_month.withColumnRenamed("n", "n_this").join(prev, "app_month")
    return Q.tolerance_check(pairs.select("app_month", "n_prev", "n_this"), "n_prev", "n_this", -10.0, 10.0)
