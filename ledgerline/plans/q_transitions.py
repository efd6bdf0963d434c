"""Transition-matrix queries over ``fx_month_states`` (m1..m4, oldest first)."""

from __future__ import annotations

from ledgerline.operators import transitions as T
from ledgerline.plans.catalog import query
from ledgerline.sources.fixtures import fixture, fixture_cte

MONTHS = ["m1", "m2", "m3", "m4"]
# Canonical buckets of the month-state table, exit bucket last.
BUCKETS = ["0", "1", "2", "3", "4", "outside"]
CANON = [b for b in BUCKETS if b != "outside"]

_MATRIX_SQL = f"""WITH {fixture_cte("fx_month_states")},
p AS (SELECT m1 AS f, m2 AS t FROM fx_month_states UNION ALL SELECT m2, m3 FROM fx_month_states
      UNION ALL SELECT m3, m4 FROM fx_month_states),
q AS (SELECT f, t, count(*) AS n FROM p WHERE f IS NOT NULL AND t IS NOT NULL AND f <> 'outside' GROUP BY f, t),
mat AS (SELECT f AS from_bucket, {", ".join(f"CAST(sum(CASE WHEN t = '{b}' THEN n END) AS BIGINT) AS to_{b}" for b in CANON)},
          CAST(sum(CASE WHEN t = 'outside' THEN n END) AS BIGINT) AS to_exit
        FROM q WHERE f IN ({", ".join(f"'{b}'" for b in CANON)}) GROUP BY f),
m2 AS (SELECT *, CAST({" + ".join(f"coalesce(to_{b}, 0)" for b in CANON)} AS BIGINT) AS volume,
         CAST(list_position([{", ".join(f"'{b}'" for b in CANON)}], from_bucket) AS INTEGER) AS bucket_order FROM mat),
m3 AS (SELECT *, log10(CAST(volume AS DOUBLE)) AS logvol FROM m2)"""


@query("transition_matrix", oracle=_MATRIX_SQL + "\nSELECT * FROM m3")
def q_transition_matrix(spark, sf_dir):
    return T.transition_matrix(fixture(spark, sf_dir, "fx_month_states"), MONTHS, BUCKETS)


def _rate(x):
    return f"round_even(coalesce({x}, 0) * 100e0 / volume, 1)"


def _rates_sql() -> str:
    cols = [f"{_rate(f'to_{b}')} AS to_{b}_rate" for b in CANON] + [f"{_rate('to_exit')} AS to_exit_rate"]
    cure = " + ".join(f"CASE WHEN {int(b)} < CAST(from_bucket AS INTEGER) THEN coalesce(to_{b}, 0) ELSE 0 END" for b in CANON)
    mill = " + ".join(f"CASE WHEN {int(b)} = CAST(from_bucket AS INTEGER) THEN coalesce(to_{b}, 0) ELSE 0 END" for b in CANON)
    worse = " + ".join(f"CASE WHEN {int(b)} > CAST(from_bucket AS INTEGER) THEN coalesce(to_{b}, 0) ELSE 0 END" for b in CANON)
    return (_MATRIX_SQL + f""",
m4 AS (SELECT *, {", ".join(cols)}, CAST({cure} AS BIGINT) AS cure, CAST({mill} AS BIGINT) AS mill, CAST({worse} AS BIGINT) AS worsen FROM m3)
SELECT *, {_rate('cure')} AS cure_rate, {_rate('mill')} AS mill_rate, {_rate('worsen')} AS worsen_rate FROM m4""")


@query("transition_rates_bland", oracle=_MATRIX_SQL + "\nSELECT *, " + ", ".join(
    [f"{_rate(f'to_{b}')} AS to_{b}_rate" for b in CANON] + [f"{_rate('to_exit')} AS to_exit_rate"]) + " FROM m3")
def q_transition_rates_bland(spark, sf_dir):
    """Row shares only, without cure, mill and worsen."""
    mat = T.transition_matrix(fixture(spark, sf_dir, "fx_month_states"), MONTHS, BUCKETS)
    return T.transition_rates(mat, BUCKETS, movement=False)


# the window (0, 2) pairs each month with the one two months later
_WIDE_SQL = _MATRIX_SQL.replace("SELECT m1 AS f, m2 AS t FROM", "SELECT m1 AS f, m3 AS t FROM").replace(
    "SELECT m2, m3 FROM", "SELECT m2, m4 FROM").replace("UNION ALL SELECT m3, m4 FROM fx_month_states)", ")")


@query("transition_matrix_two_months", oracle=_WIDE_SQL + "\nSELECT * FROM m3")
def q_transition_matrix_two_months(spark, sf_dir):
    """Transitions from a month to two months later."""
    return T.transition_matrix(fixture(spark, sf_dir, "fx_month_states"), MONTHS, BUCKETS, delta_min=0, delta_max=2)


@query("transition_rates", oracle=_rates_sql())
def q_transition_rates(spark, sf_dir):
    mat = T.transition_matrix(fixture(spark, sf_dir, "fx_month_states"), MONTHS, BUCKETS)
    return T.transition_rates(mat, BUCKETS)
