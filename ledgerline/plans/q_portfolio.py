"""Portfolio performance queries: accounts + profiles -> behaviour -> period summary.

The account view joins ``fx_accounts`` to ``fx_profiles`` (one row per
account on both sides) and derives every input of the summary with the
behaviour operators; the summary itself is one GROUPING SETS aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators import behaviour as B
from ledgerline.operators import portfolio as PF
from ledgerline.plans import oracle_tables as OT
from ledgerline.plans.catalog import query
from ledgerline.plans.q_behaviour import _STATE_BASE, _transition_sql, accounts_with_state, performance_sql

YOY, PER = "2024", "2024"


def account_view(spark, sf_dir) -> DataFrame:
    """One row per account with every measure the portfolio summary sums."""
    df = accounts_with_state(spark, sf_dir)
    df = B.performance_windows(df, PF.PERIODS)
    df = B.payment_defaulters(df)
    df = B.doubtful_debt(df)
    df = B.account_transition(df, 1)
    mob = F.col("mob_start")
    return df.select(
        "account",
        F.lit(1).alias("accounts"),
        "balance",
        F.col("cd0").alias("instalment"),
        F.when(mob == 0, 1).alias("account_m00"),
        F.when(mob.between(0, 5), 1).alias("account_new"),
        F.col("ageing_attribute").alias("account_age"),
        "account_state",
        *PF.DEFAULT_MEASURES,
        *[F.col(f"{k}_{n}") for n in PF.PERIODS for k in ("goods", "bads")],
        *[F.col(f"doubtful_debt_{n}m_flag").alias(f"doubtful_debt_{n}m") for n in PF.PERIODS],
        "transition_1_age",
    )


_VIEW_SQL = (
    _STATE_BASE
    + """,
p AS (SELECT *, """
    + ", ".join(c for n in PF.PERIODS for c in performance_sql(n))
    + """,
  CAST(CASE WHEN pit > 1 AND substr(dlq_profile, pit - 1, 1) = '1' THEN 1 END AS INTEGER) AS next_cycle_30_days,
  CAST(CASE WHEN pit > 2 AND substr(dlq_profile, pit - 2, 2) = '21' THEN 1 END AS INTEGER) AS second_cycle_60_days,
  CAST(CASE WHEN pit > 3 AND substr(dlq_profile, pit - 3, 3) = '321' THEN 1 END AS INTEGER) AS third_cycle_90_days,
  """
    + ", ".join(
        f"CAST(CASE WHEN upper(replace(account_state, ' ', '')) = 'D.DBTDOUBTFULDEBT(INVOLUNTARYCHURN)' AND pit >= {t} THEN 1 END AS INTEGER)"
        f" AS dd_{m}m"
        for m, t in ((1, 2), (3, 4), (6, 7), (9, 10), (12, 13))
    )
    + ", "
    + _transition_sql(1)
    + """ FROM s),
acct AS (SELECT account, 1 AS accounts, balance, cd0 AS instalment,
  CASE WHEN mob_start = 0 THEN 1 END AS account_m00, CASE WHEN mob_start BETWEEN 0 AND 5 THEN 1 END AS account_new,
  ageing_attribute AS account_age, account_state, next_cycle_30_days, second_cycle_60_days, third_cycle_90_days, """
    + ", ".join(f"goods_{n}, bads_{n}" for n in PF.PERIODS)
    + ", "
    + ", ".join(f"dd_{n}m AS doubtful_debt_{n}m" for n in PF.PERIODS)
    + ", transition_1_age FROM p)"
)


def _seg_sql(legacy: bool = False) -> tuple[str, str]:
    st = "upper(account_state)"
    whens_d, whens_p = [], []
    if legacy:
        whens_d += ["WHEN account_m00 IS NOT NULL THEN CASE WHEN account_m00 >= 1 THEN '01. New (MOB=00)' END",
                    "WHEN account_new IS NOT NULL THEN CASE WHEN account_new >= 1 THEN '02. Immature (MOB=01-05)' END"]
        whens_p += ["WHEN account_m00 IS NOT NULL THEN CASE WHEN account_m00 >= 1 THEN '00. Active (01 to 07)' END",
                    "WHEN account_new IS NOT NULL THEN CASE WHEN account_new >= 1 THEN '00. Active (01 to 07)' END"]
    else:
        whens_d += ["WHEN account_m00 >= 1 THEN '01. New (MOB=00)'", "WHEN account_new >= 1 THEN '02. Immature (MOB=01-05)'"]
        whens_p += ["WHEN account_m00 >= 1 THEN '00. Active (01 to 07)'", "WHEN account_new >= 1 THEN '00. Active (01 to 07)'"]
    for word, older, d, p in OT.SEGMENTS:
        w = older if legacy else word
        whens_d.append(f"WHEN coalesce(instr({st}, '{w}') > 0, false) THEN '{d}'")
        whens_p.append(f"WHEN coalesce(instr({st}, '{w}') > 0, false) THEN '{p}'")
    return "CASE " + " ".join(whens_d) + " ELSE '' END", "CASE " + " ".join(whens_p) + " ELSE '' END"


_AGE_SQL = "CASE " + " ".join(f"WHEN account_age = '{c}' THEN '{lab}'" for c, lab in OT.AGEING) + f" ELSE '{OT.AGEING_OTHER}' END"
_ROLL_SQL = ", ".join(
    f"CAST(CASE WHEN replace(upper(transition_1_age), ' ', '') = '{t}' THEN 1 END AS INTEGER) AS {n}" for n, t in OT.ROLL_RATES
)
_DC_SQL = ", ".join(f"CASE WHEN account_age = '{k}' THEN accounts END AS records_dc{k}" for k in range(5))

_PREP_SQL = (
    _VIEW_SQL
    + f""",
prep AS (SELECT *, accounts AS records, '{YOY}' AS yoy_label, {_seg_sql()[0]} AS yoy_account, {_seg_sql()[1]} AS yoy_portfolio,
  {_DC_SQL}, {_AGE_SQL} AS yoy_aging, {_ROLL_SQL} FROM acct)"""
)


def _metrics_sql(src: str, var: str) -> str:
    per = PER
    sums = ", ".join(f"sum({m}) AS {m}" for m in PF.MEASURES)
    cols = [f"CAST(trunc(balance / records) AS INTEGER) AS balance_{per}", f"CAST(trunc(instalment / records) AS INTEGER) AS instalment_{per}"]

    def pct(a, b):
        return f"CAST({a} / {b} * 100 AS FLOAT)"

    cols += [f"{pct(m, 'records')} AS {m}_{per}" for m in PF.DEFAULT_MEASURES]
    cols += [f"{pct(f'bads_{n}', f'(goods_{n} + bads_{n})')} AS bad_rate_{n}m_{per}" for n in PF.PERIODS]
    cols += [f"{pct(f'doubtful_debt_{n}m', 'records')} AS doubtful_debt_{n}m_{per}" for n in PF.PERIODS]
    cols += [f"CAST(records_dc{k} AS INTEGER) AS records_dc{k}_{per}" for k in range(5)]
    cols += [f"{pct(n, f'records_dc{n[2]}')} AS {n}_{per}" for n, _ in OT.ROLL_RATES]
    return f"SELECT {var}, yoy_label, {', '.join(cols)} FROM (SELECT {var}, yoy_label, {sums} FROM {src} GROUP BY {var}, yoy_label)"


@query(
    "portfolio_segmentation",
    oracle=_VIEW_SQL
    + f"\nSELECT account, account_m00, account_new, account_state, {_seg_sql()[0]} AS yoy_account, {_seg_sql()[1]} AS yoy_portfolio, "
    f"{_seg_sql(True)[0]} AS legacy_yoy_account, {_seg_sql(True)[1]} AS legacy_yoy_portfolio FROM acct",
)
def q_portfolio_segmentation(spark, sf_dir):
    v = account_view(spark, sf_dir).select("account", "account_m00", "account_new", "account_state")
    cur = PF.portfolio_segmentation(v, "account")
    leg = PF.portfolio_segmentation(v, "account", legacy=True).select(
        "account", F.col("yoy_account").alias("legacy_yoy_account"), F.col("yoy_portfolio").alias("legacy_yoy_portfolio")
    )
    return cur.join(leg, "account")


@query("segment_by_ageing", oracle=_VIEW_SQL + f"\nSELECT account, accounts, account_age, {_DC_SQL}, {_AGE_SQL} AS yoy_aging FROM acct")
def q_segment_by_ageing(spark, sf_dir):
    return PF.segment_by_ageing(account_view(spark, sf_dir).select("account", "accounts", "account_age"))


@query("roll_rate_flags", oracle=_VIEW_SQL + f"\nSELECT account, transition_1_age, {_ROLL_SQL} FROM acct")
def q_roll_rate_flags(spark, sf_dir):
    return PF.roll_rate_flags(account_view(spark, sf_dir).select("account", "transition_1_age"))


@query("portfolio_summary", oracle=_PREP_SQL + "\n" + _metrics_sql("prep", "yoy_account"))
def q_portfolio_summary(spark, sf_dir):
    v = PF.portfolio_input(account_view(spark, sf_dir), "account", YOY)
    v = PF.roll_rate_flags(PF.segment_by_ageing(PF.portfolio_segmentation(v, "account")))
    return PF.portfolio_summary(v, "yoy_account", PER)


@query(
    "portfolio_performance",
    oracle=_PREP_SQL
    + "\n"
    + " UNION ALL ".join(
        f"SELECT {c} AS yoy_account, * EXCLUDE ({c}) FROM ({_metrics_sql('prep', c)})" for c in ("yoy_account", "yoy_aging", "yoy_portfolio")
    ),
)
def q_portfolio_performance(spark, sf_dir):
    """Flagship: account, ageing and portfolio performance summaries for one period."""
    return PF.portfolio_performance(account_view(spark, sf_dir), "account", YOY, per=PER)


