"""Application queries over ``fx_applications`` and ``fx_activations``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators import applications as A
from ledgerline.operators import filters as FL
from ledgerline.operators import quality as Q
from ledgerline.plans import oracle_tables as OT
from ledgerline.plans.catalog import query
from ledgerline.plans.q_portfolio import _VIEW_SQL, account_view
from ledgerline.sources.fixtures import fixture, fixture_cte

_APPS, _ACT = fixture_cte("fx_applications"), fixture_cte("fx_activations")
SLOT_NAMES = ("app_account", "app_subscriber_number", "app_activation_date", "app_activation_days",
              "app_activation_weeks", "app_activation_month")


def _apps_with_outcomes(spark, sf_dir) -> DataFrame:
    apps = fixture(spark, sf_dir, "fx_applications")
    return FL.activations_initialise(FL.filter_one_hots(apps, channel=None, service=None, risk_grade=None))


def _matched(spark, sf_dir, fixed=False) -> DataFrame:
    apps = _apps_with_outcomes(spark, sf_dir)
    act = fixture(spark, sf_dir, "fx_activations")
    return A.match_applications_contracts(apps, act, fixed=fixed)


_OUTCOME_SQL = """CASE upper(coalesce(decision_outcome, '')) WHEN 'APPROVE' THEN 1 WHEN 'REFER' THEN 2 WHEN 'ARREARS' THEN 3
  WHEN 'DECLINE' THEN 4 ELSE 9 END"""
_WEEKS = ("CASE WHEN d IS NULL THEN NULL WHEN d = 0 THEN 0 WHEN d <= -1 THEN CAST(trunc((d + 1) / 7) AS INTEGER) - 1 "
          "WHEN d >= 1 THEN CAST(trunc((d - 1) / 7) AS INTEGER) + 1 END")


def _match_sql(fixed: bool) -> str:
    rn = ("row_number() OVER (PARTITION BY a.app_record_number ORDER BY c.con_start_date ASC NULLS FIRST, "
          "c.l_linenumber ASC NULLS FIRST, c.account ASC NULLS FIRST, c.subscriber_number ASC NULLS FIRST)")
    if fixed:
        slot = "CASE WHEN d IS NOT NULL AND rn <= 5 THEN rn END"
    else:
        slot = ("CASE WHEN d IS NOT NULL AND rn = 1 AND app_record_number = (SELECT min(app_record_number) FROM fx_applications) THEN NULL "
                "WHEN d IS NOT NULL AND rn = 1 THEN 1 END")
    fields = []
    for k in range(1, 6):
        fields += [f"CASE WHEN slot = {k} THEN '1' END AS app_account{k}", f"CASE WHEN slot = {k} THEN subscriber_number END AS app_subscriber_number{k}",
                   f"CASE WHEN slot = {k} THEN con_start_date END AS app_activation_date{k}", f"CASE WHEN slot = {k} THEN d END AS app_activation_days{k}",
                   f"CASE WHEN slot = {k} THEN {_WEEKS} END AS app_activation_weeks{k}",
                   f"CASE WHEN slot = {k} THEN CAST(year(con_start_date) * 100 + month(con_start_date) AS INTEGER) END AS app_activation_month{k}"]
    return f"""WITH {_APPS}, {_ACT},
j AS (SELECT a.*, c.account, c.subscriber_number, c.con_start_date, c.l_linenumber,
        CAST(date_diff('day', a.app_date, c.con_start_date) AS INTEGER) AS d, {rn} AS rn
      FROM fx_applications a LEFT JOIN fx_activations c ON a.app_record_number = c.app_record_number WHERE a.app_date IS NOT NULL),
s AS (SELECT *, CAST({slot} AS INTEGER) AS slot FROM j)
SELECT app_record_number, account, subscriber_number, con_start_date, l_linenumber, d AS matched_distance, slot,
  slot AS app_subscriptions, CASE WHEN slot IS NOT NULL THEN account END AS app_account_number1,
  CAST(NULL AS BIGINT) AS app_account_number2, CAST(NULL AS BIGINT) AS app_account_number3,
  CASE WHEN slot IS NOT NULL THEN '1' END AS app_accounts, {', '.join(fields)}
FROM s"""


MATCH_COLS = (["app_record_number", "account", "subscriber_number", "con_start_date", "l_linenumber", "matched_distance", "slot",
               "app_subscriptions", "app_account_number1", "app_account_number2", "app_account_number3", "app_accounts"]
              + [f"{n}{k}" for k in range(1, 6) for n in SLOT_NAMES])


@query("match_applications_contracts", oracle=_match_sql(fixed=False))
def q_match_applications_contracts(spark, sf_dir):
    return _matched(spark, sf_dir).select(*MATCH_COLS)


_SLOT_COLS = [f"{n}{k}" for k in range(1, 6) for n in SLOT_NAMES]


@query("match_applications_fixed", oracle=_match_sql(fixed=True).replace(
    "FROM s", ", greatest(count(*) FILTER (d IS NOT NULL) OVER (PARTITION BY app_record_number) - 5, 0) AS app_unslotted FROM s"))
def q_match_applications_fixed(spark, sf_dir):
    """The intended numbering: activations take slots 1 to 5 in order; app_unslotted counts those beyond."""
    return _matched(spark, sf_dir, fixed=True).select(*MATCH_COLS, "app_unslotted")


@query("applications_slots", oracle=f"""SELECT app_record_number, max(app_subscriptions) AS app_subscriptions,
  {', '.join(f'max({c}) AS {c}' for c in _SLOT_COLS)}
FROM ({_match_sql(fixed=True)}) GROUP BY app_record_number""")
def q_applications_slots(spark, sf_dir):
    """One row per application with the five slots filled from its activations."""
    return A.applications_slots(_matched(spark, sf_dir, fixed=True))


@query(
    "activation_status",
    oracle=f"""WITH {_APPS}, {_ACT},
j AS (SELECT a.app_record_number, a.decision_outcome, c.account, c.subscriber_number, c.con_start_date,
        CAST(date_diff('day', a.app_date, c.con_start_date) AS INTEGER) AS d, {_OUTCOME_SQL} AS o
      FROM fx_applications a LEFT JOIN fx_activations c ON a.app_record_number = c.app_record_number WHERE a.app_date IS NOT NULL),
k AS (SELECT *, CASE WHEN d IS NULL AND o = 4 THEN 1 WHEN d IS NULL AND o = 3 THEN 2 WHEN d IS NULL AND o = 2 THEN 3
        WHEN d IS NULL AND o = 1 THEN 4 WHEN d IS NOT NULL AND o = 4 THEN 5 WHEN d IS NOT NULL AND o = 3 THEN 6
        WHEN d IS NOT NULL AND o = 2 THEN 7 WHEN d IS NOT NULL AND o = 1 THEN 8 END AS k FROM j)
SELECT app_record_number, decision_outcome, account, subscriber_number, con_start_date, d AS matched_distance,
  CAST([7, 6, 5, 4, 3, 2, 1, 0][k] AS INTEGER) AS filter_activation_seq,
  {', '.join(f"CAST(CASE WHEN k = {i + 1} THEN 1 END AS INTEGER) AS {n}" for i, n in enumerate(FL.ACTIVATION_COUNTERS))},
  {', '.join(f"CAST(NULL AS VARCHAR) AS {n}" for n in FL.ACTIVATION_EXTRA)}
FROM k""",
)
def q_activation_status(spark, sf_dir):
    m = _matched(spark, sf_dir)
    out = FL.activation_status(m)
    return out.select("app_record_number", "decision_outcome", "account", "subscriber_number", "con_start_date",
                      "matched_distance", "filter_activation_seq", *FL.ACTIVATION_COUNTERS, *FL.ACTIVATION_EXTRA)


@query(
    "drop_all_null_columns",
    oracle=f"""WITH {_APPS}, a AS (SELECT app_record_number, decision_outcome, app_date, {_OUTCOME_SQL} AS o FROM fx_applications)
SELECT app_record_number, decision_outcome, app_date, CAST(o AS INTEGER) AS filter_decision_outcome_seq,
  CAST(CASE WHEN o = 1 THEN 1 END AS INTEGER) AS filter_decision_outcome_approved, CAST(CASE WHEN o = 4 THEN 1 END AS INTEGER) AS filter_decision_outcome_declined
FROM a WHERE o IN (1, 4)""",
)
def q_drop_all_null_columns(spark, sf_dir):
    """One-hots of the approved and declined applications: no row sets those of the other outcomes, nor the 14 initialised
    activation columns, so these are dropped."""
    apps = FL.filter_one_hots(fixture(spark, sf_dir, "fx_applications").select("app_record_number", "decision_outcome", "app_date"),
                              channel=None, service=None, risk_grade=None)
    return Q.drop_all_null_columns(FL.activations_initialise(apps.filter(F.col("filter_decision_outcome_seq").isin(1, 4))))


def _dup_sql(order: str, incoming: bool) -> str:
    """Lag over the whole key, a missing predecessor being the row itself; the span above 14 days never opens a sequence."""
    days, seq = ("app_record_number % 5", "app_record_number % 3") if incoming else ("NULL", "NULL")
    if order == "ascending":
        out = """CASE WHEN idkey IS NOT NULL THEN CAST(date_diff('day', coalesce(rd, app_date), app_date) AS INTEGER) ELSE days_in END
    AS dup_days_between_applications, CASE WHEN idkey IS NULL THEN seq_in END AS dup_application_sequence"""
    else:
        out = "days_in AS dup_days_between_applications, seq_in AS dup_application_sequence"
    return f"""WITH {_APPS},
n AS (SELECT app_record_number, CASE WHEN app_record_number % 13 = 0 THEN NULL ELSE idkey END AS idkey,
        CASE WHEN app_record_number % 17 = 0 THEN NULL ELSE app_date END AS app_date,
        CAST({days} AS INTEGER) AS days_in, CAST({seq} AS INTEGER) AS seq_in FROM fx_applications),
w AS (SELECT *, lag(app_date) OVER (PARTITION BY idkey ORDER BY app_date ASC NULLS FIRST, app_record_number DESC) AS rd FROM n)
SELECT app_record_number, idkey, app_date, CASE WHEN idkey IS NULL THEN 'N' ELSE 'Y' END AS dup_applicant, {out}
FROM w"""


def _dup_input(spark, sf_dir) -> DataFrame:
    """Applications with some keys and dates missing."""
    apps = fixture(spark, sf_dir, "fx_applications").select("app_record_number", "idkey", "app_date")
    rec = F.col("app_record_number")
    return apps.withColumns({"idkey": F.when(rec % 13 != 0, F.col("idkey")), "app_date": F.when(rec % 17 != 0, F.col("app_date"))})


@query("flag_duplicate_applicants", oracle=_dup_sql("ascending", incoming=False))
def q_flag_duplicate_applicants(spark, sf_dir):
    return A.flag_duplicate_applicants(_dup_input(spark, sf_dir), "ascending", day=14)


def _with_incoming(spark, sf_dir) -> DataFrame:
    rec = F.col("app_record_number")
    return _dup_input(spark, sf_dir).withColumns({"dup_days_between_applications": rec % 5, "dup_application_sequence": rec % 3})


@query("flag_duplicate_applicants_incoming", oracle=_dup_sql("ascending", incoming=True))
def q_flag_duplicate_applicants_incoming(spark, sf_dir):
    return A.flag_duplicate_applicants(_with_incoming(spark, sf_dir), "ascending", day=14)


@query("flag_duplicate_applicants_descending", oracle=_dup_sql("descending", incoming=True))
def q_flag_duplicate_applicants_descending(spark, sf_dir):
    return A.flag_duplicate_applicants(_with_incoming(spark, sf_dir), "descending")


_SESSION_SQL = f"""WITH RECURSIVE {_APPS},
days AS (SELECT idkey, app_date, min(app_record_number) AS first_rec FROM fx_applications GROUP BY idkey, app_date),
ranked AS (SELECT *, row_number() OVER (PARTITION BY idkey ORDER BY app_date) AS rn FROM days),
chain AS (
  SELECT idkey, app_date, first_rec, rn, 0 AS seq, app_date AS start FROM ranked WHERE rn = 1
  UNION ALL
  SELECT r.idkey, r.app_date, r.first_rec, r.rn, CASE WHEN date_diff('day', c.start, r.app_date) > 14 THEN c.seq + 1 ELSE c.seq END,
         CASE WHEN date_diff('day', c.start, r.app_date) > 14 THEN r.app_date ELSE c.start END
  FROM chain c JOIN ranked r ON r.idkey = c.idkey AND r.rn = c.rn + 1)
SELECT a.app_record_number, a.idkey, a.app_date, CAST(c.seq AS INTEGER) AS dup_application_sequence, c.start AS dup_session_start,
  CAST(date_diff('day', c.start, a.app_date) AS INTEGER) AS dup_days_since_session_start,
  CASE WHEN a.app_date = c.start AND a.app_record_number = c.first_rec THEN 'N' ELSE 'Y' END AS dup_applicant
FROM fx_applications a JOIN chain c ON a.idkey = c.idkey AND a.app_date = c.app_date"""


@query("sessionize_applications", oracle=_SESSION_SQL)
def q_sessionize_applications(spark, sf_dir):
    """Greedy 14-day application sessions per applicant."""
    apps = fixture(spark, sf_dir, "fx_applications").select("app_record_number", "idkey", "app_date")
    return A.sessionize_applications(apps, day=14)


def _consecutive_input(spark, sf_dir) -> DataFrame:
    apps = fixture(spark, sf_dir, "fx_applications").select(
        "app_record_number", "idkey", "app_date", "app_month", "decision_outcome", "risk_grade", "gross_income", "subscription_limit")
    apps = FL.filter_one_hots(apps, channel=None, service=None, risk_grade=None).select(
        "app_record_number", "idkey", "app_date", "app_month", "risk_grade", "gross_income", "subscription_limit", "filter_decision_outcome_seq")
    return apps.withColumn("dup_application_sequence", (F.col("app_record_number") % 3).cast("int"))


@query(
    "compare_consecutive_applications",
    oracle=f"""WITH {_APPS},
a AS (SELECT app_record_number, idkey, app_date, app_month, risk_grade, gross_income, subscription_limit,
        CAST({_OUTCOME_SQL} AS INTEGER) AS filter_decision_outcome_seq, CAST(app_record_number % 3 AS INTEGER) AS dup_application_sequence FROM fx_applications),
w AS (SELECT *, lag(idkey) OVER o AS rk, lag(app_date) OVER o AS ret_date, lag(dup_application_sequence) OVER o AS ret_application_sequence,
        CAST(date_trunc('month', app_date) AS DATE) AS app_month_dte, lag(app_month) OVER o AS ret_month,
        lag(filter_decision_outcome_seq) OVER o AS ret_decision_outcome, lag(risk_grade) OVER o AS rg
      FROM a WINDOW o AS (PARTITION BY idkey ORDER BY dup_application_sequence, filter_decision_outcome_seq, risk_grade,
        gross_income DESC, subscription_limit DESC, app_date, app_record_number)),
x AS (SELECT *, CAST(date_trunc('month', ret_date) AS DATE) AS ret_month_dte, coalesce(idkey = rk, false) AS same,
        coalesce(idkey = rk, false) AND coalesce(ret_application_sequence = dup_application_sequence, false) AS same_seq FROM w)
SELECT * EXCLUDE (rk, rg, same, same_seq, ret_date, ret_application_sequence, ret_month, ret_decision_outcome),
  CASE WHEN same THEN CAST(date_diff('day', ret_date, app_date) AS INTEGER) END AS dup_days_between_applications,
  CASE WHEN same_seq THEN 'Z' END AS dup_applicant,
  CASE WHEN same_seq AND coalesce(app_month <> ret_month, false) THEN CAST(date_diff('month', ret_month_dte, app_month_dte) AS DOUBLE) END
    AS dup_calendar_months_skipped,
  CASE WHEN same_seq AND filter_decision_outcome_seq IN (1, 2, 3) AND ret_decision_outcome IN (1, 2, 3)
       AND filter_decision_outcome_seq <> ret_decision_outcome THEN ret_decision_outcome - filter_decision_outcome_seq END AS dup_decision_outcome,
  CASE WHEN same_seq AND risk_grade IS NOT NULL AND rg IS NOT NULL AND risk_grade <> rg THEN rg - risk_grade END AS dup_risk_grade
FROM x""",
)
def q_compare_consecutive_applications(spark, sf_dir):
    return A.compare_consecutive_applications(_consecutive_input(spark, sf_dir))


def _mandate_input(spark, sf_dir) -> DataFrame:
    """Volumes and 6/9/12-month bad rates (%) per account state, from the account view."""
    v = account_view(spark, sf_dir)

    def rate(n):
        return (F.sum(f"bads_{n}") / (F.sum(f"goods_{n}") + F.sum(f"bads_{n}")) * 100).alias(f"bad_rate_{n}m")

    return v.groupBy("account_state").agg(
        F.count(F.lit(1)).alias("applicants"), F.sum("accounts").alias("app_accounts"), rate(12), rate(9), rate(6))


def _grade_sql(r, cuts):
    return ("CASE WHEN " + r + " IS NULL OR " + r + " = 0 THEN 0 " + " ".join(f"WHEN {r} < {c} THEN {i + 1}" for i, c in enumerate(cuts))
            + " ELSE 9 END")


def _mandate_sql() -> str:
    g12, g9, g6 = (_grade_sql(f"bad_rate_{n}m", OT.MANDATE[n]) for n in (12, 9, 6))
    m = f"""CASE WHEN bad_rate_12m IS NOT NULL AND bad_rate_9m IS NOT NULL AND bad_rate_6m IS NOT NULL THEN trunc(10 * ({g12} + {g9} + {g6}) / 3) / 10e0
  WHEN bad_rate_12m IS NOT NULL AND bad_rate_9m IS NOT NULL THEN trunc(10 * ({g12} + {g9}) / 2) / 10e0
  WHEN bad_rate_9m IS NOT NULL AND bad_rate_6m IS NOT NULL THEN trunc(10 * ({g9} + {g6}) / 2) / 10e0
  WHEN bad_rate_12m IS NOT NULL THEN bad_rate_12m WHEN bad_rate_9m IS NOT NULL THEN bad_rate_9m WHEN bad_rate_6m IS NOT NULL THEN bad_rate_6m END"""
    return (_VIEW_SQL + ",\nr AS (SELECT account_state, count(*) AS applicants, sum(accounts) AS app_accounts, "
            + ", ".join(f"sum(bads_{n}) / (sum(goods_{n}) + sum(bads_{n})) * 100 AS bad_rate_{n}m" for n in (12, 9, 6))
            + " FROM acct GROUP BY account_state)\n"
            + f"SELECT account_state, applicants, app_accounts, round(bad_rate_12m, 6) AS bad_rate_12m, round(bad_rate_9m, 6) AS bad_rate_9m, "
            + f"round(bad_rate_6m, 6) AS bad_rate_6m, CAST(CASE WHEN coalesce(applicants, 0) >= 100 AND coalesce(app_accounts, 0) >= 50 THEN {m} END AS FLOAT) AS risk_grade_mandate FROM r")


@query("risk_grade_mandate", oracle=_mandate_sql())
def q_risk_grade_mandate(spark, sf_dir):
    out = A.risk_grade_mandate(_mandate_input(spark, sf_dir))
    return out.withColumns({c: F.round(c, 6) for c in ("bad_rate_12m", "bad_rate_9m", "bad_rate_6m")})


PRISM_CUTS = (580, 600, 620, 640, 660, 680)
SCORE_CUTS = (555, 575, 595, 615, 635, 655)


def _band_sql(x, cuts):
    parts = [f"WHEN {x} < {cuts[0]} THEN '001'"] + [f"WHEN {x} < {cuts[i]} THEN '{cuts[i - 1]}'" for i in range(1, len(cuts))]
    return f"CASE WHEN {x} IS NULL THEN NULL " + " ".join(parts) + f" ELSE '{cuts[-1]}' END"


@query(
    "risk_grade_matrix",
    oracle=f"""WITH {_APPS}, a AS (SELECT app_record_number, risk_grade, prism_score, custom_score,
      CASE WHEN deceased = 'Y' THEN 'P01 Deceased' WHEN customer_age < 1800 THEN 'P02 Age' ELSE '' END AS waterfall_in FROM fx_applications)
    SELECT app_record_number, risk_grade, prism_score, custom_score, waterfall_in,
      CASE WHEN waterfall_in IS NULL OR waterfall_in = '' THEN 'Approve RG' || CAST(risk_grade AS VARCHAR) ELSE 'Decline' END AS outcome,
      CASE WHEN waterfall_in IS NULL OR waterfall_in = '' THEN 'P. Pass Credit Policies' ELSE waterfall_in END AS waterfall,
      {_band_sql('prism_score', PRISM_CUTS)} || 'x' || {_band_sql('custom_score', SCORE_CUTS)} AS matrix
    FROM a""",
)
def q_risk_grade_matrix(spark, sf_dir):
    apps = fixture(spark, sf_dir, "fx_applications").select(
        "app_record_number", "risk_grade", "prism_score", "custom_score",
        F.when(F.col("deceased") == "Y", F.lit("P01 Deceased")).when(F.col("customer_age") < 1800, F.lit("P02 Age")).otherwise(F.lit(""))
        .alias("waterfall_in"))
    grade = F.concat(F.lit("RG"), F.col("risk_grade").cast("string"))
    return apps.withColumns(A.risk_grade_matrix(grade, PRISM_CUTS, "custom_score", SCORE_CUTS, F.col("waterfall_in"), F.col("prism_score")))
