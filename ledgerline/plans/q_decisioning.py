"""Decision-services waterfall and report over applications, bureau scores and account performance.

Applications take their bureau scores from the three scorecards (joined on
the applicant key) and, for the report, the goods/bads of the applicant's
account and whether the application reached an activation.  Policy inputs
the fixture does not carry (fraud, dispute, sequestration, emigration,
notices, debt review) are the literal "N".
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators import decisioning as D
from ledgerline.operators import filters as FL
from ledgerline.operators import scorecards as S
from ledgerline.plans import oracle_decisions as OD
from ledgerline.plans import oracle_tables as OT
from ledgerline.plans.catalog import query
from ledgerline.plans.q_applications import _grade_sql
from ledgerline.plans.q_ecl import SCORE_INPUTS, _points_sql
from ledgerline.plans.q_portfolio import _VIEW_SQL, account_view
from ledgerline.sources.fixtures import fixture, fixture_cte

_APPS, _BUR, _ACT = fixture_cte("fx_applications"), fixture_cte("fx_bureau"), fixture_cte("fx_activations")
OUT_COLS = (["app_record_number", "decision_services_segment", "decision_services_waterfall", "decision_services_outcome",
             "decision_services_matrix", "decision_services_risk_grade"] + [*OD.OUTPUT_FLAGS, *OD.ACTIVATION_FLAGS])


def bureau_scores(spark, sf_dir) -> DataFrame:
    b = fixture(spark, sf_dir, "fx_bureau")
    for card in ("new", "est", "cam"):
        b = S.score(b, card, SCORE_INPUTS[card])
    return b.select(F.col("applicant").alias("idkey"), F.col("new_customer_score"), F.col("est_customer_score"),
                    F.col("cam_customer_score"))


def decision_input(spark, sf_dir) -> DataFrame:
    apps = FL.filter_one_hots(fixture(spark, sf_dir, "fx_applications"), channel="channel", outcome="decision_outcome",
                              service=None, risk_grade=None)
    apps = apps.join(bureau_scores(spark, sf_dir), "idkey", "left")
    return apps.withColumns(
        {
            "all_timeoldesttrade": F.col("time_oldest_trade"),
            "app_customer_state": F.col("customer_state"),
            "cst_deceased": F.col("deceased"),
            "cst_customerage": F.col("customer_age"),
            "app_gross_income": F.col("gross_income"),
            "cbx_prism_tm": F.col("prism_score"),
            "ntc_accept_final_score_v01": F.col("custom_score"),
            "ntc_accept_risk_score_v01": F.col("prism_score"),
            "all_perc0delq90days": F.col("perc0delq90"),
            "all_numpayments90days": F.col("numpay90"),
            "app_subscriptions": F.col("subscription_limit"),
        }
    )


# ---------------------------------------------------------------- oracle SQL

def _score_expr(card: str) -> str:
    attrs, inputs = OD.SCORECARDS[card], SCORE_INPUTS[card]
    total = " + ".join(f"coalesce({_points_sql(a, inputs[a.name])}, 0)" for a in attrs)
    voids = [f"{inputs[a.name]} IS NULL" for a in attrs if isinstance(a, OD.Codes) and a.null == "void"]
    t = f"CAST({total} AS INTEGER)"
    return f"CASE WHEN NOT ({' OR '.join(voids)}) THEN {t} END" if voids else t


def _band(x: str, cuts) -> str:
    parts = [f"WHEN {x} < {cuts[0]} THEN '001'"] + [f"WHEN {x} < {cuts[i]} THEN '{cuts[i - 1]}'" for i in range(1, len(cuts))]
    return f"CASE WHEN {x} IS NULL THEN NULL " + " ".join(parts) + f" ELSE '{cuts[-1]}' END"


def _claim_sql(seg, states) -> str:
    if states is None:
        return "coalesce(all_timeoldesttrade < 3, false)"
    c = "coalesce(app_customer_state IN (" + ", ".join(f"'{s}'" for s in states) + "), false)"
    return f"({c} AND {seg.channel} IS NOT NULL)" if seg.channel else c


def _policy_sql(seg, strict: bool) -> str:
    whens = []
    for c, label in OT.POLICY:
        young = f"coalesce({c} < 1800, {'true' if strict else 'false'})"
        cond = young if c == "cst_customerage" else f"coalesce({c} = 'Y', false)"
        whens.append(f"WHEN {cond} THEN '{label}'")
    if seg.debt_review:
        whens.append(f"WHEN coalesce({OT.DEBT_REVIEW[0]} = 'Y', false) THEN '{OT.DEBT_REVIEW[1]}'")
    if seg.income:
        low = "(app_gross_income IS NULL OR app_gross_income < 1500)" if strict else "coalesce(app_gross_income < 1500, false)"
        whens.append(f"WHEN {low} THEN '{OT.LOW_INCOME}'")
    for c, op, v, label in seg.checks:
        cond = f"{c} IS NULL" if op == "null" else f"coalesce({c} {'<' if op == '<' else '='} {v}, false)"
        whens.append(f"WHEN {cond} THEN '{label}'")
    return "CASE " + " ".join(whens) + " END"


def _waterfall_sql(fixed: bool = False) -> str:
    sc = {c: f"({_score_expr(c)})" for c in ("new", "est", "cam")}
    oh_ch = "upper(coalesce(channel, ''))"
    ch_idx = "CASE " + " ".join(f"WHEN instr({oh_ch}, '{w}') > 0 THEN {i + 1}" for i, (w, _) in enumerate(OT.CHANNELS)) + " END"
    ch_cols = ", ".join(f"CASE WHEN ({ch_idx}) = {i + 1} THEN 1 END AS {n}" for i, (_, n) in enumerate(OT.CHANNELS))
    ctes = [f"""bs AS (SELECT applicant AS idkey, {sc['new']} AS new_customer_score, {sc['est']} AS est_customer_score,
        {sc['cam']} AS cam_customer_score FROM fx_bureau)""",
            f"""inp AS (SELECT a.*, bs.new_customer_score, bs.est_customer_score, bs.cam_customer_score, {ch_cols},
        a.time_oldest_trade AS all_timeoldesttrade, a.customer_state AS app_customer_state, a.deceased AS cst_deceased,
        a.customer_age AS cst_customerage, a.gross_income AS app_gross_income,
        a.prism_score AS cbx_prism_tm, a.custom_score AS ntc_accept_final_score_v01, a.prism_score AS ntc_accept_risk_score_v01,
        a.perc0delq90 AS all_perc0delq90days, a.numpay90 AS all_numpayments90days, a.subscription_limit AS app_subscriptions,
        CAST(NULL AS VARCHAR) AS seg, {', '.join(f'CAST(NULL AS INTEGER) AS {f}' for f in OD.OUTPUT_FLAGS)},
        CAST(NULL AS VARCHAR) AS wf, CAST(NULL AS VARCHAR) AS outc, CAST(NULL AS VARCHAR) AS mat, CAST(NULL AS VARCHAR) AS grade
      FROM fx_applications a LEFT JOIN bs ON a.idkey = bs.idkey)"""]
    prev = "inp"
    steps = list(OD.SEGMENTS)
    for i, code, states, matrix in OD.INTENDED if fixed else ():
        steps[i] = steps[i]._replace(code=code, states=states, matrix_states=matrix)
    for i, seg in enumerate(steps):
        claim = _claim_sql(seg, seg.states)
        ctes.append(f"""s{i}a AS (SELECT * REPLACE (CASE WHEN {claim} THEN '{seg.code}' ELSE seg END AS seg,
            CASE WHEN {claim} THEN 1 ELSE {seg.flag} END AS {seg.flag},
            CASE WHEN {claim} THEN coalesce({_policy_sql(seg, i == OD.STRICT)}, wf) ELSE wf END AS wf) FROM {prev})""")
        computed = _claim_sql(seg, seg.matrix_states if seg.matrix_states is not None else seg.states)
        applied = _claim_sql(seg, seg.states) if i == OD.CROSSED and not fixed else computed
        empty = "(wf IS NULL OR wf = '')"
        mat = f"{_band('cbx_prism_tm', seg.prism_cuts)} || 'x' || {_band(seg.score, seg.score_cuts)}"
        ctes.append(f"""s{i}b AS (SELECT * REPLACE (
            CASE WHEN {applied} THEN CASE WHEN {computed} THEN CASE WHEN {empty} THEN 'Approve {seg.approves}' ELSE 'Decline' END END ELSE outc END AS outc,
            CASE WHEN {applied} THEN CASE WHEN {computed} THEN CASE WHEN {empty} THEN 'P. Pass Credit Policies' ELSE wf END END ELSE wf END AS wf,
            CASE WHEN {applied} THEN CASE WHEN {computed} THEN {mat} END ELSE mat END AS mat) FROM s{i}a)""")
        prev = f"s{i}b"
        if seg.grades:
            g = "CASE " + " ".join(f"WHEN {applied} AND mat = '{k}' THEN '{v}'" for k, v in seg.grades) + " ELSE grade END"
            ctes.append(f"s{i}c AS (SELECT * REPLACE ({g} AS grade) FROM {prev})")
            prev = f"s{i}c"
    ctes.append(f"""fin AS (SELECT * REPLACE (coalesce(seg, 'XXX') AS seg) FROM {prev})""")
    ctes.append("""fin2 AS (SELECT * REPLACE (CASE WHEN seg = 'XXX' THEN 'Decline' ELSE outc END AS outc,
        CASE WHEN seg = 'XXX' THEN 1 ELSE filter_xxxxxx_state END AS filter_xxxxxx_state) FROM fin)""")
    idx = ("CASE WHEN coalesce(customer_state, '') = 'IMM MOB 00-05' THEN 1 WHEN coalesce(filter_clear_state, 0) = 1 THEN 2 "
           "WHEN coalesce(filter_responsible_state, 0) = 1 THEN 3 WHEN coalesce(filter_erratic_state, 0) = 1 THEN 4 "
           "WHEN coalesce(filter_arrears_state, 0) = 1 THEN 5 ELSE 6 END")
    acts = ", ".join(f"CAST(CASE WHEN app_subscriptions IS NOT NULL AND {idx} = {i + 1} THEN 1 END AS INTEGER) AS {n}"
                     for i, n in enumerate(OD.ACTIVATION_FLAGS))
    ctes.append(f"""dw AS (SELECT *, seg AS decision_services_segment, wf AS decision_services_waterfall, outc AS decision_services_outcome,
        mat AS decision_services_matrix, grade AS decision_services_risk_grade, {acts} FROM fin2)""")
    return f"WITH {_APPS}, {_BUR},\n" + ",\n".join(ctes)


@query("decision_waterfall", oracle=_waterfall_sql() + "\nSELECT " + ", ".join(OUT_COLS) + " FROM dw")
def q_decision_waterfall(spark, sf_dir):
    return D.decision_waterfall(decision_input(spark, sf_dir)).select(*OUT_COLS)


@query("decision_waterfall_fixed", oracle=_waterfall_sql(fixed=True) + "\nSELECT " + ", ".join(OUT_COLS) + " FROM dw")
def q_decision_waterfall_fixed(spark, sf_dir):
    """The intended segments: credit balance by its own rules, the immature matrix for its own state."""
    return D.decision_waterfall(decision_input(spark, sf_dir), fixed=True).select(*OUT_COLS)


# ---------------------------------------------------------------- report

REPORT_VAR = "channel"


def report_input(spark, sf_dir) -> DataFrame:
    dw = D.decision_waterfall(decision_input(spark, sf_dir))
    acts = fixture(spark, sf_dir, "fx_activations").groupBy("app_record_number").agg(F.lit(1).alias("_act"))
    view = account_view(spark, sf_dir).select(
        F.col("account").alias("idkey"), F.col("accounts").alias("app_accounts"),
        *[F.col(f"{k}_{n}").alias(f"{k}{n}") for n in (1, 3, 6, 9, 12) for k in ("goods", "bads")])
    df = dw.join(acts, "app_record_number", "left").join(view, "idkey", "left")
    has = F.col("_act").isNotNull()
    cols = {}
    for o in ("approved", "referred", "declined"):
        oc = F.col(f"filter_decision_outcome_{o}").isNotNull()
        cols[f"filter_{o}_with_activations"] = F.when(oc & has, F.lit(1))
        cols[f"filter_{o}_no_activations"] = F.when(oc & ~has, F.lit(1))
    for k in (1, 3, 6, 9, 12):
        cols[f"badrate{k}m"] = F.lit(None).cast("double")
    src = {"app_customer_score": "custom_score", "new_customer_score": "new_customer_score", "cam_customer_score": "cam_customer_score",
           "est_customer_score": "est_customer_score", "cbx_prism_tm": "cbx_prism_tm",
           "ntc_accept_risk_score_v01": "ntc_accept_risk_score_v01", "ntc_accept_final_score_v01": "ntc_accept_final_score_v01",
           "app_subscription_limit": "subscription_limit", "app_gross_income": "gross_income"}
    for name, c in src.items():
        cols[name] = F.col(c)
        cols[f"{name}_cnt"] = F.when(F.col(c).isNotNull(), F.lit(1))
    cols["app_predicted_income"] = F.lit(None).cast("long")
    cols["app_predicted_income_cnt"] = F.lit(None).cast("int")
    return df.withColumns(cols)


def _report_sql() -> str:
    base = _waterfall_sql().replace("WITH ", f"WITH {_ACT}, ", 1).replace(_BUR, _BUR + ",\n" + _VIEW_SQL.replace("WITH ", "", 1), 1)
    srcs = {"app_customer_score": "custom_score", "new_customer_score": "new_customer_score", "cam_customer_score": "cam_customer_score",
            "est_customer_score": "est_customer_score", "cbx_prism_tm": "cbx_prism_tm",
            "ntc_accept_risk_score_v01": "ntc_accept_risk_score_v01", "ntc_accept_final_score_v01": "ntc_accept_final_score_v01",
            "app_subscription_limit": "subscription_limit", "app_gross_income": "gross_income"}
    per_app = [f"CASE WHEN filter_decision_outcome_{o} IS NOT NULL AND act IS NOT NULL THEN 1 END AS filter_{o}_with_activations, "
               f"CASE WHEN filter_decision_outcome_{o} IS NOT NULL AND act IS NULL THEN 1 END AS filter_{o}_no_activations"
               for o in ("approved", "referred", "declined")]
    per_app += [f"CAST(NULL AS DOUBLE) AS badrate{k}m" for k in (1, 3, 6, 9, 12)]
    per_app += [f"{c} AS r_{n}, CASE WHEN {c} IS NOT NULL THEN 1 END AS r_{n}_cnt" for n, c in srcs.items()]
    per_app += ["CAST(NULL AS BIGINT) AS r_app_predicted_income", "CAST(NULL AS INTEGER) AS r_app_predicted_income_cnt"]
    o = "upper(coalesce(decision_outcome, ''))"
    outcome_flags = (f"CASE WHEN {o} = 'APPROVE' THEN 1 END AS filter_decision_outcome_approved, "
                     f"CASE WHEN {o} = 'REFER' THEN 1 END AS filter_decision_outcome_referred, "
                     f"CASE WHEN {o} = 'DECLINE' THEN 1 END AS filter_decision_outcome_declined")
    goods = ", ".join(f"v.goods_{n} AS goods{n}, v.bads_{n} AS bads{n}" for n in (1, 3, 6, 9, 12))
    ri = f"""dwo AS (SELECT *, {outcome_flags} FROM dw),
ri0 AS (SELECT dwo.*, 1 AS freq, v.accounts AS app_accounts, {goods}, ac.act
      FROM dwo LEFT JOIN (SELECT app_record_number, 1 AS act FROM fx_activations GROUP BY app_record_number) ac
        ON dwo.app_record_number = ac.app_record_number
      LEFT JOIN acct v ON dwo.idkey = v.account),
ri AS (SELECT *, {', '.join(per_app)} FROM ri0)"""
    measure_src = {m: (f"r_{m}" if (m.replace("_cnt", "") in srcs or m.startswith("app_predicted_income")) else m) for m in OD.REPORT_MEASURES}
    sums = ", ".join(f"sum({measure_src[m]}) AS s_{m}" for m in OD.REPORT_MEASURES)
    keys = f"decision_services_segment, decision_services_waterfall, decision_services_outcome, {REPORT_VAR}"
    agg = f"""agg AS (SELECT {keys}, {sums} FROM ri GROUP BY {keys})"""
    exprs = {m: f"s_{m}" for m in OD.REPORT_MEASURES if m != "freq"}
    apps = "(s_filter_decision_outcome_approved + s_filter_decision_outcome_referred + s_filter_decision_outcome_declined)"
    for o2 in ("approved", "referred", "declined"):
        exprs[f"filter_decision_outcome_{o2}"] = f"CASE WHEN {apps} IS NOT NULL THEN 100 * s_filter_decision_outcome_{o2} / {apps} END"
        w, n = f"s_filter_{o2}_with_activations", f"s_filter_{o2}_no_activations"
        exprs[f"filter_{o2}_with_activations"] = f"CASE WHEN {w} IS NOT NULL THEN 100 * {w} / ({w} + {n}) END"
    for k in (1, 3, 6, 9, 12):
        exprs[f"badrate{k}m"] = (f"CASE WHEN s_goods{k} + s_bads{k} > 50 AND s_app_accounts >= 50 "
                                 f"THEN (1000 * s_bads{k} / CAST(s_goods{k} + s_bads{k} AS INTEGER)) / 10 END")
    for s_ in OD.SCORE_AVERAGES:
        exprs[s_] = f"CASE WHEN s_{s_}_cnt IS NOT NULL THEN CAST(trunc(s_{s_} / s_{s_}_cnt) AS INTEGER) END"
    met = f"met AS (SELECT {keys}, s_freq AS applicants, {', '.join(f'{v} AS {k}' for k, v in exprs.items())} FROM agg)"
    g12, g9, g6 = (_grade_sql(f"badrate{n}m", OT.MANDATE[n]) for n in (12, 9, 6))
    m = f"""CASE WHEN badrate12m IS NOT NULL AND badrate9m IS NOT NULL AND badrate6m IS NOT NULL THEN trunc(10 * ({g12} + {g9} + {g6}) / 3) / 10e0
      WHEN badrate12m IS NOT NULL AND badrate9m IS NOT NULL THEN trunc(10 * ({g12} + {g9}) / 2) / 10e0
      WHEN badrate9m IS NOT NULL AND badrate6m IS NOT NULL THEN trunc(10 * ({g9} + {g6}) / 2) / 10e0
      WHEN badrate12m IS NOT NULL THEN badrate12m WHEN badrate9m IS NOT NULL THEN badrate9m WHEN badrate6m IS NOT NULL THEN badrate6m END"""
    final = f"""SELECT * EXCLUDE ({', '.join(f'badrate{k}m' for k in (1, 3, 6, 9, 12))}, {', '.join(f'filter_decision_outcome_{x}' for x in ('approved', 'referred', 'declined'))},
      {', '.join(f'filter_{x}_with_activations' for x in ('approved', 'referred', 'declined'))}),
      {', '.join(f'round(badrate{k}m, 6) AS badrate{k}m' for k in (1, 3, 6, 9, 12))},
      {', '.join(f'round(filter_decision_outcome_{x}, 6) AS filter_decision_outcome_{x}' for x in ('approved', 'referred', 'declined'))},
      {', '.join(f'round(filter_{x}_with_activations, 6) AS filter_{x}_with_activations' for x in ('approved', 'referred', 'declined'))},
      CAST(CASE WHEN coalesce(applicants, 0) >= 100 AND coalesce(app_accounts, 0) >= 50 THEN {m} END AS FLOAT) AS risk_grade_mandate
    FROM met"""
    return base + ",\n" + ri + ",\n" + agg + ",\n" + met + "\n" + final


ROUNDED = ([f"badrate{k}m" for k in (1, 3, 6, 9, 12)] + [f"filter_decision_outcome_{x}" for x in ("approved", "referred", "declined")]
           + [f"filter_{x}_with_activations" for x in ("approved", "referred", "declined")])


@query("decision_report", oracle=_report_sql())
def q_decision_report(spark, sf_dir):
    out = D.decision_report(report_input(spark, sf_dir), REPORT_VAR)
    return out.withColumns({c: F.round(c, 6) for c in ROUNDED})
