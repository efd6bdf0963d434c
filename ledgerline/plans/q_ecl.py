"""ECL and scorecard queries over ``fx_ecl`` and ``fx_bureau``.

Derived doubles are rounded to 6 places in both the Spark result and the
oracle, so that last-bit differences between JVM and C maths do not count.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators import ecl as E
from ledgerline.operators import scorecards as S
from ledgerline.plans import oracle_decisions as OD
from ledgerline.plans.catalog import query
from ledgerline.sources.fixtures import fixture, fixture_cte

_ECL, _BUR = fixture_cte("fx_ecl"), fixture_cte("fx_bureau")
P = E.ScenarioParams()
VINTAGES = (1, 2, 3)


def _r(df: DataFrame, cols) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), 6) for c in cols})


def _all_vintages(spark, sf_dir) -> DataFrame:
    base = fixture(spark, sf_dir, "fx_ecl")
    parts = [E.ecl_pipeline(base, v, P).withColumn("vintage", F.lit(v)) for v in VINTAGES]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


# ---------------------------------------------------------------- oracle SQL, one CTE chain per vintage


def _z(x):
    return f"coalesce({x}, 0)"


def _vintage_sql(v: int) -> str:
    bad = "bd_use = 1 OR wof = 1" if v == 2 else "bd_use = 1"
    s1 = f"""SELECT *, CAST(CASE WHEN gbx = 'X' THEN 4 WHEN {bad} THEN 5 WHEN dlq = '4' THEN 3 ELSE CAST(stage AS INTEGER) END AS INTEGER) AS stage_fix
      FROM fx_ecl"""
    if v == 3:
        first = "CASE non_def_2_c WHEN 2 THEN 3 WHEN 3 THEN 6 WHEN 4 THEN 6 WHEN 5 THEN 6 WHEN 6 THEN 999 END"
        full = "CASE non_def_2_c WHEN 2 THEN 24 WHEN 3 THEN 24 WHEN 4 THEN 24 WHEN 5 THEN 24 WHEN 6 THEN 999 END"
        adj = ("CASE non_def_2_c WHEN 2 THEN 1.568250136e0 WHEN 3 THEN 1.526799282e0 WHEN 4 THEN 1.628589246e0 "
               "WHEN 5 THEN 1.759179777e0 WHEN 6 THEN 1.0e0 END")
        s2 = f"""SELECT *, CASE WHEN stage_fix = 4 THEN 'DECEASED' WHEN stage_fix = 5 THEN 'WO' WHEN dlq IN ('4', 'A') THEN 'DEFAULT'
          WHEN non_def_2_c = 1 AND stage_fix <= 2 THEN 'PERF' WHEN non_def_2_time = 0 THEN 'DEFAULT'
          WHEN non_def_2_c > 5 THEN '>5 DEFAULTS' WHEN ({first}) IS NULL OR non_def_2_time IS NULL THEN 'DEFAULT'
          WHEN non_def_2_time < {first} THEN 'DEFAULT' WHEN non_def_2_time < {full} THEN 'PARTIAL CURE'
          WHEN non_def_2_time >= {first} THEN 'PURE CURE' ELSE 'DEFAULT' END AS cure FROM s1"""
        s3 = f"""SELECT *, CASE WHEN cure = 'PARTIAL CURE' THEN {adj} ELSE 1.0e0 END AS cure_adjustment,
          CAST(CASE WHEN stage_fix = 3 AND cure IN ('PURE CURE', 'PARTIAL CURE') THEN
             CASE WHEN dlq IN ('C', 'P', '0') THEN 1 WHEN dlq = '1' THEN 2 ELSE 3 END ELSE stage_fix END AS INTEGER) AS stage_cure FROM s2"""
        s4 = """SELECT *, CASE WHEN stage_cure = 3 OR stage_fix IN (4, 5) THEN pd3 WHEN stage_cure = 2 THEN pd2 ELSE pd1 END AS pd_use,
          CASE WHEN stage_fix IN (1, 2) THEN lgd_new ELSE lgd_curve END AS lgd_use,
          CAST(CASE WHEN stage_cure = 3 OR stage_fix IN (4, 5) THEN ttwo ELSE CASE WHEN ttwo - ttd IS NOT NULL THEN ceil(greatest(0, ttwo - ttd + 0)) END END AS INTEGER) AS avg_rem_time
          FROM s3"""
        e123 = ", ".join(
            f"(({_z('bal_total')} * {_z('pit_pd')}) * {_z(pd)} * {_z('ead')} * ({_z(lgd)} * {_z('pit_lgd')} * (1 - {_z('pwor')}))) "
            f"* pow(1 + {_z('interest_rate')}, -({_z('ttd')} + {_z('ttwo')}) / 12) AS ecl_{n}"
            for n, pd, lgd in ((1, "pd1", "lgd_new"), (2, "pd2", "lgd_new"), (3, "pd3", "lgd_curve"))
        )
        s5 = f"SELECT *, {e123} FROM s4"
        s6 = """SELECT *, CAST(CASE WHEN bal_total < 0 AND stage_cure <= 3 THEN -1
            WHEN stage_cure = 3 AND ecl_3 < ecl_2 THEN 2 ELSE stage_cure END AS INTEGER) AS updated_stage FROM s5"""
        s7 = """SELECT *, CASE WHEN updated_stage = 5 THEN bdt_all ELSE
            ((bal_total * CASE WHEN updated_stage = 1 THEN 1.0e0 ELSE pit_pd END) * pd_use * ead * (lgd_use * pit_lgd * (1 - pwor)))
            * pow(1 + interest_rate, -(ttd + ttwo) / 12) END AS ecl FROM s6"""
    else:
        s2 = "SELECT * FROM s1"
        s3 = "SELECT * FROM s2"
        s4 = """SELECT *, CASE WHEN stage_fix IN (3, 4, 5) THEN pd3 WHEN stage_fix = 2 THEN pd2 ELSE pd1 END AS pd_use,
          CASE WHEN stage_fix IN (1, 2) THEN lgd_new ELSE lgd_curve END AS lgd_use,
          CAST(CASE WHEN stage_fix IN (3, 4, 5) THEN ttwo ELSE CASE WHEN ttwo - ttd IS NOT NULL THEN ceil(greatest(0, ttwo - ttd + 2)) END END AS INTEGER) AS avg_rem_time
          FROM s3"""
        if v == 1:
            e123 = ", ".join(
                f"{_z('bal_total')} * {_z('pit_pd')} * {_z(pd)} * {_z('ead')} * {lgd} * {_z('pit_lgd')} * (1 - {_z('pwor')}) "
                f"* pow(1.0e0 + {_z('interest_rate')}, (-{_z('ttd')} - {_z('ttwo')}) / 12e0) AS ecl_{n}"
                for n, pd, lgd in ((1, "pd1", _z("lgd_new")), (2, "pd2", _z("lgd_new")), (3, "pd3", "lgd_curve"))
            )
            amount = """CASE WHEN stage_fix = 5 THEN bdt_all ELSE
              (CASE WHEN stage_fix = 1 THEN coalesce(bal_total, 0) * pit_pd ELSE coalesce(bal_total, 0) * 1.0e0 END)
              * (pd_use * ead * lgd_use * pit_lgd * (1 - pwor)) * pow(1 + interest_rate, -1 * (ttd + coalesce(ttwo, 0)) / 12) END"""
        else:
            e123 = ", ".join(
                f"bal_total * pit_pd * {pd} * ead * {lgd} * pit_lgd * (1 - pwor) "
                f"* pow(1.0e0 + interest_rate, (-ttd - ttwo) / 12e0) AS ecl_{n}"
                for n, pd, lgd in ((1, "pd1", "lgd_new"), (2, "pd2", "lgd_new"), (3, "pd3", "lgd_curve"))
            )
            amount = """CASE WHEN stage_fix = 5 AND wof = 0 THEN bdt_all ELSE
              (CASE WHEN stage_fix = 1 THEN bal_total * pit_pd ELSE bal_total * 1.0e0 END)
              * (pd_use * ead * lgd_use * pit_lgd * (1 - pwor)) * pow(1 + interest_rate, -1 * (ttd + ttwo) / 12) END"""
        s5 = f"SELECT *, {e123} FROM s4"
        s6 = "SELECT *, CAST(CASE WHEN stage_fix = 3 AND ecl_2 > ecl_3 THEN 2 ELSE stage_fix END AS INTEGER) AS updated_stage FROM s5"
        s7 = f"SELECT *, {amount} AS ecl FROM s6"
    # scenarios
    cols = []
    for s in E.SCENARIOS:
        spd, slgd = getattr(P, f"{s}_pd"), getattr(P, f"{s}_lgd")
        if v == 3:
            low, mid = f"pd1 * pit_pd * cure_adjustment * {spd!r}e0", f"pd2 * {spd!r}e0"
            lgd = f"(CASE WHEN updated_stage IN (1, 2) THEN lgd_new ELSE lgd_curve END * pit_lgd) * {slgd!r}e0"
        else:
            low = f"pd1 * pit_pd * {spd!r}e0"
            mid = f"pd2 * {spd!r}e0" if s == "base" else f"pd2 * pit_pd * {spd!r}e0"
            lgd = f"CASE WHEN updated_stage IN (1, 2) THEN lgd_new ELSE lgd_curve END * (pit_lgd * {slgd!r}e0)"
        pdx = f"CASE WHEN updated_stage IN (3, 4, 5) THEN pd3 WHEN updated_stage = 2 THEN {mid} ELSE {low} END"
        cols.append(f"CASE WHEN ({pdx}) IS NULL THEN NULL ELSE least(1.0e0, {pdx}) END AS pd_{s}")
        cols.append(f"{lgd} AS lgd_{s}")
    s8 = f"SELECT *, {', '.join(cols)} FROM s7"
    ecls = []
    for s in E.SCENARIOS:
        if v == 1:
            c = f"coalesce(bal_total, 0) * pd_{s} * ead * (lgd_{s} * (1.0e0 - pwor)) * pow(1.0e0 + interest_rate, (-ttd - coalesce(ttwo, 0)) / 12e0)"
            e = f"CASE WHEN stage_fix = 5 THEN greatest(0.0e0, bdt_all) ELSE greatest(0.0e0, coalesce({c}, 0.0e0)) END"
        elif v == 2:
            c = f"bal_total * pd_{s} * ead * (lgd_{s} * (1.0e0 - pwor)) * pow(1.0e0 + interest_rate, (-ttd - ttwo) / 12e0)"
            e = f"CASE WHEN stage_fix = 5 AND wof = 0 THEN bdt_all ELSE {c} END"
        else:
            c = (f"{_z('bal_total')} * {_z(f'pd_{s}')} * {_z('ead')} * lgd_{s} * (1 - {_z('pwor')}) "
                 f"* pow(1 + {_z('interest_rate')}, -({_z('ttd')} + {_z('ttwo')}) / 12)")
            i = f"CASE WHEN coalesce(stage_fix, 0) = 5 THEN coalesce(bdt_all, 0) ELSE {c} END"
            e = f"CASE WHEN ({i}) IS NULL THEN NULL ELSE greatest({i}, 0.0e0) END"
        ecls.append(f"CAST({e} AS DOUBLE) AS ecl_{s}")
    s9 = f"SELECT *, {', '.join(ecls)} FROM s8"
    w = [f"ecl_{s} * {getattr(P, f'{s}_weight')!r}e0" for s in E.SCENARIOS]
    if v == 1:
        w = [f"coalesce({x}, 0.0e0)" for x in w]
    s10 = f"SELECT *, {v} AS vintage, {' + '.join(w)} AS ecl_final FROM s9"
    steps = [s1, s2, s3, s4, s5, s6, s7, s8, s9, s10]
    return ",\n".join(f"v{v}_s{i + 1} AS ({q.replace(' FROM s', f' FROM v{v}_s')})" for i, q in enumerate(steps))


def _union_sql() -> str:
    ctes = ",\n".join(_vintage_sql(v) for v in VINTAGES)
    return f"WITH {_ECL},\n{ctes},\nall_v AS (" + " UNION ALL BY NAME ".join(f"SELECT * FROM v{v}_s10" for v in VINTAGES) + ")"


def _rsql(cols) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" for c in cols)


STAGE_COLS = ["stage_fix", "pd_use", "lgd_use", "avg_rem_time"]


@query("ecl_stage", oracle=_union_sql() + "\nSELECT account, vintage, stage_fix, avg_rem_time, " + _rsql(["pd_use", "lgd_use"]) + " FROM all_v")
def q_ecl_stage(spark, sf_dir):
    return _r(_all_vintages(spark, sf_dir).select("account", "vintage", *STAGE_COLS), ["pd_use", "lgd_use"])


@query("ecl_by_stage", oracle=_union_sql() + "\nSELECT account, vintage, " + _rsql(["ecl_1", "ecl_2", "ecl_3"]) + " FROM all_v")
def q_ecl_by_stage(spark, sf_dir):
    return _r(_all_vintages(spark, sf_dir).select("account", "vintage", "ecl_1", "ecl_2", "ecl_3"), ["ecl_1", "ecl_2", "ecl_3"])


@query("ecl_amount", oracle=_union_sql() + "\nSELECT account, vintage, updated_stage, " + _rsql(["ecl"]) + " FROM all_v")
def q_ecl_amount(spark, sf_dir):
    return _r(_all_vintages(spark, sf_dir).select("account", "vintage", "updated_stage", "ecl"), ["ecl"])


@query("ecl_updated_stage", oracle=_union_sql() + "\nSELECT account, vintage, stage_fix, updated_stage FROM all_v")
def q_ecl_updated_stage(spark, sf_dir):
    return _all_vintages(spark, sf_dir).select("account", "vintage", "stage_fix", "updated_stage")


SCEN_COLS = [f"{k}_{s}" for s in E.SCENARIOS for k in ("pd", "lgd", "ecl")]


@query("ecl_scenarios", oracle=_union_sql() + "\nSELECT account, vintage, " + _rsql(SCEN_COLS) + " FROM all_v")
def q_ecl_scenarios(spark, sf_dir):
    return _r(_all_vintages(spark, sf_dir).select("account", "vintage", *SCEN_COLS), SCEN_COLS)


@query("ecl_final", oracle=_union_sql() + "\nSELECT account, vintage, " + _rsql(["ecl_final"]) + " FROM all_v")
def q_ecl_final(spark, sf_dir):
    return _r(_all_vintages(spark, sf_dir).select("account", "vintage", "ecl_final"), ["ecl_final"])


@query(
    "ecl_cure",
    oracle=f"WITH {_ECL},\n{_vintage_sql(3)}\nSELECT account, stage_fix, cure, stage_cure, round(cure_adjustment, 6) AS cure_adjustment FROM v3_s10",
)
def q_ecl_cure(spark, sf_dir):
    out = E.stage_columns(fixture(spark, sf_dir, "fx_ecl"), 3)
    return _r(out.select("account", "stage_fix", "cure", "stage_cure", "cure_adjustment"), ["cure_adjustment"])


@query(
    "ecl_summary",
    oracle=_union_sql()
    + """
SELECT vintage, updated_stage, count(*) AS accounts, round(sum(bal_total), 6) AS balance, round(sum(ecl), 6) AS ecl,
       round(sum(ecl_final), 6) AS ecl_final FROM all_v GROUP BY vintage, updated_stage""",
)
def q_ecl_summary(spark, sf_dir):
    return _r(E.ecl_summary(_all_vintages(spark, sf_dir)), ["balance", "ecl", "ecl_final"])


# ---------------------------------------------------------------- scorecards

# fixture columns for each scorecard attribute
SCORE_INPUTS = {
    "cam": {"num0delq1y": "num0delq1y", "percpay2y": "percpay2y", "maxdelq180d": "maxdelq", "avgmob": "avgmob",
            "percutil": "percutil", "maxdelqever": "maxdelq", "perc0delq90": "perc0delq90", "trades2y": "trades180"},
    "est": {"perc0delq90": "perc0delq90", "trades180": "trades180", "num0delq1y": "num0delq1y", "maxdelq1y": "maxdelq",
            "percpay2y": "percpay2y", "util_lt10": "util_lt10", "percutil": "percutil", "avgmob": "avgmob"},
    "new": {"num0delq1y": "num0delq1y", "percpay2y": "percpay2y", "avgmob": "avgmob", "maxdelq180d": "maxdelq",
            "trades180": "trades180", "util_lt10": "util_lt10", "perc0delq90": "perc0delq90", "maxdelqever": "maxdelq"},
}


def _points_sql(attr, c: str) -> str:
    if isinstance(attr, OD.Bins):
        parts = [f"WHEN {c} IS NULL THEN {attr.null}"]
        parts += [f"WHEN {c} {op} {b} THEN {p}" for op, b, p in attr.bins]
        parts.append(f"WHEN {c} >= {attr.bins[-1][1]} THEN {attr.rest}")
        return "CASE " + " ".join(parts) + " END"
    code = f"upper(replace({c}, ' ', ''))"
    if attr.null == "blank":
        code = f"coalesce({code}, '')"
    parts = [f"WHEN {code} = '' THEN {attr.blank}"]
    for codes, p in attr.groups:
        parts.append(f"WHEN {code} IN ({', '.join(repr(x) for x in codes)}) THEN {p}")
    return "CASE " + " ".join(parts) + " END"


def _score_sql(card: str) -> str:
    attrs, inputs = OD.SCORECARDS[card], SCORE_INPUTS[card]
    total = " + ".join(f"coalesce({_points_sql(a, inputs[a.name])}, 0)" for a in attrs)
    voids = [f"{inputs[a.name]} IS NULL" for a in attrs if isinstance(a, OD.Codes) and a.null == "void"]
    t = f"CAST({total} AS INTEGER)"
    if voids:
        t = f"CASE WHEN NOT ({' OR '.join(voids)}) THEN {t} END"
    k = 20 / math.log(2)
    return f"""WITH {_BUR}, s AS (SELECT applicant, {t} AS sc FROM fx_bureau),
    l AS (SELECT applicant, sc, (sc - 582) / {k!r} AS lo FROM s)
    SELECT applicant, sc AS {card}_customer_score, round(lo, 6) AS {card}_customer_score_lnodds,
      round(exp(lo) / (1 + exp(lo)), 6) AS {card}_customer_score_prob FROM l"""


def _score_query(card: str):
    def run(spark, sf_dir):
        df = S.score(fixture(spark, sf_dir, "fx_bureau").select("applicant", *sorted(set(SCORE_INPUTS[card].values()))),
                     card, SCORE_INPUTS[card])
        pre = f"{card}_customer_score"
        return _r(df.select("applicant", pre, f"{pre}_lnodds", f"{pre}_prob"), [f"{pre}_lnodds", f"{pre}_prob"])

    return run


for _key, _card in (("score_campaign", "cam"), ("score_established", "est"), ("score_new", "new")):
    query(_key, oracle=_score_sql(_card))(_score_query(_card))
