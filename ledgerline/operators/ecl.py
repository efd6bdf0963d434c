"""Expected credit loss in three vintages, as one projection chain per vintage.

Vintage 1 and 2 share the stage/PD/ECL structure (2 adds the write-off flag
and drops NULL defaults); vintage 3 adds the cure model (lookup by default
count) and stages on the cured stage.  ``ecl_pipeline`` adds every column;
the stage functions below are usable one by one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F



@dataclass(frozen=True)
class ScenarioParams:
    base_pd: float = 1.0
    upside_pd: float = 0.9
    downside_pd: float = 1.15
    base_lgd: float = 1.0
    upside_lgd: float = 0.95
    downside_lgd: float = 1.1
    base_weight: float = 0.5
    upside_weight: float = 0.25
    downside_weight: float = 0.25


# Cure lookup by number of defaults (first cure months, adjustment, full cure months).
CURE_TABLE = [
    (2, "1st Default", 3, 1.568250136, 24),
    (3, "2nd Default", 6, 1.526799282, 24),
    (4, "3rd Default", 6, 1.628589246, 24),
    (5, "4th Default", 6, 1.759179777, 24),
    (6, "5th Default", 999, 1.0, 999),
]

# input column names (fx_ecl)
COLS = dict(
    bal="bal_total", gbx="gbx", bd_use="bd_use", wof="wof", dlq="dlq", stage="stage", n_def="non_def_2_c",
    t_def="non_def_2_time", pd1="pd1", pd2="pd2", pd3="pd3", ead="ead", lgd_new="lgd_new", lgd_curve="lgd_curve",
    pit_pd="pit_pd", pit_lgd="pit_lgd", ttwo="ttwo", ttd="ttd", pwor="pwor", rate="interest_rate", bdt="bdt_all",
    avg_rem="ttwo",
)


def _c(k: str) -> str:
    return f"`{COLS[k]}`"


def _z(x: str) -> str:
    return f"coalesce({x}, 0)"


def _d(v: float) -> str:
    """A double literal (a bare decimal literal would be DECIMAL in Spark SQL)."""
    return f"{float(v)!r}D"


def _lookup(col_: str, idx: int) -> str:
    pairs = ", ".join(f"{row[0]}, {row[idx]!r}" + ("D" if isinstance(row[idx], float) else "") for row in CURE_TABLE)
    return f"try_element_at(map({pairs}), {col_})"


def _discount(rate: str, ttd: str, ttwo: str) -> str:
    return f"pow(1.0D + {rate}, (-{ttd} - {ttwo}) / 12.0D)"


def _exprs(df: DataFrame, cols: dict[str, str]) -> DataFrame:
    return df.withColumns({k: F.expr(v) for k, v in cols.items()})


def stage_columns(df: DataFrame, vintage: int, cure: bool = True) -> DataFrame:
    """stage_fix (+ V3 cure, cure_adjustment, stage_cure), pd_use, avg_rem_time."""
    gbx, bd, dlq, stage = _c("gbx"), _c("bd_use"), _c("dlq"), _c("stage")
    bad = f"({bd} = 1 OR {_c('wof')} = 1)" if vintage == 2 else f"{bd} = 1"
    stage_fix = f"CAST(CASE WHEN {gbx} = 'X' THEN 4 WHEN {bad} THEN 5 WHEN {dlq} = '4' THEN 3 ELSE CAST({stage} AS INT) END AS INT)"
    out = _exprs(df, {"stage_fix": stage_fix})
    sf = "stage_fix"
    if vintage == 3:
        n, t = _c("n_def"), _c("t_def")
        first_cure, full_cure = _lookup(n, 2), _lookup(n, 4)
        cure_state = f"""CASE WHEN {sf} = 4 THEN 'DECEASED' WHEN {sf} = 5 THEN 'WO' WHEN {dlq} IN ('4', 'A') THEN 'DEFAULT'
            WHEN {n} = 1 AND {sf} <= 2 THEN 'PERF' WHEN {t} = 0 THEN 'DEFAULT' WHEN {n} > 5 THEN '>5 DEFAULTS'
            WHEN {n} IS NULL OR {t} IS NULL OR {first_cure} IS NULL THEN 'DEFAULT'
            WHEN {t} < {first_cure} THEN 'DEFAULT' WHEN {t} < {full_cure} THEN 'PARTIAL CURE'
            WHEN {t} >= {first_cure} THEN 'PURE CURE' ELSE 'DEFAULT' END"""
        out = _exprs(out, {"cure": cure_state})
        adj = "1.0D" if not cure else f"CASE WHEN cure = 'PARTIAL CURE' THEN CAST({_lookup(n, 3)} AS DOUBLE) ELSE 1.0D END"
        stage_cure = (f"CAST(CASE WHEN {sf} = 3 AND cure IN ('PURE CURE', 'PARTIAL CURE') THEN "
                      f"CASE WHEN {dlq} IN ('C', 'P', '0') THEN 1 WHEN {dlq} = '1' THEN 2 ELSE 3 END ELSE {sf} END AS INT)")
        out = _exprs(out, {"cure_adjustment": adj, "stage_cure": stage_cure})
        st = "stage_cure" if cure else sf
        hi = f"({st} = 3 OR {sf} IN (4, 5))"
        pd_use = f"CASE WHEN {hi} THEN {_c('pd3')} WHEN {st} = 2 THEN {_c('pd2')} ELSE {_c('pd1')} END"
        rem = f"({_c('avg_rem')} - {_c('ttd')} + 0)"
        avg = f"CASE WHEN {hi} THEN {_c('avg_rem')} ELSE CASE WHEN {rem} IS NOT NULL THEN ceil(greatest(0, {rem})) END END"
    else:
        pd_use = f"CASE WHEN {sf} IN (3, 4, 5) THEN {_c('pd3')} WHEN {sf} = 2 THEN {_c('pd2')} ELSE {_c('pd1')} END"
        rem = f"({_c('avg_rem')} - {_c('ttd')} + 2)"
        avg = f"CASE WHEN {sf} IN (3, 4, 5) THEN {_c('avg_rem')} ELSE CASE WHEN {rem} IS NOT NULL THEN ceil(greatest(0, {rem})) END END"
    lgd_use = f"CASE WHEN {sf} IN (1, 2) THEN {_c('lgd_new')} ELSE {_c('lgd_curve')} END"
    return _exprs(out, {"pd_use": pd_use, "lgd_use": lgd_use, "avg_rem_time": f"CAST({avg} AS INT)"})


def ecl_by_stage(df: DataFrame, vintage: int) -> DataFrame:
    """ecl_1, ecl_2, ecl_3: loss if the account were in stage 1, 2 or 3."""
    bal, pit_pd, ead, lgd_new, lgd_curve = _c("bal"), _c("pit_pd"), _c("ead"), _c("lgd_new"), _c("lgd_curve")
    pit_lgd, pwor, rate, ttd, ttwo = _c("pit_lgd"), _c("pwor"), _c("rate"), _c("ttd"), _c("ttwo")
    pds = {1: _c("pd1"), 2: _c("pd2"), 3: _c("pd3")}
    out = {}
    for n in (1, 2, 3):
        if vintage == 1:
            lgd = _z(lgd_new) if n < 3 else lgd_curve
            a = f"{_z(bal)} * {_z(pit_pd)} * {_z(pds[n])} * {_z(ead)} * {lgd} * {_z(pit_lgd)} * (1 - {_z(pwor)})"
            b = _discount(_z(rate), _z(ttd), _z(ttwo))
        elif vintage == 2:
            lgd = lgd_new if n < 3 else lgd_curve
            a = f"{bal} * {pit_pd} * {pds[n]} * {ead} * {lgd} * {pit_lgd} * (1 - {pwor})"
            b = _discount(rate, ttd, ttwo)
        else:
            lgd = _z(lgd_new if n < 3 else lgd_curve)
            a = f"({_z(bal)} * {_z(pit_pd)}) * {_z(pds[n])} * {_z(ead)} * ({lgd} * {_z(pit_lgd)} * (1 - {_z(pwor)}))"
            b = f"pow(1 + {_z(rate)}, -({_z(ttd)} + {_z(ttwo)}) / 12)"
        out[f"ecl_{n}"] = f"({a}) * {b}"
    return _exprs(df, out)


def updated_stage(df: DataFrame, vintage: int, cure: bool = True) -> DataFrame:
    if vintage in (1, 2):
        us = "CASE WHEN stage_fix = 3 AND ecl_2 > ecl_3 THEN 2 ELSE stage_fix END"
    else:
        st = "stage_cure" if cure else "stage_fix"
        us = (f"CASE WHEN {_c('bal')} < 0 AND stage_cure <= 3 THEN -1 "
              f"ELSE CASE WHEN {st} = 3 AND ecl_3 < ecl_2 THEN 2 ELSE {st} END END")
    return _exprs(df, {"updated_stage": f"CAST({us} AS INT)"})


def ecl_amount(df: DataFrame, vintage: int) -> DataFrame:
    """The account's ECL at its own stage (bad-debt amount in stage 5)."""
    bal, pit_pd, ead, pit_lgd, pwor = _c("bal"), _c("pit_pd"), _c("ead"), _c("pit_lgd"), _c("pwor")
    rate, ttd, ttwo, bdt, wof = _c("rate"), _c("ttd"), _c("ttwo"), _c("bdt"), _c("wof")
    if vintage == 1:
        a = f"(pd_use * {ead} * lgd_use * {pit_lgd} * (1 - {pwor}))"
        b = f"pow(1 + {rate}, -1 * ({ttd} + {_z(ttwo)}) / 12)"
        k = f"CASE WHEN stage_fix = 1 THEN {_z(bal)} * {pit_pd} ELSE {_z(bal)} * 1.0D END"
        e = f"CASE WHEN stage_fix = 5 THEN {bdt} ELSE ({k}) * {a} * {b} END"
    elif vintage == 2:
        a = f"(pd_use * {ead} * lgd_use * {pit_lgd} * (1 - {pwor}))"
        b = f"pow(1 + {rate}, -1 * ({ttd} + {ttwo}) / 12)"
        k = f"CASE WHEN stage_fix = 1 THEN {bal} * {pit_pd} ELSE {bal} * 1.0D END"
        e = f"CASE WHEN stage_fix = 5 AND {wof} = 0 THEN {bdt} ELSE ({k}) * {a} * {b} END"
    else:
        pit = f"CASE WHEN updated_stage = 1 THEN 1.0D ELSE {pit_pd} END"
        a = f"({bal} * {pit}) * pd_use * {ead} * (lgd_use * {pit_lgd} * (1 - {pwor}))"
        b = f"pow(1 + {rate}, -({ttd} + {ttwo}) / 12)"
        e = f"CASE WHEN updated_stage = 5 THEN {bdt} ELSE ({a}) * {b} END"
    return _exprs(df, {"ecl": f"CAST({e} AS DOUBLE)"})


SCENARIOS = ("base", "upside", "downside")


def ecl_scenarios(df: DataFrame, vintage: int, params: ScenarioParams = ScenarioParams()) -> DataFrame:
    """PD, LGD and ECL under the base, upside and downside scenarios."""
    pd1, pd2, pd3, pit_pd = _c("pd1"), _c("pd2"), _c("pd3"), _c("pit_pd")
    bal, ead, pwor, rate, ttd, ttwo, bdt, wof = (_c(k) for k in ("bal", "ead", "pwor", "rate", "ttd", "ttwo", "bdt", "wof"))
    out = {}
    for s in SCENARIOS:
        spd, slgd = _d(getattr(params, f"{s}_pd")), _d(getattr(params, f"{s}_lgd"))
        if vintage == 3:
            low, mid = f"{pd1} * {pit_pd} * cure_adjustment * {spd}", f"{pd2} * {spd}"
        else:
            low = f"{pd1} * {pit_pd} * {spd}"
            mid = f"{pd2} * {spd}" if s == "base" else f"{pd2} * {pit_pd} * {spd}"
        pdx = f"CASE WHEN updated_stage IN (3, 4, 5) THEN {pd3} WHEN updated_stage = 2 THEN {mid} ELSE {low} END"
        out[f"pd_{s}"] = f"CASE WHEN ({pdx}) IS NOT NULL THEN least(1.0D, {pdx}) END"
        base_lgd = f"CASE WHEN updated_stage IN (1, 2) THEN {_c('lgd_new')} ELSE {_c('lgd_curve')} END"
        out[f"lgd_{s}"] = (f"(({base_lgd}) * {_c('pit_lgd')}) * {slgd}" if vintage == 3
                           else f"({base_lgd}) * ({_c('pit_lgd')} * {slgd})")
    staged = _exprs(df, out)
    ecl = {}
    for s in SCENARIOS:
        pdv, lgdv = f"pd_{s}", f"lgd_{s}"
        if vintage == 1:
            c = f"{_z(bal)} * {pdv} * {ead} * ({lgdv} * (1.0D - {pwor})) * {_discount(rate, ttd, _z(ttwo))}"
            e = f"CASE WHEN stage_fix = 5 THEN greatest(0.0D, {bdt}) ELSE greatest(0.0D, coalesce({c}, 0.0D)) END"
        elif vintage == 2:
            c = f"{bal} * {pdv} * {ead} * ({lgdv} * (1.0D - {pwor})) * {_discount(rate, ttd, ttwo)}"
            e = f"CASE WHEN stage_fix = 5 AND {wof} = 0 THEN {bdt} ELSE {c} END"
        else:
            c = (f"{_z(bal)} * {_z(pdv)} * {_z(ead)} * {lgdv} * (1 - {_z(pwor)}) "
                 f"* pow(1 + {_z(rate)}, -({_z(ttd)} + {_z(ttwo)}) / 12)")
            interim = f"CASE WHEN coalesce(stage_fix, 0) = 5 THEN {_z(bdt)} ELSE {c} END"
            e = f"CASE WHEN ({interim}) IS NOT NULL THEN greatest({interim}, 0.0D) END"
        ecl[f"ecl_{s}"] = f"CAST({e} AS DOUBLE)"
    return _exprs(staged, ecl)


def ecl_final(df: DataFrame, vintage: int, params: ScenarioParams = ScenarioParams()) -> DataFrame:
    parts = []
    for s in SCENARIOS:
        p = f"ecl_{s} * {_d(getattr(params, f'{s}_weight'))}"
        parts.append(f"coalesce({p}, 0.0D)" if vintage == 1 else f"({p})")
    return _exprs(df, {"ecl_final": " + ".join(parts)})


def ecl_pipeline(df: DataFrame, vintage: int, params: ScenarioParams = ScenarioParams(), cure: bool = True) -> DataFrame:
    """All ECL columns for one vintage, in dependency order."""
    out = stage_columns(df, vintage, cure)
    out = ecl_by_stage(out, vintage)
    out = updated_stage(out, vintage, cure)
    out = ecl_amount(out, vintage)
    out = ecl_scenarios(out, vintage, params)
    return ecl_final(out, vintage, params)


def ecl_summary(scored: DataFrame, keys=("vintage", "updated_stage")) -> DataFrame:
    """Portfolio roll-up: ECL and balance per stage (partial aggregation, tiny output)."""
    return scored.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("accounts"),
        F.sum(COLS["bal"]).alias("balance"),
        F.sum("ecl").alias("ecl"),
        F.sum("ecl_final").alias("ecl_final"),
    )
