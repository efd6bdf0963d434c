"""Behaviour, state and transition queries over ``fx_accounts`` + ``fx_profiles``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators import behaviour as B
from ledgerline.operators import profiles as P
from ledgerline.plans import oracle_tables as OT
from ledgerline.plans.catalog import query
from ledgerline.plans.q_profiles import AGEING_SQL, MOB_SQL
from ledgerline.sources.fixtures import fixture, fixture_cte

_PROF, _ACC, _ID, _MS = (fixture_cte(n) for n in ("fx_profiles", "fx_accounts", "fx_identities", "fx_month_states"))

# ------------------------------------------------------------- SQL building blocks (oracle side)


def _ctl(c: str) -> str:
    return f"CASE WHEN {c} IS NULL OR {c} IN ('.', '') THEN '' ELSE upper(replace({c}, ' ', '')) END"


def _ana(c: str) -> str:
    return f"CASE WHEN {c} IS NULL OR {c} = '' THEN '.' ELSE upper(trim(regexp_replace({c}, '\\s+', ' ', 'g'))) END"


def delinquency_sql(src: str) -> str:
    """SELECT over ``src`` adding ageing, gbipx, delinquency attribute and trigger."""
    fields = {"cg": "cg", "an_a": "aa", "an_b": "ab", "status": "cust_status"}
    whens = []
    for i, (field, word, *_rest) in enumerate(OT.DELINQUENCY):
        cond = f"ageing_attribute = '{word}'" if field == "age" else f"coalesce(instr({fields[field]}, '{word}') > 0, false)"
        whens.append(f"WHEN {cond} THEN {i + 1}")
    idx = "CASE " + " ".join(whens) + " END"

    def arr(k):
        return "[" + ", ".join("'" + r[k] + "'" for r in OT.DELINQUENCY) + "]"

    g, d, t = OT.DELINQUENCY_DEFAULT
    return f"""(SELECT * EXCLUDE (cg, aa, ab, rule_no),
      coalesce({arr(2)}[rule_no], '{g}') AS gbipx_attribute,
      coalesce({arr(3)}[rule_no], '{d}') AS delinquency_attribute,
      coalesce({arr(4)}[rule_no], '{t}') AS delinquency_trigger
    FROM (SELECT *, {idx} AS rule_no FROM (
      SELECT *, {AGEING_SQL} AS ageing_attribute,
        trim(upper({_ctl('cred_ctrl_group')} || '|' || {_ctl('sub_ctrl_group')})) AS cg,
        {_ana('an_a')} AS aa, {_ana('an_b')} AS ab FROM {src})))"""


def _cnt(seg: str, ch: str) -> str:
    return f"(length({seg}) - length(replace({seg}, '{ch}', '')))"


def _counts(dlq: str | None, gbipx: str, start: str, n: int) -> dict[str, str]:
    sg = f"upper(substr({gbipx}, {start}, {n}))"
    out = {f"cnt_{k}": _cnt(sg, ch) for k, ch in B.GBIPX_CHARS.items()}
    if dlq:
        sd = f"upper(substr({dlq}, {start}, {n}))"
        out.update({f"cnt_{k}": _cnt(sd, ch) for k, ch in B.DLQ_CHARS.items()})
    return out


def _label(c: dict[str, str], n: int) -> str:
    return (f"CASE WHEN {c['cnt_x']} > 0 THEN 'X-Exclusion' WHEN {c['cnt_p']} = {n} THEN 'P-Paid-up' "
            f"WHEN {c['cnt_i']} = {n} THEN 'I-Missing' WHEN {c['cnt_g']} = {n} THEN 'G-Good' WHEN {c['cnt_b']} = {n} THEN 'B-Bad' "
            f"WHEN {c['cnt_b']} > 0 THEN 'B-Partial' WHEN {c['cnt_g']} > 0 THEN 'G-Partial' WHEN {c['cnt_p']} > 0 THEN 'P-Partial' "
            "ELSE 'I-Indeterminate' END")


def _nz(x: str) -> str:
    return f"CAST(CASE WHEN {x} <> 0 THEN {x} END AS INTEGER)"


def _grp(x: str, n: int, w: str) -> str:
    return (f"CASE WHEN {x} IS NULL OR {x} = 0 THEN 'E. All {w} points missing' WHEN {x} < {n - 2} THEN 'D. 3+ missing {w} points' "
            f"WHEN {x} = {n - 2} THEN 'C. 2 missing {w} points' WHEN {x} = {n - 1} THEN 'B. 1 missing {w} point' "
            f"WHEN {x} = {n} THEN 'A. No missing {w} point' ELSE '' END")


def gbipx_window_sql(n: int, start: str = "1", pre: str | None = None) -> list[str]:
    pre = pre or f"b{n:02d}"
    c = _counts("dlq_profile", "gbipx_profile", start, n)
    cols = [f"{_label(c, n)} AS {pre}"]
    for k in ("g", "b", "i", "p", "x", "0", "1", "2", "3", "4", "a", "c"):
        cols.append(f"{_nz(c['cnt_' + k])} AS {pre}_cnt_{k}")
    return cols


def observation_sql(n: int) -> list[str]:
    c = _counts("dlq_profile", "gbipx_profile", "pit", n)
    tot = f"({c['cnt_g']} + {c['cnt_b']} + {c['cnt_p']})"
    ok = f"pit + {n} < 62"
    pre = f"obs{n}"
    vals = {
        pre: _label(c, n),
        f"{pre}_grp": _grp(_nz(tot), n, "OBS"),
        f"{pre}_dc0": _nz(c["cnt_0"]), f"{pre}_dc1": _nz(c["cnt_1"]), f"{pre}_dc2": _nz(c["cnt_2"]),
        f"{pre}_dc3": _nz(c["cnt_3"]), f"{pre}_dc4": _nz(c["cnt_4"]), f"{pre}_adv": _nz(c["cnt_a"]),
        f"{pre}_crd": _nz(c["cnt_c"]), f"{pre}_gds": _nz(c["cnt_g"]), f"{pre}_bad": _nz(c["cnt_b"]),
        f"{pre}_pup": _nz(c["cnt_p"]), f"{pre}_cnt": _nz(tot),
    }
    return [f"CASE WHEN {ok} THEN {v} END AS {k}" for k, v in vals.items()]


def performance_sql(n: int) -> list[str]:
    c = _counts("dlq_profile", "gbipx_profile", f"pit - {n}", n)
    tot = f"({c['cnt_g']} + {c['cnt_b']} + {c['cnt_p']})"
    lab = _label(c, n)
    first = f"substr({lab}, 1, 1)"
    g, b, p = (f"CAST(CASE WHEN {first} = '{x}' THEN 1 END AS INTEGER)" for x in "GBP")
    pre = f"per{n}"
    vals = {
        pre: lab,
        f"{pre}_grp": _grp(_nz(tot), n, "PER"),
        f"bad_rate_{n}m": "CAST(NULL AS INTEGER)",
        f"doubtful_debt_{n}m": f"CAST(CASE WHEN {c['cnt_4']} >= 1 THEN 1 END AS INTEGER)",
        f"paid_up_{n}m": "CAST(NULL AS INTEGER)",
        f"{pre}_gds": _nz(c["cnt_g"]), f"{pre}_bad": _nz(c["cnt_b"]), f"{pre}_pup": _nz(c["cnt_p"]),
        f"{pre}_crd": _nz(c["cnt_c"]), f"{pre}_cnt": _nz(tot),
        f"goods_{n}": g, f"bads_{n}": b, f"paidup_{n}": p,
        f"{pre}_gbp": _nz(f"(coalesce({g}, 0) + coalesce({b}, 0) + coalesce({p}, 0))"),
    }
    return [f"CASE WHEN pit > {n} THEN {v} END AS {k}" for k, v in vals.items()]


# The state texts and their order, as the requirements have them.
STATE_SQL = """CASE
  WHEN delinquency_attribute = 'D' OR obs24 = 'X-Exclusion' OR obs24 = 'I-Missing' THEN 'X. EXC Exclusions'
  WHEN upper(account_cat) = 'APP' THEN 'A. NTU Not Taken-Up Applications'
  WHEN upper(account_cat) = 'NEW' THEN '1. IMM Immature Accounts'
  WHEN obs3_crd = 3 THEN 'B. CRD Credit balance 3+ months (Voluntary Churn)'
  WHEN delinquency_attribute = 'C' AND obs3_crd IS NOT NULL THEN '2. C01 Credit Balance 1-2 months'
  WHEN obs12_pup = 12 AND obs24_adv IS NULL AND obs24_dc4 IS NULL THEN 'C. PUP Paid-up 12+ months (Voluntary Churn)'
  WHEN obs3_pup = 3 AND obs24_adv IS NULL AND obs24_dc4 IS NULL THEN '3. P03 Paid-up 3-11 months'
  WHEN delinquency_attribute = 'P' AND obs3_pup IS NOT NULL AND obs24_adv IS NULL AND obs24_dc4 IS NULL THEN '3. P01 Paid-up 1-2 months'
  WHEN obs12_dc0 = 12 AND obs24_dc1 IS NULL AND obs24_dc2 IS NULL AND obs24_adv IS NULL AND obs24_dc3 IS NULL
       AND obs24_dc4 IS NULL AND obs24_pup IS NULL THEN '4. CLR Clear'
  WHEN obs3_dc0 = 3 AND obs12_dc2 IS NULL AND obs24_adv IS NULL AND obs24_dc3 IS NULL AND obs24_dc4 IS NULL THEN '5. RES Responsible'
  WHEN delinquency_attribute = '0' THEN '6. ERR Erratic'
  WHEN obs1_dc1 = 1 THEN '7. EXT Extended'
  WHEN delinquency_attribute IN ('2', '3') THEN '8. DIS Distressed'
  WHEN delinquency_attribute IN ('A', '4', 'P') THEN 'D. DBT Doubtful Debt (Involuntary Churn)'
  ELSE '' END"""

OBS_WINDOWS = (1, 3, 12, 24)

# accounts with profiles, delinquency attributes and observation windows (oracle side)
_STATE_BASE = f"""WITH {_ACC}, {_PROF},
j AS (SELECT a.*, p.pit, p.dlq_profile, p.gbipx_profile, p.age_profile, p.mob_start FROM fx_accounts a JOIN fx_profiles p ON a.account = p.account),
d AS {delinquency_sql('j')},
o AS (SELECT *, {', '.join(c for n in OBS_WINDOWS for c in observation_sql(n))} FROM d),
s AS (SELECT *, {STATE_SQL} AS account_state FROM o)"""

# ------------------------------------------------------------- Spark side


def accounts_with_profiles(spark, sf_dir) -> DataFrame:
    acc = fixture(spark, sf_dir, "fx_accounts")
    prof = fixture(spark, sf_dir, "fx_profiles")
    return acc.join(prof, "account")


def accounts_with_state(spark, sf_dir) -> DataFrame:
    df = B.delinquency_attributes(accounts_with_profiles(spark, sf_dir))
    return B.account_state(B.observation_windows(df, OBS_WINDOWS))


@query("delinquency_attributes", oracle=f"WITH {_ACC} SELECT * FROM {delinquency_sql('fx_accounts')}")
def q_delinquency_attributes(spark, sf_dir):
    return B.delinquency_attributes(fixture(spark, sf_dir, "fx_accounts"))


GBIPX_WINDOWS = (1, 6, 12, 18, 24)


@query(
    "gbipx_window",
    oracle=f"WITH {_PROF} SELECT account, pit, dlq_profile, gbipx_profile, "
    + ", ".join(c for n in GBIPX_WINDOWS for c in gbipx_window_sql(n))
    + " FROM fx_profiles",
)
def q_gbipx_window(spark, sf_dir):
    df = fixture(spark, sf_dir, "fx_profiles").select("account", "pit", "dlq_profile", "gbipx_profile")
    return B.gbipx_windows(df, GBIPX_WINDOWS)


@query(
    "observation_window",
    oracle=f"WITH {_PROF} SELECT account, pit, dlq_profile, gbipx_profile, "
    + ", ".join(c for n in OBS_WINDOWS for c in observation_sql(n))
    + " FROM fx_profiles",
)
def q_observation_window(spark, sf_dir):
    df = fixture(spark, sf_dir, "fx_profiles").select("account", "pit", "dlq_profile", "gbipx_profile")
    return B.observation_windows(df, OBS_WINDOWS)


PERF_WINDOWS = (1, 3, 6, 9, 12)


@query(
    "performance_window",
    oracle=f"WITH {_PROF} SELECT account, pit, dlq_profile, gbipx_profile, "
    + ", ".join(c for n in PERF_WINDOWS for c in performance_sql(n))
    + " FROM fx_profiles",
)
def q_performance_window(spark, sf_dir):
    df = fixture(spark, sf_dir, "fx_profiles").select("account", "pit", "dlq_profile", "gbipx_profile")
    return B.performance_windows(df, PERF_WINDOWS)


@query(
    "payment_defaulters",
    oracle=f"""WITH {_PROF} SELECT account, pit, dlq_profile,
      CAST(CASE WHEN pit > 1 AND substr(dlq_profile, pit - 1, 1) = '1' THEN 1 END AS INTEGER) AS next_cycle_30_days,
      CAST(CASE WHEN pit > 2 AND substr(dlq_profile, pit - 2, 2) = '21' THEN 1 END AS INTEGER) AS second_cycle_60_days,
      CAST(CASE WHEN pit > 3 AND substr(dlq_profile, pit - 3, 3) = '321' THEN 1 END AS INTEGER) AS third_cycle_90_days
    FROM fx_profiles""",
)
def q_payment_defaulters(spark, sf_dir):
    return B.payment_defaulters(fixture(spark, sf_dir, "fx_profiles").select("account", "pit", "dlq_profile"))


def _beh_sql() -> str:
    ws = ["b01", "b06", "b12", "b18", "b24"]
    whens_ci, whens_cs = [], []
    for i, (label, which, _, text) in enumerate(OT.BEHAVIOUR):
        use = ws if which == "all" else ws[1:]
        whens_ci.append("WHEN " + " OR ".join(f"lower(trim({w})) = '{label.lower()}'" for w in use) + f" THEN {i + 1}")
        whens_cs.append("WHEN " + " OR ".join(f"{w} = '{label}'" for w in use) + f" THEN '{text}'")
    flags = ", ".join(f"CAST(CASE WHEN k = {i + 1} THEN 1 END AS INTEGER) AS {r[2]}" for i, r in enumerate(OT.BEHAVIOUR))
    texts = "[" + ", ".join(f"'{r[3]}'" for r in OT.BEHAVIOUR) + "]"
    return (f"SELECT * EXCLUDE (k), {flags}, {texts}[k] AS beh_account FROM (SELECT *, CASE {' '.join(whens_ci)} END AS k, "
            f"CASE {' '.join(whens_cs)} ELSE '' END AS acct_beh, '' AS cust_beh FROM w)")


@query(
    "account_behaviour",
    oracle=f"WITH {_PROF}, w AS (SELECT account, "
    + ", ".join(gbipx_window_sql(n)[0] for n in GBIPX_WINDOWS)
    + " FROM fx_profiles) "
    + _beh_sql(),
)
def q_account_behaviour(spark, sf_dir):
    df = fixture(spark, sf_dir, "fx_profiles")
    df = B.gbipx_windows(df, GBIPX_WINDOWS)
    df = df.select("account", *[f"b{n:02d}" for n in GBIPX_WINDOWS])
    df = B.account_behaviour(df)
    return B.account_behaviour(df, case_sensitive=True)


@query("account_state", oracle=_STATE_BASE + "\nSELECT account, pit, account_cat, delinquency_attribute, account_state FROM s")
def q_account_state(spark, sf_dir):
    return accounts_with_state(spark, sf_dir).select("account", "pit", "account_cat", "delinquency_attribute", "account_state")


@query(
    "customer_behaviour",
    oracle=f"""WITH {_PROF}, {_ID},
w AS (SELECT account, mob_start, {', '.join(gbipx_window_sql(n)[0] for n in GBIPX_WINDOWS)} FROM fx_profiles),
b AS ({_beh_sql()}),
m AS (SELECT b.*, substr({MOB_SQL}, 1, 2) AS e FROM b),
f AS (SELECT m.*, CASE WHEN e = '..' THEN 1 END AS mob_missing,
        CASE WHEN e <> '..' AND e IN ('00','01','02','03','04','05') THEN 1 END AS mob_immature,
        substr(i.id_raw, 1, 10) AS idkey
      FROM m JOIN fx_identities i ON m.account = i.rec),
g AS (SELECT idkey, {', '.join(f"CAST(coalesce(sum({c}), 0) AS BIGINT) AS {c}" for c in B.CUSTOMER_COUNTERS)} FROM f GROUP BY idkey)
SELECT *, CASE WHEN beh_exclusion >= 1 THEN 'EA [Exclusion Account]' WHEN mob_immature >= 1 THEN 'IB [Immature Payment Behaviour]'
  WHEN beh_excellent >= 1 THEN 'EB [Excellent Payment Behaviour]' WHEN beh_good >= 1 OR beh_paidup >= 1 THEN 'GB [Good Payment Behaviour]'
  WHEN beh_poor >= 1 THEN 'PB [Poor Payment Behaviour]' WHEN beh_adverse >= 1 THEN 'AB [Adverse Payment Behaviour]'
  WHEN beh_missing >= 1 THEN 'MR [Missing Billing Records]' WHEN mob_missing >= 1 THEN 'ND [No Account Opening Date]' END AS beh_customer
FROM g""",
)
def q_customer_behaviour(spark, sf_dir):
    """Account behaviour and MOB class per account, rolled up per identity key (first 10 ID characters)."""
    df = fixture(spark, sf_dir, "fx_profiles")
    df = B.account_behaviour(B.gbipx_windows(df, GBIPX_WINDOWS))
    df = df.withColumns(P.mob_category(P.generate_mob_profile("mob_start")))
    ids = fixture(spark, sf_dir, "fx_identities").select(F.col("rec").alias("account"), F.substring("id_raw", 1, 10).alias("idkey"))
    return B.customer_behaviour(df.join(ids, "account"), "idkey")


TRANSITION_NDX = (1, 3)


def _transition_sql(ndx: int) -> str:
    pos = f"(pit - {ndx})"
    pa, pd_ = f"substr(age_profile, {pos}, 1)", f"substr(dlq_profile, {pos}, 1)"
    m = "MAP {" + ", ".join(f"'{c}': '{t}'" for codes, t in OT.TRANSITIONS for c in codes) + "}"
    excl_d = f"coalesce(delinquency_attribute = 'D' OR {pd_} = 'D', false)"
    excl_x = f"coalesce(delinquency_attribute = 'X' OR {pd_} = 'X', false)"
    st = "upper(substr(account_state, 1, 1))"
    ov = f"CASE WHEN {st} = 'B' THEN 'CC' WHEN {st} = 'C' THEN 'PP' WHEN {st} = 'D' THEN '44' WHEN {st} = 'X' THEN 'XX' END"
    age_c = (f"coalesce({ov}, CASE WHEN {excl_d} THEN 'DD' WHEN {excl_x} THEN 'XX' "
             f"WHEN coalesce(ageing_attribute IS NULL OR ageing_attribute = '.' OR {pa} = '.', false) THEN '..' "
             f"WHEN coalesce(ageing_attribute IS NULL OR ageing_attribute = '-' OR {pa} = '-', false) THEN '--' "
             f"ELSE replace(ageing_attribute || {pa}, ' ', '') END)")
    dlq_c = (f"coalesce({ov}, CASE WHEN {excl_d} THEN 'DD' WHEN {excl_x} THEN 'XX' "
             f"WHEN coalesce(delinquency_attribute IS NULL OR delinquency_attribute = '.' OR {pd_} = '.', false) THEN '..' "
             f"ELSE replace(delinquency_attribute || {pd_}, ' ', '') END)")
    at, dt = f"{m}[{age_c}]", f"{m}[{dlq_c}]"
    sq = "trim(regexp_replace({x}, '\\s+', ' ', 'g'))"
    inner = sq.format(x=f"replace({at}, 'or adverse event', '')")
    age_txt = sq.format(x=f"replace({inner}, 'or 120 Days and adverse next period', '')")
    pre = f"transition_{ndx}"
    return (f"CASE WHEN {pos} >= 1 THEN {age_txt} ELSE '' END AS {pre}_age, CASE WHEN {pos} >= 1 THEN {dt} ELSE '' END AS {pre}_dlq, "
            f"CAST(CASE WHEN {pos} >= 1 AND {at} = {dt} THEN 1 END AS INTEGER) AS {pre}_mat")


@query(
    "account_transition",
    oracle=_STATE_BASE + "\nSELECT account, pit, ageing_attribute, delinquency_attribute, account_state, "
    + ", ".join(_transition_sql(n) for n in TRANSITION_NDX)
    + " FROM s",
)
def q_account_transition(spark, sf_dir):
    df = accounts_with_state(spark, sf_dir)
    for n in TRANSITION_NDX:
        df = B.account_transition(df, n)
    keep = ["account", "pit", "ageing_attribute", "delinquency_attribute", "account_state"]
    return df.select(*keep, *[c for c in df.columns if c.startswith("transition_")])


@query(
    "doubtful_debt",
    oracle=_STATE_BASE + "\nSELECT account, pit, account_state, "
    + ", ".join(
        f"CAST(CASE WHEN upper(replace(account_state, ' ', '')) = 'D.DBTDOUBTFULDEBT(INVOLUNTARYCHURN)' AND pit >= {t} THEN 1 END AS INTEGER)"
        f" AS doubtful_debt_{m}m_flag"
        for m, t in ((1, 2), (3, 4), (6, 7), (9, 10), (12, 13))
    )
    + " FROM s",
)
def q_doubtful_debt(spark, sf_dir):
    return B.doubtful_debt(accounts_with_state(spark, sf_dir).select("account", "pit", "account_state"))


def _jumps_sql() -> str:
    cols = ["m1", "m2", "m3", "m4"]
    prob, interp, cyc = "CAST(NULL AS VARCHAR)", "CAST(NULL AS VARCHAR)", "CAST(NULL AS VARCHAR)"
    for old, young in zip(cols[:-1], cols[1:]):
        hit = " OR ".join(f"({old} = '{a}' AND {young} = '{b}')" for a, b, _ in OT.AGE_JUMPS)
        txt = "CASE " + " ".join(f"WHEN {old} = '{a}' AND {young} = '{b}' THEN '{t}'" for a, b, t in OT.AGE_JUMPS) + " END"
        h = f"coalesce({hit}, false)"
        prob = f"CASE WHEN {h} THEN 'From ' || {old} || ' to ' || {young} ELSE {prob} END"
        interp = f"CASE WHEN {h} THEN {txt} ELSE {interp} END"
        cyc = f"CASE WHEN {h} THEN '{old} to {young}' ELSE {cyc} END"
    return f"SELECT *, {prob} AS problem, {interp} AS interpretation, {cyc} AS cycle_id FROM fx_month_states"


@query("flag_age_jumps", oracle=f"WITH {_MS} " + _jumps_sql())
def q_flag_age_jumps(spark, sf_dir):
    return B.flag_age_jumps(fixture(spark, sf_dir, "fx_month_states"), ["m1", "m2", "m3", "m4"])
