"""Delinquency, good/bad behaviour, account state and transitions.

Inputs are account rows carrying 60-month DLQ / GBIPX / AGE profiles (newest
month first) and a point in time ``pit``.  Windows over a profile are
substrings; counters are character counts of that substring.  Every
operator is one projection of native expressions (no Python per row).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import sqltext as T
from ledgerline.functions.rules import all_null, any_equal, col, first_match, first_match_index, flag, pick

# ------------------------------------------------------------------ delinquency

# Ordered delinquency waterfall.  Each rule: (field, keyword,
# gbipx attribute, delinquency attribute, trigger).  Field ``cg`` is the
# control groups text, ``an_a`` / ``an_b`` the analysis fields,
# ``status`` the customer status, ``age`` the ageing attribute (exact match).
DELINQUENCY_RULES = [
    ("cg", "DECEASED", "X", "D", "A. Deceased"),
    ("an_b", "FINANCE", "X", "X", "X. Financial Reconciliation"),
    ("an_b", "ONBIL", "X", "X", "X. On Biller"),
    ("an_b", "BUSINESS", "X", "X", "X. Enterprise Account"),
    ("cg", "FRAUD", "B", "A", "B. Fraud"),
    ("age", "4", "B", "4", "C. CD4 (120+ days)"),
    ("an_a", "PREWRITEOF", "B", "4", "C. CD4 (120+ days)"),
    ("an_b", "ARCHIVED", "B", "4", "C. CD4 (120+ days)"),
    ("an_a", "PRECLOSED", "B", "4", "C. CD4 (120+ days)"),
    ("age", "3", "B", "3", "D. CD3 (90 days)"),
    ("age", "2", "B", "2", "E. CD2 (60 days)"),
    ("cg", "PRESCRIP", "B", "A", "F. Debt Prescription"),
    ("cg", "REVIEW", "B", "A", "G. Debt Review"),
    ("cg", "COUNCIL", "B", "A", "G. Debt Review"),
    ("cg", "ADMIN", "B", "A", "H. Administration, Insolvency & Liquidation"),
    ("cg", "INSOLVE", "B", "A", "H. Administration, Insolvency & Liquidation"),
    ("cg", "LIQUID", "B", "A", "H. Administration, Insolvency & Liquidation"),
    ("cg", "SALE", "B", "A", "I. Debt Sale"),
    ("cg", "SOLD", "B", "A", "I. Debt Sale"),
    ("cg", "AOD", "B", "A", "J. Debt Recovery"),
    ("cg", "RECOVER", "B", "A", "J. Debt Recovery"),
    ("cg", "ARRANGE", "B", "A", "K. Payment Arrangement"),
    ("cg", "REHAB", "B", "A", "K. Payment Arrangement"),
    ("cg", "LEGAL", "B", "A", "L. Legal Action"),
    ("an_b", "LEGAL", "B", "A", "L. Legal Action"),
    ("cg", "EDC", "B", "A", "M. External Debt Collector"),
    ("cg", "ADRS", "B", "A", "M. External Debt Collector"),
    ("cg", "BROOKS", "B", "A", "M. External Debt Collector"),
    ("cg", "BLAKE", "B", "A", "M. External Debt Collector"),
    ("cg", "CBS", "B", "A", "M. External Debt Collector"),
    ("cg", "DALY", "B", "A", "M. External Debt Collector"),
    ("cg", "HAMMOND", "B", "A", "M. External Debt Collector"),
    ("cg", "MBD", "B", "A", "M. External Debt Collector"),
    ("cg", "MMM", "B", "A", "M. External Debt Collector"),
    ("cg", "MYBURG", "B", "A", "M. External Debt Collector"),
    ("cg", "NDS", "B", "A", "M. External Debt Collector"),
    ("cg", "NIMBLE", "B", "A", "M. External Debt Collector"),
    ("cg", "NUDEBT", "B", "A", "M. External Debt Collector"),
    ("cg", "PHOLOSA", "B", "A", "M. External Debt Collector"),
    ("cg", "PLACEMENT", "B", "A", "M. External Debt Collector"),
    ("cg", "REALPEOPLE", "B", "A", "M. External Debt Collector"),
    ("cg", "R&W", "B", "A", "M. External Debt Collector"),
    ("cg", "TMT", "B", "A", "M. External Debt Collector"),
    ("cg", "VVM", "B", "A", "M. External Debt Collector"),
    ("an_b", "PRE_LEGAL", "B", "A", "M. External Debt Collector"),
    ("status", "SUSPEND", "B", "A", "N. Phone Suspended"),
    ("status", "BARRING", "B", "A", "O. Phone Barred"),
    ("age", "1", "G", "1", "P. CD1 (30 days)"),
    ("age", "0", "G", "0", "Q. CD0 (Current)"),
    ("age", "C", "G", "C", "R. Credit Balance"),
    ("age", "P", "P", "P", "S. Paid-up Account"),
    ("an_a", "COLLECTION", "B", "2", "E. CD2 (60 days)"),
    ("an_a", "CURRENT", "G", "0", "Q. CD0 (Current)"),
]
DELINQUENCY_DEFAULT = ("?", "-", "LAST CASE: no description.")


def ageing_attribute(balance, cd0, cd1, cd2, cd3, cd4) -> Column:
    """Oldest bucket with a positive amount and nothing owed in older buckets; C/P by balance."""
    b, c0, c1, c2, c3, c4 = (col(x) for x in (balance, cd0, cd1, cd2, cd3, cd4))
    d120 = c4
    d090 = d120 + c3
    d060 = d090 + c2
    d030 = d060 + c1
    return first_match(
        [
            (c4 > 0, "4"),
            ((c3 > 0) & (d120 <= 0), "3"),
            ((c2 > 0) & (d090 <= 0), "2"),
            ((c1 > 0) & (d060 <= 0), "1"),
            ((c0 > 0) & (d030 <= 0), "0"),
            (b < 0, "C"),
            (b == 0, "P"),
        ],
        "-",
    )


def _control_text(c: Column) -> Column:
    return F.when(c.isNull() | c.isin(".", ""), F.lit("")).otherwise(F.upper(F.replace(c, F.lit(" "), F.lit(""))))


def _analysis_text(c: Column) -> Column:
    return F.when(c.isNull() | (c == ""), F.lit(".")).otherwise(F.upper(F.trim(F.regexp_replace(c, r"\s+", " "))))


def delinquency_attributes(
    df: DataFrame,
    cust_status="cust_status",
    cred_ctrl_group="cred_ctrl_group",
    sub_ctrl_group="sub_ctrl_group",
    balance="balance",
    cds=("cd0", "cd1", "cd2", "cd3", "cd4"),
    an_a="an_a",
    an_b="an_b",
) -> DataFrame:
    """Ageing, GBIPX, delinquency attribute and trigger from the ordered rule registry.

    One CASE yields the number of the first matching rule; the three outputs
    are literal-array lookups by that number.
    """
    fields = {
        "cg": F.trim(F.upper(F.concat(_control_text(col(cred_ctrl_group)), F.lit("|"), _control_text(col(sub_ctrl_group))))),
        "an_a": _analysis_text(col(an_a)),
        "an_b": _analysis_text(col(an_b)),
        "status": col(cust_status),
    }
    # normalised texts first, then one rule-number CASE over plain columns
    staged = df.withColumns({"ageing_attribute": ageing_attribute(balance, *cds), **{f"_{k}": v for k, v in fields.items()}})
    rules = []
    for i, (field, word, *_) in enumerate(DELINQUENCY_RULES):
        if field == "age":
            cond = f"ageing_attribute = {T.q(word)}"
        else:
            cond = T.true_or_false(f"instr(_{field}, {T.q(word)}) > 0")
        rules.append((cond, str(i + 1)))
    staged = staged.withColumn("_rule", F.expr(T.case(rules)))
    g, d, t = DELINQUENCY_DEFAULT

    def pick_sql(values, default):
        arr = ", ".join(T.q(v) for v in [*values, default])
        return F.expr(f"element_at(array({arr}), coalesce(_rule, {len(values) + 1}))")

    return staged.withColumns(
        {
            "gbipx_attribute": pick_sql([r[2] for r in DELINQUENCY_RULES], g),
            "delinquency_attribute": pick_sql([r[3] for r in DELINQUENCY_RULES], d),
            "delinquency_trigger": pick_sql([r[4] for r in DELINQUENCY_RULES], t),
        }
    ).drop("_rule", *[f"_{k}" for k in fields])


# ------------------------------------------------------------------ GBIPX windows

GBIPX_CHARS = {"g": "G", "b": "B", "i": ".", "p": "P", "x": "X"}
DLQ_CHARS = {"0": "0", "1": "1", "2": "2", "3": "3", "4": "4", "a": "A", "c": "C"}


def _nz(c: Column) -> Column:
    return F.when(c != 0, c).cast("int")


# -- the window family as SQL text: one JVM call per output column instead of one per node

def _with_counts(df: DataFrame, specs):
    """Stage every window's segments and character counts as columns (two projections for all
    windows together: each count is computed once per row and generated methods stay small).

    ``specs``: (tag, dlq expr or None, gbipx expr, start expr, months).  Returns the frame, the
    count column names per tag and the temporary columns to drop.
    """
    seg, cnt, refs = {}, {}, {}
    for tag, dlq, gbipx, start, n in specs:
        seg[f"_sg_{tag}"] = f"upper(substr({gbipx}, {start}, {n}))"
        if dlq is not None:
            seg[f"_sd_{tag}"] = f"upper(substr({dlq}, {start}, {n}))"
        refs[tag] = {}
        for k, ch in GBIPX_CHARS.items():
            cnt[f"_cnt_{k}_{tag}"] = f"(length(_sg_{tag}) - length(replace(_sg_{tag}, {T.q(ch)}, '')))"
            refs[tag][f"cnt_{k}"] = f"_cnt_{k}_{tag}"
        if dlq is not None:
            for k, ch in DLQ_CHARS.items():
                cnt[f"_cnt_{k}_{tag}"] = f"(length(_sd_{tag}) - length(replace(_sd_{tag}, {T.q(ch)}, '')))"
                refs[tag][f"cnt_{k}"] = f"_cnt_{k}_{tag}"
    staged = df.withColumns({k: F.expr(v) for k, v in seg.items()})
    staged = staged.withColumns({k: F.expr(v) for k, v in cnt.items()})
    return staged, refs, [*seg, *cnt]


def _label_sql(c: dict[str, str], n: int) -> str:
    # The window labels and their order.
    return T.case(
        [
            (f"{c['cnt_x']} > 0", "'X-Exclusion'"),
            (f"{c['cnt_p']} = {n}", "'P-Paid-up'"),
            (f"{c['cnt_i']} = {n}", "'I-Missing'"),
            (f"{c['cnt_g']} = {n}", "'G-Good'"),
            (f"{c['cnt_b']} = {n}", "'B-Bad'"),
            (f"{c['cnt_b']} > 0", "'B-Partial'"),
            (f"{c['cnt_g']} > 0", "'G-Partial'"),
            (f"{c['cnt_p']} > 0", "'P-Partial'"),
        ],
        "'I-Indeterminate'",
    )


def _nz_sql(x: str) -> str:
    return f"CAST(nullif({x}, 0) AS INT)"


def _grp_sql(cnt: str, n: int, word: str) -> str:
    # The completeness texts.
    return T.case(
        [
            (f"{cnt} IS NULL OR {cnt} = 0", T.q(f"E. All {word} points missing")),
            (f"{cnt} < {n - 2}", T.q(f"D. 3+ missing {word} points")),
            (f"{cnt} = {n - 2}", T.q(f"C. 2 missing {word} points")),
            (f"{cnt} = {n - 1}", T.q(f"B. 1 missing {word} point")),
            (f"{cnt} = {n}", T.q(f"A. No missing {word} point")),
        ],
        "''",
    )


def _start_sql(start) -> str:
    if isinstance(start, int):
        return str(start)
    if isinstance(start, str):
        return T.ident(start)
    raise TypeError("start must be a month number or a column name")


def gbipx_windows(df: DataFrame, months, start=1, dlq="dlq_profile", gbipx="gbipx_profile") -> DataFrame:
    """Behaviour label ``b<nn>`` and the 12 counters (0 -> NULL) for each window length in ``months``."""
    specs = [(f"b{n:02d}", T.ident(dlq) if dlq else None, T.ident(gbipx), _start_sql(start), n) for n in months]
    staged, refs, temp = _with_counts(df, specs)
    out = {}
    for pre, _, _, _, n in specs:
        cnt = refs[pre]
        out[pre] = _label_sql(cnt, n)
        for k in ("g", "b", "i", "p", "x", "0", "1", "2", "3", "4", "a", "c"):
            if f"cnt_{k}" in cnt:
                out[f"{pre}_cnt_{k}"] = _nz_sql(cnt[f"cnt_{k}"])
    return staged.withColumns({k: F.expr(v) for k, v in out.items()}).drop(*temp)


def gbipx_window(df: DataFrame, months: int, start=1, dlq="dlq_profile", gbipx="gbipx_profile", prefix: str | None = None) -> DataFrame:
    """Behaviour label and the 12 counters (0 -> NULL) over ``months`` months from month ``start``."""
    out = gbipx_windows(df, [months], start, dlq, gbipx)
    pre = f"b{months:02d}"
    if prefix and prefix != pre:
        out = out.withColumnsRenamed({c: prefix + c[len(pre):] for c in out.columns if c == pre or c.startswith(pre + "_")})
    return out


def observation_windows(df: DataFrame, ns, pit="pit", dlq="dlq_profile", gbipx="gbipx_profile") -> DataFrame:
    """Look-back windows of each length in ``ns`` from the point in time (``obs<n>_*``); NULL when pit + n >= 62."""
    p = T.ident(pit)
    specs = [(f"obs{n}", T.ident(dlq), T.ident(gbipx), p, n) for n in ns]
    staged, refs, temp = _with_counts(df, specs)
    out = {}
    for pre, _, _, _, n in specs:
        c = refs[pre]
        total = f"({c['cnt_g']} + {c['cnt_b']} + {c['cnt_p']})"
        vals = {
            pre: _label_sql(c, n),
            f"{pre}_grp": _grp_sql(_nz_sql(total), n, "OBS"),
            f"{pre}_dc0": _nz_sql(c["cnt_0"]),
            f"{pre}_dc1": _nz_sql(c["cnt_1"]),
            f"{pre}_dc2": _nz_sql(c["cnt_2"]),
            f"{pre}_dc3": _nz_sql(c["cnt_3"]),
            f"{pre}_dc4": _nz_sql(c["cnt_4"]),
            f"{pre}_adv": _nz_sql(c["cnt_a"]),
            f"{pre}_crd": _nz_sql(c["cnt_c"]),
            f"{pre}_gds": _nz_sql(c["cnt_g"]),
            f"{pre}_bad": _nz_sql(c["cnt_b"]),
            f"{pre}_pup": _nz_sql(c["cnt_p"]),
            f"{pre}_cnt": _nz_sql(total),
        }
        out.update({k: f"CASE WHEN {p} + {n} < 62 THEN {v} END" for k, v in vals.items()})
    return staged.withColumns({k: F.expr(v) for k, v in out.items()}).drop(*temp)


def observation_window(df: DataFrame, n: int, pit="pit", dlq="dlq_profile", gbipx="gbipx_profile") -> DataFrame:
    return observation_windows(df, [n], pit, dlq, gbipx)


def performance_windows(df: DataFrame, ns, pit="pit", dlq="dlq_profile", gbipx="gbipx_profile") -> DataFrame:
    """Look-forward windows of each length in ``ns`` ending before the point in time (``per<n>_*``);
    NULL when pit <= n.  Bad-rate and paid-up-rate outputs are part of the schema but always NULL."""
    p = T.ident(pit)
    specs = [(f"per{n}", T.ident(dlq), T.ident(gbipx), f"({p} - {n})", n) for n in ns]
    staged, refs, temp = _with_counts(df, specs)
    out, more = {}, {}
    for pre, _, _, _, n in specs:
        c = refs[pre]
        total = f"({c['cnt_g']} + {c['cnt_b']} + {c['cnt_p']})"
        vals = {
            pre: _label_sql(c, n),
            f"{pre}_grp": _grp_sql(_nz_sql(total), n, "PER"),
            f"bad_rate_{n}m": "CAST(NULL AS INT)",
            f"doubtful_debt_{n}m": f"CAST(CASE WHEN {c['cnt_4']} >= 1 THEN 1 END AS INT)",
            f"paid_up_{n}m": "CAST(NULL AS INT)",
            f"{pre}_gds": _nz_sql(c["cnt_g"]),
            f"{pre}_bad": _nz_sql(c["cnt_b"]),
            f"{pre}_pup": _nz_sql(c["cnt_p"]),
            f"{pre}_crd": _nz_sql(c["cnt_c"]),
            f"{pre}_cnt": _nz_sql(total),
        }
        out.update({k: f"CASE WHEN {p} > {n} THEN {v} END" for k, v in vals.items()})
        # goods / bads / paid-up read the first letter of the label computed in the first projection
        first = f"substr({T.ident(pre)}, 1, 1)"
        goods, bads, paid = (f"CAST(CASE WHEN {first} = '{x}' THEN 1 END AS INT)" for x in "GBP")
        more.update({
            f"goods_{n}": goods,
            f"bads_{n}": bads,
            f"paidup_{n}": paid,
            f"{pre}_gbp": f"CASE WHEN {T.ident(pre)} IS NOT NULL THEN "
                          + _nz_sql(f"(coalesce({goods}, 0) + coalesce({bads}, 0) + coalesce({paid}, 0))") + " END",
        })
    staged = staged.withColumns({k: F.expr(v) for k, v in out.items()})
    return staged.withColumns({k: F.expr(v) for k, v in more.items()}).drop(*temp)


def performance_window(df: DataFrame, n: int, pit="pit", dlq="dlq_profile", gbipx="gbipx_profile") -> DataFrame:
    return performance_windows(df, [n], pit, dlq, gbipx)


def payment_defaulters(df: DataFrame, pit="pit", dlq="dlq_profile") -> DataFrame:
    """First/second/third-instalment default flags: the months after pit read 1, 21, 321."""
    p, d = col(pit), col(dlq)
    return df.withColumns(
        {
            "next_cycle_30_days": flag((p > 1) & (F.substr(d, p - 1, F.lit(1)) == "1")).cast("int"),
            "second_cycle_60_days": flag((p > 2) & (F.substr(d, p - 2, F.lit(2)) == "21")).cast("int"),
            "third_cycle_90_days": flag((p > 3) & (F.substr(d, p - 3, F.lit(3)) == "321")).cast("int"),
        }
    )


# ------------------------------------------------------------------ behaviour and state

# Account behaviour ladder (label searched, which windows, output flag, output label).
BEHAVIOUR_LADDER = [
    ("X-Exclusion", "all", "beh_exclusion", "X. Exclusions"),
    ("I-Missing", "all", "beh_missing", "D. Missing Record"),
    ("B-Bad", "all", "beh_adverse", "F. Adverse Account"),
    ("B-Partial", "tail", "beh_poor", "E. Poor Account"),
    ("G-Good", "tail", "beh_excellent", "A. Excellent Account"),
    ("G-Partial", "tail", "beh_good", "B. Good Account"),
    ("P-Paid-up", "all", "beh_paidup", "C. Paid-up Account"),
]


def account_behaviour(df: DataFrame, windows: Sequence[str] = ("b01", "b06", "b12", "b18", "b24"), case_sensitive: bool = False) -> DataFrame:
    """Account behaviour from five window labels: first rung of the ladder that any label hits.

    Case-insensitive (trimmed) by default, with one 1/NULL flag per rung and
    NULL when no rung matches; ``case_sensitive=True`` gives the exact-match
    variant whose label defaults to "" and whose customer label is always "".
    """
    ws = [col(w) for w in windows]
    if not case_sensitive:
        ws = [F.lower(F.trim(w)) for w in ws]
    conds = []
    for label, which, _, _ in BEHAVIOUR_LADDER:
        target = label if case_sensitive else label.lower()
        use = ws if which == "all" else ws[1:]
        conds.append(any_equal(target, use))
    idx = first_match_index(conds)
    if case_sensitive:
        return df.withColumns(
            {"acct_beh": pick(idx, [r[3] for r in BEHAVIOUR_LADDER], ""), "cust_beh": F.lit("")}
        )
    out = {r[2]: flag(idx == i + 1).cast("int") for i, r in enumerate(BEHAVIOUR_LADDER)}
    out["beh_account"] = pick(idx, [r[3] for r in BEHAVIOUR_LADDER])
    return df.withColumns(out)


def account_state(df: DataFrame, account_cat="account_cat", dlq="delinquency_attribute") -> DataFrame:
    """14-rung account state ladder over observation counters (obs1/obs3/obs12/obs24 columns)."""
    c, d = T.ident(account_cat), T.ident(dlq)

    def all_null(*cols):
        return "(" + " AND ".join(f"{x} IS NULL" for x in cols) + ")"

    never_adv = all_null("obs24_adv", "obs24_dc4")
    # The state texts and their order.
    rules = [
        (f"{d} = 'D' OR obs24 = 'X-Exclusion' OR obs24 = 'I-Missing'", "X. EXC Exclusions"),
        (f"upper({c}) = 'APP'", "A. NTU Not Taken-Up Applications"),
        (f"upper({c}) = 'NEW'", "1. IMM Immature Accounts"),
        ("obs3_crd = 3", "B. CRD Credit balance 3+ months (Voluntary Churn)"),
        (f"{d} = 'C' AND obs3_crd IS NOT NULL", "2. C01 Credit Balance 1-2 months"),
        (f"obs12_pup = 12 AND {never_adv}", "C. PUP Paid-up 12+ months (Voluntary Churn)"),
        (f"obs3_pup = 3 AND {never_adv}", "3. P03 Paid-up 3-11 months"),
        (f"{d} = 'P' AND obs3_pup IS NOT NULL AND {never_adv}", "3. P01 Paid-up 1-2 months"),
        ("obs12_dc0 = 12 AND " + all_null("obs24_dc1", "obs24_dc2", "obs24_adv", "obs24_dc3", "obs24_dc4", "obs24_pup"), "4. CLR Clear"),
        ("obs3_dc0 = 3 AND obs12_dc2 IS NULL AND " + all_null("obs24_adv", "obs24_dc3", "obs24_dc4"), "5. RES Responsible"),
        (f"{d} = '0'", "6. ERR Erratic"),
        ("obs1_dc1 = 1", "7. EXT Extended"),
        (f"{d} IN ('2', '3')", "8. DIS Distressed"),
        (f"{d} IN ('A', '4', 'P')", "D. DBT Doubtful Debt (Involuntary Churn)"),
    ]
    return df.withColumn("account_state", F.expr(T.case([(T.true_or_false(k), T.q(v)) for k, v in rules], "''")))


# Customer behaviour ladder (counter columns tested >= 1, label).
CUSTOMER_LADDER = [
    (("beh_exclusion",), "EA [Exclusion Account]"),
    (("mob_immature",), "IB [Immature Payment Behaviour]"),
    (("beh_excellent",), "EB [Excellent Payment Behaviour]"),
    (("beh_good", "beh_paidup"), "GB [Good Payment Behaviour]"),
    (("beh_poor",), "PB [Poor Payment Behaviour]"),
    (("beh_adverse",), "AB [Adverse Payment Behaviour]"),
    (("beh_missing",), "MR [Missing Billing Records]"),
    (("mob_missing",), "ND [No Account Opening Date]"),
]
CUSTOMER_COUNTERS = ("beh_exclusion", "mob_immature", "beh_excellent", "beh_good", "beh_paidup", "beh_poor",
                     "beh_adverse", "beh_missing", "mob_missing")


def customer_behaviour(df: DataFrame, customer: str) -> DataFrame:
    """Sum the account flags per customer (map-side partial sums) and label the customer."""
    agg = df.groupBy(customer).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in CUSTOMER_COUNTERS]
    )
    rules = []
    for cols, label in CUSTOMER_LADDER:
        cond = None
        for c in cols:
            t = F.col(c) >= 1
            cond = t if cond is None else (cond | t)
        rules.append((cond, label))
    return agg.withColumn("beh_customer", first_match(rules))


# Two-character transition code -> description.
TRANSITION_TEXT = [
    (("00",), "0(=) UTD both periods"),
    (("01", "02", "03", "04", "0A"), "0(-) UTD: Rolled forward or adverse event next period"),
    (("0C", "0P"), "0(+) UTD: Credit balance or paid-up next period"),
    (("10", "1C", "1P"), "1(+) 30 Days: Cured or credit balance or paid-up next period"),
    (("11",), "1(=) 30 Days both periods"),
    (("12", "13", "14", "1A"), "1(-) 30 Days: Rolled forward or adverse event next period"),
    (("20", "2C"), "2(+) 60 Days: Cured or credit balance next period"),
    (("21", "2P"), "2(+) 60 Days: Rolled backward or paid-up next period"),
    (("22",), "2(=) 60 Days both periods"),
    (("23", "24", "2A"), "2(-) 60 Days: Rolled forward or adverse event next period"),
    (("30", "3C"), "3(+) 90 Days: Cured or credit balance next period"),
    (("31", "32", "3P"), "3(+) 90 Days: Rolled backward or paid-up next period"),
    (("33",), "3(=) 90 Days both periods"),
    (("34", "3A"), "3(-) 90 Days: Rolled forward or adverse event next period"),
    (("40", "41", "42", "43", "4C", "4P"), "4(+) 120 Days: Rolled backward or credit balance or paid-up next period"),
    (("44", "4A"), "4(=) 120 Days both periods or 120 Days and adverse next period"),
    (("AA",), "5(=) Adverse both periods"),
    (("A0", "AC"), "5(+) Adverse: UTD or credit balance next period"),
    (("A1", "AP"), "5(+) Adverse: 30 days or paid-up next period"),
    (("A2", "A3", "A4"), "5(-) Adverse: 60+ days next period"),
    (("CC",), "6(=) Credit Balance both periods"),
    (("C0",), "6(+) Credit Balance: UTD next period"),
    (("C1", "C2", "C3", "C4", "CA", "CP"), "6(-) Credit Balance: 30+ days or paid-up or adverse event next period"),
    (("PP",), "7(=) Paid-up both periods"),
    (("P0", "PC"), "7(+) Paid-up: UTD or credit balance next period"),
    (("P1",), "7(-) Paid-up: 30 days next period"),
    (("P2", "P3", "P4", "PA"), "7(-) Paid-up: 60+ days or adverse event next period"),
    (("--", ".."), "8(.) Insufficient performance information"),
    (("DD", "XX"), "9(.) Exclusion account in either period"),
]


# wording removed from ageing transitions (the ageing profile knows no adverse events)
ADVERSE_EVENT = "or adverse event"
ADVERSE_NEXT = "or 120 Days and adverse next period"
SPACES = r"'\\s+'"
EMPTY = "''"


def transition_text_sql(code: str) -> str:
    pairs = ", ".join(f"{T.q(c)}, {T.q(text)}" for codes, text in TRANSITION_TEXT for c in codes)
    return f"try_element_at(map({pairs}), {code})"


def transition_text(code: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for codes, text in TRANSITION_TEXT for c in codes for x in (c, text)]), code)


def account_transition(
    df: DataFrame,
    ndx: int,
    pit="pit",
    age="ageing_attribute",
    dlq="delinquency_attribute",
    age_profile="age_profile",
    dlq_profile="dlq_profile",
    state="account_state",
) -> DataFrame:
    """Pair the current ageing/delinquency code with the code ``ndx`` months on (month pit-ndx).

    Adds ``transition_<ndx>_age``, ``_dlq`` (descriptions) and ``_mat`` (1 when
    they agree); empty texts and NULL match when pit <= ndx.
    """
    a, d = T.ident(age), T.ident(dlq)
    pos = f"({T.ident(pit)} - {ndx})"
    pa, pd_ = f"substr({T.ident(age_profile)}, {pos}, 1)", f"substr({T.ident(dlq_profile)}, {pos}, 1)"
    st = f"upper(substr({T.ident(state)}, 1, 1))"
    override = T.case([(f"{st} = 'B'", "'CC'"), (f"{st} = 'C'", "'PP'"), (f"{st} = 'D'", "'44'"), (f"{st} = 'X'", "'XX'")])
    excl_d = T.true_or_false(f"{d} = 'D' OR {pd_} = 'D'")
    excl_x = T.true_or_false(f"{d} = 'X' OR {pd_} = 'X'")
    age_code = T.case(
        [(excl_d, "'DD'"), (excl_x, "'XX'"),
         (T.true_or_false(f"{a} IS NULL OR {a} = '.' OR {pa} = '.'"), "'..'"),
         (T.true_or_false(f"{a} IS NULL OR {a} = '-' OR {pa} = '-'"), "'--'")],
        f"replace(concat(coalesce(CAST({a} AS STRING), 'None'), {pa}), ' ', '')",
    )
    dlq_code = T.case(
        [(excl_d, "'DD'"), (excl_x, "'XX'"), (T.true_or_false(f"{d} IS NULL OR {d} = '.' OR {pd_} = '.'"), "'..'")],
        f"replace(concat(coalesce(CAST({d} AS STRING), 'None'), {pd_}), ' ', '')",
    )
    pre = f"transition_{ndx}"
    staged = df.withColumns(
        {
            f"_{pre}_a": F.expr(transition_text_sql(f"coalesce({override}, {age_code})")),
            f"_{pre}_d": F.expr(transition_text_sql(f"coalesce({override}, {dlq_code})")),
        }
    )
    at, dt = f"_{pre}_a", f"_{pre}_d"

    def squash(x):
        return f"trim(regexp_replace({x}, {SPACES}, ' '))"

    age_txt = squash(f"replace({squash(f'replace({at}, {T.q(ADVERSE_EVENT)}, {EMPTY})')}, {T.q(ADVERSE_NEXT)}, {EMPTY})")
    ok = f"{pos} >= 1"
    return staged.withColumns(
        {
            f"{pre}_age": F.expr(f"CASE WHEN {ok} THEN {age_txt} ELSE '' END"),
            f"{pre}_dlq": F.expr(f"CASE WHEN {ok} THEN {dt} ELSE '' END"),
            f"{pre}_mat": F.expr(f"CASE WHEN {ok} THEN CAST(CASE WHEN {at} = {dt} THEN 1 END AS INT) END"),
        }
    ).drop(at, dt)


def doubtful_debt(df: DataFrame, state="account_state", pit="pit") -> DataFrame:
    """Doubtful-debt flags over 1/3/6/9/12 months for accounts in the DBT state."""
    is_dbt = F.upper(F.replace(col(state), F.lit(" "), F.lit(""))) == "D.DBTDOUBTFULDEBT(INVOLUNTARYCHURN)"
    p = col(pit)
    return df.withColumns(
        {f"doubtful_debt_{m}m_flag": flag(is_dbt & (p >= t)).cast("int") for m, t in ((1, 2), (3, 4), (6, 7), (9, 10), (12, 13))}
    )


# Ageing jumps between adjacent months (old, young, interpretation).
AGE_JUMPS = [
    ("C", "2", "aged 2 cycles"), ("P", "2", "aged 2 cycles"),
    ("C", "3", "aged 3 cycles"), ("P", "3", "aged 3 cycles"),
    ("C", "4", "aged 4 cycles"), ("P", "4", "aged 4 cycles"),
    ("0", "2", "aged 2 cycles"), ("0", "3", "aged 3 cycles"), ("0", "4", "aged 4 cycles"),
    ("1", "3", "aged 2 cycles"), ("1", "4", "aged 3 cycles"),
    ("2", "4", "aged 2 cycles"),
]


def flag_age_jumps(df: DataFrame, month_cols: Sequence[str], cycle_names: Sequence[str] | None = None) -> DataFrame:
    """Flag impossible ageing jumps between adjacent month columns (oldest first).

    Sets ``problem`` ("From a to b"), ``interpretation`` and ``cycle_id``;
    a later cycle overrides an earlier one; rows without a jump keep the
    incoming values (NULL when the columns are new).
    """
    pairs = list(zip(month_cols[:-1], month_cols[1:]))
    names = list(cycle_names) if cycle_names else [f"{a} to {b}" for a, b in pairs]
    cur = {k: (F.col(k) if k in df.columns else F.lit(None).cast("string")) for k in ("problem", "interpretation", "cycle_id")}
    for (old, young), name in zip(pairs, names):
        o, y = F.col(old), F.col(young)
        hit = None
        interp = None
        for a, b, text in AGE_JUMPS:
            t = (o == a) & (y == b)
            hit = t if hit is None else (hit | t)
            interp = F.when(t, F.lit(text)) if interp is None else interp.when(t, F.lit(text))
        hit = F.coalesce(hit, F.lit(False))
        cur = {
            "problem": F.when(hit, F.concat(F.lit("From "), o, F.lit(" to "), y)).otherwise(cur["problem"]),
            "interpretation": F.when(hit, interp).otherwise(cur["interpretation"]),
            "cycle_id": F.when(hit, F.lit(name)).otherwise(cur["cycle_id"]),
        }
    return df.withColumns(cur)
