"""Portfolio performance: segmentation, ageing buckets, roll rates and the period summary.

``portfolio_performance`` computes the dimension, ageing and portfolio
summaries in ONE aggregate with GROUPING SETS (Spark plans a single Expand
feeding a partial aggregation, so the account table is scanned once and
each grouping is pre-aggregated map-side before the shuffle).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import sqltext as T
from ledgerline.functions.rules import col, first_match, flag

# State keyword -> (dimension label, portfolio label), first match.
SEGMENT_RULES = [
    ("CLR", "03. Clear Behaviour", "00. Active (01 to 07)"),
    ("RESP", "04. Responsible Behaviour", "00. Active (01 to 07)"),
    ("ERR", "05. Erratic Behaviour", "00. Active (01 to 07)"),
    ("EXT", "06. Extended Behaviour", "00. Active (01 to 07)"),
    ("DISTRESSED", "07. Distressed Behaviour", "00. Active (01 to 07)"),
    ("CRD", "80. Voluntary Churn", "99. Churned (80 to 90)"),
    ("C01", "80. Voluntary Churn", "99. Churned (80 to 90)"),
    ("PUP", "80. Voluntary Churn", "99. Churned (80 to 90)"),
    ("P01", "80. Voluntary Churn", "99. Churned (80 to 90)"),
    ("P03", "80. Voluntary Churn", "99. Churned (80 to 90)"),
    ("DBT", "90. Involuntary Churn", "99. Churned (80 to 90)"),
    ("EXC", "90. Involuntary Churn", "99. Churned (80 to 90)"),
]
# The earlier variant tests "RES" and "DIS" where the current one tests "RESP" and "DISTRESSED".
LEGACY_KEYWORDS = {"RESP": "RES", "DISTRESSED": "DIS"}
NEW_LABELS = ("01. New (MOB=00)", "00. Active (01 to 07)")
IMMATURE_LABELS = ("02. Immature (MOB=01-05)", "00. Active (01 to 07)")

# Ageing attribute -> ageing segment.
AGEING_SEGMENTS = [
    ("0", "10. UTD Accounts"),
    ("1", "11. 30 Day Accounts"),
    ("2", "12. 60 Day Accounts"),
    ("3", "13. 90 Day Accounts"),
    ("4", "14. 120+ Day Accounts"),
    ("C", "60. Voluntary Churn (Aging)"),
    ("P", "60. Voluntary Churn (Aging)"),
]
AGEING_OTHER = "70. Exclusions (Aging)"

# Roll-rate flag -> transition text (upper-case, spaces removed).
ROLL_RATES = [
    ("dc0_credit_paidup", "0(+)UTD:CREDITBALANCEORPAID-UPNEXTPERIOD"),
    ("dc0_utd", "0(=)UTDBOTHPERIODS"),
    ("dc0_forward_roll", "0(-)UTD:ROLLEDFORWARDNEXTPERIOD"),
    ("dc1_cured", "1(+)30DAYS:CUREDORCREDITBALANCEORPAID-UPNEXTPERIOD"),
    ("dc1_30days", "1(=)30DAYSBOTHPERIODS"),
    ("dc1_forward_roll", "1(-)30DAYS:ROLLEDFORWARDNEXTPERIOD"),
    ("dc2_cured", "2(+)60DAYS:CUREDORCREDITBALANCENEXTPERIOD"),
    ("dc2_backward_roll", "2(+)60DAYS:ROLLEDBACKWARDORPAID-UPNEXTPERIOD"),
    ("dc2_60days", "2(=)60DAYSBOTHPERIODS"),
    ("dc2_forward_roll", "2(-)60DAYS:ROLLEDFORWARDNEXTPERIOD"),
    ("dc3_cured", "3(+)90DAYS:CUREDORCREDITBALANCENEXTPERIOD"),
    ("dc3_backward_roll", "3(+)90DAYS:ROLLEDBACKWARDORPAID-UPNEXTPERIOD"),
    ("dc3_90days", "3(=)90DAYSBOTHPERIODS"),
    ("dc3_forward_roll", "3(-)90DAYS:ROLLEDFORWARDNEXTPERIOD"),
    ("dc4_backward_roll", "4(+)120DAYS:ROLLEDBACKWARDORCREDITBALANCEORPAID-UPNEXTPERIOD"),
    ("dc4_120days", "4(=)120DAYSBOTHPERIODS"),
]

DEFAULT_MEASURES = ["next_cycle_30_days", "second_cycle_60_days", "third_cycle_90_days"]
PERIODS = (1, 3, 6, 9, 12)
# Measures summed per segment (order of the summary).
MEASURES = (
    ["records", "records_dc0", "records_dc1", "records_dc2", "records_dc3", "records_dc4", "balance", "instalment"]
    + DEFAULT_MEASURES
    + [f"{k}_{n}" for n in PERIODS for k in ("goods", "bads")]
    + [f"doubtful_debt_{n}m" for n in PERIODS]
    + [name for name, _ in ROLL_RATES]
)


def portfolio_segmentation(df: DataFrame, dim: str = "account", m00="account_m00", new="account_new", state=None,
                           legacy: bool = False) -> DataFrame:
    """``yoy_<dim>`` and ``yoy_portfolio`` from new/immature flags, then state keywords.

    ``legacy=True`` is the earlier variant: RES/DIS keywords, and a non-NULL
    new/immature count below 1 gives NULL labels.
    """
    st = f"upper({T.ident(state or f'{dim}_state')})"
    m, n = T.ident(m00), T.ident(new)
    kw = []
    for word, dlab, plab in SEGMENT_RULES:
        w = LEGACY_KEYWORDS.get(word, word) if legacy else word
        kw.append((T.true_or_false(f"instr({st}, {T.q(w)}) > 0"), dlab, plab))
    if legacy:
        head_d = [(f"{m} IS NOT NULL", f"CASE WHEN {m} >= 1 THEN {T.q(NEW_LABELS[0])} END"),
                  (f"{n} IS NOT NULL", f"CASE WHEN {n} >= 1 THEN {T.q(IMMATURE_LABELS[0])} END")]
        head_p = [(f"{m} IS NOT NULL", f"CASE WHEN {m} >= 1 THEN {T.q(NEW_LABELS[1])} END"),
                  (f"{n} IS NOT NULL", f"CASE WHEN {n} >= 1 THEN {T.q(IMMATURE_LABELS[1])} END")]
    else:
        head_d = [(T.true_or_false(f"{m} >= 1"), T.q(NEW_LABELS[0])), (T.true_or_false(f"{n} >= 1"), T.q(IMMATURE_LABELS[0]))]
        head_p = [(T.true_or_false(f"{m} >= 1"), T.q(NEW_LABELS[1])), (T.true_or_false(f"{n} >= 1"), T.q(IMMATURE_LABELS[1]))]
    dim_lab = T.case(head_d + [(c, T.q(d)) for c, d, _ in kw], "''")
    port_lab = T.case(head_p + [(c, T.q(p)) for c, _, p in kw], "''")
    return df.withColumns({f"yoy_{dim}": F.expr(dim_lab), "yoy_portfolio": F.expr(port_lab)})


def segment_by_ageing(df: DataFrame, acc: str = "accounts", age: str = "account_age", enabled: bool = True) -> DataFrame:
    """Per-bucket record counters and the ageing segment (all NULL when ``enabled`` is False)."""
    if not enabled:
        return df.withColumns({**{f"records_dc{k}": F.lit(None).cast("int") for k in range(5)},
                               "yoy_aging": F.lit(None).cast("string")})
    a, c = T.ident(age), T.ident(acc)
    out = {f"records_dc{k}": F.expr(f"CASE WHEN {a} = '{k}' THEN {c} END") for k in range(5)}
    out["yoy_aging"] = F.expr(T.case([(f"{a} = {T.q(code)}", T.q(lab)) for code, lab in AGEING_SEGMENTS], T.q(AGEING_OTHER)))
    return df.withColumns(out)


def roll_rate_flags(df: DataFrame, transition: str = "transition_1_age", enabled: bool = True) -> DataFrame:
    """16 roll-rate flags (1/NULL) from the one-month ageing transition text."""
    if not enabled:
        return df.withColumns({name: F.lit(None).cast("int") for name, _ in ROLL_RATES})
    staged = df.withColumn("_tr", F.expr(f"replace(upper({T.ident(transition)}), ' ', '')"))
    return staged.withColumns(
        {name: F.expr(f"CAST(CASE WHEN _tr = {T.q(text)} THEN 1 END AS INT)") for name, text in ROLL_RATES}
    ).drop("_tr")


def portfolio_input(df: DataFrame, dim: str, yoy: str, acc: str = "accounts") -> DataFrame:
    """Record counter, period label and segment placeholders (the temporary data file)."""
    return df.withColumns(
        {
            "records": F.col(acc),
            "yoy_label": F.lit(yoy),
            "yoy_portfolio": F.lit("99. No Data"),
            f"yoy_{dim}": F.lit("99. No Data"),
            "yoy_aging": F.lit("99. No Data"),
        }
    )


def _pct(num: str, den: str) -> str:
    return f"CAST(try_divide({num}, {den}) * 100 AS FLOAT)"


def summary_metrics(agg: DataFrame, per: str) -> DataFrame:
    """Averages (int) and rates (float %) from summed measures, suffixed by the period."""
    per = str(per)[:4]
    out = {
        f"balance_{per}": "CAST(try_divide(balance, records) AS INT)",
        f"instalment_{per}": "CAST(try_divide(instalment, records) AS INT)",
    }
    for m in DEFAULT_MEASURES:
        out[f"{m}_{per}"] = _pct(m, "records")
    for n in PERIODS:
        out[f"bad_rate_{n}m_{per}"] = _pct(f"bads_{n}", f"(goods_{n} + bads_{n})")
    for n in PERIODS:
        out[f"doubtful_debt_{n}m_{per}"] = _pct(f"doubtful_debt_{n}m", "records")
    for k in range(5):
        out[f"records_dc{k}_{per}"] = f"CAST(records_dc{k} AS INT)"
    for name, _ in ROLL_RATES:
        out[f"{name}_{per}"] = _pct(name, f"records_dc{name[2]}")
    return agg.withColumns({k: F.expr(v) for k, v in out.items()}).drop(*MEASURES)


def portfolio_summary(df: DataFrame, var: str, per: str) -> DataFrame:
    """Summary for one segmentation column (grouped with the period label)."""
    agg = df.groupBy(var, "yoy_label").agg(*[F.sum(m).alias(m) for m in MEASURES])
    return summary_metrics(agg, per)


def portfolio_states(df: DataFrame, dim: str = "account", yoy: str = "2024", acc: str = "accounts", age: bool = True) -> DataFrame:
    """Mergeable states of the summaries: (view, ``yoy_<dim>``, yoy_label, sums of all measures), before any average or rate.

    One pass: segmentation, ageing and roll-rate columns are projections, and the three views are one GROUPING SETS
    aggregate.  A state has a row per view and segment, whatever the accounts; states of disjoint rows (months, say) add up,
    so a store of them by period answers for any periods without reading accounts again (``performance_of``).
    """
    ydim = f"yoy_{dim}"
    staged = portfolio_input(df, dim, yoy, acc)
    staged = portfolio_segmentation(staged, dim)
    staged = segment_by_ageing(staged, acc, enabled=age)
    staged = roll_rate_flags(staged, enabled=age)
    sets = [[ydim, "yoy_label"], ["yoy_aging", "yoy_label"], ["yoy_portfolio", "yoy_label"]]
    agg = staged.groupingSets(sets, ydim, "yoy_aging", "yoy_portfolio", "yoy_label").agg(
        *[F.sum(m).alias(m) for m in MEASURES],
        F.grouping(ydim).alias("_g_dim"),
        F.grouping("yoy_aging").alias("_g_age"),
    )
    seg = F.expr(f"CASE WHEN _g_dim = 0 THEN {T.ident(ydim)} WHEN _g_age = 0 THEN yoy_aging ELSE yoy_portfolio END")
    view = F.expr("CASE WHEN _g_dim = 0 THEN 'dimension' WHEN _g_age = 0 THEN 'ageing' ELSE 'portfolio' END")
    return agg.select(view.alias("view"), seg.alias(ydim), "yoy_label", *MEASURES)


def performance_of(states: DataFrame, dim: str = "account", per: str = "2024", sort: bool = True) -> DataFrame:
    """The report of some ``portfolio_states`` rows (of one period or several, of one label or several): states of the same
    view, segment and label are added up, then averaged."""
    ydim = f"yoy_{dim}"
    agg = states.groupBy("view", ydim, "yoy_label").agg(*[F.sum(m).alias(m) for m in MEASURES])
    out = summary_metrics(agg.drop("view"), per)
    return out.orderBy(ydim) if sort else out


def portfolio_performance(df: DataFrame, dim: str = "account", yoy: str = "2024", acc: str = "accounts",
                          age: bool = True, per: str = "2024", sort: bool = True) -> DataFrame:
    """Dimension, ageing and portfolio summaries stacked under ``yoy_<dim>``, from the accounts in one pass."""
    out = summary_metrics(portfolio_states(df, dim, yoy, acc, age).drop("view"), per)
    return out.orderBy(f"yoy_{dim}") if sort else out


# Collections-system analysis codes -> flag columns.
ANALYSIS_A_FLAGS = [
    ("CURRENT", "a_current_nbr"),
    ("COLLECTION", "a_collections_nbr"),
    ("INT UNALLO", "a_internal_allocation_nbr"),
    ("EXT ALLOC", "a_external_allocation_nbr"),
    ("PREWRITEOF", "a_churn_bad_debt_nbr"),
    ("PRECLOSED", "a_churn_voluntary_nbr"),
]
ANALYSIS_B_FLAGS = [("PRE_LEGAL", "b_churn_bad_debt_nbr"), ("ARCHIVED", "b_churn_voluntary_nbr")]


def collections_segmentation(df: DataFrame, an_a="an_a", an_b="an_b", crd="crd_nbr", pup="pup_nbr",
                             waterfall="filter_waterfall") -> DataFrame:
    """Analysis-code flags and, for an empty waterfall, the churn segment 91-94."""
    a = F.upper(F.coalesce(col(an_a), F.lit("")))
    b = F.upper(F.coalesce(col(an_b), F.lit("")))
    out = {name: flag(a == code).cast("int") for code, name in ANALYSIS_A_FLAGS}
    out.update({name: flag(b == code).cast("int") for code, name in ANALYSIS_B_FLAGS})
    seg = first_match(
        [
            ((a == "PREWRITEOF") | (b == "PRE_LEGAL"), "91 Bad Debt (120-239 Days)"),
            ((a == "PRECLOSED") | (b == "ARCHIVED"), "92 Voluntary Churn (Attrition)"),
            ((a == "CURRENT") & F.coalesce(col(crd) == 1, F.lit(False)), "93 Voluntary Churn (Credit Balance)"),
            ((a == "CURRENT") & F.coalesce(col(pup) == 1, F.lit(False)), "94 Voluntary Churn (Paid Up)"),
        ],
        "",
    )
    wf = col(waterfall)
    out["filter_waterfall"] = F.when(wf == "", seg).otherwise(wf)
    return df.withColumns(out)


def ecl_features(df: DataFrame) -> DataFrame:
    """Copy the bad-debt month, events and subscriptions under their ECL names."""
    return df.withColumns(
        {
            "ecl_bad_debt_month": F.col("bad_month"),
            "ecl_bad_debt_events": F.col("bad_events"),
            "ecl_bad_debt_subscriptions": F.col("bad_subscriptions"),
        }
    )
