"""Decision-services waterfall and report.

Twelve segments are applied in order.  Each segment (a) claims applications
by state/channel and writes its segment code, its filter flag and -- when a
policy rule fails -- the waterfall text, (b) bands the bureau and customer
scores into a matrix and sets the outcome ("Approve <grade>" when the
waterfall is still empty, else "Decline"), (c) maps the matrix to a risk
grade.  Later segments see what earlier ones wrote (as delivered: an
application passed by one segment arrives at an overlapping later segment
with a non-empty waterfall and is declined there).  Every step is a
projection of CASE expressions; nothing leaves the JVM.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import sqltext as T
from ledgerline.functions.rules import first_match
from ledgerline.operators.applications import risk_grade_mandate

# Policy rules shared by every segment (column, label); a rule fails on "Y"
# except the age rule, which fails below 1800 (years x 100).
POLICY_RULES = [
    ("cst_deceased", "P01 Consumer Deceased"),
    ("cst_customerage", "P02 Consumer Age < 18"),
    ("cst_fraud", "P03 Payment Profile Fraud"),
    ("cst_sequestration", "P04 Consumer Sequestrated"),
    ("cst_dispute", "P05 Payment Profile Dispute"),
    ("cst_emigrated", "P06 Consumer Emigrated"),
    ("all_notices5years", "P07 Public Notice Issued"),
    ("cst_debtreviewgranted", "P08 Debt Review Granted"),
]
DEBT_REVIEW_REQUESTED = ("cst_debtreviewrequested", "G01 Debt Review Requested")
LOW_INCOME = ("app_gross_income", "C06 Gross Income < R1500")


@dataclass(frozen=True)
class Segment:
    code: str                      # segment code written to decision_services_segment
    flag: str                      # filter column set to 1 for claimed applications
    states: tuple | None = None    # customer states claimed (None: by trade history)
    channel: str | None = None     # channel one-hot that must be set
    debt_review: bool = True       # G01 rule present
    income: bool = True            # C06 rule present
    checks: tuple = ()             # (column, op, value, label) after the shared rules
    grade: str = ""                # risk-grade label of the matrix
    prism_cuts: tuple = ()
    score_col: str = ""
    score_cuts: tuple = ()
    matrix_states: tuple | None = None   # states whose matrix is computed (default: the claimed ones)
    grades: tuple = ()             # (matrix, risk grade)
    claim_code: str | None = None  # segment code as written (differs from code for CLR)
    extra: dict = field(default_factory=dict)


NEW_OR_IMM = ("", "IMM MOB 00-05")
ARREARS = ("EXT Extended", "DIS Distressed", "DBT Doubtful Debt")

# The twelve segments in order, with their policy checks, score matrices and grade tables.
SEGMENTS = [
    Segment("NTC", "filter_new_to_credit", None, None, True, True,
            (("ntc_accept_final_score_v01", "null", None, "C01 Accept Final Score V01 is None"),
             ("ntc_accept_final_score_v01", "<", 580, "C01 Accept Final Score V01 < 580"),
             ("ntc_accept_risk_score_v01", "null", None, "C01 Accept Risk Score V01 is None"),
             ("ntc_accept_risk_score_v01", "<", 580, "C01 Accept Risk Score V01 < 580")),
            "RG9", (999, 999, 999, 999, 999, 999), "new_customer_score", (999, 999, 999, 999, 999, 999)),
    Segment("TSO", "filter_telesales_outbound", NEW_OR_IMM, "filter_channel_outbound", True, True,
            (("cbx_prism_tm", "<", 580, "C01 Prism TM < 580"), ("new_customer_score", "<", 555, "C01 New Customer Score < 555"),
             ("all_perc0delq90days", "<", 60, "G02 UTD bureau trades last 90 days < 60%"),
             ("all_numpayments90days", "==", 0, "G04 Number bureau payments last 90 days = 0")),
            "RG9", (580, 999, 999, 999, 999, 999), "new_customer_score", (555, 999, 999, 999, 999, 999),
            grades=(("580x555", "9"), ("580x585", "8"), ("640x555", "8"), ("640x585", "8"))),
    Segment("TSI", "filter_telesales_inbound", NEW_OR_IMM, "filter_channel_inbound", True, True,
            (("cbx_prism_tm", "<", 580, "C01 Prism TM < 580"), ("new_customer_score", "<", 555, "C01 New Customer Score < 555"),
             ("all_perc0delq90days", "<", 40, "G02 UTD bureau trades last 90 days < 40%"),
             ("all_numpayments90days", "==", 0, "G04 Number bureau payments last 90 days = 0")),
            "RG8", (580, 999, 999, 999, 999, 999), "new_customer_score", (555, 999, 999, 999, 999, 999),
            grades=(("580x555", "9"), ("580x585", "8"), ("600x555", "8"), ("600x585", "8"))),
    Segment("WWW", "filter_web_service", NEW_OR_IMM, "filter_channel_online", True, True,
            (("cbx_prism_tm", "<", 580, "C01 Prism TM < 580"), ("new_customer_score", "<", 555, "C01 New Customer Score < 555"),
             ("all_perc0delq90days", "<", 20, "G02 UTD bureau trades last 90 days < 20%"),
             ("all_numpayments90days", "==", 0, "G04 Number bureau payments last 90 days = 0")),
            "RG7", (580, 999, 999, 999, 999, 999), "new_customer_score", (555, 999, 999, 999, 999, 999)),
    Segment("FAA", "filter_first_account_applicant", ("",), None, True, True,
            (("cbx_prism_tm", "<", 580, "C01 Prism TM < 580"), ("new_customer_score", "<", 555, "C01 New Customer Score < 555"),
             ("all_perc0delq90days", "<", 20, "G02 UTD bureau trades last 90 days < 20%"),
             ("all_numpayments90days", "==", 0, "G04 Number bureau payments last 90 days = 0")),
            "RG7", (580, 625, 655, 999, 999, 999), "new_customer_score", (555, 590, 605, 999, 999, 999),
            grades=(("580x555", "9"), ("580x590", "7"), ("580x605", "6"), ("625x555", "7"), ("625x590", "6"), ("625x605", "5"),
                    ("655x555", "5"), ("655x590", "5"), ("655x605", "4"))),
    Segment("IMM", "filter_immature_state", ("IMM MOB 00-05",), None, True, True,
            (("cbx_prism_tm", "<", 580, "C01 Prism TM < 580"), ("new_customer_score", "<", 555, "C01 New Customer Score < 555"),
             ("all_perc0delq90days", "<", 20, "G02 UTD bureau trades last 90 days < 20%"),
             ("all_numpayments90days", "==", 0, "G04 Number bureau payments last 90 days = 0")),
            "RG7", (580, 640, 999, 999, 999, 999), "new_customer_score", (555, 590, 615, 999, 999, 999),
            matrix_states=("",),
            grades=(("580x555", "8"), ("580x590", "6"), ("580x615", "6"), ("640x555", "7"), ("640x590", "5"), ("640x615", "4"))),
    Segment("PUP", "filter_xxxxxx_state", ("PUP Paid-Up",), None, True, False,
            (("cbx_prism_tm", "<", 570, "C01 Prism TM < 570"), ("est_customer_score", "<", 540, "C01 Established Customer Score < 540"),
             ("all_perc0delq90days", "<", 10, "G02 UTD bureau trades last 90 days < 10%"),
             ("all_numpayments90days", "==", 0, "G04 Number bureau payments last 90 days = 0")),
            "RG7", (570, 999, 999, 999, 999, 999), "est_customer_score", (540, 615, 630, 999, 999, 999),
            grades=(("570x540", "8"), ("570x615", "7"), ("570x630", "6"))),
    # The credit-balance step re-runs the paid-up rule set (so it claims no credit-balance application)
    # and then bands and grades the credit-balance applications.
    Segment("CRD", "filter_xxxxxx_state", ("PUP Paid-Up",), None, True, False,
            (("cbx_prism_tm", "<", 570, "C01 Prism TM < 570"), ("est_customer_score", "<", 540, "C01 Established Customer Score < 540"),
             ("all_perc0delq90days", "<", 10, "G02 UTD bureau trades last 90 days < 10%"),
             ("all_numpayments90days", "==", 0, "G04 Number bureau payments last 90 days = 0")),
            "RG3", (570, 630, 999, 999, 999, 999), "est_customer_score", (540, 605, 999, 999, 999, 999),
            matrix_states=("CRD Credit Balance",), claim_code="PUP",
            grades=(("570x540", "5"), ("570x605", "4"), ("630x540", "5"), ("630x605", "3"))),
    Segment("CLR", "filter_clear_state", ("CLR Clear",), None, False, False,
            (("est_customer_score", "<", 540, "C01 Established Customer Score < 540"),),
            "RG2", (100, 625, 635, 665, 999, 999), "est_customer_score", (540, 600, 645, 999, 999, 999), claim_code="CRD",
            grades=(("100x540", "5"), ("100x600", "4"), ("100x645", "3"), ("625x540", "5"), ("625x600", "3"), ("625x645", "3"),
                    ("635x540", "5"), ("635x600", "3"), ("635x645", "2"), ("665x540", "3"), ("665x600", "2"), ("665x645", "1"))),
    Segment("RES", "filter_responsible_state", ("RES Responsible",), None, False, False,
            (("est_customer_score", "<", 540, "C01 Established Customer Score < 540"),),
            "RG5", (100, 640, 670, 999, 999, 999), "est_customer_score", (540, 570, 610, 640, 999, 999),
            grades=(("100x540", "8"), ("100x570", "7"), ("100x610", "6"), ("100x640", "5"), ("640x540", "7"), ("640x570", "6"),
                    ("640x610", "5"), ("640x640", "4"), ("670x540", "6"), ("670x570", "5"), ("670x610", "4"), ("670x640", "3"))),
    Segment("ERR", "filter_erratic_state", ("ERR Erratic",), None, False, False,
            (("cbx_prism_tm", "<", 580, "C01 Prism TM < 580"), ("est_customer_score", "<", 555, "C01 Established Customer Score < 555")),
            "RG7", (580, 640, 670, 999, 999, 999), "est_customer_score", (555, 605, 625, 635, 645, 999),
            grades=(("580x555", "8"), ("580x605", "7"), ("580x625", "7"), ("580x635", "6"), ("580x645", "6"), ("640x555", "7"),
                    ("640x605", "7"), ("640x625", "6"), ("640x635", "6"), ("640x645", "5"), ("670x555", "6"), ("670x605", "5"),
                    ("670x625", "5"), ("670x635", "5"), ("670x645", "4"))),
    Segment("ARR", "filter_arrears_state", ARREARS, None, True, False,
            (("cbx_prism_tm", "<", 615, "C01 Prism TM < 615"), ("est_customer_score", "<", 590, "C01 Established Customer Score < 590"),
             ("all_perc0delq90days", "<", 50, "G02 UTD bureau trades last 90 days < 50%")),
            "RG8", (615, 690, 999, 999, 999, 999), "est_customer_score", (590, 655, 999, 999, 999, 999),
            grades=(("615x590", "8"), ("615x655", "7"), ("690x590", "7"), ("690x655", "6"))),
]


def fixed_segments() -> list:
    """The segments as evidently intended: the credit-balance step claims credit-balance applications
    with its own code, the immature matrix is computed for immature applications and the clear step
    writes its own code."""
    from dataclasses import replace

    out = []
    for seg in SEGMENTS:
        if seg.code == "CRD":
            seg = replace(seg, states=("CRD Credit Balance",), matrix_states=None, claim_code=None)
        elif seg.code == "IMM":
            seg = replace(seg, matrix_states=None)
        elif seg.code == "CLR":
            seg = replace(seg, claim_code=None)
        out.append(seg)
    return out


OUTPUT_FLAGS = ["filter_new_to_credit", "filter_telesales_outbound", "filter_telesales_inbound", "filter_web_service",
                "filter_first_account_applicant", "filter_immature_state", "filter_xxxxxx_state", "filter_clear_state",
                "filter_responsible_state", "filter_erratic_state", "filter_arrears_state"]
ACTIVATION_FLAGS = ["filter_immature_activations", "filter_clear_activations", "filter_responsible_activations",
                    "filter_erratic_activations", "filter_arrears_activations", "filter_other_activations"]


def _yes(c: str) -> str:
    return T.true_or_false(f"{c} = 'Y'")


def _claims(seg: Segment, states) -> str:
    if states is None:
        return T.true_or_false("all_timeoldesttrade < 3")
    cond = T.true_or_false(T.in_list("app_customer_state", states))
    return f"({cond} AND {seg.channel} IS NOT NULL)" if seg.channel else cond


def _rules_of(seg: Segment) -> list[tuple[str, str]]:
    """(condition, label) of a segment's policy rules in their order; in the NTC segment missing values fail as well."""
    missing = seg.code == "NTC"

    def below(c, v):
        return f"({c} IS NULL OR {c} < {v})" if missing else T.true_or_false(f"{c} < {v}")

    out = [(below(c, 1800) if c == "cst_customerage" else _yes(c), label) for c, label in POLICY_RULES]
    if seg.debt_review:
        out.append((_yes(DEBT_REVIEW_REQUESTED[0]), DEBT_REVIEW_REQUESTED[1]))
    if seg.income:
        out.append((below(LOW_INCOME[0], 1500), LOW_INCOME[1]))
    for c, op, v, label in seg.checks:
        out.append((f"{c} IS NULL" if op == "null" else T.true_or_false(f"{c} {'<' if op == '<' else '='} {v}"), label))
    return out


def _rule_table(segments: list[Segment]) -> tuple[list[tuple[str, str]], list[int]]:
    """(all distinct rules in an order that is every segment's own, each segment's rules as a bit mask over them)."""
    order: list[tuple[str, str]] = []
    for seg in segments:
        place = -1
        for rule in _rules_of(seg):
            if rule not in order:
                order.insert(place + 1, rule)
            if order.index(rule) <= place:
                raise ValueError(f"{seg.code} tests {rule[1]!r} in another order than earlier segments")
            place = order.index(rule)
    if len(order) > 63:
        raise ValueError("more rules than the bits of a long")
    return order, [sum(1 << order.index(rule) for rule in _rules_of(seg)) for seg in segments]


def _bits(conditions: list[str]) -> str:
    """A long with bit i set where condition i holds."""
    return "(" + " | ".join(f"(CASE WHEN {c} THEN {1 << i}L ELSE 0L END)" for i, c in enumerate(conditions)) + ")"


def _lowest(bits: str) -> str:
    """The number of the lowest set bit."""
    return f"bit_count(({bits} & -({bits})) - 1L)"


def _listed(values: list[str], place: str) -> str:
    return f"element_at(array({', '.join(values)}), CAST({place} AS INT) + 1)"


def _band(x: str, cuts) -> str:
    """Band label of a score: '001' below the first cut-off, else the highest cut-off reached."""
    rules = [(f"{x} < {cuts[0]}", "'001'")] + [(f"{x} < {cuts[i]}", T.q(str(cuts[i - 1]))) for i in range(1, len(cuts))]
    return f"CASE WHEN {x} IS NULL THEN NULL ELSE {T.case(rules, T.q(str(cuts[-1])))} END"


def decision_waterfall(df: DataFrame, fixed: bool = False) -> DataFrame:
    """Apply the twelve segments in order; adds segment, outcome, waterfall, matrix, risk grade,
    the segment filter flags and the activation flags.  ``fixed=True`` uses ``fixed_segments()``.

    A bitmap decision table: every distinct rule is one bit of a long, computed once a row, and a segment's first failing
    rule is the lowest bit of that long under the segment's mask.  Claims and computed matrices are one bit a segment, the
    last segment the lowest, so that what the steps one after the other leave behind is the lowest set bit of a few longs,
    and the bands and grades of a row's own segments only are looked up.
    """
    segments = fixed_segments() if fixed else SEGMENTS
    rules, masks = _rule_table(segments)
    last_first = list(reversed(segments))
    masks = masks[::-1]
    claims = [_claims(s, s.states) for s in last_first]
    dones = [_claims(s, s.matrix_states if s.matrix_states is not None else s.states) for s in last_first]
    # as delivered for IMM: computed for one state, applied to another -> NULL results there
    applied = [c if s.code == "IMM" and not fixed else d for s, c, d in zip(last_first, claims, dones)]
    mats = [f"concat({_band('cbx_prism_tm', s.prism_cuts)}, 'x', {_band(s.score_col, s.score_cuts)})" for s in last_first]
    staged = df.withColumns({"_rules": F.expr(_bits([c for c, _ in rules])), "_claim": F.expr(_bits(claims)),
                             "_applied": F.expr(_bits(applied)), "_done": F.expr(_bits([f"({a} AND {d})" for a, d in zip(applied, dones)]))})
    # what counts for the waterfall stands after the last step that wiped it (applied, but not computed)
    fails = " | ".join(f"(CASE WHEN (_rules & {m}L) <> 0 THEN {1 << i}L ELSE 0L END)" for i, m in enumerate(masks))
    wiped = "(_applied & ~_done)"
    after = f"CASE WHEN {wiped} = 0 THEN -1L ELSE ({wiped} & -{wiped}) - 1L END"
    staged = staged.withColumns({"_fail": F.expr(f"_claim & ({fails}) & ({after})"), "_pass": F.expr(f"_done & ({after})"),
                                 "_last": F.expr("_applied & -_applied")})
    own = f"(_rules & {_listed([f'{m}L' for m in masks], _lowest('_fail'))})"
    labels = _listed([T.q(label) for _, label in rules], _lowest(own))
    computed = "(_last & _done) <> 0"
    grades = []
    for i, (s, mat) in enumerate(zip(last_first, mats)):
        if s.grades:
            table = "map(" + ", ".join(f"{T.q(k)}, {T.q(v)}" for k, v in s.grades) + ")"
            grades.append(f"CASE WHEN (_done & {1 << i}L) <> 0 THEN try_element_at({table}, {mat}) END")
    flags = {f: sum(1 << i for i, s in enumerate(last_first) if s.flag == f) for f in OUTPUT_FLAGS}
    flags = {f: f"(_claim & {m}L) <> 0" for f, m in flags.items()}
    flags["filter_xxxxxx_state"] += " OR _claim = 0"
    out = {
        "decision_services_segment": f"CASE WHEN _claim = 0 THEN 'XXX' ELSE {_listed([T.q(s.claim_code or s.code) for s in last_first], _lowest('_claim'))} END",
        **{f: f"CAST(CASE WHEN {c} THEN 1 END AS INT)" for f, c in flags.items()},
        "decision_services_waterfall": f"CASE WHEN _fail <> 0 THEN {labels} WHEN _pass <> 0 THEN 'P. Pass Credit Policies' END",
        "decision_services_outcome": f"CASE WHEN _claim = 0 THEN 'Decline' WHEN NOT ({computed}) THEN NULL "
                                     f"WHEN (_fail & -_last) = 0 AND (_pass & -(2L * _last)) = 0 "
                                     f"THEN {_listed([T.q('Approve ' + s.grade) for s in last_first], _lowest('_last'))} ELSE 'Decline' END",
        "decision_services_matrix": f"CASE WHEN {computed} THEN CASE _last " + " ".join(f"WHEN {1 << i}L THEN {m}" for i, m in enumerate(mats)) + " END END",
        "decision_services_risk_grade": f"coalesce({', '.join(grades)})",
    }
    return activation_flags(staged.withColumns({c: F.expr(e) for c, e in out.items()}).drop(
        "_rules", "_claim", "_applied", "_done", "_fail", "_pass", "_last"))


def activation_flags(df: DataFrame, subscriptions: str = "app_subscriptions", state: str = "customer_state") -> DataFrame:
    """Applications with subscriptions: immature / clear / responsible / erratic / arrears / other (one-hot)."""
    has = F.col(subscriptions).isNotNull()
    st = F.coalesce(F.col(state), F.lit(""))

    def on(c):
        return F.coalesce(F.col(c), F.lit(0)) == 1

    idx = first_match([(st == "IMM MOB 00-05", 1), (on("filter_clear_state"), 2), (on("filter_responsible_state"), 3),
                       (on("filter_erratic_state"), 4), (on("filter_arrears_state"), 5)], 6)
    return df.withColumns({name: F.when(has & (idx == i + 1), F.lit(1)).cast("int") for i, name in enumerate(ACTIVATION_FLAGS)})


# Measures summed per report group (FREQ is the applicant counter).
REPORT_MEASURES = [
    "freq", "app_subscriptions", "app_accounts", "filter_decision_outcome_approved", "filter_decision_outcome_referred",
    "filter_decision_outcome_declined", "filter_approved_with_activations", "filter_referred_with_activations",
    "filter_declined_with_activations", "filter_approved_no_activations", "filter_referred_no_activations",
    "filter_declined_no_activations", "badrate1m", "badrate3m", "badrate6m", "badrate9m", "badrate12m",
    "goods1", "bads1", "goods3", "bads3", "goods6", "bads6", "goods9", "bads9", "goods12", "bads12",
    "app_customer_score", "app_customer_score_cnt", "new_customer_score", "new_customer_score_cnt",
    "cam_customer_score", "cam_customer_score_cnt", "est_customer_score", "est_customer_score_cnt",
    "cbx_prism_tm", "cbx_prism_tm_cnt", "ntc_accept_risk_score_v01", "ntc_accept_risk_score_v01_cnt",
    "ntc_accept_final_score_v01", "ntc_accept_final_score_v01_cnt", "app_subscription_limit", "app_subscription_limit_cnt",
    "app_gross_income", "app_gross_income_cnt", "app_predicted_income", "app_predicted_income_cnt",
]
SCORE_AVERAGES = ["app_customer_score", "new_customer_score", "cam_customer_score", "est_customer_score", "cbx_prism_tm",
                  "ntc_accept_risk_score_v01", "ntc_accept_final_score_v01", "app_subscription_limit", "app_gross_income",
                  "app_predicted_income"]


def decision_metrics(agg: DataFrame) -> DataFrame:
    c = F.col
    apps = c("filter_decision_outcome_approved") + c("filter_decision_outcome_referred") + c("filter_decision_outcome_declined")
    staged = agg.withColumn("_apps", apps)
    out = {}
    for o in ("approved", "referred", "declined"):
        x = c(f"filter_decision_outcome_{o}")
        out[f"filter_decision_outcome_{o}"] = F.when(c("_apps").isNotNull(), F.lit(100) * x / c("_apps"))
        w, n = c(f"filter_{o}_with_activations"), c(f"filter_{o}_no_activations")
        out[f"filter_{o}_with_activations"] = F.when(w.isNotNull(), F.lit(100) * w / (w + n))
    for k in (1, 3, 6, 9, 12):
        g, b = c(f"goods{k}"), c(f"bads{k}")
        # the integer cast applies to the denominator only, so the rate keeps its decimals
        out[f"badrate{k}m"] = F.when((g + b > 50) & (c("app_accounts") >= 50), (F.lit(1000) * b / (g + b).cast("int")) / F.lit(10))
    for s in SCORE_AVERAGES:
        out[s] = F.when(c(f"{s}_cnt").isNotNull(), (c(s) / c(f"{s}_cnt")).cast("int"))
    return staged.withColumns(out).drop("_apps")


def decision_report(df: DataFrame, var: str) -> DataFrame:
    """Sum the 47 measures per segment, waterfall, outcome and ``var``; derive shares, bad rates,
    average scores and the risk-grade mandate.  Partial aggregation before the shuffle."""
    base = df.withColumn("freq", F.lit(1))
    keys = ["decision_services_segment", "decision_services_waterfall", "decision_services_outcome", var]
    agg = base.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in REPORT_MEASURES]).withColumnRenamed("freq", "applicants")
    out = decision_metrics(agg)
    return risk_grade_mandate(out, "applicants", "app_accounts", "badrate12m", "badrate9m", "badrate6m")
