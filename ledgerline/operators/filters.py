"""Account filter waterfall, one-hot filters and application-activation status.

``filter_waterfall`` folds an ordered list of filters into one projection:
each filter contributes its flag columns, and the waterfall label is the
label of the first filter that holds, written only when the incoming
waterfall is the empty string (the business-subscriptions filter overwrites
whatever is there, as delivered; ``fixed=True`` makes it respect "" too).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import sqltext as T
from ledgerline.functions.rules import col, first_match, first_match_index, flag, pick


def _z(c: Column) -> Column:
    return F.coalesce(c, F.lit(0))


def _label(*parts) -> Column:
    """Concatenate text parts and collapse runs of spaces."""
    return F.regexp_replace(F.concat(*[p if isinstance(p, Column) else F.lit(str(p)) for p in parts]), " +", " ")


def _static(text: str) -> Column:
    import re

    return F.lit(re.sub(" +", " ", text))


def _int_share(per, contracts: Column) -> Column:
    """int(PER * contracts / 100): truncation toward zero."""
    return (F.lit(float(per)) * contracts / F.lit(100.0)).cast("long")


@dataclass
class Filter:
    name: str
    seq: str = ""
    params: dict = field(default_factory=dict)


def _filter_parts(flt: Filter, c) -> tuple[Column, Column | None, dict[str, Column], bool]:
    """(condition, waterfall label or None, flag columns, overwrites)."""
    n, seq, p = flt.name, flt.seq, flt.params
    trig = c("delinquency_trigger")
    a, b = c("an_a"), c("an_b")
    one = F.lit(1)
    none = F.lit(None).cast("int")
    # Fixed values in what follows: the filter words and the waterfall labels.
    if n in ("administration", "debt_review", "deceased", "fraud", "debt_prescription"):
        spec = {
            "administration": ("H. Administration, Insolvency & Liquidation", "Consumer under Administration, Insolvency, Liquidation", "administration"),
            "debt_review": ("G. Debt Review", "Customer under debt review", "debt_review"),
            "deceased": ("A. Deceased", "Customer is deceased", "deceased"),
            "fraud": ("B. Fraud", "Account is fraudulent", "fraud"),
            "debt_prescription": ("F. Debt Prescription", "Debt prescription invoked", "debt_prescription"),
        }[n]
        cond = F.coalesce(trig == spec[0], F.lit(False))
        out = {f"filter_{spec[2]}": one, f"{spec[2]}_per": one}
        if n in ("administration", "debt_review", "deceased"):
            out[f"{spec[2]}_dlq_trigger"] = one
            out[f"{spec[2]}_credit_bureau"] = none
        return cond, _static(f"{seq} {spec[1]}"), out, False
    if n == "bad_debt":
        pa, pb = F.coalesce(a == "PREWRITEOF", F.lit(False)), F.coalesce(b == "PRE_LEGAL", F.lit(False))
        cond = c("bad_month").isNotNull() | pa | pb
        return cond, _static(f"{seq} Account involuntary churned (120-239 Days)"), {
            "filter_bad_debt": one, "bad_debt_per": one, "bad_debt_extract_file": none,
            "bad_debt_analysis_a": flag(pa), "bad_debt_analysis_b": flag(pb)}, False
    if n in ("business_subscriptions", "ftth_subscriptions", "onseller_subscriptions"):
        src, word, stem = {
            "business_subscriptions": ("chn_business", "business", "business"),
            "ftth_subscriptions": ("prd_ftth", "FTTH", "ftth"),
            "onseller_subscriptions": ("chn_onseller", "onseller", "onseller"),
        }[n]
        per = p.get("per", 50)
        v = _z(c(src))
        cond = (v >= 1) & (v >= _int_share(per, _z(c("contracts"))))
        outs = {f"{stem}_subscriptions": F.when(v >= 1, v), f"filter_{stem}": one, f"{stem}_per": v}
        return cond, _static(f"{seq} {per}% {word} subscriptions"), outs, n == "business_subscriptions"
    if n in ("cd0_collection", "cd0_current"):
        which = "COLLECTION" if n == "cd0_collection" else "CURRENT"
        cond = (_z(c("cd0_nbr")) == 1) & F.coalesce(a == which, F.lit(False))
        text = "0X UTD account flagged as being in COLLECTION by Infinity" if which == "COLLECTION" else "00 UTD account and CURRENT per Infinity"
        return cond, F.lit(text), {f"filter_{n}": one, f"{n}_per": one}, False
    if n in ("cdx_collection", "cdx_current"):
        which = "COLLECTION" if n == "cdx_collection" else "CURRENT"
        total = _z(c("cd1_nbr")) + _z(c("cd2_nbr")) + _z(c("cd3_nbr")) + _z(c("cd4_nbr"))
        cond = (total == 1) & F.coalesce(a == which, F.lit(False))
        age = F.coalesce(c("ageing_attribute").cast("string"), F.lit("None"))
        text = "X Delinquent account flagged as being in COLLECTION by Infinity" if which == "COLLECTION" else "0 Delinquent account and CURRENT per Infinity"
        return cond, _label(age, text), {f"filter_{n}": one, f"{n}_per": one}, False
    if n in ("contract_abnormal_date", "contract_barred", "contract_churned"):
        src, text = {
            "contract_abnormal_date": ("con_abnormal_date", "Subscription has an abnormal start date"),
            "contract_barred": ("con_status_bar_outgoing", "Subscriptions barred from outgoing calls"),
            "contract_churned": ("con_status_churned", "Subscriptions involuntary or voluntary churned"),
        }[n]
        return c(src).isNotNull(), _static(f"{seq} {text}"), {f"filter_{n}": one, f"{n}_per": one}, False
    if n == "enterprise":
        cond = F.coalesce(c("customer_typ") == "Enterprise", F.lit(False))
        return cond, _static(f"{seq} Enterprise account"), {
            "filter_enterprise": one, "enterprise_per": one, "enterprise_analysis_b": c("trigger_analysis_b"),
            "enterprise_account_type": c("trigger_account_type"), "enterprise_idvalidate": c("trigger_idvalidate")}, False
    if n == "high_balances":
        bal = p.get("bal", 5000)
        v = _z(c("balance_sme"))
        cond = (v <= -bal) | (v >= bal)
        return cond, _static(f"{seq} R{bal}+ balance account"), {"filter_high_balance": one, "high_balance_per": v}, False
    if n == "high_contracts":
        sub = p.get("sub", 20)
        v = _z(c("contracts"))
        return v >= sub, _static(f"{seq} {sub}+ contracts (subscriptions)"), {"filter_high_contracts": one, "high_contracts_per": v}, False
    if n == "not_infinity":
        cond = F.coalesce(c("source") != "CEC", F.lit(True))
        return cond, _static(f"{seq} Account not processed by Infinity"), {"filter_not_infinity": one, "not_infinity_per": one}, False
    if n == "written_off":
        t = F.coalesce(trig.isin("I. Debt Sale", "J. Debt Recovery", "L. Legal Action"), F.lit(False))
        wa, wb = F.coalesce(a == "WRITEOFF", F.lit(False)), F.coalesce(b == "LEGAL", F.lit(False))
        return t | wa | wb, _static(f"{seq} Account written-off"), {
            "filter_written_off": one, "written_off_dlq_trigger": flag(t), "written_off_analysis_a": flag(wa),
            "written_off_analysis_b": flag(wb), "written_off_extract_file": none}, False
    raise ValueError(f"unknown filter {n}")


def filter_waterfall(df: DataFrame, filters: Sequence[Filter], waterfall: str = "filter_waterfall", fixed: bool = False) -> DataFrame:
    """Apply the filters in order: flag columns (1/NULL, counts where the filter reports one) and the waterfall label."""

    def c(name):
        return F.col(name) if name in df.columns else F.lit(None)

    incoming = F.col(waterfall) if waterfall in df.columns else F.lit("")
    outs: dict[str, Column] = {}
    normal: list[tuple[Column, Column]] = []
    overwrite: list[tuple[Column, Column]] = []
    for flt in filters:
        cond, label, flags, over = _filter_parts(flt, c)
        cond = F.coalesce(cond, F.lit(False))
        for k, v in flags.items():
            # the subscription counts are reported whenever positive; every other output only when the filter holds
            outs[k] = v if k.endswith("_subscriptions") else F.when(cond, v)
        (overwrite if over and not fixed else normal).append((cond, label))
    # a later overwrite wins; before it, the first normal filter on an empty waterfall
    first = first_match(normal) if normal else F.lit(None).cast("string")
    base = F.when(incoming == "", F.coalesce(first, F.lit(""))).otherwise(incoming)
    final = first_match(list(reversed(overwrite)), base) if overwrite else base
    outs[waterfall] = final
    return df.withColumns(outs)


# ---------------------------------------------------------------- one-hot filters

# Channel keyword -> one-hot column (first match, else other).
CHANNELS = [("STORE", "filter_channel_store"), ("FRANCHISE", "filter_channel_franchise"), ("OUTBOUND", "filter_channel_outbound"),
            ("INBOUND", "filter_channel_inbound"), ("DEALER", "filter_channel_dealer"), ("ONLINE", "filter_channel_online")]
# Decision outcome -> (sequence, column).
OUTCOMES = [("APPROVE", 1, "filter_decision_outcome_approved"), ("REFER", 2, "filter_decision_outcome_referred"),
            ("ARREARS", 3, "filter_decision_outcome_arrears"), ("DECLINE", 4, "filter_decision_outcome_declined")]
# Decision-service keyword -> one-hot column (first match, else DMP unknown).
DECISION_SERVICES = [
    ("NEW TO CREDIT", "filter_new_to_credit"), ("FIRST ACCOUNT APPLICANT", "filter_first_account_applicant"),
    ("WEB SERVICE", "filter_web_service"), ("TELESALES INBOUND", "filter_telesales_inbound"),
    ("TELESALES OUTBOUND", "filter_telesales_outbound"), ("IMMATURE CUSTOMER STATE", "filter_immature_state"),
    ("CLEAR CUSTOMER STATE", "filter_clear_state"), ("RESPONSIBLE CUSTOMER STATE", "filter_responsible_state"),
    ("ERRATIC CUSTOMER STATE", "filter_erratic_state"), ("ARREARS CUSTOMER STATE", "filter_arrears_state"),
    ("XXXXXXX CUSTOMER STATE", "filter_xxxxxx_state"), ("CAMPAIGN", "filter_dmp_campaign"), ("NEW", "filter_dmp_new"),
    ("ESTABLISHED", "filter_dmp_established"),
]


def _one_hots_sql(idx: str, names: Sequence[str], other: str) -> dict[str, Column]:
    out = {name: F.expr(f"CAST(CASE WHEN {idx} = {i + 1} THEN 1 END AS INT)") for i, name in enumerate(names)}
    out[other] = F.expr(f"CAST(CASE WHEN ({idx}) IS NULL THEN 1 END AS INT)")
    return out


def filter_one_hots(df: DataFrame, channel: str | None = "channel", outcome: str | None = "decision_outcome",
                    service: str | None = "decision_service", risk_grade: str | None = "risk_grade") -> DataFrame:
    """Channel, decision outcome (+ sequence), decision service and risk grade one-hot columns.

    Each family is one rule-number CASE (staged once per row) and its one-hot columns.
    """
    idx: dict[str, str] = {}
    if channel:
        ch = f"upper(coalesce({T.ident(channel)}, ''))"
        idx["_ix_channel"] = T.case([(f"instr({ch}, {T.q(k)}) > 0", str(i + 1)) for i, (k, _) in enumerate(CHANNELS)])
    if outcome:
        o = f"upper(coalesce({T.ident(outcome)}, ''))"
        idx["_ix_outcome"] = T.case([(f"{o} = {T.q(k)}", str(i + 1)) for i, (k, _, _) in enumerate(OUTCOMES)])
    if service:
        sv = f"upper(coalesce({T.ident(service)}, ''))"
        idx["_ix_service"] = T.case([(f"instr({sv}, {T.q(k)}) > 0", str(i + 1)) for i, (k, _) in enumerate(DECISION_SERVICES)])
    if risk_grade:
        g = f"upper(coalesce(CAST({T.ident(risk_grade)} AS STRING), 'None'))"
        idx["_ix_grade"] = T.case([(f"{g} = '{k}'", str(k)) for k in range(1, 10)])
    staged = df.withColumns({k: F.expr(v) for k, v in idx.items()})
    out: dict[str, Column] = {}
    if channel:
        out.update(_one_hots_sql("_ix_channel", [n for _, n in CHANNELS], "filter_channel_other"))
    if outcome:
        seqs = T.case([(f"_ix_outcome = {i + 1}", str(s_)) for i, (_, s_, _) in enumerate(OUTCOMES)], "9")
        out["filter_decision_outcome_seq"] = F.expr(f"CAST({seqs} AS INT)")
        out.update(_one_hots_sql("_ix_outcome", [n for _, _, n in OUTCOMES], "filter_decision_outcome_unknown"))
    if service:
        out.update(_one_hots_sql("_ix_service", [n for _, n in DECISION_SERVICES], "filter_dmp_unknown"))
    if risk_grade:
        out.update(_one_hots_sql("_ix_grade", [f"filter_risk_grade_{k}" for k in range(1, 10)], "filter_risk_grade_x"))
    return staged.withColumns(out).drop(*idx)


# ---------------------------------------------------------------- activations

ACTIVATION_COUNTERS = [
    "filter_declined_no_activations", "filter_arrears_no_activations", "filter_referred_no_activations",
    "filter_approved_no_activations", "filter_declined_with_activations", "filter_arrears_with_activations",
    "filter_referred_with_activations", "filter_approved_with_activations",
]
ACTIVATION_EXTRA = ["filter_immature_activations", "filter_clear_activations", "filter_responsible_activations",
                    "filter_erratic_activations", "filter_arrears_activations", "filter_other_activations"]


def activations_initialise(df: DataFrame) -> DataFrame:
    """The 14 empty application-activation columns (text, NULL)."""
    return df.withColumns({c: F.lit(None).cast("string") for c in ACTIVATION_COUNTERS + ACTIVATION_EXTRA})


def activation_status(df: DataFrame, matched_distance: str = "matched_distance") -> DataFrame:
    """Matched/unmatched x outcome (declined, arrears, referred, approved) -> sequence 7..0 and counters (+1, 0 -> NULL).

    Reads the decision-outcome one-hots (``filter_decision_outcome_*``).
    """
    m = col(matched_distance)
    outs = ["declined", "arrears", "referred", "approved"]
    conds = []
    for matched in (False, True):
        for o in outs:
            has = F.col(f"filter_decision_outcome_{o}").isNotNull()
            conds.append((m.isNotNull() if matched else m.isNull()) & has)
    idx = first_match_index(conds)
    res = {"filter_activation_seq": pick(idx, [7, 6, 5, 4, 3, 2, 1, 0]).cast("int")}
    for i, name in enumerate(ACTIVATION_COUNTERS):
        cur = F.coalesce(F.col(name).cast("int"), F.lit(0)) if name in df.columns else F.lit(0)
        v = cur + F.when(F.coalesce(idx == i + 1, F.lit(False)), 1).otherwise(0)
        res[name] = F.when(v != 0, v).cast("int")
    return df.withColumns(res)
