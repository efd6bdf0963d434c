"""Filter queries: account filter waterfall and application one-hot filters.

The account filter input joins the accounts (with delinquency attributes and
customer type) to per-customer subscription counts aggregated from the
applications, so the waterfall runs over data derived at full scale.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators import behaviour as B
from ledgerline.operators import filters as FL
from ledgerline.operators import identity as I
from ledgerline.operators import portfolio as PF
from ledgerline.plans import oracle_decisions as OD
from ledgerline.plans import oracle_tables as OT
from ledgerline.plans.catalog import query
from ledgerline.plans.q_behaviour import delinquency_sql
from ledgerline.plans.q_identity import _ACCOUNT_TYPE, AS_OF, _validate_sql
from ledgerline.sources.fixtures import fixture, fixture_cte

_ACC, _APPS = fixture_cte("fx_accounts"), fixture_cte("fx_applications")

# Filter order and sequence labels of the account waterfall.
ACCOUNT_FILTERS = [
    FL.Filter("deceased", "A1"),
    FL.Filter("fraud", "A2"),
    FL.Filter("debt_review", "A3"),
    FL.Filter("administration", "A4"),
    FL.Filter("debt_prescription", "A5"),
    FL.Filter("written_off", "A6"),
    FL.Filter("bad_debt", "A7"),
    FL.Filter("enterprise", "B1"),
    FL.Filter("business_subscriptions", "B2", {"per": 50}),
    FL.Filter("ftth_subscriptions", "B3", {"per": 50}),
    FL.Filter("onseller_subscriptions", "B4", {"per": 50}),
    FL.Filter("high_balances", "B5", {"bal": 9000}),
    FL.Filter("high_contracts", "B6", {"sub": 20}),
    FL.Filter("not_infinity", "B7"),
    FL.Filter("contract_abnormal_date", "C1"),
    FL.Filter("contract_barred", "C2"),
    FL.Filter("contract_churned", "C3"),
    FL.Filter("cd0_collection"),
    FL.Filter("cd0_current"),
    FL.Filter("cdx_collection"),
    FL.Filter("cdx_current"),
]


def subscription_counts(spark, sf_dir) -> DataFrame:
    """Per customer: applications (contracts) and those by dealer, online and grade 9 (partial aggregation)."""
    apps = fixture(spark, sf_dir, "fx_applications")
    return apps.groupBy(F.col("idkey").alias("account")).agg(
        F.count(F.lit(1)).alias("contracts"),
        F.sum(F.when(F.col("channel") == "Dealer", 1).otherwise(0)).alias("chn_business"),
        F.sum(F.when(F.col("channel") == "Online", 1).otherwise(0)).alias("chn_onseller"),
        F.sum(F.when(F.col("risk_grade") == 9, 1).otherwise(0)).alias("prd_ftth"),
    )


def filter_input(spark, sf_dir) -> DataFrame:
    acc = B.delinquency_attributes(fixture(spark, sf_dir, "fx_accounts"))
    ids = I.validate_identities(fixture(spark, sf_dir, "fx_identities"), "id_raw", as_of=AS_OF)
    acc = acc.withColumn("account_type", F.expr(_ACCOUNT_TYPE)).join(ids.select(F.col("rec").alias("account"), "id_type"), "account")
    acc = I.derive_customer_type(acc, analysis_b="an_b")
    acc = acc.join(subscription_counts(spark, sf_dir), "account", "left")
    age = F.col("ageing_attribute")
    return acc.withColumns(
        {
            "bad_month": F.when(F.col("cd4") > 0, F.lit(202401)),
            **{f"cd{k}_nbr": F.when(age == str(k), F.lit(1)) for k in range(5)},
            "con_abnormal_date": F.when(F.col("cd0") < 0, F.lit(1)),
            "con_status_bar_outgoing": F.when(F.col("cust_status") == "BARRING", F.lit(1)),
            "con_status_churned": F.when(F.col("an_b") == "ARCHIVED", F.lit(1)),
            "source": F.when(F.col("contact_raw").startswith("+27"), F.lit("Cell C")).otherwise(F.lit("CEC")),
            "balance_sme": F.col("balance"),
            "filter_waterfall": F.lit(""),
        }
    )


_INPUT_SQL = f"""WITH v AS ({_validate_sql()}), {_ACC}, {_APPS},
d AS {delinquency_sql('fx_accounts')},
subs AS (SELECT idkey AS account, count(*) AS contracts, sum(CASE WHEN channel = 'Dealer' THEN 1 ELSE 0 END) AS chn_business,
  sum(CASE WHEN channel = 'Online' THEN 1 ELSE 0 END) AS chn_onseller, sum(CASE WHEN risk_grade = 9 THEN 1 ELSE 0 END) AS prd_ftth
  FROM fx_applications GROUP BY idkey),
t AS (SELECT d.*, {_ACCOUNT_TYPE} AS account_type, v.id_type FROM d JOIN v ON d.account = v.rec),
u AS (SELECT *, coalesce(id_type, '') AS idt, upper(trim(coalesce(account_type, ''))) AS acct_t, upper(trim(coalesce(an_b, ''))) AS anb FROM t),
ct AS (SELECT * EXCLUDE (idt, acct_t, anb),
  CASE WHEN anb = 'BUSINESS' THEN 'Enterprise'
       WHEN acct_t IN ('1', 'SOUTHAFRICANID', '2', 'PASSPORT', '5', 'TEMPRESIDENCE', 'OTHERS', 'EMIS') THEN 'Consumer'
       WHEN acct_t IN ('3', 'COMPANYID', 'BUSINESSREGNUM') THEN 'Enterprise'
       WHEN idt IN ('N', 'n', 'I', 'i') THEN 'Consumer' WHEN idt IN ('B', 'b') THEN 'Enterprise' ELSE 'Unknown' END AS customer_typ,
  CAST(CASE WHEN idt IN ('B', 'b') THEN 1 END AS INTEGER) AS trigger_idvalidate,
  CAST(CASE WHEN acct_t IN ('3', 'COMPANYID', 'BUSINESSREGNUM') THEN 1 END AS INTEGER) AS trigger_account_type,
  CAST(CASE WHEN anb = 'BUSINESS' THEN 1 END AS INTEGER) AS trigger_analysis_b FROM u),
fi AS (SELECT ct.*, s.contracts, s.chn_business, s.chn_onseller, s.prd_ftth,
  CASE WHEN cd4 > 0 THEN 202401 END AS bad_month,
  {', '.join(f"CASE WHEN ageing_attribute = '{k}' THEN 1 END AS cd{k}_nbr" for k in range(5))},
  CASE WHEN cd0 < 0 THEN 1 END AS con_abnormal_date, CASE WHEN cust_status = 'BARRING' THEN 1 END AS con_status_bar_outgoing,
  CASE WHEN an_b = 'ARCHIVED' THEN 1 END AS con_status_churned,
  CASE WHEN contact_raw LIKE '+27%' THEN 'Cell C' ELSE 'CEC' END AS source, balance AS balance_sme, '' AS fw
  FROM ct LEFT JOIN subs s ON ct.account = s.account)"""


def _filter_sql() -> str:
    """Every filter as plain CASE expressions over ``fi``; the waterfall as a first-match CASE."""
    cols, labels = [], []
    over = None
    for f in ACCOUNT_FILTERS:
        n, seq, p = f.name, f.seq, f.params
        if n in ("administration", "debt_review", "deceased", "fraud", "debt_prescription"):
            trig, text = {
                "administration": ("H. Administration, Insolvency & Liquidation", "Consumer under Administration, Insolvency, Liquidation"),
                "debt_review": ("G. Debt Review", "Customer under debt review"), "deceased": ("A. Deceased", "Customer is deceased"),
                "fraud": ("B. Fraud", "Account is fraudulent"), "debt_prescription": ("F. Debt Prescription", "Debt prescription invoked"),
            }[n]
            cond = f"coalesce(delinquency_trigger = '{trig}', false)"
            cols += [f"CASE WHEN {cond} THEN 1 END AS filter_{n}", f"CASE WHEN {cond} THEN 1 END AS {n}_per"]
            if n in ("administration", "debt_review", "deceased"):
                cols += [f"CASE WHEN {cond} THEN 1 END AS {n}_dlq_trigger", f"CAST(NULL AS INTEGER) AS {n}_credit_bureau"]
            labels.append((cond, f"'{seq} {text}'"))
        elif n == "bad_debt":
            pa, pb = "coalesce(an_a = 'PREWRITEOF', false)", "coalesce(an_b = 'PRE_LEGAL', false)"
            cond = f"(bad_month IS NOT NULL OR {pa} OR {pb})"
            cols += [f"CASE WHEN {cond} THEN 1 END AS filter_bad_debt", f"CASE WHEN {cond} THEN 1 END AS bad_debt_per",
                     "CAST(NULL AS INTEGER) AS bad_debt_extract_file",
                     f"CASE WHEN {cond} THEN CASE WHEN {pa} THEN 1 END END AS bad_debt_analysis_a",
                     f"CASE WHEN {cond} THEN CASE WHEN {pb} THEN 1 END END AS bad_debt_analysis_b"]
            labels.append((cond, f"'{seq} Account involuntary churned (120-239 Days)'"))
        elif n in ("business_subscriptions", "ftth_subscriptions", "onseller_subscriptions"):
            src, word, stem = {"business_subscriptions": ("chn_business", "business", "business"),
                               "ftth_subscriptions": ("prd_ftth", "FTTH", "ftth"),
                               "onseller_subscriptions": ("chn_onseller", "onseller", "onseller")}[n]
            v = f"coalesce({src}, 0)"
            cond = f"({v} >= 1 AND {v} >= CAST(trunc({float(p['per'])!r} * coalesce(contracts, 0) / 100.0) AS BIGINT))"
            cols += [f"CASE WHEN {v} >= 1 THEN {v} END AS {stem}_subscriptions", f"CASE WHEN {cond} THEN 1 END AS filter_{stem}",
                     f"CASE WHEN {cond} THEN {v} END AS {stem}_per"]
            if n == "business_subscriptions":
                over = (cond, f"'{seq} {p['per']}% {word} subscriptions'")
            else:
                labels.append((cond, f"'{seq} {p['per']}% {word} subscriptions'"))
        elif n in ("cd0_collection", "cd0_current"):
            which = "COLLECTION" if n == "cd0_collection" else "CURRENT"
            cond = f"(coalesce(cd0_nbr, 0) = 1 AND coalesce(an_a = '{which}', false))"
            cols += [f"CASE WHEN {cond} THEN 1 END AS filter_{n}", f"CASE WHEN {cond} THEN 1 END AS {n}_per"]
            text = "0X UTD account flagged as being in COLLECTION by Infinity" if which == "COLLECTION" else "00 UTD account and CURRENT per Infinity"
            labels.append((cond, f"'{text}'"))
        elif n in ("cdx_collection", "cdx_current"):
            which = "COLLECTION" if n == "cdx_collection" else "CURRENT"
            tot = " + ".join(f"coalesce(cd{k}_nbr, 0)" for k in range(1, 5))
            cond = f"({tot} = 1 AND coalesce(an_a = '{which}', false))"
            cols += [f"CASE WHEN {cond} THEN 1 END AS filter_{n}", f"CASE WHEN {cond} THEN 1 END AS {n}_per"]
            text = "X Delinquent account flagged as being in COLLECTION by Infinity" if which == "COLLECTION" else "0 Delinquent account and CURRENT per Infinity"
            labels.append((cond, f"regexp_replace(coalesce(ageing_attribute, 'None') || '{text}', ' +', ' ', 'g')"))
        elif n in ("contract_abnormal_date", "contract_barred", "contract_churned"):
            src, text = {"contract_abnormal_date": ("con_abnormal_date", "Subscription has an abnormal start date"),
                         "contract_barred": ("con_status_bar_outgoing", "Subscriptions barred from outgoing calls"),
                         "contract_churned": ("con_status_churned", "Subscriptions involuntary or voluntary churned")}[n]
            cond = f"{src} IS NOT NULL"
            cols += [f"CASE WHEN {cond} THEN 1 END AS filter_{n}", f"CASE WHEN {cond} THEN 1 END AS {n}_per"]
            labels.append((cond, f"'{seq} {text}'"))
        elif n == "enterprise":
            cond = "coalesce(customer_typ = 'Enterprise', false)"
            cols += [f"CASE WHEN {cond} THEN 1 END AS filter_enterprise", f"CASE WHEN {cond} THEN 1 END AS enterprise_per",
                     f"CASE WHEN {cond} THEN trigger_analysis_b END AS enterprise_analysis_b",
                     f"CASE WHEN {cond} THEN trigger_account_type END AS enterprise_account_type",
                     f"CASE WHEN {cond} THEN trigger_idvalidate END AS enterprise_idvalidate"]
            labels.append((cond, f"'{seq} Enterprise account'"))
        elif n == "high_balances":
            v, bal = "coalesce(balance_sme, 0)", p["bal"]
            cond = f"({v} <= -{bal} OR {v} >= {bal})"
            cols += [f"CASE WHEN {cond} THEN 1 END AS filter_high_balance", f"CASE WHEN {cond} THEN {v} END AS high_balance_per"]
            labels.append((cond, f"'{seq} R{bal}+ balance account'"))
        elif n == "high_contracts":
            v, sub = "coalesce(contracts, 0)", p["sub"]
            cond = f"{v} >= {sub}"
            cols += [f"CASE WHEN {cond} THEN 1 END AS filter_high_contracts", f"CASE WHEN {cond} THEN {v} END AS high_contracts_per"]
            labels.append((cond, f"'{seq} {sub}+ contracts (subscriptions)'"))
        elif n == "not_infinity":
            cond = "coalesce(source <> 'CEC', true)"
            cols += [f"CASE WHEN {cond} THEN 1 END AS filter_not_infinity", f"CASE WHEN {cond} THEN 1 END AS not_infinity_per"]
            labels.append((cond, f"'{seq} Account not processed by Infinity'"))
        elif n == "written_off":
            t = "coalesce(delinquency_trigger IN ('I. Debt Sale', 'J. Debt Recovery', 'L. Legal Action'), false)"
            wa, wb = "coalesce(an_a = 'WRITEOFF', false)", "coalesce(an_b = 'LEGAL', false)"
            cond = f"({t} OR {wa} OR {wb})"
            cols += [f"CASE WHEN {cond} THEN 1 END AS filter_written_off",
                     f"CASE WHEN {cond} THEN CASE WHEN {t} THEN 1 END END AS written_off_dlq_trigger",
                     f"CASE WHEN {cond} THEN CASE WHEN {wa} THEN 1 END END AS written_off_analysis_a",
                     f"CASE WHEN {cond} THEN CASE WHEN {wb} THEN 1 END END AS written_off_analysis_b",
                     "CAST(NULL AS INTEGER) AS written_off_extract_file"]
            labels.append((cond, f"'{seq} Account written-off'"))
    first = "CASE " + " ".join(f"WHEN {c} THEN {lab}" for c, lab in labels) + " END"
    wf = f"CASE WHEN fw = '' THEN coalesce({first}, '') ELSE fw END"
    if over:
        wf = f"CASE WHEN {over[0]} THEN {over[1]} ELSE {wf} END"
    return _INPUT_SQL + f"\nSELECT * EXCLUDE (fw), {', '.join(cols)}, {wf} AS filter_waterfall FROM fi"


@query("filter_waterfall", oracle=_filter_sql())
def q_filter_waterfall(spark, sf_dir):
    return FL.filter_waterfall(filter_input(spark, sf_dir), ACCOUNT_FILTERS)


# Decision-service text per application (the fixture carries none): derived from trade history, channel and state.
DECISION_SERVICE_SQL = """CASE WHEN time_oldest_trade < 3 THEN 'DMP New To Credit' WHEN channel = 'Online' THEN 'DMP Web Service'
  WHEN channel = 'Inbound' THEN 'DMP Telesales Inbound' WHEN channel = 'Outbound' THEN 'DMP Telesales Outbound'
  WHEN customer_state LIKE 'IMM%' THEN 'DMP Immature Customer State' WHEN customer_state LIKE 'CLR%' THEN 'DMP Clear Customer State'
  WHEN customer_state LIKE 'RES%' THEN 'DMP Responsible Customer State' WHEN customer_state LIKE 'ERR%' THEN 'DMP Erratic Customer State'
  WHEN customer_state IN ('EXT Extended', 'DIS Distressed', 'DBT Doubtful Debt') THEN 'DMP Arrears Customer State'
  WHEN customer_state = '' THEN 'DMP Campaign' WHEN customer_state = 'other' THEN 'DMP Established' ELSE 'unknown' END"""


def applications_with_service(spark, sf_dir) -> DataFrame:
    return fixture(spark, sf_dir, "fx_applications").withColumn("decision_service", F.expr(DECISION_SERVICE_SQL))


def _one_hot_sql() -> str:
    cols = []
    ch = "upper(coalesce(channel, ''))"
    k = "CASE " + " ".join(f"WHEN instr({ch}, '{w}') > 0 THEN {i + 1}" for i, (w, _) in enumerate(OT.CHANNELS)) + " END"
    cols += [f"CAST(CASE WHEN {k} = {i + 1} THEN 1 END AS INTEGER) AS {n}" for i, (_, n) in enumerate(OT.CHANNELS)]
    cols.append(f"CAST(CASE WHEN ({k}) IS NULL THEN 1 END AS INTEGER) AS filter_channel_other")
    o = "upper(coalesce(decision_outcome, ''))"
    k = "CASE " + " ".join(f"WHEN {o} = '{w}' THEN {i + 1}" for i, (w, _, _) in enumerate(OT.OUTCOMES)) + " END"
    cols.append(f"CAST(coalesce([{', '.join(str(s) for _, s, _ in OT.OUTCOMES)}][{k}], 9) AS INTEGER) AS filter_decision_outcome_seq")
    cols += [f"CAST(CASE WHEN {k} = {i + 1} THEN 1 END AS INTEGER) AS {n}" for i, (_, _, n) in enumerate(OT.OUTCOMES)]
    cols.append(f"CAST(CASE WHEN ({k}) IS NULL THEN 1 END AS INTEGER) AS filter_decision_outcome_unknown")
    s = "upper(coalesce(decision_service, ''))"
    k = "CASE " + " ".join(f"WHEN instr({s}, '{w}') > 0 THEN {i + 1}" for i, (w, _) in enumerate(OD.DECISION_SERVICES)) + " END"
    cols += [f"CAST(CASE WHEN {k} = {i + 1} THEN 1 END AS INTEGER) AS {n}" for i, (_, n) in enumerate(OD.DECISION_SERVICES)]
    cols.append(f"CAST(CASE WHEN ({k}) IS NULL THEN 1 END AS INTEGER) AS filter_dmp_unknown")
    g = "upper(coalesce(CAST(risk_grade AS VARCHAR), 'None'))"
    k = "CASE " + " ".join(f"WHEN {g} = '{i}' THEN {i}" for i in range(1, 10)) + " END"
    cols += [f"CAST(CASE WHEN {k} = {i} THEN 1 END AS INTEGER) AS filter_risk_grade_{i}" for i in range(1, 10)]
    cols.append(f"CAST(CASE WHEN ({k}) IS NULL THEN 1 END AS INTEGER) AS filter_risk_grade_x")
    return f"WITH {_APPS}, a AS (SELECT *, {DECISION_SERVICE_SQL} AS decision_service FROM fx_applications) SELECT *, {', '.join(cols)} FROM a"


@query("filter_one_hots", oracle=_one_hot_sql())
def q_filter_one_hots(spark, sf_dir):
    return FL.filter_one_hots(applications_with_service(spark, sf_dir))


# ---------------------------------------------------------------- collections segmentation and ECL features

def _collections_input(spark, sf_dir) -> DataFrame:
    fw = FL.filter_waterfall(filter_input(spark, sf_dir), ACCOUNT_FILTERS)
    age = F.col("ageing_attribute")
    return fw.select(
        "account", "an_a", "an_b", "filter_waterfall",
        F.when(age == "C", F.lit(1)).alias("crd_nbr"), F.when(age == "P", F.lit(1)).alias("pup_nbr"),
    )


def _collections_sql() -> str:
    a, b = "upper(coalesce(an_a, ''))", "upper(coalesce(an_b, ''))"
    flags = [f"CAST(CASE WHEN {a} = '{code}' THEN 1 END AS INTEGER) AS {name}" for code, name in PF.ANALYSIS_A_FLAGS]
    flags += [f"CAST(CASE WHEN {b} = '{code}' THEN 1 END AS INTEGER) AS {name}" for code, name in PF.ANALYSIS_B_FLAGS]
    seg = (f"CASE WHEN {a} = 'PREWRITEOF' OR {b} = 'PRE_LEGAL' THEN '91 Bad Debt (120-239 Days)' "
           f"WHEN {a} = 'PRECLOSED' OR {b} = 'ARCHIVED' THEN '92 Voluntary Churn (Attrition)' "
           f"WHEN {a} = 'CURRENT' AND coalesce(crd_nbr = 1, false) THEN '93 Voluntary Churn (Credit Balance)' "
           f"WHEN {a} = 'CURRENT' AND coalesce(pup_nbr = 1, false) THEN '94 Voluntary Churn (Paid Up)' ELSE '' END")
    return (_filter_sql().replace("\nSELECT * EXCLUDE (fw)", ",\nfwq AS (SELECT * EXCLUDE (fw)", 1) + "),\n"
            + "ci AS (SELECT account, an_a, an_b, filter_waterfall AS fw0, CASE WHEN ageing_attribute = 'C' THEN 1 END AS crd_nbr, "
            + "CASE WHEN ageing_attribute = 'P' THEN 1 END AS pup_nbr FROM fwq)\n"
            + f"SELECT account, an_a, an_b, crd_nbr, pup_nbr, {', '.join(flags)}, CASE WHEN fw0 = '' THEN {seg} ELSE fw0 END AS filter_waterfall FROM ci")


@query("collections_segmentation", oracle=_collections_sql())
def q_collections_segmentation(spark, sf_dir):
    return PF.collections_segmentation(_collections_input(spark, sf_dir))


@query(
    "ecl_features",
    oracle=_INPUT_SQL
    + """
SELECT account, bad_month, CASE WHEN bad_month IS NOT NULL THEN 1 END AS bad_events,
  CASE WHEN bad_month IS NOT NULL THEN contracts END AS bad_subscriptions,
  bad_month AS ecl_bad_debt_month, CASE WHEN bad_month IS NOT NULL THEN 1 END AS ecl_bad_debt_events,
  CASE WHEN bad_month IS NOT NULL THEN contracts END AS ecl_bad_debt_subscriptions FROM fi""",
)
def q_ecl_features(spark, sf_dir):
    fi = filter_input(spark, sf_dir)
    bad = F.col("bad_month").isNotNull()
    src = fi.select("account", "bad_month", F.when(bad, F.lit(1)).alias("bad_events"), F.when(bad, F.col("contracts")).alias("bad_subscriptions"))
    return PF.ecl_features(src)
