"""Ledger and contract queries over ``fx_transactions`` and ``fx_contracts``."""

from __future__ import annotations

from ledgerline.operators import contracts as K
from ledgerline.operators import ledger as L
from ledgerline.plans import oracle_tables as OT
from ledgerline.plans.catalog import query
from ledgerline.sources.fixtures import fixture, fixture_cte

_TXN, _CON = fixture_cte("fx_transactions"), fixture_cte("fx_contracts")


def _lu(x: str) -> str:
    return f"upper(regexp_replace({x}, '[^\\p{{L}}]', '', 'g'))"


def _case(pairs, default="NULL") -> str:
    return "CASE " + " ".join(f"WHEN {c} THEN {v}" for c, v in pairs) + f" ELSE {default} END"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def classify_sql(src: str) -> str:
    amount = "CASE WHEN coalesce(upper(replace(src, ' ', '')) = 'CELLC', false) THEN -amt ELSE amt END"
    code = "upper(replace(tdc, ' ', ''))"
    rc_label = _case([(f"txn_rc = {_q(k)}", _q(v)) for k, v in OT.RECEIPT_CODES])
    letters = _lu("coalesce(rec, '')")
    rtype = (f"CASE WHEN length(coalesce(rec, '')) >= 1 AND length({letters}) >= 1 THEN "
             + _case([(f"substr({letters}, 1, 1) = {_q(k)}", _q(v)) for k, v in OT.RECEIPT_TYPES], letters) + " END")
    remark = "upper(coalesce(rem, ''))"
    note = _case([(f"instr({remark}, {_q(k)}) > 0", _q(v)) for k, v in OT.RECEIPT_NOTES], "''")
    bt = _lu("coalesce(res, '')")
    bank = _case([(f"instr({bt}, {_q(k)}) > 0", _q(v)) for k, v in OT.RECEIPT_BANKS]
                 + [(f"length({bt}) = 0 OR {bt} = 'A'", "''")], f"'* ' || {bt}")
    stage1 = f"""SELECT *,
      CASE WHEN tdc IS NOT NULL THEN CASE WHEN {code} = 'CR' THEN 1 ELSE 0 END ELSE CASE WHEN ({amount}) < 0 THEN 1 ELSE 0 END END AS txn_credit,
      CASE WHEN tdc IS NOT NULL THEN CASE WHEN {code} = 'DR' THEN 1 ELSE 0 END ELSE CASE WHEN ({amount}) > 0 THEN 1 ELSE 0 END END AS txn_debit,
      ({amount}) AS amount_signed,
      substr({_lu('txn')}, 1, 3) AS txn_rc,
      {rtype} AS txn_receipt_type, {note} AS txn_receipt_note, {bank} AS txn_receipt_bank
    FROM {src}"""
    ttype = f"CASE WHEN txn IS NOT NULL AND txn <> '' THEN substr({_lu('txn')}, 1, 3) ELSE '' END"
    rules = []
    for tcode, extra, label in OT.TRANSACTIONS:
        cond = f"tt = {_q(tcode)}"
        if extra == "C":
            cond += " AND txn_credit = 1"
        elif extra == "D":
            cond += " AND txn_debit = 1"
        elif extra and extra.startswith("note:"):
            cond += f" AND coalesce(txn_receipt_note = {_q(extra[5:])}, false)"
        elif extra and extra.startswith("rc:"):
            codes, _, side = extra[3:].partition("+")
            cond += " AND txn_rc IN (" + ", ".join(_q(x) for x in codes.split(",")) + ")"
            cond += {"C": " AND txn_credit = 1", "D": " AND txn_debit = 1"}.get(side, "")
        rules.append((cond, "txn_rc_label" if label == "=RC" else _q(label)))
    ttl = _case(rules, _q(OT.TRANSACTION_DEFAULT))
    return f"""SELECT * EXCLUDE (amount_signed, tt), {ttl} AS txn_type_label FROM (
      SELECT *, CASE WHEN amount_signed > 0 AND txn_credit = 1 THEN 1 ELSE 0 END AS amt_pos,
        CASE WHEN amount_signed < 0 AND txn_debit = 1 THEN 1 ELSE 0 END AS amt_neg,
        {rc_label} AS txn_rc_label, {ttype} AS tt
      FROM ({stage1}))"""


@query("classify_transactions", oracle=f"WITH {_TXN} {classify_sql('fx_transactions')}")
def q_classify_transactions(spark, sf_dir):
    return L.classify_transactions(fixture(spark, sf_dir, "fx_transactions"))


@query(
    "transaction_summary",
    oracle=f"""WITH {_TXN}, c AS ({classify_sql('fx_transactions')})
    SELECT account, txn_type_label, CAST(sum(amt) AS BIGINT) AS amt_total, count(*) AS n_txn,
      CAST(sum(txn_credit) AS BIGINT) AS n_credit, CAST(sum(txn_debit) AS BIGINT) AS n_debit
    FROM c GROUP BY account, txn_type_label""",
)
def q_transaction_summary(spark, sf_dir):
    return L.transaction_summary(L.classify_transactions(fixture(spark, sf_dir, "fx_transactions")))


def _contract_sql() -> str:
    whens = [f"WHEN {name} = {v} THEN {i + 1}" for i, (name, v, _, _) in enumerate(OT.CONTRACTS)]
    labels = "[" + ", ".join(_q(r[2]) for r in OT.CONTRACTS) + "]"
    hots = ", ".join(f"CAST(CASE WHEN k = {i + 1} THEN 1 END AS INTEGER) AS {r[3]}" for i, r in enumerate(OT.CONTRACTS))
    return (f"SELECT * EXCLUDE (k), coalesce({labels}[k], {_q(OT.CONTRACT_DEFAULT)}) AS con_treatment, {hots} "
            f"FROM (SELECT *, CASE {' '.join(whens)} END AS k FROM fx_contracts)")


@query("contract_treatment", oracle=f"WITH {_CON} {_contract_sql()}")
def q_contract_treatment(spark, sf_dir):
    return K.contract_treatment(fixture(spark, sf_dir, "fx_contracts"))
