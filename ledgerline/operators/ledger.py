"""Ledger transactions: debit/credit, receipt code, receipt details, transaction type.

All four classifiers run in one projection; the type ladder reads the
outputs of the other three as plain columns of the same row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.rules import col, contains, first_match

# Receipt-code prefix -> payment label.
RECEIPT_CODE_LABELS = [
    ("SCZ", "Payment (Debit Order)"),
    ("SCF", "Payment (DCA)"),
    ("SCD", "Payment (DCA)"),
    ("SCA", "Payment (Cash)"),
    ("SCR", "Payment (EFT)"),
    ("SCM", "Payment (Credit Card)"),
    ("SCY", "Payment (EasyPay)"),
    ("SCJ", "Payment (EasyPay)"),
    ("SCN", "Payment (PBX)"),
    ("SCQ", "Payment (Debit Order Void)"),
    ("SCU", "Payment (Debit Order Voic)"),
    ("CNJ", "Credit Note"),
    ("DNJ", "Debit Note"),
]

# Receipt type by first letter of the receipt number.
RECEIPT_TYPES = [("P", "Payment"), ("V", "Void"), ("F", "Refund"), ("T", "Transfer"), ("R", "????")]

# Receipt note by keyword in the upper-cased remark (first match).
RECEIPT_NOTES = [
    ("REFUND", "Payment Refund"),
    ("CREDIT", "Credit Card"),
    ("EFT", "EasyPay"),
    ("EASYPAY", "EasyPay"),
    ("NEDLINK", "Nedbank"),
    ("ABSA", "ABSA"),
    ("HYPHEN", "Hyphen"),
    ("CASH", "Cash"),
    ("FCKNY", "* FCKNY"),
    ("FLAL", "* FLAL"),
    ("FMAP", "* FMAP"),
    ("FNMR", "* FNMR"),
]

# Bank by keyword in the letters-only, upper-cased bank text (first match).
# "Commercial" is tested as written against upper-case text, so it never matches.
RECEIPT_BANKS = [
    ("CAPITEC", "Capitec"),
    ("FIRST", "FNB"),
    ("RAND", "FNB"),
    ("FNB", "FNB"),
    ("STANDARD", "SBSA"),
    ("STD", "SBSA"),
    ("CLEARY", "SBSA"),
    ("ABSA", "ABSA"),
    ("TRUST", "ABSA"),
    ("SAAMBOU", "ABSA"),
    ("VOLK", "ABSA"),
    ("NEDBANK", "Nedbank"),
    ("PEOPLE", "Nedbank"),
    ("PERM", "Nedbank"),
    ("UNITED", "United Bank"),
    ("NBS", "NBS"),
    ("INVEST", "Investec"),
    ("BIDVEST", "Bidvest"),
    ("AFRICAN", "African"),
    ("DISCOVERY", "Discovery"),
    ("ITHALA", "Ithala Bank"),
    ("ATHENS", "Bank of Athens"),
    ("LISBON", "Bank of Lisbon"),
    ("TRANSKEI", "Bank of Transkei"),
    ("ALLIED", "Allied Bank"),
    ("POST", "Postbank"),
    ("SASFIN", "Sasfin Bank"),
    ("TEBA", "Teba Bank"),
    ("TYME", "Tyme Bank"),
    ("ALBARAKA", "Albaraka Bank"),
    ("Commercial", "Nambia"),
    ("WINDHOEK", "Bank Windhoek"),
    ("BUSINESS", "BOE Bank"),
    ("BOE", "BOE Bank"),
    ("CITI", "Citi Bank"),
    ("HABIB", "Habib Bank"),
    ("HBZ", "Habib Bank"),
    ("HSBC", "HSBC"),
    ("MEEG", "Meeg Bank"),
    ("OLDMUTUAL", "Old Mutual Bank"),
    ("MERC", "Mercantile Bank"),
    ("VBS", "VBS Mutual Bank"),
    ("UNIBANK", "UBank"),
    ("DUMMY", ""),
    ("REMOTE", ""),
    ("RIVONIA", ""),
    ("UNIDENTI", ""),
    ("UNKNOWN", ""),
]

# Transaction-type ladder (first match).  Each rule: (type code,
# extra condition, label); label "=RC" means the receipt-code label.
# Extra conditions: C credit, D debit, "note:<text>" receipt note, "rc:<codes>" receipt code (with optional +C/+D).
TRANSACTION_TYPES = [
    ("BLL", None, "Invoice (Subscription)"),
    ("PAU", "C", "Payment (Debit Order)"),
    ("PAU", "D", "Payment (Debit Order Void)"),
    ("VOI", None, "Payment (Debit Order Void)"),
    ("POB", "note:Cash", "Payment (Cash)"),
    ("POB", "note:EasyPay", "Payment (EasyPay)"),
    ("POB", "note:Credit Card", "Payment (Credit Card)"),
    ("POB", None, "Payment (EFT)"),
    ("PRE", None, "Payment (ATM)"),
    ("TRF", None, "Payment (Transfer)"),
    ("RFN", None, "Payment (Refund)"),
    ("ADJ", "C", "Adjustment (Credit) (Cell C)"),
    ("ADJ", "D", "Adjustment (Debit) (Cell C)"),
    ("OCC", "C", "* Cell C TXN Type=OCC (Credit)"),
    ("OCC", "D", "* Cell C TXN Type=OCC (Debit)"),
    ("SAL", None, "* Cell C TXN Type=SAL (sale?)"),
    ("RTN", None, "* Cell C TXN Type=RTN (return?)"),
    ("ADV", None, "* Advance (Cell C)"),
    ("REJ", None, "* Rejection (Cell C)"),
    ("RCH", None, "* Recharge (Cell C)"),
    ("DEP", None, "* Direct Deposit (Cell C)"),
    ("BIL", "C", "Invoice (Reversal)"),
    ("BIL", "D", "Invoice (Subscription)"),
    ("INV", "C", "Invoice (Reversal)"),
    ("INV", "D", "Invoice (Subscription)"),
    ("CSH", "rc:SCA+C", "=RC"),
    ("CSH", "rc:SCA+D", "Payment (Cash Reversal)"),
    ("CSH", "rc:SCJ,SCY", "=RC"),
    ("CSH", "rc:SCN", "=RC"),
    ("CSH", "rc:SCQ,SCU", "Payment (Debit Order Void)"),
    ("CSH", "rc:SCR", "=RC"),
    ("CSH", "rc:SCD", "=RC"),
    ("CSH", "C", "Payment (Debit Order)"),
    ("CSH", "D", "Payment (Debit Order Void)"),
    ("VSP", "C", "Payment (Debit Order)"),
    ("VSP", "D", "Payment (Debit Order Void)"),
    ("JRN", "C", "Journal Entry (Credit)"),
    ("JRN", "D", "Journal Entry (Debit)"),
    ("CRN", "C", "Credit Note"),
    ("CRN", "D", "Credit Note (Reversal)"),
    ("ADM", None, "Fee (Debit Order Void)"),
    ("PST", None, "Fee (Postal Charge)"),
    ("CRP", None, "* CEC TXN Type = CRP"),
    ("REF", None, "* CEC TXN Type = REF"),
]
TRANSACTION_TYPE_DEFAULT = "* TXN Type Unknown"


def letters_upper(text) -> Column:
    """Letters only (any alphabet), upper-cased."""
    return F.upper(F.regexp_replace(col(text), r"[^\p{L}]", ""))


def debit_credit(src, tdc, amt) -> dict[str, Column]:
    s, t, a = col(src), col(tdc), col(amt)
    flip = F.coalesce(F.upper(F.replace(s, F.lit(" "), F.lit(""))) == "CELLC", F.lit(False))
    amount = F.when(flip, -a).otherwise(a)
    code = F.upper(F.replace(t, F.lit(" "), F.lit("")))
    debit = F.when(t.isNotNull(), F.when(code == "DR", 1).otherwise(0)).otherwise(F.when(amount > 0, 1).otherwise(0))
    credit = F.when(t.isNotNull(), F.when(code == "CR", 1).otherwise(0)).otherwise(F.when(amount < 0, 1).otherwise(0))
    return {
        "txn_credit": credit,
        "txn_debit": debit,
        "amt_pos": F.when((amount > 0) & (credit == 1), 1).otherwise(0),
        "amt_neg": F.when((amount < 0) & (debit == 1), 1).otherwise(0),
    }


def receipt_code(txn) -> dict[str, Column]:
    rc = F.substring(letters_upper(txn), 1, 3)
    label = first_match([(rc == code, text) for code, text in RECEIPT_CODE_LABELS])
    return {"txn_rc": rc, "txn_rc_label": label}


def receipt_details(rec, rem, res, normalised: bool = False, rec_letters=None) -> dict[str, Column]:
    """Receipt type, note and bank.  ``normalised=True`` means ``rec`` is
    non-NULL text, ``rem`` upper-cased and ``res`` letters-only upper-case."""
    if normalised:
        r, remark, bank_text = col(rec), col(rem), col(res)
    else:
        r = F.coalesce(col(rec), F.lit(""))
        remark = F.upper(F.coalesce(col(rem), F.lit("")))
        bank_text = letters_upper(F.coalesce(col(res), F.lit("")))
    letters = col(rec_letters) if rec_letters is not None else letters_upper(r)
    first = F.substring(letters, 1, 1)
    rtype = F.when(
        (F.length(r) >= 1) & (F.length(letters) >= 1),
        first_match([(first == k, v) for k, v in RECEIPT_TYPES], letters),
    )
    note = first_match([(contains(remark, k), v) for k, v in RECEIPT_NOTES], "")
    bank = first_match(
        [(contains(bank_text, k), v) for k, v in RECEIPT_BANKS]
        + [((F.length(bank_text) == 0) | (bank_text == "A"), "")],
        F.concat(F.lit("* "), bank_text),
    )
    return {"txn_receipt_type": rtype, "txn_receipt_note": note, "txn_receipt_bank": bank}


def transaction_type(txn, credit: Column, debit: Column, note: Column, rc: Column, rc_label: Column, ttype=None) -> Column:
    if ttype is None:
        t = col(txn)
        ttype = F.when(t.isNotNull() & (t != ""), F.substring(letters_upper(t), 1, 3)).otherwise(F.lit(""))
    c = F.coalesce(credit, F.lit(0)) == 1
    d = F.coalesce(debit, F.lit(0)) == 1
    rules = []
    for code, extra, label in TRANSACTION_TYPES:
        cond = ttype == code
        if extra == "C":
            cond = cond & c
        elif extra == "D":
            cond = cond & d
        elif extra and extra.startswith("note:"):
            cond = cond & F.coalesce(note == extra[5:], F.lit(False))
        elif extra and extra.startswith("rc:"):
            spec = extra[3:]
            codes, _, side = spec.partition("+")
            cond = cond & rc.isin(*codes.split(","))
            if side == "C":
                cond = cond & c
            elif side == "D":
                cond = cond & d
        rules.append((cond, rc_label if label == "=RC" else label))
    return first_match(rules, TRANSACTION_TYPE_DEFAULT)


def classify_transactions(df: DataFrame, src="src", tdc="tdc", amt="amt", txn="txn", rec="rec", rem="rem", res="res") -> DataFrame:
    """Debit/credit flags, receipt code and label, receipt type/note/bank and transaction type.

    Three projections: normalised texts and codes first, then the flag and
    label ladders over those plain columns, then the type ladder.  Each text
    is normalised once per row; the optimizer keeps the projections apart
    because the normalised texts are referenced many times, which also keeps
    each generated method small enough for the JIT.
    """
    t = col(txn)
    letters = letters_upper(t)
    stage1 = df.withColumns(
        {
            "txn_rc": F.substring(letters, 1, 3),
            "_ttype": F.when(t.isNotNull() & (t != ""), F.substring(letters, 1, 3)).otherwise(F.lit("")),
            "_rec": F.coalesce(col(rec), F.lit("")),
            "_rem": F.upper(F.coalesce(col(rem), F.lit(""))),
            "_res": letters_upper(F.coalesce(col(res), F.lit(""))),
        }
    )
    stage1 = stage1.withColumn("_rec_letters", letters_upper("_rec"))
    rc = F.col("txn_rc")
    stage2 = stage1.withColumns(
        {
            **debit_credit(src, tdc, amt),
            "txn_rc_label": first_match([(rc == code, text) for code, text in RECEIPT_CODE_LABELS]),
            **receipt_details("_rec", "_rem", "_res", normalised=True, rec_letters="_rec_letters"),
        }
    )
    out = stage2.withColumn(
        "txn_type_label",
        transaction_type(None, F.col("txn_credit"), F.col("txn_debit"), F.col("txn_receipt_note"), rc, F.col("txn_rc_label"),
                         ttype=F.col("_ttype")),
    )
    return out.drop("_ttype", "_rec", "_rem", "_res", "_rec_letters")


def transaction_summary(classified: DataFrame, keys=("account", "txn_type_label"), amt="amt") -> DataFrame:
    """Amount and count per account and transaction type (partial aggregation before the shuffle)."""
    return classified.groupBy(*keys).agg(
        F.sum(amt).cast("bigint").alias("amt_total"),
        F.count(F.lit(1)).alias("n_txn"),
        F.sum("txn_credit").cast("bigint").alias("n_credit"),
        F.sum("txn_debit").cast("bigint").alias("n_debit"),
    )
