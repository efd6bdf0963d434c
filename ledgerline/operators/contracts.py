"""Contract treatment: first-match ladder over 16 contract flags, plus one-hot outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.rules import first_match_index, flag, pick

# Ordered treatment ladder (input flag, value it must equal, label, one-hot column).
CONTRACT_LADDER = [
    ("act_mob", 0, "1 New account (activation = contract start)", "con_treat_no_0"),
    ("renewal", 1, "2 Contract renewed this period", "con_treat_no_1"),
    ("started_0", 1, "3 Contract commenced this period", "con_treat_no_2"),
    ("started_1", 1, "4 Contract commenced last period", "con_treat_no_3"),
    ("started_2", 1, "5 Contract commenced prior period", "con_treat_no_4"),
    ("bar_outgoing", 1, "6 Contract service barred", "con_treat_no_5"),
    ("months_00", 1, "A Active on a 0 month contract", "con_treat_yes_0"),
    ("months_01", 1, "B Active on a 1 month contract", "con_treat_yes_1"),
    ("ended_2", 1, "C Contract active and ended prior period", "con_treat_yes_2"),
    ("ended_1", 1, "D Contract active and ended last period", "con_treat_yes_3"),
    ("ended_0", 1, "E Contract active and ended this period", "con_treat_yes_4"),
    ("ending_1", 1, "F Contract active and ending next period", "con_treat_yes_5"),
    ("ending_2", 1, "G Contract active and ending following period", "con_treat_yes_6"),
    ("months_24", 1, "H 24 month contract active and out of period", "con_treat_yes_7"),
    ("months_12", 1, "I 12 month contract active and out of period", "con_treat_yes_8"),
    ("months_06", 1, "J 6 month contract active and out of period", "con_treat_yes_9"),
]
CONTRACT_DEFAULT = "X Contract active and out of period"


def contract_treatment(df: DataFrame) -> DataFrame:
    """Treatment label and 16 one-hot flags (1/NULL); absent input flags count as NULL."""

    def c(name):
        return F.col(name) if name in df.columns else F.lit(None).cast("int")

    idx = first_match_index([F.coalesce(c(name) == v, F.lit(False)) for name, v, _, _ in CONTRACT_LADDER])
    out = {"con_treatment": pick(idx, [r[2] for r in CONTRACT_LADDER], CONTRACT_DEFAULT)}
    for i, (_, _, _, name) in enumerate(CONTRACT_LADDER):
        out[name] = flag(F.coalesce(idx == i + 1, F.lit(False))).cast("int")
    return df.withColumns(out)
