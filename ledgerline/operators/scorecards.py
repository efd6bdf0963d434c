"""Bureau scorecards: eight attributes -> points by ordered bins, score, log-odds, probability.

Each scorecard is a registry; ``score`` compiles it into one CASE per
attribute and sums the points in a single projection.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import sqltext as T


@dataclass(frozen=True)
class NumericAttribute:
    """Points by ordered bins: ``(op, bound, points)`` tested in order, then ``top`` for the rest."""

    name: str
    bins: tuple
    top: int
    null_points: int = 73


@dataclass(frozen=True)
class CodeAttribute:
    """Points by delinquency code (spaces removed, upper-cased); unknown code -> no points.

    ``null``: what a NULL code does: "blank" (scored as the empty code),
    "zero" (0 points) or "void" (the whole scorecard result is NULL).
    """

    name: str
    groups: tuple
    blank_points: int = 73
    null: str = "blank"


# Campaign scorecard.
CAMPAIGN = (
    NumericAttribute("num0delq1y", (("<", -6, 0), ("<", 0, 53), ("<", 10, 53), ("<", 20, 59), ("<", 30, 67),
                                    ("<", 40, 73), ("<", 65, 83), ("<", 100, 100)), 112),
    NumericAttribute("percpay2y", (("<", -6, 0), ("<", 0, 51), ("<", 30, 51), ("<", 55, 58), ("<", 65, 64),
                                   ("<", 75, 68), ("<", 85, 74)), 80),
    CodeAttribute("maxdelq180d", ((("!", "$", "-", "="), 0), ((".", "-1", "?", "@"), 72), (("0",), 76), (("1",), 65),
                                  (("2",), 58), (("3", "4", "5"), 54), (("6", "7", "8"), 54),
                                  (("9", "I", "J", "L", "W"), 54)), null="void"),
    NumericAttribute("avgmob", (("<", -6, 0), ("<", 0, 68), ("<", 6, 65), ("<", 18, 72), ("<", 60, 79)), 86),
    NumericAttribute("percutil", (("<", -6, 0), ("<", 0, 65), ("<", 55, 69)), 74),
    CodeAttribute("maxdelqever", ((("!", "$", "-", "="), 0), ((".", "-1", "?", "@"), 73), (("0", "1", "2"), 73),
                                  (("3", "4", "5"), 73), (("6", "7", "8"), 70), (("9", "I", "J", "L", "W"), 66)), null="void"),
    NumericAttribute("perc0delq90", (("<", -6, 0), ("<", 0, 64), ("<", 55, 64), ("<", 70, 67), ("<", 85, 70)), 73),
    NumericAttribute("trades2y", (("<", -6, 0), ("<", 0, 115), ("<", 1, 115), ("<", 2, 82)), 63),
)

# Established-customer scorecard.
ESTABLISHED = (
    NumericAttribute("perc0delq90", (("<", -6, 0), ("<", 0, 52), ("<", 50, 52), ("<", 70, 60), ("<", 80, 67),
                                     ("<", 85, 70), ("<", 90, 75), ("<", 95, 80)), 91),
    NumericAttribute("trades180", (("<", -6, 0), ("<", 0, 86), ("<", 1, 86), ("<", 2, 80), ("<", 3, 70),
                                   ("<", 4, 61), ("<", 5, 53)), 44),
    NumericAttribute("num0delq1y", (("<=", -6, 0), ("<", 0, 54), ("<", 20, 54), ("<", 35, 65), ("<", 45, 71),
                                    ("<", 65, 78), ("<", 80, 84)), 93),
    CodeAttribute("maxdelq1y", ((("!", "$", "-", "="), 0), ((".", "-1", "?", "@"), 89), (("0",), 85), (("1", "2"), 67),
                                (("3", "4", "5"), 58), (("6", "7", "8"), 58), (("9", "I", "J", "L", "W"), 58)), null="blank"),
    NumericAttribute("percpay2y", (("<", -6, 0), ("<", 0, 69), ("<", 65, 69), ("<", 70, 72), ("<", 75, 74),
                                   ("<", 80, 76), ("<", 85, 78), ("<", 90, 81), ("<", 95, 86)), 88),
    NumericAttribute("util_lt10", (("<", -6, 0), ("<", 0, 73), ("<", 1, 75), ("<", 2, 87)), 96),
    NumericAttribute("percutil", (("<", -6, 0), ("<", 0, 77), ("<", 2, 77), ("<", 30, 73), ("<", 50, 75),
                                  ("<", 65, 78), ("<", 80, 79)), 81),
    NumericAttribute("avgmob", (("<", -6, 0), ("<", 0, 52), ("<", 18, 52), ("<", 24, 59), ("<", 30, 62),
                                ("<", 36, 67), ("<", 42, 71), ("<", 54, 75), ("<", 72, 83), ("<", 96, 90)), 99),
)

# New-customer scorecard.
NEW = (
    NumericAttribute("num0delq1y", (("<", -6, 0), ("<", 0, 54), ("<", 5, 54), ("<", 10, 63), ("<", 20, 67),
                                    ("<", 30, 73), ("<", 35, 76), ("<", 45, 80), ("<", 55, 84), ("<", 70, 89),
                                    ("<", 100, 96)), 103),
    NumericAttribute("percpay2y", (("<", -6, 0), ("<", 0, 55), ("<", 30, 55), ("<", 40, 59), ("<", 50, 62),
                                   ("<", 60, 66), ("<", 65, 69), ("<", 70, 72), ("<", 75, 75), ("<", 80, 77),
                                   ("<", 85, 79), ("<", 90, 84)), 85),
    NumericAttribute("avgmob", (("<=", -6, 0), ("<", 0, 52), ("<", 1, 52), ("<", 6, 63), ("<", 12, 66),
                                ("<", 24, 68), ("<", 36, 71), ("<", 42, 73), ("<", 48, 75), ("<", 54, 78),
                                ("<", 60, 79), ("<", 66, 82), ("<", 84, 86), ("<", 120, 94)), 107),
    CodeAttribute("maxdelq180d", ((("!", "$", "-", "="), 0), ((".", "-1", "?", "@"), 76), (("0",), 76), (("1",), 70),
                                  (("2",), 66), (("3", "4", "5"), 61), (("6", "7", "8"), 56),
                                  (("9", "I", "J", "L", "W"), 49)), null="zero"),
    NumericAttribute("trades180", (("<", -6, 0), ("<", 0, 77), ("<", 1, 77), ("<", 3, 73), ("<", 5, 62)), 50),
    NumericAttribute("util_lt10", (("<", -6, 0), ("<", 0, 63), ("<", 1, 72), ("<", 2, 83)), 95),
    NumericAttribute("perc0delq90", (("<", -6, 0), ("<", 0, 63), ("<", 5, 63), ("<", 30, 64), ("<", 55, 67),
                                     ("<", 70, 70), ("<", 80, 72), ("<", 85, 73), ("<", 90, 75)), 76),
    CodeAttribute("maxdelqever", ((("!", "$", "-", "="), 0), ((".", "-1", "?", "@"), 77), (("0", "1"), 77), (("2",), 75),
                                  (("3",), 74), (("4",), 72), (("5", "6", "7", "8"), 70), (("9", "I", "J", "L", "W"), 66)),
                  null="zero"),
)

SCORECARDS = {"cam": CAMPAIGN, "est": ESTABLISHED, "new": NEW}
PDO = 20
CONSTANT = 582


def attribute_points_sql(attr, value: str) -> str:
    """Points of one attribute as SQL text over the column expression ``value``."""
    if isinstance(attr, NumericAttribute):
        rules = [(f"{value} IS NULL", str(attr.null_points))]
        rules += [(f"{value} {op} {bound}", str(pts)) for op, bound, pts in attr.bins]
        rules.append((f"{value} >= {attr.bins[-1][1]}", str(attr.top)))
        return T.case(rules)
    code = f"upper(replace({value}, ' ', ''))"
    if attr.null == "blank":
        code = f"coalesce({code}, '')"
    rules = [(f"{code} = ''", str(attr.blank_points))]
    rules += [(T.in_list(code, codes), str(pts)) for codes, pts in attr.groups]
    return T.case(rules)


def score(df: DataFrame, card: str, inputs: dict[str, str], pdo: float = PDO, constant: float = CONSTANT) -> DataFrame:
    """``<card>_customer_score`` (sum of points, a missing point counting 0), log-odds and probability.

    ``inputs`` maps each attribute name of the scorecard to a column of ``df``.
    """
    attrs = SCORECARDS[card]
    total = " + ".join(f"coalesce({attribute_points_sql(a, T.ident(inputs[a.name]))}, 0)" for a in attrs)
    voids = [f"{T.ident(inputs[a.name])} IS NULL" for a in attrs if isinstance(a, CodeAttribute) and a.null == "void"]
    total = f"CAST({total} AS INT)"
    if voids:
        total = f"CASE WHEN NOT ({' OR '.join(voids)}) THEN {total} END"
    name = f"{card}_customer_score"
    staged = df.withColumn(name, F.expr(total))
    lnodds = (F.col(name) - F.lit(constant)) / F.lit(pdo / math.log(2))
    staged = staged.withColumn(f"{name}_lnodds", lnodds)
    lo = F.col(f"{name}_lnodds")
    return staged.withColumn(f"{name}_prob", F.exp(lo) / (F.lit(1.0) + F.exp(lo)))
