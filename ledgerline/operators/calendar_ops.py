"""Calendar operators: month stamps, spines, period labels, date reconciliation.

"Today" is never read from the clock; callers pass stamps or dates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import months as M


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def month_shift(df: DataFrame, stamp_col: str, shifts: dict[str, int]) -> DataFrame:
    """Add one column per ``{name: n}``: the ccyymm stamp moved by ``n`` months."""
    return df.withColumns({name: M.shift_stamp(stamp_col, n) for name, n in shifts.items()})


def year_month_pairs(df: DataFrame, stamp_col: str, prefix: str = "") -> DataFrame:
    """Year and month (unpadded text) of the stamp and of the month before it."""
    s = F.col(stamp_col)
    prev = M.shift_stamp(s, -1)
    return df.withColumns(
        {
            f"{prefix}year_latest": F.floor(s / 100).cast("int").cast("string"),
            f"{prefix}month_latest": F.pmod(s, F.lit(100)).cast("string"),
            f"{prefix}year_prev": F.floor(prev / 100).cast("int").cast("string"),
            f"{prefix}month_prev": F.pmod(prev, F.lit(100)).cast("string"),
        }
    )


def month_spine(df: DataFrame, stamp_col: str, steps: int, ascending: bool = False, out: str = "month_id") -> DataFrame:
    """One row per input row and step ``n`` = 1..steps.

    Descending: step 1 is the stamp itself, step n is n-1 months earlier.
    Ascending: step ``steps`` is the stamp itself, step 1 the oldest.
    """
    n = F.explode(F.sequence(F.lit(1), F.lit(steps))).alias("n")
    staged = df.select("*", n)
    back = (F.col("n") - 1) if not ascending else (F.lit(steps) - F.col("n"))
    return staged.withColumn(out, M.shift_stamp(stamp_col, -back))


def quarter_of_stamp(stamp) -> Column:
    """202006 -> '2020Q2'; a month outside 01-12 or a NULL stamp gives NULL."""
    s = _c(stamp).cast("string")
    mm = F.lpad(F.substring(s, 5, 100), 2, "0")
    q = (
        F.when(mm.isin("01", "02", "03"), "Q1")
        .when(mm.isin("04", "05", "06"), "Q2")
        .when(mm.isin("07", "08", "09"), "Q3")
        .when(mm.isin("10", "11", "12"), "Q4")
    )
    return F.when(s.isNull() | (s == ""), F.lit(None).cast("string")).otherwise(F.concat(F.substring(s, 1, 4), q))


def quarter_of_date(d) -> Column:
    """Date -> 'yyyyQn'; NULL -> ''."""
    d = _c(d)
    return F.coalesce(F.concat(F.year(d).cast("string"), F.lit("Q"), F.quarter(d).cast("string")), F.lit(""))


def month_tag(d) -> Column:
    """Upper-case ``MMMyy`` tag, e.g. JAN21."""
    return F.upper(F.date_format(_c(d), "MMMyy"))


def period_labels(df: DataFrame, stamp_col: str, date_col: str) -> DataFrame:
    s = F.col(stamp_col)
    first = M.first_of_month(s)
    return df.withColumns(
        {
            "quarter_of_stamp": quarter_of_stamp(s),
            "quarter_of_date": quarter_of_date(date_col),
            "proxy_date": first,
            "tag_prev": month_tag(F.add_months(first, -1)),
            "tag_this": month_tag(first),
            "tag_next": month_tag(F.add_months(first, 1)),
        }
    )


def month_differences(df: DataFrame, start_col: str, end_col: str) -> DataFrame:
    """``months_back``: calendar months between the two dates (days ignored);
    ``elapsed_months``: whole elapsed months, -1 when either date is NULL."""
    s, e = F.col(start_col), F.col(end_col)
    return df.withColumns(
        {
            "months_back": M.calendar_month_diff(s, e).cast("int"),
            "elapsed_months": F.when(s.isNull() | e.isNull(), F.lit(-1)).otherwise(M.elapsed_months(s, e)),
        }
    )


def reconcile_dates(df: DataFrame, m0m: str, m1m: str) -> DataFrame:
    """Label the NULL/order relation of two dates and keep the earlier one.

    The kept date is NULL when ``m0m`` is NULL (even if ``m1m`` is set).
    """
    a, b = F.col(m0m), F.col(m1m)
    label = (
        F.when(a.isNull() & b.isNotNull(), "1: Only M0M is Null")
        .when(a.isNotNull() & b.isNull(), "2: Only M1M is Null")
        .when(a.isNull() & b.isNull(), "3: Both M0M and M1M are Null")
        .when(a == b, "4: M0M = M1M")
        .when(a < b, "5: M0M is historic wrt M1M")
        .when(a > b, "6: M0M more recent wrt M1M")
        .otherwise("7: Unaccounted situation")
    )
    kept = F.when(a.isNull(), F.lit(None).cast("date")).otherwise(F.least(a, b))
    return df.withColumns({"date_comparison": label, "final_date": kept})
