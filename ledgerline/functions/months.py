"""Month arithmetic on integer ``ccyymm`` stamps and dates, as Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def month_index(stamp) -> Column:
    """ccyymm -> months since year 0 (y*12 + m - 1)."""
    s = _c(stamp).cast("int")
    return F.floor(s / 100).cast("int") * 12 + F.pmod(s, F.lit(100)) - 1


def stamp_from_index(k) -> Column:
    k = _c(k)
    return (F.floor(k / 12).cast("int") * 100 + F.pmod(k, F.lit(12)) + 1).cast("int")


def shift_stamp(stamp, n) -> Column:
    """Add ``n`` (int or Column) months to a ccyymm stamp."""
    n = F.lit(n) if isinstance(n, int) else _c(n)
    return stamp_from_index(month_index(stamp) + n)


def stamp_of_date(d) -> Column:
    d = _c(d)
    return (F.year(d) * 100 + F.month(d)).cast("int")


def first_of_month(stamp) -> Column:
    s = _c(stamp).cast("int")
    return F.make_date(F.floor(s / 100).cast("int"), F.pmod(s, F.lit(100)), F.lit(1))


def calendar_month_diff(start, end) -> Column:
    """12*(year(end)-year(start)) + month(end)-month(start); days ignored."""
    s, e = _c(start), _c(end)
    return (F.year(e) - F.year(s)) * 12 + F.month(e) - F.month(s)


def elapsed_months(start, end) -> Column:
    """Whole months from ``start`` to ``end`` as a calendar delta counts them.

    Month-end clipping follows ``add_months``: 2021-01-30 -> 2021-02-28 is one
    month.  Negative when ``end`` precedes ``start``.
    """
    s, e = _c(start), _c(end)
    n = calendar_month_diff(s, e)
    lands = F.add_months(s, n)
    return (
        F.when(e >= s, n - F.when(lands > e, 1).otherwise(0))
        .otherwise(n + F.when(lands < e, 1).otherwise(0))
        .cast("int")
    )
