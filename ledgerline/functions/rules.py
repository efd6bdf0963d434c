"""Rule registries compiled to native Column expressions.

A registry is an ordered list of (condition, outputs) rows.  ``first_match``
folds it into one CASE expression, so an ordered waterfall stays a single
codegen'd projection instead of a chain of Python calls.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def lit_or_col(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def first_match(rules: Sequence[tuple[Column, object]], default=None) -> Column:
    """CASE WHEN c1 THEN v1 WHEN c2 THEN v2 ... ELSE default END (first match wins)."""
    if not rules:
        return lit_or_col(default)
    expr = None
    for cond, value in rules:
        expr = F.when(cond, lit_or_col(value)) if expr is None else expr.when(cond, lit_or_col(value))
    return expr.otherwise(lit_or_col(default)) if default is not None else expr


def first_match_index(conds: Sequence[Column]) -> Column:
    """1-based number of the first true condition, NULL when none holds."""
    return first_match([(c, i + 1) for i, c in enumerate(conds)])


def pick(index: Column, values: Sequence, default=None) -> Column:
    """``values[index-1]`` (literal array lookup), ``default`` when index is NULL.

    The index is never NULL inside ``element_at`` (the default sits at the end
    of the array): a nullable CASE index there is not evaluated reliably.
    """
    items = [F.lit(v) for v in values]
    items.append(lit_or_col(default) if default is not None else F.lit(None).cast("string"))
    return F.element_at(F.array(*items), F.coalesce(index, F.lit(len(values) + 1)))


def flag(cond: Column) -> Column:
    """1 when ``cond`` holds, else NULL (the 1-or-NULL flag convention)."""
    return F.when(cond, F.lit(1))


def one_hot(label: Column, values: Sequence[str], names: Sequence[str]) -> dict[str, Column]:
    return {n: flag(label == F.lit(v)) for v, n in zip(values, names)}


def contains(text: Column, word: str) -> Column:
    """Null-safe substring test (NULL text -> false)."""
    return F.coalesce(F.instr(text, word) > 0, F.lit(False))


def null_safe(cond: Column) -> Column:
    return F.coalesce(cond, F.lit(False))


def count_char(text: Column, ch: str) -> Column:
    """Occurrences of one character in ``text``."""
    return F.length(text) - F.length(F.replace(text, F.lit(ch), F.lit("")))


def any_equal(value, cols: Sequence[Column]) -> Column:
    """True if any column equals ``value`` (NULL never matches)."""
    out = None
    for c in cols:
        t = null_safe(c == F.lit(value))
        out = t if out is None else (out | t)
    return out


def all_null(cols: Sequence[Column]) -> Column:
    out = None
    for c in cols:
        t = c.isNull()
        out = t if out is None else (out & t)
    return out
