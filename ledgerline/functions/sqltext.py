"""Spark SQL expression text for wide rule ladders.

Building a long CASE ladder from Column objects costs one Python-to-JVM call
per node; the same ladder written as SQL text is parsed in one call.  These
helpers only assemble text; ``F.expr`` turns it into a Column.
"""

from __future__ import annotations

from collections.abc import Sequence


def q(value) -> str:
    """SQL literal for a Python value."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, (int, float)):
        return repr(value)
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def ident(name: str) -> str:
    return f"`{name}`"


def case(rules: Sequence[tuple[str, str]], default: str | None = None) -> str:
    """CASE WHEN c1 THEN v1 ... [ELSE default] END from (condition, value) SQL texts."""
    body = " ".join(f"WHEN {c} THEN {v}" for c, v in rules)
    return f"CASE {body} ELSE {default} END" if default is not None else f"CASE {body} END"


def true_or_false(cond: str) -> str:
    """A condition that is false (not NULL) when its inputs are NULL."""
    return f"coalesce({cond}, false)"


def in_list(expr: str, values: Sequence) -> str:
    return f"{expr} IN ({', '.join(q(v) for v in values)})"
