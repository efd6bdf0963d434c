"""60-month string profiles: normalise, shift, read, generate, encode, build.

A profile holds one chunk per month, newest month leftmost.  Chunks are
1 character (AGE, DLQ, GBIPX), 2 characters plus a pipe (MOB) or 5 characters
plus a pipe (BAL, INS, PMT); ``.`` marks a missing month.  Everything here is
a native string expression evaluated inside one projection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.rules import col, flag

# Profile type -> (characters per element, characters per chunk, full length).
PROFILE_TYPES = {
    "AGE": (1, 1, 60),
    "DLQ": (1, 1, 60),
    "GBIPX": (1, 1, 60),
    "MOB": (2, 3, 180),
    "BAL": (5, 6, 360),
    "INS": (5, 6, 360),
    "PMT": (5, 6, 360),
}
MONTHS = 60


def _missing_chunk(ptype: str) -> str:
    elem, chunk, _ = PROFILE_TYPES[ptype]
    return "." * elem if elem <= 1 else "." * elem + "|"


def missing_profile(ptype: str) -> str:
    elem, _, full = PROFILE_TYPES[ptype]
    return "." * full if elem <= 1 else _missing_chunk(ptype) * MONTHS


def normalise(profile, ptype: str) -> Column:
    """Pad on the right with whole missing chunks (a partial deficit stays short), or truncate."""
    p = col(profile)
    _, chunk, full = PROFILE_TYPES[ptype]
    n = F.length(p)
    pad = F.repeat(F.lit(_missing_chunk(ptype)), F.floor((F.lit(full) - n) / chunk).cast("int"))
    return (
        F.when(p.isNull() | (n == 0), F.lit(missing_profile(ptype)))
        .when(n < full, F.concat(p, pad))
        .when(n == full, p)
        .otherwise(F.substring(p, 1, full))
    )


def shift_back(profile, ptype: str) -> Column:
    """Drop the newest month and re-normalise (the profile as seen one month earlier)."""
    p = col(profile)
    chunk = PROFILE_TYPES[ptype][1]
    return normalise(F.substr(p, F.lit(chunk + 1)), ptype)


def prefix_month(profile, element, ptype: str) -> Column:
    """Monthly roll: the new month's element in front of the old profile, normalised."""
    elem, chunk, _ = PROFILE_TYPES[ptype]
    e = col(element)
    piece = e if elem <= 1 else F.concat(e, F.lit("|"))
    return normalise(F.concat(F.coalesce(piece, F.lit(_missing_chunk(ptype))), F.coalesce(col(profile), F.lit(""))), ptype)


def element_at_month(profile, chunk_chars: int, pipe_present: bool = True, point_in_time=1, fixed: bool = False) -> Column:
    """Element of one month; NULL when it holds a ``.``.

    Default reads month 1 whatever ``point_in_time`` says (the long-standing
    behaviour); ``fixed=True`` reads month ``point_in_time``.
    """
    p = col(profile)
    width = chunk_chars - 1 if pipe_present else chunk_chars
    if fixed:
        pit = point_in_time if isinstance(point_in_time, Column) else F.lit(point_in_time)
        start = (pit - 1) * chunk_chars + 1
        el = F.substr(p, start, F.lit(width))
    else:
        el = F.substring(p, 1, width)
    return F.when(F.instr(el, ".") > 0, F.lit(None).cast("string")).otherwise(el)


def mob_category(profile, point_in_time: int = 1, fixed: bool = False) -> dict[str, Column]:
    """MOB element at a month and its class: missing (``..``), immature (00-05), established."""
    p = col(profile)
    start = (point_in_time - 1) * 3 + 1 if fixed else point_in_time
    el = F.substring(p, start, 2)
    return {
        "account_mob": el,
        "mob_missing": flag(el == ".."),
        "mob_immature": flag((el != "..") & el.isin("00", "01", "02", "03", "04", "05")),
        "mob_established": flag(~((el == "..") | el.isin("00", "01", "02", "03", "04", "05"))),
    }


def generate_mob_profile(mob_start) -> Column:
    """60 months on book counting down from ``mob_start``; capped at 99, negative -> ``..``."""
    m = col(mob_start)
    items = F.transform(
        F.sequence(F.lit(0), F.lit(MONTHS - 1)),
        lambda i: F.when(m - i < 0, F.lit("..")).otherwise(F.lpad(F.least(m - i, F.lit(99)).cast("string"), 2, "0")),
    )
    return F.concat(F.array_join(items, "|"), F.lit("|"))


def derive_first_mob(profile) -> Column:
    """Month-1 months-on-book implied by the oldest known non-zero MOB element (as text).

    Elements holding ``.`` are unknown; a value 00 is skipped like a missing one.
    """
    p = col(profile)
    chunks = F.split(F.substring(p, 1, F.length(p) - 1), r"\|")
    vals = F.transform(chunks, lambda c: F.when(F.instr(c, ".") > 0, F.lit(None).cast("int")).otherwise(c.cast("int")))
    rev = F.reverse(vals)
    hits = F.filter(
        F.transform(rev, lambda v, i: F.struct(v.alias("v"), i.alias("i"))),
        lambda s: s["v"].isNotNull() & (s["v"] != 0),
    )
    first = F.try_element_at(hits, F.lit(1))
    return (first["v"] + F.lit(MONTHS - 1) - first["i"]).cast("string")


def _as_long_text(v: Column, dtype: str) -> Column:
    """Integer value of a number or of text an integer parser accepts; NULL otherwise."""
    if dtype == "string":
        t = F.trim(v)
        return F.when(t.rlike(r"^[+-]?[0-9]+$"), t.try_cast("bigint"))
    return v.cast("bigint")


def encode_value(value, width: int, dtype: str = "bigint") -> Column:
    """Fixed-width profile text of a number.

    Width 5: ``.....`` for NULL/unparseable, clamp to -9999..99999, zero-pad
    with the sign counted in the width (-5 -> ``-0005``).  Width 2: ``..``,
    clamp to -9..99, zero-pad.  Width 1: the value as text, ``.`` for NULL.
    """
    v = _as_long_text(col(value), dtype)
    if width == 1:
        return F.coalesce(col(value).cast("string"), F.lit("."))
    lo, hi = (-9999, 99999) if width == 5 else (-9, 99)
    clamped = F.least(F.greatest(v, F.lit(lo)), F.lit(hi))
    fmt = F.format_string(f"%0{width}d", clamped)
    return F.coalesce(fmt, F.lit("." * width))


def cents_to_units(value) -> Column:
    """Cents -> whole units, truncated toward zero."""
    v = col(value)
    return (v / 100).cast("bigint")


def round_half_even_int(value, digits: int = 0) -> Column:
    return F.bround(col(value), digits).cast("int")


def pipe_count(profile) -> Column:
    p = col(profile)
    return (F.length(p) - F.length(F.replace(p, F.lit("|"), F.lit("")))).cast("int")


# ---------------------------------------------------------------- table operators


def normalise_profiles(df: DataFrame, cols: dict[str, str]) -> DataFrame:
    """Normalise each ``{column: profile type}`` in place."""
    return df.withColumns({c: normalise(c, t) for c, t in cols.items()})


def shift_profiles(df: DataFrame, cols: dict[str, str], suffix: str = "_prev") -> DataFrame:
    return df.withColumns({f"{c}{suffix}": shift_back(c, t) for c, t in cols.items()})


def extract_profile_element(df: DataFrame, cols: dict[str, str], point_in_time=1, fixed: bool = False) -> DataFrame:
    out = {}
    for c, t in cols.items():
        elem, chunk, _ = PROFILE_TYPES[t]
        out[f"{c}_m01"] = element_at_month(c, chunk, pipe_present=elem > 1, point_in_time=point_in_time, fixed=fixed)
    return df.withColumns(out)


def generate_mob_profiles(df: DataFrame, mob_start_col: str, out: str = "mob_profile") -> DataFrame:
    return df.withColumn(out, generate_mob_profile(mob_start_col))


def derive_first_mob_col(df: DataFrame, profile_col: str, out: str = "first_mob") -> DataFrame:
    return df.withColumn(out, derive_first_mob(profile_col))


def mob_categories(df: DataFrame, profile_col: str, point_in_time: int = 1, fixed: bool = False) -> DataFrame:
    return df.withColumns(mob_category(profile_col, point_in_time, fixed))


def profile_integrity(df: DataFrame, cols: dict[str, str]) -> DataFrame:
    """Pipe count and length of each profile, and whether both are as the type expects."""
    out = {}
    for c, t in cols.items():
        elem, _, full = PROFILE_TYPES[t]
        pipes = pipe_count(c)
        length = F.length(col(c)).cast("int")
        out[f"{c}_pipes"] = pipes
        out[f"{c}_length"] = length
        out[f"{c}_ok"] = flag((length == full) & (pipes == (MONTHS if elem > 1 else 0)))
    return df.withColumns(out)


def build_profiles(df: DataFrame, profile_col: str, element_col: str, ptype: str, out: str | None = None) -> DataFrame:
    """Monthly roll: prefix this month's element to last month's profile."""
    return df.withColumn(out or profile_col, prefix_month(profile_col, element_col, ptype))


def roll_profiles(profiles: DataFrame, month: DataFrame, key: str, elements: dict[str, tuple[str, str]]) -> DataFrame:
    """Every account of the old profiles or the new month, with the month's elements in front: ``elements`` maps a profile
    column to (element column of ``month``, profile type).

    Accounts without a row in the month get a missing element, new accounts a profile of missing months behind it; ``month``
    holds at most one row of a key.  Where both sides are bucketed by the key into equally many buckets
    (``sources.bucketed``), the join shuffles neither: a month is added by reading the profiles once, in place.
    """
    held = profiles.join(month.select(key, *[e for e, _ in elements.values()]), key, "full_outer")
    return held.select(key, *[prefix_month(c, e, t).alias(c) for c, (e, t) in elements.items()])


def build_profiles_from_months(df: DataFrame, key: str, month_col: str, value_col: str, ptype: str, out: str = "profile") -> DataFrame:
    """Bulk build from long form ``(key, month_idx 1..60, element)``.

    One partial aggregation per key (60 conditional maxima, no collected
    lists), so a key with many months never materialises as one group.
    """
    elem, _, _ = PROFILE_TYPES[ptype]
    aggs = [
        F.max(F.when(F.col(month_col) == k, F.col(value_col))).alias(f"_m{k}") for k in range(1, MONTHS + 1)
    ]
    missing = "." * elem
    parts = []
    for k in range(1, MONTHS + 1):
        parts.append(F.coalesce(F.col(f"_m{k}"), F.lit(missing)))
        if elem > 1:
            parts.append(F.lit("|"))
    return df.groupBy(key).agg(*aggs).select(key, F.concat(*parts).alias(out))


def flag_simultaneous(a, b, value=1) -> Column:
    """1 when both columns equal ``value``, else NULL."""
    return flag((col(a) == F.lit(value)) & (col(b) == F.lit(value)))
