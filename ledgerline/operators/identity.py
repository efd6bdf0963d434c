"""Identity numbers, customer type and contact numbers.

Two ID routines: ``validate_identities`` (key, type, failure, date of birth,
age, gender, report) and the later ``classify_identities`` (adds
truncated/zero-filled and passport types).  Both are string expressions over
a 15-character, space-padded working value, evaluated in a few projections.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import months as M
from ledgerline.functions.rules import col, first_match, flag

# Company registration suffix -> company class.
COMPANY_TYPES = [
    (("06",), "Public"),
    (("07",), "Private"),
    (("08",), "Society"),
    (("09",), "Association"),
    (("10",), "Foreign"),
    (("12", "14", "20"), "Sundry"),
    (("21",), "Professional"),
    (("23",), "Closed Corp"),
    (("24",), "Co-operative"),
    (("25", "26"), "Agriculture"),
]
# Month labels used in the expanded date of birth (July reads "Jun" as delivered).
MONTH_LABELS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jun", "Aug", "Sep", "Oct", "Nov", "Dec"]
MONTH_LABELS_FIXED = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]


def _strip(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def _ljust(c: Column, width: int = 15) -> Column:
    return F.when(F.length(c) < width, F.rpad(c, width, " ")).otherwise(c)


def _compress(c: Column, width: int = 15) -> Column:
    return _ljust(_strip(F.replace(c, F.lit(" "), F.lit(""))), width)


def _ch(s: Column, i: int) -> Column:
    """Python ``s[i]`` (0-based) for i within the padded width."""
    return F.substring(s, i + 1, 1)


def _sl(s: Column, a: int, b: int | None = None) -> Column:
    """Python ``s[a:b]``."""
    return F.substr(s, F.lit(a + 1)) if b is None else F.substring(s, a + 1, b - a)


def _only(s: Column, chars_regex: str) -> Column:
    return s.rlike(f"^[{chars_regex}]*$")


def _two(n: int) -> str:
    return str(n).zfill(2)


def check_digit_ok(d: Column) -> Column:
    """Luhn-style control digit of a 13-digit number (odd positions + digit sum of doubled evens)."""
    odd = None
    for i in (0, 2, 4, 6, 8, 10):
        v = _ch(d, i).cast("int")
        odd = v if odd is None else odd + v
    evens = F.concat(*[_ch(d, i) for i in (1, 3, 5, 7, 9, 11)]).cast("bigint") * 2
    digit_sum = F.aggregate(F.split(evens.cast("string"), ""), F.lit(0), lambda acc, x: acc + F.coalesce(x.try_cast("int"), F.lit(0)))
    total = digit_sum + odd
    last = F.pmod(total, F.lit(10))
    control = F.when(last != 0, F.lit(10) - last).otherwise(F.lit(0))
    return control == _ch(d, 12).cast("int")


def _py_lstrip(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+", "")


def validate_identities(df: DataFrame, id_col: str = "id_raw", as_of=None, fixed_month_label: bool = False,
                        fixed: bool = False) -> DataFrame:
    """Clean and classify ID numbers; adds id_key, id_type, id_failure, id_dob, id_dobx, id_expand,
    id_age, id_gender, id_fix, id_report.  ``as_of`` (date) is "today" for the age.

    As delivered, company numbers with a short middle part (``yyyy/nnnnn/nn``) keep
    their text; ``fixed=True`` zero-pads the middle part to six digits, as the
    identity classifier does."""
    as_of = F.lit(as_of if as_of is not None else _dt.date(2024, 1, 31)).cast("date") if not isinstance(as_of, Column) else as_of
    s0 = _py_lstrip(F.coalesce(col(id_col).cast("string"), F.lit("None")))
    s1 = _py_lstrip(F.when(s0.endswith(".0"), F.substring(s0, F.lit(1), F.length(s0) - 2)).otherwise(s0))
    fix = _compress(s1)
    fix = F.when(_sl(fix, 0, 2) == "CK", _sl(fix, 2)).otherwise(fix)
    fix = F.when(_ch(fix, 0).isin(".", "/") & (F.length(fix) > 2), _sl(fix, 1)).otherwise(fix)
    st = df.withColumn("_fix0", fix)
    f = F.col("_fix0")
    n = F.length(_strip(f))
    digits, slashdig = _only(f, "0-9 "), _only(f, "/0-9 ")
    head4 = _sl(f, 0, 4)
    rules = [
        ((n == 13) & digits, "I", f),
        ((n == 14) & (_ch(f, 4) == "/") & (_ch(f, 11) == "/") & slashdig & (head4 > "1800"), "B", f),
        ((n == 13) & (_ch(f, 4) == "/") & (_ch(f, 10) == "/") & slashdig & (head4 > "1800"), "b",
         _compress(F.concat(_sl(f, 0, 5), F.lit("0"), _sl(f, 5))) if fixed else f),
        ((n == 12) & (_ch(f, 4) == "/") & (_ch(f, 9) == "/") & slashdig & (head4 > "1800"), "b",
         _compress(F.concat(_sl(f, 0, 5), F.lit("00"), _sl(f, 5))) if fixed else f),
        ((n == 12) & digits & (head4.try_cast("int") > 1800),
         "b", _compress(F.concat_ws("/", _sl(f, 0, 4), _sl(f, 4, 10), _sl(f, 10)))),
        ((n == 12) & (_ch(f, 2) == "/") & (_ch(f, 9) == "/") & slashdig, "b", _compress(F.concat(F.lit("00"), f))),
        ((n == 11) & (_ch(f, 2) == "/") & (_ch(f, 8) == "/") & slashdig, "b",
         _compress(F.concat(_sl(F.rtrim(F.concat(F.lit("00"), f)), 0, 5), F.lit("0"), _sl(F.rtrim(F.concat(F.lit("00"), f)), 5)))),
        ((n == 10) & (_ch(f, 2) == "/") & (_ch(f, 7) == "/") & slashdig, "b",
         _compress(F.concat(_sl(F.rtrim(F.concat(F.lit("00"), f)), 0, 5), F.lit("00"), _sl(F.rtrim(F.concat(F.lit("00"), f)), 5)))),
        ((n >= 3) & (F.upper(_sl(f, 0, 2)) == "IT") & _ch(f, 2).rlike("^[0-9]$"), "T", f),
    ]
    long_enough = F.length(_strip(F.replace(f, F.lit(" "), F.lit("")))) >= 5
    t0 = F.when(long_enough, first_match([(c, t) for c, t, _ in rules], "X")).otherwise("X")
    fx = F.when(long_enough, first_match([(c, v) for c, _, v in rules], f)).otherwise(f)
    fail0 = F.when(long_enough, F.when(t0 == "X", F.lit("00 Unsure ID Type")).otherwise(F.lit(""))).otherwise(
        F.when(F.length(f) == 0, F.lit("00 Blank ID")).otherwise(F.lit("00 Short ID (<=5)"))
    )
    st = st.withColumns({"_t0": t0, "_fx": fx, "_fail0": fail0})
    t0, fx, fail0 = F.col("_t0"), F.col("_fx"), F.col("_fail0")

    # -- consumer numbers (type I)
    yy, mm, dd = _sl(fx, 0, 2), _sl(fx, 2, 4), _sl(fx, 4, 6)
    months = [_two(i) for i in range(1, 13)]
    days = [_two(i) for i in range(1, 32)]
    leap = [_two(i) for i in range(0, 97, 4)]
    month_fail = F.when(~mm.isin(*months), F.lit("01 Month Not 01-12"))
    day_fail = F.when(~dd.isin(*days), F.lit("02 Days Not 01-31"))
    branch_fail = first_match(
        [
            ((mm == "02") & dd.isin("30", "31"), "03 FEB Day 29-31"),
            ((mm == "02") & (dd == "29") & ~yy.isin(*leap), "04 Not Leap Year"),
            ((mm == "04") & (dd == "31"), "05 Apr Day 31"),
            ((mm == "06") & (dd == "31"), "06 Jun Day 31"),
            ((mm == "09") & (dd == "31"), "07 Sep Day 31"),
            ((mm == "11") & (dd == "31"), "08 Nov Day 31"),
            (~mm.isin(*months), "09 Unknown Month"),
        ]
    )
    date_fail = F.coalesce(branch_fail, day_fail, month_fail)
    is_i = t0 == "I"
    i_fail = F.when(date_fail.isNotNull(), date_fail).when(~check_digit_ok(fx), F.lit("10 Failed Modulus 11"))
    century = F.when(yy.isin(*[_two(i) for i in range(0, 6)]), F.lit("20")).otherwise(F.lit("19"))
    labels = MONTH_LABELS_FIXED if fixed_month_label else MONTH_LABELS
    mth = F.try_element_at(F.array(*[F.lit(x) for x in labels]), F.coalesce(mm.try_cast("int"), F.lit(1)))
    dob = F.make_date(F.concat(century, yy).cast("int"), mm.cast("int"), dd.cast("int"))
    cit = _sl(fx, 10, 12)
    cit_type = first_match([(cit.isin("08", "09"), "N"), (cit.isin(*[_two(i) for i in range(0, 8)]), "n"), (cit.isin("18", "19"), "I")], "i")
    st = st.withColumn("_ifail", F.when(is_i, i_fail))
    i_ok = is_i & F.col("_ifail").isNull()

    comp = _sl(fx, 12, 14)
    comp_class = first_match([(comp.isin(*codes), lab) for codes, lab in COMPANY_TYPES])
    is_b = t0.isin("B", "b")

    failure = (
        F.when(is_i, F.coalesce(F.col("_ifail"), F.lit("")))
        .when(is_b & comp_class.isNull(), F.lit("11 Invalid Company Type"))
        .otherwise(fail0)
    )
    id_type = F.when(is_i, cit_type).when(is_b & comp_class.isNull(), F.lit("X")).otherwise(t0)
    gender = (
        F.when(i_ok, F.when(_ch(fx, 6).isin("0", "1", "2", "3", "4"), "F").otherwise("M"))
        .when(is_i, F.lit(""))
        .when(is_b, F.when(comp_class.isNull(), F.lit("")).otherwise(F.lit("B")))
        .when(t0 == "T", F.lit("T"))
        .otherwise(F.lit(""))
    )
    key = F.when(is_i, _sl(fx, 0, 10)).when(is_b, F.when(comp_class.isNull(), F.lit("")).otherwise(fx)).when(t0 == "T", fx)
    expand = F.when(i_ok, F.concat_ws(" ", dd, mth, F.concat(century, yy))).when(is_b, F.coalesce(comp_class, F.lit(""))).otherwise(F.lit(""))
    st = st.withColumns(
        {
            "_key": key, "_type": id_type, "_failure": failure, "_gender": gender, "_expand": expand,
            "_dob": F.when(i_ok, dob), "_dobx": F.when(i_ok, F.concat(century, _sl(fx, 0, 6))),
        }
    )
    zero = _sl(fx, 0, 10) == "0000000000"
    fail = F.when(zero, F.lit("0000000000 ID")).otherwise(F.col("_failure"))
    typ = F.when(zero, F.lit("")).otherwise(F.col("_type"))
    age_dob = F.when(zero, F.lit(None).cast("date")).otherwise(F.col("_dob"))
    report = (
        F.when((fail == "") & typ.isin("I", "N"), "N")
        .when((fail == "") & typ.isin("i", "n"), "O")
        .when(fail == "00 Blank ID", "-")
        .otherwise("X")
    )
    out = st.withColumns(
        {
            "id_key": F.when(zero | (fail != ""), F.lit("")).otherwise(F.col("_key")),
            "id_type": typ,
            "id_failure": fail,
            "id_dob": age_dob,
            "id_dobx": F.when(zero, F.lit("")).otherwise(F.col("_dobx")),
            "id_expand": F.when(zero, F.lit("")).otherwise(F.col("_expand")),
            "id_age": (M.elapsed_months(age_dob, as_of) / 12).cast("int"),
            "id_gender": F.when(zero, F.lit("")).otherwise(F.col("_gender")),
            "id_fix": F.when(fail != "", F.lit("")).otherwise(_strip(F.replace(fx, F.lit(" "), F.lit("")))),
            "id_report": report,
        }
    )
    return out.drop("_fix0", "_t0", "_fx", "_fail0", "_ifail", "_key", "_type", "_failure", "_gender", "_expand", "_dob", "_dobx")


def _valid_yymmdd(s: Column) -> Column:
    """``%y%m%d`` parses: month 01-12, day within the month, 29 Feb when yy is divisible by 4."""
    yy, mm, dd = _sl(s, 0, 2), _sl(s, 2, 4), _sl(s, 4, 6)
    ok_fmt = _sl(s, 0, 6).rlike("^[0-9]{6}$")
    m, d, y = mm.try_cast("int"), dd.try_cast("int"), yy.try_cast("int")
    dim = first_match([(m.isin(4, 6, 9, 11), 30), (m == 2, F.when(F.pmod(y, F.lit(4)) == 0, 29).otherwise(28))], 31)
    return F.coalesce(ok_fmt & (m >= 1) & (m <= 12) & (d >= 1) & (d <= dim), F.lit(False))


def classify_identities(df: DataFrame, id_col: str = "id_raw") -> DataFrame:
    """Later ID routine: idfix, idtype (incl. G truncated/zero-filled, P passport), idfailure, idreport,
    plus ``idkey`` (first ten characters of idfix) and ``id_digits`` (digits only)."""
    s0 = F.coalesce(col(id_col).cast("string"), F.lit("None"))
    s1 = _py_lstrip(F.when(s0.endswith(".0"), F.substring(s0, F.lit(1), F.length(s0) - 2)).otherwise(s0))
    fix = _compress(s1)
    fix = F.when(F.lower(_sl(fix, 0, 2)) == "ck", _sl(fix, 2)).otherwise(fix)
    fix = F.when(_ch(fix, 0).isin(".", "/"), _sl(fix, 1)).otherwise(fix)
    st = df.withColumn("_f", fix)
    f = F.col("_f")
    n = F.length(_strip(f))
    digits, slashdig = _only(f, "0-9 "), _only(f, "/0-9 ")
    head4 = _sl(f, 0, 4)
    padded00 = F.concat(F.lit("00"), f)
    rules = [
        ((n == 13) & digits & (_strip(_sl(f, 6, 13)) == "0000000"), "G", f),
        ((n == 6) & digits, "G", f),
        ((n == 13) & digits, "I", f),
        ((_ch(f, 4) == "/") & (_ch(f, 11) == "/") & (n == 14) & slashdig & (head4 > "1800"), "B", f),
        ((_ch(f, 4) == "/") & (_ch(f, 10) == "/") & (n == 13) & slashdig & (head4 > "1800"), "b",
         _compress(F.concat(_sl(f, 0, 5), F.lit("0"), _sl(f, 5)))),
        ((_ch(f, 4) == "/") & (_ch(f, 9) == "/") & (n == 12) & slashdig & (head4 > "1800"), "b",
         _compress(F.concat(_sl(f, 0, 5), F.lit("00"), _sl(f, 5)))),
        ((n == 12) & digits & (head4 > "1800"), "b", _compress(F.concat_ws("/", _sl(f, 0, 4), _sl(f, 4, 10), _sl(f, 10)))),
        ((_ch(f, 2) == "/") & (_ch(f, 9) == "/") & (n == 12) & slashdig, "b", _compress(padded00)),
        ((_ch(f, 2) == "/") & (_ch(f, 8) == "/") & (n == 11) & slashdig, "b",
         _compress(F.concat(_sl(F.rtrim(padded00), 0, 5), F.lit("0"), _sl(F.rtrim(padded00), 5)))),
        ((_ch(f, 2) == "/") & (_ch(f, 7) == "/") & (F.length(F.rtrim(f)) == 10) & slashdig, "b",
         _compress(F.concat(_sl(padded00, 0, 5), F.lit("00"), _sl(padded00, 5)))),
        ((F.upper(_sl(f, 0, 2)) == "IT") & _ch(f, 2).rlike("^[0-9]$"), "T", f),
        (f.rlike(r"\p{L}"), "P", f),
    ]
    core_len = F.length(_strip(F.replace(f, F.lit(" "), F.lit(""))))
    blank = (core_len <= 1) | _strip(f).isin("", ".", "None")
    t0 = F.when(core_len >= 6, first_match([(c, t) for c, t, _ in rules], "X")).otherwise("X")
    fx = F.when(core_len >= 6, first_match([(c, v) for c, _, v in rules], f)).otherwise(f)
    fail0 = (
        F.when(core_len >= 6, F.when(t0 == "X", F.lit("00 Unsure ID Type")).otherwise(F.lit("")))
        .when(blank, F.lit("01 Blank ID"))
        .otherwise(F.lit("00 Short ID <= 5"))
    )
    st = st.withColumns({"_t": t0, "_fx": fx, "_fail0": fail0})
    t, fx, fail0 = F.col("_t"), F.col("_fx"), F.col("_fail0")
    dob_ok = _valid_yymmdd(fx)
    i_fail = F.when(~check_digit_ok(fx), F.lit("05 Failed Modulus 11 Test")).when(~dob_ok, F.lit("02 Impossible Date of Birth"))
    g_fail = F.when(~dob_ok, F.lit("02 Impossible Date of Birth")).when(
        F.length(_strip(fx)) == 13, F.lit("03 Last 7 digits replaced by zeros")
    ).otherwise(F.lit("04 Truncation of last 7 digits"))
    failure = F.when(t == "I", F.coalesce(i_fail, fail0)).when(t == "G", g_fail).otherwise(fail0)
    cit = _sl(fx, 10, 12)
    cit_type = first_match([(cit.isin("08", "09"), "N"), (cit.isin(*[_two(i) for i in range(0, 8)]), "n"), (cit.isin("18", "19"), "I")], "i")
    id_type = F.when(t == "I", cit_type).otherwise(t)
    zeros = _strip(fx).rlike("^0*$")
    failure = F.when(zeros, F.lit("06 Only zero digits")).otherwise(failure)
    st = st.withColumns({"idtype": id_type, "idfailure": failure})
    ft, fl = F.col("idtype"), F.col("idfailure")
    report = (
        F.when((fl == "") & ft.isin("I", "N"), "N")
        .when((fl == "") & ft.isin("i", "n"), "O")
        .when(fl.isin("01 Blank ID", "06 Only zero digits", "03 Last 7 digits replaced by zeros", "04 Truncation of last 7 digits"), "-")
        .when(fl == "00 Unsure ID Type", "U")
        .otherwise("X")
    )
    clean = _strip(F.replace(fx, F.lit(" "), F.lit("")))
    idfix = F.when(F.lower(clean) == "none", F.lit(None).cast("string")).otherwise(clean)
    out = st.withColumns({"idfix": idfix, "idreport": report})
    out = out.withColumns(
        {
            "idkey": F.when(F.col("idfix").isNull() | (F.col("idfix") == ""), F.col("idfix")).otherwise(F.substring("idfix", 1, 10)),
            "id_digits": F.regexp_replace(col(id_col).cast("string"), "[^0-9]", ""),
        }
    )
    return out.drop("_f", "_t", "_fx", "_fail0")


def extract_idkey(c) -> Column:
    """First ten characters; NULL or empty stay as they are."""
    x = col(c)
    return F.when(x.isNull() | (x == ""), x).otherwise(F.substring(x, 1, 10))


def keep_digits(c) -> Column:
    return F.regexp_replace(col(c), "[^0-9]", "")


def derive_customer_type(df: DataFrame, id_type="id_type", account_type="account_type", analysis_b=None,
                         version: int = 2) -> DataFrame:
    """Consumer / Enterprise from the ID type, overridden by the account type (and, v2, analysis B).

    v1 -> ``customer_typ`` in {"", Consumer, Enterprise}.  v2 -> ``customer_typ``
    defaulting to "Unknown" plus the three trigger flags (set even when a later
    source overrides).
    """
    idt = F.coalesce(col(id_type), F.lit(""))
    typ = F.coalesce(col(account_type), F.lit(""))
    if version == 1:
        i, a = F.upper(idt), F.upper(typ)
        base = F.when(i.isin("N", "I"), "Consumer").when(i == "B", "Enterprise").otherwise("")
        over = F.when(a.isin("1", "SOUTHAFRICANID", "2", "PASSPORT", "5", "TEMPRESIDENCE"), "Consumer").when(
            a.isin("3", "COMPANYID", "BUSINESSREGNUM"), "Enterprise"
        )
        return df.withColumn("customer_typ", F.coalesce(over, base))
    anb = F.upper(F.trim(F.coalesce(col(analysis_b), F.lit("")))) if analysis_b else F.lit("")
    a = F.upper(F.trim(typ))
    t_id = idt.isin("B", "b")
    t_acc = a.isin("3", "COMPANYID", "BUSINESSREGNUM")
    t_anb = anb == "BUSINESS"
    base = F.when(idt.isin("N", "n", "I", "i"), "Consumer").when(t_id, "Enterprise").otherwise("Unknown")
    acc = F.when(a.isin("1", "SOUTHAFRICANID", "2", "PASSPORT", "5", "TEMPRESIDENCE", "OTHERS", "EMIS"), "Consumer").when(t_acc, "Enterprise")
    typ_out = F.when(t_anb, F.lit("Enterprise")).otherwise(F.coalesce(acc, base))
    return df.withColumns(
        {
            "customer_typ": typ_out,
            "trigger_idvalidate": flag(t_id).cast("int"),
            "trigger_account_type": flag(t_acc).cast("int"),
            "trigger_analysis_b": flag(t_anb).cast("int"),
        }
    )


def normalise_contacts(df: DataFrame, contact="contact_raw", out="contact_number") -> DataFrame:
    """South-African numbers to 10-digit 0xxxxxxxxx; anything else NULL."""
    s = col(contact).cast("string")
    s = F.when(s.endswith(".0"), F.substring(s, F.lit(1), F.length(s) - 2)).otherwise(s)
    n = F.length(s)
    norm = (
        F.when(s.isNull() | s.isin("", "."), F.lit(None).cast("string"))
        .when(n == 9, F.concat(F.lit("0"), s))
        .when((n == 10) & s.startswith("0"), s)
        .when((F.substring(s, 1, 3) == "+27") & (n == 12), F.concat(F.lit("0"), F.substring(s, 4, 100)))
        .when((F.substring(s, 1, 2) == "27") & (n == 11), F.concat(F.lit("0"), F.substring(s, 3, 100)))
    )
    return df.withColumn(out, norm)
