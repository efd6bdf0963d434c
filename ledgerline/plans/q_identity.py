"""Identity, customer-type and contact queries over ``fx_identities`` and ``fx_accounts``."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ledgerline.operators import identity as I
from ledgerline.plans.catalog import query
from ledgerline.sources.fixtures import fixture, fixture_cte

_ID, _ACC = fixture_cte("fx_identities"), fixture_cte("fx_accounts")
AS_OF = dt.date(2024, 1, 31)

# ---------------------------------------------------------------- SQL helpers (DuckDB)


def strip(x):
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def lstrip(x):
    return f"regexp_replace({x}, '^\\s+', '')"


def ljust(x, w=15):
    return f"CASE WHEN length({x}) < {w} THEN rpad({x}, {w}, ' ') ELSE {x} END"


def compress(x):
    return ljust(strip(f"replace({x}, ' ', '')"))


def ch(s, i):
    return f"substr({s}, {i + 1}, 1)"


def sl(s, a, b=None):
    return f"substr({s}, {a + 1}, {b - a})" if b is not None else f"substr({s}, {a + 1})"


def only(s, cls):
    return f"regexp_matches({s}, '^[{cls}]*$')"


def inlist(x, vals):
    return f"{x} IN (" + ", ".join(f"'{v}'" for v in vals) + ")"


def check_sql(d):
    odd = " + ".join(f"CAST({ch(d, i)} AS INTEGER)" for i in (0, 2, 4, 6, 8, 10))
    ev = f"CAST(CAST({' || '.join(ch(d, i) for i in (1, 3, 5, 7, 9, 11))} AS BIGINT) * 2 AS VARCHAR)"
    dsum = f"list_sum(list_transform(string_split({ev}, ''), lambda x: CAST(x AS INTEGER)))"
    tot = f"({dsum} + {odd})"
    return f"(CASE WHEN {tot} % 10 <> 0 THEN 10 - {tot} % 10 ELSE 0 END) = CAST({ch(d, 12)} AS INTEGER)"


NOSPACE = "replace(f, ' ', '')"
TWO = lambda rng: [str(i).zfill(2) for i in rng]


def _validate_sql() -> str:
    s0 = lstrip("coalesce(id_raw, 'None')")
    a = f"""a AS (SELECT rec, id_raw, {s0} AS s0 FROM fx_identities),
b AS (SELECT *, {lstrip("CASE WHEN s0 LIKE '%.0' THEN substr(s0, 1, length(s0) - 2) ELSE s0 END")} AS s1 FROM a),
c AS (SELECT *, {compress('s1')} AS f1 FROM b),
d AS (SELECT *, CASE WHEN {sl('f1', 0, 2)} = 'CK' THEN {sl('f1', 2)} ELSE f1 END AS f2 FROM c),
e AS (SELECT *, CASE WHEN {ch('f2', 0)} IN ('.', '/') AND length(f2) > 2 THEN {sl('f2', 1)} ELSE f2 END AS f FROM d)"""
    n = f"length({strip('f')})"
    dig, sd, h4 = only("f", "0-9 "), only("f", "/0-9 "), sl("f", 0, 4)
    p00 = "rtrim('00' || f)"
    rules = [
        (f"{n} = 13 AND {dig}", "I", "f"),
        (f"{n} = 14 AND {ch('f', 4)} = '/' AND {ch('f', 11)} = '/' AND {sd} AND {h4} > '1800'", "B", "f"),
        (f"{n} = 13 AND {ch('f', 4)} = '/' AND {ch('f', 10)} = '/' AND {sd} AND {h4} > '1800'", "b", "f"),
        (f"{n} = 12 AND {ch('f', 4)} = '/' AND {ch('f', 9)} = '/' AND {sd} AND {h4} > '1800'", "b", "f"),
        (f"{n} = 12 AND {dig} AND TRY_CAST({h4} AS INTEGER) > 1800", "b", compress(f"{sl('f', 0, 4)} || '/' || {sl('f', 4, 10)} || '/' || {sl('f', 10)}")),
        (f"{n} = 12 AND {ch('f', 2)} = '/' AND {ch('f', 9)} = '/' AND {sd}", "b", compress("'00' || f")),
        (f"{n} = 11 AND {ch('f', 2)} = '/' AND {ch('f', 8)} = '/' AND {sd}", "b", compress(f"{sl(p00, 0, 5)} || '0' || {sl(p00, 5)}")),
        (f"{n} = 10 AND {ch('f', 2)} = '/' AND {ch('f', 7)} = '/' AND {sd}", "b", compress(f"{sl(p00, 0, 5)} || '00' || {sl(p00, 5)}")),
        (f"{n} >= 3 AND upper({sl('f', 0, 2)}) = 'IT' AND regexp_matches({ch('f', 2)}, '^[0-9]$')", "T", "f"),
    ]
    le = f"length({strip(NOSPACE)}) >= 5"
    t0 = "CASE " + " ".join(f"WHEN {c} THEN '{t}'" for c, t, _ in rules) + " ELSE 'X' END"
    fx = "CASE " + " ".join(f"WHEN {c} THEN {v}" for c, _, v in rules) + " ELSE f END"
    g = f"""g AS (SELECT *, CASE WHEN {le} THEN {t0} ELSE 'X' END AS t0, CASE WHEN {le} THEN {fx} ELSE f END AS fx,
      CASE WHEN {le} THEN CASE WHEN ({t0}) = 'X' THEN '00 Unsure ID Type' ELSE '' END
           WHEN length(f) = 0 THEN '00 Blank ID' ELSE '00 Short ID (<=5)' END AS fail0 FROM e)"""
    yy, mm, dd = sl("fx", 0, 2), sl("fx", 2, 4), sl("fx", 4, 6)
    months, days, leap = TWO(range(1, 13)), TWO(range(1, 32)), TWO(range(0, 97, 4))
    branch = (f"CASE WHEN {mm} = '02' AND {dd} IN ('30', '31') THEN '03 FEB Day 29-31' "
              f"WHEN {mm} = '02' AND {dd} = '29' AND NOT {inlist(yy, leap)} THEN '04 Not Leap Year' "
              f"WHEN {mm} = '04' AND {dd} = '31' THEN '05 Apr Day 31' WHEN {mm} = '06' AND {dd} = '31' THEN '06 Jun Day 31' "
              f"WHEN {mm} = '09' AND {dd} = '31' THEN '07 Sep Day 31' WHEN {mm} = '11' AND {dd} = '31' THEN '08 Nov Day 31' "
              f"WHEN NOT {inlist(mm, months)} THEN '09 Unknown Month' END")
    datef = (f"coalesce({branch}, CASE WHEN NOT {inlist(dd, days)} THEN '02 Days Not 01-31' END, "
             f"CASE WHEN NOT {inlist(mm, months)} THEN '01 Month Not 01-12' END)")
    h = f"""h AS (SELECT *, CASE WHEN t0 = 'I' THEN CASE WHEN {datef} IS NOT NULL THEN {datef}
               WHEN NOT ({check_sql('fx')}) THEN '10 Failed Modulus 11' END END AS ifail FROM g)"""
    century = f"CASE WHEN {inlist(yy, TWO(range(0, 6)))} THEN '20' ELSE '19' END"
    mth = "[" + ", ".join(f"'{m}'" for m in I.MONTH_LABELS) + f"][TRY_CAST({mm} AS INTEGER)]"
    cit = sl("fx", 10, 12)
    cit_t = f"CASE WHEN {cit} IN ('08', '09') THEN 'N' WHEN {inlist(cit, TWO(range(0, 8)))} THEN 'n' WHEN {cit} IN ('18', '19') THEN 'I' ELSE 'i' END"
    comp = sl("fx", 12, 14)
    cls = "CASE " + " ".join(f"WHEN {inlist(comp, codes)} THEN '{lab}'" for codes, lab in I.COMPANY_TYPES) + " END"
    i = f"""i AS (SELECT *, t0 = 'I' AND ifail IS NULL AS i_ok, t0 IN ('B', 'b') AS is_b, {cls} AS cls FROM h),
j AS (SELECT *,
  CASE WHEN t0 = 'I' THEN coalesce(ifail, '') WHEN is_b AND cls IS NULL THEN '11 Invalid Company Type' ELSE fail0 END AS fail1,
  CASE WHEN t0 = 'I' THEN {cit_t} WHEN is_b AND cls IS NULL THEN 'X' ELSE t0 END AS type1,
  CASE WHEN i_ok THEN CASE WHEN {ch('fx', 6)} IN ('0', '1', '2', '3', '4') THEN 'F' ELSE 'M' END WHEN t0 = 'I' THEN ''
       WHEN is_b THEN CASE WHEN cls IS NULL THEN '' ELSE 'B' END WHEN t0 = 'T' THEN 'T' ELSE '' END AS gender1,
  CASE WHEN t0 = 'I' THEN {sl('fx', 0, 10)} WHEN is_b THEN CASE WHEN cls IS NULL THEN '' ELSE fx END WHEN t0 = 'T' THEN fx END AS key1,
  CASE WHEN i_ok THEN {dd} || ' ' || {mth} || ' ' || {century} || {yy} WHEN is_b THEN coalesce(cls, '') ELSE '' END AS expand1,
  CASE WHEN i_ok THEN make_date(CAST({century} || {yy} AS INTEGER), CAST({mm} AS INTEGER), CAST({dd} AS INTEGER)) END AS dob1,
  CASE WHEN i_ok THEN {century} || {sl('fx', 0, 6)} END AS dobx1,
  {sl('fx', 0, 10)} = '0000000000' AS zero
FROM i)"""
    asof = f"DATE '{AS_OF.isoformat()}'"
    dm = f"((year({asof}) - year(dob)) * 12 + month({asof}) - month(dob))"
    elapsed = (f"CASE WHEN {asof} >= dob THEN {dm} - CASE WHEN CAST(dob + to_months({dm}) AS DATE) > {asof} THEN 1 ELSE 0 END "
               f"ELSE {dm} + CASE WHEN CAST(dob + to_months({dm}) AS DATE) < {asof} THEN 1 ELSE 0 END END")
    k = f"""k AS (SELECT *, CASE WHEN zero THEN '0000000000 ID' ELSE fail1 END AS fail, CASE WHEN zero THEN '' ELSE type1 END AS typ,
       CASE WHEN zero THEN NULL ELSE dob1 END AS dob FROM j)"""
    final = f"""SELECT rec, id_raw,
  CASE WHEN zero OR fail <> '' THEN '' ELSE key1 END AS id_key, typ AS id_type, fail AS id_failure, dob AS id_dob,
  CASE WHEN zero THEN '' ELSE dobx1 END AS id_dobx, CASE WHEN zero THEN '' ELSE expand1 END AS id_expand,
  CAST(trunc(({elapsed}) / 12) AS INTEGER) AS id_age, CASE WHEN zero THEN '' ELSE gender1 END AS id_gender,
  CASE WHEN fail <> '' THEN '' ELSE {strip("replace(fx, ' ', '')")} END AS id_fix,
  CASE WHEN fail = '' AND typ IN ('I', 'N') THEN 'N' WHEN fail = '' AND typ IN ('i', 'n') THEN 'O' WHEN fail = '00 Blank ID' THEN '-' ELSE 'X' END AS id_report
FROM k"""
    return f"WITH {_ID},\n{a},\n{g},\n{h},\n{i},\n{k}\n{final}"


@query("validate_identities", oracle=_validate_sql())
def q_validate_identities(spark, sf_dir):
    return I.validate_identities(fixture(spark, sf_dir, "fx_identities"), "id_raw", as_of=AS_OF)


def _classify_sql() -> str:
    s0 = "coalesce(id_raw, 'None')"
    a = f"""a AS (SELECT rec, id_raw, {lstrip(f"CASE WHEN {s0} LIKE '%.0' THEN substr({s0}, 1, length({s0}) - 2) ELSE {s0} END")} AS s1 FROM fx_identities),
c AS (SELECT *, {compress('s1')} AS f1 FROM a),
d AS (SELECT *, CASE WHEN lower({sl('f1', 0, 2)}) = 'ck' THEN {sl('f1', 2)} ELSE f1 END AS f2 FROM c),
e AS (SELECT *, CASE WHEN {ch('f2', 0)} IN ('.', '/') THEN {sl('f2', 1)} ELSE f2 END AS f FROM d)"""
    n = f"length({strip('f')})"
    dig, sd, h4 = only("f", "0-9 "), only("f", "/0-9 "), sl("f", 0, 4)
    p00 = "('00' || f)"
    rules = [
        (f"{n} = 13 AND {dig} AND {strip(sl('f', 6, 13))} = '0000000'", "G", "f"),
        (f"{n} = 6 AND {dig}", "G", "f"),
        (f"{n} = 13 AND {dig}", "I", "f"),
        (f"{ch('f', 4)} = '/' AND {ch('f', 11)} = '/' AND {n} = 14 AND {sd} AND {h4} > '1800'", "B", "f"),
        (f"{ch('f', 4)} = '/' AND {ch('f', 10)} = '/' AND {n} = 13 AND {sd} AND {h4} > '1800'", "b", compress(f"{sl('f', 0, 5)} || '0' || {sl('f', 5)}")),
        (f"{ch('f', 4)} = '/' AND {ch('f', 9)} = '/' AND {n} = 12 AND {sd} AND {h4} > '1800'", "b", compress(f"{sl('f', 0, 5)} || '00' || {sl('f', 5)}")),
        (f"{n} = 12 AND {dig} AND {h4} > '1800'", "b", compress(f"{sl('f', 0, 4)} || '/' || {sl('f', 4, 10)} || '/' || {sl('f', 10)}")),
        (f"{ch('f', 2)} = '/' AND {ch('f', 9)} = '/' AND {n} = 12 AND {sd}", "b", compress(p00)),
        (f"{ch('f', 2)} = '/' AND {ch('f', 8)} = '/' AND {n} = 11 AND {sd}", "b",
         compress(f"{sl(f'rtrim({p00})', 0, 5)} || '0' || {sl(f'rtrim({p00})', 5)}")),
        (f"{ch('f', 2)} = '/' AND {ch('f', 7)} = '/' AND length(rtrim(f)) = 10 AND {sd}", "b", compress(f"{sl(p00, 0, 5)} || '00' || {sl(p00, 5)}")),
        (f"upper({sl('f', 0, 2)}) = 'IT' AND regexp_matches({ch('f', 2)}, '^[0-9]$')", "T", "f"),
        ("regexp_matches(f, '\\p{L}')", "P", "f"),
    ]
    core = f"length({strip(NOSPACE)})"
    t0 = "CASE " + " ".join(f"WHEN {c} THEN '{t}'" for c, t, _ in rules) + " ELSE 'X' END"
    fx = "CASE " + " ".join(f"WHEN {c} THEN {v}" for c, _, v in rules) + " ELSE f END"
    g = f"""g AS (SELECT *, CASE WHEN {core} >= 6 THEN {t0} ELSE 'X' END AS t, CASE WHEN {core} >= 6 THEN {fx} ELSE f END AS fx,
      CASE WHEN {core} >= 6 THEN CASE WHEN ({t0}) = 'X' THEN '00 Unsure ID Type' ELSE '' END
           WHEN {core} <= 1 OR {strip('f')} IN ('', '.', 'None') THEN '01 Blank ID' ELSE '00 Short ID <= 5' END AS fail0 FROM e)"""
    yy, mm, dd = (f"TRY_CAST({sl('fx', a, a + 2)} AS INTEGER)" for a in (0, 2, 4))
    dim = f"CASE WHEN {mm} IN (4, 6, 9, 11) THEN 30 WHEN {mm} = 2 THEN CASE WHEN {yy} % 4 = 0 THEN 29 ELSE 28 END ELSE 31 END"
    dob_ok = f"coalesce(regexp_matches({sl('fx', 0, 6)}, '^[0-9]{{6}}$') AND {mm} BETWEEN 1 AND 12 AND {dd} >= 1 AND {dd} <= {dim}, false)"
    cit = sl("fx", 10, 12)
    cit_t = f"CASE WHEN {cit} IN ('08', '09') THEN 'N' WHEN {inlist(cit, TWO(range(0, 8)))} THEN 'n' WHEN {cit} IN ('18', '19') THEN 'I' ELSE 'i' END"
    h = f"""h AS (SELECT *,
  CASE WHEN regexp_matches({strip('fx')}, '^0*$') THEN '06 Only zero digits'
       WHEN t = 'I' THEN coalesce(CASE WHEN NOT ({check_sql('fx')}) THEN '05 Failed Modulus 11 Test' WHEN NOT {dob_ok} THEN '02 Impossible Date of Birth' END, fail0)
       WHEN t = 'G' THEN CASE WHEN NOT {dob_ok} THEN '02 Impossible Date of Birth'
                              WHEN length({strip('fx')}) = 13 THEN '03 Last 7 digits replaced by zeros' ELSE '04 Truncation of last 7 digits' END
       ELSE fail0 END AS idfailure,
  CASE WHEN t = 'I' THEN {cit_t} ELSE t END AS idtype,
  {strip("replace(fx, ' ', '')")} AS clean FROM g)"""
    final = """SELECT rec, id_raw, CASE WHEN lower(clean) = 'none' THEN NULL ELSE clean END AS idfix, idtype, idfailure,
  CASE WHEN idfailure = '' AND idtype IN ('I', 'N') THEN 'N' WHEN idfailure = '' AND idtype IN ('i', 'n') THEN 'O'
       WHEN idfailure IN ('01 Blank ID', '06 Only zero digits', '03 Last 7 digits replaced by zeros', '04 Truncation of last 7 digits') THEN '-'
       WHEN idfailure = '00 Unsure ID Type' THEN 'U' ELSE 'X' END AS idreport,
  CASE WHEN lower(clean) = 'none' THEN NULL WHEN clean = '' THEN clean ELSE substr(clean, 1, 10) END AS idkey,
  regexp_replace(id_raw, '[^0-9]', '', 'g') AS id_digits
FROM h"""
    return f"WITH {_ID},\n{a},\n{g},\n{h}\n{final}"


@query("classify_identities", oracle=_classify_sql())
def q_classify_identities(spark, sf_dir):
    return I.classify_identities(fixture(spark, sf_dir, "fx_identities"), "id_raw")


# account type code per account (fixture accounts carry none): derived from the account category
_ACCOUNT_TYPE = "CASE account_cat WHEN 'NEW' THEN '1' WHEN 'APP' THEN 'COMPANYID' ELSE ' passport ' END"


def _typed_accounts(spark, sf_dir):
    acc = fixture(spark, sf_dir, "fx_accounts").select("account", "an_b", F.expr(_ACCOUNT_TYPE).alias("account_type"))
    ids = I.validate_identities(fixture(spark, sf_dir, "fx_identities"), "id_raw", as_of=AS_OF)
    return acc.join(ids.select(F.col("rec").alias("account"), "id_type"), "account")


@query(
    "derive_customer_type",
    oracle=f"""WITH v AS ({_validate_sql()}), {_ACC},
t AS (SELECT a.account, a.an_b, {_ACCOUNT_TYPE} AS account_type, v.id_type FROM fx_accounts a JOIN v ON a.account = v.rec),
u AS (SELECT *, coalesce(id_type, '') AS idt, upper(trim(coalesce(account_type, ''))) AS acct_t,
        upper(trim(coalesce(an_b, ''))) AS anb FROM t)
SELECT account, an_b, account_type, id_type,
  CASE WHEN anb = 'BUSINESS' THEN 'Enterprise'
       WHEN acct_t IN ('1', 'SOUTHAFRICANID', '2', 'PASSPORT', '5', 'TEMPRESIDENCE', 'OTHERS', 'EMIS') THEN 'Consumer'
       WHEN acct_t IN ('3', 'COMPANYID', 'BUSINESSREGNUM') THEN 'Enterprise'
       WHEN idt IN ('N', 'n', 'I', 'i') THEN 'Consumer' WHEN idt IN ('B', 'b') THEN 'Enterprise' ELSE 'Unknown' END AS customer_typ,
  CAST(CASE WHEN idt IN ('B', 'b') THEN 1 END AS INTEGER) AS trigger_idvalidate,
  CAST(CASE WHEN acct_t IN ('3', 'COMPANYID', 'BUSINESSREGNUM') THEN 1 END AS INTEGER) AS trigger_account_type,
  CAST(CASE WHEN anb = 'BUSINESS' THEN 1 END AS INTEGER) AS trigger_analysis_b,
  CASE WHEN upper(account_type) IN ('1', 'SOUTHAFRICANID', '2', 'PASSPORT', '5', 'TEMPRESIDENCE') THEN 'Consumer'
       WHEN upper(account_type) IN ('3', 'COMPANYID', 'BUSINESSREGNUM') THEN 'Enterprise'
       WHEN upper(idt) IN ('N', 'I') THEN 'Consumer' WHEN upper(idt) = 'B' THEN 'Enterprise' ELSE '' END AS customer_typ_v1
FROM u""",
)
def q_derive_customer_type(spark, sf_dir):
    df = _typed_accounts(spark, sf_dir)
    v1 = I.derive_customer_type(df, version=1).select("account", F.col("customer_typ").alias("customer_typ_v1"))
    return I.derive_customer_type(df, analysis_b="an_b").join(v1, "account")


@query(
    "normalise_contacts",
    oracle=f"""WITH {_ACC}, s AS (SELECT account, contact_raw,
      CASE WHEN contact_raw LIKE '%.0' THEN substr(contact_raw, 1, length(contact_raw) - 2) ELSE contact_raw END AS c FROM fx_accounts)
    SELECT account, contact_raw, CASE WHEN c IS NULL OR c IN ('', '.') THEN NULL WHEN length(c) = 9 THEN '0' || c
      WHEN length(c) = 10 AND c LIKE '0%' THEN c WHEN substr(c, 1, 3) = '+27' AND length(c) = 12 THEN '0' || substr(c, 4)
      WHEN substr(c, 1, 2) = '27' AND length(c) = 11 THEN '0' || substr(c, 3) END AS contact_number FROM s""",
)
def q_normalise_contacts(spark, sf_dir):
    return I.normalise_contacts(fixture(spark, sf_dir, "fx_accounts").select("account", "contact_raw"))
