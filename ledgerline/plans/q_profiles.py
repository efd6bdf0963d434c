"""Profile queries over ``fx_profiles``, ``fx_accounts`` and ``fx_contracts``."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.operators import behaviour as B
from ledgerline.operators import profiles as P
from ledgerline.plans.catalog import query
from ledgerline.sources.fixtures import fixture, fixture_cte

_PROF, _ACC, _CON = fixture_cte("fx_profiles"), fixture_cte("fx_accounts"), fixture_cte("fx_contracts")

# ---- SQL pieces for the oracles (DuckDB dialect)
MOB_SQL = ("array_to_string(list_transform(range(0, 60), lambda i: CASE WHEN mob_start - i < 0 THEN '..' "
           "ELSE lpad(CAST(least(mob_start - i, 99) AS VARCHAR), 2, '0') END), '|') || '|'")


def norm_sql(p: str, elem: int, chunk: int, full: int) -> str:
    miss = "." * elem if elem <= 1 else "." * elem + "|"
    allm = "." * full if elem <= 1 else miss * 60
    return (f"CASE WHEN {p} IS NULL OR length({p}) = 0 THEN '{allm}' "
            f"WHEN length({p}) < {full} THEN {p} || repeat('{miss}', CAST(floor(({full} - length({p})) / {chunk}) AS INTEGER)) "
            f"WHEN length({p}) = {full} THEN {p} ELSE substr({p}, 1, {full}) END")


# variable-length inputs derived from the profiles: empty, short, partial chunk, exact, too long
_VAR = f"""WITH {_PROF}, v AS (
  SELECT account, pit, substr(dlq_profile || gbipx_profile, 1, CAST(account % 130 AS INTEGER)) AS dlq_var,
         substr({MOB_SQL}, 1, CAST(account % 200 AS INTEGER)) AS mob_var
  FROM fx_profiles)"""


def _var(spark, sf_dir):
    prof = fixture(spark, sf_dir, "fx_profiles")
    return prof.select(
        "account",
        "pit",
        F.substr(F.concat("dlq_profile", "gbipx_profile"), F.lit(1), (F.col("account") % 130).cast("int")).alias("dlq_var"),
        F.substr(P.generate_mob_profile("mob_start"), F.lit(1), (F.col("account") % 200).cast("int")).alias("mob_var"),
    )


@query("normalise_profiles", oracle=_VAR + f"\nSELECT account, pit, {norm_sql('dlq_var', 1, 1, 60)} AS dlq_var, "
       f"{norm_sql('mob_var', 2, 3, 180)} AS mob_var FROM v")
def q_normalise_profiles(spark, sf_dir):
    return P.normalise_profiles(_var(spark, sf_dir), {"dlq_var": "DLQ", "mob_var": "MOB"})


@query("shift_profiles", oracle=_VAR + "\nSELECT account, pit, dlq_var, mob_var, "
       f"{norm_sql('substr(dlq_var, 2)', 1, 1, 60)} AS dlq_var_prev, {norm_sql('substr(mob_var, 4)', 2, 3, 180)} AS mob_var_prev FROM v")
def q_shift_profiles(spark, sf_dir):
    return P.shift_profiles(_var(spark, sf_dir), {"dlq_var": "DLQ", "mob_var": "MOB"})


@query(
    "extract_profile_element",
    oracle=f"""WITH {_PROF}, m AS (SELECT account, pit, dlq_profile, {MOB_SQL} AS mob_profile FROM fx_profiles)
    SELECT account, pit, dlq_profile, mob_profile,
      CASE WHEN instr(substr(dlq_profile, 1, 1), '.') > 0 THEN NULL ELSE substr(dlq_profile, 1, 1) END AS dlq_profile_m01,
      CASE WHEN instr(substr(mob_profile, 1, 2), '.') > 0 THEN NULL ELSE substr(mob_profile, 1, 2) END AS mob_profile_m01,
      CASE WHEN instr(substr(dlq_profile, pit, 1), '.') > 0 THEN NULL ELSE substr(dlq_profile, pit, 1) END AS dlq_at_pit
    FROM m""",
)
def q_extract_profile_element(spark, sf_dir):
    prof = fixture(spark, sf_dir, "fx_profiles").select("account", "pit", "dlq_profile", P.generate_mob_profile("mob_start").alias("mob_profile"))
    out = P.extract_profile_element(prof, {"dlq_profile": "DLQ", "mob_profile": "MOB"})
    return out.withColumn("dlq_at_pit", P.element_at_month("dlq_profile", 1, pipe_present=False, point_in_time=F.col("pit"), fixed=True))


@query("generate_mob_profiles", oracle=f"WITH {_PROF} SELECT account, mob_start, {MOB_SQL} AS mob_profile FROM fx_profiles")
def q_generate_mob_profiles(spark, sf_dir):
    return P.generate_mob_profiles(fixture(spark, sf_dir, "fx_profiles").select("account", "mob_start"), "mob_start")


_MASKED = norm_sql(f"substr({MOB_SQL}, 1, CAST(3 * (account % 61) AS INTEGER))", 2, 3, 180)


@query(
    "derive_first_mob",
    oracle=f"""WITH {_PROF}, m AS (SELECT account, {_MASKED} AS mob_profile FROM fx_profiles),
    c AS (SELECT account, mob_profile, list_reverse(list_transform(string_split(substr(mob_profile, 1, length(mob_profile) - 1), '|'),
            lambda x: CASE WHEN instr(x, '.') > 0 THEN NULL ELSE CAST(x AS INTEGER) END)) AS r FROM m),
    f AS (SELECT account, mob_profile, list_filter(list_transform(r, lambda v, i: {{'v': v, 'i': i - 1}}),
            lambda s: s.v IS NOT NULL AND s.v <> 0) AS hits FROM c)
    SELECT account, mob_profile, CAST(hits[1].v + 59 - hits[1].i AS VARCHAR) AS first_mob FROM f""",
)
def q_derive_first_mob(spark, sf_dir):
    prof = fixture(spark, sf_dir, "fx_profiles")
    masked = P.normalise(F.substr(P.generate_mob_profile("mob_start"), F.lit(1), (F.col("account") % 61 * 3).cast("int")), "MOB")
    return P.derive_first_mob_col(prof.select("account", masked.alias("mob_profile")), "mob_profile")


@query(
    "mob_category",
    oracle=f"""WITH {_PROF}, m AS (SELECT account, substr({MOB_SQL}, 1, 2) AS e FROM fx_profiles)
    SELECT account, e AS account_mob, CASE WHEN e = '..' THEN 1 END AS mob_missing,
      CASE WHEN e <> '..' AND e IN ('00','01','02','03','04','05') THEN 1 END AS mob_immature,
      CASE WHEN NOT (e = '..' OR e IN ('00','01','02','03','04','05')) THEN 1 END AS mob_established FROM m""",
)
def q_mob_category(spark, sf_dir):
    prof = fixture(spark, sf_dir, "fx_profiles").select("account", P.generate_mob_profile("mob_start").alias("mob_profile"))
    return P.mob_categories(prof, "mob_profile").drop("mob_profile")


def _enc_sql(v: str, width: int) -> str:
    lo, hi = (-9999, 99999) if width == 5 else (-9, 99)
    return f"coalesce(printf('%0{width}d', least(greatest({v}, {lo}), {hi})), '{'.' * width}')"


@query(
    "encode_profile_values",
    oracle=f"""WITH {_ACC}, s AS (SELECT *, CASE WHEN regexp_matches(trim(contact_raw), '^[+-]?[0-9]+$')
        THEN TRY_CAST(trim(contact_raw) AS BIGINT) END AS contact_num FROM fx_accounts)
    SELECT account, {_enc_sql('balance', 5)} AS balance_5, {_enc_sql('balance', 2)} AS balance_2,
      {_enc_sql('cd0', 2)} AS cd0_2, {_enc_sql('CAST(trunc(balance / 7e0) AS BIGINT)', 5)} AS balance_div7_5,
      {_enc_sql('contact_num', 5)} AS contact_5, coalesce(CAST(cd1 AS VARCHAR), '.') AS cd1_1,
      CAST(trunc(balance / 100e0) AS BIGINT) AS balance_units, CAST(round_even(balance / 1000e0, 0) AS INTEGER) AS balance_k
    FROM s""",
)
def q_encode_profile_values(spark, sf_dir):
    acc = fixture(spark, sf_dir, "fx_accounts")
    return acc.select(
        "account",
        P.encode_value("balance", 5).alias("balance_5"),
        P.encode_value("balance", 2).alias("balance_2"),
        P.encode_value("cd0", 2).alias("cd0_2"),
        P.encode_value(F.col("balance") / 7.0, 5, dtype="double").alias("balance_div7_5"),
        P.encode_value("contact_raw", 5, dtype="string").alias("contact_5"),
        P.encode_value("cd1", 1).alias("cd1_1"),
        P.cents_to_units("balance").alias("balance_units"),
        P.round_half_even_int(F.col("balance") / 1000.0).alias("balance_k"),
    )


@query(
    "profile_integrity",
    oracle=_VAR + """
SELECT account, pit, dlq_var, mob_var,
  CAST(length(dlq_var) - length(replace(dlq_var, '|', '')) AS INTEGER) AS dlq_var_pipes, CAST(length(dlq_var) AS INTEGER) AS dlq_var_length,
  CASE WHEN length(dlq_var) = 60 AND length(dlq_var) - length(replace(dlq_var, '|', '')) = 0 THEN 1 END AS dlq_var_ok,
  CAST(length(mob_var) - length(replace(mob_var, '|', '')) AS INTEGER) AS mob_var_pipes, CAST(length(mob_var) AS INTEGER) AS mob_var_length,
  CASE WHEN length(mob_var) = 180 AND length(mob_var) - length(replace(mob_var, '|', '')) = 60 THEN 1 END AS mob_var_ok
FROM v""",
)
def q_profile_integrity(spark, sf_dir):
    return P.profile_integrity(_var(spark, sf_dir), {"dlq_var": "DLQ", "mob_var": "MOB"})


AGEING_SQL = """CASE WHEN cd4 > 0 THEN '4' WHEN cd3 > 0 AND cd4 <= 0 THEN '3' WHEN cd2 > 0 AND cd4 + cd3 <= 0 THEN '2'
  WHEN cd1 > 0 AND cd4 + cd3 + cd2 <= 0 THEN '1' WHEN cd0 > 0 AND cd4 + cd3 + cd2 + cd1 <= 0 THEN '0'
  WHEN balance < 0 THEN 'C' WHEN balance = 0 THEN 'P' ELSE '-' END"""


@query(
    "build_profiles",
    oracle=f"""WITH {_ACC}, {_PROF}, j AS (SELECT a.account, {AGEING_SQL} AS ageing_attribute, p.age_profile
      FROM fx_accounts a JOIN fx_profiles p ON a.account = p.account)
    SELECT account, ageing_attribute, {norm_sql("coalesce(ageing_attribute, '.') || coalesce(age_profile, '')", 1, 1, 60)} AS age_profile FROM j""",
)
def q_build_profiles(spark, sf_dir):
    """Monthly roll: this month's ageing attribute in front of last month's ageing profile."""
    acc = fixture(spark, sf_dir, "fx_accounts")
    acc = acc.select("account", B.ageing_attribute("balance", "cd0", "cd1", "cd2", "cd3", "cd4").alias("ageing_attribute"))
    prof = fixture(spark, sf_dir, "fx_profiles").select("account", "age_profile")
    return P.build_profiles(acc.join(prof, "account"), "age_profile", "ageing_attribute", "AGE")


@query(
    "flag_simultaneous",
    oracle=f"""WITH {_CON} SELECT contract_id, CASE WHEN renewal = 1 AND started_0 = 1 THEN 1 END AS renewed_and_started,
      CASE WHEN bar_outgoing = 1 AND months_24 = 1 THEN 1 END AS barred_24m,
      CASE WHEN act_mob = 3 AND act_mob = 3 THEN 1 END AS mob_3 FROM fx_contracts""",
)
def q_flag_simultaneous(spark, sf_dir):
    con = fixture(spark, sf_dir, "fx_contracts")
    return con.select(
        "contract_id",
        P.flag_simultaneous("renewal", "started_0").alias("renewed_and_started"),
        P.flag_simultaneous("bar_outgoing", "months_24").alias("barred_24m"),
        P.flag_simultaneous("act_mob", "act_mob", 3).alias("mob_3"),
    )
