"""Test inputs as SQL over the driver tables (text of FIXTURES.md).

Each fixture is plain SQL in the dialect subset that Spark 4.1 and DuckDB
share.  Table names are ``{placeholders}``: Spark binds them to DataFrames
read from the given folder (``spark.sql(text, customer=df)``), the DuckDB
oracle binds them to its pre-registered views.  Fixtures grow with the
tables they read; none holds made-up rows.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

FIXTURE_SQL: dict[str, str] = {}

FIXTURE_SQL["fx_accounts"] = """
SELECT c_custkey AS account,
       CAST(floor(c_acctbal) AS BIGINT) AS balance,
       CAST((c_custkey * 7) % 3 AS INT) * 120 - 60 AS cd0,
       CASE WHEN c_custkey % 4 = 1 THEN 90 ELSE 0 END AS cd1,
       CASE WHEN c_custkey % 6 = 2 THEN 80 ELSE 0 END AS cd2,
       CASE WHEN c_custkey % 9 = 4 THEN 70 ELSE 0 END AS cd3,
       CASE WHEN c_custkey % 11 = 5 THEN 60 ELSE 0 END AS cd4,
       CASE WHEN c_custkey % 13 = 0 THEN 'SUSPENDED' WHEN c_custkey % 13 = 1 THEN 'BARRING' ELSE 'ACTIVE' END AS cust_status,
       CASE WHEN c_custkey % 17 = 0 THEN 'Deceased ' WHEN c_custkey % 17 = 1 THEN 'FRAUD' WHEN c_custkey % 17 = 2 THEN 'Debt Review'
            WHEN c_custkey % 17 = 3 THEN 'NIMBLE' WHEN c_custkey % 17 = 4 THEN '.' ELSE NULL END AS cred_ctrl_group,
       CASE WHEN c_custkey % 19 = 0 THEN 'ADMIN' WHEN c_custkey % 19 = 1 THEN 'Debt Sale' ELSE '' END AS sub_ctrl_group,
       CASE WHEN c_custkey % 5 = 0 THEN 'CURRENT' WHEN c_custkey % 5 = 1 THEN 'COLLECTION' WHEN c_custkey % 5 = 2 THEN 'PREWRITEOF'
            WHEN c_custkey % 5 = 3 THEN 'EXT ALLOC' ELSE NULL END AS an_a,
       CASE WHEN c_custkey % 23 = 0 THEN 'BUSINESS' WHEN c_custkey % 23 = 1 THEN 'PRE_LEGAL' WHEN c_custkey % 23 = 2 THEN 'ARCHIVED' ELSE NULL END AS an_b,
       CASE WHEN c_custkey % 3 = 0 THEN 'NEW' WHEN c_custkey % 31 = 1 THEN 'APP' ELSE 'EST' END AS account_cat,
       CASE WHEN c_custkey % 2 = 0 THEN '27' ELSE '+27' END || CAST(821000000 + c_custkey AS VARCHAR(12)) AS contact_raw
FROM {customer}
"""

FIXTURE_SQL["fx_profiles"] = """
SELECT c_custkey AS account,
       CAST(1 + c_custkey % 24 AS INT) AS pit,
       substr(repeat('0012C0P1023.40A0', 6), CAST(1 + c_custkey % 16 AS INT), 60) AS dlq_profile,
       substr(repeat('GGGBGGPGGBB.BGBG', 6), CAST(1 + c_custkey % 16 AS INT), 60) AS gbipx_profile,
       substr(repeat('0012C0P1023.40-0', 6), CAST(1 + c_custkey % 16 AS INT), 60) AS age_profile,
       CAST(c_custkey % 75 AS INT) - 5 AS mob_start
FROM {customer}
"""

FIXTURE_SQL["fx_identities"] = """
SELECT c_custkey AS rec,
  CASE c_custkey % 8
    WHEN 0 THEN right('0' || CAST(40 + c_custkey % 60 AS VARCHAR(4)), 2) || right('0' || CAST(1 + c_custkey % 13 AS VARCHAR(4)), 2)
                || right('0' || CAST(1 + c_custkey % 31 AS VARCHAR(4)), 2) || CAST(1000 + c_custkey % 9000 AS VARCHAR(5)) || '08' || CAST(c_custkey % 10 AS VARCHAR(2))
    WHEN 1 THEN CAST(1990 + c_custkey % 30 AS VARCHAR(5)) || '/' || right('000000' || CAST(c_custkey AS VARCHAR(12)), 6) || '/' || right('0' || CAST(c_custkey % 27 AS VARCHAR(4)), 2)
    WHEN 2 THEN CAST(1990 + c_custkey % 30 AS VARCHAR(5)) || right('000000' || CAST(c_custkey AS VARCHAR(12)), 6) || '07'
    WHEN 3 THEN 'IT' || CAST(c_custkey AS VARCHAR(12)) || '/99'
    WHEN 4 THEN '0000000000000'
    WHEN 5 THEN CAST(c_custkey AS VARCHAR(12))
    WHEN 6 THEN 'CK98/' || right('000000' || CAST(c_custkey AS VARCHAR(12)), 6) || '/23'
    ELSE NULL END AS id_raw
FROM {customer}
"""

FIXTURE_SQL["fx_transactions"] = """
SELECT l_orderkey * 10 + l_linenumber AS txn_id, l_orderkey AS account,
       CASE WHEN l_linenumber % 2 = 0 THEN 'Cell C' ELSE 'CEC' END AS src,
       CASE WHEN l_returnflag = 'R' THEN 'CR' WHEN l_returnflag = 'A' THEN 'd r' ELSE NULL END AS tdc,
       CASE WHEN l_linestatus = 'F' THEN -1 ELSE 1 END * CAST(floor(l_extendedprice) AS BIGINT) AS amt,
       CASE l_partkey % 8 WHEN 0 THEN 'BLL-1' WHEN 1 THEN 'pau2' WHEN 2 THEN 'POB' WHEN 3 THEN 'CSH9' WHEN 4 THEN 'ADJ' WHEN 5 THEN 'INV'
            WHEN 6 THEN '' ELSE 'ZZZ' END AS txn,
       CASE l_suppkey % 5 WHEN 0 THEN 'SCA001' WHEN 1 THEN 'P-77' WHEN 2 THEN 'SCJ2' WHEN 3 THEN '12' ELSE NULL END AS rec,
       CASE l_suppkey % 4 WHEN 0 THEN 'cash dep' WHEN 1 THEN 'EasyPay' WHEN 2 THEN 'credit card' ELSE NULL END AS rem,
       CASE l_suppkey % 6 WHEN 0 THEN 'Capitec Bank' WHEN 1 THEN 'First National' WHEN 2 THEN 'unknown' WHEN 3 THEN 'Zeta 9' WHEN 4 THEN 'A' ELSE NULL END AS res
FROM {lineitem}
"""

FIXTURE_SQL["fx_bureau"] = """
SELECT c_custkey AS applicant,
       CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE CAST((c_custkey * 37) % 125 AS INT) - 10 END AS num0delq1y,
       CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE CAST((c_custkey * 53) % 115 AS INT) - 10 END AS percpay2y,
       CASE WHEN c_custkey % 12 = 0 THEN NULL ELSE CAST((c_custkey * 29) % 150 AS INT) - 10 END AS avgmob,
       CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE CAST((c_custkey * 31) % 110 AS INT) - 10 END AS perc0delq90,
       CASE WHEN c_custkey % 14 = 0 THEN NULL ELSE CAST((c_custkey * 41) % 16 AS INT) - 8 END AS trades180,
       CASE WHEN c_custkey % 15 = 0 THEN NULL ELSE CAST((c_custkey * 43) % 14 AS INT) - 8 END AS util_lt10,
       CASE WHEN c_custkey % 16 = 0 THEN NULL ELSE CAST((c_custkey * 47) % 110 AS INT) - 10 END AS percutil,
       CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE substr('!$-=.?@0123456789IJLW z', CAST(1 + c_custkey % 23 AS INT), 1) END AS maxdelq
FROM {customer}
"""

FIXTURE_SQL["fx_ecl"] = """
SELECT c_custkey AS account, c_acctbal AS bal_total,
       CASE WHEN c_custkey % 29 = 0 THEN 'X' ELSE 'G' END AS gbx,
       CASE WHEN c_custkey % 13 = 0 THEN 1 ELSE 0 END AS bd_use,
       CASE WHEN c_custkey % 37 = 0 THEN 1 ELSE 0 END AS wof,
       substr('01234CPA', CAST(1 + c_custkey % 8 AS INT), 1) AS dlq,
       CAST(1 + c_custkey % 3 AS INT) AS stage,
       CAST(1 + c_custkey % 8 AS INT) AS non_def_2_c, CAST(c_custkey % 30 AS INT) AS non_def_2_time,
       1e-2 * (1 + c_custkey % 5) AS pd1, 5e-2 * (1 + c_custkey % 6) AS pd2, 1e-1 * (1 + c_custkey % 10) AS pd3,
       9e-1 AS ead, 35e-2 AS lgd_new, 1e-2 * (30 + c_custkey % 50) AS lgd_curve, 105e-2 AS pit_pd, 95e-2 AS pit_lgd,
       CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE CAST(c_custkey % 12 AS INT) END AS ttwo, CAST(c_custkey % 9 AS INT) AS ttd,
       1e-1 AS pwor, 18e-2 AS interest_rate, 100e0 AS bdt_all
FROM {customer}
"""

FIXTURE_SQL["fx_applications"] = """
SELECT o.o_orderkey AS app_record_number, o.o_custkey AS idkey, CAST(o.o_orderdate AS DATE) AS app_date,
       CAST(year(o.o_orderdate) * 100 + month(o.o_orderdate) AS INT) AS app_month,
       CASE substr(o.o_orderpriority, 1, 1) WHEN '1' THEN 'APPROVE' WHEN '2' THEN 'REFER' WHEN '3' THEN 'ARREARS' WHEN '4' THEN 'DECLINE' ELSE 'x' END AS decision_outcome,
       CAST(1 + o.o_orderkey % 9 AS INT) AS risk_grade, CAST(floor(o.o_totalprice) AS BIGINT) AS gross_income,
       CAST(o.o_orderkey % 5 AS INT) AS subscription_limit,
       CASE o.o_orderkey % 7 WHEN 0 THEN 'Own Store' WHEN 1 THEN 'Franchise' WHEN 2 THEN 'Outbound' WHEN 3 THEN 'Inbound' WHEN 4 THEN 'Dealer' WHEN 5 THEN 'Online' ELSE NULL END AS channel,
       CASE o.o_orderkey % 11 WHEN 0 THEN '' WHEN 1 THEN 'IMM MOB 00-05' WHEN 2 THEN 'PUP Paid-Up' WHEN 3 THEN 'CRD Credit Balance' WHEN 4 THEN 'CLR Clear'
            WHEN 5 THEN 'RES Responsible' WHEN 6 THEN 'ERR Erratic' WHEN 7 THEN 'EXT Extended' WHEN 8 THEN 'DBT Doubtful Debt' WHEN 9 THEN 'DIS Distressed' ELSE 'other' END AS customer_state,
       CAST(o.o_orderkey % 40 AS INT) AS time_oldest_trade,
       CASE WHEN o.o_orderkey % 41 = 0 THEN 'Y' ELSE 'N' END AS deceased, CASE WHEN o.o_orderkey % 23 <> 0 THEN CAST(1700 + (o.o_orderkey * 13) % 5000 AS INT) END AS customer_age,
       CASE WHEN o.o_orderkey % 43 = 1 THEN 'Y' ELSE 'N' END AS cst_fraud, CASE WHEN o.o_orderkey % 47 = 2 THEN 'Y' ELSE 'N' END AS cst_sequestration,
       CASE WHEN o.o_orderkey % 53 = 3 THEN 'Y' ELSE 'N' END AS cst_dispute, CASE WHEN o.o_orderkey % 59 = 4 THEN 'Y' END AS cst_emigrated,
       CASE WHEN o.o_orderkey % 61 = 5 THEN 'Y' ELSE 'N' END AS all_notices5years, CASE WHEN o.o_orderkey % 67 = 6 THEN 'Y' END AS cst_debtreviewgranted,
       CASE WHEN o.o_orderkey % 71 < 9 THEN 'Y' ELSE 'N' END AS cst_debtreviewrequested,
       CAST(560 + (o.o_orderkey * 17) % 140 AS INT) AS prism_score, CAST(520 + (o.o_orderkey * 19) % 160 AS INT) AS custom_score,
       CAST((o.o_orderkey * 23) % 100 AS INT) AS perc0delq90, CAST(o.o_orderkey % 6 AS INT) AS numpay90
FROM {orders} o
"""

FIXTURE_SQL["fx_activations"] = """
SELECT l_orderkey AS app_record_number, l_suppkey AS account, l_partkey AS subscriber_number,
       CAST(CASE WHEN l_quantity >= 25 THEN l_shipdate END AS DATE) AS con_start_date, l_linenumber
FROM {lineitem}
"""

FIXTURE_SQL["fx_contracts"] = """
SELECT l_orderkey * 10 + l_linenumber AS contract_id,
       CAST(l_partkey % 7 AS INT) AS act_mob,
       CASE WHEN l_partkey % 5 = 0 THEN 1 END AS renewal, CASE WHEN l_partkey % 6 = 1 THEN 1 END AS started_0,
       CASE WHEN l_partkey % 8 = 2 THEN 1 END AS started_1, CASE WHEN l_partkey % 9 = 3 THEN 1 END AS started_2,
       CASE WHEN l_suppkey % 4 = 0 THEN 1 END AS bar_outgoing, CASE WHEN l_suppkey % 5 = 1 THEN 1 END AS months_24,
       CASE WHEN l_suppkey % 5 = 2 THEN 1 END AS months_12,
       CASE WHEN l_partkey % 11 = 4 THEN 1 END AS months_00, CASE WHEN l_partkey % 13 = 5 THEN 1 END AS months_01,
       CASE WHEN l_partkey % 17 = 6 THEN 1 END AS ended_2, CASE WHEN l_partkey % 19 = 7 THEN 1 END AS ended_1,
       CASE WHEN l_partkey % 23 = 8 THEN 1 END AS ended_0, CASE WHEN l_suppkey % 7 = 3 THEN 1 END AS ending_1,
       CASE WHEN l_suppkey % 7 = 5 THEN 1 END AS ending_2, CASE WHEN l_suppkey % 3 = 1 THEN 1 END AS months_06
FROM {lineitem}
"""

FIXTURE_SQL["fx_activity"] = """
SELECT user_id AS service_number, CAST(ts AS DATE) AS call_begin_date,
       MAX(CASE WHEN event_type IN ('view','click') THEN 1 ELSE 0 END) AS active_data,
       MAX(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS active_voice,
       MAX(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS active_sms, 1 AS active_any
FROM {events} GROUP BY user_id, CAST(ts AS DATE)
"""

FIXTURE_SQL["fx_activity_rows"] = """
SELECT user_id AS service_number, CASE WHEN event_id % 29 = 0 THEN NULL ELSE CAST(ts AS DATE) END AS call_begin_date,
       CASE WHEN event_type IN ('view','click') THEN 1 ELSE 0 END AS active_data, CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS active_voice,
       CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS active_sms, 1 AS active_any
FROM {events}
"""

FIXTURE_SQL["fx_month_states"] = """
SELECT c_custkey AS account,
       CASE WHEN c_custkey % 5 = 1 THEN 'C' WHEN c_custkey % 5 = 2 THEN 'P' ELSE substr('0123401', CAST(1 + c_custkey % 7 AS INT), 1) END AS m1, substr('0012341', CAST(1 + c_custkey % 7 AS INT), 1) AS m2,
       CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE substr('1023400', CAST(1 + c_custkey % 7 AS INT), 1) END AS m3,
       CASE WHEN c_custkey % 12 = 0 THEN 'outside' ELSE substr('2101340', CAST(1 + c_custkey % 7 AS INT), 1) END AS m4
FROM {customer}
"""


TABLES_USED = {
    name: sorted(set(re.findall(r"\{(\w+)\}", sql))) for name, sql in FIXTURE_SQL.items()
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The fixture as a Spark DataFrame over the parquet tables in ``sf_dir``."""
    tables = {t: read_table(spark, sf_dir, t) for t in TABLES_USED[name]}
    return spark.sql(FIXTURE_SQL[name], **tables)


def fixture_cte(name: str, alias: str | None = None) -> str:
    """The fixture as a DuckDB CTE body over the pre-registered views."""
    sql = FIXTURE_SQL[name].format(**{t: t for t in TABLES_USED[name]})
    return f"{alias or name} AS ({sql})"
