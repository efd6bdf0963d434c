"""Source/sink queries: each writes derived data to a fresh folder under the
shared checkpoint location and returns the table read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.operators import behaviour as B
from ledgerline.plans.catalog import query
from ledgerline.plans.q_behaviour import delinquency_sql
from ledgerline.session import scratch_dir
from ledgerline.sources import io_ops as IO
from ledgerline.sources import published
from ledgerline.sources.fixtures import fixture, fixture_cte

_ACC, _APPS, _TXN = fixture_cte("fx_accounts"), fixture_cte("fx_applications"), fixture_cte("fx_transactions")


@query(
    "read_source",
    oracle="SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders WHERE o_orderstatus = 'F'",
)
def q_read_source(spark, sf_dir):
    return IO.read_source(
        spark, "parquet", f"{sf_dir.rstrip('/')}/orders.parquet",
        query="SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM {src} WHERE o_orderstatus = 'F'",
    )


_DLQ_COLS = "account, ageing_attribute, gbipx_attribute, delinquency_attribute, delinquency_trigger"


@query("write_overwrite", oracle=f"WITH {_ACC} SELECT {_DLQ_COLS} FROM {delinquency_sql('fx_accounts')}")
def q_write_overwrite(spark, sf_dir):
    target = scratch_dir(spark, "delinquency")
    data = B.delinquency_attributes(fixture(spark, sf_dir, "fx_accounts")).select(*[c.strip() for c in _DLQ_COLS.split(",")])
    IO.write_overwrite(data.limit(0), target)  # an existing table is replaced, not added to
    IO.write_overwrite(data, target)
    return spark.read.parquet(target)


@query("write_append", oracle=f"WITH {_APPS} SELECT app_record_number, idkey, app_date, decision_outcome FROM fx_applications")
def q_write_append(spark, sf_dir):
    target = scratch_dir(spark, "applications")
    apps = fixture(spark, sf_dir, "fx_applications").select("app_record_number", "idkey", "app_date", "decision_outcome")
    IO.write_overwrite(apps.filter(F.col("decision_outcome") == "APPROVE"), target)
    IO.write_append(apps.filter((F.col("decision_outcome") != "APPROVE") | F.col("decision_outcome").isNull()), target)
    return spark.read.parquet(target)


@query(
    "replace_partition",
    oracle=f"""WITH {_APPS} SELECT app_record_number, app_month, gross_income,
      CASE WHEN app_month >= 199700 THEN 2 ELSE 1 END AS load_version FROM fx_applications""",
)
def q_replace_partition(spark, sf_dir):
    """Load every month, then reload the months from 1997 on twice (idempotent): those partitions carry version 2."""
    target = scratch_dir(spark, "applications_by_month")
    apps = fixture(spark, sf_dir, "fx_applications").select("app_record_number", "app_month", "gross_income")
    published.replace_partitions(apps.withColumn("load_version", F.lit(1)), target, "app_month")
    recent = apps.filter(F.col("app_month") >= 199700).withColumn("load_version", F.lit(2))
    published.replace_partitions(recent, target, "app_month")
    published.replace_partitions(recent, target, "app_month")
    return published.read(spark, target).select("app_record_number", "app_month", "gross_income", "load_version")


@query(
    "export_csv_gz",
    oracle=f"""WITH {_TXN} SELECT account, CAST(count(*) AS BIGINT) AS n_txn, CAST(sum(amt) AS BIGINT) AS amt_total
      FROM fx_transactions GROUP BY account""",
)
def q_export_csv_gz(spark, sf_dir):
    base = scratch_dir(spark, "exports")
    txn = fixture(spark, sf_dir, "fx_transactions")
    summary = txn.groupBy("account").agg(F.count(F.lit(1)).alias("n_txn"), F.sum("amt").cast("bigint").alias("amt_total"))
    path = IO.export_csv_gz(summary, base, "transactions_summary.csv.gz", single=True)
    return spark.read.schema(summary.schema).option("header", True).option("sep", "|").csv(path)
