"""Tables bucketed and sorted by a key, so that joins on it need no shuffle.

The profiles of all accounts are far larger than one month's rows and are joined with them every month.  Written once by
bucket, they stay where they are: only the month's rows are dealt (when they are written with as many buckets).
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int, dealt: bool = False) -> DataFrame:
    """Write ``df`` as the table ``name`` (files below ``path``), one sorted file a bucket, and return it as read back.

    Rows are dealt by the key first, one task a bucket; ``dealt`` says that they are already, as after a join of equally
    bucketed tables.  There should be so many buckets that one fits a task."""
    rows = df if dealt else df.repartition(buckets, key)
    rows.write.format("parquet").mode("overwrite").option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    return df.sparkSession.table(name)
