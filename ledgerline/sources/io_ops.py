"""Sources and sinks: read a table or query, overwrite, append, replace partitions, export CSV.

Every sink is one DataFrame write (no count() probes, no reading back the
table being overwritten): a partition is replaced with Spark's dynamic
partition overwrite, which rewrites only the partitions present in the
new data and leaves all others untouched.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def read_source(spark: SparkSession, fmt: str, path: str | None = None, options: dict | None = None,
                query: str | None = None, schema=None) -> DataFrame:
    """Load a table through any DataFrame source.

    ``fmt`` is a source name (parquet, orc, csv, jdbc, a warehouse connector
    ...) and ``options`` its options; a connector that runs SQL takes the text
    in its own ``query`` option.  For file sources ``query`` may be SQL over
    ``{src}`` (the loaded files); projections and filters in it reach the scan.
    A ``schema`` skips schema inference.
    """
    reader = spark.read.format(fmt).options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load(path) if path is not None else reader.load()
    return spark.sql(query, src=df) if query else df


def _writer(df: DataFrame, fmt: str, options: dict | None, partition_by: Sequence[str] | None):
    if not partition_by:
        return df.write.format(fmt).options(**(options or {}))
    # Rows of one partition value go to few tasks (AQE splits a hot value and merges small ones),
    # so a partitioned write makes about one file per value instead of one per task and value.
    df = df.hint("rebalance", *partition_by)
    return df.write.format(fmt).options(**(options or {})).partitionBy(*partition_by)


def write_overwrite(df: DataFrame, target: str, fmt: str = "parquet", options: dict | None = None,
                    partition_by: Sequence[str] | None = None) -> None:
    """Replace the whole table (a path, or a table name when ``fmt`` is a connector with ``dbtable``)."""
    _writer(df, fmt, options, partition_by).mode("overwrite").save(target)


def write_append(df: DataFrame, target: str, fmt: str = "parquet", options: dict | None = None,
                 partition_by: Sequence[str] | None = None) -> None:
    _writer(df, fmt, options, partition_by).mode("append").save(target)


def table_exists(spark: SparkSession, target: str) -> bool:
    """Whether a path-based table holds data (a metadata listing on the driver, no job)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(target)
    fs = p.getFileSystem(conf)
    if not fs.exists(p):
        return False
    return any(not s.getPath().getName().startswith(("_", ".")) for s in fs.listStatus(p))


def replace_partition(df: DataFrame, target: str, partition_col: str | Sequence[str], fmt: str = "parquet",
                      options: dict | None = None) -> int:
    """Idempotent load of the partition value(s) in ``df``.

    A missing or empty table is created; otherwise only the partitions whose
    values occur in ``df`` are rewritten (dynamic partition overwrite), all
    others stay as they are.  Running it twice with the same data gives the
    same table as running it once.  Returns 1 when the table existed before.

    The result is a plain partitioned folder; its partitions become visible one
    after the other.  ``published.replace_partitions`` makes all visible at once.
    """
    cols = [partition_col] if isinstance(partition_col, str) else list(partition_col)
    existed = table_exists(df.sparkSession, target)
    opts = dict(options or {})
    opts["partitionOverwriteMode"] = "dynamic"
    _writer(df, fmt, opts, cols).mode("overwrite").save(target)
    return int(existed)


def export_csv_gz(df: DataFrame, fp_base: str, fn: str, sep: str = "|", single: bool = False) -> str:
    """Gzip CSV with a header row, ``|``-delimited, overwriting ``fp_base/fn``.

    The default is a folder, one file with a header per task.  ``single`` makes ``fp_base/fn`` one file, still written by
    many tasks: a gzip file may consist of members, so the tasks' files (without headers) are joined byte by byte, in the
    DataFrame's order, after a member that holds the header.  The driver copies the compressed bytes once, a buffer at a
    time; nothing is formatted, compressed or held there.
    """
    target = f"{fp_base.rstrip('/')}/{fn}"
    writer = df.write.mode("overwrite").option("sep", sep).option("compression", "gzip")
    if not single:
        writer.option("header", True).csv(target)
        return target
    parts = f"{target}.parts-{uuid.uuid4().hex}"
    writer.option("header", False).csv(parts)
    head = f"{target}.head-{uuid.uuid4().hex}"
    empty = df.sparkSession.createDataFrame([tuple(df.columns)], ", ".join(f"c{i} string" for i in range(len(df.columns))))
    empty.coalesce(1).write.option("sep", sep).option("compression", "gzip").csv(head)
    _joined(df.sparkSession, [head, parts], target)
    return target


def _joined(spark: SparkSession, folders: Sequence[str], target: str) -> None:
    """One file of the data files of some folders, in order of folder and name; the folders are removed."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(target).getFileSystem(conf)
    files = []
    for folder in folders:
        held = [s.getPath() for s in fs.listStatus(path(folder)) if not s.getPath().getName().startswith(("_", "."))]
        files += sorted(held, key=lambda p: p.getName())
    whole = path(f"{target}.whole-{uuid.uuid4().hex}")
    out = fs.create(whole, False)
    try:
        for f in files:
            stream = fs.open(f)
            jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, out, 1 << 20, False)
            stream.close()
    finally:
        out.close()
    if fs.exists(path(target)):
        fs.delete(path(target), True)
    fs.rename(whole, path(target))
    for folder in folders:
        fs.delete(path(folder), True)
