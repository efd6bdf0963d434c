"""Partitioned Parquet tables whose loads become visible all at once.

Dynamic partition overwrite renames one partition after the other, so a reader (or a failure) in between sees some partitions
old and some new.  Here a load is staged in a folder of its own and then published by one small file:

* ``data/load=<id>/<column>=<value>/...``: the files of one load, never changed afterwards;
* ``_manifests/<version>``: which load holds each partition of that version, and the schema.  Readers take the highest
  version; the file is written under a temporary name and renamed where no file of that name may exist.

Publishing compares, then swaps: the new manifest is the latest one with the load's partitions replaced, under the next
number.  If another load took that number first, the rename fails and the manifest is built anew on what is there now, so
loads of different partitions both count and of loads of one partition the later one.  The rename must be exclusive, as on
HDFS and local disks; object stores need a committer that offers it.  The driver handles one line a partition, never rows.

Defined cases: rows of a NULL partition value form a partition; an empty load publishes no partition (on a missing table, an
empty table); a load whose columns or types differ from the table's raises.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType


def _fs(spark: SparkSession, target: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _path(spark: SparkSession, *parts: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/".join(parts))


def _names(spark: SparkSession, folder: str) -> list[str]:
    fs, path = _fs(spark, folder), _path(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []


def _latest(spark: SparkSession, target: str) -> tuple[int, dict | None]:
    """(number, manifest) of the version that readers see; (0, None) if nothing was published."""
    versions = [n for n in _names(spark, f"{target}/_manifests") if n.isdigit()]
    if not versions:
        return 0, None
    jvm = spark.sparkContext._jvm
    stream = _fs(spark, target).open(_path(spark, target, "_manifests", versions[-1]))
    try:
        return int(versions[-1]), json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _swap(spark: SparkSession, target: str, version: int, manifest: dict) -> bool:
    """Make the manifest this version, unless there is one; whether it was made."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    name = _path(spark, target, "_manifests", f"{version:012d}")
    staged = _path(spark, target, "_manifests", f".{uuid.uuid4().hex}")
    out = _fs(spark, target).create(staged, False)
    out.write(bytearray(json.dumps(manifest).encode()))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(name.toUri(), conf)
    none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(staged, name, none)
        return True
    except Exception as e:
        if "FileAlreadyExists" not in str(e):
            raise
        _fs(spark, target).delete(staged, False)
        return False


def _partitions(spark: SparkSession, folder: str, depth: int) -> list[str]:
    """The partition folders (``a=1/b=2``) below a load's folder."""
    found = [""]
    for _ in range(depth):
        found = [f"{p}/{n}" if p else n for p in found for n in _names(spark, f"{folder}/{p}") if "=" in n]
    return found


def stage(df: DataFrame, target: str, partition_by: Sequence[str]) -> str:
    """Write the files of a load, seen by nobody yet; returns its id."""
    load = uuid.uuid4().hex
    # rows of one partition value go to few tasks: AQE splits a hot value and merges small ones
    df.hint("rebalance", *partition_by).write.partitionBy(*partition_by).parquet(f"{target}/data/load={load}")
    return load


def publish(spark: SparkSession, target: str, load: str, schema: StructType, partition_by: Sequence[str], most_tries: int = 100) -> int:
    """Make a staged load visible, all its partitions at once; returns the version before (0: there was no table)."""
    own = _partitions(spark, f"{target}/data/load={load}", len(partition_by))
    shape = {"partition_by": list(partition_by), "schema": StructType([StructField(f.name, f.dataType) for f in schema]).jsonValue()}
    for _ in range(most_tries):
        version, now = _latest(spark, target)
        if now and {k: now[k] for k in shape} != shape:
            raise ValueError(f"the load's columns are not those of {target}")
        held = {p: at for p, at in (now["partitions"] if now else {}).items()}
        held.update(dict.fromkeys(own, load))
        if _swap(spark, target, version + 1, {**shape, "partitions": held}):
            return version
    raise RuntimeError(f"{target}: other loads were published first, {most_tries} times")


def replace_partitions(df: DataFrame, target: str, partition_by: str | Sequence[str]) -> int:
    """Idempotent load of the partitions that occur in ``df``; returns 1 when the table existed before."""
    cols = [partition_by] if isinstance(partition_by, str) else list(partition_by)
    ordered = [c for c in df.columns if c not in cols] + cols
    df = df.select(*[f"`{c}`" for c in ordered])
    return int(publish(df.sparkSession, target, stage(df, target, cols), df.schema, cols) > 0)


def read(spark: SparkSession, target: str, version: int | None = None) -> DataFrame:
    """The latest published version (or an earlier one); filters on partition columns prune folders."""
    latest, manifest = _latest(spark, target)
    if manifest is None:
        raise FileNotFoundError(f"nothing was published at {target}")
    if version is not None and version != latest:
        stream = _fs(spark, target).open(_path(spark, target, "_manifests", f"{version:012d}"))
        manifest = json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        stream.close()
    schema = StructType.fromJson(manifest["schema"])
    if not manifest["partitions"]:
        return spark.createDataFrame([], schema)
    paths = [f"{target}/data/load={load}/{p}" for p, load in sorted(manifest["partitions"].items())]
    files = StructType([*schema.fields, StructField("load", StringType())])
    return spark.read.schema(files).option("basePath", f"{target}/data").parquet(*paths).select(*[f"`{c}`" for c in schema.names])


def expire(spark: SparkSession, target: str, keep: int = 2) -> list[str]:
    """Remove the manifests before the last ``keep`` and the loads that only they, or none, name; returns those loads.

    Staged loads that are not published yet look the same as abandoned ones: run it while nothing loads."""
    versions = [int(n) for n in _names(spark, f"{target}/_manifests") if n.isdigit()]
    kept = set()
    for v in versions[-keep:]:
        stream = _fs(spark, target).open(_path(spark, target, "_manifests", f"{v:012d}"))
        kept |= set(json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))["partitions"].values())
        stream.close()
    for v in versions[:-keep]:
        _fs(spark, target).delete(_path(spark, target, "_manifests", f"{v:012d}"), False)
    gone = [n.removeprefix("load=") for n in _names(spark, f"{target}/data") if n.startswith("load=") and n.removeprefix("load=") not in kept]
    for load in gone:
        _fs(spark, target).delete(_path(spark, target, "data", f"load={load}"), True)
    return gone
