"""Session helpers.

Library operators never create or configure a session; they take DataFrames
and return DataFrames (``llm.common.small_batches`` lowers one setting while a
table is written, and puts it back).  These helpers exist for tests, the bench and the
driver contract only.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every local run uses.  On a cluster these come from the job
# submission instead; nothing here is required for correctness except UTC.
LOCAL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.caseSensitive": "false",
    # Rule ladders compile to long generated methods; let the JIT compile them
    # instead of interpreting them (set the same on executors of a cluster).
    "spark.driver.extraJavaOptions": "-XX:-DontCompileHugeMethods",
    # A fused stage whose generated method passes the JIT's size limit runs as
    # separate (split, compiled) projections instead of one interpreted method.
    "spark.sql.codegen.hugeMethodLimit": os.environ.get("LEDGERLINE_HUGE_METHOD_LIMIT", "8000"),
    "spark.executor.extraJavaOptions": "-XX:-DontCompileHugeMethods",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "ledgerline") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in LOCAL_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("LEDGERLINE_DRIVER_MEMORY", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    A session on one machine (``local`` master, as in tests and the bench) that names none gets a fresh scratch
    folder; on a cluster the setting must name shared storage, and without it this raises.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(current)
        return current
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="ledgerline-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for written tables under the shared checkpoint location.

    Always below ``spark.checkpoint.dir`` (shared storage on a cluster), never
    a machine-local temporary folder unless the session itself points there.
    """
    import uuid

    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}-{uuid.uuid4().hex[:12]}"
