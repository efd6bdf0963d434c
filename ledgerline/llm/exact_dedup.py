"""Exact deduplication by an extendible-hash index on shared files (DataFrame functions only).

Texts are equal when identical after lower-casing A-Z; a null text is the empty text.

* Key: 64-bit xxhash64 of the normalised text.  The directory starts at depth 0 and doubles until every
  bucket holds at most ``capacity`` distinct keys (``MAX_DEPTH`` bits at the most): a bucket of local depth d
  is the d-bit key prefix whose own count fits while its parent's did not; a directory slot is a prefix of the
  global depth and points to the bucket that covers it.  Beyond 2**MAX_DEPTH times ``capacity`` distinct keys (8.6e9 by
  default) buckets grow past ``capacity``; nothing else changes.  Copies of one text are one key, so a hot text never
  makes a bucket overfull.
* Insertion compares bytes: rows are grouped by (key, normalised text), with map-side pre-aggregation, so a
  text that holds a third of all rows is shuffled once per task, and two texts with one key stay apart.
* Owner tasks: each bucket (a key range) goes to one task, which chains the texts of one key in order of their
  digest and writes its index file below ``spark.checkpoint.dir``.
* Probe: every row goes from its key's slot to the bucket, and there down the key's chain by its digest; only ids and
  digests are shuffled.

Defined cases: null ``doc_id`` counts below every other id; of rows equal in id and text exactly one stays;
an empty table gives no rows; other columns of the input are ignored by ``dedup_index`` and kept by ``keep_one``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ledgerline.llm.common import lowered, text_or_empty, written

MAX_DEPTH = 20


def _keyed(docs: DataFrame) -> DataFrame:
    norm = lowered(text_or_empty())
    return docs.select("doc_id", norm.alias("norm")).withColumn("key", F.xxhash64("norm"))


def _prefix(depth) -> F.Column:
    """The first ``depth`` bits of the key (0 for depth 0)."""
    return F.expr(f"CASE WHEN {depth} = 0 THEN 0L ELSE shiftrightunsigned(key, 64 - {depth}) END")


def directory(keys: DataFrame, capacity: int) -> tuple[DataFrame, int]:
    """(slots, global depth): one row (slot, bucket, local_depth) per directory slot.

    ``keys`` holds distinct keys.  Counts at all depths come from one aggregate of at most 2**MAX_DEPTH leaf counts.
    """
    leaf = keys.groupBy(_prefix(MAX_DEPTH).alias("leaf")).agg(F.count(F.lit(1)).alias("n"))
    nodes = (leaf.select("n", "leaf", F.explode(F.sequence(F.lit(0), F.lit(MAX_DEPTH))).alias("depth"))
             .groupBy("depth", F.expr(f"shiftright(leaf, {MAX_DEPTH} - depth)").alias("prefix"))
             .agg(F.sum("n").alias("n")))
    full = nodes.filter(F.col("n") > capacity).select(F.col("depth").alias("up_depth"), F.col("prefix").alias("up_prefix"))
    buckets = (nodes.filter((F.col("n") <= capacity) | (F.col("depth") == MAX_DEPTH))
               .join(full, (F.col("up_depth") == F.col("depth") - 1)
                     & (F.col("up_prefix") == F.shiftright("prefix", 1)), "left")
               .filter(F.col("up_depth").isNotNull() | (F.col("depth") == 0))
               .select(F.col("depth").alias("local_depth"), "prefix"))
    buckets = written(keys.sparkSession, buckets, "hash-buckets")
    depth = int(buckets.agg(F.max("local_depth")).first()[0] or 0)
    width = F.expr(f"shiftleft(1L, {depth} - local_depth)")
    slots = buckets.select(
        "local_depth", F.concat_ws("/", F.col("local_depth"), F.col("prefix")).alias("bucket"),
        F.explode(F.sequence(F.col("prefix") * width, (F.col("prefix") + 1) * width - 1)).alias("slot"))
    return slots, depth


def build_index(spark: SparkSession, docs: DataFrame, capacity: int = 8192) -> tuple[DataFrame, DataFrame, int]:
    """Write the index; returns its files (bucket, local_depth, key, chain, sha, keep_id, group_size), the directory's slots
    and its depth."""
    keyed = _keyed(docs)
    slots, depth = directory(keyed.select("key").distinct(), capacity)
    texts = (keyed.groupBy("key", "norm").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
             .select("key", "keep_id", "group_size", F.sha2(F.col("norm").cast("binary"), 256).alias("sha")))
    owned = (texts.withColumn("slot", _prefix(depth)).join(slots, "slot").repartition("bucket")
             .withColumn("chain", F.row_number().over(W.partitionBy("bucket", "key").orderBy("sha")) - 1))
    owned = owned.select("bucket", "local_depth", "key", "chain", "sha", "keep_id", "group_size")
    return written(spark, owned, "hash-index"), slots, depth


def dedup_index(spark: SparkSession, docs: DataFrame, capacity: int = 8192) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256, and the index place (bucket, chain).

    Rows equal in id and text travel as one row with their number until the end.
    """
    index, slots, depth = build_index(spark, docs, capacity)
    rows = _repeats(docs).withColumn("slot", _prefix(depth)).join(slots.select("slot", "bucket"), "slot")
    rows = rows.join(index.select("bucket", "chain", "key", "sha", "keep_id", "group_size"), ["bucket", "key", "sha"])
    return rows.select(
        "doc_id", "keep_id", "group_size", F.col("sha").alias("text_sha256"), "bucket", "chain", "key", "repeats",
        F.explode(F.sequence(F.lit(1), F.col("repeats"))).alias("copy"),
    ).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).drop("copy")


def _repeats(docs: DataFrame) -> DataFrame:
    return (_keyed(docs).select("doc_id", "key", F.sha2(F.col("norm").cast("binary"), 256).alias("sha"))
            .groupBy("doc_id", "key", "sha").agg(F.count(F.lit(1)).alias("repeats")))


def keep_one(spark: SparkSession, docs: DataFrame, capacity: int = 8192) -> DataFrame:
    """The rows of ``docs`` (all their columns) that stay: of equal texts the one with the largest id."""
    stay = dedup_index(spark, docs, capacity).filter("kept").select(
        F.col("doc_id").alias("_id"), F.col("key").alias("_key"), F.col("text_sha256").alias("_sha"), "repeats")
    stay = written(spark, stay, "dedup-stay")
    norm = lowered(text_or_empty())
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").alias("_doc"),
                       F.xxhash64(norm).alias("_k"), F.sha2(norm.cast("binary"), 256).alias("_s"))
    hit = rows.join(stay, F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_k") == F.col("_key"))
                    & (F.col("_s") == F.col("_sha")))
    alone = hit.filter("repeats = 1").select("row.*")
    repeated = hit.filter("repeats > 1").dropDuplicates(["_doc", "_k", "_s"]).select("row.*")
    return alone.unionByName(repeated)
