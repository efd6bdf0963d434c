"""Token-id files: fixed-width bit packing with block offsets.

One shard file holds consecutive documents in ascending id order::

    b"TIDBITS1" | packed blocks | block offsets u64[blocks + 1] | id starts u64[docs + 1] | doc ids i64[docs]
    | doc id is null u8[docs] | trailer: bits u32, ids per block u32, blocks u64, docs u64, ids u64, place of offsets u64

Every id takes ``bits`` = the fewest bits that hold the vocabulary, least significant bit first; a block packs
``per_block`` ids and starts on a byte.  A reader gets any document by one ranged read of the blocks it touches and
unpacks them with numpy.  Shards are written to ``spark.checkpoint.dir`` under names unique to the task attempt;
the written manifest names the ones that count, so a lost or repeated task leaves no trace in the result.

Rows are dealt out by range of (doc_id, hash of the text): repeated ids may spread over shards, and no shard is hot.
Defined cases: null text is empty (the end id alone); null ids come first; rows equal in id are ordered by the hash
of their text; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ledgerline.llm.common import attempt_name, file_system, shuffle_width, text_or_empty, tidied, written
from ledgerline.llm.tokens import encoder, slices
from ledgerline.session import scratch_dir

MAGIC = b"TIDBITS1"
TRAILER = np.dtype([("bits", "<u4"), ("per_block", "<u4"), ("blocks", "<u8"), ("docs", "<u8"), ("ids", "<u8"), ("at", "<u8")])


def pack_bits(ids: np.ndarray, bits: int) -> bytes:
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    lanes = (ids.astype(np.uint32)[:, None] >> np.arange(bits, dtype=np.uint32)) & 1
    return np.packbits(lanes.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack_bits(raw: bytes, bits: int, count: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(raw, f"<u{bits // 8}", count).astype("<u4")
    lanes = np.unpackbits(np.frombuffer(raw, np.uint8), bitorder="little", count=bits * count).reshape(count, bits)
    return (lanes.astype(np.uint32) << np.arange(bits, dtype=np.uint32)).sum(axis=1, dtype=np.uint32).astype("<u4")


class ShardWriter:
    def __init__(self, uri: str, bits: int, per_block: int):
        fs, path = file_system(uri)
        fs.create_dir(path.rpartition("/")[0], recursive=True)
        self.out = fs.open_output_stream(path, compression=None)
        self.out.write(MAGIC)
        self.bits, self.per_block, self.at = bits, per_block, len(MAGIC)
        self.offsets, self.starts, self.doc_ids, self.nulls = [self.at], [0], [], []
        self.held: list[np.ndarray] = []
        self.n_held = 0

    def add(self, doc_id, ids: np.ndarray) -> None:
        self.nulls.append(pd.isna(doc_id))
        self.doc_ids.append(0 if pd.isna(doc_id) else int(doc_id))
        self.starts.append(self.starts[-1] + len(ids))
        self.held.append(ids)
        self.n_held += len(ids)
        if self.n_held >= 64 * self.per_block:
            self._flush(self.n_held // self.per_block * self.per_block)

    def _flush(self, count: int) -> None:
        ids = np.concatenate(self.held) if self.held else np.empty(0, "<u4")
        for a in range(0, count, self.per_block):
            raw = pack_bits(ids[a : min(a + self.per_block, count)], self.bits)
            self.out.write(raw)
            self.at += len(raw)
            self.offsets.append(self.at)
        self.held, self.n_held = [ids[count:]], len(ids) - count

    def close(self) -> None:
        self._flush(self.n_held)
        for values, kind in ((self.offsets, "<u8"), (self.starts, "<u8"), (self.doc_ids, "<i8"), (self.nulls, "u1")):
            self.out.write(np.array(values, kind).tobytes())
        self.out.write(np.array([(self.bits, self.per_block, len(self.offsets) - 1, len(self.doc_ids), self.starts[-1],
                                  self.at)], TRAILER).tobytes())
        self.out.close()


class ShardReader:
    """Random access to one shard by ranged reads."""

    def __init__(self, uri: str):
        fs, path = file_system(uri)
        self.file = fs.open_input_file(path)
        size = self.file.size()
        self.meta = np.frombuffer(self.file.read_at(TRAILER.itemsize, size - TRAILER.itemsize), TRAILER)[0]
        at, blocks, docs = int(self.meta["at"]), int(self.meta["blocks"]), int(self.meta["docs"])
        raw = self.file.read_at(size - TRAILER.itemsize - at, at)
        cut = np.cumsum([0, 8 * (blocks + 1), 8 * (docs + 1), 8 * docs, docs])
        self.offsets, self.starts, self.doc_ids, self.nulls = (
            np.frombuffer(raw[a:b], kind) for a, b, kind in zip(cut, cut[1:], ("<u8", "<u8", "<i8", "u1")))

    def ids(self, first: int, last: int) -> np.ndarray:
        """Ids ``first`` to ``last`` (excluded), counted from the shard's first."""
        if first >= last:
            return np.empty(0, "<u4")
        per, bits = int(self.meta["per_block"]), int(self.meta["bits"])
        a, b = first // per, (last - 1) // per + 1
        place = self.offsets[a : b + 1].astype(np.int64)
        raw = self.file.read_at(int(place[-1] - place[0]), int(place[0]))
        out = [unpack_bits(raw[x - place[0] : y - place[0]], bits, min(per, int(self.meta["ids"]) - k * per))
               for k, x, y in zip(range(a, b), place, place[1:])]
        return np.concatenate(out)[first - a * per : last - a * per]

    def document(self, i: int) -> np.ndarray:
        return self.ids(int(self.starts[i]), int(self.starts[i + 1]))

    def documents(self, most: int = 1 << 20) -> Iterator[tuple[int, np.ndarray]]:
        """All documents in order, holding about ``most`` ids at a time (a longer document is alone)."""
        i, n = 0, len(self.doc_ids)
        while i < n:
            j = max(i + 1, int(np.searchsorted(self.starts, int(self.starts[i]) + most, side="right")) - 1)
            first = int(self.starts[i])
            ids = self.ids(first, int(self.starts[j]))
            for k in range(i, j):
                yield k, ids[int(self.starts[k]) - first : int(self.starts[k + 1]) - first]
            i = j


def write_shards(spark: SparkSession, docs: DataFrame, vocabulary: str, end_id: int = 0, per_block: int = 4096) -> DataFrame:
    """Write all documents as shards; returns the manifest (shard, uri, n_docs, n_ids, first_id)."""
    folder = scratch_dir(spark, "token-files")
    end = np.array([end_id], "<u4")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        enc, out, uri = encoder(vocabulary), None, ""
        for batch in batches:
            texts = batch["text"].tolist()
            for a, b in slices(texts):
                if out is None:
                    uri = f"{folder}/{attempt_name('shard', '.tid')}"
                    out = ShardWriter(uri, max(1, (enc.vocabulary_size - 1).bit_length()), per_block)
                for doc, ids in zip(batch["doc_id"].iloc[a:b], enc.ids(texts[a:b])):
                    out.add(doc, np.concatenate([np.frombuffer(ids, "<u4"), end]))
        if out is not None:
            out.close()
            yield pd.DataFrame({"shard": [TaskContext.get().partitionId()], "uri": [uri], "n_docs": [len(out.doc_ids)],
                                "n_ids": [out.starts[-1]]})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    rows = rows.withColumn("salt", F.xxhash64("text"))
    ordered = rows.repartitionByRange(shuffle_width(spark), "doc_id", "salt").sortWithinPartitions("doc_id", "salt")
    shards = written(spark, ordered.drop("salt").mapInPandas(tidied(write, vocabulary), "shard int, uri string, n_docs long, n_ids long"),
                     "token-manifest")
    before = W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)  # one row per shard file
    return shards.withColumn("first_id", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).cast("long"))


def read_documents(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """Read the shards back: doc_id, start, n_tokens, ids_crc32 (of little-endian unsigned 32-bit ids), shard."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for uri, first, shard in zip(batch["uri"], batch["first_id"], batch["shard"]):
                r = ShardReader(uri)
                crc = np.zeros(len(r.doc_ids), np.int64)
                for i, ids in r.documents():
                    crc[i] = zlib.crc32(ids.tobytes())
                starts = r.starts.astype(np.int64)
                yield pd.DataFrame({"doc_id": pd.Series(r.doc_ids.astype(np.int64)).astype("Int64").mask(r.nulls.astype(bool)),
                                    "start": first + starts[:-1], "n_tokens": np.diff(starts), "ids_crc32": crc,
                                    "shard": np.full(len(crc), shard)})

    spread = manifest.repartition(shuffle_width(spark), "shard")
    return spread.mapInPandas(read, "doc_id long, start long, n_tokens long, ids_crc32 long, shard int")
