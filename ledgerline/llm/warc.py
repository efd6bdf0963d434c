"""WARC archives with a two-level capture index.

Archive: each page is one gzip member (a WARC/1.1 record: response, or revisit with a reference to the response of
the same payload).  Index: capture lines sorted by reversed-host URL key, compressed in blocks of ``per_block``
lines.  An index shard ends in its sparse block directory (first key, place and length of each block); the level above
is the manifest, one row per shard with its first and last key.  A lookup binary-searches the manifest and the block
directory, then reads only the blocks, then only the records that it needs, by ranged reads.

Files go below ``spark.checkpoint.dir`` under names unique to the task attempt; only the written tables of captures and
shards name them, so repeated tasks leave no trace in results.  The manifest is the one thing held whole: one row
per shard, and there are as many shards as shuffle partitions.

Captures of one key may fill many blocks and shards: lookups are dealt out by (key, block), so a hot URL is spread.
Defined cases: null html is an empty payload; a null URL has the empty key; equal payloads under ``shortest`` bytes are all
responses; of longer equal ones those with the smallest page_id (all of them, if the id repeats) are responses and a null
page_id counts as the largest; control characters and spaces of a URL are percent-encoded; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
import re
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import attempt_name, file_system, shuffle_width, written
from ledgerline.session import scratch_dir

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Fixed value: pages carry no time of capture.
DATE = "1970-01-01T00:00:00Z"
CAPTURES = "key string, page_id long, uri string, at long, size long"


def url_key(url: Column) -> Column:
    """Reversed-host sort key: https://News.example.org:8080/a?b -> org,example,news:8080)/a?b; null -> ''."""
    clean = F.regexp_replace(F.coalesce(url, F.lit("")), r"[\x00-\x20\x7f]", "%20")
    parts = r"(?s)^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)((?::[0-9]+)?)(.*)$"
    host = F.array_join(F.reverse(F.split(F.lower(F.regexp_extract(clean, parts, 1)), r"\.")), ",")
    keyed = F.concat(host, F.regexp_extract(clean, parts, 2), F.lit(")"), F.regexp_extract(clean, parts, 3))
    return F.when(clean.rlike(parts), keyed).otherwise(clean)


def record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """The bytes of one record: a response, or a revisit if ``refers_to`` is given."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{page_id}>",
            f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += [f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response",
             f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed(raw: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """(WARC headers, HTTP headers, payload) of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    http, _, payload = rest[: int(headers["Content-Length"])].partition(b"\r\n\r\n")
    return headers, http, payload


def write_archive(spark: SparkSession, pages: DataFrame, shortest: int = 100, roll: int = 1 << 30) -> DataFrame:
    """Write the records; returns the written captures (key, page_id, uri, at, size)."""
    folder = scratch_dir(spark, "warc")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256)).withColumn("key", url_key(F.col("url")))
    first = (rows.filter(F.length("payload") >= shortest).groupBy("digest")
             .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"))
    marked = rows.join(first, "digest", "left").withColumn(
        "refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id")))

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, uri, at = None, "", 0
        for batch in batches:
            found = []
            for page, url, payload, digest, key, ref in zip(
                    batch["page_id"], batch["url"], batch["payload"], batch["digest"], batch["key"], batch["refers_to"]):
                if out is None or at >= roll:
                    if out is not None:
                        out.close()
                    uri = f"{folder}/{attempt_name('part', '.warc.gz')}"
                    fs, path = file_system(uri)
                    fs.create_dir(path.rpartition("/")[0], recursive=True)
                    out, at = fs.open_output_stream(path, compression=None), 0
                page = None if pd.isna(page) else int(page)
                member = zlib.compressobj(6, zlib.DEFLATED, 31)
                raw = member.compress(record(page, url, payload, digest, None if pd.isna(ref) else int(ref))) + member.flush()
                out.write(raw)
                found.append((key, page, uri, at, len(raw)))
                at += len(raw)
            yield pd.DataFrame(found, columns=["key", "page_id", "uri", "at", "size"]).astype({"page_id": "Int64"})
        if out is not None:
            out.close()

    marked = marked.select("page_id", "url", "payload", "digest", "key", "refers_to")
    return written(spark, marked.mapInPandas(write, CAPTURES), "captures")


def build_index(spark: SparkSession, captures: DataFrame, per_block: int = 1024) -> DataFrame:
    """Write the index shards; returns the manifest (shard, uri, first_key, last_key, blocks, captures)."""
    folder = scratch_dir(spark, "capture-index")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        held: list[tuple] = []
        directory, out, uri, at, first, last, total = [], None, "", 0, None, None, 0

        def flush(rows):
            nonlocal at
            lines = "\n".join(f"{key}\t" + json.dumps({"page": page, "uri": u, "at": a, "size": s}) for key, page, u, a, s in rows)
            raw = zlib.compress(lines.encode("utf-8", "surrogatepass"), 6)
            out.write(raw)
            directory.append((rows[0][0], at, len(raw)))
            at += len(raw)

        for batch in batches:
            pages = [None if pd.isna(p) else int(p) for p in batch["page_id"]]
            held += zip(batch["key"], pages, batch["uri"], batch["at"].tolist(), batch["size"].tolist())
            if held and out is None:
                uri = f"{folder}/{attempt_name('shard', '.idx')}"
                fs, path = file_system(uri)
                fs.create_dir(path.rpartition("/")[0], recursive=True)
                out, first = fs.open_output_stream(path, compression=None), held[0][0]
            total += len(batch)
            last = held[-1][0] if held else last
            while len(held) > per_block:
                flush(held[:per_block])
                held = held[per_block:]
        if out is not None:
            flush(held)
            foot = zlib.compress(json.dumps(directory).encode())
            out.write(foot + len(foot).to_bytes(8, "little"))
            out.close()
            yield pd.DataFrame([(TaskContext.get().partitionId(), uri, first, last, len(directory), total)],
                               columns=["shard", "uri", "first_key", "last_key", "blocks", "captures"])

    ordered = captures.repartitionByRange(shuffle_width(spark), "key", "page_id", "uri", "at").sortWithinPartitions(
        "key", "page_id", "uri", "at")
    return written(spark, ordered.mapInPandas(
        write, "shard int, uri string, first_key string, last_key string, blocks int, captures long"), "index-manifest")


def _directory(uri: str) -> tuple[list[str], list[tuple[int, int]]]:
    fs, path = file_system(uri)
    with fs.open_input_file(path) as f:
        size = f.size()
        n = int.from_bytes(f.read_at(8, size - 8), "little")
        rows = json.loads(zlib.decompress(f.read_at(n, size - 8 - n)))
    return [r[0] for r in rows], [(r[1], r[2]) for r in rows]


def lookup(spark: SparkSession, manifest: DataFrame, urls: DataFrame) -> DataFrame:
    """The captures (key, page_id, uri, at, size) of every distinct URL key of ``urls`` (column url)."""
    shards = sorted((r["shard"], r["first_key"], r["last_key"], r["uri"]) for r in manifest.collect())  # one row per shard
    first_keys, last_keys, uris = [[s[i] for s in shards] for i in (1, 2, 3)]

    def locate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[str, tuple] = {}
        for batch in batches:
            found = []
            for key in batch["key"]:
                for s in range(bisect_left(last_keys, key), bisect_right(first_keys, key)):
                    if uris[s] not in known:
                        known = {**known, uris[s]: _directory(uris[s])} if len(known) < 4 else {uris[s]: _directory(uris[s])}
                    firsts, places = known[uris[s]]
                    for b in range(max(0, bisect_left(firsts, key) - 1), bisect_right(firsts, key)):
                        found.append((key, uris[s], *places[b]))
            yield pd.DataFrame(found, columns=["key", "index", "block", "n"])

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, lines = (None, None), {}
        for batch in batches:
            found = []
            for key, uri, block, n in zip(batch["key"], batch["index"], batch["block"], batch["n"]):
                if at != (uri, block):
                    fs, path = file_system(uri)
                    with fs.open_input_file(path) as f:
                        text = zlib.decompress(f.read_at(int(n), int(block))).decode("utf-8", "surrogatepass")
                    at, lines = (uri, block), {}
                    for line in text.split("\n"):
                        k, _, rest = line.partition("\t")
                        lines.setdefault(k, []).append(rest)
                for rest in lines.get(key, ()):
                    c = json.loads(rest)
                    found.append((key, c["page"], c["uri"], c["at"], c["size"]))
            yield pd.DataFrame(found, columns=["key", "page_id", "uri", "at", "size"]).astype({"page_id": "Int64"})

    width = shuffle_width(spark)
    keys = urls.select(url_key(F.col("url").cast("string")).alias("key")).distinct()
    keys = keys.repartitionByRange(width, "key").sortWithinPartitions("key")
    blocks = keys.mapInPandas(locate, "key string, index string, block long, n long")
    blocks = blocks.repartition(width, "index", "block").sortWithinPartitions("index", "block", "key")
    return blocks.mapInPandas(fetch, CAPTURES)


def read_records(spark: SparkSession, captures: DataFrame, most: int = 8 << 20) -> DataFrame:
    """Read records by ranged reads (neighbours within ``most`` bytes in one): page_id, payload_bytes, payload_digest,
    record_type, refers_to.  A response whose payload does not match its digest fails the job."""

    def number(urn):
        name = urn.removeprefix("<urn:page:").removesuffix(">")
        return None if name == "None" else int(name)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            places = list(zip(batch["uri"], batch["at"].tolist(), batch["size"].tolist()))
            found, i = [], 0
            while i < len(places):
                uri, start, _ = places[i]
                j = i + 1
                while j < len(places) and places[j][0] == uri and places[j][1] + places[j][2] - start <= most:
                    j += 1
                fs, path = file_system(uri)
                with fs.open_input_file(path) as f:
                    raw = f.read_at(places[j - 1][1] + places[j - 1][2] - start, start)
                for _, at, size in places[i:j]:
                    headers, http, payload = parsed(zlib.decompress(raw[at - start : at - start + size], 31))
                    digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
                    kind = headers["WARC-Type"]
                    if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
                        raise ValueError(f"payload of {headers['WARC-Record-ID']} does not match its digest")
                    length = int(re.search(rb"Content-Length: (\d+)", http)[1])
                    refers = headers.get("WARC-Refers-To")
                    found.append((number(headers["WARC-Record-ID"]), length, digest, kind, refers and number(refers)))
                i = j
            yield pd.DataFrame(found, columns=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]).astype(
                {"page_id": "Int64", "refers_to": "Int64"})

    ordered = captures.repartitionByRange(shuffle_width(spark), "uri", "at").sortWithinPartitions("uri", "at")
    return ordered.mapInPandas(
        read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")
