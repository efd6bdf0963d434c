"""Queries of the training-data operators: each applies one operator with production parameters to a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import (
    bpe_trie, conversation_repair, decontamination, exact_dedup, language_model, lexical_search, license_scan, ngram_join, packing, quality, token_files, toxicity, warc,
)
from ledgerline.llm.common import table


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """Place of a public vocabulary file on this machine; the files are part of the environment, not of the library."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_pack_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(spark, table(spark, sf_dir, "documents"), vocabulary(), capacity=1024, end_id=2)


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    manifest = warc.build_index(spark, warc.write_archive(spark, pages))
    return warc.read_records(spark, warc.lookup(spark, manifest, pages.select("url")))


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(spark, table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = token_files.write_shards(spark, table(spark, sf_dir, "documents"), vocabulary(), end_id=0)
    return token_files.read_documents(spark, manifest).drop("shard")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.dedup_index(spark, table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op7_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score(spark, table(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.leaks(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "first_word", "n_words", "similarity", "hamming")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(spark, table(spark, sf_dir, "documents"))


def op11_bpe_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = bpe_trie.encode(spark, table(spark, sf_dir, "documents"), vocabulary())
    return bpe_trie.digests(bpe_trie.decode(spark, encoded, vocabulary()))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair(spark, conversation_repair.damaged(table(spark, sf_dir, "conversations")))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), top=10)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_pack_best_fit, op2_warc, op3_ngram_join, op4_quality, op5_token_files, op6_exact_dedup, op7_language_model, op8_decontamination, op9_toxicity, op10_license_scan,
                              op11_bpe_trie, op12_conversation_repair, op13_lexical_search)
}

ORACLES: dict[str, str] = {
    "op2_warc": """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha256(payload) AS payload_digest FROM p),
g AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM g
""",
    "op3_ngram_join": """
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                                      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * o >= 75 * (nx.n + ny.n - o)),
e AS (SELECT x AS a, y AS b FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT a AS node, a AS root FROM e UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.node WHERE r.root < e.b),
c AS (SELECT node, min(root) AS root FROM r GROUP BY node)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, coalesce(c.root, d.doc_id) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN c ON c.node = d.doc_id
""",
    "op6_exact_dedup": """
WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                           'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256),
n AS (SELECT *, row_number() OVER (PARTITION BY text_sha256, doc_id) AS copy FROM d)
SELECT n.doc_id, g.keep_id, g.group_size, (n.doc_id IS NOT DISTINCT FROM g.keep_id AND copy = 1) AS kept, n.text_sha256
FROM n JOIN g USING (text_sha256)
""",
    "op12_conversation_repair": """
WITH RECURSIVE
k AS (SELECT dense_rank() OVER (ORDER BY conv_id) AS g, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
             coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name FROM conversations),
c AS (SELECT *, xor(list_reduce(list_transform(string_split(name, ''), lambda x: CAST(ord(x) AS BIGINT)),
        lambda crc, b: list_reduce([0, 1, 2, 3, 4, 5, 6, 7], lambda v, i: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, xor(crc, b)),
        4294967295), 4294967295) % 20 AS deal FROM k),
d AS (SELECT g, turn, CASE deal WHEN 4 THEN 'user' ELSE role END AS role,
             CASE deal WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
             unnest(CASE deal WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END) AS copy FROM c),
l AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY turn NULLS FIRST, role, text) AS n FROM d),
o AS (SELECT *, row_number() OVER (PARTITION BY g, role, text ORDER BY n) AS again,
             rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS ended,
             lag(substr(role, 1, 1)) OVER (PARTITION BY g ORDER BY n) AS before FROM l),
f AS (SELECT *, CASE WHEN ended = '' THEN 'blank' WHEN again > 1 THEN 'duplicate' WHEN right(ended, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault
      FROM o),
m AS (SELECT g, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
             count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
             count(*) FILTER (before || substr(role, 1, 1) NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY g),
-- states: 0 nothing yet, 1 system, 2 user, 3 assistant; up to two rows are inserted in one place
ins AS (SELECT * FROM (VALUES (0, 0, 0, '', ''), (1, 0, 1, '', ''), (2, 0, 2, '', ''), (3, 0, 3, '', ''), (0, 5, 2, 'I', chr(10) || 'user:'),
  (1, 5, 2, 'I', chr(10) || 'user:'), (3, 5, 2, 'I', chr(10) || 'user:'), (2, 5, 3, 'I', chr(10) || 'assistant:'),
  (0, 10, 3, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'), (1, 10, 3, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'),
  (3, 10, 3, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'), (2, 10, 2, 'II', chr(10) || 'assistant:' || chr(10) || 'user:'))
  AS t(state, price, then_state, letters, lines)),
keep AS (SELECT * FROM (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (3, 'u', 2), (2, 'a', 3)) AS t(state, initial, then_state)),
p AS (
  SELECT DISTINCT g, CAST(0 AS BIGINT) AS n, 0 AS state, printf('%012d', 0) AS audit, '' AS lines FROM f
  UNION ALL
  SELECT g, n, state, min(audit) AS audit, arg_min(lines, audit) AS lines FROM (
    SELECT f.g, f.n, e.state, printf('%012d', CAST(substr(p.audit, 1, 12) AS BIGINT) + ins.price + e.price) || substr(p.audit, 13) || ins.letters || e.letter AS audit,
           p.lines || ins.lines || e.line AS lines
    FROM p JOIN f ON f.g = p.g AND f.n = p.n + 1 JOIN ins ON ins.state = p.state,
    LATERAL (
      SELECT ins.then_state AS state, 2 AS price, 'D' AS letter, '' AS line
      UNION ALL
      SELECT keep.then_state, CASE WHEN f.fault = 'truncated' THEN 5 ELSE 0 END, 'K', chr(10) || f.role || ':' || f.text FROM keep
      WHERE keep.state = ins.then_state AND keep.initial = substr(f.role, 1, 1) AND coalesce(f.fault, '') NOT IN ('blank', 'duplicate')
      UNION ALL
      SELECT CASE ins.then_state WHEN 2 THEN 3 ELSE 2 END, CASE WHEN f.fault = 'truncated' THEN 6 ELSE 1 END, 'R',
             chr(10) || CASE ins.then_state WHEN 2 THEN 'assistant:' ELSE 'user:' END || f.text
      WHERE coalesce(f.fault, '') NOT IN ('blank', 'duplicate')) e)
  GROUP BY g, n, state),
z AS (SELECT g, min(audit) AS audit, arg_min(lines, audit) AS lines FROM (
        SELECT p.g, printf('%012d', CAST(substr(p.audit, 1, 12) AS BIGINT) + ins.price) || substr(p.audit, 13) || ins.letters AS audit, p.lines || ins.lines AS lines
        FROM p JOIN m ON m.g = p.g AND m.n = p.n JOIN ins ON ins.state = p.state AND ins.then_state IN (0, 3)) GROUP BY g),
a AS (SELECT DISTINCT g, conv_id FROM k)
SELECT a.conv_id, CAST(coalesce(m.gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(m.blank, 0) AS BIGINT) AS blank, CAST(coalesce(m.duplicate, 0) AS BIGINT) AS duplicate,
       CAST(coalesce(m.truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(m.illegal, 0) AS BIGINT) AS illegal,
       CAST(coalesce(substr(z.audit, 1, 12), '0') AS BIGINT) AS cost, coalesce(substr(z.audit, 13), '') AS audit,
       sha256(coalesce(substr(z.lines, 2), '')) AS repaired_sha256
FROM a LEFT JOIN m USING (g) LEFT JOIN z USING (g)
""",
    "op13_lexical_search": """
WITH o AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
d AS (
  SELECT r, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM o),
i AS (SELECT row_number() OVER () AS q, item_id, text FROM benchmark),
q AS (
  SELECT DISTINCT q, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM i),
n AS (SELECT r, any_value(doc_id) AS doc_id, count(*) AS n FROM d GROUP BY r),
a AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM n),
m AS (SELECT r, doc_id, 100 - 90 + (90 * n * docs) // terms AS m FROM n, a),
f AS (SELECT r, term, count(*) AS tf FROM d SEMI JOIN q USING (term) GROUP BY r, term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM f, a GROUP BY term),
s AS (
  SELECT q.q, m.r, m.doc_id, CAST(sum(w.w * ((1000000000 * f.tf) // (1000 * f.tf + 8 * m.m))) AS BIGINT) AS score
  FROM f JOIN w USING (term) JOIN m ON m.r = f.r JOIN q ON q.term = f.term GROUP BY q.q, m.r, m.doc_id),
k AS (SELECT q, doc_id, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id ASC NULLS LAST) AS place FROM s WHERE score > 0)
SELECT i.item_id, CAST(k.place AS INTEGER) AS rank, k.doc_id, k.score FROM k JOIN i USING (q) WHERE k.place <= 10
""",
}
