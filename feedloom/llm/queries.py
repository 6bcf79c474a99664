"""Registered queries of the training-data operators: name -> f(spark, sf_dir).

Each applies its operator with production parameters to whole tables and only
derives the digest columns; ORACLE has DuckDB SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm import alignment as q13
from feedloom.llm import ann as q7
from feedloom.llm import bpe as q4
from feedloom.llm import cover_tree as q11
from feedloom.llm import line_dedup as q10
from feedloom.llm import merkle as q12
from feedloom.llm import packing as q8
from feedloom.llm import quality_rules as q6
from feedloom.llm import sharding as q9
from feedloom.llm import simhash_trie as q2
from feedloom.llm import suffix_dedup as q5
from feedloom.llm import toxicity as q1
from feedloom.llm import warc as q3

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@query
def op6_quality_rules(spark, sf_dir):
    rows = q6.quality_rules(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       "base_failed", "kept")


@query
def op2_simhash_trie(spark, sf_dir):
    return q2.simhash_groups(spark, table(spark, sf_dir, "documents"), shingle=3, max_bits=2)


@query
def op10_line_dedup(spark, sf_dir):
    rows = q10.line_dedup(spark, table(spark, sf_dir, "documents"))
    return rows.select("row.doc_id", "n_lines", "n_removed", "n_runs", F.md5(F.col("text").cast("binary")).alias("kept_md5"))


ORACLE["op10_line_dedup"] = r"""
WITH split AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL),
lines AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM split),
worded AS (SELECT doc_id, line, pos, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS k,
                  len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words
           FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
pairs AS (SELECT *, lead(line) OVER (PARTITION BY doc_id ORDER BY k) AS next_line FROM worded),
later AS (SELECT doc_id, k, 2 AS size,
                 row_number() OVER (PARTITION BY line, next_line ORDER BY doc_id, k) AS copy
          FROM pairs WHERE next_line IS NOT NULL
          UNION ALL
          SELECT doc_id, k, 1, row_number() OVER (PARTITION BY line ORDER BY doc_id, k)
          FROM pairs WHERE words >= 50),
dropped AS (SELECT DISTINCT doc_id, unnest(range(k, k + size)) AS k FROM later WHERE copy > 1),
marked AS (SELECT l.doc_id, l.line, l.pos, w.k, d.k AS gone FROM lines l
           LEFT JOIN worded w ON w.doc_id = l.doc_id AND w.pos = l.pos
           LEFT JOIN dropped d ON d.doc_id = w.doc_id AND d.k = w.k),
runs AS (SELECT d.doc_id, count(*) AS n_runs FROM dropped d
         LEFT JOIN dropped p ON p.doc_id = d.doc_id AND p.k = d.k - 1 WHERE p.k IS NULL GROUP BY d.doc_id),
texts AS (SELECT doc_id, count(k) AS n_lines, count(gone) AS n_removed,
                 coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE gone IS NULL), '') AS kept
          FROM marked GROUP BY doc_id)
SELECT s.doc_id, coalesce(t.n_lines, 0) AS n_lines, coalesce(t.n_removed, 0) AS n_removed,
       coalesce(r.n_runs, 0) AS n_runs, CASE WHEN s.text IS NOT NULL THEN md5(coalesce(t.kept, '')) END AS kept_md5
FROM documents s LEFT JOIN texts t USING (doc_id) LEFT JOIN runs r USING (doc_id)
"""


@query
def op5_suffix_dedup(spark, sf_dir):
    rows = q5.suffix_dedup(spark, table(spark, sf_dir, "documents"), length=400)
    return rows.select(F.col("row.doc_id").alias("doc_id"), "n_bytes",
                       (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
                       F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query
def op8_best_fit_packing(spark, sf_dir):
    return q8.pack_documents(spark, table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                             encode_special_tokens=False)


@query
def op4_byte_bpe(spark, sf_dir):
    ranks = q4.rank_file(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    rows = q4.encode(spark, table(spark, sf_dir, "documents").select("doc_id", "text"), ranks, decoded=True)
    return rows.select("row.doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))



@query
def op9_extendible_sharding(spark, sf_dir):
    return q9.extendible_shards(spark, table(spark, sf_dir, "documents"), max_bytes=q9.MAX_BYTES)


ORACLE["op9_extendible_sharding"] = r"""
WITH RECURSIVE hashed AS (
  SELECT doc_id, CAST(coalesce(strlen(text), 0) AS BIGINT) AS n_bytes,
         lpad(bin(CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT)), 60, '0') AS bits
  FROM documents),
step AS (
  SELECT doc_id, n_bytes, bits, 0 AS d, '' AS shard,
         CAST(sum(n_bytes) OVER () AS BIGINT) AS shard_bytes, count(*) OVER () AS shard_docs
  FROM hashed
  UNION ALL
  SELECT doc_id, n_bytes, bits, d + 1, substr(bits, 1, d + 1),
         CAST(sum(n_bytes) OVER (PARTITION BY substr(bits, 1, d + 1)) AS BIGINT),
         count(*) OVER (PARTITION BY substr(bits, 1, d + 1))
  FROM step WHERE shard_bytes > 1048576 AND d < 60)
SELECT doc_id, n_bytes, shard, shard_bytes, shard_docs, shard_bytes > 1048576 AS oversized
FROM step WHERE shard_bytes <= 1048576 OR d = 60
"""


@query
def op3_warc(spark, sf_dir):
    rows = q3.archive_pages(spark, table(spark, sf_dir, "pages"))
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", F.col("refers_page").alias("refers_to"))


ORACLE["op3_warc"] = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
           FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id > first THEN first END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""


@query
def op7_multi_index_hashing(spark, sf_dir):
    v = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("x"))
    return q7.nearest(spark, v, v.filter("id % 20 = 0").select("id"), k=20)


@query
def op1_toxicity(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    bias, weights = q1.learn(spark, docs, labels.filter(~held_out).select("doc_id", "toxic"))
    rows = q1.score(docs, bias, weights)
    return rows.select("doc_id", held_out.alias("held_out"), "score",
                       F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


@query
def op12_merkle_manifest(spark, sf_dir):
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.lit(False))
    tampered = q12.leaf(*[F.col(c) + F.when(hit, 1).otherwise(0) if c == "n_chars" else F.col(c) for c in columns])
    rows = q12.merkle_manifest(spark, table(spark, sf_dir, "documents"), columns, carry={"seen": tampered})
    back = q12.folded(F.col("seen"), F.col("path"))
    return rows.select("doc_id", "leaf", "subroot", "root", q12.siblings_digest(F.col("path")).alias("proof_sha256"),
                       back.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


ORACLE["op12_merkle_manifest"] = r"""
WITH RECURSIVE bits AS (
  SELECT DISTINCT doc_id, list_reduce(
      list_concat([CAST(4294967295 AS BIGINT)],
                  flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
                                         lambda x: [CAST(ascii(x) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))),
      lambda a, x: xor(xor(a, x) >> 1, CAST(3988292384 AS BIGINT) * (xor(a, x) & 1))) AS reg
  FROM documents WHERE doc_id IS NOT NULL),
hit AS (SELECT doc_id FROM bits WHERE xor(reg, CAST(4294967295 AS BIGINT)) % 7 = 0),
parts AS (
  SELECT d.doc_id, d.lang,
         coalesce(strlen(CAST(d.doc_id AS VARCHAR)) || ':' || CAST(d.doc_id AS VARCHAR), '-')
           || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS head,
         coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || CAST(n_chars AS VARCHAR), '-') AS size,
         CASE WHEN h.doc_id IS NOT NULL
              THEN coalesce(strlen(CAST(n_chars + 1 AS VARCHAR)) || ':' || CAST(n_chars + 1 AS VARCHAR), '-') END AS other,
         coalesce(strlen(text) || ':' || text, '-') AS body
  FROM documents d LEFT JOIN hit h ON h.doc_id = d.doc_id),
hashed AS (SELECT doc_id, lang, sha256(head || size || body) AS leaf,
                  sha256(head || coalesce(other, size) || body) AS seen FROM parts),
leaves AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
                  dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g FROM hashed),
nodes AS (
  SELECT g, 0 AS lvl, pos, leaf AS h, count(*) OVER (PARTITION BY g) AS n FROM leaves
  UNION ALL
  SELECT g, lvl, pos, h, count(*) OVER (PARTITION BY g) FROM (
    SELECT g, lvl + 1 AS lvl, pos // 2 AS pos, sha256(string_agg(h, '' ORDER BY pos)) AS h
    FROM nodes WHERE n > 1 GROUP BY g, lvl, pos // 2)),
subs AS (SELECT g, h AS subroot, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS lvl, g AS pos, subroot AS h, n FROM subs
  UNION ALL
  SELECT lvl, pos, h, count(*) OVER () FROM (
    SELECT lvl + 1 AS lvl, pos // 2 AS pos, sha256(string_agg(h, '' ORDER BY pos)) AS h
    FROM tops WHERE n > 1 GROUP BY lvl, pos // 2)),
fold AS (
  SELECT l.doc_id, l.g, l.leaf, l.pos AS start, 0 AS lvl, l.pos, l.seen AS h, '' AS sibs, FALSE AS up,
         count(*) OVER (PARTITION BY l.g) AS n
  FROM leaves l
  UNION ALL
  SELECT f.doc_id, f.g, f.leaf, f.start,
         CASE WHEN f.up OR f.n > 1 THEN f.lvl + 1 ELSE 0 END,
         CASE WHEN f.up OR f.n > 1 THEN f.pos // 2 ELSE f.g END,
         CASE WHEN NOT f.up AND f.n = 1 THEN f.h
              WHEN f.pos % 2 = 0 THEN sha256(f.h || coalesce(s.h, t.h, '')) ELSE sha256(coalesce(s.h, t.h) || f.h) END,
         CASE WHEN NOT f.up AND f.n = 1 THEN f.sibs ELSE f.sibs || coalesce(s.h, t.h, '') END,
         f.up OR f.n = 1,
         CASE WHEN f.up OR f.n > 1 THEN (f.n + 1) // 2 ELSE (SELECT count(*) FROM subs) END
  FROM fold f
  LEFT JOIN nodes s ON NOT f.up AND f.n > 1 AND s.g = f.g AND s.lvl = f.lvl AND s.pos = xor(f.pos, CAST(1 AS BIGINT))
  LEFT JOIN tops t ON f.up AND t.lvl = f.lvl AND t.pos = xor(f.pos, CAST(1 AS BIGINT))
  WHERE NOT f.up OR f.n > 1)
SELECT f.doc_id, f.leaf, s.subroot, (SELECT h FROM tops WHERE n = 1) AS root, sha256(f.sibs) AS proof_sha256,
       f.h AS folded_root, f.h = (SELECT h FROM tops WHERE n = 1) AS verified
FROM fold f JOIN subs s ON s.g = f.g WHERE f.up AND f.n = 1
"""


@query
def op13_tokenizer_alignment(spark, sf_dir):
    rows = q13.align(spark, table(spark, sf_dir, "documents").select("doc_id", "text"),
                     public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    return rows.select(F.col("row.doc_id").cast("long").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best",
                       "count_sum", "groups_sha256")


@query
def op11_cover_tree(spark, sf_dir):
    v = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("x"))
    rows = q11.near_duplicates(spark, v, cosine=0.95)
    return rows.select(F.col("id").alias("vec_id"), "n_links", "component_id",
                       F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))


ORACLE["op11_cover_tree"] = """
WITH RECURSIVE d AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings WHERE embedding IS NOT NULL),
v AS (SELECT vec_id, x FROM d WHERE len(list_filter(x, lambda c: c IS NULL OR NOT isfinite(c))) = 0
                                AND len(list_filter(x, lambda c: c <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
          ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x) AND list_cosine_similarity(a.x, b.x) >= 0.95),
reach AS (SELECT vec_id, vec_id AS root FROM v
          UNION SELECT l.a, r.root FROM reach r JOIN links l ON l.b = r.vec_id WHERE r.root < l.a),
least AS (SELECT vec_id, min(root) AS root FROM reach GROUP BY vec_id),
n AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(n.n, 0) AS n_links, coalesce(l.root, e.vec_id) AS component_id,
       e.vec_id = coalesce(l.root, e.vec_id) AS kept
FROM embeddings e LEFT JOIN least l ON l.vec_id = e.vec_id LEFT JOIN n ON n.vec_id = e.vec_id
"""
