"""The registered queries of this subpackage, their oracle SQL, and the stages of the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footmark.llm import (centroid_drift, embedding_dedup, importance_radix, language_id, minhash_dedup, mixing, packing, quality_rff, secret_scan, topk_bitsliced,
                          toxicity_chain, url_cascade, wavelet_shards)
from footmark.llm.common import held_out_col


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_minhash_near_dedup(spark, sf_dir):
    return minhash_dedup.near_duplicates(_read(spark, sf_dir, "documents"), shingle=3, percent=85)


def op2_exact_topk(spark, sf_dir):
    return topk_bitsliced.top_k(_read(spark, sf_dir, "embeddings"))


def op3_curve_packing(spark, sf_dir):
    return packing.digest(packing.pack(_read(spark, sf_dir, "documents")))


def op4_language_id(spark, sf_dir):
    docs = _read(spark, sf_dir, "documents")
    profiles = language_id.learn_profiles(docs.filter(~held_out_col()))
    return language_id.predict(docs, profiles) \
        .select(F.col("key").alias("doc_id"), held_out_col("key").alias("held_out"), "lang_pred", "score")


def op5_toxicity(spark, sf_dir):
    # the labels have one toxicity column; low quality is the chain's first link
    chain = {"low_quality": F.col("quality") == 0, "toxic": F.col("toxic") == 1}
    return toxicity_chain.score_toxicity(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"), held_out_col(), chain)


def op6_embedding_near_dedup(spark, sf_dir):
    return embedding_dedup.near_vectors(_read(spark, sf_dir, "embeddings"))


def op7_wavelet_tokens(spark, sf_dir):
    return wavelet_shards.token_table(_read(spark, sf_dir, "documents"))


def op8_source_mixing(spark, sf_dir):
    return mixing.mix_sources(_read(spark, sf_dir, "documents"))


def op9_quality(spark, sf_dir):
    return quality_rff.score_quality(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"), held_out_col())


def op10_secret_scan(spark, sf_dir):
    return secret_scan.digest(secret_scan.scan(_read(spark, sf_dir, "documents")))


def op11_url_cascade(spark, sf_dir):
    pages = _read(spark, sf_dir, "pages").select("page_id", "url")
    return url_cascade.judge(pages, url_cascade.rule_table(spark)).select("page_id", "host", "path", "rule", "verdict")


def op12_importance_radix(spark, sf_dir):
    return importance_radix.resample(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op13_centroid_drift(spark, sf_dir):
    return centroid_drift.centroid_clusters(_read(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_minhash_near_dedup, op2_exact_topk, op3_curve_packing, op4_language_id, op5_toxicity, op6_embedding_near_dedup,
                            op7_wavelet_tokens, op8_source_mixing, op9_quality, op10_secret_scan, op11_url_cascade,
                            op12_importance_radix, op13_centroid_drift)
}

# DuckDB: whole-table brute force. Operators that need a tokenizer, a trained model or a seeded draw
# have none; tests/llm compares them with brute-force versions.
ORACLE_SQL: dict[str, str] = {
    "op1_minhash_near_dedup": r"""
WITH RECURSIVE words AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS MATERIALIZED (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s FROM words),
shingles AS MATERIALIZED (SELECT doc_id, hash(unnest(s)) AS h FROM sets),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_both FROM shingles a JOIN shingles b ON a.h = b.h AND a.doc_id < b.doc_id
           GROUP BY ALL),
links AS MATERIALIZED (SELECT a, b FROM common JOIN sets x ON x.doc_id = a JOIN sets y ON y.doc_id = b
                       WHERE 100 * n_both >= 85 * (len(x.s) + len(y.s) - n_both)),
edges AS MATERIALIZED (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT doc_id, doc_id AS r FROM documents UNION SELECT reach.doc_id, b FROM reach JOIN edges ON r = a)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, c.component_id, s.doc_id = c.component_id AS kept
FROM sets s JOIN (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id) c ON c.doc_id = s.doc_id
""",
    "op2_exact_topk": """
WITH q AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings),
parts AS MATERIALIZED (SELECT vec_id, unnest(range(1, len(v) + 1)) AS d, unnest(v) AS x FROM q),
scores AS (SELECT a.vec_id AS query_id, b.vec_id, sum(a.x * b.x)::BIGINT AS score
           FROM parts a JOIN parts b ON a.d = b.d AND a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0 GROUP BY ALL)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scores) WHERE rank <= 10
""",
    "op11_url_cascade": r"""
WITH rests AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
urls AS (SELECT row_number() OVER () AS n, page_id, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
  translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host FROM rests),
rules(action, h, p) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
                               ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
fits AS (SELECT n, arg_max(h || p, len(h || p)) AS rule, arg_max(action, len(h || p)) AS verdict FROM urls JOIN rules
         ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY n)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM urls LEFT JOIN fits USING (n)
""",
    "op12_importance_radix": r"""
WITH crc_table AS MATERIALIZED (
  SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384)
                                                                                    ELSE c >> 1 END, b)) AS t),
docs AS MATERIALIZED (
  SELECT row_number() OVER () AS n, doc_id, unnest(words) AS w FROM (SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM documents)),
goal AS MATERIALIZED (
  SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark),
crcs AS MATERIALIZED (
  SELECT w, xor(list_reduce(list_transform(range(1, octet_length(encode(w)) + 1), lambda i: ('0x' || substr(hex(encode(w)), 2 * i - 1, 2))::BIGINT),
                            lambda c, b: xor(c >> 8, t[xor(c, b) % 256 + 1]), 4294967295), 4294967295) % 10000 AS bucket
  FROM (SELECT w FROM docs UNION SELECT w FROM goal) JOIN crc_table ON true),
s AS (SELECT bucket, count(*) AS s FROM docs JOIN crcs USING (w) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM goal JOIN crcs USING (w) GROUP BY bucket),
gains AS MATERIALIZED (
  SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1.0::DOUBLE) * ((SELECT coalesce(sum(s), 0) FROM s)::DOUBLE + 10000)
                                 / ((s + 1.0::DOUBLE) * ((SELECT coalesce(sum(t), 0) FROM t)::DOUBLE + 10000))))::BIGINT AS gain
  FROM s LEFT JOIN t USING (bucket)),
weights AS (SELECT doc_id, count(*) AS n_features, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
            FROM docs JOIN crcs USING (w) JOIN gains USING (bucket) GROUP BY doc_id),
scores AS (SELECT d.doc_id, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
             (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || d.doc_id), 1, 8))::BIGINT + 0.5::DOUBLE)
                                                          / 4294967296.0::DOUBLE))))::BIGINT AS score
           FROM documents d LEFT JOIN weights w ON w.doc_id = d.doc_id),
ranks AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS able FROM scores WHERE n_features >= 20)
SELECT s.doc_id, n_features, weight, score, CASE WHEN r <= 10 * able // 100 THEN r END AS rank
FROM scores s LEFT JOIN ranks USING (doc_id)
""",
    "op13_centroid_drift": """
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = 64 AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
c0 AS MATERIALIZED (SELECT (row_number() OVER (ORDER BY h))::INTEGER - 1 AS c, v AS m
                    FROM (SELECT v, sha256('1:' || vec_id) AS h FROM kept ORDER BY h LIMIT 16)),
a0 AS MATERIALIZED (
  SELECT n, vec_id, v, arg_min(c, (d, c)) AS c, min(d) AS d
  FROM (SELECT n, vec_id, v, c, list_sum(list_transform(list_zip(v, m), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM kept JOIN c0 ON true)
  GROUP BY n, vec_id, v),
c1 AS MATERIALIZED (
  SELECT c, coalesce(x.m, c0.m) AS m FROM c0 LEFT JOIN (
    SELECT c, list(f ORDER BY j) AS m FROM (
      SELECT c, j, ((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS f
      FROM (SELECT c, unnest(v) AS x, unnest(range(64)) AS j FROM a0) GROUP BY c, j) GROUP BY c) x USING (c)),
a1 AS MATERIALIZED (
  SELECT n, vec_id, v, arg_min(c, (d, c)) AS c, min(d) AS d
  FROM (SELECT n, vec_id, v, c, list_sum(list_transform(list_zip(v, m), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM kept JOIN c1 ON true)
  GROUP BY n, vec_id, v),
c2 AS MATERIALIZED (
  SELECT c, coalesce(x.m, c1.m) AS m FROM c1 LEFT JOIN (
    SELECT c, list(f ORDER BY j) AS m FROM (
      SELECT c, j, ((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS f
      FROM (SELECT c, unnest(v) AS x, unnest(range(64)) AS j FROM a1) GROUP BY c, j) GROUP BY c) x USING (c)),
a2 AS MATERIALIZED (
  SELECT n, vec_id, v, arg_min(c, (d, c)) AS c, min(d) AS d
  FROM (SELECT n, vec_id, v, c, list_sum(list_transform(list_zip(v, m), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM kept JOIN c2 ON true)
  GROUP BY n, vec_id, v),
c3 AS MATERIALIZED (
  SELECT c, coalesce(x.m, c2.m) AS m FROM c2 LEFT JOIN (
    SELECT c, list(f ORDER BY j) AS m FROM (
      SELECT c, j, ((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS f
      FROM (SELECT c, unnest(v) AS x, unnest(range(64)) AS j FROM a2) GROUP BY c, j) GROUP BY c) x USING (c)),
a3 AS MATERIALIZED (
  SELECT n, vec_id, v, arg_min(c, (d, c)) AS c, min(d) AS d
  FROM (SELECT n, vec_id, v, c, list_sum(list_transform(list_zip(v, m), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM kept JOIN c3 ON true)
  GROUP BY n, vec_id, v)
SELECT vec_id, a3.c AS cluster, d AS distance, (sum(d) OVER (PARTITION BY a3.c))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia,
  sha256(array_to_string(m, ',')) AS centroid_sha256
FROM a3 JOIN c3 ON c3.c = a3.c
""",
    "op6_embedding_near_dedup": """
WITH RECURSIVE v AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings WHERE label IS NOT NULL),
n AS MATERIALIZED (SELECT *, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS l FROM v),
edges AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM n a JOIN n b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE a.l > 0 AND b.l > 0 AND list_inner_product(a.e, b.e) / (a.l * b.l) >= 0.98),
reach AS (SELECT vec_id, vec_id AS r FROM embeddings UNION SELECT reach.vec_id, b FROM reach JOIN edges ON r = a)
SELECT e.vec_id, coalesce(d.n_links, 0)::BIGINT AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e JOIN (SELECT vec_id, min(r) AS component_id FROM reach GROUP BY vec_id) c ON c.vec_id = e.vec_id
LEFT JOIN (SELECT a, count(*) AS n_links FROM edges GROUP BY a) d ON d.a = e.vec_id
""",
}
