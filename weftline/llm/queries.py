"""Queries over the given tables, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import ann, chat, lm, media, mixing, packing, secrets, simhash, substring, toxicity
from .common import read


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"))


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.render(read(spark, sf_dir, "conversations"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.schedule(read(spark, sf_dir, "documents"))


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.scores(read(spark, sf_dir, "documents"))


def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries are the vectors whose id is divisible by 100, against all."""
    return ann.neighbours(read(spark, sf_dir, "embeddings"), every=ann.EVERY)


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.findings(read(spark, sf_dir, "documents"))


def op7_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.copies(media.media_table(read(spark, sf_dir, "embeddings")))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.offending(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op9_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.repeats(read(spark, sf_dir, "documents"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.groups(read(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_packing, op2_chat, op3_mixing, op4_lm_scoring, op5_neighbours, op6_secrets, op7_media, op8_toxicity, op9_substring, op10_simhash, pipeline)}

# the same two-level order, as one window over each source
MIXING_SQL = r"""
WITH d AS (
  SELECT doc_id, source, tokens, md5(coalesce(doc_id::VARCHAR, '') || CASE WHEN copy > 0 THEN ':' || copy ELSE '' END) AS key FROM (
    SELECT *, row_number() OVER (PARTITION BY doc_id, source, tokens) - 1 AS copy FROM (
      SELECT doc_id, coalesce(source, '') AS source, greatest(coalesce(len(regexp_extract_all(text, '\S+')), 0), 1) AS tokens FROM documents))),
c AS (
  SELECT *, coalesce(sum(tokens) OVER (PARTITION BY source ORDER BY key, doc_id NULLS LAST, tokens ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS c FROM d),
s AS (SELECT source, sum(tokens)::DOUBLE AS supply FROM d GROUP BY 1),
r AS (SELECT source, supply, supply AS r0, sqrt(supply * sqrt(supply)) AS r1, sqrt(supply) AS r2 FROM s),
w AS (SELECT source, supply, r0 / sum(r0) OVER () AS w0, r1 / sum(r1) OVER () AS w1, r2 / sum(r2) OVER () AS w2 FROM r),
k AS (SELECT *, (w0 + w1) * 0.25 AS c1, (w0 + w1) * 0.25 + (w1 + w2) * 0.25 AS c2 FROM w),
p AS (SELECT *, max(supply / c2) OVER () AS budget FROM k),
e AS (
  SELECT c.doc_id, c.source, c.tokens, unnest(range(0, ceil((budget * c2 - 0.5 - c.c) / supply)::BIGINT)) AS epoch, c.c, p.* EXCLUDE (source)
  FROM c JOIN p USING (source) WHERE ceil((budget * c2 - 0.5 - c.c) / supply) > 0),
f AS (SELECT *, (epoch * supply + c) / budget AS share FROM e),
t AS (
  SELECT *, share >= c1 AS late, CASE WHEN share < c1 THEN share ELSE share - c1 END AS q,
    CASE WHEN share < c1 THEN w0 ELSE w1 END AS a, CASE WHEN share < c1 THEN w1 ELSE w2 END AS b FROM f)
SELECT doc_id, source, tokens::BIGINT AS tokens, epoch::INTEGER AS epoch,
  round(least(CASE WHEN late THEN 0.5 ELSE 0.0 END + CASE WHEN q > 0 THEN q * 2 / (a + sqrt(greatest(a * a + q * (b - a) * 4.0, 0.0))) ELSE 0.0 END, CASE WHEN late THEN 1.0 ELSE 0.5 END), 9) AS position
FROM t ORDER BY position, source, doc_id NULLS LAST, epoch
"""

# every pair compared; components by following the smallest reachable id
SIMHASH_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM (
    SELECT doc_id, regexp_extract_all(lower(text), '[a-z0-9_\x{80}-\x{10ffff}]+') AS ws FROM documents WHERE doc_id IS NOT NULL)),
h AS (
  SELECT doc_id, i, word, ('0x' || substr(md5(word), 1, 16))::UBIGINT AS hi, ('0x' || substr(md5(word), 17, 16))::UBIGINT AS lo FROM w),
n AS (SELECT doc_id, count(*) AS n FROM h GROUP BY 1),
bits AS (SELECT unnest(range(0, 64)) AS bit),
tf AS (SELECT doc_id, hi, CAST(round(16 * sqrt(count(*))) AS BIGINT) AS weight FROM h GROUP BY doc_id, word, hi),
u AS (
  SELECT doc_id, sum(b)::UBIGINT AS u FROM (
    SELECT doc_id, CASE WHEN sum(CASE WHEN (hi >> bit::UBIGINT) & 1 = 1 THEN weight ELSE -weight END) > 0 THEN CAST(pow(2, bit) AS HUGEINT) ELSE 0 END AS b
    FROM tf, bits GROUP BY doc_id, bit) GROUP BY 1),
g AS (
  SELECT DISTINCT doc_id, word, next, xor(hi, nlo) AS p1, xor(lo, nhi) AS p2 FROM (
    SELECT doc_id, word, hi, lo, lead(word) OVER o AS next, lead(hi) OVER o AS nhi, lead(lo) OVER o AS nlo FROM h WINDOW o AS (PARTITION BY doc_id ORDER BY i)) WHERE next IS NOT NULL),
v AS (
  SELECT doc_id, sum(b1)::UBIGINT AS b1, sum(b2)::UBIGINT AS b2 FROM (
    SELECT doc_id, CASE WHEN sum(CASE WHEN (p1 >> bit::UBIGINT) & 1 = 1 THEN 1 ELSE -1 END) > 0 THEN CAST(pow(2, bit) AS HUGEINT) ELSE 0 END AS b1,
      CASE WHEN sum(CASE WHEN (p2 >> bit::UBIGINT) & 1 = 1 THEN 1 ELSE -1 END) > 0 THEN CAST(pow(2, bit) AS HUGEINT) ELSE 0 END AS b2
    FROM g, bits GROUP BY doc_id, bit) GROUP BY 1),
f AS (SELECT doc_id, n, u, coalesce(b1, 0::UBIGINT) AS b1, coalesce(b2, 0::UBIGINT) AS b2 FROM n JOIN u USING (doc_id) LEFT JOIN v USING (doc_id)),
e AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM f x JOIN f y ON x.doc_id <> y.doc_id
    AND bit_count(xor(x.u, y.u)) <= 9 AND bit_count(xor(x.b1, y.b1)) + bit_count(xor(x.b2, y.b2)) <= 30
    AND least(x.n, y.n) >= 0.8 * greatest(x.n, y.n)),
reach(a, b) AS (SELECT a, b FROM e UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a)
SELECT a AS doc_id, min(b) AS keep_id FROM reach GROUP BY a HAVING min(b) < a
"""

# every query against every vector; at sf0.01 the relaxed search looks at all of them too
NEIGHBOURS_SQL = """
WITH d AS (
  SELECT q.vec_id AS query_id, b.vec_id AS neighbour_id,
    round(sqrt(greatest(2 - 2 * list_cosine_similarity(q.embedding::DOUBLE[], b.embedding::DOUBLE[]), 0)), 6) AS distance
  FROM embeddings q JOIN embeddings b ON q.vec_id % 100 = 0 AND b.vec_id <> q.vec_id)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbour_id)::INTEGER AS rank, neighbour_id, distance FROM d QUALIFY rank <= 10
"""

SQL = {"op5_neighbours": NEIGHBOURS_SQL, "op2_chat": chat.CHATML_SQL, "op3_mixing": MIXING_SQL, "op10_simhash": SIMHASH_SQL}
