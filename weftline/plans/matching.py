"""Matching operators: events stand for plans (a window after each), orders and documents for works."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftline.functions import clean
from weftline.operators import match

from .base import query

_PAIRS = """
p AS (SELECT c_custkey AS plan_id, DATE '1995-01-01' + (c_custkey % 700)::INTEGER AS s, DATE '1996-06-01' + (c_custkey % 900)::INTEGER AS e, c_nationkey, c_mktsegment, c_custkey % 50 AS g FROM customer),
pe AS (SELECT plan_id, s, e, unnest(['person_id', 'grant_id', 'affiliation_name']) AS entity_type, unnest(['c' || plan_id, 'g' || g, c_mktsegment]) AS entity FROM p),
w AS (SELECT o_orderkey AS work_id, CAST(o_orderdate AS DATE) AS d, o_custkey, o_orderkey % 5000 AS g, c_mktsegment FROM orders LEFT JOIN customer ON c_custkey = o_custkey),
we AS (SELECT work_id, d, unnest(['person_id', 'grant_id', 'affiliation_name']) AS entity_type, unnest(['c' || o_custkey, 'g' || g, CASE WHEN o_custkey % 20 = 0 THEN c_mktsegment END]) AS entity FROM w),
m AS (SELECT plan_id, work_id, entity_type, entity, count(*) AS n FROM pe JOIN we USING (entity_type, entity) WHERE d BETWEEN s AND e GROUP BY ALL),
a AS (SELECT plan_id, work_id, sum(CASE WHEN entity_type = 'grant_id' THEN n ELSE 0 END)::BIGINT AS grant_id_count, sum(CASE WHEN entity_type = 'person_id' THEN n ELSE 0 END)::BIGINT AS person_id_count, sum(CASE WHEN entity_type = 'affiliation_name' THEN 1 ELSE 0 END)::BIGINT AS affiliation_name_count FROM m GROUP BY ALL),
f AS (SELECT *, (100 * grant_id_count + 5 * person_id_count + affiliation_name_count)::BIGINT AS weighted_count FROM a),
k AS (SELECT *, row_number() OVER (PARTITION BY plan_id ORDER BY weighted_count DESC, work_id) AS match_rank FROM f WHERE weighted_count >= 3 QUALIFY match_rank <= 20)"""


def _pairs(t):
    day = lambda d, k: F.date_add(F.lit(d).cast("date"), (F.col("c_custkey") % k).cast("int"))
    c = t("customer")
    plans = c.select(F.col("c_custkey").alias("plan_id"), day("1995-01-01", 700).alias("project_start"), day("1996-06-01", 900).alias("project_end"), F.array(F.concat(F.lit("c"), F.col("c_custkey").cast("string"))).alias("p"), F.array(F.concat(F.lit("g"), (F.col("c_custkey") % 50).cast("string"))).alias("g"), F.array("c_mktsegment").alias("a"))
    works = t("orders").join(c.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment"), "o_custkey", "left")
    works = works.select(F.col("o_orderkey").alias("work_id"), F.to_date("o_orderdate").alias("publication_date"), F.array(F.concat(F.lit("c"), F.col("o_custkey").cast("string"))).alias("p"), F.array(F.concat(F.lit("g"), (F.col("o_orderkey") % 5000).cast("string"))).alias("g"), F.array(F.when(F.col("o_custkey") % 20 == 0, F.col("c_mktsegment"))).alias("a"))
    kinds = {"person_id": "p", "grant_id": "g", "affiliation_name": "a"}
    got = match.entity_matches(match.entities(plans, ["plan_id", "project_start", "project_end"], kinds), match.entities(works, ["work_id", "publication_date"], kinds), k=20)
    return got.select("plan_id", "work_id", "grant_id_count", "person_id_count", "affiliation_name_count", "weighted_count", "match_rank")


@query(f"WITH {_PAIRS} SELECT * FROM k")
def entity_match(t):
    return _pairs(t).withColumn("match_rank", F.col("match_rank").cast("long"))


@query(f"WITH {_PAIRS} SELECT plan_id, string_agg(work_id || '=' || weighted_count, ',' ORDER BY match_rank) AS matches FROM k GROUP BY 1")
def topk_matches(t):
    got = match.matches_by_plan(_pairs(t))
    return got.select("plan_id", F.array_join(F.transform("matches", lambda m: F.concat_ws("=", m["work_id"].cast("string"), m["weighted_count"].cast("string"))), ",").alias("matches"))


_COS = "round(list_cosine_distance({a}::DOUBLE[], {b}::DOUBLE[]), 6)"


@query(f"""WITH {_PAIRS}, r AS (SELECT k.plan_id, k.work_id, weighted_count, {_COS.format(a="x.embedding", b="y.embedding")} AS distance FROM k LEFT JOIN embeddings x ON x.vec_id = k.plan_id % (SELECT count(*) FROM embeddings) LEFT JOIN embeddings y ON y.vec_id = k.work_id % (SELECT count(*) FROM embeddings))
SELECT plan_id, work_id, weighted_count, distance, round(weighted_count + 5 * coalesce(distance, 0), 6) AS vector_weighted FROM r""")
def vector_rerank(t):
    pairs = _pairs(t).select("plan_id", "work_id", "weighted_count")
    v = t("embeddings").select("vec_id", F.col("embedding").alias("vector"))
    n = t("embeddings").count()
    of = lambda d, c, name: d.select(F.col(c).alias(name), (F.col(c) % n).alias("vec_id")).join(v, "vec_id").select(name, "vector")
    got = match.reranked(pairs, of(t("customer"), "c_custkey", "plan_id"), of(t("orders"), "o_orderkey", "work_id"))
    return got.withColumn("distance", F.round("distance", 6)).withColumn("vector_weighted", F.round(F.col("weighted_count") + 5 * F.coalesce("distance", F.lit(0.0)), 6))


@query(f"""SELECT * FROM (SELECT q.vec_id AS query_id, b.vec_id AS base_id, {_COS.format(a="q.embedding", b="b.embedding")} AS distance, row_number() OVER (PARTITION BY q.vec_id ORDER BY {_COS.format(a="q.embedding", b="b.embedding")}, b.vec_id) AS rank
FROM embeddings q JOIN embeddings b ON q.vec_id % 100 = 0) WHERE rank <= 5""")
def vector_search(t):
    """Vectors of ids divisible by 100 are queries against all."""
    v = t("embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    return match.vector_search(v.where("id % 100 = 0"), v, 5).withColumn("rank", F.col("rank").cast("long"))


@query("""SELECT doc_id, text FROM documents WHERE doc_id NOT IN (SELECT vec_id FROM embeddings) ORDER BY doc_id LIMIT 100""")
def embed_batch(t):
    return match.to_embed(t("documents").select("doc_id", "text"), t("embeddings").select(F.col("vec_id").alias("doc_id")), "doc_id", 100)


@query("""
WITH a AS (SELECT p.c_custkey AS plan_id, o.o_orderkey AS work_id, 10.0::DOUBLE AS s, true AS must FROM customer p JOIN orders o ON o.o_custkey = p.c_custkey),
b AS (SELECT p.c_custkey, o.o_orderkey, 2.0::DOUBLE, false FROM customer p JOIN customer c ON c.c_nationkey = p.c_nationkey AND c.c_custkey = p.c_custkey JOIN orders o ON o.o_custkey = c.c_custkey),
u AS (SELECT plan_id, work_id, sum(s) AS score, bool_or(must) AS must FROM (SELECT * FROM a UNION ALL SELECT * FROM b) GROUP BY ALL),
f AS (SELECT u.plan_id, u.work_id, u.score FROM u JOIN orders ON o_orderkey = work_id WHERE must AND o_orderpriority <> '5-LOW' AND CAST(o_orderdate AS DATE) BETWEEN DATE '1994-01-01' AND DATE '1997-12-31')
SELECT plan_id, work_id, score, max(score) OVER (PARTITION BY plan_id) AS score_max, row_number() OVER (PARTITION BY plan_id ORDER BY score DESC, work_id) AS match_rank FROM f QUALIFY match_rank <= 10""")
def search_score(t):
    c, o = t("customer"), t("orders")
    plans = c.select(F.col("c_custkey").alias("plan_id"), F.array("c_custkey").alias("ids"), F.array(F.struct("c_custkey", "c_nationkey")).alias("places"), F.lit("1994-01-01").cast("date").alias("project_start"), F.lit("1994-12-31").cast("date").alias("project_end"))
    works = o.join(c.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey", "left").select(F.col("o_orderkey").alias("work_id"), F.array("o_custkey").alias("ids"), F.array(F.struct(F.col("o_custkey").alias("c_custkey"), "c_nationkey")).alias("places"), F.col("o_orderpriority").alias("work_type"), F.to_date("o_orderdate").alias("publication_date"))
    must = match.keyed_scores(plans, works, "awards", F.col("ids"), F.col("ids"), 10.0)
    should = match.keyed_scores(plans, works, "institutions", F.col("places"), F.col("places"), 2.0)
    return match.search([must], [should], works, plans, k=10, excluded="5-LOW").withColumn("match_rank", F.col("match_rank").cast("long"))


@query("""SELECT o_orderkey, greatest(0.0, CASE WHEN o_orderstatus = 'F' THEN 2.0 ELSE 0.0 END, CASE WHEN o_orderpriority LIKE '%URGENT%' THEN 1.0 ELSE 0.0 END)::DOUBLE AS score FROM orders""")
def dis_max(t):
    return t("orders").select("o_orderkey", match.best_of(F.when(F.col("o_orderstatus") == "F", 2.0), F.when(F.contains("o_orderpriority", F.lit("URGENT")), 1.0)).alias("score"))


_TOK = r"list_filter(regexp_split_to_array(replace(translate({x}, 'àáâãäåçèéêëìíîïñòóôõöøùúûüýÿāăąćčďđēęěğīįłńňōőřśšťūůűźżž', 'aaaaaaceeeeiiiinoooooouuuuyyaaaccddeeegiilnnoorsstuuuzzz'), 'ß', 'ss'), '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '')"


@query(f"""
WITH d AS (SELECT doc_id, {_TOK.format(x="lower(text)")} AS ws FROM documents), b AS (SELECT item_id, {_TOK.format(x="lower(text)")} AS ws FROM benchmark),
sz AS (SELECT count(*) AS docs, avg(len(ws)) AS mean FROM d WHERE len(ws) > 0),
ix AS (SELECT doc_id, term, count(*) AS tf, any_value(n) AS length FROM (SELECT doc_id, len(ws) AS n, unnest(ws) AS term FROM d) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM ix GROUP BY 1 HAVING count(*) >= 5),
idf AS (SELECT term, mean, ln(1 + (docs - df + 0.5) / (df + 0.5)) AS idf FROM df, sz),
q AS (SELECT item_id, term, idf, mean FROM (SELECT item_id, term, count(*) AS q FROM (SELECT item_id, unnest(ws) AS term FROM b) GROUP BY ALL) JOIN idf USING (term) QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY q * idf DESC, term) <= 25),
s AS (SELECT item_id, doc_id, round(sum(idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * length / mean))), 5) AS score FROM q JOIN ix USING (term) GROUP BY ALL)
SELECT item_id, doc_id, score FROM s QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 10""")
def more_like_this(t):
    scores = match.more_like_this(t("benchmark").select("item_id", "text"), t("documents").select("doc_id", "text"), "item_id", "doc_id", "text")
    return match.top_k(scores.withColumn("score", F.round("score", 5)), ["item_id"], 10, F.desc("score"), F.col("doc_id"))


@query(f"""SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN n >= 3 WHEN 1 THEN n >= 7 ELSE false END AS found FROM (SELECT doc_id, len({_TOK.format(x='lower(text)')}) AS n FROM documents)""")
def phrase_match(t):
    """Words of a document's own text: the third to fifth, the third and seventh (three others between), and one that is not there."""
    rows = t("documents").select("doc_id", "text", match.tokens(F.col("text")).alias("ws"))
    third = F.get("ws", F.lit(2))
    words = F.when(F.col("doc_id") % 3 == 0, F.slice("ws", 3, 3)).when(F.col("doc_id") % 3 == 1, F.array(third, F.get("ws", F.lit(6)))).otherwise(F.array(third, F.lit("zzzznotaword")))
    return rows.select("doc_id", match.phrase(F.col("text"), words).alias("found"))


@query(r"""SELECT doc_id, replace(regexp_replace(chr(1) || regexp_replace(text, '([^\p{L}\p{N}_])', chr(1) || '\1' || chr(1), 'g') || chr(1), '(?i)' || chr(1) || '(of|und|que)' || chr(1), '<mark>\1</mark>', 'g'), chr(1), '') AS text FROM documents""")
def highlight(t):
    return t("documents").select("doc_id", match.highlighted(F.col("text"), F.array(F.lit("of"), F.lit("und"), F.lit("que"))).alias("text"))


@query("""
WITH x AS (SELECT p.c_custkey AS plan_id, o.o_orderkey AS work_id, p.c_nationkey = s.c_nationkey AS same_nation, p.c_mktsegment = s.c_mktsegment AS same_segment, o.o_orderkey % 97 = p.c_custkey % 97 AS same_grant, o.o_orderkey % 5 = 0 AS same_repo
  FROM customer p JOIN orders o ON o.o_custkey = p.c_custkey JOIN customer s ON s.c_custkey = o.o_custkey + 1),
y AS (SELECT *, 2 + same_nation::INT + 2 * same_segment::INT + same_repo::INT AS base FROM x)
SELECT plan_id, work_id, CASE WHEN same_grant THEN 100 ELSE base END::INT AS score, CASE WHEN same_grant THEN 'Absolute' WHEN base > 10 THEN 'High' WHEN base > 5 THEN 'Medium' ELSE 'Low' END AS confidence FROM y""")
def comparator(t):
    c, o = t("customer"), t("orders")
    s = c.select(F.col("c_custkey").alias("sk"), F.col("c_nationkey").alias("sn"), F.col("c_mktsegment").alias("sm"))
    pairs = c.join(o, F.col("c_custkey") == F.col("o_custkey")).join(s, F.col("sk") == F.col("o_custkey") + 1)
    none = F.lit(None).cast("string")
    side = {
        "p_grant_ids": F.array(F.col("c_custkey") % 97), "w_grant_ids": F.array(F.col("o_orderkey") % 97), "p_opportunity_ids": F.array(F.lit(-1).cast("long")),
        "p_people_ids": F.array("c_custkey"), "w_people_ids": F.array("o_custkey"), "p_people": F.array("c_mktsegment"), "w_people": F.array("sm"),
        "p_affiliation_ids": F.array("c_nationkey"), "w_affiliation_ids": F.array("sn"), "p_affiliations": F.array(F.lit("a")), "w_affiliations": F.array(F.lit("b")),
        "p_repo_ids": F.array(F.lit(0).cast("long")), "w_repo_ids": F.array(F.col("o_orderkey") % 5), "p_title": none, "w_title": none, "p_description": none, "w_description": none,
    }
    got = match.compared(pairs.select(F.col("c_custkey").alias("plan_id"), F.col("o_orderkey").alias("work_id"), *[v.alias(k) for k, v in side.items()]))
    return got.select("plan_id", "work_id", "score", "confidence")


@query(r"""
WITH w AS (SELECT p_partkey, 1 AS side, unnest(string_split_regex(upper(p_name), '\s+')) AS w FROM part UNION ALL SELECT p_partkey, 2, unnest(string_split_regex(upper(p_type), '\s+')) FROM part),
g AS (SELECT p_partkey, side, unnest(list_transform(range(1, len(w)), lambda i: substr(w, i, 2))) AS pair FROM w WHERE len(w) > 1),
n AS (SELECT p_partkey, pair, count(*) FILTER (side = 1) AS a, count(*) FILTER (side = 2) AS b FROM g GROUP BY ALL)
SELECT p_partkey, round(2.0 * sum(least(a, b)) / sum(a + b), 6) AS similarity FROM n GROUP BY 1""")
def white_similarity(t):
    return t("part").select("p_partkey", F.round(clean.pair_similarity(F.col("p_name"), F.col("p_type")), 6).alias("similarity"))
