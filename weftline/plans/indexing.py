"""Index-building operators over the given tables: orders and lines stand for works and their children."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftline.functions import clean
from weftline.operators import audit, index

from .base import query


@query("SELECT user_id, event_id, ts, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id) = 1")
def dedupe_latest(t):
    return index.latest_per_key(t("events").select("user_id", "event_id", "ts", "event_type"), "user_id", "ts", "event_id")


@query("""
WITH base AS (SELECT * FROM orders o WHERE o_orderkey NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)),
n AS (SELECT l_orderkey, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_suppkey) AS suppliers, count(DISTINCT l_returnflag) AS flags FROM lineitem GROUP BY 1),
c AS (SELECT b.o_orderkey AS id, b.o_custkey AS key, coalesce(parts, 0) AS parts, coalesce(suppliers, 0) AS suppliers, coalesce(flags, 0) AS flags, count(*) OVER (PARTITION BY b.o_custkey) AS doi_count FROM base b LEFT JOIN n ON l_orderkey = o_orderkey),
r AS (SELECT *, parts + suppliers + flags AS total_count, row_number() OVER (PARTITION BY key ORDER BY parts + suppliers + flags DESC, id) AS doi_rank FROM c)
SELECT *, doi_count > 1 AS is_duplicate, doi_rank = 1 AS is_primary_doi FROM r""")
def works_metadata(t):
    """Anti-join, counts of distinct children, rank and duplicate flags; the children are counted before they are joined."""
    base = t("orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("key")).join(t("labels").select(F.col("doc_id").alias("id")), "id", "left_anti")
    lines = t("lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.size(F.collect_set("l_partkey")).cast("long").alias("parts"), F.size(F.collect_set("l_suppkey")).cast("long").alias("suppliers"), F.size(F.collect_set("l_returnflag")).cast("long").alias("flags"))
    counts = base.join(lines, "id", "left").fillna(0, ["parts", "suppliers", "flags"])
    return index.ranked_duplicates(counts, "key", "id", ["parts", "suppliers", "flags"])


@query("""SELECT source AS doi, arg_min(doc_id, (-n, doc_id)) AS id, max(n) AS length FROM (SELECT source, doc_id, length(text) AS n FROM documents WHERE source IS NOT NULL) GROUP BY 1""")
def longest_text(t):
    rows = t("documents").where("source is not null").select(F.col("source").alias("doi"), F.col("doc_id").alias("id"), F.length("text").cast("long").alias("length"))
    return index.longest(rows, "length")


@query("""SELECT d.doc_id, CASE WHEN length(b.text) > length(d.text) OR (b.text IS NOT NULL AND d.text IS NULL) THEN b.text ELSE d.text END AS text FROM documents d LEFT JOIN benchmark b ON d.doc_id = b.item_id""")
def longest_text_pick(t):
    b = t("benchmark").select(F.col("item_id").alias("doc_id"), F.col("text").alias("other"))
    both = t("documents").select("doc_id", "text").join(b, "doc_id", "left")
    return both.select("doc_id", index.strictly_longer(F.col("text"), F.length("text"), F.col("other"), F.length("other")).alias("text"))


@query("""SELECT key, max(newest) AS newest FROM (SELECT o_orderkey AS key, o_orderdate AS newest FROM orders UNION ALL SELECT l_orderkey, l_shipdate FROM lineitem) WHERE newest IS NOT NULL GROUP BY 1""")
def latest_of_union(t):
    return index.newest_of("key", "newest", t("orders").select(F.col("o_orderkey").alias("key"), F.col("o_orderdate").alias("newest")), t("lineitem").select(F.col("l_orderkey").alias("key"), F.col("l_shipdate").alias("newest")))


@query("""SELECT p_brand, string_agg(p_type, '|' ORDER BY lower(p_type), p_type) AS types FROM (SELECT DISTINCT p_brand, p_type FROM part WHERE p_type IS NOT NULL) GROUP BY 1""")
def distinct_list(t):
    return t("part").groupBy("p_brand").agg(F.array_join(clean.distinct_sorted(F.col("p_type")), "|").alias("types"))


@query("""SELECT l_orderkey, string_agg(l_partkey || ':' || l_suppkey, ',' ORDER BY l_linenumber, l_partkey, l_suppkey) AS lines FROM lineitem GROUP BY 1""")
def ordered_list(t):
    line = F.concat_ws(":", F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"))
    return t("lineitem").groupBy("l_orderkey").agg(F.array_join(clean.in_order(F.struct("l_linenumber", "l_partkey", "l_suppkey"), line), ",").alias("lines"))


@query("""SELECT l_returnflag, l_linestatus, kind, count(*) AS n, round(sum(v), 2) AS total FROM (
  SELECT l_returnflag, l_linestatus, unnest(['quantity', 'discount', 'tax']) AS kind, unnest([l_quantity, l_discount, l_tax]) AS v FROM lineitem) GROUP BY ALL""")
def unpivot_relations(t):
    items = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(f"l_{k}").alias("v")) for k in ("quantity", "discount", "tax")])
    rows = t("lineitem").select("l_returnflag", "l_linestatus", F.explode(items).alias("x"))
    return rows.groupBy("l_returnflag", "l_linestatus", "x.kind").agg(F.count("*").alias("n"), F.round(F.sum("x.v"), 2).alias("total"))


@query(r"""SELECT conv_id, turn, s.i AS sentence, nullif(string_split_regex(s.line, '[ ]+')[1], '') AS first_word FROM (
  SELECT conv_id, turn, unnest(list_transform(string_split(text, '.'), lambda x, i: {'i': i, 'line': x})) AS s FROM conversations)""")
def explode_double(t):
    rows = t("conversations").select("conv_id", "turn", F.posexplode_outer(F.split("text", r"\.", -1)).alias("i", "line"))
    return rows.select("conv_id", "turn", (F.col("i") + 1).cast("long").alias("sentence"), F.nullif(F.split("line", "[ ]+")[0], F.lit("")).alias("first_word"))


@query("""SELECT c_custkey, n_name, r_name FROM (SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_nationkey END AS k FROM customer) LEFT JOIN nation ON k = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""")
def crosswalk_left(t):
    """Ids looked up in small registries, which Spark broadcasts by their size; a NULL id keeps its row."""
    c = t("customer").select("c_custkey", F.when(F.col("c_custkey") % 10 != 0, F.col("c_nationkey")).alias("n_nationkey"))
    return c.join(t("nation"), "n_nationkey", "left").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"), "left").select("c_custkey", "n_name", "r_name")


@query("""SELECT o_orderkey, string_agg(coalesce(n_name, 'x') || '/' || coalesce(s_name, '?'), ';' ORDER BY l_linenumber, s_name) AS funders FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN supplier ON s_suppkey = CASE WHEN l_linenumber % 2 = 0 THEN l_suppkey END LEFT JOIN nation ON s_nationkey = n_nationkey GROUP BY 1""")
def funder_crosswalk(t):
    """Lists of (id, name) looked up in a registry, in order, unknown ids kept."""
    ids = F.when(F.col("l_linenumber") % 2 == 0, F.col("l_suppkey"))
    lists = t("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(clean.in_order(F.col("l_linenumber"), F.struct(ids.alias("id"), F.col("l_linenumber").alias("name"))).alias("items")).join(t("orders").select("o_orderkey"), "o_orderkey", "left_semi")
    registry = t("supplier").join(t("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    got = index.crosswalk(lists, ["o_orderkey"], "items", "id", "name", registry, "s_suppkey", F.concat_ws("/", F.coalesce("n_name", F.lit("x")), F.coalesce("s_name", F.lit("?"))))
    return got.select("o_orderkey", F.array_join(F.transform("items", lambda x: F.coalesce(x["ror"], F.lit("x/?"))), ";").alias("funders"))


@query("""
SELECT 'customer/' || c_custkey AS doi, c_name AS title, coalesce(upper(c_mktsegment), 'OTHER') AS work_type, n_name AS venue, coalesce(o.n, 0) AS awards, o.last AS updated, 'customers' AS source
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN (SELECT o_custkey, count(*) AS n, max(o_orderdate) AS last FROM orders GROUP BY 1) o ON o_custkey = c_custkey
UNION ALL SELECT 'supplier/' || s_suppkey, s_name, 'OTHER', n_name, coalesce(l.n, 0), l.last, 'suppliers'
FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN (SELECT l_suppkey, count(*) AS n, max(l_shipdate) AS last FROM lineitem GROUP BY 1) l ON l_suppkey = s_suppkey""")
def index_assembly(t):
    """A star of left joins for each of two sources, and their union by name."""

    def side(df, key, title, kind, nation, counts, ckey, when, source):
        c = counts.groupBy(F.col(ckey).alias(key)).agg(F.count("*").alias("n"), F.max(when).alias("updated"))
        return df.join(t("nation"), F.col(nation) == F.col("n_nationkey"), "left").join(c, key, "left").select(F.concat(F.lit(f"{source}/"), F.col(key).cast("string")).alias("doi"), F.col(title).alias("title"), F.coalesce(kind, F.lit("OTHER")).alias("work_type"), F.col("n_name").alias("venue"), F.coalesce("n", F.lit(0)).cast("long").alias("awards"), "updated", F.lit(f"{source}s").alias("source"))

    a = side(t("customer"), "c_custkey", "c_name", F.upper("c_mktsegment"), "c_nationkey", t("orders"), "o_custkey", "o_orderdate", "customer")
    b = side(t("supplier"), "s_suppkey", "s_name", F.lit(None).cast("string"), "s_nationkey", t("lineitem"), "l_suppkey", "l_shipdate", "supplier")
    return index.union_by_name(a, b)


@query("""
SELECT 'number_of_rows' AS audit, '' AS "column", greatest(100000000 - count(*), 0)::BIGINT AS failures, false AS blocking FROM documents
UNION ALL SELECT 'not_empty_string', 'text', count(*) FILTER (text = ''), true FROM documents
UNION ALL SELECT 'accepted_values', 'lang', count(*) FILTER (lang NOT IN ('en', 'de', 'fr')), true FROM documents
UNION ALL SELECT 'unique_values', 'doc_id', count(*), true FROM (SELECT doc_id FROM documents WHERE doc_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'unique_values', 'source', count(*), true FROM (SELECT source FROM documents WHERE source IS NOT NULL GROUP BY 1 HAVING count(*) > 1)""")
def audits(t):
    return audit.audited(t("documents"), [audit.number_of_rows(100_000_000, blocking=False), audit.not_empty_string("text"), audit.accepted_values("lang", ["en", "de", "fr"]), audit.unique_values("doc_id", "source")])
