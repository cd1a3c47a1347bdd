"""Record-keeping operators: facets, pages, histograms, versions, upserts and merges."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftline.operators import hub, match
from weftline.sources import sinks
from weftline.streaming import changes

from .base import query


@query("""
WITH hit AS (SELECT DISTINCT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING' OR c_nationkey IN (3, 7))
SELECT pk, title, modified FROM (
  SELECT c_custkey AS pk, c_name AS title, c_acctbal AS modified, row_number() OVER (ORDER BY c_acctbal DESC NULLS LAST, c_custkey) AS r, count(*) OVER () AS n
  FROM customer WHERE c_custkey IN (SELECT * FROM hit) AND contains(lower(c_name), '1')) WHERE (r - 1) // 25 + 1 = least(2, ceil(n / 25.0))""")
def facet_page(t):
    """Records under any of two facets, filtered by text, the second page of 25 (or the last) by newest first."""
    c = t("customer").select(F.col("c_custkey").alias("pk"), F.col("c_name").alias("title"), F.col("c_acctbal").alias("modified"), "c_mktsegment", "c_nationkey")
    lists = match.entities(c.select("pk", F.array(F.lower("c_mktsegment")).alias("s"), F.array(F.col("c_nationkey").cast("string")).alias("n")), ["pk"], {"ORG": "s", "FUNDER": "n"}).select(F.col("entity_type").alias("kind"), F.col("entity").alias("value"), "pk")
    found = c.select("pk", "title", "modified").join(hub.facets(lists, {"ORG": ["BUILDING"], "FUNDER": ["3", "7"]}), "pk", "left_semi")
    return hub.page(hub.sorted_by(hub.containing(found, "1", "title")), number=2)[0]


@query("""SELECT year(o_orderdate) AS year, count(*) AS n, count(*) FILTER (o_orderstatus = 'O') AS open, count(*) FILTER (o_orderstatus <> 'O') AS closed FROM orders GROUP BY 1""")
def histogram(t):
    return t("orders").groupBy(F.year("o_orderdate").cast("long").alias("year")).agg(F.count("*").alias("n"), F.count_if(F.col("o_orderstatus") == "O").alias("open"), F.count_if(F.col("o_orderstatus") != "O").alias("closed"))


@query("""
WITH u AS (SELECT user_id AS pk, event_id, ts, event_type = 'view' AS own, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events)
SELECT pk::VARCHAR AS pk, 'VERSION#' || strftime(before, '%Y-%m-%dT%H:%M:%S') AS sk, before AS modified FROM u WHERE before IS NOT NULL AND NOT (own AND epoch_us(ts) - epoch_us(before) <= 3600000000)""")
def version_snapshot(t):
    e = t("events").select(F.col("user_id").cast("string").alias("pk"), F.col("event_id").alias("seq"), F.col("ts").alias("modified"), F.lit("view").alias("owner"), F.col("event_type").alias("updater"))
    return hub.versions(e)


@query("""
WITH last AS (SELECT * FROM events WHERE event_type <> 'error' QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
SELECT DISTINCT kind, value, user_id::VARCHAR AS pk FROM (SELECT user_id, event_type, unnest(['PERSON', 'AFFILIATION']) AS kind, unnest([event_type, json_extract_string(props, '$.k')]) AS value FROM last WHERE event_type <> 'click') WHERE value IS NOT NULL""")
def change_upsert(t):
    """Inverted lists after two batches of a change stream; clicks remove a record, errors are of no interest."""
    e = t("events")
    events = e.select(F.when(F.col("event_type") == "click", "REMOVE").otherwise("MODIFY").alias("event_name"), F.col("user_id").cast("string").alias("pk"), F.when(F.col("event_type") == "error", "METADATA").otherwise("VERSION#latest").alias("sk"), F.col("event_id").alias("seq"), F.col("ts").alias("modified"), F.lit(None).cast("string").alias("title"), F.lit(None).cast("string").alias("abstract"), F.array("event_type").alias("people"), F.array(F.get_json_object("props", "$.k")).alias("affiliations"), F.array().cast("array<string>").alias("funders"), "ts")
    cut = F.lit("2024-01-15").cast("timestamp")
    first, second = events.where(F.col("ts") < cut).drop("ts"), events.where(F.col("ts") >= cut).drop("ts")
    before = changes.postings(changes.last_by_key(changes.relevant(first)).where("event_name <> 'REMOVE'"))
    return changes.applied(before, second).select("kind", "value", "pk")


@query("""SELECT c_custkey AS pk, coalesce(n.name, c_name) AS name, c_mktsegment AS segment FROM customer LEFT JOIN (SELECT o_custkey, CASE WHEN max(o_orderkey) % 2 = 0 THEN 'order ' || max(o_orderkey) END AS name FROM orders GROUP BY 1) n ON o_custkey = c_custkey
UNION ALL SELECT 1000000000 + s_suppkey, s_name, NULL FROM supplier""")
def merge_patch(t):
    old = t("customer").select(F.col("c_custkey").alias("pk"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    last = t("orders").groupBy(F.col("o_custkey").alias("pk")).agg(F.max("o_orderkey").alias("k"))
    new = last.join(old.select("pk"), "pk", "left_semi").select("pk", F.when(F.col("k") % 2 == 0, F.concat(F.lit("order "), F.col("k").cast("string"))).alias("name"), F.lit("ignored").alias("segment"))
    more = t("supplier").select((F.col("s_suppkey") + 1000000000).alias("pk"), F.col("s_name").alias("name"), F.lit(None).cast("string").alias("segment"))
    return hub.merge_patch(old, new.unionByName(more), "pk", kept=("segment",))


@query("""SELECT c_custkey AS doi, CASE WHEN c_custkey % 3 = 0 THEN upper(c_name) ELSE c_name END AS title, c_acctbal AS score FROM customer""")
def partial_upsert(t):
    old = t("customer").select(F.col("c_custkey").alias("doi"), F.col("c_name").alias("title"), F.col("c_acctbal").alias("score"))
    new = old.select("doi", F.when(F.col("doi") % 3 == 0, F.upper("title")).alias("title"))
    return sinks.upserted(old, new, "doi")


@query("""SELECT o_orderkey AS k, o_orderstatus AS v FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') UNION ALL SELECT DISTINCT l_orderkey, 'R' FROM lineitem WHERE l_returnflag = 'R'""")
def merge_by_key(t):
    new = t("lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("k"), F.lit("R").alias("v")).distinct()
    return sinks.merged(t("orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("v")), new, ["k"])


@query("""SELECT c_custkey FROM customer WHERE c_custkey % 7 = 0 OR c_custkey % 11 = 0""")
def changed_keys(t):
    old = t("customer")
    new = old.withColumn("c_name", F.when(F.col("c_custkey") % 7 == 0, F.lower("c_name")).otherwise(F.col("c_name"))).withColumn("c_acctbal", F.col("c_acctbal") + 1)
    return hub.changed(old.where("c_custkey % 11 <> 0"), new, "c_custkey", ignored=("c_acctbal",))


@query("""SELECT count(*) AS documents, min(n)::BIGINT AS least, max(n)::BIGINT AS most, sum(n)::BIGINT AS total, avg(n) AS mean FROM (SELECT strlen('{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '"}') AS n FROM customer)""")
def document_sizes(t):
    return sinks.document_sizes(t("customer").select("c_custkey", "c_name"))


@query("""SELECT o_custkey AS pk, o_orderkey AS missing FROM orders WHERE o_orderkey NOT IN (SELECT doc_id FROM documents WHERE doc_id IS NOT NULL)""")
def reconciliation(t):
    o = t("orders").select(F.col("o_orderkey").alias("missing"), F.col("o_custkey").alias("pk"))
    lost = hub.missing(o, t("documents").select(F.col("doc_id").alias("missing")), key="missing")[0]
    return o.join(lost, "missing", "left_semi").select("pk", "missing")
