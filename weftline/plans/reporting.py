"""Reports, repairs and search assembly over records made of the given tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from weftline.operators import enrich, hub, match, reports, searching
from weftline.sources import readers, sinks

from .base import query
from .registry import _lines, _s


def _related(c: Column) -> Column:
    """Three identifiers: a narrative of every third record, a DOI without citation, a cited one."""
    item = lambda d, w, t, i, z: F.struct(F.lit(d).alias("descriptor"), F.lit(w).alias("work_type"), F.lit(t).alias("type"), i.alias("identifier"), F.lit(z).alias("citation"))
    rest = F.array(item("cites", "dataset ", "doi", _s(" 10.1/x​", c % 10), " "), item("cites", "article", "doi", _s("10.1/y", c), "Known."))
    return F.when(c % 3 == 0, F.concat(F.array(item("is_metadata_for", "output_management_plan", "doi", _s("10.1/n", c), None)), rest)).when(c % 3 == 1, rest)


def _records(t) -> DataFrame:
    c = F.col("c_custkey")
    return t("customer").select(
        _s("DMP#", c).alias("pk"), F.when(c % 7 == 0, "VERSION#old").otherwise("VERSION#latest").alias("sk"), _s("doi.org/10.9999/D", c).alias("dmp_id"), F.col("c_name").alias("title"), _s(" about\t\r\n", F.col("c_mktsegment"), " ").alias("description"), F.lit("2024-01-01").alias("created"), _s("2024-02-", c % 28 + 1).alias("modified"), F.lit(None).cast("string").alias("registered"),
        F.when(c % 2 == 0, "public").otherwise("private").alias("visibility"), F.lit("1994-01-01").alias("project_start"), F.lit("1995-01-01").alias("project_end"), F.when(c % 5 > 0, F.array(_s("r", F.col("c_nationkey")), _s("r", c % 4))).alias("affiliation_ids"), F.array("c_mktsegment").alias("affiliations"),
        *[F.array(_s(n, c)).alias(n) for n in ("people", "people_ids", "funders", "funder_ids", "funder_opportunity_ids", "grant_ids", "repos", "repo_ids")], _related(c).alias("related"),
    )


@query("SELECT 'DMP#' || c_custkey AS pk FROM customer WHERE c_custkey % 5 > 0 AND (c_nationkey IN (3, 7) OR c_custkey % 4 = 3)")
def partner_dump(t):
    """Records of partner organisations: any id of a list in another."""
    return reports.of_organisations(_records(t), ["r3", "r7"]).select("pk")


@query("SELECT 'DMP#' || c_custkey AS tool_id, 'https://doi.org/10.9999/D' || c_custkey AS dmp_id, c_name AS title, 'about ' || c_mktsegment AS abstract, CASE WHEN c_custkey % 2 = 0 THEN 'public' ELSE 'private' END AS dmp_visibility, 'people' || c_custkey AS people, 'repo_ids' || c_custkey AS repository_ids, 20 AS fields FROM customer")
def flat_plans(t):
    got = reports.flat_export(_records(t))
    return got.select("tool_id", "dmp_id", "title", "abstract", "dmp_visibility", F.array_join("people", ";").alias("people"), F.array_join("repository_ids", ";").alias("repository_ids"), F.lit(len(got.columns)).alias("fields"))


@query("""SELECT 'https://D' || l_orderkey AS dmp_id, 'w' || l_partkey AS id, arg_min(l_returnflag || l_linenumber, (l_linenumber, l_returnflag)) AS work_type, arg_min(l_quantity, (l_linenumber, l_returnflag, l_quantity)) AS score FROM lineitem GROUP BY ALL""")
def harvested_report(t):
    """Maps of related works turned into rows; the first record of a plan that has a work counts."""
    line = t("lineitem").groupBy("l_orderkey", "l_linenumber", "l_returnflag", "l_partkey").agg(F.min("l_quantity").alias("l_quantity")).groupBy("l_orderkey", "l_linenumber", "l_returnflag").agg(F.map_from_entries(F.array_sort(F.collect_set(F.struct(_s("w", F.col("l_partkey")), F.struct(_s(F.col("l_returnflag"), F.col("l_linenumber")).alias("work_type"), F.col("l_quantity").alias("score")))))).alias("related_works"))
    return reports.harvested_outputs(line.select(_s("PK#D", F.col("l_orderkey")).alias("pk"), F.struct("l_linenumber", "l_returnflag").alias("sk"), "related_works"))


@query("""
WITH m AS (SELECT c_custkey AS c, o_orderkey AS k, c_nationkey AS n, o_totalprice / 10000 AS w, o_orderpriority AS p FROM customer JOIN orders ON o_custkey = c_custkey)
SELECT 'https://D' || c AS dmp_id, c % 50 = 0 AS is_pilot_dmp, a AS affiliation_id, n_name AS affiliation_name, 'https://doi.org/10.1/' || k AS related_work, 'vol: ' || (k % 9) || CASE WHEN k % 3 > 0 THEN ', pgs: ' || p ELSE '' END AS location, 'Ann Berg | ' || p AS authors, round(w, 6) AS weighted_score
FROM (SELECT *, 'r' || n AS a FROM m WHERE w >= 10 AND k % 4 > 0 AND k % 2 = 1) JOIN nation ON n_nationkey = n WHERE n_nationkey < 12""")
def match_report(t):
    c, k, p = F.col("c_custkey"), F.col("o_orderkey"), F.col("o_orderpriority")
    text = F.lit(None).cast("string")
    person = lambda g, f: F.struct(g.alias("given"), f.alias("family"))
    one = F.struct(_s("10.1/", k).alias("match_doi"), (F.col("o_totalprice") / 10000).alias("weighted_count"), F.array(F.when(k % 2 == 1, _s("r", F.col("c_nationkey"))).otherwise("x")).alias("affiliation_ids"), F.when(k % 4 > 0, p).alias("title"), p.alias("type"), p.alias("container_title"), text.alias("publisher"), text.alias("publication_date"), _s(k % 9).alias("volume"), text.alias("issue"), F.when(k % 3 > 0, p).alias("page"), F.array(person(F.lit("Ann"), F.lit("Berg")), person(text, p)).alias("authors"))
    lines = t("customer").join(t("orders"), c == F.col("o_custkey")).groupBy("c_custkey", "c_nationkey").agg(F.collect_list(one).alias("matches"))
    lines = lines.select(_s("DMP#D", c).alias("dmp_doi"), F.lit("harvest").alias("provenance"), F.array(_s("r", F.col("c_nationkey"))).alias("affiliation_ids"), "matches")
    organisations = t("nation").where("n_nationkey < 12").select(_s("r", F.col("n_nationkey")).alias("affiliation_id"), F.col("n_name").alias("affiliation_name"))
    pilots = t("customer").where(c % 50 == 0).select(_s("DMP#D", c).alias("dmp_doi"))
    return reports.match_report(lines, organisations, pilots).select("dmp_id", "is_pilot_dmp", "affiliation_id", "affiliation_name", "related_work", "location", "authors", F.round("weighted_score", 6).alias("weighted_score"))


@query("SELECT 'DMP#' || c_custkey AS pk FROM customer WHERE c_custkey % 2 = 0 AND c_custkey % 3 = 1")
def without_narrative(t):
    """Public records whose list of identifiers holds no narrative."""
    return reports.without_narrative(_records(t)).select("pk")


@query("SELECT 'DMP#' || c_custkey AS pk, CASE WHEN c_custkey % 3 = 0 THEN 3 ELSE 2 END AS n FROM customer WHERE c_custkey % 3 < 2 AND CASE WHEN c_custkey % 3 = 0 THEN 3 ELSE 2 END > 2")
def having_more(t):
    return reports.having(_records(t), "related", 2).select("pk", F.size("related").alias("n"))


@query("""SELECT 'DMP#' || c_custkey AS pk, CASE WHEN c_custkey % 3 = 2 THEN NULL ELSE (CASE WHEN c_custkey % 3 = 0 THEN '-;' ELSE '' END) || CASE WHEN c_custkey % 10 < 5 THEN 'Cite ' || (c_custkey % 10) ELSE 'No citation available.' END || ';Known.' END AS citations FROM customer""")
def citation_backfill(t):
    """Citations filled in from a table; control characters do not keep a DOI from being found."""
    known = t("nation").where("n_nationkey < 5").select(_s("10.1/x", F.col("n_nationkey")).alias("doi"), _s("Cite ", F.col("n_nationkey")).alias("citation"))
    return reports.cited(_records(t), known).select("pk", _lines(F.col("related"), "citation").alias("citations"))


@query("SELECT '10.1/x' || k AS doi FROM (SELECT DISTINCT c_custkey % 10 AS k FROM customer WHERE c_custkey % 3 < 2)")
def citations_wanted(t):
    return reports.to_cite(_records(t))


@query("""SELECT o_custkey AS pk, CASE WHEN o_custkey % 4 = 0 THEN 'contact' ELSE arg_min(p, (-n, first)) END AS owner FROM (
  SELECT o_custkey, o_orderpriority AS p, count(*) AS n, min(o_orderkey) AS first FROM orders GROUP BY ALL) GROUP BY o_custkey""")
def owner_org(t):
    """A contact's organisation, else the most frequent one, the first met of equally frequent ones."""
    rows = t("orders").groupBy("o_custkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", "o_orderpriority"))), lambda x: x["o_orderpriority"]).alias("others"))
    return rows.select(F.col("o_custkey").alias("pk"), reports.owner_org(F.when(F.col("o_custkey") % 4 == 0, "contact"), F.col("others")).alias("owner"))


@query("""SELECT c_custkey AS id, NULL::VARCHAR AS blank, c_name AS name, CASE WHEN c_custkey % 2 = 1 THEN 1 ELSE 0 END AS featured, c_mktsegment || ';b' AS tags, NULL::VARCHAR AS flag, c_name || '/-' AS inner_text FROM customer""")
def tidied_documents(t):
    c = F.col("c_custkey")
    rows = t("customer").select(
        _s(c).alias("id"), F.lit(" \t").alias("blank"), _s(" ", F.col("c_name"), " ").alias("name"), F.when(c % 2 == 1, "1").otherwise("0").alias("featured"), F.array(F.col("c_mktsegment"), _s(F.col("c_mktsegment"), " "), F.lit(None).cast("string"), F.lit("b")).alias("tags"), F.lit(True).alias("flag"),
        F.struct(F.col("c_name").alias("a"), F.lit(" ").alias("b"), c.alias("number")).alias("inner"),
    )
    got = reports.tidied(rows)
    return got.select(F.col("id").cast("long"), "blank", "name", "featured", F.array_join("tags", ";").alias("tags"), F.col("flag").cast("string").alias("flag"), F.concat_ws("/", "inner.a", F.coalesce("inner.b", F.lit("-"))).alias("inner_text"))


@query("""SELECT '{"PK":{"S":"' || c_name || '"},"dmp":{"M":{"SCORE":{"N":"' || c_nationkey || '"},"tags":{"L":[{"S":"' || c_mktsegment || '"}]},"open":{"BOOL":true}}}}' AS value FROM customer""")
def legacy_records(t):
    """Records as typed attributes with renamed keys."""
    rows = t("customer").select(F.col("c_name").alias("pk"), F.struct(F.col("c_nationkey").alias("score"), F.array("c_mktsegment").alias("tags"), F.lit(True).alias("open")).alias("dmp"))
    return reports.converted(rows, lambda n: n.upper() if n in ("pk", "score") else n)


@query("SELECT 'DMP#' || c_custkey AS pk, CASE WHEN c_custkey % 7 > 0 AND c_custkey % 2 = 0 THEN 'now' ELSE '2024-02-' || (c_custkey % 28 + 1) END AS modified FROM customer WHERE c_custkey % 7 > 0")
def reindexed(t):
    """Public latest versions touched, old versions purged."""
    return reports.purged(reports.touched(_records(t), F.lit("now"), F.col("visibility") == "public"), "VERSION#old").select("pk", "modified")


@query("""SELECT 'DMP#' || c_custkey AS pk, CASE WHEN c_custkey % 11 = 0 THEN 'CREATED' WHEN c_custkey % 13 = 0 THEN 'REMOVED' ELSE 'UPDATED' END AS detail_type FROM customer WHERE (c_custkey % 11 = 0 AND c_custkey % 13 > 0) OR (c_custkey % 13 = 0 AND c_custkey % 11 > 0) OR (c_custkey % 5 = 0 AND c_custkey % 11 > 0 AND c_custkey % 13 > 0)""")
def event_notices(t):
    """What an update announces: created, updated and removed records, dates apart."""
    old = t("customer").select(_s("DMP#", F.col("c_custkey")).alias("pk"), F.col("c_name").alias("title"), F.lit("a").alias("modified"), "c_custkey")
    new = old.where("c_custkey % 13 > 0").withColumn("title", F.when(F.col("c_custkey") % 5 == 0, F.upper("title")).otherwise(F.col("title"))).withColumn("modified", F.lit("b"))
    return reports.notices(old.where("c_custkey % 11 > 0").drop("c_custkey"), new.drop("c_custkey"))


# records of the hub


@query("SELECT 'DMP#' || c_custkey AS pk, CASE WHEN c_custkey % 7 = 0 THEN 'VERSION#old' WHEN c_custkey % 5 = 0 THEN 'VERSION#tombstone' ELSE 'VERSION#latest' END AS sk, CASE WHEN c_custkey % 7 > 0 AND c_custkey % 5 = 0 THEN 'OBSOLETE: ' ELSE '' END || c_name AS title FROM customer")
def tombstones(t):
    r = _records(t)
    gone = t("customer").where("c_custkey % 5 = 0").select(_s("DMP#", F.col("c_custkey")).alias("pk"))
    return hub.tombstones(r, gone.union(gone)).select("pk", "sk", "title")


@query("SELECT 'DMP#' || s_suppkey || 'n' AS pk, 'VERSION#latest' AS sk, s_name AS title FROM supplier WHERE s_suppkey % 2 = 1")
def created_plans(t):
    """New records whose key is free."""
    s = F.col("s_suppkey")
    new = t("supplier").select(F.when(s % 2 == 1, _s("DMP#", s, "n")).otherwise(_s("DMP#", s)).alias("pk"), F.col("s_name").alias("title"))
    return hub.created(_records(t), new).select("pk", "sk", "title")


@query("""SELECT 'D' || l_orderkey AS pk, l_returnflag AS provenance, string_agg(DISTINCT lpad(l_partkey::VARCHAR, 9, '0'), ',' ORDER BY lpad(l_partkey::VARCHAR, 9, '0')) AS works FROM lineitem WHERE l_suppkey % 3 > 0 AND (l_orderkey, l_partkey) NOT IN (SELECT l_orderkey, l_partkey FROM lineitem WHERE l_suppkey % 3 = 0) GROUP BY ALL""")
def harvested_modifications(t):
    """Found works that are not known yet, by plan and provenance."""
    line = t("lineitem").select(_s("D", F.col("l_orderkey")).alias("pk"), F.col("l_returnflag").alias("provenance"), F.lpad(F.col("l_partkey").cast("string"), 9, "0").alias("work_id"), "l_suppkey")
    got = hub.harvested(line.where("l_suppkey % 3 = 0"), line.where("l_suppkey % 3 > 0"))
    return got.select("pk", "provenance", F.array_join("works", ",").alias("works"))


@query("""SELECT o_orderkey AS work_id, CASE WHEN o_orderkey % 3 = 0 THEN 'approved' WHEN o_orderkey % 3 = 1 THEN 'rejected' ELSE 'pending' END AS status, o_orderkey % 3 = 0 AS related FROM orders""")
def reviewed_works(t):
    k = F.col("o_orderkey")
    works = t("orders").select(F.col("o_custkey").alias("pk"), k.alias("work_id"), F.lit("pending").alias("status"))
    decisions = t("orders").where("o_orderkey % 3 < 2").select(F.col("o_custkey").alias("pk"), k.alias("work_id"), F.when(k % 3 == 0, "approved").otherwise("rejected").alias("status"))
    return hub.reviewed(works, decisions).select("work_id", "status", "related")


@query("SELECT c_custkey AS pk, CASE WHEN c_custkey % 2 = 0 OR c_custkey % 3 > 0 THEN 2 ELSE 1 END AS n FROM customer")
def redacted_records(t):
    c = F.col("c_custkey")
    item = lambda k: F.struct(k.alias("kind"), _s(c).alias("id"))
    rows = t("customer").select(c.alias("pk"), F.when(c % 2 == 0, "public").otherwise("private").alias("privacy"), F.array(item(F.when(c % 3 == 0, "narrative").otherwise("work")), item(F.lit("work"))).alias("related"))
    return hub.redacted(rows, F.array(F.lit("narrative"))).select("pk", F.size("related").alias("n"))


@query("SELECT event_id FROM events WHERE event_id % 4 = 0 OR ts >= TIMESTAMP '2024-01-15 00:00:00'")
def stale_records(t):
    """Never enriched, or modified since."""
    e = t("events")
    return e.where(hub.stale(F.col("ts"), F.when(F.col("event_id") % 4 > 0, F.lit("2024-01-15").cast("timestamp_ntz")))).select("event_id")


@query("SELECT 'DMP#' || user_id AS pk, string_agg(strftime(ts, '%Y-%m-%dT%H:%M:%S'), ',' ORDER BY ts DESC, event_id DESC) AS versions FROM events WHERE event_type = 'view' GROUP BY 1")
def version_list(t):
    """Versions of each record, newest first."""
    rows = t("events").where("event_type = 'view'").groupBy("user_id").agg(F.reverse(F.array_sort(F.collect_list(F.struct("ts", "event_id")))).alias("v"))
    return rows.select(_s("DMP#", F.col("user_id")).alias("pk"), F.array_join(F.transform("v", lambda x: F.date_format(x["ts"], "yyyy-MM-dd'T'HH:mm:ss")), ",").alias("versions"))


@query("SELECT DISTINCT 'a' || (c_custkey % 500) AS award_id, c_mktsegment AS title FROM customer WHERE c_custkey % 3 > 0 AND c_custkey % 4 > 0")
def award_results(t):
    """Funder search results in one shape, incomplete ones dropped, repeated ones once."""
    c = F.col("c_custkey")
    return hub.normalised_awards(t("customer"), {"award_id": F.when(c % 3 > 0, _s("a", c % 500)), "title": F.when(c % 4 > 0, F.col("c_mktsegment"))})


@query("SELECT l_suppkey AS work_id, arg_min(l_orderkey, (-l_quantity, l_orderkey)) AS plan_id, max(l_quantity) AS score FROM lineitem GROUP BY 1")
def best_plans(t):
    """The best plan of each work; the smaller id of equally good ones."""
    rows = t("lineitem").select(F.col("l_suppkey").alias("work_id"), F.col("l_orderkey").alias("plan_id"), F.col("l_quantity").alias("score"))
    return match.best_plan(rows, "work_id", "plan_id").select("work_id", "plan_id", "score")


@query("""SELECT p_brand, string_agg(p_type, ' AND ' ORDER BY p_type) AS kinds, any_nulls AS any_null FROM (SELECT DISTINCT p_brand, p_type FROM part WHERE p_size % 4 > 0) JOIN (SELECT p_brand, bool_or(p_size % 4 = 0) AS any_nulls FROM part GROUP BY 1) USING (p_brand) GROUP BY ALL""")
def listed_values(t):
    from weftline.functions import clean

    kind = F.when(F.col("p_size") % 4 > 0, F.col("p_type"))
    got = t("part").groupBy("p_brand").agg(clean.listed(kind).alias("kinds"), clean.distinct_with_null(kind).alias("all"))
    return got.select("p_brand", "kinds", F.exists("all", lambda x: x.isNull()).alias("any_null"))


@query("""SELECT '{"cCustkey":' || c_custkey || ',"cName":"' || c_name || '","cMktsegment":"' || c_mktsegment || '"}' AS value FROM customer""")
def camel_documents(t):
    return sinks.camel_json(t("customer").select("c_custkey", "c_name", "c_mktsegment"))


@query("""SELECT '10.1/' || l_partkey AS doi, arg_min(l_orderkey, (-l_quantity, l_orderkey)) AS plan_doi, max(l_quantity) AS score, '["' || 'w' || l_partkey || '"]' AS authors, md5('{"authors":["w' || l_partkey || '"],"title":"t' || l_partkey || '"}') AS hash FROM lineitem GROUP BY l_partkey""")
def work_versions(t):
    """One row for each work among the matches, lists as JSON, with a hash of the content."""
    p = F.col("l_partkey")
    rows = t("lineitem").select(_s("10.1/", p).alias("doi"), F.col("l_orderkey").alias("plan_doi"), F.col("l_quantity").alias("score"), _s("t", p).alias("title"), F.array(_s("w", p)).alias("authors"))
    return sinks.work_versions(rows).select("doi", "plan_doi", "score", "authors", F.lower(F.hex("hash")).alias("hash"))


# search assembly and enrichment


@query("""
WITH a AS (SELECT c_custkey AS plan_id, o_orderkey AS work_id, CASE WHEN o_orderkey % 3 = 0 THEN 2.0 ELSE 1.0 END AS s, true AS must FROM customer JOIN orders ON o_custkey = c_custkey WHERE o_orderkey % 3 < 2),
g AS (SELECT c_custkey, o_orderkey, 10.0, true FROM customer JOIN orders ON o_orderkey % 1000 = c_custkey % 1000 WHERE c_custkey % 4 = 0 AND o_orderkey % 2 = 0),
f AS (SELECT c_custkey, o_orderkey, 15.0, true FROM customer JOIN orders ON o_orderkey = c_custkey * 7 WHERE c_custkey % 2 = 0),
i AS (SELECT p.c_custkey, o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 2.0 ELSE 1.0 END, false FROM customer p JOIN orders ON o_custkey = p.c_custkey OR o_orderkey % 1000 = p.c_custkey % 1000 OR o_orderkey = p.c_custkey * 7
  JOIN customer s ON s.c_custkey = o_custkey WHERE CASE WHEN o_orderkey % 5 = 0 THEN s.c_nationkey = p.c_nationkey ELSE s.c_mktsegment = p.c_mktsegment END),
u AS (SELECT plan_id, work_id, sum(s) AS score, bool_or(must) AS must FROM (SELECT * FROM a UNION ALL SELECT * FROM g UNION ALL SELECT * FROM f UNION ALL SELECT DISTINCT * FROM i) GROUP BY ALL)
SELECT plan_id, work_id, score::DOUBLE AS score, max(score) OVER (PARTITION BY plan_id)::DOUBLE AS score_max, row_number() OVER (PARTITION BY plan_id ORDER BY score DESC, work_id) AS match_rank FROM u WHERE must QUALIFY match_rank <= 10""")
def search_assembled(t):
    """Must and should clauses of plans against works: funded DOIs, author ids or surnames, award spellings, institutions by id or name."""
    c, o = readers.spread(t("customer")), readers.spread(t("orders"))
    key, k, none = F.col("c_custkey"), F.col("o_orderkey"), F.lit(None).cast("string")
    pair = lambda i, n: F.struct(i.alias("id"), n.alias("name"))
    empty = F.array().cast("array<struct<id:string,name:string>>")
    name = _s("Customer#", F.lpad(key.cast("string"), 9, "0"))  # of the key: a c_name that two customers share is no key
    award = F.array(F.struct(F.lit("021nxhr62").alias("ror"), _s("NSF ", F.lpad((key % 1000).cast("string"), 7, "0")).alias("text")))
    plans = c.select(
        key.alias("plan_id"), F.when(key % 2 == 0, F.array(key * 7)).otherwise(F.array().cast("array<bigint>")).alias("funded_dois"), F.array(pair(_s("a", key), name)).alias("authors"), F.array(pair(_s("n", F.col("c_nationkey")), F.col("c_mktsegment"))).alias("institutions"), empty.alias("funders"),
        F.when(key % 4 == 0, award).alias("awards"), F.lit(None).cast("date").alias("project_start"), F.lit(None).cast("date").alias("project_end"),
    )
    works = o.join(c, key == F.col("o_custkey")).select(
        k.alias("work_id"), F.array(F.when(k % 3 == 0, pair(_s("a", key), none)).when(k % 3 == 1, pair(none, _s("Dr ", name, " of X"))).otherwise(pair(none, none))).alias("authors"), F.array(F.when(k % 5 == 0, pair(_s("n", F.col("c_nationkey")), none)).otherwise(pair(none, _s("The ", F.col("c_mktsegment"), " group")))).alias("institutions"), empty.alias("funders"),
        F.when(k % 2 == 0, F.array(F.lpad((k % 1000).cast("string"), 7, "0"))).alias("award_ids"), none.alias("work_type"), F.lit(None).cast("date").alias("publication_date"),
    )
    return searching.best_works(plans, works, 10).withColumn("match_rank", F.col("match_rank").cast("long"))


@query(r"""
WITH p AS (SELECT c_custkey AS c, CASE WHEN c_custkey % 2 = 0 THEN lpad((c_custkey % 300)::VARCHAR, 7, '0') END AS no FROM customer),
w AS (SELECT o_custkey, lpad((o_orderkey % 300)::VARCHAR, 7, '0') AS no, 'd' || o_orderkey AS doi FROM orders WHERE o_orderkey % 100 = 0)
SELECT c AS doi, CASE WHEN no IS NULL THEN '' ELSE no || '=' || coalesce(string_agg(DISTINCT w.doi, '|' ORDER BY w.doi), '') END AS awards FROM p LEFT JOIN w USING (no) WHERE no IS NOT NULL GROUP BY c, no""")
def enriched_plans(t):
    """Awards parsed out of a plan's funding, with the works that are known for each."""
    c = F.col("c_custkey")
    fund = F.struct(F.struct(F.lit("021nxhr62").alias("ror")).alias("funder"), F.lit(None).cast("string").alias("funding_opportunity_id"), F.when(c % 2 == 0, _s("NSF ", F.lpad((c % 300).cast("string"), 7, "0"), "; n/a")).alias("award_id"))
    plans = t("customer").select(c.alias("doi"), F.array(fund).alias("funding"))
    funded = t("orders").where("o_orderkey % 100 = 0").groupBy(F.lpad((F.col("o_orderkey") % 300).cast("string"), 7, "0").alias("key")).agg(F.array_sort(F.collect_set(_s("d", F.col("o_orderkey")))).alias("values"))
    got = enrich.enriched(plans, funded)
    return got.select("doi", F.array_join(F.transform("awards", lambda a: F.concat(a["award_id"], F.lit("="), F.array_join(a["funded_dois"], "|"))), ";").alias("awards"))


@query("SELECT p_partkey AS ref_id, 'd' || p_partkey AS doi, round(200.0 * 32 / 66, 6) AS score FROM part")
def similar_titles(t):
    """Titles that differ in one character, in accents, case and punctuation."""
    p = F.col("p_partkey")
    text = F.md5(p.cast("string"))
    part = readers.spread(t("part"))
    wanted = part.select(p.alias("ref_id"), _s("É", F.upper(text), "!").alias("title"))
    works = part.select(_s("d", p).alias("doi"), _s(" e", F.substring(text, 1, 31), "z").alias("title"))
    return enrich.similar_titles(wanted, works).withColumn("score", F.round("score", 6))
