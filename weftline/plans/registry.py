"""Registry transforms and index models over raw records and clean tables that are made of the given ones, each with its SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from weftline.operators import index, normalise
from weftline.sources import readers, registries

from .base import query


def _s(*parts) -> Column:
    """Texts and columns joined as text."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _lines(items: Column, *fields: str) -> Column:
    """A list of structs as text: fields by '/', items by ';'."""
    return F.array_join(F.transform(items, lambda x: F.concat_ws("/", *[F.coalesce(x[f].cast("string"), F.lit("-")) for f in fields])), ";")


def _lines_sql(items: str, *fields: str) -> str:
    return "array_to_string(list_transform({}, lambda x: {}), ';')".format(items, " || '/' || ".join(f"coalesce(x.{f}::VARCHAR, '-')" for f in fields))


def _read(df: DataFrame, schema: str) -> DataFrame:
    """The columns as the raw schema has them: by name, through JSON, as a dump holds them."""
    return df.select(F.from_json(F.to_json(F.struct(*df.columns)), schema).alias("r")).select("r.*")


# raw records


def _articles(t) -> DataFrame:
    """Orders as raw records of articles."""
    k, c, p = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderpriority")
    link = lambda i, kind: F.struct(i.alias("id"), F.lit(kind).alias("id-type"), F.lit("publisher").alias("asserted-by"))
    place = F.when(k % 3 == 1, F.array(F.struct(p.alias("name"), F.array(link(_s("https://ROR.org/0", c % 9), "ROR")).alias("id")))).when(k % 3 == 2, F.array(F.struct(p.alias("name"), F.lit(None).alias("id"))))
    one = F.struct(F.lit("Ann").alias("given"), F.col("o_orderstatus").alias("family"), _s("https://orcid.org/0000-0002-", F.lpad((c % 10000).cast("string"), 4, "0"), "-123X").alias("ORCID"), place.alias("affiliation"))
    fund = F.struct(_s("http://dx.doi.org/10.13039/", c % 100).alias("DOI"), p.alias("name"), F.when(k % 5 != 1, F.array(_s("A", c % 7), F.lit("B"))).otherwise(F.array().cast("array<string>")).alias("award"))
    date = F.when(k % 2 == 0, F.array(F.year("o_orderdate"), F.month("o_orderdate"))).otherwise(F.array(F.year("o_orderdate"), F.month("o_orderdate"), F.day("o_orderdate")))
    return _read(
        readers.spread(t("orders")).select(
            _s("10.1/O", k).alias("DOI"), F.lit("journal-article").alias("type"), F.array(_s("<i>Order</i> ", k), _s('"', p, '"')).alias("title"),
            F.when(k % 3 != 0, _s("&lt;p&gt;Of customer ", c, " & co")).alias("abstract"), F.when(k % 4 != 0, F.array(one, one)).alias("author"),
            F.when(k % 5 != 0, F.array(fund)).alias("funder"), F.array(p, F.lit("B")).alias("container-title"),
            F.struct(F.array(date).alias("date-parts")).alias("issued"), F.struct(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("date-time")).alias("deposited"),
            F.struct(F.when(k % 2 == 0, F.array(link(_s("https://doi.org/10.1/O", k + 1), "doi"))).alias("references"), F.array(link(_s("10.1/O", c), "doi")).alias("is-based-on")).alias("relation"),
        ),
        registries.CROSSREF,
    )


def _datasets(t) -> DataFrame:
    """Customers as raw records of datasets."""
    c, name, seg = F.col("c_custkey"), F.col("c_name"), F.col("c_mktsegment")
    place = _s('{"name":"', seg, '","affiliationIdentifier":"https://ror.org/0', c % 9, '","affiliationIdentifierScheme":"ROR"}')
    ids = _s('[{"nameIdentifier":"https://orcid.org/0000-0001-', F.lpad((c % 10000).cast("string"), 4, "0"), '-5678-123x","nameIdentifierScheme":"ORCID"}]')
    person = lambda kind: F.struct(F.lit("Ann Maria").alias("givenName"), _s("Berg", c).alias("familyName"), F.lit(kind).alias("nameType"), F.when(c % 3 > 0, F.when(c % 3 == 1, place).otherwise(F.concat(F.lit("["), place, F.lit(","), place, F.lit("]")))).alias("affiliation"), F.when(c % 2 == 0, ids).alias("nameIdentifiers"))
    fund = F.struct(_s("https://doi.org/10.13039/", c % 50).alias("funderIdentifier"), F.lit("Crossref Funder ID").alias("funderIdentifierType"), seg.alias("funderName"), F.when(c % 4 > 0, _s("N", c % 13)).alias("awardNumber"), F.lit(None).cast("string").alias("awardUri"))
    text = F.when(c % 4 == 0, ":unav").when(c % 4 == 1, "Cover title.").otherwise(_s("About &lt;br&gt;", seg))
    day = F.date_format(F.date_add(F.lit("1995-01-01").cast("date"), (c % 700).cast("int")), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    attributes = F.struct(
        day.alias("created"), day.alias("updated"), F.when(c % 5 > 0, F.array(F.struct(_s("<b>", name, "</b>").alias("title")), F.struct(F.lit("'x'").alias("title")))).alias("titles"),
        F.array(F.struct(text.alias("description"))).alias("descriptions"), F.struct(F.when(c % 3 > 0, "Dataset").alias("resourceTypeGeneral")).alias("types"), F.array(person("Personal"), person("Organizational"), person(None)).alias("creators"),
        F.array(fund, F.struct(*[F.lit(None).cast("string").alias(f) for f in ("funderIdentifier", "funderIdentifierType", "funderName", "awardNumber", "awardUri")])).alias("fundingReferences"), F.struct(seg.alias("name")).alias("publisher"),
        F.when(c % 2 == 0, F.array(F.struct(F.lit("Cites").alias("relationType"), _s("10.1/O", c).alias("relatedIdentifier"), F.lit("DOI").alias("relatedIdentifierType")), F.struct(*[F.lit(None).cast("string").alias(f) for f in ("relationType", "relatedIdentifier", "relatedIdentifierType")]))).alias("relatedIdentifiers"),
    )
    return _read(readers.spread(t("customer")).select(_s("10.5438/C", c).alias("id"), attributes.alias("attributes")), registries.DATACITE)


def _graph(t) -> DataFrame:
    """Parts as raw records of the citation graph."""
    p = F.col("p_partkey")
    place = F.struct(F.col("p_brand").alias("display_name"), _s("https://ror.org/0", p % 9).alias("ror"))
    person = F.struct(F.struct(_s("Dr. Ana Q. van Dyk", p).alias("display_name"), F.when(p % 2 == 0, _s("https://orcid.org/0000-0003-", F.lpad((p % 10000).cast("string"), 4, "0"), "-1-X")).alias("orcid")).alias("author"), F.when(p % 4 > 0, F.array(place, place)).alias("institutions"))
    grant = F.struct(_s("https://openalex.org/F", p % 40).alias("funder"), F.col("p_brand").alias("funder_display_name"), F.when(p % 3 > 0, _s("G", p % 17)).alias("award_id"))
    words = _s('{"big":[1],"A":[0],"', F.col("p_type"), '":[3,2]}')
    return _read(
        readers.spread(t("part")).select(
            _s("https://openalex.org/W", p).alias("id"), _s("https://doi.org/10.7/P", p).alias("doi"), F.struct(_s("https://doi.org/10.7/P", p).alias("doi"), p.cast("string").alias("mag"), _s("https://openalex.org/W", p).alias("openalex"), F.when(p % 3 == 0, _s("https://pubmed.ncbi.nlm.nih.gov/", p)).alias("pmid")).alias("ids"),
            F.when(p % 6 == 0, "  ").otherwise(_s("  ", F.col("p_name"), " ")).alias("title"), F.when(p % 5 > 0, words).alias("abstract_inverted_index"), F.lit("article").alias("type"), F.lit("2020-02-29").alias("publication_date"),
            F.array(person).alias("authorships"), F.when(p % 7 > 0, F.array(grant)).alias("grants"), F.struct(F.struct(F.col("p_brand").alias("display_name")).alias("source")).alias("primary_location"),
        ),
        registries.OPENALEX_WORKS,
    )


def _organisations(t) -> DataFrame:
    s = F.col("s_suppkey")
    entry = lambda kind, *xs: F.struct(F.lit(kind).alias("type"), (F.array(*xs) if xs else F.array().cast("array<string>")).alias("all"))
    ids = F.array(entry("isni", _s("0000 0001 2345 ", s)), entry("fundref", _s(s + 100000), _s(s + 200000)), entry("grid", _s("grid.", s, ".A")), entry("wikidata"))
    return _read(readers.spread(t("supplier")).select(_s("https://ror.org/0", s).alias("id"), F.when(s % 3 > 0, ids).alias("external_ids")), registries.ROR)


def _plans(t) -> DataFrame:
    """Customers as raw records of plans."""
    c, seg = F.col("c_custkey"), F.col("c_mktsegment")
    start = F.date_add(F.lit("1994-01-01").cast("date"), (c % 900).cast("int"))
    fund = lambda award: F.struct(F.struct(seg.alias("name"), _s("https://ror.org/0", c % 9).alias("id")).alias("funder"), F.lit("granted").alias("status"), F.when(c % 3 == 0, " N/A ").otherwise(_s("OPP-", c)).alias("funding_opportunity_id"), award.alias("grant_id"))
    return _read(
        readers.spread(t("customer")).select(
            _s("https://DOI.org/10.9999/D", c).alias("dmp_id"), start.alias("created"), _s("<p>Plan of ", F.col("c_name"), "</p>").alias("title"), F.when(c % 4 > 0, seg).alias("description"), start.alias("project_start"), F.when(c % 5 > 0, F.date_add(start, (c % 2000).cast("int"))).alias("project_end"),
            F.array(F.struct(_s(seg, " (US)").alias("name"), _s("https://ror.org/0abcdef1", c % 10).alias("ror")), F.struct(F.lit(" ").alias("name"), F.lit(None).cast("string").alias("ror"))).alias("institutions"),
            F.array(F.struct(_s("Berg", c, ", Ann M").alias("name"), _s("https://orcid.org/0000-0002-1825-0", F.lpad((c % 1000).cast("string"), 3, "0")).alias("orcid"))).alias("authors"), F.array(fund(_s("award ", c + 10000)), fund(F.lit("tbd"))).alias("funding"),
        ),
        registries.PLANS,
    )


@query(r"""SELECT '10.1/O' || o_orderkey AS doi, 'Order ' || o_orderkey || ' ' || o_orderpriority AS title, CASE WHEN o_orderkey % 3 <> 0 THEN ';Of customer ' || o_custkey || ' & co' END AS abstract, 'journal-article' AS type,
  CASE WHEN o_orderkey % 2 = 0 THEN last_day(o_orderdate) ELSE o_orderdate::DATE END AS publication_date, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS updated, o_orderpriority || ' B' AS container_title FROM orders""")
def crossref_works(t):
    got = registries.crossref(_articles(t))["works"]
    return got.select("doi", "title", "abstract", "type", "publication_date", F.date_format("updated_date", "yyyy-MM-dd HH:mm:ss").alias("updated"), "container_title")


@query(r"""SELECT '10.1/O' || o_orderkey AS work_doi, CASE WHEN h THEN 'Ann' END AS given, CASE WHEN h THEN o_orderstatus END AS family, NULL::VARCHAR AS name, CASE WHEN h THEN '0000-0002-' || lpad((o_custkey % 10000)::VARCHAR, 4, '0') || '-123x' END AS orcid
FROM (SELECT *, o_orderkey % 4 <> 0 AS h FROM orders)""")
def crossref_authors(t):
    """Repeated authors of a work are one row; a work without authors has a row of NULLs."""
    return registries.crossref(_articles(t))["works_authors"]


@query(r"""SELECT '10.1/O' || o_orderkey AS work_doi, CASE WHEN h THEN o_orderpriority END AS name, CASE WHEN h AND o_orderkey % 3 = 1 THEN '0' || (o_custkey % 9) END AS affiliation_id, CASE WHEN h AND o_orderkey % 3 = 1 THEN 'ROR' END AS id_type,
  CASE WHEN h AND o_orderkey % 3 = 1 THEN 'publisher' END AS asserted_by FROM (SELECT *, o_orderkey % 4 <> 0 AND o_orderkey % 3 > 0 AS h FROM orders)""")
def crossref_affiliations(t):
    return registries.crossref(_articles(t))["works_affiliations"]


@query(r"""SELECT DISTINCT '10.1/O' || o_orderkey AS work_doi, CASE WHEN o_orderkey % 5 > 0 THEN o_orderpriority END AS name, CASE WHEN o_orderkey % 5 > 0 THEN '10.13039/' || (o_custkey % 100) END AS funder_doi,
  unnest(CASE WHEN o_orderkey % 5 > 1 THEN ['A' || (o_custkey % 7), 'B'] ELSE [NULL] END) AS award FROM orders""")
def crossref_funders(t):
    return registries.crossref(_articles(t))["works_funders"]


_RELATED = ", ".join(f"'{r}'" for r in registries.RELATIONS)


@query(rf"""SELECT '10.1/O' || o_orderkey AS work_doi, r AS relation_type, CASE WHEN r = 'references' AND o_orderkey % 2 = 0 THEN '10.1/o' || (o_orderkey + 1) WHEN r = 'is-based-on' THEN '10.1/o' || o_custkey END AS relation_id,
  CASE WHEN (r = 'references' AND o_orderkey % 2 = 0) OR r = 'is-based-on' THEN 'doi' END AS id_type, CASE WHEN (r = 'references' AND o_orderkey % 2 = 0) OR r = 'is-based-on' THEN 'publisher' END AS asserted_by
FROM orders, (SELECT unnest([{_RELATED}]) AS r)""")
def crossref_relations(t):
    """Twelve kinds of relation turned into rows; a kind without links keeps a row."""
    return registries.crossref(_articles(t))["relations"]


@query(r"""SELECT '10.5438/C' || c_custkey AS doi, CASE WHEN c_custkey % 5 > 0 THEN c_name || ' x' END AS title, CASE WHEN c_custkey % 4 > 1 THEN 'About ;' || c_mktsegment END AS abstract, CASE WHEN c_custkey % 3 > 0 THEN 'Dataset' END AS type,
  DATE '1995-01-01' + (c_custkey % 700)::INTEGER AS publication_date, c_mktsegment AS publication_venue,
  CASE WHEN c_custkey % 2 = 0 THEN '0000-0001-' || lpad((c_custkey % 10000)::VARCHAR, 4, '0') || '-5678' ELSE '-' END || '/A/Ann/M/Maria/Berg' || c_custkey || '/Ann Maria Berg' || c_custkey AS authors,
  '10.13039/' || (c_custkey % 50) || '/' || c_mktsegment || '/' || CASE WHEN c_custkey % 4 > 0 THEN 'N' || (c_custkey % 13) ELSE '-' END AS funders,
  CASE WHEN c_custkey % 3 > 0 THEN '0' || (c_custkey % 9) || '/ROR/' || c_mktsegment ELSE '' END AS institutions FROM customer""")
def datacite_works(t):
    """Persons only; empty funders dropped; repeated institutions once; texts that say nothing are NULL."""
    got = registries.datacite(_datasets(t).withColumn("attributes", F.col("attributes").withField("nothing", F.lit(1))))["works"]
    authors = _lines(F.col("authors"), "orcid", *[f for f in registries.NAME_FIELDS])
    return got.select("doi", "title", "abstract", "type", "publication_date", "publication_venue", authors.alias("authors"), _lines(F.col("funders"), "funder_identifier", "funder_name", "award_number").alias("funders"), _lines(F.col("institutions"), "affiliation_identifier", "affiliation_identifier_scheme", "name").alias("institutions"))


@query(r"""SELECT '10.5438/C' || c_custkey AS work_doi, 'Cites' AS relation_type, '10.1/O' || c_custkey AS related_identifier, 'DOI' AS related_identifier_type FROM customer WHERE c_custkey % 2 = 0""")
def datacite_relations(t):
    return registries.datacite(_datasets(t))["relations"]


@query(r"""SELECT 'w' || p_partkey AS id, '10.7/p' || p_partkey AS doi, concat_ws('|', '10.7/p' || p_partkey, p_partkey::VARCHAR, 'w' || p_partkey, CASE WHEN p_partkey % 3 = 0 THEN p_partkey::VARCHAR ELSE '-' END) AS ids,
  CASE WHEN p_partkey % 6 > 0 THEN p_name END AS title, CASE WHEN p_partkey % 5 > 0 THEN 'A big ' || p_type || ' ' || p_type END AS abstract, DATE '2020-02-29' AS publication_date, p_brand AS publication_venue,
  CASE WHEN p_partkey % 2 = 0 THEN '0000-0003-' || lpad((p_partkey % 10000)::VARCHAR, 4, '0') || '-1-x' ELSE '-' END || '/A/Ana/Q/Q./van Dyk' || p_partkey || '/Dr. Ana Q. van Dyk' || p_partkey AS authors,
  CASE WHEN p_partkey % 7 > 0 THEN 'f' || (p_partkey % 40) || '/' || p_brand || '/' || CASE WHEN p_partkey % 3 > 0 THEN 'G' || (p_partkey % 17) ELSE '-' END END AS grants,
  CASE WHEN p_partkey % 4 > 0 THEN p_brand || '/0' || (p_partkey % 9) ELSE '' END AS institutions FROM part""")
def openalex_works(t):
    got = registries.openalex_works(_graph(t))["works"]
    ids = F.concat_ws("|", *[F.coalesce(F.col(f"ids.{f}"), F.lit("-")) for f in ("doi", "mag", "openalex", "pmid")])
    return got.select("id", "doi", ids.alias("ids"), "title", "abstract", "publication_date", "publication_venue", _lines(F.col("authors"), "orcid", *registries.NAME_FIELDS).alias("authors"), _lines(F.col("grants"), "funder_id", "funder_display_name", "award_id").alias("grants"), _lines(F.col("institutions"), "name", "ror").alias("institutions"))


@query(r"""SELECT 'f' || s_suppkey AS id, s_name AS display_name, '10.13039/' || s_suppkey AS crossref, CASE WHEN s_suppkey % 2 = 0 THEN '0r' || s_suppkey END AS ror FROM supplier""")
def openalex_funders(t):
    s = F.col("s_suppkey")
    raw = _read(t("supplier").select(_s("https://openalex.org/F", s).alias("id"), F.col("s_name").alias("display_name"), F.struct(_s("https://doi.org/10.13039/", s).alias("crossref"), F.when(s % 2 == 0, _s("https://ror.org/0R", s)).alias("ror")).alias("ids")), registries.OPENALEX_FUNDERS)
    return registries.openalex_funders(raw)["funders"].select("id", "display_name", "ids.crossref", "ids.ror")


@query(r"""SELECT '0' || s_suppkey AS ror_id, 'ror' AS type, '0' || s_suppkey AS identifier FROM supplier
UNION ALL SELECT '0' || s_suppkey, unnest(['isni', 'fundref', 'fundref', 'grid', 'wikidata']), unnest(['000000012345' || s_suppkey, '10.13039/' || (s_suppkey + 100000), '10.13039/' || (s_suppkey + 200000), 'grid.' || s_suppkey || '.a', NULL]) FROM supplier WHERE s_suppkey % 3 > 0""")
def ror_index(t):
    """Each organisation by itself and by every external id; a type without ids keeps a row, an organisation without any has none."""
    return registries.ror(_organisations(t))["index"]


_PLAN_SQL = r"""p AS (SELECT c_custkey AS c, c_mktsegment AS seg, c_name AS name, DATE '1994-01-01' + (c_custkey % 900)::INTEGER AS s FROM customer),
plan AS (SELECT 'https://10.9999/d' || c AS doi, 'Plan of ' || name AS title, CASE WHEN c % 4 > 0 THEN seg END AS abstract, s AS project_start, CASE WHEN c % 5 > 0 THEN s + (c % 2000)::INTEGER END AS project_end, c, seg FROM p)"""


@query(rf"""WITH {_PLAN_SQL} SELECT doi, title, abstract, project_start, project_end, seg || ' (US)/https://ror.org/0abcdef1' || (c % 10) AS institutions,
  '0000-0002-1825-0' || lpad((c % 1000)::VARCHAR, 3, '0') || '/A/Ann/M/M/Berg' || c || '/Berg' || c || ', Ann M' AS authors,
  seg || '/0' || (c % 9) || '/' || CASE WHEN c % 3 = 0 THEN '-' ELSE 'OPP-' || c END || '/award ' || (c + 10000) || ';' || seg || '/0' || (c % 9) || '/' || CASE WHEN c % 3 = 0 THEN '-' ELSE 'OPP-' || c END || '/-' AS funding FROM plan""")
def plans_clean(t):
    got = registries.plans(_plans(t))["plans"]
    fund = F.transform("funding", lambda f: F.struct(f["funder"]["name"].alias("n"), f["funder"]["ror"].alias("r"), f["funding_opportunity_id"].alias("o"), f["award_id"].alias("a")))
    return got.select("doi", "title", "abstract", "project_start", "project_end", _lines(F.col("institutions"), "name", "ror").alias("institutions"), _lines(F.col("authors"), "orcid", *registries.NAME_FIELDS).alias("authors"), _lines(fund, "n", "r", "o", "a").alias("funding"))


@query(rf"""WITH {_PLAN_SQL} SELECT doi AS plan_id, project_start, CASE WHEN project_end IS NULL OR year(project_end) - year(project_start) < 3 THEN CAST(project_start + INTERVAL 36 MONTH AS DATE) ELSE project_end END AS project_end,
  concat_ws(' ', title, abstract) AS content, (c + 10000)::VARCHAR AS grant_ids, CASE WHEN c % 3 = 0 THEN '' ELSE 'opp-' || c END AS opportunity_ids, '0000-0002-1825-0' || lpad((c % 1000)::VARCHAR, 3, '0') AS person_ids,
  CASE WHEN c % 10 < 10 THEN '0abcdef1' || (c % 10) END AS affiliation_ids, 'ann berg' || c AS person_names, lower(seg) AS funder_names, lower(seg) AS affiliation_names FROM plan""")
def normalised_plans(t):
    got = normalise.plans(registries.plans(_plans(t))["plans"])
    # a ROR has six characters and two digits after its 0
    return got.select("plan_id", "project_start", "project_end", "content", *[F.array_join(c, ";").alias(c) for c in ("grant_ids", "opportunity_ids", "person_ids", "affiliation_ids", "person_names", "funder_names", "affiliation_names")])


@query(r"""SELECT count(*) AS n FROM customer WHERE c_custkey % 10 = 3 OR c_mktsegment = 'BUILDING'""")
def demo_dataset(t):
    """Records with an institution, by ROR or by name."""
    return registries.of_institution(_plans(t), F.col("institutions"), "0abcdef13", "Building").agg(F.count("*").alias("n"))


# clean tables as sources of the index models

_SOURCES = r"""
ow AS (SELECT 'W' || o_orderkey AS id, CASE WHEN o_orderkey % 10 > 0 THEN '10.5/' || (o_orderkey % 4000) END AS doi, o_orderkey % 2 = 0 AS has_mag, o_orderkey % 3 = 0 AS has_pmid, CASE WHEN o_orderkey % 7 > 0 THEN 'Title ' || o_custkey || CASE WHEN o_orderkey % 3 = 0 THEN ' long' ELSE '' END END AS title,
  CASE WHEN o_orderkey % 4 > 0 THEN o_orderpriority END AS abstract, CASE o_orderkey % 3 WHEN 0 THEN 'book-chapter' WHEN 1 THEN 'dataset' END AS type, o_orderdate::DATE AS publication_date, CASE WHEN o_orderkey % 11 > 0 THEN o_orderdate END AS updated_date, o_orderpriority AS publication_venue,
  CASE WHEN o_orderkey % 2 = 0 THEN '0000-' || o_custkey END AS orcid, 'N' || o_custkey AS author, CASE WHEN o_orderkey % 6 > 0 THEN [{'funder_id': CASE WHEN o_orderkey % 5 > 0 THEN 'F' || (o_custkey % 120) END, 'name': o_orderpriority, 'award_id': 'a' || (o_orderkey % 9)}, {'funder_id': 'F' || (o_orderkey % 120), 'name': 'second', 'award_id': NULL}] END AS grants,
  [{'name': o_orderstatus, 'ror': CASE WHEN o_orderkey % 2 = 1 THEN 'r' || (o_custkey % 30) END}] AS institutions FROM orders),
dw AS (SELECT '10.5/' || ((c_custkey // 2) * 3) AS doi, c_name AS title, CASE WHEN c_custkey % 3 > 0 THEN c_mktsegment END AS abstract, CASE c_custkey % 3 WHEN 0 THEN 'Dataset' WHEN 1 THEN 'Nonsense' END AS type, DATE '1996-01-01' AS publication_date, CASE WHEN c_custkey % 4 > 0 THEN (DATE '1995-01-01' + (c_custkey % 700)::INTEGER)::TIMESTAMP END AS updated_date, c_mktsegment AS publication_venue, 'N' || c_custkey AS author,
  CASE WHEN c_custkey % 5 > 0 THEN [{'funder_identifier': 'i' || (c_custkey % 70), 'funder_name': c_mktsegment, 'award_number': CASE WHEN c_custkey % 2 = 0 THEN 'D' || (c_custkey % 8) END}, {'funder_identifier': NULL, 'funder_name': 'none', 'award_number': 'd1'}] END AS funders, [{'affiliation_identifier': 'i' || (c_custkey % 90), 'name': c_mktsegment}] AS institutions FROM customer),
cw AS (SELECT '10.5/' || p_partkey AS doi, CASE WHEN p_partkey % 8 > 0 THEN p_name END AS title, CASE WHEN p_partkey % 2 = 0 THEN p_type END AS abstract, DATE '1997-01-01' + (p_partkey % 900)::INTEGER AS publication_date, (DATE '1997-01-01' + (p_partkey % 900)::INTEGER)::TIMESTAMP AS updated_date FROM part),
cf AS (SELECT '10.5/' || p_partkey AS work_doi, CASE WHEN p_size % 3 > 0 THEN 'C' || p_size END AS award FROM part),
of AS (SELECT 'F' || s_suppkey AS id, CASE WHEN s_suppkey % 4 > 0 THEN 'r' || (s_suppkey % 40) END AS ror FROM supplier),
ri AS (SELECT 'r' || s_suppkey AS ror_id, 'i' || (s_suppkey % 60) AS identifier FROM supplier),
dl AS (SELECT * FROM dw QUALIFY row_number() OVER (PARTITION BY doi ORDER BY updated_date DESC NULLS LAST, title) = 1),
om AS (SELECT id, doi, length(title) AS title_length, length(abstract) AS abstract_length, (has_mag::INT + has_pmid::INT)::BIGINT AS id_count, (orcid IS NOT NULL)::BIGINT AS orcid_count, len(list_distinct(list_filter(list_transform(coalesce(grants, []), lambda g: g.funder_id), lambda x: x IS NOT NULL))) AS funder_id_count,
  len(list_distinct(list_filter(list_transform(coalesce(grants, []), lambda g: g.award_id), lambda x: x IS NOT NULL))) AS award_id_count, len(list_filter(list_transform(institutions, lambda g: g.ror), lambda x: x IS NOT NULL)) AS inst_id_count FROM ow WHERE doi IS NOT NULL AND doi NOT IN (SELECT doi FROM dw)),
ot AS (SELECT *, id_count + orcid_count + funder_id_count + award_id_count + inst_id_count AS total_count FROM om),
meta AS (SELECT *, count(*) OVER (PARTITION BY doi) AS doi_count, row_number() OVER (PARTITION BY doi ORDER BY total_count DESC, id) AS doi_rank FROM ot),
prime AS (SELECT id, doi FROM meta WHERE doi_rank = 1)"""


def _tables(t) -> index.Tables:
    """The sources of the models, as the SQL has them."""
    k, c, p = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderpriority")
    text, some = F.lit(None).cast("string"), lambda test, v: F.when(test, v)
    grants = F.array(F.struct(some(k % 5 > 0, _s("F", c % 120)).alias("funder_id"), p.alias("funder_display_name"), _s("a", k % 9).alias("award_id")), F.struct(_s("F", k % 120).alias("funder_id"), F.lit("second").alias("funder_display_name"), text.alias("award_id")))
    graph = t("orders").select(
        _s("W", k).alias("id"), some(k % 10 > 0, _s("10.5/", k % 4000)).alias("doi"), F.struct(some(k % 2 == 0, F.lit("m")).alias("mag"), some(k % 3 == 0, F.lit("p")).alias("pmid"), text.alias("pmcid")).alias("ids"),
        some(k % 7 > 0, F.concat(_s("Title ", c), F.when(k % 3 == 0, " long").otherwise(""))).alias("title"), some(k % 4 > 0, p).alias("abstract"), F.when(k % 3 == 0, "book-chapter").when(k % 3 == 1, "dataset").alias("type"), F.to_date("o_orderdate").alias("publication_date"), some(k % 11 > 0, F.col("o_orderdate")).alias("updated_date"), p.alias("publication_venue"),
        F.array(*[F.struct(some(k % 2 == 0, _s("0000-", c)).alias("orcid"), _s("N", c).alias("full"))] * 2).alias("authors"), some(k % 6 > 0, grants).alias("grants"), F.array(F.struct(F.col("o_orderstatus").alias("name"), some(k % 2 == 1, _s("r", c % 30)).alias("ror"))).alias("institutions"),
    )
    c, seg = F.col("c_custkey"), F.col("c_mktsegment")
    funders = F.array(F.struct(_s("i", c % 70).alias("funder_identifier"), seg.alias("funder_name"), some(c % 2 == 0, _s("D", c % 8)).alias("award_number")), F.struct(text.alias("funder_identifier"), F.lit("none").alias("funder_name"), F.lit("d1").alias("award_number")))
    datasets = t("customer").select(
        _s("10.5/", F.floor(c / 2) * 3).alias("doi"), F.col("c_name").alias("title"), some(c % 3 > 0, seg).alias("abstract"), F.when(c % 3 == 0, "Dataset").when(c % 3 == 1, "Nonsense").alias("type"), F.lit("1996-01-01").cast("date").alias("publication_date"), some(c % 4 > 0, F.date_add(F.lit("1995-01-01").cast("date"), (c % 700).cast("int")).cast("timestamp_ntz")).alias("updated_date"), seg.alias("publication_venue"),
        F.array(F.struct(text.alias("orcid"), _s("N", c).alias("full"))).alias("authors"), some(c % 5 > 0, funders).alias("funders"), F.array(F.struct(_s("i", c % 90).alias("affiliation_identifier"), seg.alias("name"))).alias("institutions"),
    )
    p = F.col("p_partkey")
    day = F.date_add(F.lit("1997-01-01").cast("date"), (p % 900).cast("int"))
    articles = t("part").select(_s("10.5/", p).alias("doi"), some(p % 8 > 0, F.col("p_name")).alias("title"), some(p % 2 == 0, F.col("p_type")).alias("abstract"), day.alias("publication_date"), day.cast("timestamp_ntz").alias("updated_date"))
    s = F.col("s_suppkey")
    return {
        "openalex.works": graph, "datacite.works": datasets, "crossref.works": articles, "crossref.works_funders": t("part").select(_s("10.5/", p).alias("work_doi"), some(F.col("p_size") % 3 > 0, _s("C", F.col("p_size"))).alias("award")),
        "openalex.funders": t("supplier").select(_s("F", s).alias("id"), F.struct(some(s % 4 > 0, _s("r", s % 40)).alias("ror")).alias("ids")), "ror.index": t("supplier").select(_s("r", s).alias("ror_id"), F.lit("x").alias("type"), _s("i", s % 60).alias("identifier")),
    }


def _model(t, name: str) -> DataFrame:
    return index.build(_tables(t), [name])[name]


_DATE = "strftime({}, '%Y-%m-%d %H:%M:%S')"


def _time(c: str) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


@query(f"WITH {_SOURCES} SELECT doi, length(title) AS title_length, length(abstract) AS abstract_length FROM cw")
def model_crossref_lengths(t):
    return _model(t, "crossref_index.works_metadata").select("doi", F.col("title_length").cast("long"), F.col("abstract_length").cast("long"))


@query(f"WITH {_SOURCES} SELECT doi, title, abstract, type, {_DATE.format('updated_date')} AS updated FROM dw QUALIFY row_number() OVER (PARTITION BY doi ORDER BY updated_date DESC NULLS LAST) = 1")
def model_datacite_latest(t):
    """Of the versions of a DOI the newest, a missing date last."""
    return _model(t, "datacite_index.works").select("doi", "title", "abstract", "type", _time("updated_date").alias("updated"))


@query(f"WITH {_SOURCES} SELECT doi, 'DATASET' AS type FROM dl WHERE type = 'Dataset'")
def model_datacite_types(t):
    return _model(t, "datacite_index.types")


@query(f"WITH {_SOURCES} SELECT doi, {_DATE.format('max(updated_date)')} AS updated FROM (SELECT doi, updated_date FROM dl UNION ALL SELECT doi, updated_date FROM ow) WHERE updated_date IS NOT NULL GROUP BY doi")
def model_datacite_dates(t):
    return _model(t, "datacite_index.updated_dates").select("doi", _time("updated_date").alias("updated"))


def _crosswalk_sql(source: str, key: str, items: str, match: str, name: str, lookup: str) -> str:
    return f"""SELECT {key}, string_agg(coalesce(name, '-') || '/' || coalesce(ror, '-'), ';' ORDER BY pos, ror NULLS FIRST) AS items FROM (
  SELECT {key}, u.pos, u.x.{name} AS name, l.ror FROM (SELECT {key}, unnest(list_transform({items}, lambda x, i: {{'pos': i, 'x': x}})) AS u FROM {source}) LEFT JOIN ({lookup}) l ON l.lid = u.x.{match}) GROUP BY ALL"""


_BY_ROR = "SELECT identifier AS lid, ror_id AS ror FROM ri"


@query(f"WITH {_SOURCES} {_crosswalk_sql('dl', 'doi', 'institutions', 'affiliation_identifier', 'name', _BY_ROR)}")
def model_datacite_institutions(t):
    """An id of several organisations gives several items; an unknown one keeps its name."""
    return _model(t, "datacite_index.institutions").select("doi", _lines(F.col("institutions"), "name", "ror").alias("items"))


@query(f"WITH {_SOURCES} {_crosswalk_sql('dl', 'doi', 'funders', 'funder_identifier', 'funder_name', _BY_ROR)}")
def model_datacite_funders(t):
    return _model(t, "datacite_index.funders").select("doi", _lines(F.col("funders"), "name", "ror").alias("items"))


_AWARDS = "SELECT doi, string_agg(award_id, ';' ORDER BY lower(award_id), award_id) AS awards FROM (SELECT DISTINCT doi, award_id FROM ({}) WHERE award_id IS NOT NULL) GROUP BY doi"


@query(f"WITH {_SOURCES} " + _AWARDS.format("SELECT doi, unnest(list_transform(funders, lambda f: f.award_number)) AS award_id FROM dl UNION ALL SELECT doi, unnest(list_transform(grants, lambda g: g.award_id)) FROM ow WHERE doi IN (SELECT doi FROM dl)"))
def model_datacite_awards(t):
    return _model(t, "datacite_index.awards").select("doi", _lines(F.col("awards"), "award_id").alias("awards"))


@query(f"""WITH {_SOURCES}, d AS (SELECT doi, max(updated_date) AS u FROM (SELECT doi, updated_date FROM dl UNION ALL SELECT doi, updated_date FROM ow) WHERE updated_date IS NOT NULL GROUP BY doi),
a AS ({_AWARDS.format("SELECT doi, unnest(list_transform(funders, lambda f: f.award_number)) AS award_id FROM dl UNION ALL SELECT doi, unnest(list_transform(grants, lambda g: g.award_id)) FROM ow WHERE doi IN (SELECT doi FROM dl)")}),
f AS ({_crosswalk_sql('dl', 'doi', 'funders', 'funder_identifier', 'funder_name', _BY_ROR)})
SELECT doi, title, abstract AS abstract_text, CASE WHEN type = 'Dataset' THEN 'DATASET' ELSE 'OTHER' END AS work_type, {_DATE.format('u')} AS updated, coalesce(awards, '') AS awards, coalesce(items, '') AS funders, 'DataCite https://commons.datacite.org/doi.org/' || doi AS source
FROM dl LEFT JOIN d USING (doi) LEFT JOIN a USING (doi) LEFT JOIN f USING (doi)""")
def model_datacite_index(t):
    got = _model(t, "datacite_index.index")
    return got.select("doi", "title", "abstract_text", "work_type", _time("updated_date").alias("updated"), _lines(F.col("awards"), "award_id").alias("awards"), _lines(F.col("funders"), "name", "ror").alias("funders"), F.concat_ws(" ", "source.name", "source.url").alias("source"))


@query(f"WITH {_SOURCES} SELECT *, doi_count > 1 AS is_duplicate, doi_rank = 1 AS is_primary_doi FROM meta")
def model_openalex_metadata(t):
    """Datasets' DOIs excluded; counts of distinct ids; rank among works of one DOI."""
    return _model(t, "openalex_index.works_metadata").withColumns({c: F.col(c).cast("long") for c in ("title_length", "abstract_length")})


_STATS = "SELECT arg_min(id, (-coalesce({n}, -1), id)) AS id, doi, max({n}) AS {n} FROM (SELECT m.id, m.doi, m.{n}, length(cw.{f}) AS o FROM meta m LEFT JOIN cw USING (doi)) WHERE {n} > 0 OR o > 0 GROUP BY doi"
_TEXTS = "SELECT s.doi, CASE WHEN length(cw.{f}) > s.{n} OR (cw.{f} IS NOT NULL AND s.{n} IS NULL) THEN cw.{f} ELSE ow.{f} END AS {f} FROM ({stats}) s LEFT JOIN ow ON ow.id = s.id LEFT JOIN cw ON cw.doi = s.doi"
_TITLE_STATS, _ABSTRACT_STATS = (_STATS.format(n=f"{f}_length", f=f) for f in ("title", "abstract"))
_TITLES, _ABSTRACTS = (_TEXTS.format(n=f"{f}_length", f=f, stats=s) for f, s in (("title", _TITLE_STATS), ("abstract", _ABSTRACT_STATS)))


@query(f"WITH {_SOURCES} {_TITLE_STATS}")
def model_title_stats(t):
    return _model(t, "openalex_index.title_stats").withColumn("title_length", F.col("title_length").cast("long"))


@query(f"WITH {_SOURCES} {_ABSTRACT_STATS}")
def model_abstract_stats(t):
    return _model(t, "openalex_index.abstract_stats").withColumn("abstract_length", F.col("abstract_length").cast("long"))


@query(f"WITH {_SOURCES} {_TITLES}")
def model_titles(t):
    """The longer title of both registries."""
    return _model(t, "openalex_index.titles")


@query(f"WITH {_SOURCES} {_ABSTRACTS}")
def model_abstracts(t):
    return _model(t, "openalex_index.abstracts")


_DATED = "SELECT doi, max({c}) AS {c} FROM (SELECT m.doi, ow.{c} FROM meta m JOIN ow USING (id) UNION ALL SELECT doi, {c} FROM cw WHERE doi IN (SELECT doi FROM meta)) WHERE {c} IS NOT NULL GROUP BY doi"


@query(f"WITH {_SOURCES} {_DATED.format(c='publication_date')}")
def model_publication_dates(t):
    return _model(t, "openalex_index.publication_dates")


@query(f"WITH {_SOURCES} SELECT doi, {_DATE.format('updated_date')} AS updated FROM ({_DATED.format(c='updated_date')})")
def model_updated_dates(t):
    return _model(t, "openalex_index.updated_dates").select("doi", _time("updated_date").alias("updated"))


_GRAPH_AWARDS = _AWARDS.format("SELECT doi, unnest(list_transform(grants, lambda g: g.award_id)) AS award_id FROM ow WHERE id IN (SELECT id FROM meta) UNION ALL SELECT work_doi, award FROM cf WHERE work_doi IN (SELECT doi FROM meta)")
_GRAPH_FUNDERS = _crosswalk_sql("(SELECT prime.id, prime.doi, grants FROM prime JOIN ow USING (id))", "id, doi", "grants", "funder_id", "name", "SELECT id AS lid, ror FROM of")


@query(f"WITH {_SOURCES} {_GRAPH_AWARDS}")
def model_openalex_awards(t):
    return _model(t, "openalex_index.awards").select("doi", _lines(F.col("awards"), "award_id").alias("awards"))


@query(f"WITH {_SOURCES} {_GRAPH_FUNDERS}")
def model_openalex_funders(t):
    """Funders of the primary work of each DOI."""
    return _model(t, "openalex_index.funders").select("id", "doi", _lines(F.col("funders"), "name", "ror").alias("items"))


_GRAPH_INDEX = f"""SELECT prime.doi, ti.title, ab.abstract AS abstract_text, coalesce(upper(replace(ow.type, '-', '_')), 'OTHER') AS work_type, strftime(up.updated_date, '%Y-%m-%d %H:%M:%S') AS updated, coalesce(awards, '') AS awards, coalesce(items, '') AS funders,
  'OpenAlex https://openalex.org/works/' || prime.id AS source FROM prime JOIN ow USING (id) LEFT JOIN ({_TITLES}) ti ON ti.doi = prime.doi LEFT JOIN ({_ABSTRACTS}) ab ON ab.doi = prime.doi
  LEFT JOIN ({_DATED.format(c='updated_date')}) up ON up.doi = prime.doi LEFT JOIN ({_GRAPH_AWARDS}) aw ON aw.doi = prime.doi LEFT JOIN ({_GRAPH_FUNDERS}) fu ON fu.id = prime.id"""


def _flat(got: DataFrame) -> DataFrame:
    return got.select("doi", "title", "abstract_text", "work_type", _time("updated_date").alias("updated"), _lines(F.col("awards"), "award_id").alias("awards"), _lines(F.col("funders"), "name", "ror").alias("funders"), F.concat_ws(" ", "source.name", "source.url").alias("source"))


@query(f"WITH {_SOURCES} {_GRAPH_INDEX}")
def model_openalex_index(t):
    return _flat(_model(t, "openalex_index.index"))


@query(f"WITH {_SOURCES}, both_ AS (SELECT doi FROM dl UNION ALL SELECT doi FROM prime) SELECT left(doi, 6) AS prefix, count(*) AS works, count(DISTINCT doi) AS dois, count(*) FILTER (doi IN (SELECT doi FROM dl)) AS datasets FROM both_ GROUP BY 1")
def model_works_index(t):
    """Both registries in one index; no DOI is in both."""
    got = _model(t, "works_index.works")
    return got.groupBy(F.substring("doi", 1, 6).alias("prefix")).agg(F.count("*").alias("works"), F.count_distinct("doi").alias("dois"), F.count_if(F.col("source.name") == "DataCite").alias("datasets"))


@query(f"""WITH {_SOURCES}, g AS ({_GRAPH_INDEX}), b AS (SELECT g.*, ow.publication_date, ow.author, ow.orcid, ow.institutions FROM g JOIN prime USING (doi) JOIN ow ON ow.id = prime.id WHERE ow.publication_date BETWEEN DATE '1994-01-01' AND DATE '1998-12-31')
SELECT doi AS work_id, publication_date, concat_ws(' ', title, abstract_text) AS content, lower(awards) AS grant_ids, lower(author) AS person_names, lower(institutions[1].name) AS affiliation_names FROM b""")
def normalised_works(t):
    """The entity lists of index works published in a window."""
    import datetime

    got = normalise.works(_model(t, "openalex_index.index"), datetime.date(1994, 1, 1), datetime.date(1998, 12, 31))
    return got.select("work_id", "publication_date", F.coalesce("content", F.lit("")).alias("content"), *[F.array_join(c, ";").alias(c) for c in ("grant_ids", "person_names", "affiliation_names")])
