"""Column functions one by one over values made of the given tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftline.functions import awards, clean, kinds
from weftline.operators import match
from weftline.sources import readers

from .base import query
from .registry import _s


@query(r"""SELECT c_custkey, lower('0R' || c_custkey) AS loose, lower('00000001' || c_custkey) AS isni, '0000000121' || lpad((c_custkey % 100000)::VARCHAR, 5, '0') || 'X' AS isni_digits, CASE WHEN c_custkey % 2 = 0 THEN '0abcdef' || lpad((c_custkey % 100)::VARCHAR, 2, '0') ELSE (987654321 + c_custkey)::VARCHAR END AS any_id,
  CASE c_custkey % 3 WHEN 0 THEN (c_custkey + 10000)::VARCHAR WHEN 1 THEN 'nsf-' || c_custkey END AS award_no, 'PLAN#10.9999/d' || c_custkey AS plan_key, 'PROVENANCE#' || c_mktsegment AS provenance, '1-' || c_custkey AS pages, 'https://ror.org/0' || c_custkey AS ror, CASE WHEN c_custkey % 2 = 0 THEN c_name END AS public_name,
  lower(c_mktsegment) AS bare, trim(c_mktsegment) AS tags, round(1 - (c_acctbal + 1000.0) / 11000.0, 6) AS near FROM customer""")
def identifier_values(t):
    c, seg = F.col("c_custkey"), F.col("c_mktsegment")
    award = F.when(c % 3 == 0, _s("https://x/y?AWD_ID=", c + 10000, "&z")).when(c % 3 == 1, _s("NSF nsf-", c)).otherwise("none 12")
    got = {
        "loose": clean.loose_identifier(_s(" HTTPS://ror.org/0R", c)), "isni": clean.isni(_s("0000 0001 ", c)), "isni_digits": clean.isni_digits(_s("ISNI 0000 0001 21", F.substring(F.lpad((c % 100000).cast("string"), 5, "0"), 1, 2), " ", F.substring(F.lpad((c % 100000).cast("string"), 5, "0"), 3, 3), "X")),
        "any_id": clean.any_id(F.when(c % 2 == 0, _s("https://ror.org/0abcdef", F.lpad((c % 100).cast("string"), 2, "0"))).otherwise(_s("10.13039/", c + 987654321))), "award_no": clean.grant_id(award), "plan_key": clean.plan_key(_s("https://doi.org/10.9999/D", c)),
        "provenance": clean.provenance_key(_s("PROVENANCE#", seg)), "pages": clean.page_range(F.lit("1"), _s(c)), "ror": clean.collapse_ror_url(_s("https://ror.org/https://ror.org/0", c)), "public_name": clean.public_name(F.when(c % 2 == 0, F.col("c_name")).otherwise(_s(F.col("c_name"), "@x.org"))),
        "bare": clean.bare_name(_s(seg, " (US) ")), "tags": clean.strip(clean.strip_tags(_s("<p>", seg, "</p>"))), "near": F.round(clean.nearness(F.col("c_acctbal"), F.lit(-1000.0), F.lit(10000.0)), 6),
    }
    return t("customer").select("c_custkey", *[v.alias(k) for k, v in got.items()])


@query(r"""SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN 'A|Ann|M|Maria|Berg' WHEN 1 THEN 'A|Ann|MM|M. Maria|van der Berg' WHEN 2 THEN 'A|Ann|-|-|de la Cruz' WHEN 3 THEN '-|-|-|-|-' ELSE 'Z|Zoë|-|-|Berg' END || c_custkey AS parts,
  CASE c_custkey % 5 WHEN 0 THEN 'ann maria berg' WHEN 1 THEN 'prof. ann m. maria van der berg' WHEN 2 THEN 'ann de la cruz' WHEN 3 THEN 'plato' ELSE 'zoë berg' END || CASE WHEN c_custkey % 5 = 4 THEN '' ELSE c_custkey::VARCHAR END AS author FROM customer""")
def parsed_names(t):
    """Given names, initials, particles, titles, single words and turned names."""
    c = F.col("c_custkey")
    kind = c % 5
    name = F.when(kind == 0, _s("Ann Maria Berg", c)).when(kind == 1, _s("Prof. Ann M. Maria van der Berg", c)).when(kind == 2, _s("de la Cruz", c, ", Ann")).when(kind == 3, _s("Plato", c)).otherwise(_s("Dr Zoë  Berg", c))
    p = clean.parsed_name(name)
    fields = F.concat_ws("|", *[F.coalesce(p[f], F.lit("-")) for f in ("first_initial", "given_name", "middle_initials", "middle_names", "surname")])
    parts = F.when(kind == 3, F.concat(fields, c.cast("string"))).otherwise(fields)
    author = F.when(kind == 4, clean.author_name(F.lit("Berg, Zoë (x)"))).otherwise(clean.author_name(name))
    return t("customer").select("c_custkey", parts.alias("parts"), author.alias("author"))


def _nih_variants_sql() -> str:
    base, dated, full = "'AI ' || no", "'AI ' || no || '-02'", "'AI ' || no || '-02S1'"
    spaced = f"[{base}, {dated}, {full}]"
    tight = "list_transform(b, lambda x: replace(x, ' ', ''))"
    return f"""WITH p AS (SELECT p_partkey, lpad((p_partkey % 1000000)::VARCHAR, 6, '0') AS no FROM part), f AS (SELECT p_partkey, {spaced} AS b FROM p), g AS (SELECT p_partkey, list_concat(b, {tight}) AS x FROM f),
h AS (SELECT p_partkey, list_concat(x, list_concat(list_transform(x, lambda v: 'R01 ' || v), list_transform(x, lambda v: 'R01' || replace(v, ' ', '')))) AS x FROM g),
i AS (SELECT p_partkey, list_concat(x, list_concat(list_transform(x, lambda v: '5 ' || v), list_transform(x, lambda v: '5' || replace(v, ' ', '')))) AS x FROM h)
SELECT p_partkey, array_to_string(list_sort(list_distinct(x)), ',') AS variants FROM i"""


@query(_nih_variants_sql())
def award_nih_variants(t):
    """Every spelling of an award by value."""
    text = _s("5r01ai", F.lpad((F.col("p_partkey") % 1000000).cast("string"), 6, "0"), "-02S1")
    return readers.spread(t("part")).select("p_partkey", F.array_join(awards.nih_variants(awards.nih(text)), ",").alias("variants"))


_NO = "lpad((p_partkey % 10000000)::VARCHAR, 7, '0')"


@query(rf"""SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN {_NO} || ',DMR ' || {_NO} || ',DMR-' || {_NO} ELSE {_NO} END AS variants, 'https://www.nsf.gov/awardsearch/showAward?AWD_ID=' || {_NO} || '&HistoricalAwards=false' AS url, 'https://reporter.nih.gov/project-details/' || p_partkey AS nih_url,
  CASE p_size % 3 WHEN 0 THEN 'R01AI' || right({_NO}, 6) WHEN 1 THEN {_NO} ELSE '' END AS parsed FROM part""")
def award_nsf_variants(t):
    no, size = F.lpad((F.col("p_partkey") % 10000000).cast("string"), 7, "0"), F.col("p_size")
    a = awards.nsf(F.when(size % 2 == 0, _s("NSF-DMR", no)).otherwise(no))
    text = F.when(size % 3 == 0, _s("x; r01 ai", F.substring(no, 2, 6), ",r01ai", F.substring(no, 2, 6))).otherwise(_s("none; ", no))
    funder = F.when(size % 3 == 0, awards.NIH).when(size % 3 == 1, awards.NSF).otherwise("other")
    return t("part").select("p_partkey", F.array_join(awards.nsf_variants(a), ",").alias("variants"), awards.nsf_url(a).alias("url"), awards.nih_url(F.col("p_partkey")).alias("nih_url"), F.array_join(awards.parsed(funder, text), ",").alias("parsed"))


@query(r"""SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN '10.7/p' || p_partkey END AS doi, p_brand AS journal, '2019' AS year, 'On ' || p_name AS title FROM part""")
def award_references(t):
    r = awards.reference(F.concat(F.col("p_brand"), F.lit("~ 2019 ~N~~On "), F.col("p_name"), F.when(F.col("p_size") % 2 == 0, _s("~https://doi.org/10.7/P", F.col("p_partkey"))).otherwise(""), F.lit("~05/03/2019 04:03:03 AM")))
    return t("part").select("p_partkey", "p_brand", "p_size", r.alias("r")).select("p_partkey", "r.doi", "r.journal", "r.year", "r.title")


@query("""SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'article' WHEN 1 THEN 'book' WHEN 2 THEN 'book-chapter' WHEN 3 THEN 'other' END AS article, CASE p_partkey % 5 WHEN 0 THEN 'dataset' WHEN 1 THEN 'article' WHEN 2 THEN 'audio-visual' WHEN 3 THEN 'other' END AS dataset FROM part""")
def type_maps(t):
    k = F.col("p_partkey") % 5
    one = F.when(k == 0, "journal-article").when(k == 1, "monograph").when(k == 2, "book-part").when(k == 3, "nonsense")
    two = F.when(k == 0, "Dataset").when(k == 1, "ConferencePaper").when(k == 2, "Film").when(k == 3, "nonsense")
    return t("part").select("p_partkey", kinds.lookup(one, kinds.ARTICLE_TYPES).alias("article"), kinds.lookup(two, kinds.DATASET_TYPES).alias("dataset"))


@query("""SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN y || ',' || m || ',' || d WHEN 1 THEN y || ',' || m WHEN 2 THEN y::VARCHAR WHEN 3 THEN y || ',' || m || ',' || d ELSE '' END AS parts FROM (SELECT o_orderkey, year(o_orderdate) AS y, month(o_orderdate) AS m, day(o_orderdate) AS d FROM orders)""")
def date_texts(t):
    """Dates as y-m-d, y/m, y/y, by a timestamp instead, or not at all."""
    k, d = F.col("o_orderkey") % 5, F.col("o_orderdate")
    text = F.when(k == 0, F.date_format(d, " yyyy-MM-dd")).when(k == 1, F.date_format(d, "yyyy/M")).when(k == 2, F.date_format(d, "yyyy'/'yyyy")).otherwise("soon")
    parts = clean.parts_of_text(text, F.when(k < 4, F.to_date(d)))
    return t("orders").select("o_orderkey", F.array_join(F.transform(parts, lambda x: x.cast("string")), ",").alias("parts"))


@query(r"""SELECT p_partkey, 'etude ' || lower(p_name) || ' 2 co' AS comparable, upper(left(p_name, 1)) || substr(p_name, 2) AS name FROM part""")
def comparable_titles(t):
    """Titles folded to ASCII, without punctuation, and names in camel case."""
    return t("part").select("p_partkey", clean.comparable(_s(" Étude:  ", F.upper("p_name"), " – 2 & Co.")).alias("comparable"), F.concat(F.upper(F.substring("p_name", 1, 1)), F.expr("substring(p_name, 2)")).alias("name"))


@query(r"""
WITH w AS (SELECT doc_id, string_split(text, ' ') AS ws, text FROM (SELECT doc_id, regexp_replace(regexp_replace(text, '\s+', ' ', 'g'), '^ | $', '', 'g') AS text FROM documents)),
p AS (SELECT doc_id, unnest(range(1, greatest(len(text) // 160 + 1, 1) + 1)) AS i, text FROM w)
SELECT doc_id, contains(lower(text), 'benchmark') AS seen FROM w""")
def fragments(t):
    """Whether a text has a fragment with a term: exactly where it holds the word or a part of it is told apart by its tag."""
    marked = match.fragments(F.regexp_replace("text", "(?i)benchmark", " benchmark "), F.array(F.lit("benchmark")))
    return t("documents").select("doc_id", (F.size(marked) > 0).alias("seen"))
