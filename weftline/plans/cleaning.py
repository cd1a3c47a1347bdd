"""Clean-up functions over pages, documents, orders and parts."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftline.functions import awards, clean, kinds

from .base import query

_WS = r"'^\s+|\s+$', '', 'g'"


@query(r"""SELECT page_id, regexp_replace(regexp_replace(replace(replace(html, '&lt;', '<'), '&gt', '>'), '<[^>]*>', '', 'g'), '[''"]', '', 'g') AS text,
  regexp_replace(replace(replace(html, '&lt;', '<'), '&gt;', '>'), '<[^>]*>', '', 'g') AS stripped FROM pages""")
def remove_markup(t):
    return t("pages").select("page_id", clean.remove_markup(F.col("html")).alias("text"), clean.strip_html(F.col("html")).alias("stripped"))


@query(rf"""SELECT page_id, regexp_replace(regexp_replace(lower(url), {_WS}), '^https?://[^/]+/', '') AS path,
  regexp_replace(lower(trim('https://doi.org/10.' || (1000 + page_id) || '/' || url)), '^(https?://)?doi\.org/', '') AS doi,
  lower(nullif(regexp_extract('see 10.' || page_id || '.5/' || url || ' end', '(?i)10\.[0-9.]+/[^\s]+'), '')) AS found_doi FROM pages""")
def normalise_identifiers(t):
    url = F.col("url")
    made = F.concat(F.lit("https://doi.org/10."), (F.col("page_id") + 1000).cast("string"), F.lit("/"), url)
    text = F.concat(F.lit("see 10."), F.col("page_id").cast("string"), F.lit(".5/"), url, F.lit(" end"))
    return t("pages").select("page_id", clean.identifier(url).alias("path"), clean.doi(made).alias("doi"), clean.doi_in(text).alias("found_doi"))


@query(r"""SELECT doc_id, nullif(regexp_extract(lower(text), '[0-9]{4}-[0-9]{4}-[0-9]{4}-[0-9]{3}[0-9x]'), '') AS orcid,
  nullif(regexp_extract(text, '0[a-hj-km-np-tv-z|0-9]{6}[0-9]{2}'), '') AS ror, nullif(regexp_extract(text, 'grid\.[0-9]+\.[0-9]+'), '') AS grid,
  nullif(regexp_extract(text, 'Q[0-9]+'), '') AS wikidata, nullif(regexp_extract(text, '[0-9]{9,}'), '') AS fundref, contains(text, '@') AS has_mail,
  regexp_matches(text, '[0-9]{4}-[0-9]{4}-[0-9]{4}-[0-9]{4}') AS has_orcid FROM documents""")
def extract_ids(t):
    x = F.col("text")
    ids = {"orcid": clean.orcid(x), "ror": clean.ror(x), "grid": clean.grid(x), "wikidata": clean.wikidata(x), "fundref": clean.fundref(x), "has_mail": clean.is_email(x), "has_orcid": clean.is_orcid(x)}
    return t("documents").select("doc_id", *[v.alias(k) for k, v in ids.items()])


@query(rf"""SELECT conv_id, turn, nullif(regexp_replace(text, {_WS}), '') AS text, CASE WHEN lower(regexp_replace(role, {_WS})) NOT IN ('system', 'tool', '') THEN regexp_replace(role, {_WS}) END AS role,
  CASE WHEN role IS NOT NULL OR text IS NOT NULL THEN concat_ws(' ', role, text) END AS content FROM conversations""")
def clean_strings(t):
    return t("conversations").select("conv_id", "turn", clean.blank_to_null(F.col("text")).alias("text"), clean.null_if_in(F.col("role"), ["System", "TOOL", ""]).alias("role"), clean.content(F.col("role"), F.col("text")).alias("content"))


@query(r"""SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN CASE WHEN m <= 12 THEN last_day(make_date(y, m, 1)) END WHEN 1 THEN make_date(y, 12, 31) WHEN 2 THEN CASE WHEN m <= 12 THEN try_cast(format('{:04d}-{:02d}-{:02d}', y, m, d) AS DATE) END END AS date,
  CASE o_orderkey % 4 WHEN 0 THEN format('{:04d}-{:02d}', y, m) WHEN 1 THEN format('{:04d}', y) WHEN 2 THEN format('{:04d}-{:02d}-{:02d}', y, m, d) END AS text
FROM (SELECT o_orderkey, year(o_orderdate) AS y, o_orderkey % 13 + 1 AS m, o_orderkey % 31 + 1 AS d FROM orders)""")
def date_parts(t):
    y, m, d = F.year("o_orderdate").cast("long"), F.col("o_orderkey") % 13 + 1, F.col("o_orderkey") % 31 + 1
    parts = F.when(F.col("o_orderkey") % 4 == 0, F.array(y, m)).when(F.col("o_orderkey") % 4 == 1, F.array(y)).when(F.col("o_orderkey") % 4 == 2, F.array(y, m, d)).otherwise(F.array().cast("array<bigint>"))
    rows = t("orders").select("o_orderkey", parts.alias("p"))
    return rows.select("o_orderkey", clean.date_of_parts(F.col("p")).alias("date"), clean.date_text(F.col("p")).alias("text"))


@query(r"""SELECT o_orderkey, CASE WHEN year(e) - year(s) < 3 THEN CAST(s + INTERVAL 36 MONTH AS DATE) ELSE e END AS window_end, greatest(e, s + 1095) AS hub_end
FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS s, CAST(o_orderdate AS DATE) + (o_orderkey % 2000)::INTEGER AS e FROM orders)""")
def project_window(t):
    s = F.to_date("o_orderdate")
    rows = t("orders").select("o_orderkey", s.alias("s"), F.date_add(s, (F.col("o_orderkey") % 2000).cast("int")).alias("e"))
    return rows.select("o_orderkey", clean.window_end(F.col("s"), F.col("e")).alias("window_end"), clean.hub_window(F.col("s"), F.col("e"))["end"].alias("hub_end"))


@query(r"""SELECT event_id, json_extract_string(props, '$.k')::BIGINT AS k, CASE WHEN event_id % 3 = 0 THEN 1 WHEN event_id % 3 = 1 THEN 2 ELSE 0 END::BIGINT AS n, CASE WHEN event_id % 3 < 2 THEN event_type END AS first_name,
  CASE WHEN event_id % 3 = 1 THEN '0000-0001-2345-678x' END AS orcid FROM events""")
def json_lists(t):
    """Affiliations that are an object, a list or missing."""
    one = F.concat(F.lit('{"name":"'), F.col("event_type"), F.lit('"}'))
    made = F.when(F.col("event_id") % 3 == 0, one).when(F.col("event_id") % 3 == 1, F.concat(F.lit("["), one, F.lit(',{"schemeUri":"u"}]')))
    ids = F.when(F.col("event_id") % 3 == 1, F.lit('[{"nameIdentifier":"x","nameIdentifierScheme":"ISNI"},{"nameIdentifier":"https://orcid.org/0000-0001-2345-678X","nameIdentifierScheme":"orcid"}]'))
    got = clean.affiliations(made)
    return t("events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"), F.size(got).cast("long").alias("n"), F.get(got, F.lit(0))["name"].alias("first_name"), clean.orcid_of(ids).alias("orcid"))


@query(r"""SELECT doc_id, nullif(array_to_string(list_filter(string_split_regex(text, '[^a-zA-Z]+'), lambda x: x <> ''), ' '), '') AS text FROM documents""")
def revert_inverted_index(t):
    """An inverted index made of each document's ASCII words, turned back into text."""
    words = F.filter(F.split("text", "[^a-zA-Z]+"), lambda w: w != "")
    made = t("documents").select("doc_id", clean.word_positions(words).alias("m"))
    return made.select("doc_id", F.nullif(clean.from_positions(F.to_json("m")), F.lit("")).alias("text"))


@query(r"""SELECT p_partkey, lower(p_name) AS name, nullif(list_extract(string_split(p_name, ' '), -1), '') AS family,
  nullif(array_to_string(list_slice(string_split(p_name, ' '), 1, len(string_split(p_name, ' ')) - 1), ' '), '') AS given,
  nullif(lower(regexp_replace(trim(regexp_replace('Dr. ' || p_name, '\b(mr|mrs|ms|miss|dr|prof|sir|madam|lady|lord|rev)\.?(\s+|$)', '', 'gi')), '[-'']', '', 'g')), '') AS person FROM part""")
def person_names(t):
    n = F.col("p_name")
    parts = clean.split_name(n)
    return t("part").select("p_partkey", clean.name(n).alias("name"), parts["family"].alias("family"), parts["given"].alias("given"), clean.person_name(F.concat(F.lit("Dr. "), n)).alias("person"))


_NIH = "'R01AI' || lpad((p_partkey % 1000000)::VARCHAR, 6, '0') || CASE WHEN p_size % 3 = 0 THEN '-02' WHEN p_size % 3 = 1 THEN '-03S1' ELSE '' END"


@query(rf"""SELECT p_partkey, {_NIH} AS award, 5 * CASE WHEN p_size % 3 = 0 THEN 2 WHEN p_size % 3 = 1 THEN 3 ELSE 1 END::BIGINT AS variants FROM part""")
def award_nih(t):
    year = F.when(F.col("p_size") % 3 == 0, "-02").when(F.col("p_size") % 3 == 1, "-03S1").otherwise("")
    text = F.concat(F.lit("ro1 ai"), F.lpad((F.col("p_partkey") % 1000000).cast("string"), 6, "0"), year)
    rows = t("part").select("p_partkey", awards.nih(text).alias("a"))
    return rows.select("p_partkey", awards.nih_text(F.col("a")).alias("award"), F.size(awards.nih_variants(F.col("a"))).cast("long").alias("variants"))


_NO = "lpad((p_partkey % 10000000)::VARCHAR, 7, '0')"


@query(rf"""SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN 'DMR-' || {_NO} ELSE {_NO} END AS award, CASE p_size % 3 WHEN 0 THEN 3 ELSE 1 END::BIGINT AS variants FROM part""")
def award_nsf(t):
    no = F.lpad((F.col("p_partkey") % 10000000).cast("string"), 7, "0")
    text = F.when(F.col("p_size") % 3 == 0, F.concat(F.lit("NSF-DMR"), no)).when(F.col("p_size") % 3 == 1, F.concat(F.lit("https://x/showAward?AWD_ID="), no, F.lit("&a=b"))).otherwise(F.concat(F.lit("NSF "), no))
    rows = t("part").select("p_partkey", awards.nsf(text).alias("a"))
    return rows.select("p_partkey", awards.nsf_text(F.col("a")).alias("award"), F.size(awards.nsf_variants(F.col("a"))).cast("long").alias("variants"))


@query(r"""SELECT p_type, CASE split_part(p_type, ' ', 1) WHEN 'PROMO' THEN 'article' WHEN 'STANDARD' THEN 'dataset' ELSE 'other' END AS kind, upper(replace(p_type, '-', '_')) AS index_type, count(*) AS parts FROM part GROUP BY ALL""")
def type_map(t):
    kind = kinds.lookup(F.split("p_type", " ")[0], {"PROMO": "article", "STANDARD": "dataset"})
    return t("part").groupBy("p_type", kind.alias("kind"), kinds.index_type(F.col("p_type")).alias("index_type")).agg(F.count("*").alias("parts"))


@query(r"""SELECT c_custkey, md5('{"c_custkey":' || c_custkey || ',"c_mktsegment":"' || c_mktsegment || '","c_name":"' || c_name || '"}') AS hash FROM customer""")
def content_hash(t):
    return t("customer").select("c_custkey", clean.content_hash(["c_name", "c_custkey", "c_mktsegment"]).alias("hash"))


@query(r"""SELECT doc_id, array_to_string(list_filter(string_split_regex(regexp_replace(lower(text), '^[ \t\n\r\f]+|[ \t\n\r\f]+$', '', 'g'), '[ \t\n\r\f]+'), lambda w: w NOT IN ('a','an','and','if','of','or','the','then','they')), ' ') AS text FROM documents""")
def cleansed_text(t):
    return t("documents").select("doc_id", clean.without_stop_words(F.col("text")).alias("text"))
