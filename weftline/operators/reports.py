"""Reports and exports over plan records, and repairs of them: each a DataFrame to a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, NumericType, StringType, StructType

from weftline.functions import clean

from .hub import LATEST

_FLAT = {
    "tool_id": "pk", "dmp_created": "created", "dmp_modified": "modified", "dmp_doi_registered": "registered", "dmp_visibility": "visibility",
    "project_start": "project_start", "project_end": "project_end", "repositories": "repos", "repository_ids": "repo_ids",
} | {c: c for c in "affiliations affiliation_ids people people_ids funders funder_ids funder_opportunity_ids grant_ids".split()}


def of_organisations(df: DataFrame, ids: list[str], column: str = "affiliation_ids") -> DataFrame:
    """Records whose list has any of the ids."""
    return df.where(F.coalesce(F.arrays_overlap(column, F.array(*[F.lit(i) for i in ids])), F.lit(False)))


def having(df: DataFrame, column: str, more_than: int = 0) -> DataFrame:
    """Records that have the list, with more than so many members."""
    return df.where(F.col(column).isNotNull() & (F.size(column) > more_than))


def flat_export(plans: DataFrame) -> DataFrame:
    """Plan records as the flat rows that matching reads: renamed, id as a web address, texts stripped."""
    named = {new: F.col(old) for new, old in _FLAT.items()}
    return plans.select(F.concat(F.lit("https://"), "dmp_id").alias("dmp_id"), clean.strip(F.col("title")).alias("title"), F.replace(clean.strip(F.col("description")), F.lit("\t\r\n"), F.lit(" ")).alias("abstract"), *[c.alias(n) for n, c in named.items()])


def harvested_outputs(mods: DataFrame) -> DataFrame:
    """``dmp_id, id`` and the fields of each related work (a map by id); of a plan's records the first (by sk) that has an id counts."""
    rows = mods.select(F.regexp_replace("pk", "PK#", "https://").alias("dmp_id"), "sk", F.explode("related_works").alias("id", "work"))
    first = rows.groupBy("dmp_id", "id").agg(F.min_by("work", "sk").alias("work"))
    return first.select("dmp_id", "id", "work.*")


def match_report(lines: DataFrame, organisations: DataFrame, pilots: DataFrame, least: float = 10.0) -> DataFrame:
    """A row for each match of weight ``least`` or more with a title, and each listed organisation that plan and work share.

    ``lines``: dmp_doi, provenance, affiliation_ids, matches array<struct(match_doi, weighted_count, affiliation_ids, title, type,
    container_title, publisher, publication_date, volume, issue, page, authors array<struct(given, family)>)>; ``organisations``:
    affiliation_id, affiliation_name; ``pilots``: dmp_doi.
    """
    m = F.col("m")
    places = F.array_compact(F.array(*[F.when(m[f].isNotNull(), F.concat(F.lit(f"{short}: "), m[f])) for f, short in (("volume", "vol"), ("issue", "iss"), ("page", "pgs"))]))
    authors = F.array_join(F.transform(m["authors"], lambda a: F.concat_ws(" ", a["given"], a["family"])), " | ")
    # concat_ws keeps no space for a missing part
    marked = lines.distinct().join(pilots.select("dmp_doi").distinct().withColumn("pilot", F.lit(True)), "dmp_doi", "left")
    rows = marked.select("dmp_doi", F.coalesce("pilot", F.lit(False)).alias("is_pilot_dmp"), "provenance", "affiliation_ids", F.explode("matches").alias("m")).where((m["weighted_count"] >= least) & m["title"].isNotNull())
    rows = rows.select(
        F.explode(F.array_intersect("affiliation_ids", m["affiliation_ids"])).alias("affiliation_id"), F.regexp_replace("dmp_doi", "^DMP#", "https://").alias("dmp_id"), "is_pilot_dmp", "provenance",
        F.concat(F.lit("https://doi.org/"), m["match_doi"]).alias("related_work"), *[m[f].alias(n) for n, f in (("type", "type"), ("container", "container_title"), ("publisher", "publisher"), ("publication_date", "publication_date"), ("title", "title"))],
        F.array_join(places, ", ").alias("location"), authors.alias("authors"), m["weighted_count"].alias("weighted_score"),
    )
    return rows.join(organisations.select("affiliation_id", "affiliation_name"), "affiliation_id")


def _narrative(x: Column) -> Column:
    return F.coalesce((x["descriptor"] == "is_metadata_for") & (x["work_type"] == "output_management_plan"), F.lit(False))


def without_narrative(plans: DataFrame, related: str = "related") -> DataFrame:
    """Public plans whose related identifiers hold no narrative; plans without the list are not reported."""
    return plans.where((F.col("visibility") == "public") & F.col(related).isNotNull() & ~F.exists(related, _narrative))


def _uncited(x: Column) -> Column:
    plain = F.coalesce(clean.strip(x["work_type"]), F.lit("")) != "output_management_plan"
    return F.coalesce((x["type"] == "doi") & plain & clean.blank_to_null(x["citation"]).isNull(), F.lit(False))


def printable(c: Column) -> Column:
    """Printable ASCII alone, without white space."""
    return F.regexp_replace(c, r"[^\x21-\x7E]", "")


def to_cite(plans: DataFrame, related: str = "related") -> DataFrame:
    """``doi``: the distinct identifiers to look up."""
    return plans.select(F.explode(F.filter(related, _uncited)).alias("x")).select(printable(F.col("x.identifier")).alias("doi")).where("doi <> ''").distinct()


def cited(plans: DataFrame, citations: DataFrame, key: str = "pk", related: str = "related", missing: str = "No citation available.") -> DataFrame:
    """The plans with the citations (doi, citation) filled in where there was none; ``missing`` where none was found."""
    rows = plans.select(key, F.posexplode(F.filter(related, _uncited)).alias("i", "x")).select(key, printable(F.col("x.identifier")).alias("doi"))
    found = rows.distinct().join(citations.select("doi", "citation"), "doi").groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("doi", "citation"))).alias("__found"))
    out = plans.join(found, key, "left").withColumn("__found", F.coalesce("__found", F.create_map().cast("map<string,string>")))
    fill = F.transform(related, lambda x: x.withField("citation", F.when(_uncited(x), F.coalesce(F.try_element_at("__found", printable(x["identifier"])), F.lit(missing))).otherwise(x["citation"])))
    return out.withColumn(related, fill).select(*plans.columns)


def owner_org(contact: Column, others: Column) -> Column:
    """The contact's organisation, else the most frequent of the others, the first of equally frequent ones."""
    known = F.array_compact(others)
    counted = F.transform(F.array_distinct(known), lambda v, i: F.struct((-F.size(F.filter(known, lambda x: x == v))).alias("n"), i.alias("i"), v.alias("v")))
    return F.coalesce(contact, F.get(F.array_sort(counted), F.lit(0))["v"])


def _tidy(c: Column, kind: DataType) -> Column:
    if isinstance(kind, StringType):
        return clean.blank_to_null(c)
    if isinstance(kind, ArrayType):
        inner = kind.elementType
        shape = (lambda x: _tidy(x, inner)) if isinstance(inner, StructType) else clean.strip if isinstance(inner, StringType) else (lambda x: x)
        return F.array_distinct(F.array_compact(F.transform(c, shape)))
    if isinstance(kind, StructType):
        return F.when(c.isNotNull(), F.struct(*[_tidy_field(c[f.name], f.name, f.dataType).alias(f.name) for f in kind.fields]))
    return F.lit(None).cast(kind)


def _tidy_field(c: Column, name: str, kind: DataType) -> Column:
    return F.when(F.coalesce(c.cast("string"), F.lit("")).isin("1", "true"), 1).otherwise(0) if name == "featured" else _tidy(c, kind)


def tidied(df: DataFrame) -> DataFrame:
    """Documents for an index, at every depth: blank texts NULL, lists without NULLs and repeats, ``featured`` 1 or 0; what is neither text,
    list nor object is NULL."""
    return df.select(*[_tidy_field(F.col(f.name), f.name, f.dataType).alias(f.name) for f in df.schema.fields])


def typed(c: Column, kind: DataType, rename: Callable[[str], str] = lambda n: n) -> Column:
    """A value as typed attributes: S text, N number as text, BOOL, L list, M object with renamed keys; NULL stays NULL."""
    if isinstance(kind, StructType):
        inner = F.struct(*[typed(c[f.name], f.dataType, rename).alias(rename(f.name)) for f in kind.fields])
        return F.when(c.isNotNull(), F.struct(inner.alias("M")))
    if isinstance(kind, ArrayType):
        return F.when(c.isNotNull(), F.struct(F.transform(c, lambda x: typed(x, kind.elementType, rename)).alias("L")))
    name = "BOOL" if isinstance(kind, BooleanType) else "N" if isinstance(kind, NumericType) else "S"
    return F.when(c.isNotNull(), F.struct((c if name == "BOOL" else c.cast("string")).alias(name)))


def converted(df: DataFrame, rename: Callable[[str], str] = lambda n: n) -> DataFrame:
    """``value``: each row as JSON of typed attributes."""
    return df.select(F.to_json(F.struct(*[typed(F.col(f.name), f.dataType, rename).alias(rename(f.name)) for f in df.schema.fields])).alias("value"))


def touched(records: DataFrame, when: Column, chosen: Column | None = None) -> DataFrame:
    """Latest versions (that are chosen) marked as modified, so that whatever follows changes takes them up again."""
    hit = (F.col("sk") == LATEST) & (F.coalesce(chosen, F.lit(False)) if chosen is not None else F.lit(True))
    return records.withColumn("modified", F.when(hit, when).otherwise(F.col("modified")))


def purged(records: DataFrame, sk: str) -> DataFrame:
    """The records without those of a kind."""
    return records.where(~F.coalesce(F.col("sk") == sk, F.lit(False)))


def notices(old: DataFrame, new: DataFrame, key: str = "pk", ignored: tuple[str, ...] = ("modified",)) -> DataFrame:
    """``pk, detail_type``: what to announce on an event bus after an update: CREATED, UPDATED or REMOVED records."""
    names = sorted(c for c in new.columns if c != key and c not in ignored)
    h = lambda d, n: d.select(key, F.md5(F.to_json(F.struct(*names), {"ignoreNullFields": "false"})).alias(n))
    both = h(old, "o").join(h(new, "n"), key, "full")
    kind = F.when(F.col("o").isNull(), "CREATED").when(F.col("n").isNull(), "REMOVED").when(F.col("o") != F.col("n"), "UPDATED")
    return both.select(key, kind.alias("detail_type")).where("detail_type is not null")


def to_files(report: DataFrame, path: str) -> None:
    """A report as JSON lines and as CSV with a header, below ``path``; lists are for JSON alone."""
    report.write.mode("overwrite").json(f"{path}/json")
    flat = [c for c, t in report.dtypes if not t.startswith(("array", "struct", "map"))]
    report.select(*flat).write.mode("overwrite").option("header", "true").csv(f"{path}/csv")
