"""The works index: named models over clean registry tables, built in order of what they need.

A model is a function of the tables it names; nothing is materialised between models unless it is asked for, so
Catalyst sees one plan for each output.  Relations of many consumers are written once (kind FULL) by :func:`build`.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from weftline.functions import clean, kinds

Tables = dict[str, DataFrame]


class Model(NamedTuple):
    name: str
    needs: tuple[str, ...]
    build: Callable[..., DataFrame]
    kind: str  # VIEW or FULL
    unique: tuple[str, ...]


MODELS: dict[str, Model] = {}


def model(name: str, *needs: str, kind: str = "VIEW", unique: tuple[str, ...] = ()) -> Callable:
    def add(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        MODELS[name] = Model(name, needs, f, kind, unique)
        return f

    return add


def latest_per_key(df: DataFrame, key: str, when: str, *ties: str) -> DataFrame:
    """One row for each key: the newest, NULL dates last; ``ties`` decide, then the whole row."""
    rest = [F.col(c).asc_nulls_last() for c in ties] or [F.xxhash64(*df.columns)]
    w = Window.partitionBy(key).orderBy(F.col(when).desc_nulls_last(), *rest)
    return df.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def newest_of(key: str, when: str, *sources: DataFrame) -> DataFrame:
    """The latest date of each key in any source; keys without one are left out."""
    every = sources[0].select(key, when)
    for s in sources[1:]:
        every = every.unionByName(s.select(key, when))
    return every.where(F.col(when).isNotNull()).groupBy(key).agg(F.max(when).alias(when))


def longest(stats: DataFrame, length: str) -> DataFrame:
    """``id, doi, length`` by DOI: the row with the longest text; the smallest id for ties and where all are NULL."""
    order = F.struct((-F.coalesce(F.col(length), F.lit(-1))).alias("n"), F.col("id").alias("id"))
    return stats.groupBy("doi").agg(F.min(order)["id"].alias("id"), F.max(length).alias(length)).select("id", "doi", length)


class Lookup(NamedTuple):
    """A list column whose items are looked up: ``items`` by field ``match`` in ``index`` (``index_id`` to ``index_ror``), ``name`` kept, as ``out``."""

    items: str
    match: str
    name: str
    index: DataFrame
    index_id: str
    index_ror: Column
    out: str


def looked_up(df: DataFrame, *lookups: Lookup) -> DataFrame:
    """``df`` with each list as struct(name, ror) in order: a NULL or unknown id keeps its name, an id of several organisations gives several items.

    An id of very many organisations makes long lists, so these are gathered once for each distinct list of ids and joined last: rows are
    shuffled with their ids alone, whatever the lists become.
    """
    keys = [f"__ids{n}" for n in range(len(lookups))]
    ids = [F.coalesce(F.transform(x.items, partial(_field, x.match)), F.array().cast("array<string>")).alias(k) for k, x in zip(keys, lookups)]
    lists = df.select(*ids).distinct()
    for k, x in zip(keys, lookups):
        found = x.index.select(F.col(x.index_id).cast("string").alias("__id"), F.struct(x.index_ror.alias("ror")).alias("r")).groupBy("__id").agg(F.sort_array(F.collect_list("r"))["ror"].alias("rors"))
        each = lists.select(k).distinct().select(k, F.posexplode(k).alias("pos", "__id")).join(found, "__id", "left")
        unknown = F.array(F.lit(None).cast(found.schema["rors"].dataType.elementType))
        lists = lists.join(each.groupBy(k).agg(clean.in_order(F.col("pos"), F.coalesce("rors", unknown)).alias(f"{k}r")), k, "left")
    out = df.select("*", *ids).join(lists, keys)
    for k, x in zip(keys, lookups):
        pairs = F.zip_with(x.items, f"{k}r", partial(_named, x.name))
        out = out.withColumn(x.out, F.when(F.size(k) > 0, F.flatten(pairs)))
    return out.drop(*keys, *[f"{k}r" for k in keys])


def _field(name: str, item: Column) -> Column:
    return item[name].cast("string")


def _named(name: str, item: Column, rors: Column) -> Column:
    return F.transform(rors, lambda r: F.struct(item[name].alias("name"), r.alias("ror")))


def crosswalk(df: DataFrame, key: list[str], items: str, match: str, name: str, index: DataFrame, index_id: str, index_ror: Column) -> DataFrame:
    """The :func:`looked_up` items of a list by ``key``, which is unique; rows without items are left out."""
    out = items if items != "grants" else "funders"
    return looked_up(df.where(F.size(items) > 0), Lookup(items, match, name, index, index_id, index_ror, "__out")).select(*key, F.col("__out").alias(out))


def award_structs(df: DataFrame) -> DataFrame:
    """Distinct awards by DOI as array of struct(award_id), in order of lower case."""
    got = df.where("award_id is not null").groupBy("doi").agg(clean.distinct_sorted(F.col("award_id")).alias("a"))
    return got.select("doi", F.transform("a", lambda x: F.struct(x.alias("award_id"))).alias("awards"))


def empty_if_null(df: DataFrame, column: str) -> Column:
    return F.coalesce(F.col(column), F.array().cast(df.schema[column].dataType)).alias(column)


@model("crossref_index.works_metadata", "crossref.works", unique=("doi",))
def crossref_lengths(works: DataFrame) -> DataFrame:
    return works.select("doi", F.length("title").alias("title_length"), F.length("abstract").alias("abstract_length"))


@model("datacite_index.works", "datacite.works", kind="FULL", unique=("doi",))
def datacite_latest(works: DataFrame) -> DataFrame:
    return latest_per_key(works, "doi", "updated_date")


@model("datacite_index.types", "datacite_index.works", unique=("doi",))
def datacite_types(works: DataFrame) -> DataFrame:
    """Types in the map; others are left out."""
    return works.select("doi", kinds.lookup(F.col("type"), kinds.INDEX_TYPES, None).alias("type")).where("type is not null")


@model("datacite_index.updated_dates", "datacite_index.works", "openalex.works", unique=("doi",))
def datacite_dates(works: DataFrame, graph: DataFrame) -> DataFrame:
    return newest_of("doi", "updated_date", works, graph)


@model("datacite_index.institutions", "datacite_index.works", "ror.index", unique=("doi",))
def datacite_institutions(works: DataFrame, ror: DataFrame) -> DataFrame:
    return crosswalk(works, ["doi"], "institutions", "affiliation_identifier", "name", ror, "identifier", F.col("ror_id"))


@model("datacite_index.funders", "datacite_index.works", "ror.index", unique=("doi",))
def datacite_funders(works: DataFrame, ror: DataFrame) -> DataFrame:
    return crosswalk(works, ["doi"], "funders", "funder_identifier", "funder_name", ror, "identifier", F.col("ror_id"))


@model("datacite_index.awards", "datacite_index.works", "openalex.works", unique=("doi",))
def datacite_awards(works: DataFrame, graph: DataFrame) -> DataFrame:
    own = works.select("doi", F.explode("funders.award_number").alias("award_id"))
    other = graph.join(works.select("doi"), "doi", "left_semi").select("doi", F.explode("grants.award_id").alias("award_id"))
    return award_structs(own.unionByName(other))


_DATACITE_PARTS = ("datacite_index.works", "datacite_index.types", "datacite_index.updated_dates", "ror.index", "datacite_index.awards")


@model("datacite_index.index", *_DATACITE_PARTS, kind="FULL", unique=("doi",))
def datacite_index(works: DataFrame, types: DataFrame, dates: DataFrame, ror: DataFrame, awards: DataFrame) -> DataFrame:
    """Institutions and funders as in their models, but looked up last: joined by DOI, their lists would be shuffled."""
    base = works.select("doi", "title", F.col("abstract").alias("abstract_text"), "publication_date", "publication_venue", "authors", F.col("institutions").alias("__places"), F.col("funders").alias("__funds"))
    for part in (types, dates, awards):
        base = base.join(part, "doi", "left")
    base = looked_up(base, Lookup("__places", "affiliation_identifier", "name", ror, "identifier", F.col("ror_id"), "institutions"), Lookup("__funds", "funder_identifier", "funder_name", ror, "identifier", F.col("ror_id"), "funders"))
    source = F.struct(F.lit("DataCite").alias("name"), F.concat(F.lit("https://commons.datacite.org/doi.org/"), "doi").alias("url"))
    return base.select("doi", "title", "abstract_text", F.coalesce("type", F.lit("OTHER")).alias("work_type"), "publication_date", "updated_date", "publication_venue", empty_if_null(base, "institutions"), "authors", empty_if_null(base, "funders"), empty_if_null(base, "awards"), source.alias("source"))


def ranked_duplicates(df: DataFrame, key: str, ident: str, counts: list[str]) -> DataFrame:
    """Adds ``doi_count, total_count, doi_rank, is_duplicate, is_primary_doi``: rows of one key, the richest first."""
    by = Window.partitionBy(key)
    out = df.withColumn("total_count", sum((F.col(c) for c in counts[1:]), F.col(counts[0])))
    out = out.withColumns({"doi_count": F.count("*").over(by), "doi_rank": F.row_number().over(by.orderBy(F.desc("total_count"), F.col(ident).asc_nulls_last())).cast("long")})
    return out.withColumns({"is_duplicate": F.col("doi_count") > 1, "is_primary_doi": F.col("doi_rank") == 1})


@model("openalex_index.works_metadata", "openalex.works", "datacite.works", kind="FULL", unique=("id",))
def openalex_metadata(works: DataFrame, datasets: DataFrame) -> DataFrame:
    """Works whose DOI no dataset has, with counts of distinct ids; counted within the row, so only the DOI is shuffled."""
    base = works.where("doi is not null").join(datasets.select("doi"), "doi", "left_anti")
    kinds_of = lambda items, field: F.size(F.array_distinct(F.array_compact(F.coalesce(F.col(f"{items}.{field}"), F.array().cast("array<string>"))))).cast("long")
    known = sum((F.col(f"ids.{i}").isNotNull().cast("long") for i in ("mag", "pmid", "pmcid")), F.lit(0).cast("long"))
    slim = base.select("id", "doi", F.length("title").alias("title_length"), F.length("abstract").alias("abstract_length"), known.alias("id_count"), kinds_of("authors", "orcid").alias("orcid_count"), kinds_of("grants", "funder_id").alias("funder_id_count"), kinds_of("grants", "award_id").alias("award_id_count"), kinds_of("institutions", "ror").alias("inst_id_count"))
    return ranked_duplicates(slim, "doi", "id", ["id_count", "orcid_count", "funder_id_count", "award_id_count", "inst_id_count"])


def _stats(meta: DataFrame, other: DataFrame, length: str) -> DataFrame:
    both = meta.join(other.select("doi", F.col(length).alias("__other")), "doi", "left").where((F.col(length) > 0) | (F.col("__other") > 0))
    return longest(both.select("id", "doi", length), length)


@model("openalex_index.title_stats", "openalex_index.works_metadata", "crossref_index.works_metadata", unique=("doi",))
def title_stats(meta: DataFrame, other: DataFrame) -> DataFrame:
    """The work with the longest title for each DOI; a DOI of one work is that work."""
    return _stats(meta, other, "title_length")


@model("openalex_index.abstract_stats", "openalex_index.works_metadata", "crossref_index.works_metadata", unique=("doi",))
def abstract_stats(meta: DataFrame, other: DataFrame) -> DataFrame:
    return _stats(meta, other, "abstract_length")


def strictly_longer(own: Column, own_length: Column, other: Column, other_length: Column) -> Column:
    """The other text if it is longer or the only one."""
    return F.when((other_length > own_length) | (other_length.isNotNull() & own_length.isNull()), other).otherwise(own)


def _texts(stats: DataFrame, works: DataFrame, other: DataFrame, field: str) -> DataFrame:
    n = f"{field}_length"
    own = works.select("id", F.col(field).alias("__own"))
    cross = other.select("doi", F.col(field).alias("__other"))
    both = stats.join(own, "id", "left").join(cross, "doi", "left")
    return both.select("doi", strictly_longer(F.col("__own"), F.col(n), F.col("__other"), F.length("__other")).alias(field))


@model("openalex_index.titles", "openalex_index.title_stats", "openalex.works", "crossref.works", unique=("doi",))
def titles(stats: DataFrame, works: DataFrame, other: DataFrame) -> DataFrame:
    return _texts(stats, works, other, "title")


@model("openalex_index.abstracts", "openalex_index.abstract_stats", "openalex.works", "crossref.works", unique=("doi",))
def abstracts(stats: DataFrame, works: DataFrame, other: DataFrame) -> DataFrame:
    return _texts(stats, works, other, "abstract")


def _dated(meta: DataFrame, works: DataFrame, other: DataFrame, when: str) -> DataFrame:
    own = meta.select("id", "doi").join(works.select("id", when), "id")
    return newest_of("doi", when, own, other.join(meta.select("doi"), "doi", "left_semi"))


@model("openalex_index.publication_dates", "openalex_index.works_metadata", "openalex.works", "crossref.works", unique=("doi",))
def publication_dates(meta: DataFrame, works: DataFrame, other: DataFrame) -> DataFrame:
    """Not used by the index itself."""
    return _dated(meta, works, other, "publication_date")


@model("openalex_index.updated_dates", "openalex_index.works_metadata", "openalex.works", "crossref.works", unique=("doi",))
def updated_dates(meta: DataFrame, works: DataFrame, other: DataFrame) -> DataFrame:
    return _dated(meta, works, other, "updated_date")


@model("openalex_index.awards", "openalex_index.works_metadata", "openalex.works", "crossref.works_funders", unique=("doi",))
def openalex_awards(meta: DataFrame, works: DataFrame, funders: DataFrame) -> DataFrame:
    own = meta.select("id", "doi").join(works.select("id", "grants"), "id").select("doi", F.explode("grants.award_id").alias("award_id"))
    other = funders.select(F.col("work_doi").alias("doi"), F.col("award").alias("award_id")).join(meta.select("doi"), "doi", "left_semi")
    return award_structs(own.unionByName(other))


@model("openalex_index.funders", "openalex_index.works_metadata", "openalex.works", "openalex.funders", unique=("id",))
def openalex_funders(meta: DataFrame, works: DataFrame, funders: DataFrame) -> DataFrame:
    first = meta.where("is_primary_doi").select("id", "doi").join(works.select("id", "grants"), "id")
    return crosswalk(first, ["id", "doi"], "grants", "funder_id", "funder_display_name", funders, "id", F.col("ids.ror"))


_OPENALEX_PARTS = ("openalex_index.works_metadata", "openalex.works", *(f"openalex_index.{p}" for p in ("titles", "abstracts", "updated_dates", "awards", "funders")))


@model("openalex_index.index", *_OPENALEX_PARTS, kind="FULL", unique=("doi",))
def openalex_index(meta: DataFrame, works: DataFrame, titles: DataFrame, abstracts: DataFrame, dates: DataFrame, awards: DataFrame, funders: DataFrame) -> DataFrame:
    base = meta.where("is_primary_doi").select("id", "doi").join(works.select("id", "type", "publication_date", "publication_venue", "institutions", "authors"), "id", "left")
    for part in (titles, abstracts, dates, awards):
        base = base.join(part, "doi", "left")
    base = base.join(funders.drop("doi"), "id", "left")
    source = F.struct(F.lit("OpenAlex").alias("name"), F.concat(F.lit("https://openalex.org/works/"), "id").alias("url"))
    return base.select("doi", "title", F.col("abstract").alias("abstract_text"), kinds.index_type(F.col("type")).alias("work_type"), "publication_date", "updated_date", "publication_venue", "institutions", "authors", empty_if_null(base, "funders"), empty_if_null(base, "awards"), source.alias("source"))


@model("works_index.works", "datacite_index.index", "openalex_index.index", kind="FULL", unique=("doi",))
def works_index(datasets: DataFrame, graph: DataFrame) -> DataFrame:
    return union_by_name(datasets, graph)


def union_by_name(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of both, matched by name inside structs too."""
    return a.unionByName(b.select(*[F.col(c).cast(a.schema[c].dataType) if b.schema[c].dataType == a.schema[c].dataType else F.col(c) for c in a.columns]))


def ordered(wanted: list[str], given: set[str]) -> list[str]:
    """The models to build, each after what it needs."""
    out: list[str] = []

    def visit(name: str) -> None:
        if name in given or name in out:
            return
        if name not in MODELS:
            raise KeyError(f"no table or model {name}")
        for need in MODELS[name].needs:
            visit(need)
        out.append(name)

    for name in wanted:
        visit(name)
    return out


def build(sources: Tables, wanted: list[str] | None = None, folder: str | None = None) -> Tables:
    """All tables and models.  With a folder, FULL models are written there as Parquet and read back by those after them."""
    tables = dict(sources)
    for name in ordered(wanted or list(MODELS), set(sources)):
        m = MODELS[name]
        df = m.build(*[tables[n] for n in m.needs])
        if folder and m.kind == "FULL":
            path = f"{folder}/{name}"
            df.write.mode("overwrite").parquet(path)
            df = df.sparkSession.read.parquet(path)
        tables[name] = df
    return tables
