"""Registry dumps as clean tables: raw schemas and, for each, raw DataFrame -> named DataFrames.

Lists are shaped within the row by higher-order functions; only child tables explode.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from weftline.functions import awards, clean
from weftline.functions.clean import first_of, identifier, present

RELATIONS = "compiles documents has-related-material is-based-on is-basis-for is-derived-from is-documented-by is-referenced-by is-related-material is-supplement-to is-supplemented-by references".split()
_LINK = "array<struct<id:string,`id-type`:string,`asserted-by`:string>>"
CROSSREF = (
    "DOI string, type string, title array<string>, abstract string, author array<struct<given:string,family:string,name:string,"
    f"ORCID:string,affiliation:array<struct<name:string,id:{_LINK}>>>>, funder array<struct<DOI:string,name:string,award:array<string>>>,"
    "`container-title` array<string>, volume string, issue string, page string, publisher string, `publisher-location` string,"
    "issued struct<`date-parts`:array<array<bigint>>>, deposited struct<`date-time`:string>, relation struct<"
    + ",".join(f"`{r}`:{_LINK}" for r in RELATIONS) + ">"
)
DATACITE = (
    "id string, attributes struct<created:string,updated:string,titles:array<struct<title:string>>,descriptions:array<struct<description:string>>,"
    "types:struct<resourceTypeGeneral:string>,container:struct<title:string>,creators:array<struct<givenName:string,familyName:string,name:string,"
    "nameType:string,affiliation:string,nameIdentifiers:string>>,fundingReferences:array<struct<funderIdentifier:string,funderIdentifierType:string,"
    "funderName:string,awardNumber:string,awardUri:string>>,publisher:struct<name:string>,relatedIdentifiers:array<struct<relationType:string,"
    "relatedIdentifier:string,relatedIdentifierType:string>>>"
)
OPENALEX_WORKS = (
    "id string, doi string, ids struct<doi:string,mag:string,openalex:string,pmid:string,pmcid:string>, title string,"
    "abstract_inverted_index string, type string, publication_date date, updated_date timestamp_ntz, authorships array<struct<author:struct<id:string,"
    "display_name:string,orcid:string>,institutions:array<struct<id:string,display_name:string,type:string,ror:string>>>>,"
    "grants array<struct<funder:string,funder_display_name:string,award_id:string>>, primary_location struct<source:struct<display_name:string,publisher:string>>"
)
OPENALEX_FUNDERS = "id string, display_name string, ids struct<crossref:string,doi:string,openalex:string,ror:string,wikidata:string>"
ROR = "id string, external_ids array<struct<type:string,all:array<string>,preferred:string>>"
PLANS = (
    "dmp_id string, created date, registered date, modified date, title string, description string, project_start date, project_end date,"
    "institutions array<struct<name:string,ror:string>>, authors array<struct<name:string,orcid:string>>,"
    "funding array<struct<funder:struct<name:string,id:string>,funding_opportunity_id:string,status:string,grant_id:string>>"
)
NAME_FIELDS = ["first_initial", "given_name", "middle_initials", "middle_names", "surname", "full"]


def _person(orcid: Column, name: Column) -> Column:
    return F.struct(orcid.alias("orcid"), *[name[f].alias(f) for f in NAME_FIELDS])


def crossref(raw: DataFrame) -> dict[str, DataFrame]:
    """Works, authors, affiliations, funders and relations of articles.  DOIs stay as they came; works without children keep a NULL row."""
    works = raw.select(
        F.col("DOI").alias("doi"),
        clean.remove_markup(F.array_join("title", " ")).alias("title"),
        clean.remove_markup(F.col("abstract")).alias("abstract"),
        "type",
        clean.date_of_parts(first_of(F.col("issued.date-parts"))).alias("publication_date"),
        clean.iso_time(F.col("deposited.date-time")).alias("updated_date"),
        F.array_join("container-title", " ").alias("container_title"),
        "volume", "issue", "page", "publisher", F.col("publisher-location").alias("publisher_location"),
    )
    people = raw.select(F.col("DOI").alias("work_doi"), F.explode_outer("author").alias("a"))
    authors = people.select("work_doi", "a.given", "a.family", "a.name", identifier(F.col("a.ORCID")).alias("orcid")).distinct()
    places = people.select("work_doi", F.explode_outer("a.affiliation").alias("p")).select("work_doi", "p.name", F.explode_outer("p.id").alias("i"))
    places = places.select("work_doi", "name", identifier(F.col("i.id")).alias("affiliation_id"), F.col("i.id-type").alias("id_type"), F.col("i.asserted-by").alias("asserted_by")).distinct()
    funders = raw.select(F.col("DOI").alias("work_doi"), F.explode_outer("funder").alias("f"))
    funders = funders.select("work_doi", "f.name", identifier(F.col("f.DOI")).alias("funder_doi"), F.explode_outer("f.award").alias("award")).distinct()
    kinds = F.array(*[F.struct(F.lit(r).alias("kind"), F.col(f"relation.{r}").alias("links")) for r in RELATIONS])
    links = raw.select(F.col("DOI").alias("work_doi"), F.explode(kinds).alias("r")).select("work_doi", F.col("r.kind").alias("relation_type"), F.explode_outer("r.links").alias("l"))
    relations = links.select("work_doi", "relation_type", identifier(F.col("l.id")).alias("relation_id"), F.col("l.id-type").alias("id_type"), F.col("l.asserted-by").alias("asserted_by")).distinct()
    return {"works": works, "works_authors": authors, "works_affiliations": places, "works_funders": funders, "relations": relations}


def datacite(raw: DataFrame) -> dict[str, DataFrame]:
    """Works and relations of datasets.  Authors and institutions are of creators marked as persons."""
    a = F.col("attributes")
    persons = F.filter(a["creators"], lambda c: c["nameType"] == "Personal")
    place = lambda x: F.struct(identifier(x["affiliationIdentifier"]).alias("affiliation_identifier"), x["affiliationIdentifierScheme"].alias("affiliation_identifier_scheme"), x["name"].alias("name"), x["schemeUri"].alias("scheme_uri"))
    fund = lambda x: F.struct(identifier(x["funderIdentifier"]).alias("funder_identifier"), x["funderIdentifierType"].alias("funder_identifier_type"), x["funderName"].alias("funder_name"), x["awardNumber"].alias("award_number"), x["awardUri"].alias("award_uri"))
    places = present(F.flatten(F.transform(persons, lambda c: clean.affiliations(c["affiliation"]))), place, ["affiliation_identifier", "affiliation_identifier_scheme", "name", "scheme_uri"])
    none = F.array()
    works = raw.select(
        F.col("id").alias("doi"),
        clean.null_if_in(clean.remove_markup(F.array_join(a["titles"]["title"], " ")), [""]).alias("title"),
        clean.null_if_in(clean.remove_markup(F.array_join(a["descriptions"]["description"], " ")), ["", ":unav", "Cover title."]).alias("abstract"),
        a["types"]["resourceTypeGeneral"].alias("type"),
        clean.iso_time(a["created"]).cast("date").alias("publication_date"),
        clean.iso_time(a["updated"]).alias("updated_date"),
        a["publisher"]["name"].alias("publication_venue"),
        present(persons, lambda c: _person(clean.orcid_of(c["nameIdentifiers"]), clean.creator_name(c["givenName"], c["familyName"], c["name"])), ["orcid", *NAME_FIELDS]).alias("authors"),
        present(a["fundingReferences"], fund, ["funder_identifier", "funder_identifier_type", "funder_name", "award_number", "award_uri"]).alias("funders"),
        F.array_distinct(places).alias("institutions"),
    )
    works = works.withColumn("institutions", F.coalesce("institutions", none.cast(works.schema["institutions"].dataType)))
    links = raw.select(F.col("id").alias("work_doi"), F.explode(a["relatedIdentifiers"]).alias("r"))
    relations = links.select("work_doi", F.col("r.relationType").alias("relation_type"), F.col("r.relatedIdentifier").alias("related_identifier"), F.col("r.relatedIdentifierType").alias("related_identifier_type"))
    return {"works": works, "relations": relations.where("coalesce(relation_type, related_identifier, related_identifier_type) is not null")}


def openalex_works(raw: DataFrame) -> dict[str, DataFrame]:
    """Works of the open citation graph; abstracts come from word positions."""
    grant = lambda g: F.struct(identifier(g["funder"]).alias("funder_id"), g["funder_display_name"].alias("funder_display_name"), g["award_id"].alias("award_id"))
    place = lambda i: F.struct(i["display_name"].alias("name"), identifier(i["ror"]).alias("ror"))
    places = F.flatten(F.transform("authorships", lambda x: F.coalesce(x["institutions"], F.array().cast(raw.schema["authorships"].dataType.elementType["institutions"].dataType))))
    works = raw.select(
        identifier(F.col("id")).alias("id"),
        identifier(F.col("doi")).alias("doi"),
        F.struct(*[identifier(F.col("ids")[f]).alias(f) for f in ("doi", "mag", "openalex", "pmid", "pmcid")]).alias("ids"),
        clean.blank_to_null(F.col("title")).alias("title"),
        clean.blank_to_null(clean.from_positions(F.col("abstract_inverted_index"))).alias("abstract"),
        "type", "publication_date", "updated_date",
        F.col("primary_location.source.display_name").alias("publication_venue"),
        present(F.col("authorships"), lambda x: _person(identifier(x["author"]["orcid"]), clean.parsed_name(x["author"]["display_name"])), ["orcid", *NAME_FIELDS]).alias("authors"),
        present(F.col("grants"), grant, ["funder_id", "funder_display_name", "award_id"]).alias("grants"),
        F.array_distinct(present(places, place, ["name", "ror"])).alias("institutions"),
    )
    return {"works": works.withColumn("institutions", F.coalesce("institutions", F.array().cast(works.schema["institutions"].dataType)))}


def openalex_funders(raw: DataFrame) -> dict[str, DataFrame]:
    ids = F.struct(*[identifier(F.col("ids")[f]).alias(f) for f in ("crossref", "doi", "openalex", "ror", "wikidata")])
    return {"funders": raw.select(identifier(F.col("id")).alias("id"), "display_name", ids.alias("ids"))}


def ror(raw: DataFrame) -> dict[str, DataFrame]:
    """``ror_id, type, identifier``: each organisation by its own id and by every external one."""
    me = identifier(F.col("id"))
    own = raw.select(me.alias("ror_id"), F.lit("ror").alias("type"), me.alias("identifier")).distinct()
    other = raw.select(me.alias("ror_id"), F.explode_outer("external_ids").alias("e")).select("ror_id", F.col("e.type").alias("type"), F.explode_outer("e.all").alias("x"))
    value = F.when(F.col("type") == "fundref", F.concat(F.lit("10.13039/"), "x")).when(F.col("type") == "isni", clean.isni(F.col("x"))).otherwise(F.lower("x"))
    other = other.select("ror_id", "type", value.alias("identifier")).where("type is not null or identifier is not null")
    return {"index": own.unionByName(other)}


def plans(raw: DataFrame) -> dict[str, DataFrame]:
    """Research plans; award ids that say nothing become NULL."""
    junk = lambda c: clean.null_if_in(c, awards.JUNK)
    fund = lambda f: F.struct(F.struct(clean.blank_to_null(f["funder"]["name"]).alias("name"), identifier(f["funder"]["id"]).alias("ror")).alias("funder"), f["status"].alias("status"), junk(f["funding_opportunity_id"]).alias("funding_opportunity_id"), junk(f["grant_id"]).alias("award_id"))
    place = lambda i: F.struct(clean.blank_to_null(i["name"]).alias("name"), clean.blank_to_null(i["ror"]).alias("ror"))
    out = raw.select(
        clean.plan_doi(F.col("dmp_id")).alias("doi"), "created", "registered", "modified",
        clean.blank_to_null(clean.strip_tags(F.col("title"))).alias("title"),
        clean.blank_to_null(clean.strip_tags(F.col("description"))).alias("abstract"),
        "project_start", "project_end",
        present(F.col("institutions"), place, ["name", "ror"]).alias("institutions"),
        present(F.col("authors"), lambda x: _person(clean.orcid(x["orcid"]), clean.parsed_name(x["name"])), ["orcid", *NAME_FIELDS]).alias("authors"),
        F.transform("funding", fund).alias("funding"),
    )
    return {"plans": out}


def of_institution(df: DataFrame, institutions: Column, ror_id: str, name: str) -> DataFrame:
    """A demonstration set: records with one of the institutions (array of struct(name, ror)), by ROR or by name."""
    key, text = ror_id.lower(), name.lower()
    return df.where(F.coalesce(F.exists(institutions, lambda i: (clean.loose_identifier(i["ror"]) == key) | F.coalesce(F.contains(F.lower(i["name"]), F.lit(text)), F.lit(False))), F.lit(False)))


TRANSFORMS = {
    "crossref-metadata": (CROSSREF, crossref), "datacite": (DATACITE, datacite), "openalex-works": (OPENALEX_WORKS, openalex_works),
    "openalex-funders": (OPENALEX_FUNDERS, openalex_funders), "ror": (ROR, ror), "plans": (PLANS, plans),
}
