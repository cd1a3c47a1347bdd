import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from weftline.__main__ import main
from weftline.operators import audit, enrich, hub, index, match, normalise
from weftline.sources import readers, registries, sinks
from weftline.streaming import changes

T = dt.datetime


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Clean registry tables made from small raw dumps."""
    raw = tmp_path_factory.mktemp("raw")
    person = {"nameType": "Personal", "name": "Doe, Jane", "affiliation": '[{"name":"Uni","affiliationIdentifier":"https://ror.org/0aa"}]', "nameIdentifiers": '{"nameIdentifier":"0000-0001-0000-0001","nameIdentifierScheme":"ORCID"}'}
    dumps = {
        "datacite": [
            {"id": "10.1/d", "attributes": {"created": "2020-01-02T03:04:05Z", "updated": f"202{i}-01-01T00:00:00Z", "titles": [{"title": f"<b>Data</b> {i}"}], "types": {"resourceTypeGeneral": "Dataset"}, "creators": [person, {"nameType": "Organizational", "name": "Org"}], "publisher": {"name": "Pub"}, "fundingReferences": [{"funderName": "F", "funderIdentifier": "https://doi.org/10.13039/1", "awardNumber": "A1"}, {"funderName": "G", "awardNumber": "a2"}], "relatedIdentifiers": [{"relationType": "Cites", "relatedIdentifier": "x"}]}}
            for i in (1, 2)
        ],
        "openalex-works": [
            {"id": "https://openalex.org/W1", "doi": "https://doi.org/10.1/A", "ids": {"pmid": "p"}, "title": "Short", "abstract_inverted_index": '{"two":[1],"one":[0]}', "type": "journal-article", "updated_date": "2021-01-01T00:00:00", "authorships": [{"author": {"display_name": "Jane Q Doe", "orcid": "https://orcid.org/0000-0001-0000-0001"}, "institutions": [{"display_name": "Uni", "ror": "https://ror.org/0aa"}]}], "grants": [{"funder": "https://openalex.org/F1", "funder_display_name": "Fund", "award_id": "Z9"}]},
            {"id": "https://openalex.org/W2", "doi": "https://doi.org/10.1/A", "title": "A longer title"},
            {"id": "https://openalex.org/W3", "doi": "https://doi.org/10.1/d", "title": "in both", "updated_date": "2024-05-05T00:00:00", "grants": [{"award_id": "A3"}]},
        ],
        "crossref-metadata": [{"DOI": "10.1/a", "title": ["The longest title of all"], "type": "journal-article", "deposited": {"date-time": "2022-02-02T00:00:00Z"}, "issued": {"date-parts": [[2020, 2]]}, "funder": [{"name": "F", "DOI": "10.13039/1", "award": ["b1", "A0"]}], "author": [{"given": "J", "family": "D", "affiliation": [{"name": "U", "id": [{"id": "https://ror.org/0aa", "id-type": "ROR"}]}]}], "relation": {"references": [{"id": "10.2/b", "id-type": "doi"}]}}, {"DOI": "10.1/z"}],
        "openalex-funders": [{"id": "https://openalex.org/F1", "display_name": "Fund", "ids": {"ror": "https://ror.org/0ff"}}],
        "plans": [{"dmp_id": "doi.org/10.9/P", "title": " <i>Plan</i> ", "project_start": "2020-01-01", "authors": [{"name": "Jane Doe", "orcid": "0000-0001-0000-0001"}, {}], "funding": [{"funder": {"name": "NSF", "id": "https://ror.org/021nxhr62"}, "grant_id": "1507101", "funding_opportunity_id": "n/a"}]}],
    }
    out = {}
    for name, rows in dumps.items():
        (raw / f"{name}.jsonl").write_text("\n".join(map(json.dumps, rows)))
        schema, shape = registries.TRANSFORMS[name]
        for k, df in shape(readers.json_lines(spark, str(raw / f"{name}.jsonl"), schema)).items():
            out[f"{name.split('-')[0]}.{k}"] = df
    (raw / "ror.json").write_text(json.dumps([{"id": "https://ror.org/0aa", "external_ids": [{"type": "fundref", "all": ["1"]}, {"type": "isni", "all": ["0000 1"]}]}]))
    out["ror.index"] = registries.ror(readers.json_document(spark, str(raw / "ror.json"), registries.ROR))["index"]
    return out


def test_transforms(tables):
    d = tables["datacite.works"].orderBy("updated_date").first()
    assert d["title"] == "Data 1" and d["authors"][0]["orcid"] == "0000-0001-0000-0001" and d["authors"][0]["surname"] == "Doe" and len(d["authors"]) == 1
    assert [i["affiliation_identifier"] for i in d["institutions"]] == ["0aa"] and d["funders"][0]["funder_identifier"] == "10.13039/1"
    o = {r["id"]: r for r in tables["openalex.works"].collect()}
    assert o["w1"]["abstract"] == "one two" and o["w1"]["doi"] == "10.1/a" and o["w1"]["institutions"][0]["ror"] == "0aa" and o["w2"]["institutions"] == []
    c = {r["doi"]: r for r in tables["crossref.works"].collect()}
    assert c["10.1/a"]["publication_date"] == dt.date(2020, 2, 29) and c["10.1/z"]["title"] is None
    assert tables["crossref.works_authors"].count() == 2 and tables["crossref.works_funders"].count() == 3
    assert tables["crossref.relations"].where("relation_id is not null").collect()[0]["relation_type"] == "references"
    assert {(r["type"], r["identifier"]) for r in tables["ror.index"].collect()} == {("ror", "0aa"), ("fundref", "10.13039/1"), ("isni", "00001")}
    p = tables["plans.plans"].first()
    assert p["doi"] == "10.9/p" and p["title"] == "Plan" and len(p["authors"]) == 1 and p["funding"][0]["award_id"] == "1507101" and p["funding"][0]["funding_opportunity_id"] is None


def test_works_index(tables, tmp_path):
    got = index.build(tables, ["works_index.works", "openalex_index.publication_dates"], str(tmp_path))
    rows = {r["doi"]: r for r in got["works_index.works"].collect()}
    assert set(rows) == {"10.1/d", "10.1/a"}
    d, a = rows["10.1/d"], rows["10.1/a"]
    assert d["title"] == "Data 2" and d["work_type"] == "DATASET" and d["updated_date"] == T(2024, 5, 5)
    assert [x["award_id"] for x in d["awards"]] == ["A1", "a2", "A3"] and [(f["name"], f["ror"]) for f in d["funders"]] == [("F", "0aa"), ("G", None)] and d["institutions"][0]["ror"] == "0aa"
    assert a["title"] == "The longest title of all" and a["abstract_text"] == "one two" and a["work_type"] == "JOURNAL_ARTICLE" and a["source"]["url"].endswith("w1")
    assert [x["award_id"] for x in a["awards"]] == ["A0", "b1", "Z9"] and a["funders"][0]["ror"] == "0ff" and a["updated_date"] == T(2022, 2, 2)
    meta = {r["id"]: r for r in got["openalex_index.works_metadata"].collect()}
    assert meta["w1"]["is_primary_doi"] and not meta["w2"]["is_primary_doi"] and meta["w1"]["is_duplicate"] and meta["w1"]["total_count"] == 5
    assert list(got["works_index.works"].columns) == "doi title abstract_text work_type publication_date updated_date publication_venue institutions authors funders awards source".split()


def test_longest_falls_back_to_the_smallest_id(spark):
    df = spark.createDataFrame([("b", "d", None), ("a", "d", None), ("c", "e", 3), ("a", "e", 3)], "id string, doi string, n int")
    assert {(r["doi"], r["id"], r["n"]) for r in index.longest(df, "n").collect()} == {("d", "a", None), ("e", "a", 3)}


def test_audits(spark):
    df = spark.createDataFrame([(1, "", "x"), (1, "a", "y"), (2, None, None)], "id int, s string, k string")
    rules = [audit.number_of_rows(5, blocking=False), audit.unique_values("id"), audit.not_empty_string("s"), audit.accepted_values("k", ["x"])]
    assert {(r["audit"], r["failures"]) for r in audit.audited(df, rules).collect()} == {("number_of_rows", 2), ("unique_values", 1), ("not_empty_string", 1), ("accepted_values", 1)}
    with pytest.raises(ValueError):
        audit.enforce(df, rules)
    assert audit.enforce(df, rules[:1]) is df


def test_entity_match(spark):
    plans = spark.createDataFrame([("p", dt.date(2020, 1, 1), dt.date(2020, 12, 31), ["g"], ["a b"])], "plan_id string, project_start date, project_end date, g array<string>, n array<string>")
    works = spark.createDataFrame([("w1", dt.date(2020, 5, 5), ["g", "g"], ["a b", "a b"]), ("w2", dt.date(2021, 5, 5), ["g"], None), ("w3", dt.date(2020, 1, 1), None, ["a b"]), ("w4", None, ["g"], [None])], "work_id string, publication_date date, g array<string>, n array<string>")
    kinds = {"grant_id": "g", "person_name": "n"}
    got = match.entity_matches(match.entities(plans, ["plan_id", "project_start", "project_end"], kinds), match.entities(works, ["work_id", "publication_date"], kinds)).collect()
    assert [(r["work_id"], r["weighted_count"], r["match_rank"]) for r in sorted(got, key=lambda r: r["match_rank"])] == [("w1", 205, 1), ("w3", 5, 2)]


@pytest.mark.parametrize("text,words,want", [("a b c", ["a", "b"], True), ("a x x x b", ["a", "b"], True), ("a x x x x b", ["a", "b"], False), ("b a", ["a", "b"], False), ("a x b x c x d", ["a", "b", "c", "d"], True), ("a a x x x b", ["a", "b"], True), ("", ["a"], False), (None, ["a"], False), ("a", [], False)])
def test_phrase(spark, text, words, want):
    assert spark.createDataFrame([(text, words)], "t string, w array<string>").select(match.phrase(F.col("t"), F.col("w")).alias("v")).first()["v"] is want


def test_search_and_highlight(spark):
    plans = spark.createDataFrame([("p", dt.date(2000, 1, 1), None), ("old", dt.date(1980, 1, 1), None)], "plan_id string, project_start date, project_end date")
    works = spark.createDataFrame([("w1", "ARTICLE", dt.date(2001, 1, 1)), ("w2", "OUTPUT_MANAGEMENT_PLAN", dt.date(2001, 1, 1)), ("w3", None, dt.date(1999, 1, 1))], "work_id string, work_type string, publication_date date")
    must = spark.createDataFrame([(p, w, 10.0) for p in ("p", "old") for w in ("w1", "w2", "w3")], "plan_id string, work_id string, score double")
    should = spark.createDataFrame([("p", "w1", 2.0), ("p", "w9", 9.0)], "plan_id string, work_id string, score double")
    got = {(r["plan_id"], r["work_id"]): r["score"] for r in match.search([must], [should], works, plans).collect()}
    assert got == {("p", "w1"): 12.0, ("old", "w1"): 10.0, ("old", "w3"): 10.0}
    row = spark.range(1).select(match.highlighted(F.lit("Data of dataset data"), F.array(F.lit("data"))).alias("h"), match.fragments(F.lit("none here " * 20 + "the data " + "more words " * 20), F.array(F.lit("data"))).alias("f")).first()
    assert row["h"] == "<mark>Data</mark> of dataset <mark>data</mark>" and len(row["f"]) == 1 and "<mark>data</mark>" in row["f"][0]


def test_comparator(spark):
    names = "grant_ids opportunity_ids people_ids people affiliation_ids affiliations repo_ids".split()
    base = {f"p_{n}": ["1"] for n in names} | {f"w_{n}": ["2"] for n in names if n != "opportunity_ids"} | {"p_title": "Soil and water", "w_title": "the soil water", "p_description": None, "w_description": None}
    rows = [base | {"id": 1}, base | {"id": 2, "w_grant_ids": ["1"]}, base | {"id": 3, "w_people_ids": ["1"], "w_repo_ids": ["1"]}]
    rows[1]["p_opportunity_ids"] = ["9"]
    schema = ", ".join(f"{k} {'array<string>' if isinstance(v, list) else 'int' if k == 'id' else 'string'}" for k, v in rows[0].items())
    got = {r["id"]: (r["score"], r["confidence"]) for r in match.compared(spark.createDataFrame([tuple(r.values()) for r in rows], schema)).collect()}
    assert got[1] == (0, "Low") and got[2] == (100, "Absolute") and got[3][0] in (5, 8) and got[3][1] in ("Low", "Medium")


def test_hub(spark):
    records = spark.createDataFrame([("a", hub.LATEST, "T", 1), ("b", hub.LATEST, "U", 2), ("a", "VERSION#1", "S", 0)], "pk string, sk string, title string, modified int")
    gone = hub.tombstones(records, records.where("pk = 'a'"))
    assert {(r["pk"], r["sk"], r["title"]) for r in gone.collect()} == {("a", hub.TOMBSTONE, "OBSOLETE: T"), ("b", hub.LATEST, "U"), ("a", "VERSION#1", "S")}
    page, about = hub.page(hub.sorted_by(records), number=9, size=2)
    assert about["page"] == 2 and about["total_items"] == 3 and page.count() == 1 and about["links"]["prev"] == 1
    assert hub.allowed(["x", "y"], ["y"]) == ["y"] and hub.allowed([], ["y"]) == ["y"]
    with pytest.raises(ValueError):
        hub.facets(records, {})
    new = spark.createDataFrame([("a", None, "new"), ("c", "N", "c")], "pk string, title string, sk string")
    assert {(r["pk"], r["title"], r["sk"]) for r in hub.merge_patch(records.where("modified > 0").drop("modified"), new, "pk", kept=("sk",)).collect()} == {("a", "T", hub.LATEST), ("b", "U", hub.LATEST), ("c", "N", "c")}


def test_enrichment(tables, spark):
    funded = enrich.lookup(spark.createDataFrame([("1507101",), ("1507101",), (None,)], "key string"), lambda ks: {k: ["10.1/a"] for k in ks})
    got = enrich.enriched(tables["plans.plans"], funded).first()
    assert got["awards"][0]["award_id"] == "1507101" and got["awards"][0]["funded_dois"] == ["10.1/a"]
    wanted = spark.createDataFrame([(1, "A study of the soils of northern Spain")], "ref_id long, title string")
    works = spark.createDataFrame([("x", "A Study of the soils of Northern Spain."), ("y", "A study of the oceans of northern Spain")], "doi string, title string")
    assert [r["doi"] for r in enrich.similar_titles(wanted, works).collect()] == ["x"]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "doi_id int, some_name string")
    sinks.export(df, f"{tmp_path}/x")
    sinks.json_gz(df, f"{tmp_path}/j")
    assert spark.read.parquet(f"{tmp_path}/x").count() == 2 and spark.read.json(f"{tmp_path}/j").count() == 2
    assert json.loads(sinks.camel_json(df.where("doi_id = 1")).first()[0]) == {"doiId": 1, "someName": "a"}
    for _ in range(2):
        sinks.append_export(spark, f"{tmp_path}/e", "2025-01-02")
    assert spark.read.parquet(f"{tmp_path}/e").count() == 1
    for d in ("2024-01-01", "2024-06-01"):
        df.write.parquet(f"{tmp_path}/t/release_date={d}")
    assert readers.latest(spark, f"{tmp_path}/t").count() == 2
    merged = sinks.upserted(df, spark.createDataFrame([(2, "b"), (3, None)], "doi_id int, some_name string"), "doi_id")
    assert {tuple(r) for r in merged.collect()} == {(1, "a"), (2, "b"), (3, None)}


def test_change_stream(spark, tmp_path):
    def event(kind, pk, seq, people, sk=hub.LATEST):
        return (kind, pk, sk, seq, T(2024, 1, 1, 0, seq), "t", None, people, [], None)

    batches = [[event("INSERT", "a", 1, ["X", "Y"]), event("INSERT", "b", 2, ["X"]), event("INSERT", "c", 3, ["Q"], sk="METADATA")], [event("MODIFY", "a", 4, ["Z"]), event("REMOVE", "b", 5, ["X"]), event("MODIFY", None, 6, ["W"])]]
    for rows in batches:
        spark.createDataFrame(rows, changes.EVENT).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(changes.EVENT).parquet(f"{tmp_path}/in")
        changes.maintain(stream, f"{tmp_path}/out", f"{tmp_path}/checkpoint").awaitTermination(120)
    assert {(r["value"], r["pk"]) for r in changes.current(spark, f"{tmp_path}/out").collect()} == {("z", "a")}


def test_version_stream_agrees_with_batch(spark, tmp_path):
    schema = "pk string, seq long, modified timestamp, owner string, updater string"
    rows = [("a", 1, T(2024, 1, 1, 0), "o", "o"), ("a", 2, T(2024, 1, 1, 0, 30), "o", "o"), ("a", 3, T(2024, 1, 1, 3), "o", "o"), ("a", 4, T(2024, 1, 1, 3, 5), "o", "x"), ("b", 5, T(2024, 1, 1), "o", "x")]
    df = spark.createDataFrame(rows, schema)
    df.coalesce(1).write.parquet(f"{tmp_path}/in")
    want = {tuple(r) for r in hub.versions(df).collect()}
    q = changes.version_stream(spark.readStream.schema(schema).parquet(f"{tmp_path}/in")).writeStream.format("memory").queryName("versions").outputMode("append").trigger(availableNow=True).option("checkpointLocation", f"{tmp_path}/c").start()
    q.awaitTermination(120)
    assert {tuple(r) for r in spark.table("versions").collect()} == want and len(want) == 2


def test_windowed_counts(spark):
    df = spark.createDataFrame([(T(2024, 1, 1, 0, 5), "a", 1.0), (T(2024, 1, 1, 0, 50), "a", 2.0), (T(2024, 1, 1, 1, 5), "a", 3.0)], "ts timestamp, event_type string, value double")
    assert sorted((r["n"], r["total"]) for r in changes.windowed_counts(df).collect()) == [(1, 3.0), (2, 3.0)]


def test_plans_meet_the_works_index(tables):
    works = normalise.works(index.build(tables, ["works_index.works"])["works_index.works"])
    plans = normalise.plans(tables["plans.plans"])
    assert plans.first()["project_end"] == dt.date(2023, 1, 1)
    works = works.withColumn("publication_date", F.coalesce("publication_date", F.lit(dt.date(2021, 1, 1))))
    got = match.entity_matches(match.entities(plans, ["plan_id", "project_start", "project_end"], normalise.PLAN_KINDS), match.entities(works, ["work_id", "publication_date"], normalise.WORK_KINDS)).collect()
    assert {(r["work_id"], r["person_id_count"]) for r in got} == {("10.1/d", 1), ("10.1/a", 1)}


def test_command_line(spark, tmp_path):
    (tmp_path / "in.jsonl").write_text(json.dumps({"id": "https://openalex.org/F1", "display_name": "Fund"}))
    main(["transform", "openalex-funders", f"{tmp_path}/in.jsonl", f"{tmp_path}/out"])
    assert spark.read.parquet(f"{tmp_path}/out/openalex.funders").first()["id"] == "f1"
