"""Reports, search clauses, streams by buckets, bulk sending and the command line."""

import datetime as dt
import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from weftline import __main__ as cli
from weftline.operators import match, reports, searching
from weftline.sources import readers, sinks
from weftline.streaming import changes


def plain_matches(plans, works, weights, threshold):
    counts = {}
    for (p, s, e, t, x), (w, d, u, y) in itertools.product(plans, works):
        if t == u and x == y and s <= d <= e:
            n = counts.setdefault((p, w), {}).setdefault(t, {})
            n[x] = n.get(x, 0) + 1
    out = {}
    for pair, types in counts.items():
        total = sum(weights[t] * sum(1 if t in match.NAMES else k for k in xs.values()) for t, xs in types.items())
        if total >= threshold:
            out[pair] = total
    return out


@pytest.mark.parametrize("threshold", [1, 3, 6])
def test_entity_matches_are_those_of_all_comparisons(spark, threshold):
    r = random.Random(threshold)
    kinds = list(match.WEIGHTS)
    plans = [(f"p{i}", 1, 3 + i % 5, t, r.choice("abcd")) for i in range(30) for t in r.sample(kinds, 4)]
    works = [(f"w{i}", 1 + i % 7, t, r.choice("abcd")) for i in range(60) for t in r.choices(kinds, k=4)]  # with repetitions
    day = lambda c: F.date_add(F.lit("2020-01-01").cast("date"), F.col(c)).alias(c)
    p = spark.createDataFrame(plans, "plan_id string, project_start int, project_end int, entity_type string, entity string").select("plan_id", day("project_start"), day("project_end"), "entity_type", "entity")
    w = spark.createDataFrame(works, "work_id string, publication_date int, entity_type string, entity string").select("work_id", day("publication_date"), "entity_type", "entity")
    got = match.entity_matches(p, w, threshold=threshold, k=1000).collect()
    assert {(x["plan_id"], x["work_id"]): x["weighted_count"] for x in got} == plain_matches(plans, works, match.WEIGHTS, threshold)


def test_a_task_of_vector_search_keeps_k_rows_of_a_query(spark):
    rng = np.random.default_rng(3)
    table = lambda ids: pa.table({"id": ids, "vector": [rng.integers(-2, 3, 3).astype(float).tolist() for _ in ids]})
    base, asked = table(list(range(300))[::-1]), table([7, 8, 9])
    out = pa.Table.from_batches(list(match._nearest(asked, 4, rows=2)(iter(base.to_batches(max_chunksize=50)))))
    unit = lambda t: np.array([np.array(v) / (np.linalg.norm(v) or np.nan) for v in t["vector"].to_pylist()])
    far = np.round(1 - unit(asked) @ unit(base).T, 6) + 0.0
    want = [(q, *x[::-1]) for q, row in zip([7, 8, 9], far) for x in sorted((d, i) for d, i in zip(row, base["id"].to_pylist()) if d == d)[:4]]
    assert [(x["query_id"], x["base_id"], x["distance"]) for x in out.to_pylist()] == [(q, i, d) for q, i, d in want]


@pytest.mark.parametrize("shared", [1, 6])
def test_plans_of_a_kind_match_alike(spark, shared):
    """Entities of many plans are compared once for each kind of plan; ranks are those of all comparisons."""
    r = random.Random(shared)
    kinds = ["grant_id", "person_id", "person_name", "affiliation_id", "affiliation_name"]
    plans = [(f"p{i:02}", 1, 3 + i % 3, t, r.choice("ab") if t[:1] != "p" else f"{i % 9}") for i in range(40) for t in r.choices(kinds, k=4)]  # with repetitions
    works = [(f"w{i:02}", 1 + i % 7, t, r.choice("ab") if t[:1] != "p" else f"{r.randrange(9)}") for i in range(60) for t in r.choices(kinds, k=4)]
    day = lambda c: F.date_add(F.lit("2020-01-01").cast("date"), F.col(c)).alias(c)
    p = spark.createDataFrame(plans, "plan_id string, project_start int, project_end int, entity_type string, entity string").select("plan_id", day("project_start"), day("project_end"), "entity_type", "entity")
    w = spark.createDataFrame(works, "work_id string, publication_date int, entity_type string, entity string").select("work_id", day("publication_date"), "entity_type", "entity")
    want = {}
    for (plan, work), n in sorted(plain_matches(plans, works, match.WEIGHTS, 3).items(), key=lambda x: (x[0][0], -x[1], x[0][1])):
        want.setdefault(plan, []).append((work, n))
    got = {}
    for x in match.entity_matches(p, w, k=5, shared=shared).orderBy("plan_id", "match_rank").collect():
        got.setdefault(x["plan_id"], []).append((x["work_id"], x["weighted_count"]))
    assert got == {k: v[:5] for k, v in want.items()}


@pytest.mark.parametrize("block", [2, 1000])
def test_vector_search_in_blocks(spark, block):
    rng = np.random.default_rng(1)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(60, 5)))] + [(60, [0.0] * 5), (61, [1.0, 2.0]), (62, None), (63, [1.0, None, 1.0, 1.0, 1.0])]
    base = spark.createDataFrame(rows, "id long, vector array<double>")
    got = {(r["query_id"], r["rank"]): (r["base_id"], r["distance"]) for r in match.vector_search(base.where("id % 10 = 0 and id < 60"), base, 3, block=block).collect()}
    x = np.array([v for _, v in rows[:60]])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for q in range(0, 60, 10):
        d = np.round(1 - x @ x[q], 6)
        for k, j in enumerate(np.lexsort((np.arange(60), d))[:3]):
            assert got[q, k + 1] == (j, d[j])
    assert len(got) == 18 and match.vector_search(base.limit(0), base, 3).count() == 0


def test_name_phrases_by_their_rarest_word(spark):
    asked = spark.createDataFrame([("Berg",), ("University of X",), ("nobody",), (None,), ("  ",)], "name string")
    held = spark.createDataFrame([("Ann Berg",), ("the University of big X",), ("X of University",), ("bergen",), (None,)], "name string")
    got = {tuple(r) for r in searching.phrase_pairs(asked, held).collect()}
    assert got == {("Berg", "Ann Berg"), ("University of X", "the University of big X")}


def test_bulk_sending_tries_again_and_reports(spark, tmp_path):
    def send(docs, folder=str(tmp_path)):
        import os

        first = not os.path.exists(f"{folder}/seen")
        open(f"{folder}/seen", "w").close()
        if first:
            raise OSError("busy")
        return {d.split('"')[3]: "bad" for d in docs if '"b' in d}

    df = spark.createDataFrame([("a1",), ("b1",), ("b2",)], "id string").coalesce(1)
    got = sinks.sent(df, send, "id", tries=3, first_wait=0.01).collect()
    assert sorted((r["key"], r["error"]) for r in got) == [("b1", "bad"), ("b2", "bad")]
    errors = spark.createDataFrame([("b1", "bad"), ("b2", "bad"), ("c", "worse")], "key string, error string")
    assert [tuple(r) for r in sinks.error_summary(errors).collect()] == [("bad", 2, "b1"), ("worse", 1, "c")]


def test_streams_rewrite_the_buckets_they_touch(spark, tmp_path):
    event = lambda name, pk, seq, person: (name, pk, "VERSION#latest", seq, f"2024-01-01T00:00:{seq:02d}Z", "t", "a", [person], [], [])
    batches = [[event("INSERT", f"k{i}", i, "x") for i in range(20)], [event("MODIFY", "k1", 30, "y")], [event("REMOVE", "k2", 31, "x")], [event("INSERT", "new", 32, "z")]]
    for n, rows in enumerate(batches):
        spark.createDataFrame(rows, changes.EVENT.replace("modified timestamp", "modified string")).coalesce(1).write.json(f"{tmp_path}/in/{n}")
        stream = spark.readStream.schema(changes.EVENT).json(f"{tmp_path}/in/*")
        changes.maintain(stream, f"{tmp_path}/out", f"{tmp_path}/checkpoint", buckets=8).awaitTermination(120)
    got = {(r["value"], r["pk"]) for r in changes.current(spark, f"{tmp_path}/out").collect()}
    assert got == {("x", f"k{i}") for i in range(20) if i not in (1, 2)} | {("y", "k1"), ("z", "new")}
    sizes = [len(list((tmp_path / "out").glob(f"generation={n:012d}/bucket=*"))) for n in range(4)]
    assert sizes[0] == 8 and sizes[1] == 1 and sizes[3] == 1


def test_exports_are_cut_by_bytes(spark, tmp_path):
    df = spark.range(4000).select(F.col("id"), F.sha2(F.col("id").cast("string"), 256).alias("text"))
    sinks.export(df, f"{tmp_path}/x", bytes_per_file=80_000)
    files = list((tmp_path / "x").glob("*.parquet"))
    assert len(files) >= 4 and max(f.stat().st_size for f in files) <= 80_000 and spark.read.parquet(f"{tmp_path}/x").count() == 4000
    reports.to_files(df, f"{tmp_path}/r")
    assert spark.read.option("header", "true").csv(f"{tmp_path}/r/csv").count() == spark.read.json(f"{tmp_path}/r/json").count() == 4000
    assert sum(len(p) for p in readers.rows_of(df.limit(7), 3)) == 7 and readers.first_files(["b", "a", "c"], 2, 1) == [["a", "b"]]


def test_tidied_at_every_depth(spark):
    rows = [(" x ", [" a", "a", None], ([("  ", True)],), True, 3)]
    df = spark.createDataFrame(rows, "s string, l array<string>, o struct<i:array<struct<b:string,f:boolean>>>, flag boolean, n int")
    got = reports.tidied(df).first()
    assert got["s"] == "x" and got["l"] == ["a"] and got["flag"] is None and got["n"] is None and got["o"]["i"][0]["b"] is None


def test_command_line(spark, tmp_path):
    assert cli.arguments().parse_args(["match", "i", "p", "o", "--most", "5"]).most == 5
    works = "doi string, title string, abstract_text string, work_type string, publication_date date, authors array<struct<orcid:string,full:string>>, institutions array<struct<name:string,ror:string>>, funders array<struct<name:string,ror:string>>, awards array<struct<award_id:string>>"
    spark.createDataFrame([("10.1/a", "T", None, "ARTICLE", None, [("0000-0002-1825-0097", "Ann Berg")], [("X", None)], [], [])], works).withColumn("publication_date", F.lit("2021-01-01").cast("date")).write.parquet(f"{tmp_path}/works")
    plans = "doi string, title string, abstract string, authors array<struct<orcid:string,full:string,surname:string>>, institutions array<struct<name:string,ror:string>>, funding array<struct<funder:struct<name:string,ror:string>,funding_opportunity_id:string,award_id:string>>"
    spark.createDataFrame([("10.2/p", "T", None, [("0000-0002-1825-0097", "Ann Berg", "Berg")], [("X", None)], [])], plans).withColumn("project_start", F.lit("2020-01-01").cast("date")).withColumn("project_end", F.lit("2022-01-01").cast("date")).write.parquet(f"{tmp_path}/plans")
    for name in ("match", "search"):
        cli.main([name, f"{tmp_path}/works", f"{tmp_path}/plans", f"{tmp_path}/{name}"])
        got = spark.read.json(f"{tmp_path}/{name}").first()
        assert got["plan_id"] == "10.2/p" and (got["matches"] if name == "match" else got["works"])[0]["work_id"] == "10.1/a"


def test_best_works_are_those_of_all_clauses(spark):
    """Kinds of plans and works compared once give what all pairs give, ties and windows among them."""
    day = lambda n: (dt.date(2000, 1, 1) + dt.timedelta(days=n)) if n % 4 else None
    pair = lambda i, n: (i, n)
    plans = [(f"p{i:02}", [f"w{i * 3:02}"] if i % 5 == 0 else [], [pair(f"a{i}", f"Name{i} Berg")], [pair(f"n{i % 3}", ["Blue", "Red"][i % 2])], [pair(None, "Fund")] if i % 3 else None, [("021nxhr62", f"NSF {i % 4:07}")] * (i % 3) or None, day(i % 6 * 100), None) for i in range(40)]
    works = [(f"w{i:02}", [pair(f"a{i % 50}", None) if i % 2 else pair(None, f"Dr Name{i % 40} Berg")], [pair(f"n{i % 4}", None) if i % 3 else pair(None, "The Red group")], [pair(None, "A Fund")] if i % 2 else None, [f"{i % 5:07}", None], "OUTPUT_MANAGEMENT_PLAN" if i % 17 == 0 else None, day(i % 8 * 90 + 1)) for i in range(90)]
    two = "array<struct<id:string,name:string>>"
    p = spark.createDataFrame(plans, f"plan_id string, funded_dois array<string>, authors {two}, institutions {two}, funders {two}, awards array<struct<ror:string,text:string>>, project_start date, project_end date")
    w = spark.createDataFrame(works, f"work_id string, authors {two}, institutions {two}, funders {two}, award_ids array<string>, work_type string, publication_date date")
    must, should = searching.clauses(p, w)
    want = {tuple(r) for r in match.search(list(must.values()), list(should.values()), w, p, k=4).collect()}
    assert {tuple(r) for r in searching.best_works(p, w, 4).collect()} == want and len(want) > 100
