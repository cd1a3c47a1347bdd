"""Queries on tables with other keys, more repeats and longer lists than the given ones, against their SQL or all comparisons."""

import datetime as dt
import random

import duckdb

from weftline.operators import enrich, index
from weftline.plans import catalog

from test_queries import rows_of


def customers(n, first=0, step=1):
    return [(first + step * i, f"Customer#{i % 7:09}", i % 25, float(i), ["BUILDING", "FURNITURE", "MACHINERY"][i % 3]) for i in range(n)]


def orders(n, custkeys, first=0):
    return [(first + i, custkeys[i * 7 % len(custkeys)], "OFP"[i % 3], 60000.0 + 1000 * i, dt.datetime(1995, 1, 1) + dt.timedelta(days=i * 37 % 1500), ["1-URGENT", "5-LOW"][i % 2]) for i in range(n)]


SCHEMAS = {
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string", "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int", "nation": "n_nationkey int, n_name string", "embeddings": "vec_id long, embedding array<float>", "part": "p_partkey long, p_name string",
}


def agrees(spark, folder, name, **tables):
    """The query's rows are those of its SQL; how many."""
    con = duckdb.connect()
    for k, rows in tables.items():
        spark.createDataFrame(rows, SCHEMAS[k]).write.parquet(f"{folder}/{k}.parquet")
        con.execute(f"CREATE VIEW {k} AS SELECT * FROM '{folder}/{k}.parquet/*.parquet'")
    got = catalog.QUERIES[name](spark, str(folder))
    cursor = con.execute(catalog.SQL[name])
    names = [d[0] for d in cursor.description]
    want = rows_of(names, cursor.fetchall())
    assert rows_of(got.columns, got.collect()) == want
    return len(want)


def test_similar_titles_are_those_of_all_comparisons(spark):
    rng = random.Random(5)
    base = ["".join(rng.choice("abcd ef") for _ in range(rng.choice([3, 8, 20, 41, 60]))) for _ in range(25)]

    def changed(s):
        for _ in range(rng.randrange(1 + len(s) // 5)):
            i = rng.randrange(len(s) + 1)
            s = s[:i] + rng.choice(["", "z", "a"]) + s[i + rng.randrange(2) :]
        return s

    norm = lambda s: " ".join(s.split())
    a, b = [(i, norm(x)) for i, x in enumerate(base)], [(f"d{i}", norm(changed(x))) for i, x in enumerate(base * 4)]
    for least in (95.0, 80.0):
        want = {(i, d) for i, x in a for d, y in b if x and y and enrich.ratio(x, y) >= least}
        got = enrich.similar_titles(spark.createDataFrame(a, "ref_id long, title string"), spark.createDataFrame(b, "doi string, title string"), least).collect()
        assert {(r["ref_id"], r["doi"]) for r in got} == want and len(got) == len(want) > 25


def test_match_report_knows_pilots_of_any_key(spark, tmp_path):
    keys = [200_000 + 25 * i for i in range(40)]
    assert agrees(spark, tmp_path, "match_report", customer=customers(40, 200_000, 25), orders=orders(400, keys), nation=[(i, f"N{i}") for i in range(25)]) > 50


def shuffled(spark, df):
    """The rows and the bytes that were shuffled for them."""
    written = lambda: sum(e.apply(i).totalShuffleWrite() for e in [spark.sparkContext._jsc.sc().statusStore().executorList(False)] for i in range(e.size()))
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    before, rows = written(), df.collect()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    return rows, written() - before


def test_long_lists_of_an_id_are_not_shuffled_by_row(spark):
    registry = spark.range(3000).selectExpr("'i' || id % 2 AS identifier", "md5(string(id)) AS ror_id")
    works = spark.createDataFrame([(f"d{i}", [(f"i{i % 3}", f"N{i}"), (None, "none")]) for i in range(60)], "doi string, institutions array<struct<affiliation_identifier:string,name:string>>")
    rows, size = shuffled(spark, index.datacite_institutions(works, registry))
    assert len(rows) == 60 and sum(len(r["institutions"]) for r in rows) == 40 * 1501 + 20 * 2 and size < 400_000
    mine = next(r for r in rows if r["doi"] == "d4")["institutions"]
    assert mine[-1] == ("none", None) and {x["name"] for x in mine[:-1]} == {"N4"} and [x["ror"] for x in mine[:-1]] == sorted(x["ror"] for x in mine[:-1])


def test_long_lists_of_an_award_are_not_shuffled_by_plan(spark):
    funded = spark.range(2).selectExpr("lpad(string(id), 7, '0') AS key", "transform(sequence(1, 3000), x -> md5(string(x))) AS values")
    fund = "array<struct<funder:struct<ror:string>,funding_opportunity_id:string,award_id:string>>"
    plans = spark.createDataFrame([(f"p{i}", [(("021nxhr62",), None, f"NSF {i % 3:07}")]) for i in range(60)], f"doi string, funding {fund}")
    rows, size = shuffled(spark, enrich.enriched(plans, funded))
    assert sorted(len(r["awards"][0]["funded_dois"]) for r in rows) == [0] * 20 + [3000] * 40 and size < 1_000_000


def test_heavy_rows_are_spread_over_the_cores(spark, tmp_path):
    spark.createDataFrame(customers(50), SCHEMAS["customer"]).coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    for name in ("plans_clean", "normalised_plans", "datacite_works"):
        assert catalog.QUERIES[name](spark, str(tmp_path)).rdd.getNumPartitions() >= 3 * spark.sparkContext.defaultParallelism


def test_an_inverted_index_of_a_row_is_made_without_a_shuffle(spark, tmp_path):
    spark.createDataFrame([(1, "b a b"), (2, "12 "), (3, None), (4, "é a-a")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rows, size = shuffled(spark, catalog.QUERIES["revert_inverted_index"](spark, str(tmp_path)))
    assert {tuple(r) for r in rows} == {(1, "b a b"), (2, None), (3, None), (4, "a a")} and size == 0
