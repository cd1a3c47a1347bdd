"""Every operator and pipeline stage on nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from weftline.llm import ann, chat, lm, media, mixing, packing, secrets, simhash, substring, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, bin string, keep_id string, position string, tokens string, epoch string, shard string, toxic string"


def word(r):
    return "".join(r.choice("abcdefghijklmno") for _ in range(r.randint(3, 8)))


def odd_rows():
    r = random.Random(4)
    prose = lambda n: " ".join(word(r) + ("." if r.random() < 0.1 else "") for _ in range(n))
    copied = prose(120)
    texts = [None, "", "   ", "\n.!?", "Ünïcödé 漢字 🙂", copied, copied, copied + " end", "x" * 300_000, prose(60_000), "word " * 5000]
    rows = [(i, t, "en", "web" if i % 2 else None, len(t or "")) for i, t in enumerate(texts)]
    rows += [(5, copied, None, "web", 1), (5, copied, None, "web", 1), (None, copied, "en", "web", None), (None, None, None, None, None)]
    rows += [(100 + i, prose(80), "en", "books", 9) for i in range(30)]
    return [row + ("b", "k", "p", "t", "e", "s", "x") for row in rows]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(100, 130)] + [(None, 1, 1), (101, None, None), (101, 1, 0)], "doc_id long, quality int, toxic int")


def test_packing(odd):
    got = packing.pack(odd, capacity=512).collect()
    want = odd.select("doc_id", F.coalesce(F.regexp_count("text", F.lit(r"\S+")), F.lit(0)).alias("n")).collect()
    assert sum(r["tokens"] for r in got) == sum(r["n"] for r in want)
    assert len({(r["bin"]) for r in got}) >= sum(r["n"] for r in want) // 512
    fills = {}
    for r in got:
        fills[r["bin"]] = fills.get(r["bin"], 0) + r["tokens"]
    assert max(fills.values()) <= 512
    assert sum(r["doc_id"] is None and r["piece"] == 0 for r in got) == 2
    assert sum(r["doc_id"] == 5 and r["piece"] == 0 for r in got) == 3


def test_mixing(odd):
    rows = mixing.schedule(odd).collect()
    first = [r for r in rows if r["epoch"] == 0]
    assert len(first) == odd.count()  # every row trains
    assert [r["position"] for r in rows] == sorted(r["position"] for r in rows)
    out = mixing.mixed(odd)
    assert out.columns == odd.columns and out.select("doc_id", "text").distinct().count() == odd.select("doc_id", "text").distinct().count()


def test_simhash(odd):
    got = {r["doc_id"]: r["keep_id"] for r in simhash.groups(odd).collect()}
    assert got == {6: 5, 7: 5}
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns and kept.count() == odd.count() - 2
    assert kept.where("doc_id is null").count() == 2


def test_substring(odd):
    got = [(r["doc_id"], r["first_doc_id"]) for r in substring.repeats(odd).collect()]
    assert set(got) == {(6, 5), (7, 5)}
    cut = substring.without_repeats(odd)
    assert cut.columns == odd.columns and cut.count() == odd.count()
    assert cut.where("doc_id = 6").first()["text"].strip() == ""


def test_secrets(spark, odd):
    key = "AKIA" + "Q7ZK3M9XW2B5T8RC"
    more = spark.createDataFrame([(900, f"key {key} here", "en", "web", 30, *"bkptesx"), (None, f"a {key}", "en", "web", 30, *"bkptesx")], SCHEMA)
    both = odd.unionByName(more)
    found = secrets.findings(both).collect()
    assert {(r["doc_id"], r["secret"]) for r in found} == {(900, key), (None, key)}
    out = secrets.redact(both)
    assert out.columns == both.columns and out.count() == both.count()
    assert out.where("doc_id = 900").first()["text"] == f"key {secrets.MASK} here"
    assert out.where(F.contains("text", F.lit(key))).count() == 0
    assert out.where("doc_id is null and text is null").count() == 1


def test_toxicity(odd, labels):
    kept = toxicity.clean(odd, labels)
    assert kept.columns == odd.columns and kept.where("text is null").count() == 2 and kept.where("doc_id = 2").count() == 1
    assert set(toxicity.offending(odd, labels).columns) == {"doc_id", "toxicity", "sentence_no", "sentence_score", "char_start", "sentence"}
    assert toxicity.clean(odd, labels.where("toxic = 0")).count() == odd.count()


def test_lm(odd):
    got = lm.scores(odd, rounds=1, rate=0.25).collect()
    assert len(got) == odd.count()
    blank = [r for r in got if r["n_tokens"] == 0]
    assert len(blank) == 5 and all(r["log_likelihood"] == 0 and r["mean_log_probability"] is None for r in blank)
    assert all(r["mean_log_probability"] < 0 for r in got if r["n_tokens"])


def test_chat(spark):
    rows = [(1, 0, "user", " hi ", "x"), (1, 1, "assistant", None, "x"), (1, 1, "assistant", None, "x"), (None, 0, None, "", "x"), (2, 0, "user", "y" * 200_000, "x")]
    got = chat.render(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, rendered string")).collect()
    assert sorted([r["conv_id"] for r in got], key=str) == [1, 2, None]
    assert chat.render(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_neighbours(spark):
    rows = [(1, [1.0, 0.0], 0), (2, [1.0, 0.1], 0), (2, [1.0, 0.1], 0), (3, None, 0), (4, [], 0), (5, [0.0, 0.0], 0), (6, [float("nan"), 1.0], 0), (7, [1.0, None], 0), (8, [1.0, 2.0, 3.0], 0), (None, [1.0, 0.0], 0), (9, [0.0, 1.0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int")
    got = ann.neighbours(df, k=3).collect()
    assert {r["query_id"] for r in got} == {1, 2, 9} and all(r["query_id"] != r["neighbour_id"] for r in got)
    assert ann.neighbours(df.limit(0), k=3).count() == 0


def test_media(spark):
    img = media.draw(3)
    rows = [(1, media.encode_png(img)), (2, media.encode_png(media.edit(img, 0))), (2, media.encode_png(media.edit(img, 0))), (3, None), (4, b""), (5, b"\x89PNG\r\n\x1a\nbroken"), (None, media.encode_png(img)), (6, media.encode_png(media.draw(9)))]
    df = spark.createDataFrame([r + ("x",) for r in rows], "media_id long, image binary, scale string")
    assert {(r["media_a"], r["media_b"]) for r in media.copies(df).collect()} == {(1, 2)}
    assert media.copies(df.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["pack", "schedule", "mixed", "groups", "keep_one", "repeats", "without_repeats", "findings", "redact", "scores", "clean", "offending"])
def test_empty_table(odd, labels, name):
    none = odd.limit(0)
    module = next(m for m in (packing, mixing, simhash, substring, secrets, lm, toxicity) if hasattr(m, name))
    args = (none, labels) if module is toxicity else (none,)
    assert getattr(module, name)(*args).count() == 0


def test_pipeline_stages(spark, odd, labels, tmp_path):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    docs = odd
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        if i + 1 < len(corpus_pipeline.STAGES):
            assert out.columns == odd.columns
        docs = out
    assert docs.count() > 0
    docs = odd.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
    assert docs.count() == 0
