import datetime as dt

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from weftline.functions import awards, clean, kinds
from weftline.operators import enrich


def value(spark, c, text=None):
    return spark.createDataFrame([(text,)], "s string").select(c(F.col("s")).alias("v")).first()["v"]


CASES = [
    (clean.remove_markup, "&lt;b&gt;It's &quot", ";Its &quot"), (clean.remove_markup, "<p>a  b</p>", "a  b"), (clean.remove_markup, None, None),
    (clean.strip_html, "&lt;i&gt;'x'", "'x'"), (clean.identifier, " HTTPS://Doi.org/10.1/AB ", "10.1/ab"), (clean.identifier, "", ""),
    (clean.isni, "0000 0001 X", "00000001x"), (clean.orcid, "https://orcid.org/0000-0002-1825-009X", "0000-0002-1825-009x"), (clean.orcid, "none", None),
    (lambda c: clean.orcid(c, False), "0000-0002-1825-009X", None), (clean.blank_to_null, " \t\n", None), (clean.blank_to_null, "\ta ", "a"),
    (lambda c: clean.null_if_in(c, [":unav"]), " :UNAV ", None), (lambda c: clean.null_if_in(c, [":unav"]), " x ", "x"),
    (clean.plan_doi, " https://DOI.org/10.9999/D1 ", "https://10.9999/d1"), (clean.public_name, "a@b.c", None), (clean.public_name, "www.x.y", None), (clean.public_name, " N ", "N"),
    (clean.from_positions, '{"world":[1],"hello":[0]}', "hello world"), (clean.from_positions, "oops", ""), (clean.from_positions, None, None),
    (clean.doi_in, "see doi:10.5061/DRYAD.1 now", "10.5061/dryad.1"), (clean.doi, "doi.org/10.1/A", "10.1/a"), (clean.isni_digits, "x 0000 0001 2345 678X", "000000012345678X"), (clean.isni_digits, "abc", "abc"),
    (clean.ror, "https://ror.org/01an7q238", "01an7q238"), (clean.grid, "grid.1.2", "grid.1.2"), (clean.any_id, "id 100000001", "100000001"), (clean.any_id, "z", "z"),
    (clean.grant_id, "http://x?AWD_ID=123", "123"), (clean.grant_id, "nsf12-345", "nsf12-345"), (clean.grant_id, "G 12345", "12345"), (clean.grant_id, "12", None),
    (clean.person_name, "Prof. Mary-Ann B. O'Neil", "maryann oneil"), (clean.person_name, "Dr.", None), (clean.author_name, "Doe,  Jane Q, Ph.D (x)", "jane q. doe"), (clean.bare_name, "NIH (USA) ", "nih"),
    (clean.comparable, "Éa: straße  x-y", "ea strasse xy"), (clean.without_stop_words, "The end OF a day", "end day"), (clean.collapse_ror_url, "https://ror.org/https://ror.org/0x", "https://ror.org/0x"),
    (lambda c: kinds.lookup(c, kinds.INDEX_TYPES, None), "Film", "AUDIO_VISUAL"), (lambda c: kinds.lookup(c, kinds.ARTICLE_TYPES), "strange", "other"), (kinds.index_type, None, "OTHER"), (kinds.index_type, "book-chapter", "BOOK_CHAPTER"),
    (lambda c: awards.nih_text(awards.nih(c)), "1 R01 AG080054-01R1", "1R01AG080054-01R1"), (lambda c: awards.nih_text(awards.nih(c)), "ro1 AI176039", "R01AI176039"), (lambda c: awards.nih_text(awards.nih(c)), "no", None),
    (lambda c: awards.nih(c)["support_year"], "AI176039-01R", None), (lambda c: awards.nih(c)["other_suffixes"], "AI176039-S1", "S1"),
    (lambda c: awards.nsf_text(awards.nsf(c)), "https://nsf.gov/showAward?AWD_ID=2234213&H=f", "2234213"), (lambda c: awards.nsf_text(awards.nsf(c)), "NSF-DMR1507101", "DMR-1507101"), (lambda c: awards.nsf_text(awards.nsf(c)), "12", None),
    (lambda c: awards.nsf_variants(awards.nsf(c)), "DMR1507101", ["1507101", "DMR 1507101", "DMR-1507101"]), (lambda c: awards.parsed(F.lit(awards.NSF), c), "1507101; 1507101,x", ["1507101"]), (lambda c: awards.parsed(F.lit("other"), c), "1507101", []),
    (lambda c: awards.reference(c)["title"], "J~2019~Some title~N~10.1/X", "Some title"), (lambda c: awards.reference(c)["doi"], "J~2019~Some title~N~10.1/X", "10.1/x"),
]


def test_scalar_functions(spark):
    rows = [(i, text) for i, (_, text, _) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "i long, s string")
    for i, (f, text, want) in enumerate(CASES):
        got = df.where(F.col("i") == i).select(f(F.col("s")).alias("v")).first()["v"]
        assert got == want, (i, text, got, want)


@pytest.mark.parametrize("parts,want", [([2020, 2, 5], dt.date(2020, 2, 5)), ([2020, 2], dt.date(2020, 2, 29)), ([2019], dt.date(2019, 12, 31)), ([2020, 2, 31], None), ([], None), (None, None), ([None], None)])
def test_date_parts(spark, parts, want):
    assert spark.createDataFrame([(parts,)], "p array<long>").select(clean.date_of_parts(F.col("p")).alias("v")).first()["v"] == want


def test_names(spark):
    got = value(spark, clean.parsed_name, "van der Berg, Jan Q. P.").asDict()
    assert got == {"first_initial": "J", "given_name": "Jan", "middle_initials": "QP", "middle_names": "Q. P.", "surname": "van der Berg", "full": "van der Berg, Jan Q. P."}
    assert value(spark, clean.parsed_name, "Plato")["full"] == "Plato" and value(spark, clean.parsed_name, "Plato")["surname"] is None
    assert value(spark, lambda c: clean.creator_name(F.lit("Ada"), c, F.lit(" ")), "Lovelace")["surname"] == "Lovelace"


def test_json_lists(spark):
    assert len(value(spark, clean.affiliations, '{"name":"a"}')) == 1 and len(value(spark, clean.affiliations, '[{"name":"a"},{"name":"b"}]')) == 2
    assert value(spark, clean.affiliations, None) == [] and value(spark, clean.affiliations, "oops") in ([], None)


def test_nih_variants(spark):
    got = value(spark, lambda c: awards.nih_variants(awards.nih(c)), "5R01AI176039-02S1")
    assert {"AI176039", "AI 176039", "AI176039-02", "R01AI176039-02S1", "5R01AI176039", "5 R01 AI 176039-02S1"} <= set(got) and len(got) == len(set(got))


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(max_size=30), min_size=8, max_size=8))
def test_cleaning_twice_changes_nothing(spark, texts):
    df = spark.createDataFrame([(t.replace("\0", ""),) for t in texts], "s string")
    for f in (clean.blank_to_null, clean.strip, clean.name):
        once = f(F.col("s"))
        assert df.where(~once.eqNullSafe(f(once))).count() == 0


def test_similarities(spark):
    row = spark.range(1).select(clean.pair_similarity(F.lit("healed"), F.lit("sealed")).alias("a"), clean.pair_similarity(F.lit(""), F.lit("x")).alias("b"), clean.cosine_distance(F.array(F.lit(1.0), F.lit(0.0)), F.array(F.lit(0.0), F.lit(2.0))).alias("c")).first()
    assert row["a"] == pytest.approx(0.8) and row["b"] == 0 and row["c"] == pytest.approx(1)
    assert enrich.ratio("abcd", "abxd") == pytest.approx(75) and enrich.ratio("", "") == 100 and enrich.ratio("a", "b") == 0


def test_lookup_tables():
    assert len(kinds.INDEX_TYPES) == 34 and kinds.INDEX_TYPES["BookChapter"] == "BOOK_CHAPTER" and kinds.INDEX_TYPES["Award"] == "OTHER"
    assert len(awards.JUNK) == 36 and clean.camel("work_version_id") == "workVersionId"
