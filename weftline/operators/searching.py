"""Search of works for plans: scores of each clause as pairs (plan_id, work_id, score), put together by :func:`match.search`.

Clauses that qualify a work: funded DOIs (15), authors (ORCID 2, surname 1), awards (10 for each with any spelling).  Clauses that only
add: institutions and funders (ROR 2, name 1), likeness of text.  A plan's item counts once for a work, with its best way to match.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from weftline.functions import awards, clean

from . import match


def phrase_pairs(asked: DataFrame, held: DataFrame, slop: int = 3) -> DataFrame:
    """``asked_name, held_name``: distinct names of which the first is a phrase in the second.

    All words of a phrase occur in what holds it, so candidates meet on the phrase's rarest word among the held names.
    """
    have = held.select(F.col("name").alias("held_name")).where("held_name is not null").distinct()
    words = have.select("held_name", F.explode(F.array_distinct(match.tokens(F.col("held_name")))).alias("word"))
    often = words.groupBy("word").agg(F.count("*").alias("df"))
    want = asked.select(F.col("name").alias("asked_name")).where("asked_name is not null").distinct().withColumn("words", match.tokens(F.col("asked_name"))).where(F.size("words") > 0)
    each = want.select("asked_name", "words", F.explode(F.array_distinct("words")).alias("word")).join(often, "word", "left")
    rarest = each.groupBy("asked_name", "words").agg(F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "word"))["word"].alias("word"), F.min(F.coalesce("df", F.lit(0))).alias("least")).where("least > 0")
    met = rarest.join(words, "word")
    return met.where(match.phrase(F.col("held_name"), F.col("words"), slop)).select("asked_name", "held_name")


def entity_scores(plans: DataFrame, works: DataFrame, items: Column, members: Column, id_score: float = 2.0, name_score: float = 1.0, slop: int = 3) -> DataFrame:
    """``plan_id, work_id, score, items``: for each item (struct(id, name)) of a plan, ``id_score`` if a member of the work has its id,
    else ``name_score`` if its name is a phrase in a member's; summed over items."""
    asked = plans.select("plan_id", F.posexplode(items).alias("i", "x")).select("plan_id", "i", "x.id", "x.name")
    held = works.select("work_id", F.explode(members).alias("x")).select("work_id", "x.id", "x.name").distinct()
    by_id = asked.where("id is not null").select("plan_id", "i", "id").join(held.where("id is not null").select("work_id", "id").distinct(), "id").select("plan_id", "i", "work_id", F.lit(id_score).alias("s"))
    named = asked.where("name is not null").select("plan_id", "i", F.col("name").alias("asked_name")).join(phrase_pairs(asked, held, slop), "asked_name")
    by_name = named.join(held.select("work_id", F.col("name").alias("held_name")).distinct(), "held_name").select("plan_id", "i", "work_id", F.lit(name_score).alias("s"))
    best = by_id.unionByName(by_name).groupBy("plan_id", "work_id", "i").agg(F.max("s").alias("s"))
    return best.groupBy("plan_id", "work_id").agg(F.sum("s").alias("score"), F.array_sort(F.collect_list("i")).alias("items"))


def _funded(plans: DataFrame, works: DataFrame) -> DataFrame:
    return match.keyed_scores(plans, works, "items", F.array_distinct("funded_dois"), F.array("work_id"), 15.0).withColumn("score", F.lit(15.0))


def clauses(plans: DataFrame, works: DataFrame) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """(qualifying, adding) scores by name.

    ``plans``: plan_id, funded_dois array<string>, authors / institutions / funders array<struct(id, name)>, awards
    array<struct(ror, text)>; ``works``: work_id (a DOI), authors / institutions / funders as for plans, award_ids array<string>.
    """
    texts = plans.withColumn("spellings", F.transform("awards", lambda a: F.transform(awards.variants(a["ror"], a["text"]), lambda v: F.lower(v))))
    award = match.keyed_scores(texts, works, "items", F.col("spellings"), F.transform("award_ids", lambda a: F.lower(a)), 10.0, per_item=lambda spellings: spellings)
    return (
        {"funded_dois": _funded(plans, works), "authors": entity_scores(plans, works, F.col("authors"), F.col("authors")), "awards": award},
        {k: entity_scores(plans, works, F.col(k), F.col(k)) for k in ("institutions", "funders")},
    )


def best_works(plans: DataFrame, works: DataFrame, k: int = 100, slop: int = 3) -> DataFrame:
    """:func:`match.search` of all :func:`clauses`, without making pairs that can't be among the ``k`` best.

    Authors and funded DOIs name few works, so their pairs are made and scored in full.  An award that many plans name meets all its works:
    there plans with the same awards, institutions, funders and window, and works with the same lists, type and date, score alike.  One of
    each kind is compared, and a kind of works stands for its ``k`` smallest ids.  A pair that no author or DOI has is outside a plan's ``k``
    best if it is outside those of its kind, and no clause takes from a score, so the result is the same.
    """
    people = entity_scores(plans, works, F.col("authors"), F.col("authors"), slop=slop).select("plan_id", "work_id", "score")
    strong = _funded(plans, works).select("plan_id", "work_id", "score").unionByName(people).groupBy("plan_id", "work_id").agg(F.sum("score").alias("strong"))
    keyed = lambda d, key, name: d.select(F.col(key), F.md5(F.to_json(F.struct(*[c for c in d.columns if c != key]))).alias(name), *[c for c in d.columns if c != key])
    p = keyed(plans.select("plan_id", "awards", "institutions", "funders", "project_start", "project_end"), "plan_id", "p_kind")
    w = keyed(works.select("work_id", "award_ids", F.col("institutions").alias("w_institutions"), F.col("funders").alias("w_funders"), "work_type", "publication_date"), "work_id", "w_kind")
    of_plan, of_work = p.select("plan_id", "p_kind"), w.select("work_id", "w_kind")
    one = lambda d, kind: d.groupBy(kind).agg(*[F.any_value(c).alias(c) for c in d.columns[2:]])
    worded = lambda c: F.transform(c, lambda x: F.struct(x["id"].alias("id"), match.tokens(x["name"]).alias("words"))).alias(c)
    spellings = F.transform("awards", lambda a: F.transform(awards.variants(a["ror"], a["text"]), lambda v: F.lower(v))).alias("spellings")
    p = one(p, "p_kind").select("p_kind", spellings, worded("institutions"), worded("funders"), "project_start", "project_end")
    w = one(w, "w_kind").select("w_kind", F.transform("award_ids", lambda a: F.lower(a)).alias("award_ids"), worded("w_institutions"), worded("w_funders"), "work_type", "publication_date")
    award = F.coalesce(F.size(F.filter("spellings", lambda s: F.coalesce(F.arrays_overlap(s, "award_ids"), F.lit(False)))), F.lit(0)) * 10.0
    common = F.greatest(award, F.lit(0.0)) + _items_among("institutions", "w_institutions", slop) + _items_among("funders", "w_funders", slop)

    direct = strong.join(of_plan, "plan_id").join(of_work, "work_id").join(p, "p_kind").join(w, "w_kind").where(match.allowed()).select("plan_id", "work_id", (F.col("strong") + common).alias("score"))

    named = lambda d, kind, spelled: d.select(kind, F.explode(spelled).alias("spelling")).where("spelling is not null").distinct()
    pairs = named(p, "p_kind", F.flatten("spellings")).join(named(w, "w_kind", "award_ids"), "spelling").select("p_kind", "w_kind").distinct()
    scored = pairs.join(p, "p_kind").join(w, "w_kind").where(match.allowed()).select("p_kind", "w_kind", common.alias("score"))
    first = match.top_k(of_work, ["w_kind"], k, F.col("work_id"))
    alike = match.top_k(scored.join(first, "w_kind"), ["p_kind"], k, F.desc("score"), F.col("work_id"))
    shared = of_plan.join(alike.select("p_kind", "work_id", "score"), "p_kind").select("plan_id", "work_id", "score")

    # one shuffle by plan serves the grouping and the ranks
    both = direct.unionByName(shared).repartition("plan_id").groupBy("plan_id", "work_id").agg(F.max("score").alias("score"))
    return match.best_pairs(both, k)


def _items_among(items: str, members: str, slop: int, id_score: float = 2.0, name_score: float = 1.0) -> Column:
    """The sum of :func:`entity_scores` within a row: items and members are array<struct(id, words)>."""

    def one(x: Column) -> Column:
        by_id = F.exists(members, lambda m: F.coalesce(m["id"] == x["id"], F.lit(False)))
        by_name = F.exists(members, lambda m: match.phrase_in(m["words"], x["words"], slop))
        return F.when(by_id, F.lit(id_score)).when(by_name, F.lit(name_score)).otherwise(F.lit(0.0))

    return F.coalesce(F.aggregate(F.transform(items, one), F.lit(0.0), lambda s, v: s + F.coalesce(v, F.lit(0.0))), F.lit(0.0))


def prepared_works(index: DataFrame) -> DataFrame:
    """Works of the index as :func:`clauses` reads them."""
    pair = lambda c, i, n: F.transform(c, lambda x: F.struct(F.lower(x[i]).alias("id"), x[n].alias("name"))).alias(c)
    return index.select(F.col("doi").alias("work_id"), "work_type", "publication_date", clean.content(F.col("title"), F.col("abstract_text")).alias("content"), pair("authors", "orcid", "full"), pair("institutions", "ror", "name"), pair("funders", "ror", "name"), F.transform("awards", lambda a: a["award_id"]).alias("award_ids"))


def prepared_plans(plans: DataFrame, enriched: DataFrame | None = None) -> DataFrame:
    """Clean plans (with the awards of :func:`enrich.enriched`, if given) as :func:`clauses` reads them."""
    out = plans.select(
        F.col("doi").alias("plan_id"), "project_start", "project_end", clean.content(F.col("title"), F.col("abstract")).alias("content"),
        F.transform("authors", lambda x: F.struct(F.lower(x["orcid"]).alias("id"), x["surname"].alias("name"))).alias("authors"),
        F.transform("institutions", lambda x: F.struct(F.lower(x["ror"]).alias("id"), x["name"].alias("name"))).alias("institutions"),
        F.transform("funding", lambda x: F.struct(F.lower(x["funder"]["ror"]).alias("id"), x["funder"]["name"].alias("name"))).alias("funders"),
        F.flatten(F.transform("funding", lambda x: F.array(*[F.struct(clean.ror(x["funder"]["ror"]).alias("ror"), x[f].alias("text")) for f in ("funding_opportunity_id", "award_id")]))).alias("awards"),
    )
    none = F.array().cast("array<string>")
    if enriched is None:
        return out.withColumn("funded_dois", none)
    dois = enriched.select(F.col("doi").alias("plan_id"), F.array_distinct(F.flatten("awards.funded_dois")).alias("funded_dois"))
    return out.join(dois, "plan_id", "left").withColumn("funded_dois", F.coalesce("funded_dois", none))


def related_works(plans: DataFrame, works: DataFrame, k: int = 100, likeness: bool = True) -> DataFrame:
    """The ``k`` best works of each plan: ``plan_id, work_id, score, score_max, match_rank`` over prepared plans and works."""
    if not likeness:
        return best_works(plans, works, k)
    must, should = clauses(plans, works)
    texts = plans.select("plan_id", "content").where("content is not null"), works.select("work_id", "content").where("content is not null")
    more = [*should.values(), match.more_like_this(*texts, "plan_id", "work_id", "content")]
    return match.search(list(must.values()), more, works, plans, k=k)
