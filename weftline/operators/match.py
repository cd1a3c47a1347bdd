"""Linking plans to works: weighted entity matches, vector re-ranking, search scores and pairwise comparison."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from weftline.functions import clean

WEIGHTS = {"grant_id": 100, "funder_opportunity_id": 10, "person_id": 5, "funder_id": 1, "affiliation_id": 1, "person_name": 5, "funder_name": 1, "affiliation_name": 1}
NAMES = ("person_name", "funder_name", "affiliation_name")
K1, B = 1.2, 0.75
BLOCK = 10_000  # query vectors shipped at once


def top_k(df: DataFrame, by: list[str], k: int, *order: Column, rank: str | None = None) -> DataFrame:
    """The first ``k`` rows of each group; Spark keeps only those of each partition before it shuffles."""
    name = rank or "__rank"
    out = df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col(name) <= k)
    return out if rank else out.drop(name)


def entities(df: DataFrame, key: list[str], columns: dict[str, str]) -> DataFrame:
    """``key, entity_type, entity``: one row for each member of the list columns (type -> column), in a single scan."""
    kinds = F.array(*[F.struct(F.lit(t).alias("entity_type"), F.col(c).alias("members")) for t, c in columns.items()])
    rows = df.select(*key, F.explode(kinds).alias("x")).select(*key, "x.entity_type", F.explode("x.members").alias("entity"))
    return rows.where("entity is not null")


_INSIDE = "publication_date between project_start and project_end"
SHARED = 64  # plans that have an entity, from which on they are compared by kind


def entity_matches(plans: DataFrame, works: DataFrame, weights: dict[str, int] = WEIGHTS, threshold: int = 3, k: int = 100, shared: int = SHARED) -> DataFrame:
    """``plan_id, work_id``, a count for each entity type, ``weighted_count`` and ``match_rank``.

    ``plans``: plan_id, project_start, project_end, entity_type, entity; ``works``: work_id, publication_date, entity_type,
    entity.  Entities must agree and the work must be published in the window.  Id matches count each repetition, name
    matches once.

    An entity that more than ``shared`` plans have meets many works for each of them.  Plans of one window with the same such entities
    count alike on works that share nothing else with them, so one plan of each kind is compared by these, and its ``k`` best are those of
    all.  Works met by another entity are counted in full for the plan itself.  No entity takes from a count: the result is the same.
    """
    rows = plans.groupBy("plan_id", "project_start", "project_end", "entity_type", "entity").agg(F.count("*").alias("n"))
    known = F.col("entity").isNotNull() & F.col("entity_type").isin(*weights)
    often = plans.where(known).groupBy("entity_type", "entity").agg(F.count_distinct("plan_id").alias("plans")).where(F.col("plans") > shared).select("entity_type", "entity", F.lit(True).alias("hot"))
    rows = rows.where(known).join(often, ["entity_type", "entity"], "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    each = [f"{t}_count" for t in weights]

    # few plans to an entity
    pairs = rows.where("not hot").join(works, ["entity_type", "entity"]).where(_INSIDE).select("plan_id", "work_id").distinct()
    window = rows.select("plan_id", "project_start", "project_end", "entity_type", "entity", "n")
    full = pairs.join(window, "plan_id").join(works, ["work_id", "entity_type", "entity"]).where(_INSIDE)
    full = _counted(full, weights)

    # many
    same = ["project_start", "project_end", "entities"]
    kinds = rows.where("hot").groupBy("plan_id", *same[:2]).agg(F.sort_array(F.collect_list(F.struct("entity_type", "entity", "n"))).alias("entities"))
    kinds = kinds.withColumn("kind", F.min("plan_id").over(Window.partitionBy(*same)))
    one = kinds.where("plan_id = kind").select("plan_id", *same[:2], F.explode("entities").alias("x")).select("plan_id", *same[:2], "x.*")
    alike = top_k(_weighed(_counted(_met(one, works, weights, threshold), weights), weights, threshold), ["plan_id"], k, F.desc("weighted_count"), F.col("work_id"))
    alike = kinds.select("plan_id", "kind").join(alike.withColumnRenamed("plan_id", "kind"), "kind").select("plan_id", "work_id", *each)

    # one shuffle by plan serves the grouping and the ranks
    both = full.unionByName(alike).repartition("plan_id").groupBy("plan_id", "work_id").agg(*[F.max(c).alias(c) for c in each])
    return top_k(_weighed(both, weights, threshold), ["plan_id"], k, F.desc("weighted_count"), F.col("work_id").asc(), rank="match_rank")


def _met(plans: DataFrame, works: DataFrame, weights: dict[str, int], threshold: int) -> DataFrame:
    """Rows of plans (plan_id, window, entity_type, entity, n) beside those of works where entities agree and the window holds.

    Types of a weight below the threshold have few, hot values.  A plan whose values of such types can't reach the threshold
    together meets works by its other types alone, and the weak ones are counted on those pairs only.
    """
    weak = F.col("entity_type").isin(*[t for t, w in weights.items() if w < threshold])
    weight = F.try_element_at(F.create_map(*[F.lit(x) for tw in weights.items() for x in tw]), F.col("entity_type"))
    repeats = works.where(weak & ~F.col("entity_type").isin(*NAMES)).groupBy("work_id", "entity_type", "entity").agg(F.count("*").alias("n")).agg(F.coalesce(F.max("n"), F.lit(1)).alias("most"))
    most = plans.where(weak).crossJoin(F.broadcast(repeats))  # one row
    enough = most.groupBy("plan_id").agg(F.sum(F.when(F.col("entity_type").isin(*NAMES), weight).otherwise(weight * F.col("n") * F.col("most"))).alias("bound")).where(F.col("bound") >= threshold).select("plan_id")
    mine = plans.select("plan_id", "project_start", "project_end", "entity_type", "entity", "n")
    able, others = mine.join(enough, "plan_id", "left_semi"), mine.join(enough, "plan_id", "left_anti")
    meet = lambda p, w: p.join(w, ["entity_type", "entity"]).where(_INSIDE).select("plan_id", "work_id", "entity_type", "entity", "n")
    strong = meet(others.where(~weak), works.where(~weak))
    pairs = strong.select("plan_id", "work_id").distinct().join(others.where(weak).select("plan_id", "entity_type", "entity", "n"), "plan_id")
    more = pairs.join(works.where(weak).select("work_id", "entity_type", "entity"), ["work_id", "entity_type", "entity"]).select("plan_id", "work_id", "entity_type", "entity", "n")
    return meet(able, works).unionByName(strong).unionByName(more)


def _counted(met: DataFrame, weights: dict[str, int]) -> DataFrame:
    """``plan_id, work_id`` and a count for each type of met rows, each of which stands for ``n`` of the plan's."""
    counts = met.groupBy("plan_id", "work_id", "entity_type", "entity").agg(F.sum("n").alias("n"))
    counts = counts.withColumn("n", F.when(F.col("entity_type").isin(*NAMES), F.lit(1)).otherwise(F.col("n")).cast("long"))
    return counts.groupBy("plan_id", "work_id").agg(*[F.sum(F.when(F.col("entity_type") == t, F.col("n")).otherwise(0)).alias(f"{t}_count") for t in weights])


def _weighed(counts: DataFrame, weights: dict[str, int], threshold: int) -> DataFrame:
    total = sum((F.col(f"{t}_count") * w for t, w in weights.items()), F.lit(0).cast("long"))
    return counts.withColumn("weighted_count", total).where(F.col("weighted_count") >= threshold)


def matches_by_plan(pairs: DataFrame) -> DataFrame:
    """``plan_id, matches``: the matches as a list, best first."""
    return pairs.groupBy("plan_id").agg(clean.in_order(F.col("match_rank"), F.struct(*[c for c in pairs.columns if c not in ("plan_id", "match_rank")])).alias("matches"))


def reranked(pairs: DataFrame, plan_vectors: DataFrame, work_vectors: DataFrame, weight: float = 5.0, similarity: bool = False) -> DataFrame:
    """Adds ``distance`` (cosine) and ``vector_weighted``; only the candidate pairs are compared, and lengths taken once a vector.

    By default the distance itself is added, ``weight`` times; ``similarity=True`` adds 1 - distance.
    """
    square = clean.dot(F.col("vector"), F.col("vector"))
    p = plan_vectors.select("plan_id", F.col("vector").alias("__p"), square.alias("__pp"))
    w = work_vectors.select("work_id", F.col("vector").alias("__w"), square.alias("__ww"))
    far = 1 - F.try_divide(clean.dot(F.col("__p"), F.col("__w")), F.sqrt(F.col("__pp") * F.col("__ww")))
    out = pairs.join(p, "plan_id", "left").join(w, "work_id", "left").withColumn("distance", far).drop("__p", "__w", "__pp", "__ww")
    gain = (1 - F.col("distance")) if similarity else F.col("distance")
    return out.withColumn("vector_weighted", F.col("weighted_count") + F.coalesce(gain, F.lit(0.0)) * weight)


def vector_search(queries: DataFrame, base: DataFrame, k: int, block: int = BLOCK) -> DataFrame:
    """``query_id, base_id, distance, rank``: exact nearest rows of ``base`` (id, vector) for stated ``queries`` (id, vector).

    Queries go through ``base`` in blocks of at most about ``block`` rows, each shipped to every task, which keeps its ``k``
    best; vectors of length 0 or of another size than the queries' have no distance.
    """
    blocks = -(-queries.count() // block)
    some = lambda d: d.where(F.col("id").isNotNull() & F.forall("vector", lambda x: x.isNotNull())).select("id", F.col("vector").cast("array<double>"))
    kind, parts = base.schema["id"].dataType.simpleString(), []
    for n in range(blocks):
        mine = some(queries.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == n)).toArrow()  # block rows, about
        sizes = pc.list_value_length(mine["vector"])
        for size in sorted(set(sizes.unique().to_pylist()) - {0, None}):
            asked = mine.filter(pc.equal(sizes, size))
            parts.append(some(base).where(F.size("vector") == size).mapInArrow(_nearest(asked, k), f"query_id {queries.schema['id'].dataType.simpleString()}, base_id {kind}, distance double"))
    if not parts:
        parts = [base.crossJoin(queries.select(F.col("id").alias("query_id")).limit(0)).select("query_id", F.col("id").alias("base_id"), F.lit(0.0).alias("distance"))]
    found = parts[0]
    for more in parts[1:]:
        found = found.unionByName(more)
    return top_k(found, ["query_id"], k, F.col("distance"), F.col("base_id"), rank="rank")


def _nearest(asked: pa.Table, k: int, rows: int = 256) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The ``k`` nearest of each query among all batches of a task; ties by id.

    Distances are held for ``rows`` queries and one batch at a time, and ``k`` rows of each query from batch to batch.
    """

    def unit(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        x = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
        with np.errstate(invalid="ignore", divide="ignore"):
            return x / np.linalg.norm(x, axis=1, keepdims=True)

    q = unit(asked["vector"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, tuple[np.ndarray, np.ndarray, pa.Array]] = {}  # of a block of queries: row, distance and id, by row, distance and id
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, x = batch.column(0), unit(batch.column(1))
            for i in range(0, len(q), rows):
                far = np.round(1 - q[i : i + rows] @ x.T, 6) + 0.0  # no negative zero
                most = np.sort(np.partition(far, min(k, far.shape[1]) - 1, axis=1)[:, :k], axis=1)[:, -1:]  # NaN last
                row, at = np.nonzero((far <= most) | (np.isnan(most) & ~np.isnan(far)))
                near, found = far[row, at], ids.take(pa.array(at))
                if i in best:
                    row, near, found = np.concatenate([best[i][0], row]), np.concatenate([best[i][1], near]), pa.concat_arrays([best[i][2], found])
                order = pc.sort_indices(pa.table({"row": row, "far": near, "id": found}), sort_keys=[("row", "ascending"), ("far", "ascending"), ("id", "ascending")]).to_numpy()
                row = row[order]
                keep = np.arange(len(row)) - np.searchsorted(row, row) < k
                order = order[keep]
                best[i] = row[keep], near[order], found.take(pa.array(order))
        for i, (row, near, found) in best.items():
            yield pa.RecordBatch.from_arrays([asked["id"].combine_chunks().take(pa.array(i + row)), found, pa.array(near)], ["query_id", "base_id", "distance"])

    return run


def to_embed(contents: DataFrame, embedded: DataFrame, key: str, batch: int) -> DataFrame:
    """The next batch of contents that have no embedding yet."""
    return contents.join(embedded.select(key), key, "left_anti").orderBy(key).limit(batch)


# text relevance


def tokens(c: Column) -> Column:
    """Folded words of letters and digits."""
    return F.filter(F.split(clean.fold(c), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def postings(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``key, term, tf, length`` of every distinct word, and a row of the term '' for each document with words."""
    words = docs.select(key, tokens(F.col(text)).alias("ws")).where(F.size("ws") > 0)
    rows = words.select(key, F.size("ws").alias("length"), F.explode(F.array_append("ws", F.lit(""))).alias("term")).where("term is not null")
    return rows.groupBy(key, "term").agg(F.count("*").alias("tf"), F.max("length").alias("length"))


def more_like_this(queries: DataFrame, docs: DataFrame, query_key: str, doc_key: str, text: str, terms: int = 25, min_tf: int = 1, min_df: int = 5) -> DataFrame:
    """``query_key, doc_key, score``: BM25 of each document for the ``terms`` most telling words (tf * idf) of each query text.

    Document counts, mean length and matches all come from one shuffle of postings: each reads the same columns of it, so that Spark
    can reuse the exchange.
    """
    index = postings(docs, doc_key, text)
    real = (F.col("tf") > 0) & (F.col("length") > 0)  # always; keeps the columns in every branch
    sizes = index.agg(F.count_if(real & (F.col("term") == "")).alias("docs"), F.avg(F.when(real & (F.col("term") == ""), F.col("length"))).alias("mean"))
    df = index.groupBy("term").agg(F.count_if(real).alias("df")).where(F.col("df") >= min_df)
    idf = df.crossJoin(F.broadcast(sizes)).select("term", "mean", F.log(1 + (F.col("docs") - F.col("df") + 0.5) / (F.col("df") + 0.5)).alias("idf"))  # sizes is one row
    asked = queries.select(query_key, F.explode(tokens(F.col(text))).alias("term")).groupBy(query_key, "term").agg(F.count("*").alias("q")).where(F.col("q") >= min_tf)
    asked = top_k(asked.join(idf, "term"), [query_key], terms, F.desc(F.col("q") * F.col("idf")), F.col("term")).select(query_key, "term", "idf", "mean")
    met = asked.join(index, "term")
    part = F.col("idf") * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("length") / F.col("mean")))
    return met.groupBy(query_key, doc_key).agg(F.sum(part).alias("score"))


def phrase(text: Column, words: Column, slop: int = 3) -> Column:
    """Whether the words (an array) occur in order in the text with at most ``slop`` other words between them in all."""
    return phrase_in(tokens(text), words, slop)


def phrase_in(text: Column, words: Column, slop: int = 3) -> Column:
    """:func:`phrase` in a text that is words already.

    For each start, the earliest next place of each word in turn is the closest ordered match.
    """
    n = F.size(words)

    def inside(ws: Column) -> Column:
        def span(i: Column) -> Column:
            def step(at: Column, w: Column) -> Column:
                here = F.array_position(F.slice(ws, at + 1, F.lit(slop + 1)), w).cast("int")
                return F.when((at < 1) | (at >= F.size(ws)) | (here == 0), F.lit(-1)).otherwise(at + here)

            last = F.aggregate(F.slice(words, F.lit(2), F.greatest(n - 1, F.lit(0))), i, step)
            return (last > 0) & (last - i - (n - 1) <= slop)

        starts = F.filter(F.transform(ws, lambda w, i: F.when(w == F.get(words, F.lit(0)), i + 1)), lambda i: i.isNotNull())
        return F.exists(starts, span)

    # the words of the text are bound once, as the variable of a lambda
    return F.coalesce((n > 0) & F.get(F.transform(F.array(text), inside), F.lit(0)), F.lit(False))


def highlighted(text: Column, terms: Column, tag: str = "mark") -> Column:
    """The text with every occurrence of the terms (whole words, any case) tagged."""
    safe = F.transform(terms, lambda t: F.concat(F.lit(r"\Q"), t, F.lit(r"\E")))
    return F.when(F.size(terms) > 0, F.regexp_replace(text, F.concat(F.lit(r"(?iu)(?<![\p{L}\p{N}_])("), F.array_join(safe, "|"), F.lit(r")(?![\p{L}\p{N}_])")), F.lit(f"<{tag}>$1</{tag}>"))).otherwise(text)


def fragments(text: Column, terms: Column, count: int = 2, size: int = 160, tag: str = "mark") -> Column:
    """The first ``count`` pieces of about ``size`` characters that hold a term, tagged."""
    pieces = F.regexp_extract_all(text, F.lit(rf"(?s)(.{{1,{size}}})(?:\s|$)"), F.lit(1))
    marked = F.filter(F.transform(pieces, lambda p: highlighted(p, terms, tag)), lambda p: F.contains(p, F.lit(f"<{tag}>")))
    return F.slice(marked, F.lit(1), F.lit(count))


# search scores


def best_of(*scores: Column) -> Column:
    """The largest score (no tie breaker); 0 without any."""
    return F.greatest(F.lit(0.0), *[F.coalesce(s.cast("double"), F.lit(0.0)) for s in scores])


def keyed_scores(queries: DataFrame, docs: DataFrame, items: str, members: Column, doc_members: Column, score: float, per_item: Callable[[Column], Column] | None = None) -> DataFrame:
    """``plan_id, work_id, score, items``: ``score`` for each distinct query item with a member among those of a document."""
    asked = queries.select("plan_id", F.posexplode(members).alias("i", "member"))
    asked = asked.select("plan_id", "i", F.explode(per_item(F.col("member"))).alias("member")) if per_item else asked
    have = docs.select("work_id", F.explode(doc_members).alias("member")).where("member is not null").distinct()
    met = asked.where("member is not null").join(have, "member").groupBy("plan_id", "work_id").agg(F.collect_set("i").alias(items))
    return met.withColumn("score", F.size(items) * F.lit(float(score))).withColumn(items, F.array_sort(items))


def search(must: list[DataFrame], should: list[DataFrame], works: DataFrame, plans: DataFrame, k: int = 100, excluded: str = "OUTPUT_MANAGEMENT_PLAN", years: int = 3, earliest: str = "1990-01-01") -> DataFrame:
    """``plan_id, work_id, score, score_max, match_rank``: pairs with one ``must`` score at least, ``should`` scores added.

    A work must not be of the excluded type and, if the plan starts at ``earliest`` or later, must be published between
    its start and ``years`` after its end (no bound without an end).  ``works``: work_id, work_type, publication_date;
    ``plans``: plan_id, project_start, project_end.
    """
    slim = lambda d, required: d.select("plan_id", "work_id", "score", F.lit(required).alias("required"))
    every = slim(must[0], True)
    for d in must[1:]:
        every = every.unionByName(slim(d, True))
    for d in should:
        every = every.unionByName(slim(d, False))
    pairs = every.groupBy("plan_id", "work_id").agg(F.sum("score").alias("score"), F.max("required").alias("required")).where("required").drop("required")
    pairs = pairs.join(works.select("work_id", "work_type", "publication_date"), "work_id").join(plans.select("plan_id", "project_start", "project_end"), "plan_id")
    return best_pairs(pairs.where(allowed(excluded, years, earliest)), k)


def allowed(excluded: str = "OUTPUT_MANAGEMENT_PLAN", years: int = 3, earliest: str = "1990-01-01") -> Column:
    """The condition of :func:`search` on the type and date of a work and the window of a plan."""
    bounded = F.col("project_start") >= F.lit(earliest).cast("date")
    inside = (F.col("publication_date") >= F.col("project_start")) & (F.col("project_end").isNull() | (F.col("publication_date") <= F.add_months("project_end", 12 * years)))
    return (F.coalesce(F.col("work_type"), F.lit("")) != excluded) & (~F.coalesce(bounded, F.lit(False)) | inside)


def best_pairs(pairs: DataFrame, k: int) -> DataFrame:
    """The ``k`` best works of each plan with the plan's best score beside."""
    pairs = pairs.withColumn("score_max", F.max("score").over(Window.partitionBy("plan_id")))
    return top_k(pairs, ["plan_id"], k, F.desc("score"), F.col("work_id"), rank="match_rank").select("plan_id", "work_id", "score", "score_max", "match_rank")


# pairwise comparison


def compared(pairs: DataFrame, plan: str = "p_", work: str = "w_") -> DataFrame:
    """Adds ``score, confidence, notes`` to candidate pairs with the same list columns on both sides (prefixes ``plan`` and ``work``):
    grant_ids, people_ids, people, affiliation_ids, affiliations, repo_ids, title, description, and opportunity_ids of the plan.

    A shared grant is Absolute, 100, and nothing else counts.  Texts and repositories count only if something else did.
    """
    shared = lambda a, b: F.coalesce(F.size(F.array_intersect(F.col(plan + a), F.col(work + b))), F.lit(0))
    grant = shared("grant_ids", "grant_ids")
    found = {
        "opportunity": F.when(shared("opportunity_ids", "grant_ids") > 0, 5).otherwise(0),
        "orcids": 2 * shared("people_ids", "people_ids"),
        "names": 2 * shared("people", "people"),
        "affiliations": shared("affiliation_ids", "affiliation_ids") + shared("affiliations", "affiliations"),
    }
    base = sum(found.values(), F.lit(0))

    def alike(c: str) -> Column:
        s = clean.pair_similarity(F.col(plan + c), clean.without_stop_words(F.col(work + c)))
        return F.when(clean.blank_to_null(F.col(work + c)).isNull(), 0).when(s >= 0.75, 5).when(s >= 0.5, 2).otherwise(0)

    more = {"repositories": shared("repo_ids", "repo_ids"), "title": alike("title"), "description": alike("description")}
    more = {k: F.when(base > 0, v).otherwise(0) for k, v in more.items()}
    found |= more
    out = pairs.withColumns({f"__{k}": v for k, v in found.items()} | {"__grant": grant})
    total = sum((F.col(f"__{k}") for k in found), F.lit(0))
    out = out.withColumn("score", F.when(F.col("__grant") > 0, 100).otherwise(total))
    out = out.withColumn("confidence", F.when(F.col("__grant") > 0, "Absolute").when(F.col("score") > 10, "High").when(F.col("score") > 5, "Medium").otherwise("Low"))
    notes = F.when(F.col("__grant") > 0, F.array(F.lit("grant"))).otherwise(F.array_compact(F.array(*[F.when(F.col(f"__{k}") > 0, F.lit(k)) for k in found])))
    return out.withColumn("notes", notes).drop("__grant", *[f"__{k}" for k in found])


def best_plan(scored: DataFrame, work_id: str, plan_id: str) -> DataFrame:
    """The best plan of each work."""
    return top_k(scored, [work_id], 1, F.desc("score"), F.col(plan_id))
