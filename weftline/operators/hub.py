"""Plans as keyed, versioned records: faceted reads with pages, versions, merges, redaction and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

LATEST, TOMBSTONE = "VERSION#latest", "VERSION#tombstone"
SORTS = {"title": "title", "modified": "modified"}


def facets(postings: DataFrame, wanted: dict[str, list[str]]) -> DataFrame:
    """``pk`` of the records under any of the wanted facet values (kind -> values); at least one is required."""
    wanted = {k: v for k, v in wanted.items() if v}
    if not wanted:
        raise ValueError("one of owner, org or funder is required")
    test = None
    for kind, values in wanted.items():
        t = (F.col("kind") == kind) & F.col("value").isin(*[v.lower() for v in values])
        test = t if test is None else test | t
    return postings.where(test).select("pk").distinct()


def allowed(asked: list[str], permitted: list[str]) -> list[str]:
    """The organisations a caller may read: those asked for that are permitted, all permitted if none is asked for."""
    return [a for a in asked if a in set(permitted)] if asked else list(permitted)


def containing(df: DataFrame, term: str, *columns: str) -> DataFrame:
    test = F.lit(False)
    for c in columns:
        test = test | F.coalesce(F.contains(F.lower(c), F.lit(term.lower())), F.lit(False))
    return df.where(test)


def sorted_by(df: DataFrame, sort: str = "modified", descending: bool = True, key: str = "pk") -> DataFrame:
    column = F.col(SORTS.get(sort, "modified"))
    return df.orderBy(column.desc_nulls_last() if descending else column.asc_nulls_last(), key)


def page(df: DataFrame, number: int = 1, size: int = 25, most: int = 100) -> tuple[DataFrame, dict]:
    """A page of a sorted frame and its numbers.  Sizes are capped, and a number past the end is the last page."""
    size = min(max(1, size), most)
    total = df.count()
    pages = max(1, -(-total // size))
    number = min(max(1, number), pages)
    links = {"first": 1, "last": pages} | ({"prev": number - 1} if number > 1 else {}) | ({"next": number + 1} if number < pages else {})
    return df.offset((number - 1) * size).limit(size), {"page": number, "per_page": size, "total_items": total, "total_pages": pages, "links": links}


def redacted(df: DataFrame, kinds: Column, privacy: str = "privacy", related: str = "related") -> DataFrame:
    """Related items of the given kinds are hidden unless the record is public."""
    keep = F.filter(related, lambda r: ~F.array_contains(kinds, r["kind"]))
    return df.withColumn(related, F.when(F.col(privacy) == "public", F.col(related)).otherwise(keep))


def stale(modified: Column, updated: Column) -> Column:
    """Never enriched, or modified since."""
    return updated.isNull() | (modified.isNotNull() & (modified >= updated))


def versions(updates: DataFrame, hours: int = 1) -> DataFrame:
    """Which updates leave a snapshot of the record before them: ``pk, sk, modified`` of each snapshot.

    ``updates``: pk, seq, modified (timestamp), owner, updater.  An update snapshots its predecessor unless the owner
    itself made it within ``hours`` after the predecessor.
    """
    by = Window.partitionBy("pk").orderBy("modified", "seq")
    out = updates.withColumn("__before", F.lag("modified").over(by)).where("__before is not null")
    at = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    gap = at("modified") - at("__before")
    out = out.where(~(F.col("owner").eqNullSafe(F.col("updater")) & (gap <= hours * 3_600_000_000)))
    return out.select("pk", F.concat(F.lit("VERSION#"), F.date_format("__before", "yyyy-MM-dd'T'HH:mm:ss")).alias("sk"), F.col("__before").alias("modified"))


def merge_patch(old: DataFrame, new: DataFrame, key: str, kept: tuple[str, ...] = ()) -> DataFrame:
    """Each field of ``new`` that is there and not NULL wins, except ``kept`` ones; records only in one frame stay."""
    a, b = old.alias("a"), new.alias("b")
    fields = [c for c in old.columns if c != key]
    pick = lambda c: F.coalesce(f"a.{c}", f"b.{c}") if c in kept else F.coalesce(f"b.{c}", f"a.{c}")
    return a.join(b, F.col(f"a.{key}") == F.col(f"b.{key}"), "full").select(F.coalesce(f"b.{key}", f"a.{key}").alias(key), *[(pick(c) if c in new.columns else F.col(f"a.{c}")).alias(c) for c in fields])


def tombstones(records: DataFrame, gone: DataFrame) -> DataFrame:
    """The records with the latest version of those in ``gone`` (pk) replaced by a tombstone of marked title."""
    mark = gone.select("pk", F.lit(True).alias("__gone")).distinct()
    hit = F.coalesce("__gone", F.lit(False)) & (F.col("sk") == LATEST)
    out = records.join(mark, "pk", "left").withColumn("title", F.when(hit, F.concat(F.lit("OBSOLETE: "), F.coalesce("title", F.lit("")))).otherwise(F.col("title")))
    return out.withColumn("sk", F.when(hit, F.lit(TOMBSTONE)).otherwise(F.col("sk"))).select(*records.columns)


def created(records: DataFrame, new: DataFrame) -> DataFrame:
    """New records whose key is not taken, as latest versions."""
    return new.join(records.select("pk").distinct(), "pk", "left_anti").withColumn("sk", F.lit(LATEST))


def changed(old: DataFrame, new: DataFrame, key: str, ignored: tuple[str, ...] = ()) -> DataFrame:
    """Keys whose content differs, ignored columns apart; new keys count as changed."""
    names = sorted(c for c in new.columns if c != key and c not in ignored)
    h = lambda d, n: d.select(key, F.md5(F.to_json(F.struct(*names), {"ignoreNullFields": "false"})).alias(n))
    return h(new, "n").join(h(old, "o"), key, "left").where(~F.col("n").eqNullSafe(F.col("o"))).select(key)


def harvested(known: DataFrame, found: DataFrame) -> DataFrame:
    """``pk, provenance, works``: found works (pk, provenance, work_id) that are not known (pk, work_id), by where they came from."""
    fresh = found.join(known.select("pk", "work_id"), ["pk", "work_id"], "left_anti")
    return fresh.groupBy("pk", "provenance").agg(F.array_sort(F.collect_set("work_id")).alias("works"))


def reviewed(works: DataFrame, decisions: DataFrame) -> DataFrame:
    """Works (pk, work_id, status) with the latest decision (pk, work_id, status) taken over; ``related`` says which are linked."""
    d = decisions.select("pk", "work_id", F.col("status").alias("__status"))
    out = works.join(d, ["pk", "work_id"], "left").withColumn("status", F.coalesce("__status", "status")).drop("__status")
    return out.withColumn("related", F.col("status") == "approved")


def missing(listed: DataFrame, *places: DataFrame, key: str) -> list[DataFrame]:
    """For each place, the listed keys that are not in it."""
    return [listed.select(key).join(p.select(key), key, "left_anti") for p in places]


def normalised_awards(df: DataFrame, mapping: dict[str, Column]) -> DataFrame:
    """Funder search results in one shape (project id, title, …); rows without an id or title go, repeated ones too."""
    return df.select(*[v.alias(k) for k, v in mapping.items()]).where("award_id is not null and title is not null").distinct()
