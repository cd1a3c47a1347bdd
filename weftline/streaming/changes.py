"""The change stream of plan records: Structured Streaming into keyed tables, a batch at a time."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from weftline.operators.hub import LATEST

BUCKETS = 64
EVENT = "event_name string, pk string, sk string, seq long, modified timestamp, title string, abstract string, people array<string>, affiliations array<string>, funders array<string>"


def relevant(events: DataFrame) -> DataFrame:
    """Events of latest versions with a key."""
    return events.where(F.col("pk").isNotNull() & (F.col("sk") == LATEST) & F.col("event_name").isin("INSERT", "MODIFY", "REMOVE"))


def last_by_key(events: DataFrame) -> DataFrame:
    """The last event of each record in a batch."""
    w = Window.partitionBy("pk").orderBy(F.desc("modified"), F.desc("seq"))
    return events.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def postings(records: DataFrame) -> DataFrame:
    """``kind, value, pk, modified, title, abstract``: the inverted lists of records."""
    lists = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(c).alias("members")) for k, c in (("PERSON", "people"), ("AFFILIATION", "affiliations"), ("FUNDER", "funders"))])
    rows = records.select("pk", "modified", "title", "abstract", F.explode(lists).alias("x"))
    return rows.select("x.kind", F.explode("x.members").alias("value"), "pk", "modified", "title", "abstract").where("value is not null").withColumn("value", F.lower("value")).distinct()


def applied(index: DataFrame, batch: DataFrame, remove: bool = True) -> DataFrame:
    """The inverted lists after a batch: those of changed records are replaced, of removed ones dropped (kept if not ``remove``)."""
    last = last_by_key(relevant(batch))
    gone = last if remove else last.where("event_name <> 'REMOVE'")
    return index.join(gone.select("pk"), "pk", "left_anti").select(*index.columns).unionByName(postings(last.where("event_name <> 'REMOVE'")).select(*index.columns))


def maintain(events: DataFrame, folder: str, checkpoint: str, remove: bool = True, buckets: int = BUCKETS) -> StreamingQuery:
    """Keep the inverted lists of a stream in ``folder``, by buckets of the hashed record key.

    Each batch writes a new generation, named after it, of the buckets it touches, so a batch costs what it touches and one that is run
    again writes the same.  A manifest of the buckets completes a generation; the newest complete generation of each bucket is the
    table, and those that a bucket needs no more are deleted, the last two generations apart.
    """

    def one(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        last = last_by_key(relevant(batch)).withColumn("bucket", _bucket(buckets))
        touched = sorted(r["bucket"] for r in last.select("bucket").distinct().collect())  # as many as there are buckets, at most
        if touched:
            before = current(spark, folder, number, touched)
            new = postings(last.where("event_name <> 'REMOVE'")) if before is None else applied(before, batch, remove)
            path = f"{folder}/generation={number:012d}"
            new.withColumn("bucket", _bucket(buckets)).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(path)
            spark.createDataFrame([(k,) for k in touched], "bucket int").coalesce(1).write.mode("overwrite").json(f"{folder}/manifest/generation={number:012d}")
            _prune(spark, folder)

    return events.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("pk"), F.lit(buckets)).cast("int")


def _listed(spark: SparkSession, folder: str) -> list[str]:
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(str(s.getPath()) for s in fs.listStatus(path)) if fs.exists(path) else []


def _generation(path: str) -> int:
    return int(path.rpartition("=")[2])


def _newest(spark: SparkSession, folder: str, before: int | None = None) -> dict[int, int]:
    """Bucket -> its newest complete generation (before a number)."""
    done = [p for p in _listed(spark, f"{folder}/manifest") if (before is None or _generation(p) < before) and any(f.endswith("/_SUCCESS") for f in _listed(spark, p))]
    if not done:
        return {}
    rows = spark.read.schema("bucket int, generation string").option("basePath", f"{folder}/manifest").json(done).groupBy("bucket").agg(F.max("generation").alias("g")).collect()
    return {r["bucket"]: int(r["g"]) for r in rows}


def _prune(spark: SparkSession, folder: str) -> None:
    newest = _newest(spark, folder)
    needed = set(newest.values())
    jvm = spark.sparkContext._jvm
    for kind in ("", "/manifest"):
        there = [p for p in _listed(spark, f"{folder}{kind}") if "generation=" in p]
        for p in there[:-2]:
            if _generation(p) not in needed:
                path = jvm.org.apache.hadoop.fs.Path(p)
                path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def current(spark: SparkSession, folder: str, before: int | None = None, buckets: list[int] | None = None) -> DataFrame | None:
    """The table as of the newest complete generations (before a number), of all or some buckets; None before the first."""
    newest = _newest(spark, folder, before)
    if not newest:
        return None
    held = {p: {q.rpartition("=")[2] for q in _listed(spark, p)} for p in _listed(spark, folder) if "generation=" in p}
    where = {_generation(p): p for p in held}
    paths = [f"{where[g]}/bucket={k}" for k, g in sorted(newest.items()) if (buckets is None or k in buckets) and g in where and str(k) in held[where[g]]]
    if paths:
        return spark.read.parquet(*paths)
    return postings(spark.createDataFrame([], EVENT)).limit(0)


def version_stream(updates: DataFrame, hours: int = 1) -> DataFrame:
    """``pk, sk, modified``: the snapshots of :func:`weftline.operators.hub.versions` from a stream of updates that arrive in order."""

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        before = pd.Timestamp(state.get[0], unit="us") if state.exists else None
        rows = pd.concat(list(frames)).sort_values(["modified", "seq"])
        out = []
        for now, owner, updater in zip(rows["modified"], rows["owner"], rows["updater"]):
            if before is not None and not (owner == updater and now - before <= pd.Timedelta(hours=hours)):
                out.append((key[0], "VERSION#" + before.strftime("%Y-%m-%dT%H:%M:%S"), before))
            before = now
        state.update((int(before.value // 1000),))
        yield pd.DataFrame(out, columns=["pk", "sk", "modified"])

    return updates.groupBy("pk").applyInPandasWithState(step, "pk string, sk string, modified timestamp", "at long", "append", GroupStateTimeout.NoTimeout)


def windowed_counts(events: DataFrame, late: str = "10 minutes", size: str = "1 hour") -> DataFrame:
    """Events by type and time window; late ones beyond the watermark are dropped."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", size).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")
