"""Writing: sized Parquet, gzip JSON, keyed merges, partial upserts and search extracts."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from weftline.functions import clean

SAMPLED = 10_000


def export(df: DataFrame, path: str, bytes_per_file: int = 100 << 20, rows_per_file: int = 1_000_000) -> None:
    """Snappy Parquet in files of about a size at most, replacing what is there.

    The hint lets AQE even out the partitions; rows a file follow from the bytes of a sample of about ``SAMPLED`` rows as JSON, which are more
    than those of Parquet, so files come out below the size.
    """
    n = df.count()
    mean = df.sample(min(1.0, SAMPLED / max(n, 1)), 1).agg(F.avg(F.octet_length(F.to_json(F.struct(*df.columns))))).first()[0]
    rows = min(rows_per_file, max(1, int(bytes_per_file / max(mean or 1.0, 1.0))))
    df.hint("rebalance").write.mode("overwrite").option("compression", "snappy").option("maxRecordsPerFile", rows).parquet(path)


def sent(df: DataFrame, send: Callable[[list[str]], dict[str, str]], key: str, batch: int = 1000, tries: int = 10, first_wait: float = 2.0, most_wait: float = 600.0) -> DataFrame:
    """``key, error``: documents given to ``send`` as JSON, in batches inside the executors, and what is wrong with those that failed.

    ``send`` returns the errors by key; documents with an error, or of a call that raises, are tried again after waits that double.
    Upserts by key may be repeated, so a task that is run again does no harm.
    """
    slim = df.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct(*df.columns)).alias("value"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for i in range(0, len(pdf), batch):
                left = dict(zip(pdf["key"].iloc[i : i + batch], pdf["value"].iloc[i : i + batch]))
                failed: dict[str, str] = {}
                for turn in range(tries):
                    try:
                        failed = send(list(left.values()))
                    except Exception as e:  # whatever the client raises is reported for the whole batch
                        failed = dict.fromkeys(left, f"{type(e).__name__}: {e}")
                    left = {k: v for k, v in left.items() if k in failed}
                    if not left:
                        break
                    if turn + 1 < tries:
                        time.sleep(min(most_wait, first_wait * 2**turn))
                yield pd.DataFrame({"key": list(left), "error": [failed[k] for k in left]})

    return slim.mapInPandas(run, "key string, error string")


def error_summary(errors: DataFrame) -> DataFrame:
    """``error, n, example``: how often each error came, the most frequent first."""
    return errors.groupBy("error").agg(F.count("*").alias("n"), F.min("key").alias("example")).orderBy(F.desc("n"), "error")


def json_gz(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "gzip").json(path)


def camel_json(df: DataFrame) -> DataFrame:
    """``value``: each row as JSON with camelCase names."""
    return df.select(F.to_json(F.struct(*[F.col(c).alias(clean.camel(c)) for c in df.columns]), {"ignoreNullFields": "false"}).alias("value"))


def merged(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``new``, and those of ``old`` whose keys are not in it."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new)


def upserted(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Documents merged field by field: a field of ``new`` wins unless NULL, fields it lacks stay, new keys are added."""
    names = [c for c in old.columns if c != key] + [c for c in new.columns if c != key and c not in old.columns]
    a, b = old.alias("a"), new.alias("b")
    pick = lambda c: F.coalesce(*[F.col(f"{s}.{c}") for s, d in (("b", new), ("a", old)) if c in d.columns]).alias(c)
    return a.join(b, F.col(f"a.{key}") == F.col(f"b.{key}"), "full").select(F.coalesce(f"b.{key}", f"a.{key}").alias(key), *[pick(c) for c in names])


def document_sizes(df: DataFrame) -> DataFrame:
    """Dry run of a bulk load: count and bytes of the documents."""
    n = F.octet_length(F.to_json(F.struct(*df.columns)))
    return df.agg(F.count("*").alias("documents"), F.min(n).cast("long").alias("least"), F.max(n).cast("long").alias("most"), F.sum(n).cast("long").alias("total"), F.avg(n).alias("mean"))


def first_by(df: DataFrame, keys: Iterable[str], *order) -> DataFrame:
    """The first row of each key in the given order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(w)).where("__rank = 1").drop("__rank")


def work_versions(matches: DataFrame) -> DataFrame:
    """One row for each DOI among the matches: lists as JSON, and the MD5 of the content as 16 bytes."""
    lists = {c: F.to_json(c) for c, t in matches.dtypes if t.startswith(("array", "struct"))}
    content = [c for c in matches.columns if c not in ("doi", "updated_date", "plan_doi", "score")]
    return first_by(matches.withColumn("hash", F.unhex(clean.content_hash(content))).withColumns(lists), ["doi"], F.col("score").desc_nulls_last(), "plan_doi")


def append_export(spark: SparkSession, path: str, export_date: str) -> None:
    """The bookkeeping table of exports, keyed by date: exporting a date again leaves one row."""
    row = spark.createDataFrame([(export_date,)], "export_date string").select(F.to_timestamp("export_date").alias("export_date"), F.to_date("export_date").alias("d"))
    row.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("d").parquet(path)


def load(df: DataFrame, url: str, table: str, batch: int = 1000, **options: str) -> None:
    """Rows into a staging table over JDBC, for the database's own merge."""
    df.write.format("jdbc").mode("append").options(url=url, dbtable=table, batchsize=str(batch), **options).save()
