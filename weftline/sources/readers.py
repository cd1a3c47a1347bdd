"""Reading: newline JSON with a fixed schema, one-document JSON, Parquet by glob, dated folders, key-value tables, JDBC."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def json_lines(spark: SparkSession, path: str | list[str], schema: str, pattern: str | None = None, partitions: int | None = None) -> DataFrame:
    """Newline JSON below ``path``, compressed or not.  The schema is never inferred; JSON text declared as string stays text.

    Gzip files can't be split: ``partitions`` spreads the rows of few large ones after reading.
    """
    reader = spark.read.schema(schema).option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    df = reader.json(path)
    return df.repartition(partitions) if partitions else df


def json_document(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A file that holds one JSON array."""
    return spark.read.schema(schema).option("multiLine", "true").json(path)


def parquet(spark: SparkSession, *paths: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(*paths)
    return df.select(*columns) if columns else df


def latest(spark: SparkSession, path: str, column: str = "release_date", until: str | None = None) -> DataFrame:
    """The newest dated folder (``column=YYYY-MM-DD``) of a table, no later than ``until``, found by listing folders, without a job."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    names = [s.getPath().getName() for s in root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(root) if s.isDirectory()]
    dates = [n.partition("=")[2] for n in names if n.startswith(f"{column}=")]
    dates = [d for d in dates if until is None or d <= until]
    if not dates:
        raise FileNotFoundError(f"{path} has no folder of {column}{f' up to {until}' if until else ''}")
    return spark.read.parquet(f"{path}/{column}={max(dates)}")


def items(df: DataFrame, pk: str | None = None, sk: str | None = None, where: Column | None = None, columns: list[str] | None = None) -> DataFrame:
    """Get (both keys), query (one) or scan (none) over a table keyed by ``pk`` and ``sk``."""
    for name, value in (("pk", pk), ("sk", sk)):
        df = df.where(F.col(name) == value) if value is not None else df
    df = df.where(where) if where is not None else df
    return df.select(*columns) if columns else df


def first_files(paths: list[str], size: int, batches: int | None = None) -> list[list[str]]:
    """Files in batches of ``size``, by name; the first ``batches`` of them."""
    out = [sorted(paths)[i : i + size] for i in range(0, len(paths), size)]
    return out if batches is None else out[:batches]


def rows_of(df: DataFrame, page: int = 500) -> Iterator[list]:
    """All rows in pages, a partition at a time on the driver: for clients that stream a result."""
    held: list = []
    for row in df.toLocalIterator():
        held.append(row)
        if len(held) == page:
            yield held
            held = []
    if held:
        yield held


def jdbc(spark: SparkSession, url: str, query: str, **options: str) -> DataFrame:
    return spark.read.format("jdbc").options(url=url, query=query, **options).load()


def spread(df: DataFrame) -> DataFrame:
    """The rows over all cores, three tasks to a core, before work that is heavy for each row: a small file is one task otherwise."""
    tasks = 3 * df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= tasks else df.repartition(tasks)
