"""Session helpers shared by the training-data operators."""

from __future__ import annotations

import atexit
import io
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ROOT = str(Path(__file__).resolve().parents[2])
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let Python workers import this library when it runs from a checkout: by path in local mode, as a zip file in the shared folder of a cluster."""
    context = spark.sparkContext
    if context.master.startswith("local"):
        paths = [p for p in context.environment.get("PYTHONPATH", "").split(":") if p]
        if ROOT not in paths:
            context.environment["PYTHONPATH"] = ":".join([ROOT, *paths])
    elif context.applicationId not in _SHIPPED:
        _SHIPPED.add(context.applicationId)
        packed = io.BytesIO()
        with zipfile.ZipFile(packed, "w") as z:
            for f in sorted((Path(ROOT) / "weftline").rglob("*.py")):
                z.write(f, f.relative_to(ROOT))
        path = f"{shared_dir(spark)}/weftline-{uuid.uuid4().hex}.zip"
        target = context._jvm.org.apache.hadoop.fs.Path(path)
        fs = target.getFileSystem(context._jsc.hadoopConfiguration())
        out = fs.create(target, True)
        out.write(bytearray(packed.getvalue()))
        out.close()
        fs.deleteOnExit(target)
        context.addPyFile(path)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session; one of our own only in local mode, as in tests.

    A cluster without that setting is refused: a folder of one machine would lose what its executors wrote.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        got = spark.sparkContext._jsc.sc().getCheckpointDir()
        folder = got.get() if got.isDefined() else None
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        own = tempfile.mkdtemp(prefix="weftline-")
        atexit.register(shutil.rmtree, own, True)
        folder = f"file://{own}"
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage (a lost executor re-reads files instead of recomputing Python stages) and lets several
    consumers share one computation.  The files go when the driver ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/weftline-{uuid.uuid4().hex}"
    df.write.parquet(path)
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return spark.read.schema(df.schema).parquet(path)
