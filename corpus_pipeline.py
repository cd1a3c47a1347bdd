"""A training-data pipeline over ``documents``: what is rejected, deduplicated, masked, mixed and packed stays so."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from weftline.llm import mixing, packing, secrets, simhash, toxicity
from weftline.llm.common import read, stored


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the multiple-instance model rejects go."""
    return toxicity.clean(docs, read(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return simhash.keep_one(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the text; every document stays."""
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays, as often as its source's weight asks, in training order."""
    return mixing.mixed(docs)


def pack_bins(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where every piece of every document goes; bins are numbered in training order."""
    return packing.pack_in_order(docs)


STAGES = [("toxicity", reject_toxic), ("simhash", drop_near_copies), ("secrets", mask_secrets), ("mixing", mix_sources), ("packing", pack_bins)]
ORACLE_SQL = None  # trained models decide; tests/llm compares the stages with brute-force versions


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written as Parquet in the shared folder and read again by the next."""
    docs = read(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs)
    return docs
