"""Index works and clean plans as the flat entity lists that matching joins on; shaped within the row, nothing is shuffled."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, functions as F

from weftline.functions import clean

WORK_KINDS = {"grant_id": "grant_ids", "funder_opportunity_id": "grant_ids", "person_id": "person_ids", "funder_id": "funder_ids", "affiliation_id": "affiliation_ids", "person_name": "person_names", "funder_name": "funder_names", "affiliation_name": "affiliation_names"}
PLAN_KINDS = WORK_KINDS | {"funder_opportunity_id": "opportunity_ids"}


def _each(items: Column, value) -> Column:
    """Distinct values that are there, in order of first appearance."""
    return F.array_distinct(F.array_compact(F.transform(items, value)))


def works(index: DataFrame, since: datetime.date | None = None, until: datetime.date | None = None) -> DataFrame:
    """``work_id, publication_date, content`` and the entity lists of WORK_KINDS, for works published in the bounds."""
    df = index.where(F.col("publication_date") >= F.lit(since)) if since else index
    df = df.where(F.col("publication_date") <= F.lit(until)) if until else df
    return df.select(
        F.col("doi").alias("work_id"), "publication_date", clean.content(F.col("title"), F.col("abstract_text")).alias("content"),
        _each(F.col("awards"), lambda x: F.lower(x["award_id"])).alias("grant_ids"),
        _each(F.col("authors"), lambda x: clean.orcid(x["orcid"])).alias("person_ids"),
        _each(F.col("funders"), lambda x: clean.ror(x["ror"])).alias("funder_ids"),
        _each(F.col("institutions"), lambda x: clean.ror(x["ror"])).alias("affiliation_ids"),
        _each(F.col("authors"), lambda x: clean.person_name(x["full"])).alias("person_names"),
        _each(F.col("funders"), lambda x: clean.name(x["name"])).alias("funder_names"),
        _each(F.col("institutions"), lambda x: clean.name(x["name"])).alias("affiliation_names"),
    )


def plans(clean_plans: DataFrame) -> DataFrame:
    """``plan_id, project_start, project_end, content`` and the entity lists of PLAN_KINDS; short windows are extended."""
    return clean_plans.select(
        F.col("doi").alias("plan_id"), "project_start", clean.window_end(F.col("project_start"), F.col("project_end")).alias("project_end"),
        clean.content(F.col("title"), F.col("abstract")).alias("content"),
        _each(F.col("funding"), lambda x: F.lower(clean.grant_id(x["award_id"]))).alias("grant_ids"),
        _each(F.col("funding"), lambda x: F.lower(x["funding_opportunity_id"])).alias("opportunity_ids"),
        _each(F.col("authors"), lambda x: clean.orcid(x["orcid"])).alias("person_ids"),
        _each(F.col("funding"), lambda x: clean.ror(x["funder"]["ror"])).alias("funder_ids"),
        _each(F.col("institutions"), lambda x: clean.ror(x["ror"])).alias("affiliation_ids"),
        _each(F.col("authors"), lambda x: clean.person_name(clean.author_name(x["full"]))).alias("person_names"),
        _each(F.col("funding"), lambda x: clean.bare_name(x["funder"]["name"])).alias("funder_names"),
        _each(F.col("institutions"), lambda x: clean.bare_name(x["name"])).alias("affiliation_names"),
    )
