"""Audits of a model: all of them in one aggregation pass, and one more for each uniqueness rule."""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F


class Audit(NamedTuple):
    name: str
    columns: tuple[str, ...]
    limit: object = None
    blocking: bool = True


def number_of_rows(threshold: int, blocking: bool = True) -> Audit:
    return Audit("number_of_rows", (), threshold, blocking)


def unique_values(*columns: str, blocking: bool = True) -> Audit:
    return Audit("unique_values", columns, None, blocking)


def not_empty_string(*columns: str, blocking: bool = True) -> Audit:
    return Audit("not_empty_string", columns, None, blocking)


def accepted_values(column: str, values: Iterable, blocking: bool = True) -> Audit:
    return Audit("accepted_values", (column,), tuple(values), blocking)


def _failures(a: Audit, column: str) -> Column:
    c = F.col(column)
    return F.count_if(c == "" if a.name == "not_empty_string" else ~c.isin(*a.limit))


def audited(df: DataFrame, audits: list[Audit]) -> DataFrame:
    """``audit, column, failures, blocking``: how many rows fail each audit (for a row count, rows short of it)."""
    plain = [(a, c) for a in audits if a.name in ("not_empty_string", "accepted_values") for c in a.columns]
    rows = [(a, "") for a in audits if a.name == "number_of_rows"]
    exprs = [_failures(a, c).alias(f"f{i}") for i, (a, c) in enumerate(plain)] + [F.greatest(F.lit(a.limit) - F.count("*"), F.lit(0)).alias(f"f{len(plain) + i}") for i, (a, _) in enumerate(rows)]
    out = None
    if exprs:
        items = [F.struct(F.lit(a.name).alias("audit"), F.lit(c).alias("column"), F.col(f"f{i}").cast("long").alias("failures"), F.lit(a.blocking).alias("blocking")) for i, (a, c) in enumerate(plain + rows)]
        out = df.agg(*exprs).select(F.explode(F.array(*items)).alias("x")).select("x.*")
    for a in audits:
        if a.name == "unique_values":
            for c in a.columns:
                again = df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count("*").alias("n")).where("n > 1").agg(F.count("*").alias("failures"))
                one = again.select(F.lit(a.name).alias("audit"), F.lit(c).alias("column"), "failures", F.lit(a.blocking).alias("blocking"))
                out = one if out is None else out.unionByName(one)
    if out is None:
        return df.sparkSession.createDataFrame([], "audit string, column string, failures long, blocking boolean")
    return out


def enforce(df: DataFrame, audits: list[Audit]) -> DataFrame:
    """``df`` itself, or an error that names the blocking audits it fails."""
    bad = [r for r in audited(df, audits).where("failures > 0 and blocking").collect()]  # a row for each audit
    if bad:
        raise ValueError("; ".join(f"{r['audit']}({r['column']}): {r['failures']}" for r in bad))
    return df
