"""All registered queries of the engine and the SQL that states the same results."""

from __future__ import annotations

from . import cleaning, indexing, matching, registry, reporting, serving, values  # noqa: F401  (they register themselves)
from .base import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
