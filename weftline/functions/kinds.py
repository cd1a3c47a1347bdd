"""Work types: registry vocabularies mapped to one, by literal maps that Catalyst folds."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, functions as F

#: index type -> general resource types; where none are listed, the type's own name in capitalised words is the only one
_INDEX: dict[str, str] = {
    "ARTICLE": "JournalArticle ConferencePaper", "AUDIO_VISUAL": "Film Audiovisual", "SOFTWARE": "Software ComputationalNotebook",
    "PHYSICAL_OBJECT": "PhysicalObject Instrument", "OTHER": "Other StudyRegistration Project Journal ConferenceProceeding Award",
} | {k: "" for k in "WORKFLOW TEXT STANDARD SOUND SERVICE REPORT PREPRINT PEER_REVIEW OUTPUT_MANAGEMENT_PLAN MODEL INTERACTIVE_RESOURCE IMAGE EVENT DISSERTATION DATASET DATA_PAPER COLLECTION BOOK_CHAPTER BOOK".split()}
INDEX_TYPES: dict[str, str] = {
    old: new for new, names in _INDEX.items() for old in (names.split() or ["".join(w.capitalize() for w in new.split("_"))])
} | {"List of nomenclatural and taxonomic changes for the New Zealand flora.": "OTHER"}
_ARTICLE_REGISTRY = {
    "article": "posted-content proceedings-article journal-article", "book": "monograph reference-book edited-book book",
    "book-chapter": "book-part book-section book-chapter",
} | {k: k for k in "standard report reference-entry peer-review dissertation dataset".split()}
ARTICLE_TYPES = {old: new for new, names in _ARTICLE_REGISTRY.items() for old in names.split()}
_NOT_MATCHED = {"StudyRegistration", "Project", "Journal", "ConferenceProceeding", "Award"}
DATASET_TYPES = {old: new.lower().replace("_", "-") for old, new in INDEX_TYPES.items() if old not in _NOT_MATCHED}


def lookup(c: Column, table: dict[str, str], default: str | None = "other") -> Column:
    """The table's value; ``default`` for others, NULL for NULL."""
    value = F.try_element_at(F.create_map(*[F.lit(x) for x in chain.from_iterable(table.items())]), c)
    return F.when(c.isNotNull(), F.coalesce(value, F.lit(default)))


def index_type(c: Column) -> Column:
    """A dotted, hyphenated or spaced type as UPPER_SNAKE; OTHER for NULL."""
    return F.coalesce(F.upper(F.replace(c, F.lit("-"), F.lit("_"))), F.lit("OTHER"))
