"""Substring dedup by content-defined chunks: a gear rolling hash cuts, digests match.

``h(i) = sum(GEAR[byte(i-k)] << k, k < 16)`` modulo 2**32 marks a candidate cut after byte i where its top
``BITS`` bits are zero.  A candidate cuts if the candidate before it lies at least ``MIN_GAP`` bytes back, so each
cut depends only on bytes just before it (a text begins with a candidate): an insertion moves later chunks without changing them.  Chunks over
``MAX_CHUNK`` bytes are divided.  Cuts fall between characters.

The unit that is deduplicated is the fewest whole chunks from each cut on that make ``MIN_PASSAGE`` characters, by a 96-bit digest
of their bytes.  It repeats if a document of a smaller ``doc_id`` has one of the same digest; its first occurrence is that of the
smallest (doc_id, position).  Units of one document that overlap or touch, and whose first occurrences lie in one document at the
same distance, form one passage; so a passage is, character for character, a substring of its first document, up to a chunk short at its
start and up to two (under ``MIN_PASSAGE`` characters of whole chunks) at its end.

Defined results: NULL and empty texts, and texts under ``MIN_PASSAGE`` characters, have no units; rows that repeat a ``doc_id`` are one
document (its texts lie on top of each other); a NULL ``doc_id`` is ignored; a passage that several documents had before goes to the
smallest of them, so spans with different first documents may overlap; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from . import textkit
from .common import ship, stored

BITS, MIN_GAP, MAX_CHUNK, MIN_PASSAGE = 4, 16, 256, 100
GEAR = np.random.default_rng(0x6EA7).integers(0, 1 << 32, 256, np.uint32)
GEAR[0] = 0
_GAP = b"\0" * 16


def chunk_spans(texts: list[str]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(buffer, document, byte start, byte end, character start, character end) of every chunk, in order."""
    buffer, origin = textkit.join([t.encode("utf-8", "surrogatepass") for t in texts], _GAP)
    raw = np.frombuffer(buffer, np.uint8)
    begin, end = origin[:-1], origin[1:] - len(_GAP)
    h = GEAR[raw]
    for k in (1, 2, 4, 8):
        h[k:] += h[:-k] << np.uint32(k)
    follows = np.zeros(len(raw), bool)
    follows[:-1] = (raw[1:] & 0xC0) == 0x80
    cut = np.flatnonzero(((h >> np.uint32(32 - BITS)) == 0) & ~follows) + 1
    cut = cut[np.diff(cut, prepend=0) >= MIN_GAP]  # each text begins with a candidate: the gap before it hashes to 0
    doc = np.searchsorted(begin, cut, "left") - 1
    cut = cut[(cut > begin[doc]) & (cut < end[doc])] if len(cut) else cut
    some = end > begin
    edges = np.unique(np.concatenate([cut, begin[some], end[some]]))
    doc = np.searchsorted(begin, edges, "right") - 1
    last = edges == end[doc]
    starts, ends, doc = edges[~last], edges[np.flatnonzero(~last) + 1] if len(edges) else edges, doc[~last]
    parts = -(-(ends - starts) // MAX_CHUNK)
    if (parts > 1).any():
        nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        stop = np.repeat(ends, parts)
        starts, doc = np.repeat(starts, parts) + nth * MAX_CHUNK, np.repeat(doc, parts)
        for _ in range(3):  # to the start of a character
            starts = starts + ((raw[starts] & 0xC0) == 0x80)
        ends = np.where(np.append(doc[1:] == doc[:-1], False) & (np.append(starts[1:], 0) < stop), np.append(starts[1:], 0), stop)
        fine = ends > starts
        starts, ends, doc = starts[fine], ends[fine], doc[fine]
    chars = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    base = chars[begin[doc]] if len(doc) else starts
    return buffer, doc, starts, ends, chars[starts] - base, chars[ends] - base


def units(texts: list[str], least: int = MIN_PASSAGE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, character start, character end, 16-byte digests) of every unit, in order."""
    buffer, doc, starts, ends, c0, c1 = chunk_spans(texts)
    line = doc.astype(np.int64) << 33  # character ends in one ascending row
    last = np.searchsorted(c1 + line, c0 + line + least)
    whole = last < len(doc)
    whole[whole] = doc[last[whole]] == doc[whole]
    at, last = np.flatnonzero(whole), last[whole]
    digest = xxhash.xxh3_128_digest
    raw = b"".join([digest(buffer[s:e]) for s, e in zip(starts[at].tolist(), ends[last].tolist())])
    return doc[at], c0[at], c1[last], np.frombuffer(raw, np.uint8).reshape(-1, 16)


def unit_table(docs: DataFrame, least: int = MIN_PASSAGE) -> DataFrame:
    """``doc_id, c0, c1, d1, d2``: every unit, as a character span, with its digest."""
    ship(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in textkit.chunks(batches):
            doc, c0, c1, d = units(texts, least)
            ids = part.column(0).cast(pa.int64()).take(pa.array(doc))
            digests = [pa.array(d[:, :8].copy().view(np.int64).ravel()), pa.array(d[:, 8:12].copy().view(np.int32).ravel())]
            yield pa.RecordBatch.from_arrays([ids, pa.array(c0.astype(np.int32)), pa.array(c1.astype(np.int32)), *digests], ["doc_id", "c0", "c1", "d1", "d2"])

    return docs.select("doc_id", "text").where("doc_id is not null and text is not null").mapInArrow(cut, "doc_id long, c0 int, c1 int, d1 long, d2 int")


def repeats(docs: DataFrame, min_passage: int = MIN_PASSAGE) -> DataFrame:
    """``doc_id, char_start, char_end, first_doc_id, first_start``: a row for each passage that a smaller ``doc_id`` has already.

    The digests are aggregated with map-side combining (a unit in a million documents is one row from each
    task); only digests of two documents or more are joined back, so unrepeated units end at that join.
    """
    found = stored(unit_table(docs, min_passage))
    first = F.min(F.struct("doc_id", "c0")).alias("first")
    shared = found.groupBy("d1", "d2").agg(first, F.max("doc_id").alias("m")).where("first.doc_id < m").select("d1", "d2", F.col("first.doc_id").alias("first_doc_id"), F.col("first.c0").alias("f0"))
    again = found.join(shared, ["d1", "d2"]).where("doc_id > first_doc_id").withColumn("off", F.col("c0") - F.col("f0"))
    along = Window.partitionBy("doc_id", "first_doc_id", "off").orderBy("c0", "c1")
    before = F.max("c1").over(along.rowsBetween(Window.unboundedPreceding, -1))
    runs = again.withColumn("new", F.when(F.col("c0") <= before, 0).otherwise(1))
    runs = runs.withColumn("run", F.sum("new").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    got = runs.groupBy("doc_id", "first_doc_id", "off", "run").agg(F.min("c0").alias("char_start"), F.max("c1").alias("char_end"))
    return got.select("doc_id", "char_start", "char_end", "first_doc_id", (F.col("char_start") - F.col("off")).alias("first_start"))


def without_repeats(docs: DataFrame, min_passage: int = MIN_PASSAGE) -> DataFrame:
    """The documents with repeated passages cut out of ``text`` (their first occurrences stay); columns as they came."""
    spans = repeats(docs, min_passage).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("char_start", "char_end"))).alias("__spans"))
    cut = F.expr("aggregate(__spans, named_struct('at', 0, 'text', ''), (acc, s) -> named_struct('at', greatest(acc.at, s.char_end), 'text', concat(acc.text, substring(text, acc.at + 1, greatest(s.char_start - acc.at, 0)))), acc -> concat(acc.text, substring(text, acc.at + 1)))")
    return docs.join(spans, "doc_id", "left").withColumn("text", F.when(F.col("__spans").isNull(), F.col("text")).otherwise(cut)).select(*docs.columns)
