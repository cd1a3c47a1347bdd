"""Multiple-instance toxicity: sentence scores learned through a noisy-or, and the sentences that offend.

Only documents are labelled.  A document is toxic unless every sentence is clean, so with sentence scores
p_s = sigmoid(b + sum of the weights of words and of word beginnings) the document scores 1 - prod(1 - p_s); the likelihood of the document
labels under that noisy-or trains the weights.  A document is then rejected for its worst sentence alone: many sentences of
the base score, which a noisy-or adds up, say nothing.  The threshold on that sentence's log-odds is calibrated on held-out
labelled documents.

Fitting reads at most ``MAX_LABELLED`` labelled documents (whole texts; those with the smallest hashed ids, one row of each id),
scoring reads every document and every sentence, of texts of any length.

Defined results: NULL, empty and word-less texts score 0 and are kept; a NULL label is no label; where a
``doc_id`` repeats in labels, toxic if any of its labels is, and where it repeats in documents, its smallest text is fitted on and each
row is scored by its own; a score equal to the threshold is kept; without a document of both classes nothing is rejected; an empty
table gives no rows; other columns are carried along unread.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from . import textkit
from .common import ship

MAX_LABELLED, BITS, STEPS, MIN_DOCS, MIN_LIFT, NOISE = 6000, 20, 300, 3, 5.0, 0.02
PREFIXES = (4, 5, 6, 7, 8)  # bytes
_STOP = np.zeros(256, bool)
_STOP[[0, 10, 33, 46, 63]] = True  # end of document, newline, ! . ?
_SPLIT = re.compile(r"[\x00\n!.?]")


class Model(NamedTuple):
    weights: np.ndarray
    bias: float
    threshold: float  # on the log-odds of the document's worst sentence


class Bags(NamedTuple):
    feature: np.ndarray  # of each word, and of each of its beginnings of PREFIXES bytes that more follows
    sentence: np.ndarray  # of each feature, index into the next two
    doc: np.ndarray  # of each sentence
    number: np.ndarray  # of each sentence within its document, counting stops
    docs: int


def bags(texts: list[str]) -> Bags:
    w = textkit.words(texts)
    raw = np.frombuffer(w.buffer, np.uint8)
    stops = np.cumsum(_STOP[raw])
    where = stops[w.starts]
    new = np.diff(where, prepend=-1) != 0
    first = np.flatnonzero(new)
    doc = w.doc[first]
    before = np.where(w.origin[doc] > 0, stops[w.origin[doc] - 1], 0) if len(first) else doc
    sentence = np.cumsum(new) - 1
    hashes, owner = [w.hashes], [sentence]
    for k in PREFIXES:
        longer = w.ends - w.starts > k
        start = w.starts[longer]
        hashes.append(textkit.span_hashes(w.sums, start, start + k) ^ np.uint64(0x5555555555555555))
        owner.append(sentence[longer])
    feature = (np.concatenate(hashes) >> np.uint64(64 - BITS)).astype(np.int64)
    return Bags(feature, np.concatenate(owner), doc, where[first] - before, len(texts))


def log_odds(b: Bags, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """(of each sentence, of the worst sentence of each document); a document without words has -inf."""
    z = np.bincount(b.sentence, model.weights[b.feature], len(b.doc)) + model.bias
    worst = np.full(b.docs, -np.inf)
    np.maximum.at(worst, b.doc, z)
    return z, worst


def _slices(texts: list[str], rows: np.ndarray) -> Iterator[tuple[np.ndarray, Bags]]:
    """(row numbers, bags) of the rows, about a chunk of text at a time."""
    ends = np.cumsum([len(texts[i]) for i in rows]) // textkit.CHUNK_BYTES
    for part in np.split(rows, np.flatnonzero(np.diff(ends)) + 1):
        yield part, bags([texts[i] for i in part])


def fit(texts: list[str], toxic: np.ndarray) -> Model:
    """Noisy-or maximum likelihood by Adam on two thirds, threshold on the rest."""
    toxic = np.asarray(toxic, bool)
    size = 1 << BITS
    if toxic.all() or not toxic.any():
        return Model(np.zeros(size, np.float32), -20.0, np.inf)
    turn = np.zeros(len(texts), int)
    for kind in (toxic, ~toxic):
        turn[kind] = np.arange(kind.sum()) % 3
    train = turn > 0 if len(texts) >= 30 else np.ones(len(texts), bool)
    held = ~train if len(texts) >= 30 else train
    y = toxic[train]
    every, in_bad = np.zeros(size, np.int64), np.zeros(size, np.int64)
    for part, b in _slices(texts, np.flatnonzero(train)):
        seen, _ = textkit.distinct(b.doc[b.sentence] * np.int64(size) + b.feature)
        every += np.bincount(seen % size, minlength=size)
        in_bad += np.bincount(seen[toxic[part][seen // size]] % size, minlength=size)
    bad, good = y.sum(), (~y).sum()
    rate = (every + 0.5) / (len(y) + 1)
    lift = (in_bad / bad - (every - in_bad) / good) / np.sqrt(rate * (1 - rate) * (1 / bad + 1 / good))
    common = (every >= min(MIN_DOCS, max(1, int(bad) // 4))) & (lift > MIN_LIFT)  # kinds of word that mark toxic documents
    kept, owners, n = [], [], 0
    for part, b in _slices(texts, np.flatnonzero(train)):  # only what is common enough is held
        known = common[b.feature]
        kept.append((b.feature[known], b.sentence[known] + sum(map(len, owners))))
        owners.append(b.doc + n)
        n += len(part)
    used, feature = np.unique(np.concatenate([f for f, _ in kept]), return_inverse=True)
    sentence, doc = np.concatenate([s for _, s in kept]), np.concatenate(owners)
    theta = np.zeros(len(used) + 1)
    theta[-1] = -10.0
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    balance = np.where(y, len(y) / (2 * y.sum()), len(y) / (2 * (~y).sum()))
    for step in range(1, STEPS + 1):
        z = np.bincount(sentence, theta[:-1][feature], len(doc)) + theta[-1]
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        miss = np.exp(-np.bincount(doc, np.logaddexp(0, z), n))
        told = NOISE + (1 - 2 * NOISE) * np.where(y, 1 - miss, miss)  # a label is wrong with probability NOISE
        pull = np.where(y, 1, -1) * (1 - 2 * NOISE) * miss / told * balance
        dz = pull[doc] * p
        grad = np.append(np.bincount(feature, dz[sentence], len(used)), dz.sum()) / len(y) - 1e-5 * np.append(theta[:-1], 0)
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        theta += 0.2 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    weights = np.zeros(size, np.float32)
    weights[used] = theta[:-1]
    model = Model(weights, float(theta[-1]), 0.0)
    score = np.clip(np.concatenate([log_odds(b, model)[1] for _, b in _slices(texts, np.flatnonzero(held))]), -1e3, 1e3)
    return model._replace(threshold=threshold(score, toxic[held]))


def threshold(score: np.ndarray, toxic: np.ndarray) -> float:
    """The cut with the fewest errors, a clean document rejected counting twice; the middle of equally good ones."""
    order = np.argsort(score, kind="stable")
    s, y = score[order], toxic[order]
    missed = np.concatenate([[0], np.cumsum(y)])
    wrong = np.concatenate([np.cumsum((~y)[::-1])[::-1], [0]])
    edge = np.concatenate([[s[0] - 1], (s[1:] + s[:-1]) / 2, [s[-1] + 1]])
    cost = missed + 2.0 * wrong
    best = np.flatnonzero(cost == cost.min())
    return float(edge[best[len(best) // 2]])


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Model:
    """Fit on the labelled documents with the ``max_labelled`` smallest hashed ids."""
    ids = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    ids = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    got = docs.select("doc_id", "text").where("text is not null").join(F.broadcast(ids), "doc_id")
    got = got.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic")).orderBy("doc_id").toArrow()  # max_labelled rows at most
    return fit(got["text"].to_pylist(), got["toxic"].to_numpy() > 0)


def offending(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """A row for each offending sentence of each rejected document:
    ``doc_id, toxicity, sentence_no, sentence_score, char_start, sentence``; clean documents have none.

    A sentence offends if its own log-odds pass the threshold; the worst always does.
    """
    ship(docs.sparkSession)
    model = train(docs, labels, max_labelled)

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in textkit.chunks(batches):
            b = bags(texts)
            z, odds = log_odds(b, model)
            rows: list[tuple] = []
            for d in np.flatnonzero(odds > model.threshold):
                mine = np.flatnonzero(b.doc == d)
                parts = _SPLIT.split(texts[d])
                at = np.cumsum([0] + [len(x) + 1 for x in parts])
                for s in mine[(z[mine] > model.threshold) | (mine == mine[np.argmax(z[mine])])]:
                    k = int(b.number[s])
                    rows.append((part.column(0)[int(d)].as_py(), 1 / (1 + np.exp(-odds[d])), k, 1 / (1 + np.exp(-z[s])), int(at[k]), parts[k]))
            kinds = [pa.int64(), pa.float64(), pa.int64(), pa.float64(), pa.int64(), pa.string()]
            names = ["doc_id", "toxicity", "sentence_no", "sentence_score", "char_start", "sentence"]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names)

    out = "doc_id long, toxicity double, sentence_no long, sentence_score double, char_start long, sentence string"
    return docs.select("doc_id", "text").where("text is not null").mapInArrow(locate, out)


def clean(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """The documents that are not rejected, all columns as they came."""
    ship(docs.sparkSession)
    model = train(docs, labels, max_labelled)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in textkit.chunks(batches):
            yield part.filter(pc.less_equal(pa.array(log_odds(bags(texts), model)[1]), pa.scalar(model.threshold)))

    return docs.mapInArrow(keep, docs.schema)
