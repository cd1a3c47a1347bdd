"""LM scoring by masked pseudo-likelihood: a bidirectional window network predicts every token from both sides.

Tokens are words (see textkit), counted over the whole corpus in ``2**COUNT_BITS`` word-hash buckets, which fill as the corpus
grows.  The ``VOCAB - RARE - 1`` most frequent buckets are classes of their own; the others are ordered by frequency and cut into ``RARE``
classes of about the same number of tokens, and class 0 stands before and after a document.  The network embeds the
``SIDE`` classes on each side by position, adds them, takes tanh and a softmax over the classes; its output bias starts at the log of the
corpus frequencies.  The log-probability of a token is that of its class plus the log of its bucket's share of the class.

Training reads every token position of every document (``rate`` below 1 takes a share of them, chosen by hash).  Documents are cut into
pieces of at most ``PIECE`` tokens with their context, which are divided by a hash into shards of about ``SHARD`` positions, whatever the
partitions of the table.  Each of ``ROUNDS`` rounds runs Adagrad over every position of every shard from common weights and averages the
results weighted by positions, added up in a tree of groups of ``FAN``.  The last round also judges every position, just before it trains on
it, with each weight of the context in the softmax, where 0 is the frequencies alone; the best one over all positions is kept.  Scoring
reads every token of every document.

Defined results: NULL, empty and word-less texts have 0 tokens, log-likelihood 0 and a NULL mean; rows keep their ids,
NULL and repeated ones included; a long text is one document of as many windows as tokens; extra columns are not read; an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import textkit
from .common import ship, stored

VOCAB, RARE, HIDDEN, SIDE, COUNT_BITS = 512, 64, 16, 2, 22
RATE, ROUNDS, STEP, BATCH, SHARD, FAN, PIECE = 1, 2, 0.1, 512, 1 << 19, 32, 1 << 12
MIXES = (0.0, 0.25, 0.5, 0.75, 1.0)  # weights of the context to choose from, evenly spaced
_OFFSETS = [*range(-SIDE, 0), *range(1, SIDE + 1)]


class Net(NamedTuple):
    token: np.ndarray  # class of each word-hash bucket
    share: np.ndarray  # log of each bucket's share of its class
    embed: np.ndarray  # 2 * SIDE, VOCAB, HIDDEN
    hidden: np.ndarray
    out: np.ndarray  # HIDDEN, VOCAB
    bias: np.ndarray


def buckets(w: textkit.Words) -> np.ndarray:
    return (w.hashes >> np.uint64(64 - COUNT_BITS)).astype(np.int64)


def vocabulary(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Class of each bucket, the most frequent first (ties to the smaller bucket), and the log of its share of the class."""
    own = VOCAB - RARE - 1
    order = np.argsort(-counts, kind="stable")
    rest = counts[order[own:]] + 0.5  # a bucket never seen has a share too
    mass = np.cumsum(rest)
    token = np.empty(len(counts), np.int16)
    token[order[:own]] = 1 + np.arange(own)
    token[order[own:]] = VOCAB - RARE + np.minimum((mass - rest / 2) * RARE // mass[-1], RARE - 1).astype(np.int64)
    seen = np.bincount(token, counts + 0.5, VOCAB)
    return token, np.log((counts + 0.5) / seen[token]).astype(np.float32)


def start(counts: np.ndarray, seed: int = 1) -> Net:
    (token, share), rng = vocabulary(counts), np.random.default_rng(seed)
    seen = np.bincount(token, counts + 0.5, VOCAB)
    seen[0] = 1e-3
    embed = rng.normal(0, 0.1, (2 * SIDE, VOCAB, HIDDEN)).astype(np.float32)
    return Net(token, share, embed, np.zeros(HIDDEN, np.float32), np.zeros((HIDDEN, VOCAB), np.float32), np.log(seen / seen.sum()).astype(np.float32))


def lay_out(w: textkit.Words, token: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(tokens with SIDE zeros around each document, where each word stands)."""
    at = np.arange(len(w.doc)) + SIDE * (w.doc + 1)
    line = np.zeros(len(w.doc) + SIDE * (len(w.origin) + 1), np.int64)
    line[at] = token[buckets(w)]
    return line, at


def forward(net: Net, line: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Hidden layer at the given places of a line."""
    h = net.hidden + net.embed[0][line[at + _OFFSETS[0]]]
    for k in range(1, 2 * SIDE):
        h += net.embed[k][line[at + _OFFSETS[k]]]
    return np.tanh(h, out=h)


def log_probabilities(net: Net, line: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Log-probability of the class at each place given those around it."""
    out, ones, weights = np.empty(len(at)), np.ones(VOCAB, np.float32), np.concatenate([net.out, net.bias[None]])
    for i in range(0, len(at), 512):
        here = at[i : i + 512]
        h = np.ones((len(here), HIDDEN + 1), np.float32)
        h[:, :-1] = forward(net, line, here)
        z = h @ weights
        said = z[np.arange(len(here)), line[here]]
        e, top = exponentials(z, weights)
        out[i : i + 512] = said - top - np.log(e @ ones)
    return out


def exponentials(z: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray | float]:
    """(exp(z - top), top) of ``z = h @ weights``, |h| <= 1, in place; nothing is taken off unless the weights let a row overflow or vanish."""
    spread = np.abs(weights[:-1]).sum(0)
    if (weights[-1] + spread).max() < 80 and (weights[-1] - spread).max() > -80:
        return np.exp(z, out=z), 0.0
    top = z.max(1)
    z -= top[:, None]
    return np.exp(z, out=z), top


def judged(h: np.ndarray, weights: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(exp(h @ weights) up to a factor for each row, summed log-probability of ``y`` with each of ``MIXES``)."""
    rows, out, bias, steps = np.arange(len(y)), weights[:-1], weights[-1], len(MIXES) - 1
    gains = np.empty(len(MIXES))
    if np.abs(out).sum(0).max() < 60 and np.abs(bias).max() < 60:
        part = h[:, :-1] @ (out / steps)
        said, base = part[rows, y].sum(dtype=float), bias[y].sum(dtype=float)
        share = np.exp(bias)
        root = np.exp(part, out=part)
        e = root.copy()  # the powers of one exponential are those of all weights of the context
        gains[0] = base - len(y) * np.log(share.sum(dtype=float))
        for i in range(1, steps + 1):
            if i > 1:
                e *= root
            gains[i] = i * said + base - np.log(e @ share).sum(dtype=float)
        e *= share
        return e, gains
    for i, a in enumerate(MIXES):
        mixed = np.concatenate([out * np.float32(a), bias[None]])
        z = h @ mixed
        said = z[rows, y].sum(dtype=float)
        e, top = exponentials(z, mixed)
        gains[i] = said - (top + np.log(e.sum(1, dtype=float))).sum()
    return e, gains


def gradient(flat: np.ndarray, line: np.ndarray, at: np.ndarray, judge: bool) -> tuple[np.ndarray, np.ndarray]:
    """(mean gradient of the loss at places of a line, gains of ``MIXES`` if asked for) of all parameters end to end."""
    n, cut = len(at), (2 * SIDE * VOCAB + 1) * HIDDEN
    embed, weights = flat[:cut].reshape(-1, HIDDEN), flat[cut:].reshape(HIDDEN + 1, VOCAB)
    y, ctx = line[at], np.stack([line[at + o] + k * VOCAB for k, o in enumerate(_OFFSETS)])
    h = np.ones((n, HIDDEN + 1), np.float32)
    np.tanh(embed[ctx].sum(0) + embed[-1], out=h[:, :-1])
    if judge:
        p, gains = judged(h, weights, y)
    else:
        p, gains = exponentials(h @ weights, weights)[0], np.zeros(len(MIXES))
    total = p @ np.ones(VOCAB, np.float32)
    p[np.arange(n), y] -= total
    scale = (1 / (n * total))[:, None]
    dh = (p @ weights[:-1].T) * scale
    dh *= 1 - h[:, :-1] ** 2
    to = (ctx[..., None] * HIDDEN + np.arange(HIDDEN)).ravel()
    g_embed = np.bincount(to, np.broadcast_to(dh, (2 * SIDE, n, HIDDEN)).ravel(), cut - HIDDEN)
    g_weights = (p.T @ (h * scale)).T
    return np.concatenate([g_embed, dh.sum(0), g_weights.ravel()], dtype=np.float32, casting="same_kind"), gains


def count_buckets(docs: DataFrame) -> np.ndarray:
    """Occurrences of each word-hash bucket over the whole corpus; at most ``2**COUNT_BITS`` rows reach the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << COUNT_BITS, np.int64)
        for _, texts in textkit.chunks(batches):
            some, n = textkit.distinct(buckets(textkit.words(texts)))
            total[some] += n
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    got = docs.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(1 << COUNT_BITS, np.int64)
    counts[got["bucket"].to_numpy()] = got["n"].to_numpy()
    return counts


def chosen(w: textkit.Words, rate: float) -> np.ndarray:
    """Positions to train on: a hash of the word and its place in the document below ``rate``."""
    first = np.searchsorted(w.doc, w.doc)
    h = (w.hashes ^ (np.arange(len(w.doc)) - first).astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
    return np.flatnonzero((h >> np.uint64(32)) < np.uint64(int(rate * (1 << 32))))


def training_lines(docs: DataFrame, token: np.ndarray, rate: float = RATE) -> DataFrame:
    """``x``: classes of a piece of a document as little-endian int16, ``VOCAB`` more where a token is only context; ``n``: the others."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in textkit.chunks(batches, "text"):
            w = textkit.words(texts)
            line, at = lay_out(w, token)
            context = (line + VOCAB).astype("<i2")
            some = context.copy()
            some[at[chosen(w, rate)]] -= VOCAB
            first = np.searchsorted(w.doc, np.arange(len(texts) + 1))
            doc, no, n, x = [], [], [], []
            for d in np.flatnonzero(np.diff(first)).tolist():
                begin, end = int(at[first[d]]), int(at[first[d + 1] - 1]) + 1
                for i, a in enumerate(range(begin, end, PIECE)):
                    b = min(a + PIECE, end)
                    mine = int((some[a:b] < VOCAB).sum())
                    if mine:
                        doc.append(d)
                        no.append(i)
                        n.append(mine)
                        x.append(b"".join([context[a - SIDE : a].tobytes(), some[a:b].tobytes(), context[b : b + SIDE].tobytes()]))
            yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(doc, pa.int64())), pa.array(no, pa.int64()), pa.array(n, pa.int64()), pa.array(x, pa.binary())], ["doc_id", "piece", "n", "x"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, "doc_id long, piece long, n long, x binary")


_SUM = "shard long, n long, w binary"


def _added(parts: DataFrame, shards: int) -> np.ndarray | None:
    """Sum over all rows of the vectors ``w`` (64-bit floats), by a tree of groups, divided by the sum of ``n``."""

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("shard")
        return pd.DataFrame({"shard": pdf["shard"].iloc[:1], "n": [pdf["n"].sum()], "w": [sum(np.frombuffer(w) for w in pdf["w"]).tobytes()]})

    while shards > FAN:
        parts = parts.withColumn("shard", F.floor(F.col("shard") / FAN)).groupBy("shard").applyInPandas(add, _SUM)
        shards = -(-shards // FAN)
    got = parts.orderBy("shard").collect()  # FAN rows at most
    return sum(np.frombuffer(r["w"]) for r in got) / sum(r["n"] for r in got) if got else None


def _unpacked(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(the pieces of a shard end to end, in an order of their own, the places to train on)."""
    line = np.frombuffer(b"".join(sorted(pdf["x"])), "<i2").astype(np.int64)
    at = np.flatnonzero(line < VOCAB)
    return line % VOCAB, at


def _trainer(start: np.ndarray, round_: int, judge: bool) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Adagrad over every place of a shard, from the parameters ``start``; their sum and the gains of ``MIXES``."""

    def local(pdf: pd.DataFrame) -> pd.DataFrame:
        flat, seen, gains, shard = start.copy(), np.full_like(start, 1e-8), np.zeros(len(MIXES)), int(pdf["shard"].iloc[0])
        line, at = _unpacked(pdf)
        at = at[np.random.default_rng([round_, shard]).permutation(len(at))]
        for i in range(0, len(at), BATCH):
            g, gained = gradient(flat, line, at[i : i + BATCH], judge)
            gains += gained
            seen += g * g
            flat -= np.float32(STEP) * g / (np.sqrt(seen) + np.float32(1e-6))
        return pd.DataFrame({"shard": [shard], "n": [len(at)], "w": [np.concatenate([flat * np.float64(len(at)), gains]).tobytes()]})

    return local


def fit(docs: DataFrame, rate: float = RATE, rounds: int = ROUNDS) -> Net:
    """Count, choose the classes, train by averaged rounds over every position, and weigh the context."""
    ship(docs.sparkSession)
    net = start(count_buckets(docs))
    lines = stored(training_lines(docs, net.token, rate))
    total = lines.agg(F.sum("n")).first()[0] or 0
    if not total:
        return net
    shards = -(-total // SHARD)
    # by id and place too, so that the copies of a text spread
    lines = lines.select(F.pmod(F.xxhash64("doc_id", "piece", "x"), F.lit(shards)).alias("shard"), "x")
    flat, gains = np.concatenate([p.ravel() for p in net[2:]]), np.zeros(len(MIXES))
    for round_ in range(rounds):
        got = _added(lines.groupBy("shard").applyInPandas(_trainer(flat, round_, round_ + 1 == rounds), _SUM), shards)
        flat, gains = got[: len(flat)].astype(np.float32), got[len(flat) :]
    parts = np.split(flat, np.cumsum([p.size for p in net[2:]])[:-1])
    net = Net(net.token, net.share, *[p.reshape(q.shape).copy() for p, q in zip(parts, net[2:])])
    return net._replace(out=net.out * np.float32(MIXES[int(np.argmax(gains))])) if np.isfinite(gains).all() else net


def score_texts(texts: list[str], net: Net) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, summed log-probability) of each text."""
    w = textkit.words(texts)
    line, at = lay_out(w, net.token)
    logp = log_probabilities(net, line, at) + net.share[buckets(w)]
    return np.bincount(w.doc, minlength=len(texts)), np.bincount(w.doc, logp, len(texts))


def scores(docs: DataFrame, net: Net | None = None, **options) -> DataFrame:
    """``doc_id, n_tokens, log_likelihood, mean_log_probability`` of every document."""
    ship(docs.sparkSession)
    net = net or fit(docs, **options)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in textkit.chunks(batches):
            n, total = score_texts(texts, net)
            mean = pa.array(total / np.maximum(n, 1), mask=n == 0)
            yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.int64()), pa.array(n.astype(np.int64)), pa.array(total.astype(float)), mean], ["doc_id", "n_tokens", "log_likelihood", "mean_log_probability"])

    return docs.select("doc_id", "text").mapInArrow(score, "doc_id long, n_tokens long, log_likelihood double, mean_log_probability double")
