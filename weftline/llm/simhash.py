"""SimHash near-duplicates found exactly with vantage-point trees over Hamming distance.

Two documents are near copies when

* their 64-bit word fingerprints (weight ``round(16*sqrt(tf))``) differ in at most ``radius`` bits,
* their 128-bit fingerprints over distinct word pairs differ in at most ``pair_radius`` bits, and
* the smaller word count is at least ``RATIO`` of the larger.

Groups are the connected components of that relation; the smallest ``doc_id`` of a group is its keeper.

At 9 of 64 bits nearly every fingerprint lies within reach of each border, so vantage points on whole fingerprints prune little.  The
fingerprint is therefore cut into ``BLOCKS`` blocks: a close pair differs in at most ``radius // BLOCKS`` bits (one) of some block.
For each block, vantage-point trees over the block's values prune by that small radius, both between shards (a row also
queries shards whose border it overlaps) and, over the distinct values, inside one; only rows of values that meet are compared whole.
A shard of too many rows is divided by salts, every two of which meet in one task.
All pairs that satisfy the rule count, none is capped; only the edges handed on are thinned to a spanning
forest, which has the same components.

Defined results: NULL, empty and word-less texts have no fingerprint and never match; rows that repeat a
``doc_id`` belong to one document of that id; a NULL ``doc_id`` is ignored; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import textkit
from .common import ship, stored

RADIUS, PAIR_RADIUS, RATIO = 9, 30, 0.8
SHARD, LEAF, BLOCKS = 65536, 512, 5
PIVOT_SAMPLE, MAX_LEAVES = 1 << 18, 1024  # rows from which the routing trees are built; leaves of one tree (a block has 8192 values)
_EDGES = [round(64 * i / BLOCKS) for i in range(BLOCKS + 1)]
_PRINT = "doc_id long, n long, u long, b1 long, b2 long"


def fingerprints(texts: list[str], digests: textkit.Digests | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(word count, word fingerprint, two halves of the pair fingerprint) of every text."""
    w = textkit.words(texts)
    k = len(texts)
    n = np.bincount(w.doc, minlength=k)
    if not len(w.doc):
        zero = np.zeros(k, np.uint64)
        return n, zero, zero, zero
    md5, index = (digests or textkit.Digests())(w)
    m = np.int64(len(md5))
    seen, tf = textkit.distinct(w.doc * m + index)
    weight = np.rint(16 * np.sqrt(tf)).astype(np.int64)
    u = textkit.sign_bits(md5[seen % m, 0], weight, seen // m, k)
    same = w.doc[1:] == w.doc[:-1]
    pairs, _ = textkit.distinct(((w.doc[1:] * m + index[:-1]) * m + index[1:])[same])
    doc, rest = np.divmod(pairs, m * m)
    a, b = np.divmod(rest, m)
    b1 = textkit.sign_bits(md5[a, 0] ^ md5[b, 1], None, doc, k)
    b2 = textkit.sign_bits(md5[a, 1] ^ md5[b, 0], None, doc, k)
    return n, u, b1, b2


def _print_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    digests = textkit.Digests()
    for part, texts in textkit.chunks(batches):
        n, u, b1, b2 = fingerprints(texts, digests)
        cols = [part.column(0).cast(pa.int64()), *(pa.array(x.view(np.int64)) for x in (n.astype(np.int64), u, b1, b2))]
        yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n", "u", "b1", "b2"]).filter(pa.array(n > 0))


def fingerprint_table(docs: DataFrame) -> DataFrame:
    """``doc_id, n, u, b1, b2`` of every document with a word, as signed 64-bit integers."""
    ship(docs.sparkSession)
    return docs.select("doc_id", "text").where("doc_id is not null and text is not null").mapInArrow(_print_batches, _PRINT)


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b)


class Forest:
    """Collects matching pairs and thins them to star edges of the same components."""

    def __init__(self, size: int):
        self.label, self.held, self.waiting = np.arange(size), 0, []

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        if len(a):
            self.waiting.append((a, b))
            self.held += len(a)
            if self.held > 1 << 20:
                self.settle()

    def settle(self) -> None:
        if not self.waiting:
            return
        a, b = (np.concatenate(x) for x in zip(*self.waiting))
        self.waiting, self.held, label = [], 0, self.label
        while True:
            x, y = label[a], label[b]
            low, high = np.minimum(x, y), np.maximum(x, y)
            keep = low < high
            if not keep.any():
                break
            a, b = a[keep], b[keep]
            np.minimum.at(label, high[keep], low[keep])
            while (label[label] != label).any():
                label[:] = label[label]
        label[:] = label[label]


def block(u: np.ndarray, t: int) -> np.ndarray:
    """Block ``t`` of each fingerprint."""
    return (u >> np.uint64(_EDGES[t])) & np.uint64((1 << (_EDGES[t + 1] - _EDGES[t])) - 1)


def close_values(v: np.ndarray, radius: int, leaf: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """Indices (i <= j) of all values that differ in at most ``radius`` bits, by a vantage-point tree over them."""
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    stack = [(np.arange(len(v)), np.arange(len(v)))]
    while stack:
        q, a = stack.pop()
        if not len(q) or not len(a):
            continue
        d = distance(v[a], v[a[len(a) // 2]]).astype(np.int16)
        inner = Search.cut(d) if len(a) > leaf else None
        if inner is None:
            i, j = np.nonzero(distance(v[q, None], v[a][None]) <= radius)
            up = q[i] <= a[j]
            left.append(q[i[up]])
            right.append(a[j[up]])
            continue
        dq = distance(v[q], v[a[len(a) // 2]]).astype(np.int16)
        for side in (inner, ~inner):
            stack.append((q[(dq >= d[side].min() - radius) & (dq <= d[side].max() + radius)], a[side]))
    return np.concatenate(left), np.concatenate(right)


class Search:
    """Exact pair search in one shard with a vantage-point tree; ``prints`` has columns u, b1, b2, n."""

    def __init__(self, u, b1, b2, n, radius: int, pair_radius: int, ratio: float):
        self.u, self.b1, self.b2, self.n = u, b1, b2, n
        self.radius, self.pair_radius, self.ratio = radius, pair_radius, ratio
        self.found = Forest(len(u))
        self.compared = 0

    def confirm(self, a: np.ndarray, b: np.ndarray) -> None:
        two = a != b
        if not two.any():
            return
        a, b = a[two], b[two]
        d = distance(self.b1[a], self.b1[b]) + distance(self.b2[a], self.b2[b])
        low, high = np.minimum(self.n[a], self.n[b]), np.maximum(self.n[a], self.n[b])
        ok = (d <= self.pair_radius) & (low >= self.ratio * high)
        self.found.add(a[ok], b[ok])

    def cross(self, a: np.ndarray, b: np.ndarray, same: bool = False) -> None:
        """All pairs of rows a with rows b (of a with itself if same), in blocks."""
        ub = self.u[b]
        step = max(1, (1 << 18) // max(1, len(b)))
        self.compared += len(a) * len(b)
        for i in range(0, len(a), step):
            rows, cols = np.nonzero(np.bitwise_count(self.u[a[i : i + step], None] ^ ub[None, :]) <= self.radius)
            if same:
                up = cols > rows + i
                rows, cols = rows[up], cols[up]
            if len(rows):
                self.confirm(a[rows + i], b[cols])

    def within(self, a: np.ndarray) -> None:
        """Every close pair inside ``a``: pairs across a split are found by the inner side's border looking outward."""
        stack = [a]
        while stack:
            a = stack.pop()
            if len(a) <= LEAF:
                self.cross(a, a, same=True)
                continue
            d = distance(self.u[a], self.u[a[len(a) // 2]]).astype(np.int16)
            inner = self.cut(d)
            if inner is None:
                self.cross(a, a, same=True)
                continue
            edge, side = d[inner].max(), a[~inner]
            near = a[inner][d[inner] >= d[~inner].min() - self.radius]
            self.query(near, side[d[~inner] <= edge + self.radius])
            stack += [a[inner], side]

    @staticmethod
    def cut(d: np.ndarray) -> np.ndarray | None:
        """Split at the median distance; None if all are as far."""
        inner = d <= np.median(d)
        if inner.all():
            inner = d < d.max()
        return inner if inner.any() else None

    def query(self, q: np.ndarray, a: np.ndarray) -> None:
        """Every close pair of a query row with a row of ``a``, by triangle bounds."""
        if len(q) * len(a) <= LEAF * LEAF:
            return self.cross(q, a)
        stack = [(q, a)]
        while stack:
            q, a = stack.pop()
            if not len(q) or not len(a):
                continue
            if len(a) <= LEAF or len(q) <= 8:
                self.cross(q, a)
                continue
            v = self.u[a[len(a) // 2]]
            d, dq = distance(self.u[a], v).astype(np.int16), distance(self.u[q], v).astype(np.int16)
            inner = self.cut(d)
            if inner is None:
                self.cross(q[np.abs(dq - d[0]) <= self.radius], a)
                continue
            for side in (inner, ~inner):
                ds = d[side]
                stack.append((q[(dq >= ds.min() - self.radius) & (dq <= ds.max() + self.radius)], a[side]))


    def by_block(self, t: int, own: np.ndarray, others: np.ndarray) -> None:
        """Every close pair of two own rows, or an own one and another, that is close in block ``t``."""
        v = block(self.u, t)
        values = np.unique(v[np.concatenate([own, others])])
        at = np.searchsorted(values, v[own])
        own, count = own[np.argsort(at, kind="stable")], np.bincount(at, minlength=len(values))
        start = np.cumsum(count) - count
        i, j = close_values(values, self.radius // BLOCKS)
        apart = i != j
        for value, partners in _gathered(i, j, own, start, count):  # its own rows among them
            self.query(own[start[value] : start[value] + count[value]], partners)
        if len(others):
            at = np.searchsorted(values, v[others])
            others, asked = others[np.argsort(at, kind="stable")], np.bincount(at, minlength=len(values))
            ends = np.cumsum(asked)
            both = np.concatenate([i, j[apart]]), np.concatenate([j, i[apart]])
            keep = asked[both[0]] > 0
            for value, partners in _gathered(both[0][keep], both[1][keep], own, start, count):
                self.query(others[ends[value] - asked[value] : ends[value]], partners)


def _gathered(i: np.ndarray, j: np.ndarray, rows: np.ndarray, start: np.ndarray, count: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(value, the rows of all values paired with it); ``rows`` lie value by value."""
    order = np.argsort(i, kind="stable")
    i, j = i[order], j[order]
    n = count[j]
    every = rows[np.repeat(start[j], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
    first = np.flatnonzero(np.diff(i, prepend=-1))
    ends = np.append(np.cumsum(n)[first[1:] - 1], n.sum()) if len(first) else []
    begin = 0
    for value, end in zip(i[first].tolist(), list(ends)):
        if end > begin:
            yield value, every[begin:end]
        begin = end


def build_routes(sample: np.ndarray, leaves: int) -> list:
    """A tree of vantage points that cuts the sample into about ``leaves`` shards: nested [pivot, cut, inner, outer] or None."""
    if leaves <= 1 or len(sample) < 2:
        return []
    v = sample[len(sample) // 2]
    d = distance(sample, v)
    cut = int(np.median(d))
    inner = d <= cut
    if inner.all():
        return []
    return [int(v), cut, build_routes(sample[inner], leaves // 2), build_routes(sample[~inner], leaves - leaves // 2)]


def route(tree: list, u: np.ndarray, radius: int, rows: np.ndarray, own: np.ndarray, out: list, name: str = "0") -> None:
    """Append (shard, rows, own): own rows live in the shard, the others only look for partners in it.

    A border row of the inner side visits the outer side; the converse would find the same pairs again.
    """
    if not len(rows):
        return
    if not tree:
        out.append((name, rows, own))
        return
    v, cut, inner, outer = tree
    d = distance(u[rows], np.uint64(v)).astype(np.int16)
    left = (own & (d <= cut)) | (~own & (d <= cut + radius))
    right_own = own & (d > cut)
    right = right_own | (d > cut - radius)
    route(inner, u, radius, rows[left], own[left], out, name + "0")
    route(outer, u, radius, rows[right], right_own[right], out, name + "1")


def near_edges(prints: DataFrame, radius: int = RADIUS, pair_radius: int = PAIR_RADIUS, ratio: float = RATIO, shard: int = SHARD) -> DataFrame:
    """``a, b`` (a > b): edges of a graph over distinct fingerprints whose components are those of all close pairs.

    ``prints`` is (rep, n, u, b1, b2), one row for each distinct fingerprint.  Word-count bands of ratio ``ratio``
    come first (a row also visits the next band, which no valid pair can skip), then for each band that holds more than
    ``shard`` rows a routing tree for each block; its pivots come from a sample, which affects balance and never results.
    """
    spark = prints.sparkSession
    base = float(-np.log(ratio))
    banded = prints.withColumn("band", F.floor(F.log(F.col("n").cast("double")) / F.lit(base) + F.lit(1e-9)).cast("int"))
    sizes = {r["band"]: r["k"] for r in banded.groupBy("band").agg(F.count("*").alias("k")).collect()}  # a row for each band
    trees: dict[int, list[list]] = {}
    large = {b: min(-(-k // shard), MAX_LEAVES) for b, k in sizes.items() if k > shard}
    if large:
        share = min(1.0, min(64 * sum(large.values()), PIVOT_SAMPLE) / sum(sizes[b] for b in large))
        got = banded.where(F.col("band").isin(list(large))).select("band", "u").sample(share, 7).toArrow().to_pandas()
        for b, g in got.groupby("band"):
            u = g["u"].to_numpy().view(np.uint64)
            trees[b] = [build_routes(np.sort(block(u, t))[np.random.default_rng(7).permutation(len(u))], large[b]) for t in range(BLOCKS)]

    def spread(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            u = pdf["u"].to_numpy().view(np.uint64)
            for shift in (0, 1):
                for band, rows in pdf.groupby(pdf["band"] + shift).indices.items():
                    if shift and band not in sizes:
                        continue
                    mine = np.full(len(rows), shift == 0)
                    if band not in trees:  # one shard, which goes through all blocks
                        yield pdf.iloc[rows].drop(columns="band").assign(shard=str(band), own=mine)
                        continue
                    for t, tree in enumerate(trees[band]):
                        out: list = []
                        route(tree, block(u, t), radius // BLOCKS, rows, mine, out)
                        for name, at, own in out:
                            yield pdf.iloc[at].drop(columns="band").assign(shard=f"{band}/{t}/{name}", own=own)

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rep", kind="stable", ignore_index=True)
        s = Search(*(pdf[c].to_numpy().view(np.uint64) for c in ("u", "b1", "b2")), pdf["n"].to_numpy(), radius, pair_radius, ratio)
        own, parts = pdf["own"].to_numpy(), pdf["shard"].iloc[0].split("/")
        few = len(pdf) <= LEAF
        if few:
            s.within(np.flatnonzero(own))
            s.query(np.flatnonzero(~own), np.flatnonzero(own))
        for t in () if few else range(BLOCKS) if len(parts) == 1 else [int(parts[1])]:
            s.by_block(t, np.flatnonzero(own), np.flatnonzero(~own))
        s.found.settle()
        rep, label = pdf["rep"].to_numpy(), s.found.label
        moved = label != np.arange(len(label))
        return pd.DataFrame({"a": rep[moved], "b": rep[label[moved]]})

    ship(spark)
    routed = stored(banded.mapInPandas(spread, "rep long, n long, u long, b1 long, b2 long, shard string, own boolean"))
    heavy = routed.groupBy("shard").agg(F.count("*").alias("k")).where(F.col("k") > 4 * shard).select("shard", F.ceil(F.col("k") / (2 * shard)).cast("int").alias("salts"))
    salted = routed.join(heavy, "shard", "left").withColumn("salt", F.pmod(F.xxhash64("rep"), "salts").cast("int"))  # NULL where a shard is whole
    others = F.filter(F.sequence(F.lit(0), F.col("salts") - 1), lambda x: x != F.col("salt"))
    meets = F.when(F.col("salts").isNull(), F.array(F.lit(""))).otherwise(F.transform(others, lambda x: F.format_string("%d-%d", F.least(x, "salt"), F.greatest(x, "salt"))))
    cells = salted.select("rep", "n", "u", "b1", "b2", "shard", "own", F.explode(meets).alias("cell"))
    return cells.groupBy("shard", "cell").applyInPandas(search, "a long, b long").where("a > b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root``: each node that has an edge with a smaller one, and the smallest node of its component.

    Alternates large-star and small-star steps, each an aggregation and a join, until stars remain.
    """
    edges = stored(edges.select("a", "b"))
    last = None
    while True:
        both = edges.select(F.col("a").alias("x"), F.col("b").alias("y")).union(edges.select(F.col("b").alias("x"), F.col("a").alias("y")))
        low = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        large = both.where("y > x").join(low, "x").select(F.col("y").alias("a"), F.col("m").alias("b")).where("a > b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*")
        edges = stored(small.where("a > b").distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.count_distinct("a")).first()
        if now == last or now[0] == 0:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        last = now


def groups(docs: DataFrame, radius: int = RADIUS, pair_radius: int = PAIR_RADIUS, ratio: float = RATIO, shard: int = SHARD) -> DataFrame:
    """``doc_id, keep_id``: a row for each document that is a near copy of one kept, never for keepers or clean documents."""
    prints = stored(fingerprint_table(docs))
    same = stored(prints.groupBy("n", "u", "b1", "b2").agg(F.min("doc_id").alias("rep")))
    roots = components(near_edges(same.select("rep", "n", "u", "b1", "b2"), radius, pair_radius, ratio, shard))
    exact = prints.join(same, ["n", "u", "b1", "b2"]).select("doc_id", "rep")
    found = exact.join(roots.withColumnRenamed("node", "rep"), "rep", "left").select("doc_id", F.coalesce("root", "rep").alias("keep_id"))
    return found.where("doc_id <> keep_id").groupBy("doc_id").agg(F.min("keep_id").alias("keep_id"))


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """The documents without the near copies of :func:`groups`; columns as they came."""
    return docs.join(groups(docs, **options).select("doc_id"), "doc_id", "left_anti").select(*docs.columns)
