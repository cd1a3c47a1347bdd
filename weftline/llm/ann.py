"""Approximate nearest neighbours: one vantage-point tree per shard, triangle-inequality pruning relaxed by a factor.

Vectors are compared by Euclidean distance after scaling to length 1 (the order of cosine similarity).  A tree node
keeps the distance ranges of its children from its vantage point; a query at distance d skips a child whose range lies
beyond d by more than ``factor`` times its k-th best distance so far.  ``factor=1`` is exact search; less visits fewer nodes.

Rows go down a routing tree of vantage points to a leaf (a few distances a row, whatever the number of leaves); the tree is
cut at medians of a sample of about ``SAMPLE`` numbers, which affects balance alone and bounds what the driver holds.  A leaf over
``shard`` rows is divided among several shards by hash, so that a hot cell, even of equal vectors, needs no single task.
Every row is indexed.  Queries are the rows whose id is divisible by ``every``.  The sample gives each an upper bound of its
k-th distance; it visits its own leaf, whatever the bound, and the shards of leaves that the relaxed bound cannot exclude.  Queries meet shards in blocks: a task
holds one shard and at most about ``BLOCK`` queries.  Leaf distances are matrix products.

Defined results: rows with a NULL id, a NULL, empty or zero vector, a NULL component or one not finite as a 32-bit float, or another
dimension than most vectors are not read; ties go to the smaller id; rows repeating an id are separate rows, as queries and as
neighbours, but no id neighbours itself; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from .common import ship, stored

K, FACTOR, EVERY = 10, 0.5, 100
SHARD, SAMPLE, BLOCK, LEAF, BATCH = 1 << 23, 1 << 21, 1 << 22, 1024, 1024  # the first three in numbers: rows times dimension
_NONE = np.iinfo(np.int64).max


class Tree:
    """A vantage-point tree over the rows of ``x``; a node is its rows, or (vantage point, [(least, most, child)])."""

    def __init__(self, x: np.ndarray, leaf: int = LEAF, seed: int = 3):
        self.x, self.leaf, self.rng = x, leaf, np.random.default_rng(seed)
        self.root = self.build(np.arange(len(x)))

    def build(self, rows: np.ndarray):
        if len(rows) <= self.leaf:
            return rows
        v = self.x[rows[self.rng.integers(len(rows))]]
        d = apart(self.x[rows], v[None])[:, 0]
        inner = d <= np.median(d)
        if inner.all():
            inner = d < d.max()
        if not inner.any():
            return rows
        return (v, [(float(d[s].min()), float(d[s].max()), self.build(rows[s])) for s in (inner, ~inner)])


def apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of all rows of ``a`` to all rows of ``b``, both of length 1."""
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (a @ b.T)))


class Nearest:
    """The k best (distance, id) of each query so far, none beyond ``reach``; a query never takes its own id."""

    def __init__(self, q: np.ndarray, ids: np.ndarray, k: int, reach: np.ndarray | None = None):
        self.q, self.q32, self.ids, self.k = q, q.astype(np.float32), ids, k
        self.d = np.repeat((np.full(len(q), np.inf) if reach is None else reach)[:, None], k, axis=1)
        self.id = np.full((len(q), k), _NONE)
        self.looked = 0

    def offer(self, rows: np.ndarray, x: np.ndarray, x32: np.ndarray, ids: np.ndarray) -> None:
        """Hold the queries ``rows`` against points in the order of their ids."""
        for i in range(0, len(rows), BATCH):
            r = rows[i : i + BATCH]
            self.looked += len(r) * len(ids)
            alike = self.q32[r] @ x32.T
            low, high = np.searchsorted(ids, self.ids[r], "left"), np.searchsorted(ids, self.ids[r], "right")
            for j in np.flatnonzero(high > low):
                alike[j, low[j] : high[j]] = -2
            near = alike >= (1 - np.minimum(self.d[r, -1] + 1e-3, 2.001) ** 2 / 2)[:, None]
            if len(ids) > 4 * self.k:  # far from the k best of this leaf
                near &= alike >= (np.partition(alike, len(ids) - 4 * self.k, axis=1)[:, len(ids) - 4 * self.k] - 1e-5)[:, None]
            at, of = np.nonzero(near)
            if not len(at):
                continue
            d = np.round(np.sqrt(np.maximum(0.0, 2.0 - 2.0 * np.einsum("ij,ij->i", self.q[r[at]], x[of]))), 6)
            some, at = np.unique(at, return_inverse=True)
            some = r[some]
            row = np.concatenate([np.repeat(np.arange(len(some)), self.k), at])
            dist = np.concatenate([self.d[some].ravel(), d])
            who = np.concatenate([self.id[some].ravel(), ids[of]])
            order = np.lexsort((who, dist, row))
            first = np.searchsorted(row[order], np.arange(len(some)))
            take = order[first[:, None] + np.arange(self.k)]
            self.d[some], self.id[some] = dist[take], who[take]

    def search(self, tree: Tree, ids: np.ndarray, factor: float) -> None:
        x32 = tree.x.astype(np.float32)
        stack = [(tree.root, np.arange(len(self.q)), np.zeros(len(self.q)))]
        while stack:
            node, rows, bound = stack.pop()
            keep = bound <= factor * self.d[rows, -1] + 2e-6
            rows = rows[keep]
            if not len(rows):
                continue
            if isinstance(node, np.ndarray):
                self.offer(rows, tree.x[node], x32[node], ids[node])
                continue
            v, children = node
            d = apart(self.q[rows], v[None])[:, 0]
            bounds = [np.maximum(np.maximum(lo - d, d - hi), bound[keep]) for lo, hi, _ in children]
            near = bounds[0] <= bounds[1]
            for first in (False, True):  # the nearer child is popped first
                for c in (0, 1):
                    side = near if (c == 0) == first else ~near
                    if side.any():
                        stack.append((children[c][2], rows[side], bounds[c][side]))


class Routes(NamedTuple):
    """The routing tree, node by node: vantage point, cut, and the children (a leaf as -1 - its number)."""

    pivots: np.ndarray
    cuts: np.ndarray
    inner: np.ndarray
    outer: np.ndarray
    leaves: int
    above: list[list[int]]  # nodes above each leaf


def build_routes(x: np.ndarray, leaves: int) -> Routes:
    """Cut the sample at medians until there are ``leaves`` of it, or nothing to tell apart."""
    pivots, cuts, kids, above = [], [], [], []

    def grow(rows: np.ndarray, n: int, path: list[int]) -> int:
        if n > 1 and len(rows) > 1:
            d = apart(x[rows], x[rows[len(rows) // 2]][None])[:, 0]
            inner = d <= np.quantile(d, (n // 2) / n)
            if inner.all():
                inner = d < d.max()
            if inner.any():
                at = len(cuts)
                pivots.append(x[rows[len(rows) // 2]])
                cuts.append(d[inner].max())
                kids.append([0, 0])
                kids[at] = [grow(rows[inner], n // 2, [*path, at]), grow(rows[~inner], n - n // 2, [*path, at])]
                return at
        above.append(path)
        return -len(above)

    grow(np.arange(len(x)), leaves, [])
    kids = np.array(kids, np.int64).reshape(-1, 2)
    return Routes(np.array(pivots).reshape(len(cuts), x.shape[1]), np.array(cuts), kids[:, 0], kids[:, 1], len(above), above)


def leaf_of(routes: Routes, x: np.ndarray) -> np.ndarray:
    at = np.zeros(len(x), np.int64) if len(routes.cuts) else np.full(len(x), -1)
    while (going := np.flatnonzero(at >= 0)).size:
        node = at[going]
        d = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * np.einsum("ij,ij->i", x[going], routes.pivots[node])))
        at[going] = np.where(d <= routes.cuts[node], routes.inner[node], routes.outer[node])
    return -1 - at


def _unit(column: pd.Series) -> np.ndarray:
    x = np.stack(column.to_numpy()).astype(np.float64)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def neighbours(vectors: DataFrame, k: int = K, factor: float = FACTOR, every: int = 1, shard: int | None = None, block: int | None = None, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id, rank, neighbour_id, distance``: the k nearest rows of every query (fewer if there are fewer).

    ``shard`` and ``block`` are in rows; unless given they follow from ``SHARD`` and ``BLOCK``.
    """
    spark = vectors.sparkSession
    ship(spark)
    value = F.transform(vector, lambda x: x.cast("float"))
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), value.alias("v")).where("id is not null and size(v) > 0")
    rows = rows.where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0))
    sizes = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if sizes is None:
        return spark.createDataFrame([], "query_id long, rank int, neighbour_id long, distance double")
    dim, total = sizes
    rows = rows.where(F.size("v") == dim)
    shard, block = shard or max(1, SHARD // dim), block or max(1, BLOCK // dim)
    share = SAMPLE / dim / total
    sample = (rows.sample(share, 7) if share < 1 else rows).toArrow().to_pandas().sort_values("id", ignore_index=True)  # about SAMPLE numbers at most
    known = _unit(sample["v"]) if len(sample) else np.zeros((0, dim))
    known_ids = sample["id"].to_numpy(np.int64)
    least = min(spark.sparkContext.defaultParallelism, -(-total // (4 * LEAF)))  # work for every core
    size = min(shard, -(-total // least))
    routes = build_routes(known, min(-(-total // size), max(1, len(known) // 8)))
    depth = max(map(len, routes.above))

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            x = _unit(pdf["v"])
            leaf = leaf_of(routes, x)
            path = np.full((len(x), depth), np.nan)
            for number in np.unique(leaf):
                mine = np.flatnonzero(leaf == number)
                path[mine, : len(routes.above[number])] = apart(x[mine], routes.pivots[routes.above[number]])
            yield pdf.assign(leaf=leaf, path=list(path))

    placed = stored(rows.mapInPandas(place, "id long, v array<float>, leaf int, path array<double>").withColumn("key", F.monotonically_increasing_id()))
    asks = F.col("id") % every == 0
    ranges = [f(F.get("path", F.lit(i))).alias(f"{n}{i}") for i in range(depth) for n, f in (("lo", F.min), ("hi", F.max))]
    stats = placed.groupBy("leaf").agg(F.count("*").alias("n"), F.count(F.when(asks, 1)).alias("asked"), *ranges).orderBy("leaf").toArrow().to_pandas()  # a row for each leaf
    rows_of = {int(r.leaf): int(r.n) for r in stats.itertuples()}
    shards = {int(r.leaf): -(-int(r.n) // size) for r in stats.itertuples()}
    blocks, used, n_block = {}, 0, 0  # leaf -> (first block, blocks); small leaves share one
    for r in stats.itertuples():
        parts = max(1, -(-int(r.asked) // block))
        if parts > 1 or used + r.asked > block:
            n_block, used = n_block + 1, 0
        blocks[int(r.leaf)] = (n_block, parts)
        n_block, used = n_block + parts - 1, used + r.asked if parts == 1 else block

    def visit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            x, ids = _unit(pdf["v"]), pdf["id"].to_numpy(np.int64)
            rough = Nearest(x, ids, k)
            rough.offer(np.arange(len(x)), known, known.astype(np.float32), known_ids)
            kth = rough.d[:, -1]
            first, parts = (np.array([blocks[leaf][i] for leaf in pdf["leaf"]]) for i in (0, 1))
            mine = first + pdf["key"].to_numpy(np.int64) % parts
            to_pivot = apart(x, routes.pivots)
            few = np.array([rows_of[leaf] <= k for leaf in pdf["leaf"]])  # too few at home: look everywhere
            for r in stats.itertuples():
                bound = np.zeros(len(x))
                for i, node in enumerate(routes.above[int(r.leaf)]):
                    d = to_pivot[:, node]
                    bound = np.maximum(bound, np.maximum(getattr(r, f"lo{i}") - d, d - getattr(r, f"hi{i}")))
                go = np.flatnonzero((bound <= factor * kth + 2e-6) | (pdf["leaf"].to_numpy() == r.leaf) | few)
                reach = np.where((pdf["leaf"].to_numpy()[go] == r.leaf) | few[go], np.inf, kth[go])  # so that pruning leaves k of them
                for part in range(shards[int(r.leaf)]):
                    yield pd.DataFrame({"leaf": int(r.leaf), "part": part, "block": mine[go], "key": pdf["key"].to_numpy()[go], "id": ids[go], "v": pdf["v"].to_numpy()[go], "kth": reach})

    def meet(key, points: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(points) or not len(queries):
            return pd.DataFrame({"key": [], "query_id": [], "neighbour_id": [], "distance": []})
        points = points.sort_values(["id", "key"], ignore_index=True)
        found = Nearest(_unit(queries["v"]), queries["id"].to_numpy(np.int64), k, queries["kth"].to_numpy() + 1.5e-6)
        found.search(Tree(_unit(points["v"])), points["id"].to_numpy(np.int64), factor)
        real = found.id < _NONE
        at, _ = np.nonzero(real)
        return pd.DataFrame({"key": queries["key"].to_numpy()[at], "query_id": queries["id"].to_numpy()[at], "neighbour_id": found.id[real], "distance": found.d[real]})

    visits = stored(placed.where(asks).select("id", "v", "leaf", "key").mapInPandas(visit, "leaf int, part int, block int, key long, id long, v array<float>, kth double"))
    parts = F.broadcast(spark.createDataFrame(sorted(shards.items()), "leaf int, parts int"))  # a row for each leaf, of which a sample makes at most an eighth of its rows
    points = placed.join(parts, "leaf").select("id", "v", "leaf", "key", F.pmod(F.xxhash64("key"), "parts").cast("int").alias("part"))
    pairs = visits.select(F.col("leaf").alias("l"), F.col("part").alias("p"), F.col("block").alias("b")).distinct()
    points = points.join(pairs, (F.col("leaf") == F.col("l")) & (F.col("part") == F.col("p"))).select("id", "v", "key", "leaf", "part", F.col("b").alias("block"))
    by = ["leaf", "part", "block"]
    found = points.groupBy(*by).cogroup(visits.groupBy(*by)).applyInPandas(meet, "key long, query_id long, neighbour_id long, distance double")
    rank = Window.partitionBy("key").orderBy("distance", "neighbour_id")
    return found.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k).select("query_id", "rank", "neighbour_id", "distance")
