"""Sequence packing: best fit, then a swap-based local search over underfull bins.

Every document becomes pieces of at most ``capacity`` tokens (words between whitespace unless a token column is
named); the last piece of each is packed by best fit decreasing.  The search then moves a piece, exchanges one for
one or two for one between underfull bins, always raising the sum of squared fills, until no bin can be emptied or
the bin count reaches the lower bound ceil(tokens / capacity).

Shards of about ``shard_docs`` documents (by a hash of id, tokens, text and copy, so that neither a NULL nor a repeated id fills one
shard) are packed independently: their number grows with the data, and each loses at most part of a bin.  In training order
(:func:`pack_in_order`) shards are consecutive windows of the rows instead, bins are numbered in that order, and no bin
holds two pieces of equal ``doc_id`` (:func:`separate`).

Defined results: a row for every piece of every input row, repeated rows and NULL ids included; NULL and empty
texts count 0 tokens and ride along in a bin; a text of more than ``capacity`` tokens fills bins of its own and packs the rest; among
equal sizes the smaller id (first row) comes first; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import bisect

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from .common import ship, stored

CAPACITY, SHARD_DOCS = 2048, 16384
WINDOW_DOCS, LEAST_WINDOWS = 1024, 32  # of a window in training order; windows of a small table
SCHEMA = "doc_id long, piece int, tokens int, bin long, at int"


def best_fit(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Best fit decreasing: each bin as a list of item indices; ties by index."""
    bins: list[list[int]] = []
    room: list[tuple[int, int]] = []  # (free, bin), sorted
    for i in np.lexsort((np.arange(len(sizes)), -sizes)).tolist():
        size = int(sizes[i])
        k = bisect.bisect_left(room, (size, -1))
        if k == len(room):
            bins.append([i])
            bisect.insort(room, (capacity - size, len(bins) - 1))
        else:
            free, b = room.pop(k)
            bins[b].append(i)
            bisect.insort(room, (free - size, b))
    return bins


def improve(sizes: np.ndarray, bins: list[list[int]], capacity: int) -> list[list[int]]:
    """Empty bins by moves and swaps that each raise the sum of squared fills."""
    if not bins:
        return bins
    bins = [list(b) for b in bins]
    fill = np.array([sizes[b].sum() for b in bins], np.int64)
    least = max(1, -(-int(sizes.sum()) // capacity))
    home = np.empty(len(sizes), np.int64)
    for b, items in enumerate(bins):
        home[items] = b
    alive = len(bins)
    while alive > least:
        best = None
        open_bins = np.flatnonzero((fill < capacity) & (fill > 0))
        items = np.flatnonzero(np.isin(home, open_bins))
        order = open_bins[np.lexsort((open_bins, fill[open_bins]))]
        for donor in order.tolist():
            mine = np.array(sorted(bins[donor]), np.int64)
            others = items[home[items] != donor]
            into = open_bins[open_bins != donor]
            if not len(into):
                continue
            singles = mine[sizes[mine] > 0]
            packs: list[tuple[int, ...]] = [(int(x),) for x in singles]
            _, nth = np.unique(sizes[singles], return_index=True)
            _, again = np.unique(np.delete(sizes[singles], nth), return_index=True)
            two = np.sort(np.concatenate([singles[nth], np.delete(singles, nth)[again]]))  # the first two of each size make every sum
            pairs: dict[int, tuple[int, ...]] = {}
            for i, x in enumerate(two):
                for y in two[i + 1 :]:
                    pairs.setdefault(int(sizes[x] + sizes[y]), (int(x), int(y)))
            packs += pairs.values()
            top, act = 0, None
            gap_b, fill_b = capacity - fill[into], fill[into]
            gap_o, fill_o, size_o = capacity - fill[home[others]], fill[home[others]], sizes[others]
            for pack in packs:
                s = int(sizes[list(pack)].sum())
                if len(pack) == 1:
                    gain = np.where(s <= gap_b, 2 * s * (fill_b - fill[donor] + s), 0)
                    k = int(gain.argmax())
                    if gain[k] > top:
                        top, act = int(gain[k]), (pack, None, int(into[k]))
                if len(others):
                    d = s - size_o
                    gain = np.where((d > 0) & (d <= gap_o), 2 * d * (fill_o - fill[donor] + d), 0)
                    k = int(gain.argmax())
                    if gain[k] > top:
                        top, act = int(gain[k]), (pack, int(others[k]), int(home[others[k]]))
            if act:
                best = (donor, *act)
                break
        if best is None:
            break
        donor, pack, back, target = best
        for x in pack:
            bins[donor].remove(x)
            bins[target].append(x)
            home[x] = target
        if back is not None:
            bins[target].remove(back)
            bins[donor].append(back)
            home[back] = donor
        fill[donor], fill[target] = sizes[bins[donor]].sum(), sizes[bins[target]].sum()
        if fill[donor] == 0:
            bins[target] += bins[donor]  # items of size 0
            home[bins[donor]] = target
            bins[donor] = []
            alive -= 1
    return [b for b in bins if b]


def separate(sizes: np.ndarray, bins: list[list[int]], keys: list, capacity: int) -> list[list[int]]:
    """Take apart items of equal key (None is no key) in a bin: into the fullest bin with room, by an exchange, or into a new bin."""
    bins = [list(b) for b in bins]
    held = [{keys[i] for i in b} for b in bins]
    fill = [int(sizes[b].sum()) for b in bins]
    for b in range(len(bins)):
        seen: set = set()
        for x in list(bins[b]):
            key, size = keys[x], int(sizes[x])
            if key is None or key not in seen:
                seen.add(key)
                continue
            free = [c for c in range(len(bins)) if key not in held[c]]
            fits = [c for c in free if fill[c] + size <= capacity]
            back = None
            if fits:
                c = max(fits, key=lambda c: (fill[c], -c))
            else:
                swaps = [(abs(int(sizes[y]) - size), c, y) for c in free for y in bins[c] if fill[c] - sizes[y] + size <= capacity and fill[b] - size + sizes[y] <= capacity and (keys[y] is None or keys[y] not in held[b])]
                if swaps:
                    _, c, back = min(swaps)
                else:
                    c = len(bins)
                    bins.append([])
                    held.append(set())
                    fill.append(0)
            bins[b].remove(x)
            bins[c].append(x)
            held[c].add(key)
            fill[b] -= size
            fill[c] += size
            if back is not None:
                bins[c].remove(back)
                bins[b].append(back)
                if keys[back] is not None:
                    if not any(keys[i] == keys[back] for i in bins[c]):
                        held[c].discard(keys[back])
                    held[b].add(keys[back])
                    seen.add(keys[back])
                fill[c] -= int(sizes[back])
                fill[b] += int(sizes[back])
    return bins


def pack_shard(tokens: np.ndarray, capacity: int, keys: list | None = None) -> pd.DataFrame:
    """``row, piece, tokens, bin, at`` of every piece; rows must come in a defined order; equal ``keys`` share no bin."""
    whole = np.maximum(tokens - 1, 0) // capacity
    rest = tokens - whole * capacity
    bins = improve(rest, best_fit(rest, capacity), capacity)
    if keys is not None:
        bins = separate(rest, bins, keys, capacity)
    row = [np.repeat(np.arange(len(tokens)), whole)]
    piece = [np.arange(whole.sum()) - np.repeat(np.cumsum(whole) - whole, whole)]
    count = [np.full(whole.sum(), capacity)]
    bin_, at = [np.arange(whole.sum())], [np.zeros(whole.sum(), int)]
    for k, items in enumerate(bins):
        items = np.array(sorted(items))
        row.append(items)
        piece.append(whole[items])
        count.append(rest[items])
        bin_.append(np.full(len(items), whole.sum() + k))
        at.append(np.cumsum(rest[items]) - rest[items])
    cat = lambda x: np.concatenate(x).astype(np.int64)
    return pd.DataFrame({"row": cat(row), "piece": cat(piece), "tokens": cat(count), "bin": cat(bin_), "at": cat(at)})


def pack(docs: DataFrame, capacity: int = CAPACITY, shard_docs: int = SHARD_DOCS, tokens: str | None = None) -> DataFrame:
    """``doc_id, piece, tokens, bin, at``: the bin of every piece and its offset there; ids and counts alone are shuffled."""
    if capacity < 1:
        raise ValueError("capacity must be positive")
    ship(docs.sparkSession)
    count = F.col(tokens) if tokens else F.regexp_count("text", F.lit(r"\S+"))
    shards = max(1, -(-docs.count() // shard_docs))
    same = docs.select("doc_id", F.coalesce(count, F.lit(0)).cast("int").alias("tokens"), F.xxhash64("text").alias("h") if tokens is None else F.lit(0).alias("h"))
    same = same.groupBy("doc_id", "tokens", "h").agg(F.count("*").cast("int").alias("n")).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n"))))
    slim = same.select("doc_id", "tokens", F.pmod(F.xxhash64("doc_id", "tokens", "h", "copy"), F.lit(shards)).alias("shard"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "tokens"], ignore_index=True)
        out = pack_shard(pdf["tokens"].to_numpy(np.int64), capacity)
        out["doc_id"] = pdf["doc_id"].astype("Int64").iloc[out["row"]].array
        out["bin"] += int(pdf["shard"].iloc[0]) << 32
        return out[["doc_id", "piece", "tokens", "bin", "at"]]

    return slim.groupBy("shard").applyInPandas(run, SCHEMA)


def pack_in_order(docs: DataFrame, capacity: int = CAPACITY, window_docs: int = WINDOW_DOCS) -> DataFrame:
    """As :func:`pack`, over windows of consecutive rows: a bin holds rows of one window, and bin numbers ascend with the order.

    ``position`` is the number of the row in the order, ``epoch`` how many rows of its ``doc_id`` come before (0 for a NULL id).
    The order is that of the rows: where ``docs`` is read from files, by file name and row, as a sorted table is written.
    """
    if capacity < 1:
        raise ValueError("capacity must be positive")
    ship(docs.sparkSession)
    count = F.coalesce(F.regexp_count("text", F.lit(r"\S+")), F.lit(0)).cast("int").alias("tokens")
    if docs._jdf.queryExecution().analyzed().getClass().getSimpleName() == "LogicalRelation":  # splits are read in another order than written
        slim = docs.select("doc_id", count, F.col("_metadata.file_path").alias("part"), F.col("_metadata.row_index").alias("row"))
    else:
        slim = docs.select("doc_id", count, F.monotonically_increasing_id().alias("id"))
        slim = slim.select("doc_id", "tokens", F.lpad(F.shiftright("id", 33).cast("string"), 10, "0").alias("part"), F.col("id").bitwiseAND((1 << 33) - 1).alias("row"))
    slim = stored(slim)
    parts = slim.groupBy("part").agg((F.max("row") + 1).alias("n"))  # a row for each file
    parts = parts.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    size = max(1, min(window_docs, -(-slim.count() // LEAST_WINDOWS)))
    placed = slim.join(parts, "part").select("doc_id", "tokens", (F.col("base") + F.col("row")).alias("nth"))
    earlier = Window.partitionBy("doc_id", F.when(F.col("doc_id").isNull(), F.col("nth"))).orderBy("nth")
    placed = placed.select("doc_id", "tokens", "nth", (F.row_number().over(earlier) - 1).alias("epoch"), F.floor(F.col("nth") / size).alias("window"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("nth", ignore_index=True)
        ids = pdf["doc_id"].astype("Int64")
        out = pack_shard(pdf["tokens"].to_numpy(np.int64), capacity, [None if pd.isna(i) else i for i in ids])
        middle = out["row"].groupby(out["bin"]).mean().sort_values(kind="stable")
        out["bin"] = out["bin"].map(pd.Series(np.arange(len(middle)), middle.index)) + (int(pdf["window"].iloc[0]) << 32)
        out["doc_id"], out["position"], out["epoch"] = ids.iloc[out["row"]].array, pdf["nth"].iloc[out["row"]].array, pdf["epoch"].iloc[out["row"]].array
        return out[["doc_id", "piece", "tokens", "bin", "at", "position", "epoch"]]

    return placed.groupBy("window").applyInPandas(run, SCHEMA + ", position long, epoch int")
