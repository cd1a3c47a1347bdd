"""Vectorised text kernels: words, sentences and hashes straight from UTF-8 bytes.

A word is a maximal run of ASCII letters, digits, ``_`` and non-ASCII characters of the lower-cased text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
_P = 0x9E3779B97F4A7C15  # odd, so that its powers can be inverted modulo 2**64
_WORD = np.zeros(256, bool)
for _c in b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_":
    _WORD[_c] = True
_WORD[128:] = True
_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """First ``n`` powers of the multiplier and of its inverse, modulo 2**64."""
    if len(_powers.get("up", ())) < n:
        size = max(n, 2 * CHUNK_BYTES)
        for name, base in (("up", _P), ("down", pow(_P, -1, 1 << 64))):
            step = np.full(size, base, np.uint64)
            step[0] = 1
            _powers[name] = np.multiply.accumulate(step)
    return _powers["up"][:n], _powers["down"][:n]


class Words(NamedTuple):
    buffer: bytes
    starts: np.ndarray
    ends: np.ndarray
    doc: np.ndarray  # of each word, 0-based within the chunk
    hashes: np.ndarray  # uint64
    origin: np.ndarray  # byte at which each document starts, and the end of the last
    sums: np.ndarray


def join(encoded: list[bytes], gap: bytes = b"\0") -> tuple[bytes, np.ndarray]:
    """The texts in one buffer, and where each starts (one entry more than texts)."""
    sizes = np.fromiter((len(b) + len(gap) for b in encoded), np.int64, len(encoded))
    return gap.join([*encoded, b""]), np.concatenate([[0], np.cumsum(sizes)])


def prefix_sums(raw: np.ndarray) -> np.ndarray:
    """Running sums from which the hash of any span follows."""
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * powers(len(raw) + 1)[0][: len(raw)], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Position-independent 64-bit polynomial hash of each byte span."""
    h = (sums[ends] - sums[starts]) * powers(len(sums))[1][starts]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def words(texts: list[str]) -> Words:
    """All words of the texts, lower-cased."""
    buffer, origin = join([t.lower().encode("utf-8", "surrogatepass") for t in texts])
    raw = np.frombuffer(buffer, np.uint8)
    inside = np.zeros(len(raw) + 2, np.int8)
    inside[1:-1] = _WORD[raw]
    turn = np.diff(inside)
    starts, ends = np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)
    doc = np.searchsorted(origin, starts, "right") - 1
    sums = prefix_sums(raw)
    return Words(buffer, starts, ends, doc, span_hashes(sums, starts, ends), origin, sums)


class Digests:
    """MD5 of words as big-endian uint64 pairs; remembers up to ``most`` of them so that common words are hashed once."""

    def __init__(self, most: int = 1 << 19):
        self.most, self.known, self.pairs = most, np.zeros(0, np.uint64), np.zeros((0, 2), np.uint64)

    def __call__(self, w: Words) -> tuple[np.ndarray, np.ndarray]:
        """(digest of each distinct word, each word's index among them)."""
        order = np.argsort(w.hashes)
        ranked = w.hashes[order]
        new = np.concatenate([[True], ranked[1:] != ranked[:-1]])
        index = np.empty(len(order), np.int64)
        index[order] = np.cumsum(new) - 1
        distinct, first = ranked[new], order[new]
        at = np.searchsorted(self.known, distinct)
        hit = at < len(self.known)
        hit[hit] = self.known[at[hit]] == distinct[hit]
        out = np.empty((len(distinct), 2), np.uint64)
        out[hit] = self.pairs[at[hit]]
        miss = np.flatnonzero(~hit)
        md5, buffer = hashlib.md5, w.buffer
        raw = b"".join([md5(buffer[s:e]).digest() for s, e in zip(w.starts[first[miss]].tolist(), w.ends[first[miss]].tolist())])
        out[miss] = np.frombuffer(raw, ">u8").reshape(-1, 2)
        if len(self.known) + len(miss) <= self.most:
            known = np.concatenate([self.known, distinct[miss]])
            order = np.argsort(known)
            self.known, self.pairs = known[order], np.concatenate([self.pairs, out[miss]])[order]
        return out, index


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct keys, how often each occurs)."""
    keys = np.sort(keys)
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[at], np.diff(np.append(at, len(keys)))


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of the batches whose texts total about ``most`` characters (one text at least); NULL reads as ''."""
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(column)).to_pylist()
        begin = total = 0
        for i, t in enumerate(texts):
            total += len(t or "")
            if total >= most or i + 1 == len(texts):
                yield batch.slice(begin, i + 1 - begin), [x or "" for x in texts[begin : i + 1]]
                begin, total = i + 1, 0


def bit_counts(values: np.ndarray, group: np.ndarray, groups: int) -> np.ndarray:
    """How many of each group's values have each bit (big-endian) set; ``group`` ascends.

    Eight one-byte counters ride in a machine word over runs of at most 255 values.
    """
    out = np.zeros((groups, 64), np.int64)
    if not len(values):
        return out
    lanes = np.unpackbits(values.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).view(np.uint64)
    begin = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    size = np.diff(np.append(begin, len(group)))
    runs = -(-size // 255)
    first = np.cumsum(runs) - runs
    nth = np.arange(runs.sum()) - np.repeat(first, runs)
    small = np.add.reduceat(lanes, np.repeat(begin, runs) + 255 * nth, axis=0).view(np.uint8).reshape(-1, 64)
    out[group[begin]] = np.add.reduceat(small.astype(np.int64), first, axis=0)
    return out


def sign_bits(values: np.ndarray, weights: np.ndarray | None, group: np.ndarray, groups: int) -> np.ndarray:
    """One SimHash for each group: a bit is set where the weights of values with that bit exceed those without."""
    total = np.bincount(group, weights, groups) if weights is not None else np.bincount(group, minlength=groups)
    if weights is None:
        ones = bit_counts(values, group, groups)
    else:
        ones = np.zeros((groups, 64), np.int64)
        for w in np.unique(weights).tolist():
            mine = weights == w
            ones += w * bit_counts(values[mine], group[mine], groups)
    return np.packbits(2 * ones > total[:, None], axis=1).view(">u8").ravel().astype(np.uint64)
