"""Media columns: local image descriptors find cropped or edited copies.

Corners (Harris, above a response and greatest within ``NEAR`` pixels; all of them, so their number grows with the area) at several scales
of a grey image get an orientation from the intensity centroid around them and a 128-bit descriptor of binary tests turned to that
orientation.  The tests are chosen (:func:`learned_tests`) to be balanced and little correlated over invented pictures, so that
descriptors of unlike corners rarely meet.  Descriptors of two images are joined where they agree in
one of ``TABLES`` bit groups (Hamming tables) and differ in at most ``MAX_BITS`` bits.  Every match proposes a similarity
transform (scale, turn, shift); the best ones are fitted to their matches by least squares, and images are copies if at least
``CONSENSUS`` matches then agree within a tolerance in proportion to the picture.

Images of equal bytes are one class: its smallest id is described and compared for all, and each other is a row beside it.
Images are 8-bit PNG (grey, RGB or with alpha, not interlaced) or binary PGM/PPM bytes.

Defined results: NULL, empty or undecodable bytes match nothing, and images without corners only their equals; a NULL id is ignored;
rows that repeat an id are one image with the corners of all; no image matches itself; of equally good transforms the first proposed
counts; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import ship, stored

SCALES, NEAR, PATCH = (1.0, 1.25, 1.56, 1.95, 2.44), 4, 11  # half width of the descriptor patch
TABLES, TABLE_BITS, MAX_BITS, CONSENSUS, SHIFT, TURN = 5, 25, 18, 6, 4.0, 0.25
REFINED, TOLERANCE, BATCH = 8, 0.012, 24  # transforms fitted again; of the greater side; images described at once
POOL, LEARN_FROM, BALANCE = 3000, 16, 0.15  # tests to choose from, pictures to choose them on


def encode_png(img: np.ndarray) -> bytes:
    """A grey image as PNG."""
    h, w = img.shape
    rows = np.concatenate([np.zeros((h, 1), np.uint8), img.astype(np.uint8)], 1).tobytes()

    def part(kind: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    return b"\x89PNG\r\n\x1a\n" + part(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 0, 0, 0, 0)) + part(b"IDAT", zlib.compress(rows, 1)) + part(b"IEND", b"")


def _png(data: bytes) -> np.ndarray:
    at, body, head = 8, [], None
    while at + 8 <= len(data):
        n, kind = struct.unpack(">I4s", data[at : at + 8])
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", data[at + 8 : at + 21])
        elif kind == b"IDAT":
            body.append(data[at + 8 : at + 8 + n])
        at += 12 + n
    w, h, depth, color, _, _, interlaced = head
    ways = {0: 1, 2: 3, 4: 2, 6: 4}[color]
    if depth != 8 or interlaced:
        raise ValueError("only 8-bit PNG without interlacing")
    raw = np.frombuffer(zlib.decompress(b"".join(body)), np.uint8).reshape(h, 1 + w * ways)
    out, above = np.zeros((h, w * ways), np.uint8), np.zeros(w * ways, np.uint8)
    for y in range(h):
        kind, line = raw[y, 0], raw[y, 1:].copy()
        if kind == 1:
            line = np.cumsum(line.reshape(w, ways), axis=0, dtype=np.uint8).ravel()
        elif kind == 2:
            line += above
        elif kind in (3, 4):
            for i in range(len(line)):
                a, b = (int(line[i - ways]) if i >= ways else 0), int(above[i])
                c = int(above[i - ways]) if i >= ways else 0
                guess = (a + b) // 2 if kind == 3 else min((a, b, c), key=lambda v: (abs(a + b - c - v), (a, b, c).index(v)))
                line[i] = (int(line[i]) + guess) & 255
        out[y] = above = line
    px = out.reshape(h, w, ways).astype(np.float32)
    return px[:, :, :3] @ np.float32([0.299, 0.587, 0.114]) if ways > 2 else px[:, :, 0]


def decode(data: bytes | None) -> np.ndarray | None:
    """Grey levels, or None for what cannot be read."""
    try:
        if data and data[:8] == b"\x89PNG\r\n\x1a\n":
            return _png(data)
        m = re.match(rb"P([56])\s+(\d+)\s+(\d+)\s+255\s", data or b"")
        if m:
            w, h, ways = int(m[2]), int(m[3]), 3 if m[1] == b"6" else 1
            px = np.frombuffer(data, np.uint8, w * h * ways, m.end()).reshape(h, w, ways).astype(np.float32)
            return px @ np.float32([0.299, 0.587, 0.114]) if ways == 3 else px[:, :, 0]
    except (ValueError, KeyError, TypeError, struct.error, zlib.error):
        pass  # bytes of unknown or broken form are data, not a failure of the job
    return None


def resize(img: np.ndarray, factor: float) -> np.ndarray:
    """Bilinear resampling by 1/factor of the last two axes."""
    tall, wide = img.shape[-2:]
    h, w = max(1, int(tall / factor)), max(1, int(wide / factor))
    y, x = np.clip((np.arange(h) + 0.5) * factor - 0.5, 0, tall - 1), np.clip((np.arange(w) + 0.5) * factor - 0.5, 0, wide - 1)
    y0, x0 = np.minimum(y.astype(int), max(0, tall - 2)), np.minimum(x.astype(int), max(0, wide - 2))
    y1, x1 = np.minimum(y0 + 1, tall - 1), np.minimum(x0 + 1, wide - 1)
    fy, fx = (y - y0)[:, None].astype(np.float32), (x - x0)[None].astype(np.float32)
    rows = img[..., y0, :] * (1 - fy) + img[..., y1, :] * fy
    return (rows[..., x0] * (1 - fx) + rows[..., x1] * fx).astype(np.float32)


def _blur(a: np.ndarray, times: int = 1) -> np.ndarray:
    for _ in range(times):
        for axis in (-2, -1):
            p = np.pad(a, [(0, 0)] * (a.ndim - 2) + [(2, 2) if i == axis else (0, 0) for i in (-2, -1)], "edge")
            n = a.shape[axis]
            s = [p[..., k : k + n, :] if axis == -2 else p[..., k : k + n] for k in range(5)]
            a = (s[0] + s[4] + 4 * (s[1] + s[3]) + 6 * s[2]) / np.float32(16)
    return a


_DISC_Y, _DISC_X = np.mgrid[-7:8, -7:8]
_DISC = (_DISC_Y**2 + _DISC_X**2 <= 49).astype(np.float32)


def corners(images: np.ndarray) -> Iterator[tuple[float, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(scale, smoothed pictures, picture, x, y, angle) of the corners of pictures of one size, scale by scale."""
    for scale in SCALES:
        a = _blur(resize(images, scale) if scale != 1 else images.astype(np.float32))
        h, w = a.shape[1:]
        if min(h, w) < 2 * PATCH + 5:
            continue
        gy, gx = np.gradient(a, axis=(1, 2))
        xx, yy, xy = _blur(gx * gx, 2), _blur(gy * gy, 2), _blur(gx * gy, 2)
        r = xx * yy - xy * xy - np.float32(0.05) * (xx + yy) ** 2
        edge = PATCH + 1
        core, top = r[:, edge : h - edge, edge : w - edge], r
        top = np.max([top[:, edge + k : h - edge + k] for k in range(-NEAR, NEAR + 1)], axis=0)
        top = np.max([top[:, :, edge + k : w - edge + k] for k in range(-NEAR, NEAR + 1)], axis=0)
        which, ys, xs = np.nonzero((core >= top) & (core > 1.0))
        if not len(ys):
            continue
        ys, xs = ys + edge, xs + edge
        patch = a[which[:, None, None], ys[:, None, None] + _DISC_Y, xs[:, None, None] + _DISC_X] * _DISC
        angle = np.arctan2((patch * _DISC_Y).sum((1, 2)), (patch * _DISC_X).sum((1, 2)))
        yield scale, _blur(a), which, xs, ys, angle


def tested(smooth: np.ndarray, which: np.ndarray, xs: np.ndarray, ys: np.ndarray, angle: np.ndarray, tests: np.ndarray) -> np.ndarray:
    """Outcome of every test (x1, y1, x2, y2 around the corner, turned by its angle) at every corner."""
    c, s = np.cos(angle)[:, None], np.sin(angle)[:, None]
    value = []
    for k in (0, 2):
        tx, ty = tests[:, k][None], tests[:, k + 1][None]
        px = np.clip(np.rint(xs[:, None] + c * tx - s * ty).astype(int), 0, smooth.shape[2] - 1)
        py = np.clip(np.rint(ys[:, None] + s * tx + c * ty).astype(int), 0, smooth.shape[1] - 1)
        value.append(smooth[which[:, None], py, px])
    return value[0] < value[1]


@functools.cache
def learned_tests(n: int = 128) -> np.ndarray:
    """``n`` of ``POOL`` random tests, those within ``BALANCE`` of even, each as little correlated with those before it as leaves enough."""
    pool = np.clip(np.random.default_rng(0xB41F).normal(0, 5.5, (POOL, 4)), -9, 9)
    x = np.concatenate([tested(*at, pool) for k in range(LEARN_FROM) for _, *at in corners(draw((1 << 40) + k)[None])]).astype(np.float32)
    z = x - x.mean(0)
    z /= np.sqrt((z**2).sum(0)) + 1e-9
    lean = np.abs(x.mean(0) - 0.5)
    order = [j for j in np.argsort(lean, kind="stable") if lean[j] <= BALANCE]
    alike, limit = np.abs(z.T @ z), 0.2
    while True:
        take: list[int] = []
        for j in order:
            if not take or alike[j, take].max() < limit:
                take.append(j)
            if len(take) == n:
                return pool[np.random.default_rng(7).permutation(take)]  # all tables alike
        limit += 0.05


def describe(images: list[np.ndarray], tests: np.ndarray | None = None) -> dict[str, np.ndarray]:
    """``image`` (its number), ``place, hi, lo`` of every corner; a place is x and y in eighths of a pixel (24 bits each), scale (4) and angle (12)."""
    tests = learned_tests() if tests is None else tests
    out = []
    shapes: dict[tuple, list[int]] = {}
    for i, img in enumerate(images):
        shapes.setdefault(img.shape, []).append(i)
    for shape, rows in shapes.items():
        step = max(1, min(BATCH, (1 << 22) // max(1, shape[0] * shape[1])))
        for k in range(0, len(rows), step):
            mine = np.array(rows[k : k + step])
            for scale, smooth, which, xs, ys, angle in corners(np.stack([images[i] for i in mine])):
                bits = np.packbits(tested(smooth, which, xs, ys, angle, tests), axis=1).view(">i8")
                x, y = (np.rint(8 * ((v + 0.5) * scale - 0.5)).clip(0).astype(np.int64) for v in (xs, ys))
                turn = np.rint((angle + np.pi) * (4095 / (2 * np.pi))).astype(np.int64)
                place = x << 40 | y << 16 | SCALES.index(scale) << 12 | turn
                out.append((mine[which], place, bits[:, 0].astype(np.int64), bits[:, 1].astype(np.int64)))
    return {c: np.concatenate([o[i] for o in out]) if out else np.zeros(0, np.int64) for i, c in enumerate(("image", "place", "hi", "lo"))}


def unpacked(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """x, y, scale, angle of places."""
    p = np.asarray(place, np.int64)
    return (p >> 40) / 8, ((p >> 16) & 0xFFFFFF) / 8, np.array(SCALES)[(p >> 12) & 15], (p & 4095) * (2 * np.pi / 4095) - np.pi


_IMAGE = "media_id long, digest binary, place array<long>, hi array<long>, lo array<long>"


def descriptors(media: DataFrame, id_column: str = "media_id", column: str = "image") -> DataFrame:
    """``media_id, digest`` of the bytes, and ``place, hi, lo`` of every corner: a row for each image with bytes."""
    ship(media.sparkSession)
    tests = learned_tests()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, tuple] = {}  # bytes met again need no second description
        for part in _slices(batches):
            data = part.column(1).to_pylist()
            digests = [hashlib.sha256(x).digest() for x in data]
            if len(known) > 4096:
                known.clear()
            new = {d: x for d, x in zip(digests, data) if d not in known}
            read = [(d, img) for d, img in ((d, decode(x)) for d, x in new.items()) if img is not None]
            known |= dict.fromkeys(new, ([], [], []))
            if read:
                found = describe([img for _, img in read], tests)
                order = np.argsort(found["image"], kind="stable")
                ends = np.searchsorted(found["image"][order], np.arange(len(read) + 1))
                for n, (d, _) in enumerate(read):
                    known[d] = tuple(found[c][order[ends[n] : ends[n + 1]]] for c in ("place", "hi", "lo"))
            got = [known[d] for d in digests]
            lists = [pa.array([g[k] for g in got], pa.list_(pa.int64())) for k in range(3)]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(digests, pa.binary()), *lists], ["media_id", "digest", "place", "hi", "lo"])

    slim = media.select(F.col(id_column).cast("long").alias("media_id"), F.col(column).alias("image")).where("media_id is not null and length(image) > 0")
    return slim.mapInArrow(run, _IMAGE)


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 128) -> Iterator[pa.RecordBatch]:
    """A few rows at a time: images are large."""
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)


def consensus(a: np.ndarray, b: np.ndarray) -> tuple[int, float, float, float, float] | None:
    """(matches that agree, scale, turn, dx, dy) of the transform a -> b on which most matches of one pair of images agree."""
    (ax, ay, sa, ta), (bx, by, sb, tb) = unpacked(a), unpacked(b)
    turn, grow = tb - ta, np.log(sb / sa)
    p, q = ax + 1j * ay, bx + 1j * by
    limit = np.maximum(SHIFT, TOLERANCE * max(np.ptp(bx), np.ptp(by)))
    corner = np.unique(np.stack([np.rint(ax), np.rint(ay)], 1), axis=0, return_inverse=True)[1].ravel()  # matches of one corner count once

    def agree(m: np.ndarray, shift: np.ndarray, slack: float) -> tuple[np.ndarray, np.ndarray]:
        far = np.abs(m[:, None] * p + shift[:, None] - q)
        swing = np.abs((np.angle(m)[:, None] - turn + np.pi) % (2 * np.pi) - np.pi)
        ok = (far <= slack) & (swing <= TURN) & (np.abs(np.log(np.abs(m))[:, None] - grow) <= 0.6)
        if len(m) == 1:
            return ok, np.array([len(np.unique(corner[ok[0]]))])
        return ok, ok.sum(1)

    m = np.exp(grow + 1j * turn)
    votes = np.concatenate([agree(m[i : i + 256], (q - m * p)[i : i + 256], 3 * limit)[1] for i in range(0, len(p), 256)])
    best = None
    for i in np.argsort(-votes, kind="stable")[:REFINED]:  # a coarse proposal gathers loosely, then is fitted
        scale, shift = m[i], q[i] - m[i] * p[i]
        for slack in (3 * limit, 1.5 * limit, limit):
            ok, _ = agree(np.array([scale]), np.array([shift]), slack)
            inside = np.flatnonzero(ok[0])
            if len(inside) < 2 or np.ptp(corner[inside]) == 0:
                break
            dp, dq = p[inside] - p[inside].mean(), q[inside] - q[inside].mean()
            scale = (dq * dp.conj()).sum() / (np.abs(dp) ** 2).sum()
            if scale == 0:
                break
            shift = q[inside].mean() - scale * p[inside].mean()
        else:
            n = int(agree(np.array([scale]), np.array([shift]), limit)[1][0])
            if best is None or n > best[0]:
                best = (n, float(np.abs(scale)), float(np.angle(scale)), float(shift.real), float(shift.imag))
    return best if best and best[0] >= CONSENSUS else None


_PAIR = "media_a long, media_b long, inliers int, scale double, turn double, dx double, dy double"


def copies(media: DataFrame, id_column: str = "media_id", column: str = "image") -> DataFrame:
    """``media_a, media_b, inliers, scale, turn, dx, dy`` (a < b): a row for each pair of different images that show the same, and one of
    NULL ``inliers`` for each image beside the smallest id of equal bytes, whose pairs hold for it too.

    Table keys join descriptor to descriptor, with places packed along, so nothing is joined back; pairs meet again in several
    tables, so matches are made distinct before image pairs of fewer than ``CONSENSUS`` matches are dropped and the rest checked.
    """
    images = stored(descriptors(media, id_column, column))
    first = images.groupBy("digest").agg(F.min("media_id").alias("first"), F.max("media_id").alias("last")).where("first < last").drop("last")
    members = stored(images.select("media_id", "digest").join(first, "digest").where("media_id <> first").select(F.col("first").alias("media_a"), F.col("media_id").alias("media_b"), "digest").distinct())
    beside = members.select(F.col("media_b").alias("media_id"), "digest")
    points = images.join(beside, ["media_id", "digest"], "left_anti").select("media_id", F.explode(F.arrays_zip("place", "hi", "lo")).alias("c")).select("media_id", "c.*")
    bits = []
    for t in range(TABLES):
        at = t * TABLE_BITS
        high, low = F.shiftleft("hi", at) if at < 64 else F.shiftleft("lo", at - 64), F.shiftrightunsigned("lo", 64 - at) if 0 < at < 64 else F.lit(0).cast("long")
        bits.append(F.shiftrightunsigned(high.bitwiseOR(low), 64 - TABLE_BITS) + F.lit(t << TABLE_BITS))
    keyed = points.select("media_id", "place", "hi", "lo", F.explode(F.array(*bits)).alias("key"))
    a, b = keyed.alias("a"), keyed.alias("b")
    far = F.bit_count(F.col("a.hi").bitwiseXOR(F.col("b.hi"))) + F.bit_count(F.col("a.lo").bitwiseXOR(F.col("b.lo")))
    met = a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.media_id") < F.col("b.media_id")) & (far <= MAX_BITS))
    met = met.groupBy(F.col("a.media_id").alias("media_a"), F.col("b.media_id").alias("media_b")).agg(F.collect_set(F.struct(F.col("a.place").alias("a"), F.col("b.place").alias("b"))).alias("ps"))
    enough = met.where(F.size("ps") >= CONSENSUS).select("media_a", "media_b", F.array_sort("ps").alias("ps"))
    enough = enough.select("media_a", "media_b", F.col("ps.a").alias("a"), F.col("ps.b").alias("b"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches):
            x, y, p, q = (part.column(i) for i in range(4))
            found = [consensus(p[i].values.to_numpy(), q[i].values.to_numpy()) for i in range(part.num_rows)]
            some = [i for i, f in enumerate(found) if f]
            rest = [pa.array([found[i][k] for i in some], pa.float64() if k else pa.int32()) for k in range(5)]
            yield pa.RecordBatch.from_arrays([x.take(pa.array(some, pa.int64())), y.take(pa.array(some, pa.int64())), *rest], ["media_a", "media_b", "inliers", "scale", "turn", "dx", "dy"])

    pairs = enough.mapInArrow(check, _PAIR)
    same = members.select("media_a", "media_b").distinct().select("media_a", "media_b", F.lit(None).cast("int").alias("inliers"), F.lit(1.0).alias("scale"), *[F.lit(0.0).alias(c) for c in ("turn", "dx", "dy")])
    return pairs.unionByName(same)


def draw(seed: int, size: int = 96) -> np.ndarray:
    """An invented textured picture."""
    rng = np.random.default_rng(seed)
    layer = lambda cell: resize(rng.uniform(0, 255, (size // cell, size // cell)).astype(np.float32), 1 / cell)
    return np.clip((0.45 * layer(4) + 0.35 * layer(8) + 0.2 * layer(16) - 128) * 1.6 + 128, 0, 255)


def edit(img: np.ndarray, kind: int) -> np.ndarray:
    """A cropped, turned, smaller or re-lit version."""
    h, w = img.shape
    if kind == 0:
        return img[h // 8 :, : w - w // 6]
    if kind == 1:
        return np.clip(np.rot90(img)[4:] * 0.8 + 30, 0, 255)
    if kind == 2:
        return resize(img, 1.25)
    return np.clip(255 * (img[: h - 6, 8:] / 255) ** 0.8, 0, 255)


def media_table(embeddings: DataFrame) -> DataFrame:
    """``media_id, image``: a PNG drawn for each vector (equal vectors, equal pictures), id ``2 * vec_id``, and for every
    ``vec_id`` that is 3 modulo 8 an edited copy, id ``2 * vec_id + 1``.  The given tables hold no media of their own."""
    ship(embeddings.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches):
            ids, images = [], []
            for v, x in zip(part.column(0).to_pylist(), part.column(1)):
                img = draw(zlib.crc32(np.asarray(x.as_py(), np.float32).tobytes()))
                ids.append(2 * v)
                images.append(encode_png(img))
                if v % 8 == 3:
                    ids.append(2 * v + 1)
                    images.append(encode_png(edit(img, v // 8 % 4)))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(images, pa.binary())], ["media_id", "image"])

    return embeddings.select("vec_id", "embedding").where("vec_id is not null and embedding is not null").mapInArrow(run, "media_id long, image binary")
