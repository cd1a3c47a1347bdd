"""Operators held against versions written again in plain Python, without their kernels."""

import math
import random
import re
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from weftline.llm import ann, chat, common, lm, media, mixing, packing, secrets, simhash, substring, textkit, toxicity
from weftline.llm.queries import op5_neighbours, op7_media


def prose(r, n):
    return " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(2, 9))) for _ in range(n))


# substring


def plain_units(text):
    raw, least = text.encode(), substring.MIN_PASSAGE
    gear, mask = [int(g) for g in substring.GEAR], (1 << 32) - 1
    cuts, last = [], 0
    for i in range(len(raw)):
        h = sum(gear[raw[i - k]] << k for k in range(16) if i - k >= 0) & mask
        if h >> (32 - substring.BITS) == 0 and (i + 1 >= len(raw) or raw[i + 1] & 0xC0 != 0x80):
            if i + 1 - last >= substring.MIN_GAP and i + 1 < len(raw):
                cuts.append(i + 1)
            last = i + 1
    edges = [0, *cuts, len(raw)]
    spans = []
    for s, e in zip(edges, edges[1:]):
        while e - s > substring.MAX_CHUNK:
            spans.append((s, s + substring.MAX_CHUNK))
            s += substring.MAX_CHUNK
        spans.append((s, e))
    out = []
    for i, (s, _) in enumerate(spans):
        for _, e in spans[i:]:
            if e - s >= least:
                out.append((s, e, xxhash.xxh3_128_digest(raw[s:e])[:12]))
                break
    return out


def test_substring_as_written_again(spark):
    r = random.Random(23)
    shared = [prose(r, r.randint(40, 90)) for _ in range(6)]
    texts = {i: " ".join(r.choice([prose(r, r.randint(3, 50)), r.choice(shared)]) for _ in range(4)) for i in range(40)}
    first, want = {}, {}
    for i, t in texts.items():  # all texts are ASCII
        for s, e, d in plain_units(t):
            if d not in first:
                first[d] = (i, s)
    for i, t in texts.items():
        lines = {}
        for s, e, d in plain_units(t):
            f, f0 = first[d]
            if f < i:
                lines.setdefault((f, s - f0), []).append((s, e))
        for (f, off), spans in lines.items():
            merged = []
            for s, e in sorted(spans):
                if merged and s <= merged[-1][1]:
                    merged[-1][1] = max(e, merged[-1][1])
                else:
                    merged.append([s, e])
            for s, e in merged:
                want[i, s, e, f] = s - off
    got = {(x["doc_id"], x["char_start"], x["char_end"], x["first_doc_id"]): x["first_start"] for x in substring.repeats(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    assert got == want and want
    assert all(texts[i][s:e] == texts[f][s0 : s0 + e - s] for (i, s, e, f), s0 in got.items())


# neighbours


@pytest.mark.parametrize("shard,block,factor", [(100, 5, 1.0), (10_000, 10_000, 1.0), (70, 3, 0.5)])
def test_neighbours_of_stated_queries(spark, shard, block, factor):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(900, 10)) + 2 * rng.normal(size=(6, 10))[rng.integers(0, 6, 900)]
    x[300:600] = x[300]  # a third of all rows are one vector
    ids = np.arange(900)
    ids[890:] = 880  # a repeated id
    rows = [(int(i), v.astype(np.float32).tolist()) for i, v in zip(ids, x)]
    got = ann.neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5), k=6, factor=factor, every=10, shard=shard, block=block).collect()
    v = x.astype(np.float32).astype(float)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    want = []
    for q in np.flatnonzero(ids % 10 == 0):
        d = np.round(np.sqrt(np.maximum(0, 2 - 2 * v @ v[q])), 6)
        order = [j for j in np.lexsort((ids, d)) if ids[j] != ids[q]][:6]
        want += [(int(ids[q]), k + 1, int(ids[j]), float(d[j])) for k, j in enumerate(order)]
    got = sorted((r["query_id"], r["rank"], r["neighbour_id"], r["distance"]) for r in got)
    if factor == 1.0:
        assert got == sorted(want)
    else:
        assert len(got) == len(want) and len(set(got) & set(want)) >= 0.9 * len(set(want))


def test_neighbours_of_one_id_in_two_rows(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.1]), (3, [0.1, 1.0])], "vec_id long, embedding array<float>")
    got = sorted((r["query_id"], r["rank"], r["neighbour_id"]) for r in ann.neighbours(df, k=2).where("query_id = 1").collect())
    assert got == [(1, 1, 2), (1, 1, 3), (1, 2, 2), (1, 2, 3)]


# simhash


@pytest.mark.parametrize("shard", [60, 100_000])
def test_simhash_edges_of_a_dense_ball(spark, shard):
    """Many different prints near one another in one band: salted cells find every component."""
    rng = np.random.default_rng(9)
    hub = rng.integers(0, 1 << 63, 1, dtype=np.uint64)
    ball = np.repeat(hub, 400)
    for _ in range(3):
        ball ^= np.uint64(1) << rng.integers(0, 64, 400).astype(np.uint64)
    u = np.unique(np.concatenate([ball, rng.integers(0, 1 << 63, 300, dtype=np.uint64)]))
    n = rng.integers(100, 120, len(u))
    rows = [(i, int(k), int(a), int(a), 0) for i, (k, a) in enumerate(zip(n, u.view(np.int64)))]
    edges = simhash.near_edges(spark.createDataFrame(rows, "rep long, n long, u long, b1 long, b2 long"), shard=shard).collect()
    near = (np.bitwise_count(u[:, None] ^ u[None]) <= 9) & (np.minimum(n[:, None], n[None]) >= 0.8 * np.maximum(n[:, None], n[None]))

    def parts(pairs):
        label = list(range(len(u)))

        def find(i):
            while label[i] != i:
                label[i] = label[label[i]]
                i = label[i]
            return i

        for a, b in pairs:
            label[max(find(a), find(b))] = min(find(a), find(b))
        return [find(i) for i in range(len(u))]

    assert parts((e["a"], e["b"]) for e in edges) == parts(zip(*np.nonzero(near)))


def test_simhash_looks_at_few_pairs_of_many():
    rng = np.random.default_rng(2)
    u = rng.integers(0, 1 << 63, 20_000, dtype=np.uint64)
    s = simhash.Search(u, u, u, np.full(len(u), 100), 9, 30, 0.8)
    for t in range(simhash.BLOCKS):
        s.by_block(t, np.arange(len(u)), np.zeros(0, int))
    assert s.compared < 0.02 * len(u) ** 2


# language model


def test_lm_score_as_written_again():
    rng = np.random.default_rng(4)
    counts = rng.integers(0, 50, 1 << lm.COUNT_BITS)
    net = lm.start(counts)
    net = net._replace(out=rng.normal(0, 0.3, net.out.shape).astype(np.float32), hidden=rng.normal(0, 0.3, lm.HIDDEN).astype(np.float32))
    text = "the quick brown fox jumps over the lazy dog and the cat"
    bucket = [int(lm.buckets(textkit.words([w]))[0]) for w in text.split()]
    classes = [int(net.token[b]) for b in bucket]
    total = 0.0
    for i, c in enumerate(classes):
        h = [float(x) for x in net.hidden]
        for k, off in enumerate((-2, -1, 1, 2)):
            near = classes[i + off] if 0 <= i + off < len(classes) else 0
            h = [a + float(b) for a, b in zip(h, net.embed[k][near])]
        h = [math.tanh(a) for a in h]
        z = [sum(a * float(net.out[j][v]) for j, a in enumerate(h)) + float(net.bias[v]) for v in range(lm.VOCAB)]
        top = max(z)
        same = np.flatnonzero(net.token == c)
        total += z[c] - top - math.log(sum(math.exp(a - top) for a in z)) + math.log((counts[bucket[i]] + 0.5) / (counts[same] + 0.5).sum())
    n, got = lm.score_texts([text], net)
    assert n[0] == len(classes) and abs(got[0] - total) < 1e-3


def test_lm_does_not_depend_on_partitions_and_beats_frequencies(spark):
    r = random.Random(5)
    rows = [(i, " ".join(r.choice(["red fox", "blue sky", "green tree", prose(r, 1)]) for _ in range(200))) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    a, b = (lm.fit(docs.repartition(k), rate=0.25) for k in (2, 7))
    assert all(np.allclose(x, y, atol=1e-6) for x, y in zip(a, b))
    texts = [t for _, t in rows]
    assert lm.score_texts(texts, a)[1].sum() >= lm.score_texts(texts, lm.start(lm.count_buckets(docs)))[1].sum()
    # words never seen score below real ones, and a frequent word above a rare one of its class
    odd, real = (lm.score_texts([t], a) for t in ("zqxv wkpj qqrt mmnbv", "red fox blue sky"))
    assert odd[1][0] / odd[0][0] < real[1][0] / real[0][0]


def test_lm_trains_on_every_position(spark):
    r = random.Random(8)
    words = [f"w{i}" for i in range(90)]
    texts = [" ".join(r.choice(words) for _ in range(n)) for n in (1, 2, 3, 40, 200)]
    docs = spark.createDataFrame(list(enumerate([*texts, "", None])), "doc_id long, text string")
    before, after = lm.start(lm.count_buckets(docs)), lm.fit(docs)
    for text in texts:
        line = [0, 0, *[int(before.token[b]) for b in lm.buckets(textkit.words([text]))], 0, 0]
        for i in range(2, len(line) - 2):  # a position moves the vector of every class around it
            assert all((after.embed[k][line[i + o]] != before.embed[k][line[i + o]]).any() for k, o in enumerate((-2, -1, 1, 2)))


def test_lm_windows_of_long_texts(spark):
    r = random.Random(9)
    texts = [" ".join(f"w{r.randrange(500)}" for _ in range(n)) for n in (1, lm.PIECE - 1, lm.PIECE, lm.PIECE + 1, 3 * lm.PIECE + 7)] + ["", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    token = lm.start(lm.count_buckets(docs)).token
    want, got = Counter(), Counter()
    for text in texts:
        line = [0, 0, *token[lm.buckets(textkit.words([text or ""]))].tolist(), 0, 0]
        want.update(tuple(line[i - 2 : i + 3]) for i in range(2, len(line) - 2))
    rows = lm.training_lines(docs, token).toPandas()
    line, at = lm._unpacked(rows)
    got.update(tuple(line[i - 2 : i + 3].tolist()) for i in at)
    assert got == want and rows["n"].sum() == want.total() and rows["n"].max() <= lm.PIECE


@pytest.mark.parametrize("size", [0.3, 40])
def test_lm_gradient_as_written_again(size):
    rng = np.random.default_rng(6)
    net = lm.start(rng.integers(0, 50, 1 << lm.COUNT_BITS))
    params = [p.astype(float) for p in net[2:]]
    params[2] = rng.normal(0, size, params[2].shape).astype(np.float32).astype(float)
    line, at = rng.integers(0, lm.VOCAB, 104), np.arange(2, 102)

    def loss(embed, hidden, out, bias, mix=1.0):
        h = np.tanh(hidden + sum(embed[k][line[at + o]] for k, o in enumerate((-2, -1, 1, 2))))
        z = mix * (h @ out) + bias
        top = z.max(1)
        return (top + np.log(np.exp(z - top[:, None]).sum(1)) - z[np.arange(100), line[at]]).sum()

    flat = np.concatenate([p.ravel() for p in params]).astype(np.float32)
    (got, gains), (plain, _) = lm.gradient(flat, line, at, True), lm.gradient(flat, line, at, False)
    assert np.allclose(got, plain, rtol=1e-3, atol=1e-4 * size)
    assert np.allclose(gains, [-loss(*params, mix=a) for a in lm.MIXES], rtol=1e-4)
    start = 0
    for i, p in enumerate(params):
        largest = np.argsort(-np.abs(got[start : start + p.size]))[:3]
        for j in [*largest, *rng.integers(0, p.size, 3)]:
            up, down = p.copy(), p.copy()
            up.flat[j] += 1e-5
            down.flat[j] -= 1e-5
            slope = (loss(*params[:i], up, *params[i + 1 :]) - loss(*params[:i], down, *params[i + 1 :])) / 2e-5 / len(at)
            assert abs(slope - got[start + j]) < 2e-3 * abs(slope) + 1e-4 * size
        start += p.size


# packing and mixing


def test_packing_against_every_partition():
    def least(sizes, capacity):
        best = len(sizes)

        def go(i, bins):
            nonlocal best
            if len(bins) >= best:
                return
            if i == len(sizes):
                best = len(bins)
                return
            for b in range(len(bins)):
                if bins[b] + sizes[i] <= capacity and bins[b] not in bins[:b]:
                    go(i + 1, [*bins[:b], bins[b] + sizes[i], *bins[b + 1 :]])
            go(i + 1, [*bins, sizes[i]])

        go(0, [])
        return best

    rng = np.random.default_rng(8)
    for _ in range(12):
        sizes = rng.integers(1, 60, 9)
        got = packing.improve(sizes, packing.best_fit(sizes, 100), 100)
        assert sorted(i for b in got for i in b) == list(range(9)) and all(sizes[b].sum() <= 100 for b in got)
        assert least(sizes.tolist(), 100) <= len(got) <= least(sizes.tolist(), 100) + 1


def test_packing_takes_copies_apart():
    rng = np.random.default_rng(1)
    sizes = rng.integers(1, 300, 200)
    keys = [int(k) if k else None for k in rng.integers(0, 60, 200)]
    for i, k in enumerate(keys):  # copies are of one size
        if k is not None:
            sizes[i] = 10 + 4 * k
    before = packing.improve(sizes, packing.best_fit(sizes, 1000), 1000)
    after = packing.separate(sizes, before, keys, 1000)
    assert sorted(i for b in after for i in b) == list(range(200)) and all(sizes[b].sum() <= 1000 for b in after)
    for b in after:
        held = [keys[i] for i in b if keys[i] is not None]
        assert len(held) == len(set(held))
    assert len(after) <= len(before) + 2


def test_null_and_repeated_ids_are_spread(spark):
    rows = [(None, "same text", "s")] * 300 + [(7, "same text", "s")] * 300 + [(i, prose(random.Random(i), 20), "t") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = packing.pack(docs, capacity=64, shard_docs=100).toPandas()
    assert len(got) == 900 and got["doc_id"].isna().sum() == 300
    of = got.assign(shard=got["bin"].to_numpy() >> 32)
    assert of[of["doc_id"].isna()].groupby("shard").size().max() < 120 and of[of["doc_id"] == 7].groupby("shard").size().max() < 120
    plan = mixing.schedule(docs).toPandas()
    assert len(plan[plan["epoch"] == 0]) == 900
    assert plan[(plan["source"] == "s") & (plan["epoch"] == 0)]["position"].nunique() == 600


def test_mixing_as_written_again(spark):
    import hashlib

    r = random.Random(6)
    rows = [(i, "w " * r.randint(1, 40), "big" if i % 9 else "small") for i in range(200)]
    got = {(x["doc_id"], x["epoch"]): x["position"] for x in mixing.schedule(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    size = {i: len(t.split()) for i, t, _ in rows}
    supply = {s: sum(size[i] for i, _, k in rows if k == s) for s in ("big", "small")}
    raw = {s: [n, math.sqrt(n * math.sqrt(n)), math.sqrt(n)] for s, n in supply.items()}
    w = {s: [raw[s][j] / sum(raw[k][j] for k in supply) for j in range(3)] for s in supply}
    area = lambda s, t: sum((min(t, b) - a) * (w[s][j] + w[s][j] + (w[s][j + 1] - w[s][j]) * (min(t, b) - a) / (b - a)) / 2 for j, (a, b) in enumerate(((0, 0.5), (0.5, 1))) if t > a)
    budget = max(supply[s] / area(s, 1) for s in supply)
    want = set()
    for s in supply:
        mine, at = sorted((i for i, _, k in rows if k == s), key=lambda i: hashlib.md5(str(i).encode()).hexdigest()), 0
        for i in mine:
            epoch = 0
            while epoch * supply[s] + at < budget * area(s, 1) - 0.5:
                want.add((i, epoch))
                assert abs(area(s, got[i, epoch]) * budget - (epoch * supply[s] + at)) < 1e-3 * budget
                epoch += 1
            at += size[i]
    assert set(got) == want


# toxicity and secrets


def test_toxicity_scores_as_written_again():
    r = random.Random(2)
    texts = [". ".join(prose(r, 8) for _ in range(r.randint(1, 9))) + r.choice(["!", "", "\n"]) for _ in range(20)] + ["", "  ", "...", "Ärger und Ruß? ja"]
    rng = np.random.default_rng(0)
    model = toxicity.Model(rng.normal(0, 1, 1 << toxicity.BITS).astype(np.float32), -1.5, 0.3)
    _, worst = toxicity.log_odds(toxicity.bags(texts), model)
    raw = lambda b: textkit.span_hashes(textkit.prefix_sums(np.frombuffer(b, np.uint8)), np.array([0]), np.array([len(b)]))[0]
    for text, got in zip(texts, worst):
        best = -math.inf
        for sentence in re.split(r"[\x00\n!.?]", text.lower()):
            words = [w.encode() for w in re.findall(r"[a-z0-9_\x80-\U0010ffff]+", sentence)]
            if not words:
                continue
            z = model.bias
            for w in words:
                z += model.weights[int(raw(w)) >> (64 - toxicity.BITS)]
                z += sum(float(model.weights[(int(raw(w[:k])) ^ 0x5555555555555555) >> (64 - toxicity.BITS)]) for k in toxicity.PREFIXES if len(w) > k)
            best = max(best, z)
        assert best == got if math.isinf(best) else abs(best - got) < 1e-3


def test_toxicity_noisy_or_prefers_labels_it_can_explain():
    """The likelihood of the labels under the trained noisy-or is above that of any single weight moved a little."""
    r = random.Random(3)
    texts = [". ".join([prose(r, 6), f"{prose(r, 3)} zorkish {prose(r, 2)}" if i % 4 == 0 else prose(r, 6)]) for i in range(300)]
    toxic = np.array([i % 4 == 0 for i in range(300)])
    model = toxicity.fit(texts, toxic)

    def loss(m):
        z, _ = toxicity.log_odds(toxicity.bags(texts), m)
        b = toxicity.bags(texts)
        miss = np.exp(-np.bincount(b.doc, np.logaddexp(0, z), b.docs))
        told = toxicity.NOISE + (1 - 2 * toxicity.NOISE) * np.where(toxic, 1 - miss, miss)
        balance = np.where(toxic, 1 / toxic.sum(), 1 / (~toxic).sum())
        return -(np.log(told) * balance).sum()

    at = np.flatnonzero(model.weights)
    here = loss(model)
    for j in at[:5]:
        for step in (-3.0, 3.0):
            moved = model.weights.copy()
            moved[j] += step
            assert loss(model._replace(weights=moved)) > here - 0.02


def test_secret_probability_as_written_again():
    net = secrets.default_net()
    text = "set password = hunter2!Secret#9 in the file and " + "Zx8" * 40 + " too"
    found = secrets.scan_texts([text], net)
    assert found
    for _, s, e, p in found:
        best = -math.inf
        for t, a, b in secrets.windows(text, s, e):
            cells = [[0.0] * (secrets.EMBED + 1) for _ in range(secrets.WINDOW + 2 * secrets.CONTEXT)]
            pad = secrets.CONTEXT - a
            for i in range(len(cells)):
                code = int(secrets._CLASS[ord(t[i - pad])]) if 0 <= i - pad < len(t) else 0
                cells[i] = [float(v) for v in net.embed[code]] + [1.0 if pad + a <= i < pad + b else 0.0]
            hidden = []
            for f in range(secrets.FILTERS):
                top = max(sum(cells[i + k][c] * float(net.filters[k * (secrets.EMBED + 1) + c, f]) for k in range(5) for c in range(secrets.EMBED + 1)) + float(net.bias[f]) for i in range(len(cells) - 4))
                hidden.append(max(top, 0.0))
            z = sum(h * float(o) for h, o in zip(hidden, net.out[:-1])) + float(net.out[-1])
            best = max(best, 1 / (1 + math.exp(-(net.scale * z + net.shift))))
        assert abs(best - p) < 1e-3


def test_secrets_are_calibrated_on_their_best_window():
    """A long secret counts by its best window, as in a scan: no held-out secret that a scan would miss counts as found."""
    found = secrets.labelled_findings(1200, seed=3)
    net = secrets.fit(found, epochs=3)
    true = [f for f in found if f[3]]
    said = [max(secrets.probability(net, *secrets.encode(secrets.windows(t, s, e)))) >= net.threshold for t, s, e, _ in true]
    assert np.mean(said) >= 0.97


# media


def brute_copies(images):
    """Every corner of each pair of images compared."""
    parts = {k: media.describe([img]) for k, img in images.items()}
    out = set()
    for a in images:
        for b in images:
            if a < b:
                x, y = parts[a], parts[b]
                far = np.bitwise_count(x["hi"][:, None] ^ y["hi"][None]).astype(int) + np.bitwise_count(x["lo"][:, None] ^ y["lo"][None])
                i, j = np.nonzero(far <= media.MAX_BITS)
                if len(i) >= media.CONSENSUS and media.consensus(x["place"][i], y["place"][j]):
                    out.add((a, b))
    return out


def test_media_against_all_comparisons_on_large_pictures_and_small_crops(spark):
    images = {}
    for i in range(5):
        img = media.draw(70 + i, 304)
        images[10 * i] = img
        images[10 * i + 1] = [img[100:200, 120:230], media.resize(img, 1 / 0.7), media.resize(img, 2.0), media.resize(img, 1 / 1.4), np.rot90(img)[20:200]][i]
    images = {k: media.decode(media.encode_png(v)) for k, v in images.items()}
    want = brute_copies(images)
    assert want >= {(10 * i, 10 * i + 1) for i in range(5)} and len(want) == 5
    rows = [(k, media.encode_png(v)) for k, v in images.items()]
    got = {(r["media_a"], r["media_b"]) for r in media.copies(spark.createDataFrame(rows, "media_id long, image binary")).collect()}
    assert got <= want and len(got) >= 0.9 * len(want)


def test_media_equal_images_are_one_class(spark):
    one, other = media.encode_png(media.draw(5)), media.encode_png(media.edit(media.draw(5), 0))
    rows = [(i, one) for i in (3, 4, 9)] + [(20, other), (21, other), (22, media.encode_png(media.draw(6)))]
    got = {(r["media_a"], r["media_b"]): r["inliers"] for r in media.copies(spark.createDataFrame(rows, "media_id long, image binary")).collect()}
    assert set(got) == {(3, 4), (3, 9), (20, 21), (3, 20)} and got[3, 4] is None and got[3, 20] >= media.CONSENSUS


def test_media_keeps_every_corner():
    small, large = (len(media.describe([media.draw(1, n)])["hi"]) for n in (96, 400))
    assert large > 15 * small


# chat


@pytest.mark.parametrize("template,want", [("{{ m.x + 1 }}", "1"), ("{{ m.x | length }}", "0"), ("{{ 'a' in m.x }}", "False"), ("{{ m.x | trim }}{{ m.x | upper }}", ""), ("{{ 1 + 'a' }}", "1a"), ("{% for q in m.x %}z{% endfor %}", ""), ("{{ m.x > 1 }}", "False"), ("{{ 5 | first }}", "5")])
def test_no_value_makes_a_template_fail(template, want):
    assert chat.compile_template(template)({"m": {"x": None}})[0] == want


def test_null_turns_come_first(spark):
    rows = [(1, 2, "user", "b"), (1, None, "system", "a"), (1, 1, "user", "c")]
    text = chat.render(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), "{% for m in messages %}{{ m.text }}{% endfor %}").first()["text"]
    assert text == "acb"


# shared folder and queries


def test_a_cluster_needs_a_shared_folder():
    conf = SimpleNamespace(get=lambda name, default: default)
    none = SimpleNamespace(isDefined=lambda: False)
    jsc = SimpleNamespace(sc=lambda: SimpleNamespace(getCheckpointDir=lambda: none))
    spark = SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(_jsc=jsc, master="spark://host:7077"))
    with pytest.raises(RuntimeError):
        common.shared_dir(spark)


def test_registered_searches(spark):
    folder = "/root/testdata/sf0.001"
    got = op5_neighbours(spark, folder)
    assert {r["query_id"] % 100 for r in got.select("query_id").distinct().collect()} == {0}
    pairs = op7_media(spark, folder).collect()
    assert all((r["media_a"] // 2) % 8 == 3 and r["media_b"] == r["media_a"] + 1 for r in pairs if r["inliers"] is not None) and pairs


# pipeline


def test_each_stage_against_a_plain_version(spark, tmp_path):
    r = random.Random(31)
    bad, key = "vilefoul", "AKIA" + "Q7ZK3M9XW2B5T8RC"
    rows, labels = [], []
    for i in range(260):
        text = ". ".join(prose(r, 9) for _ in range(5))
        if i % 13 == 0:
            text += f". you {bad} {prose(r, 2)}"
        if i % 17 == 0:
            text += f" key {key} end"
        rows.append((i, text, "en", "big" if i % 7 else "small", len(text)))
        labels.append((i, 1, int(i % 13 == 0)))
    rows += [(1000 + i, rows[i][1] + " tail", "en", "big", 5) for i in range(1, 30) if i % 13]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    stage = dict(corpus_pipeline.STAGES)
    texts = {i: t for i, t, *_ in rows}

    clean = stage["toxicity"](spark, docs, str(tmp_path))
    assert {x["doc_id"] for x in clean.collect()} == {i for i in texts if bad not in texts[i]}
    single = stage["simhash"](spark, clean, str(tmp_path))
    assert {x["doc_id"] for x in single.collect()} == {i for i in texts if i < 1000 and bad not in texts[i]}
    masked = common.stored(stage["secrets"](spark, single, str(tmp_path)))
    assert {x["doc_id"]: x["text"] for x in masked.collect()} == {i: texts[i].replace(key, secrets.MASK) for i in texts if i < 1000 and bad not in texts[i]}
    mixed = common.stored(stage["mixing"](spark, masked, str(tmp_path)))
    plan = mixing.schedule(masked).toPandas()
    assert mixed.columns == docs.columns and sorted(x["doc_id"] for x in mixed.select("doc_id").collect()) == sorted(plan["doc_id"])
    packed = stage["packing"](spark, mixed, str(tmp_path)).toPandas()
    size = {x["doc_id"]: len(x["text"].split()) for x in masked.collect()}
    assert len(packed) == len(plan) and all(size[i] == n for i, n in zip(packed["doc_id"], packed["tokens"]))  # no text fills a bin
    assert packed.groupby("bin")["tokens"].sum().max() <= packing.CAPACITY and not packed.duplicated(["bin", "doc_id"]).any()
    ordered = packed.sort_values("position")
    assert ordered["doc_id"].tolist() == plan["doc_id"].tolist() and ordered["position"].tolist() == list(range(len(plan)))
    assert (ordered.groupby("doc_id").cumcount() == ordered["epoch"]).all()
    whole = corpus_pipeline.run  # the stages as they are chained
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash", "secrets", "mixing", "packing"] and callable(whole)
