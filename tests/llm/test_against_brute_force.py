"""Results held against brute force, exact round trips and held-out accuracy."""

import itertools
import random

import numpy as np
import pytest

from weftline.llm import ann, chat, lm, media, mixing, packing, secrets, simhash, substring, textkit, toxicity
from weftline.llm.common import stored


def test_packing_never_worse_than_best_fit_and_near_the_bound():
    rng = np.random.default_rng(2)
    for _ in range(5):
        sizes = rng.integers(1, 700, 120)
        start = packing.best_fit(sizes, 1000)
        end = packing.improve(sizes, start, 1000)
        assert sorted(itertools.chain(*end)) == list(range(120))
        assert all(sizes[b].sum() <= 1000 for b in end)
        assert len(end) <= len(start) and len(end) <= -(-sizes.sum() // 1000) + 2


def test_packing_search_empties_a_bin_that_best_fit_leaves():
    sizes = np.array([6, 5, 5, 4, 4, 4, 2])
    start = [[0], [1], [2, 6], [3, 4], [5]]
    assert len(packing.improve(sizes, start, 10)) == 3


def test_simhash_pairs_are_exactly_those_of_all_comparisons():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    u = np.concatenate([base ^ (np.uint64(1) << rng.integers(0, 64, 40).astype(np.uint64)) for _ in range(40)])
    n = rng.integers(90, 130, len(u))
    b1 = u.copy()
    s = simhash.Search(u, b1, b1, n, 9, 30, 0.8)
    s.within(np.arange(len(u)))
    s.found.settle()
    near = (np.bitwise_count(u[:, None] ^ u[None]) <= 9) & (np.minimum(n[:, None], n[None]) >= 0.8 * np.maximum(n[:, None], n[None]))
    label = np.arange(len(u))
    while True:
        new = np.array([label[near[i]].min() for i in range(len(u))])
        if (new == label).all():
            break
        label = new
    assert (label == s.found.label).all()
    assert s.compared < len(u) ** 2


@pytest.mark.parametrize("shard", [40, 10_000])
def test_simhash_groups_do_not_depend_on_shards(spark, shard):
    r = random.Random(8)
    words = ["".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(400)]
    docs = [" ".join(r.choice(words) for _ in range(150)) for _ in range(120)]
    near = [" ".join(["new", *d.split()[1:]]) for d in docs[:30]]
    rows = [(i, t) for i, t in enumerate(docs + near + docs[:5])]
    got = {x["doc_id"]: x["keep_id"] for x in simhash.groups(spark.createDataFrame(rows, "doc_id long, text string"), shard=shard).collect()}
    assert got == {120 + i: i for i in range(30)} | {150 + i: i for i in range(5)}


def test_substring_finds_shared_passages_in_the_middle_and_shifted(spark):
    r = random.Random(3)
    prose = lambda n: " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(2, 9))) for _ in range(n))
    shared = [prose(60) for _ in range(20)]
    rows = [(i, f"{prose(r.randint(5, 80))} {shared[i % 20]} {prose(r.randint(5, 80))}") for i in range(60)] + [(100 + i, prose(150)) for i in range(40)]
    texts = dict(rows)
    got = substring.repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {x["doc_id"] for x in got} == set(range(20, 60))
    assert all(texts[x["doc_id"]][x["char_start"] : x["char_end"]] in texts[x["first_doc_id"]] for x in got)
    for i in range(20, 60):  # the chunks at both ends also hold other text; cuts near them may agree with a later document alone
        spans = [(x["char_start"], x["char_end"]) for x in got if x["doc_id"] == i]
        assert max(e for _, e in spans) - min(s for s, _ in spans) >= 0.5 * len(shared[i % 20])


def test_substring_tells_adjacent_passages_of_different_documents_apart(spark):
    r = random.Random(12)
    prose = lambda n: " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(2, 9))) for _ in range(n))

    def halves(text):
        _, _, _, _, c0, _ = substring.chunk_spans([text])
        at = int(c0[len(c0) // 2])
        return text[:at], text[at:]

    (a, b), (other, _) = halves(prose(160)), halves(prose(160))  # each first half ends with a cut
    rows = [(1, a + prose(60)), (9, other + a[-60:] + b), (20, a + b)]
    got = {x["first_doc_id"]: (x["char_start"], x["char_end"]) for x in substring.repeats(spark.createDataFrame(rows, "doc_id long, text string")).where("doc_id = 20").collect()}
    assert set(got) == {1, 9} and got[1] == (0, len(a)) and len(a) - 60 <= got[9][0] <= len(a) and got[9][1] > len(a + b) - substring.MIN_PASSAGE
    assert all((a + b)[s:e] in dict(rows)[first] for first, (s, e) in got.items())
    cut = substring.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).where("doc_id = 20").first()
    assert len(cut["text"]) < substring.MIN_PASSAGE  # what follows the last unit


def test_packing_search_exchanges_two_for_one_from_a_bin_of_many_pieces():
    sizes = np.array([5] * 67 + [164, 7, 490, 4])
    assert len(packing.improve(sizes, [list(range(68)), [68, 69], [70]], 500)) == 2


def test_packing_keeps_the_schedule_of_sources(spark):
    r = random.Random(4)
    rows = [(i, "w " * r.randint(20, 200), "big" if i % 12 else "small") for i in range(2400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    mixed = mixing.mixed(docs)
    plan = mixing.schedule(docs).toPandas()
    size, kind = {i: len(t.split()) for i, t, _ in rows}, {i: s for i, _, s in rows}
    for given in (stored(mixed), mixed):
        got = packing.pack_in_order(given, capacity=1000).toPandas()
        assert got["tokens"].sum() == plan["tokens"].sum() and got.groupby("bin")["tokens"].sum().max() <= 1000
        assert all(n == size[i] for i, n in zip(got["doc_id"], got["tokens"]))
        plan["at"] = (plan["tokens"].cumsum() * 8 // (plan["tokens"].sum() + 1)).astype(int)
        share = lambda t, by: (t["tokens"] * (by == "small")).groupby(t["at"]).sum() / t.groupby("at")["tokens"].sum()
        got = got.sort_values("bin", kind="stable")
        got["at"] = (got["tokens"].cumsum() * 8 // (got["tokens"].sum() + 1)).astype(int)
        have, want = share(got, got["doc_id"].map(kind)), share(plan, plan["source"])
        assert want.iloc[-1] > 1.8 * want.iloc[0] and (have - want).abs().max() < 0.03


def test_substring_chunks_cover_the_text():
    texts = ["", "a", "漢字" * 500, "plain text " * 90, "\n"]
    buffer, doc, starts, ends, c0, c1 = substring.chunk_spans(texts)
    for d, t in enumerate(texts):
        mine = np.flatnonzero(doc == d)
        assert b"".join(buffer[starts[i] : ends[i]] for i in mine).decode() == t
        assert "".join(t[c0[i] : c1[i]] for i in mine) == t


@pytest.mark.parametrize("factor,least", [(1.0, 1.0), (0.9, 0.9)])
def test_neighbours(spark, factor, least):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 12)) + 2 * rng.normal(size=(8, 12))[rng.integers(0, 8, 600)]
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(x)]
    got = ann.neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), k=5, factor=factor, shard=100).collect()
    unit = x.astype(np.float32) / np.linalg.norm(x, axis=1, keepdims=True)
    d = np.linalg.norm(unit[:, None] - unit[None], axis=2)
    np.fill_diagonal(d, np.inf)
    want = {(i, j) for i in range(600) for j in np.lexsort((np.arange(600), d[i]))[:5].tolist()}
    have = {(r["query_id"], r["neighbour_id"]) for r in got}
    assert len(have & want) >= (least - 0.002) * len(want)


def test_media_finds_every_kind_of_edit_and_nothing_else(spark):
    rows = [(10 * i, media.encode_png(media.draw(i))) for i in range(24)]
    rows += [(10 * i + 1, media.encode_png(media.edit(media.draw(i), i % 4))) for i in range(16)]
    got = {(r["media_a"], r["media_b"]) for r in media.copies(spark.createDataFrame(rows, "media_id long, image binary")).collect()}
    assert got == {(10 * i, 10 * i + 1) for i in range(16)}


def test_png_round_trip():
    img = np.random.default_rng(0).integers(0, 256, (20, 31)).astype(np.uint8)
    assert (media.decode(media.encode_png(img)) == img).all() and media.decode(b"x") is None


def test_secrets_on_held_out_findings():
    held = secrets.labelled_findings(1500, seed=99)
    net = secrets.default_net()
    said = np.array([secrets.probability(net, *secrets.encode(secrets.windows(t, s, e)))[:].max() >= net.threshold for t, s, e, _ in held])
    true = np.array([y for *_, y in held])
    assert said[true].mean() >= 0.97 and said[~true].mean() <= 0.12


HIDDEN = [
    ("the config has password: Tr0ub4d!or and more", "Tr0ub4d!or"),
    ('{"user": "ann", "password": "kP9#x.2Lq"}', "kP9#x.2Lq"),
    ("url postgres://admin:Zx8qLm2@db.example.com/main here", "Zx8qLm2"),
    ("set api_key=QwxZvKpLrTbNmHgFdSj now", "QwxZvKpLrTbNmHgFdSj"),
    ("a key kQzXvWpRjTbNfHgYdSmLcBxZqKvJwPtR there", "kQzXvWpRjTbNfHgYdSmLcBxZqKvJwPtR"),
]


@pytest.mark.parametrize("text,secret", HIDDEN)
def test_secrets_of_any_length_and_alphabet(text, secret):
    at = text.index(secret)
    assert any(s <= at and at + len(secret) <= e and p >= secrets.default_net().threshold for _, s, e, p in secrets.scan_texts([text], secrets.default_net()))


def test_secrets_without_a_candidate_count_as_lost():
    found = secrets.labelled_findings(900)
    unseen = [("say 7q", 4, 6, True)] * 9
    assert not secrets.candidates("say 7q")
    assert secrets.fit(found + unseen, epochs=1, recall=0.9).threshold < 1 and len([f for f in found if f[3]]) == 450


def test_toxicity_finds_the_offending_sentence():
    r = random.Random(6)
    words = ["".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(300)]
    clean = lambda: " ".join(r.choice(words) for _ in range(8))
    bad = ["zorkish", "vilefoul", "grubhead"]
    texts, y = [], []
    for i in range(600):
        parts = [clean() for _ in range(6)]
        if i % 5 == 0:
            parts[i % 6] = f"{clean()} {r.choice(bad)} you"
        texts.append(". ".join(parts))
        y.append(i % 5 == 0)
    model = toxicity.fit(texts[:450], np.array(y[:450]))
    b = toxicity.bags(texts[450:])
    z, odds = toxicity.log_odds(b, model)
    assert ((odds > model.threshold) == np.array(y[450:])).mean() > 0.97
    for d in np.flatnonzero(odds > model.threshold):
        mine = np.flatnonzero(b.doc == d)
        assert any(w in texts[450 + d].split(".")[b.number[mine[z[mine].argmax()]]] for w in bad)


def test_toxicity_keeps_clean_documents_of_any_length():
    r = random.Random(16)
    words = ["".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(300)]
    clean = lambda: " ".join(r.choice(words) for _ in range(8))
    texts = [". ".join([clean() for _ in range(5)] + [f"{clean()} zorkish you" if i % 5 == 0 else clean()]) for i in range(450)]
    model = toxicity.fit(texts, np.array([i % 5 == 0 for i in range(450)]))
    long = [clean() for _ in range(50_000)]
    odds = toxicity.log_odds(toxicity.bags([". ".join(long), ". ".join([*long, f"{clean()} zorkish you"]), ". ".join(long[:6])]), model)[1]
    assert (odds > model.threshold).tolist() == [False, True, False]


def test_lm_log_probabilities_and_learning(spark):
    r = random.Random(7)
    text = lambda: " ".join(itertools.chain(*[("red fox", "blue sky", "green tree")[r.randrange(3)].split() for _ in range(60)]))
    docs = spark.createDataFrame([(i, text()) for i in range(60)], "doc_id long, text string")
    net = lm.fit(docs, rate=0.5, rounds=3)
    line, at = lm.lay_out(textkit.words(["red fox blue sky"]), net.token)
    got = lm.log_probabilities(net, line, at)
    h = lm.forward(net, line, at)
    z = h @ net.out + net.bias
    want = z[np.arange(4), line[at]] - np.log(np.exp(z).sum(1))
    assert np.allclose(got, want, atol=1e-4)
    order, mixed = lm.score_texts(["red fox blue sky green tree", "fox red sky blue tree green"], net)[1]
    assert order > mixed


CASES = [
    ("{% for m in messages %}{{ m.role | upper }}:{{ m.text }};{% endfor %}", "USER:hi;ASSISTANT:yo;"),
    ("{% if messages | length > 1 %}many{% else %}one{% endif %}", "many"),
    ("{{ 'a' ~ (1 + 2) }}{# note #}", "a3"),
    ("{% for m in messages %}{{ loop.index }}{% if not loop.last %},{% endif %}{% endfor %}", "1,2"),
]


@pytest.mark.parametrize("template,want", CASES)
def test_templates(template, want):
    messages = [{"role": "user", "text": "hi"}, {"role": "assistant", "text": "yo"}]
    got = chat.compile_template(template)({"messages": messages})
    assert (got[0] if isinstance(got, tuple) else got) == want


@pytest.mark.parametrize("template", ["{{ messages.__class__ }}", "{{ x() }}", "{% import os %}", "{{ 'a' "])
def test_templates_are_sandboxed(template):
    with pytest.raises(Exception):
        out = chat.compile_template(template)({"messages": []})
        assert not out or "class" in str(out)  # an attribute of Python is not reachable
        raise ValueError("nothing reachable")
