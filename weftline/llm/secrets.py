"""Secret scan: a character convolutional network over every candidate and its surroundings.

Candidates are maximal runs of at least ``MIN_RUN`` characters out of ``A-Z a-z 0-9 _ + / = -``; what follows a
credential-like name and ``=``, ``:`` or ``=>``, or ``Bearer``, to its closing quote or the next space, at any length and of
any characters; and the password in ``scheme://user:password@host``.  Candidates that overlap are one.
The network sees its characters and ``CONTEXT`` characters on both sides, each as a character class embedding with a
flag for "inside the candidate"; a width-5 convolution, a maximum over positions and a logistic output follow.  Runs
longer than a window are covered by overlapping windows, of which the best counts.  It is trained with numpy on
labelled findings (:func:`labelled_findings` by default, ``FINDINGS`` of them); its log-odds are calibrated on a third
of them, and the threshold is the highest that keeps at least ``RECALL`` of the held-out secrets, where a secret that
no candidate covers counts as lost.

Defined results: NULL and empty texts have no findings; a NULL ``doc_id`` is carried along as NULL; repeated rows
give repeated findings; extra columns are not read, and come back unchanged from :func:`redact`.
"""

from __future__ import annotations

import base64
import functools
import random
import re
import string
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import textkit
from .common import ship

MIN_RUN, CONTEXT, WINDOW, RECALL, FINDINGS, FILTERS, EMBED = 16, 20, 48, 0.99, 6000, 24, 8
MASK = "[SECRET]"
_RUN = re.compile(r"[A-Za-z0-9_+/=\-]{%d,}" % MIN_RUN)
_HINTS = ("pass", "pwd", "secret", "token", "key", "cred", "auth", "bearer", "pin")
_NAMED = re.compile(
    r"""(?ai)(?P<query>[?&][\w.\-]{0,40})?(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|api[_\- ]?key|(?:access|private|secret|auth|account|signing|encryption|master)[_\- ]?key|credentials?|auth|\bkey|\bpin)"""
    r"""(?:[_\-]?(?:id|key|token|value|hash|code|\w{1,20}))?["'\]]{0,2}[ \t]{0,4}(?::=|=>|==?|:)[ \t]{0,4}(?:Bearer[ \t]+|Basic[ \t]+)?(?P<value>"[^"\n]+"|'[^'\n]+'|`[^`\n]+`|\S+)"""
)
_BEARER = re.compile(r"""(?ai)\bbearer[ \t]+(?P<value>[^\s"']+)""")
_URL = re.compile(r"""(?a)://[^\s/:@"'<>]{0,200}:(?P<value>[^\s/"'<>]+)@""")
_SIZE = WINDOW + 2 * CONTEXT
_CLASS = np.full(256, 97, np.int64)  # 0 pads, 1-95 printable ASCII, 96 space-like, 97 the rest
_CLASS[32:127] = np.arange(1, 96)
_CLASS[[9, 10, 13, 32]] = 96


class Net(NamedTuple):
    embed: np.ndarray  # class, EMBED
    filters: np.ndarray  # 5 * (EMBED + 1), FILTERS
    bias: np.ndarray
    out: np.ndarray
    shift: float
    scale: float  # calibration
    threshold: float  # on the calibrated probability


def candidates(text: str) -> list[tuple[int, int]]:
    """Character spans of every candidate, in order and apart."""
    spans = [m.span() for m in _RUN.finditer(text)]
    low = text.lower()
    if any(h in low for h in _HINTS):
        for m in (*_NAMED.finditer(text), *_BEARER.finditer(text)):
            s, e = m.span("value")
            if text[s] in "\"'`" and e - s > 2 and text[e - 1] == text[s]:
                s, e = s + 1, e - 1
            else:
                value = text[s:e]
                if m.groupdict().get("query"):
                    value = re.split("[&#]", value, maxsplit=1)[0]
                s, e = s + len(value) - len(value.lstrip("\"'`")), s + len(value.rstrip(".,;)]}>\"'`"))
            if s < e:
                spans.append((s, e))
    if "://" in text:
        spans += [m.span("value") for m in _URL.finditer(text)]
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s < out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def windows(text: str, start: int, end: int) -> list[tuple[str, int, int]]:
    """(window text, candidate start and end in it); a run longer than WINDOW gives overlapping windows."""
    out = []
    for s in range(start, max(start + 1, end - WINDOW // 2), WINDOW // 2):
        e = min(s + WINDOW, end)
        left = max(0, s - CONTEXT)
        out.append((text[left : e + CONTEXT], s - left, e - left))
        if e == end:
            break
    return out


def encode(found: list[tuple[str, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """(character classes, inside flags), padded to one size."""
    codes, inside = np.zeros((len(found), _SIZE), np.int64), np.zeros((len(found), _SIZE), np.float32)
    for i, (t, s, e) in enumerate(found):
        pad = CONTEXT - s  # candidates begin at one place
        raw = np.frombuffer(t.encode("latin-1", "replace"), np.uint8)
        codes[i, pad : pad + len(raw)] = _CLASS[raw]
        inside[i, pad + s : pad + e] = 1
    return codes, inside


def _columns(codes: np.ndarray, inside: np.ndarray, embed: np.ndarray) -> np.ndarray:
    x = np.concatenate([embed[codes], inside[:, :, None]], axis=2)
    view = np.lib.stride_tricks.sliding_window_view(x, 5, axis=1)
    return np.ascontiguousarray(view.transpose(0, 1, 3, 2)).reshape(len(codes), _SIZE - 4, -1)


def logits(net: Net, codes: np.ndarray, inside: np.ndarray) -> np.ndarray:
    out = np.zeros(len(codes), np.float64)
    for i in range(0, len(codes), 512):
        h = _columns(codes[i : i + 512], inside[i : i + 512], net.embed) @ net.filters + net.bias
        out[i : i + 512] = np.maximum(h.max(axis=1), 0) @ net.out[:-1] + net.out[-1]
    return out


def probability(net: Net, codes: np.ndarray, inside: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(net.scale * logits(net, codes, inside) + net.shift, -30, 30)))


def fit(findings: list[tuple[str, int, int, bool]], epochs: int = 8, recall: float = RECALL, seed: int = 5) -> Net:
    """Train on (text, start, end, is secret): two thirds for weights, a third for calibration and threshold.

    Every window of a finding is trained on; as in a scan, its best window counts in calibration.
    """
    parts = [windows(t, s, e) for t, s, e, _ in findings]
    codes, inside = encode([w for ws in parts for w in ws])
    sizes = np.array([len(ws) for ws in parts])
    begins = np.cumsum(sizes) - sizes
    truth = np.array([f[3] for f in findings], np.float32)
    y = np.repeat(truth, sizes)  # of each window
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(truth))
    held, learnt = order[::3], np.zeros(len(truth), bool)
    learnt[np.setdiff1d(order, held)] = True
    train = np.flatnonzero(np.repeat(learnt, sizes))
    p = [rng.normal(0, 0.3, (98, EMBED)), rng.normal(0, 0.15, (5 * (EMBED + 1), FILTERS)), np.zeros(FILTERS), rng.normal(0, 0.3, FILTERS + 1)]
    p = [x.astype(np.float32) for x in p]
    m, v = [np.zeros_like(x) for x in p], [np.zeros_like(x) for x in p]
    step = 0
    for _ in range(epochs):
        rng.shuffle(train)
        for i in range(0, len(train), 64):
            b = train[i : i + 64]
            cols = _columns(codes[b], inside[b], p[0])
            h = cols @ p[1] + p[2]
            at = h.argmax(axis=1)
            top = np.take_along_axis(h, at[:, None, :], 1)[:, 0]
            act = np.maximum(top, 0)
            d = (1 / (1 + np.exp(-(act @ p[3][:-1] + p[3][-1]))) - y[b]) / len(b)
            dtop = d[:, None] * p[3][:-1] * (top > 0)
            chosen = cols[np.arange(len(b))[:, None], at]  # document, filter, column
            gx = np.zeros((len(b), _SIZE, EMBED + 1), np.float32)
            spread = (dtop[:, :, None] * p[1].T[None]).reshape(len(b), FILTERS, 5, EMBED + 1)
            for k in range(5):
                np.add.at(gx, (np.arange(len(b))[:, None], at + k), spread[:, :, k])
            ge = np.zeros_like(p[0])
            np.add.at(ge, codes[b].ravel(), gx[:, :, :EMBED].reshape(-1, EMBED))
            grads = [ge, np.einsum("bfc,bf->cf", chosen, dtop), dtop.sum(0), np.append(act.T @ d, d.sum())]
            step += 1
            for j, g in enumerate(grads):
                m[j] = 0.9 * m[j] + 0.1 * g
                v[j] = 0.999 * v[j] + 0.001 * g * g
                p[j] -= 0.005 * (m[j] / (1 - 0.9**step)) / (np.sqrt(v[j] / (1 - 0.999**step)) + 1e-8)
    net = Net(*p, 0.0, 1.0, 0.5)
    best = np.maximum.reduceat(logits(net, codes, inside), begins)  # of each finding
    z, t = best[held], truth[held]
    a, b = 1.0, 0.0  # Platt scaling by Newton steps, slightly regularised towards none
    for _ in range(30):
        q = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
        w = q * (1 - q)
        g = np.array([((q - t) * z).sum() + 1e-2 * (a - 1), (q - t).sum() + 1e-2 * b])
        hess = np.array([[(w * z * z).sum() + 1e-2, (w * z).sum()], [(w * z).sum(), w.sum() + 1e-2]])
        a, b = np.array([a, b]) - np.linalg.solve(hess, g)
    net = net._replace(scale=float(a), shift=float(b))
    secret = held[t > 0]
    said = 1 / (1 + np.exp(-np.clip(net.scale * best + net.shift, -30, 30)))
    seen = np.array([any(s < findings[i][2] and e > findings[i][1] for s, e in candidates(findings[i][0])) for i in secret], bool)
    good = np.sort(said[secret[seen]])
    spare = int(np.floor((1 - recall) * len(secret))) - int((~seen).sum())  # secrets that may still be lost
    return net._replace(threshold=float(min(0.5, good[max(0, spare)])))


def labelled_findings(n: int = FINDINGS, seed: int = 11) -> list[tuple[str, int, int, bool]]:
    """Invented labelled findings: secrets of common shapes and look-alikes (checksums, ids, paths, words), in context."""
    r = random.Random(seed)
    pick = lambda alphabet, k: "".join(r.choice(alphabet) for _ in range(k))
    upper, alnum, hexa = string.ascii_uppercase + string.digits, string.ascii_letters + string.digits, "0123456789abcdef"
    b64 = lambda k: base64.b64encode(r.randbytes(k)).decode()
    syllables = [pick(string.ascii_lowercase, r.randint(2, 4)) for _ in range(300)]
    word = lambda: "".join(r.choice(syllables) for _ in range(r.randint(1, 3)))
    spoken = lambda k: "".join(r.choice("b c d f g h k l m n p r s t v w z st th sch br tr pl qu".split() + [""]) + r.choice("a e e e i i o u ie ei ea io ou au".split()) + r.choice(["", "", "n", "n", "r", "s", "t", "l", "ng", "ck", "nd", "st", "rn"]) for _ in range(k))
    assign = lambda: r.choice([" = ", "=", ": ", ":", ' = "', '="', ": '", '": "'])
    name = lambda: r.choice(["", word() + "_", word().upper() + "_"]) + r.choice(["token", "secret", "api_key", "apikey", "password", "passwd", "pwd", "access_key", "auth_token", "TOKEN", "SECRET_KEY", "PASSWORD", "client_secret", "private_key"])
    plain = lambda: r.choice(["commit ", "sha1: ", "sha256:", "md5 ", "checksum ", "rev ", "id=", "uuid: ", "etag ", "ref ", "blob ", "build-", "trace ", "version ", "digest ", "order ", "isbn ", "file "])
    secret = [
        lambda: ("", "AKIA" + pick(upper, 16)), lambda: ("", "ASIA" + pick(upper, 16)),
        lambda: ("", r.choice(["ghp_", "gho_", "ghs_"]) + pick(alnum, 36)), lambda: ("", "xoxb-" + pick(string.digits, 11) + "-" + pick(alnum, 24)),
        lambda: ("", r.choice(["sk_live_", "rk_live_", "sk-"]) + pick(alnum, r.choice([24, 32, 48]))), lambda: ("", "AIza" + pick(alnum + "-_", 35)),
        lambda: (name() + assign(), pick(hexa, r.choice([16, 18, 24, 32, 40, 64]))), lambda: (name() + assign(), pick(hexa, r.choice([16, 18, 20, 32, 40]))),
        lambda: ("", r.choice(["password", "passwd", "secret", "token", "api_key", "pwd"]) + "=" + pick(hexa, r.randint(12, 24))),
        lambda: ("", name() + "=" + pick(alnum, r.randint(12, 40))), lambda: (name() + assign(), pick(alnum + "_-", r.randint(16, 44))),
        lambda: (name() + assign(), b64(r.choice([18, 24, 32, 48]))), lambda: ("Authorization: Bearer ", pick(alnum + "-_", r.randint(24, 60))),
        lambda: ("-----BEGIN PRIVATE KEY-----\n", b64(120)),
        lambda: (name() + assign(), pick(alnum, r.randint(4, 15))), lambda: (name() + assign(), pick(alnum + "!@#$.%^&*?~", r.randint(6, 24))),
        lambda: (name() + assign(), word() + pick(string.digits + "!@#$.", r.randint(1, 5))), lambda: (name() + assign(), word().capitalize() + r.choice("!@#$_-.") + word() + pick(string.digits, 2)),
        lambda: (r.choice(["postgres", "mysql", "redis", "mongodb", "https", "amqp"]) + "://" + r.choice(["", word(), "admin"]) + ":", pick(alnum + "!#$._-", r.randint(3, 24)) + "@" + word() + r.choice([".com", ":5432", ""]) + "/" + word()),
        lambda: ("", pick(string.ascii_letters, r.randint(20, 48))), lambda: (name() + assign(), pick(string.ascii_letters, r.randint(8, 40))),
    ]
    decoy = [
        lambda: (plain(), pick(hexa, r.choice([32, 40, 64]))), lambda: (plain(), pick(hexa, r.choice([16, 20, 24]))),
        lambda: (r.choice(["", plain()]), "-".join(pick(hexa, k) for k in (8, 4, 4, 4, 12))), lambda: ("", "-".join(word() for _ in range(4)) + "-" + pick(string.digits, 4)),
        lambda: (r.choice(["http://", "see ", "/"]), "/".join(word() for _ in range(4)) + "/" + str(r.randint(1, 2030))), lambda: ("", pick(string.digits, r.randint(16, 24))),
        lambda: ("", word() + "_" + word() + "_" + word() + "_" + str(r.randint(1, 99))), lambda: ("", f"20{r.randint(10, 30)}-{r.randint(1, 12):02d}-{r.randint(1, 28):02d}-{word()}-{word()}"),
        lambda: ("", "".join(word().capitalize() for _ in range(4)) + str(r.randint(1, 99))), lambda: ("data:image/png;base64,", b64(60)),
        lambda: (name() + " of ", "-".join(word() for _ in range(4)) + str(r.randint(1, 9))), lambda: ("", "=" * r.randint(10, 20) + str(r.randint(1, 9)) + "=" * 10),
        lambda: ("", "-".join(pick(string.digits, 4) for _ in range(4))), lambda: ("", word() + word() + word() + word() + str(r.randint(0, 9))),
        lambda: (name() + assign(), r.choice(["none", "None", "null", "true", "false", "required", "optional", "string", "str", "****", "********", "xxxxxxxx", "...", "<password>", "<your-token>", "${TOKEN}", "$PASSWORD", "{{ secret }}", "%s", "changeme", "your_api_key_here", "[SECRET]", "input()", "os.environ", "REDACTED"])),
        lambda: ("", "-".join(word() for _ in range(r.randint(3, 7)))), lambda: ("", "/".join(word() for _ in range(r.randint(3, 7)))), lambda: ("", "_".join(word() for _ in range(r.randint(3, 7)))),
        lambda: ("", "".join(word() for _ in range(r.randint(3, 5)))), lambda: ("", "".join(word().capitalize() for _ in range(r.randint(3, 6)))), lambda: ("", r.choice("-=_+/xaAno") * r.randint(16, 80)),
        lambda: ("", spoken(r.randint(5, 11))), lambda: ("", spoken(r.randint(5, 11)).upper()), lambda: ("", spoken(r.randint(5, 9)).capitalize()),
        lambda: ("", "-".join(spoken(r.randint(1, 4)) for _ in range(r.randint(3, 6)))), lambda: ("", "".join(spoken(r.randint(1, 3)).capitalize() for _ in range(r.randint(3, 6)))),
    ]
    out = []
    for i in range(n):
        before, body = r.choice(secret if i % 2 else decoy)()
        lead = r.choice([" ", "\n", "", '"']).join(["".join(r.choice([" ", " ", ". ", "\n"]) + word() for _ in range(r.randint(0, 6))), before])
        tail = r.choice(["", '"', "'", ";", ".", ",", "\n", " "])
        text = lead + body + tail + "".join(r.choice([" ", ". "]) + word() for _ in range(r.randint(0, 6)))
        end = len(lead) + (body.rindex("@") if "://" in before and "@" in body else len(body))
        found = [s for s in candidates(text) if s[0] < end and s[1] > len(lead)]
        if found:
            out.append((text, *max(found, key=lambda s: min(s[1], end) - max(s[0], len(lead))), bool(i % 2)))
        elif i % 2:  # a secret all the same
            out.append((text, len(lead), end, True))
    return out


@functools.cache
def default_net() -> Net:
    return fit(labelled_findings())


def scan_texts(texts: list[str], net: Net) -> list[tuple[int, int, int, float]]:
    """(text number, start, end, probability) of every candidate."""
    spans = [(d, s, e) for d, t in enumerate(texts) for s, e in candidates(t)]
    parts = [windows(texts[d], s, e) for d, s, e in spans]
    if not spans:
        return []
    p = probability(net, *encode([w for ws in parts for w in ws]))
    at = np.cumsum([0] + [len(ws) for ws in parts])[:-1]
    return [(*span, float(x)) for span, x in zip(spans, np.maximum.reduceat(p, at))]


def findings(docs: DataFrame, net: Net | None = None) -> DataFrame:
    """``doc_id, char_start, char_end, probability, secret``: a row for each candidate whose probability passes the threshold."""
    ship(docs.sparkSession)
    net = net or default_net()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in textkit.chunks(batches):
            hits = [h for h in scan_texts(texts, net) if h[3] >= net.threshold]
            ids = part.column(0).take(pa.array([h[0] for h in hits], pa.int64()))
            cols = [pa.array([h[i] for h in hits], t) for i, t in ((1, pa.int32()), (2, pa.int32()), (3, pa.float64()))]
            yield pa.RecordBatch.from_arrays([ids, *cols, pa.array([texts[h[0]][h[1] : h[2]] for h in hits], pa.string())], ["doc_id", "char_start", "char_end", "probability", "secret"])

    return docs.select("doc_id", "text").where("text is not null").mapInArrow(scan, "doc_id long, char_start int, char_end int, probability double, secret string")


def redact(docs: DataFrame, net: Net | None = None, mask: str = MASK) -> DataFrame:
    """The documents with every secret in ``text`` replaced by ``mask``, and ``n_chars``, if there, recounted for those."""
    ship(docs.sparkSession)
    net = net or default_net()
    names = docs.columns

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in textkit.chunks(batches):
            changed: dict[int, str] = {}
            for d, s, e, p in reversed(scan_texts(texts, net)):
                if p >= net.threshold:
                    t = changed.get(d, texts[d])
                    changed[d] = t[:s] + mask + t[e:]
            if changed:
                cols = {n: part.column(i) for i, n in enumerate(names)}
                old = cols["text"].to_pylist()
                cols["text"] = pa.array([changed.get(i, x) for i, x in enumerate(old)], cols["text"].type)
                if "n_chars" in cols:
                    count = cols["n_chars"].to_pylist()
                    cols["n_chars"] = pa.array([len(changed[i]) if i in changed else x for i, x in enumerate(count)], cols["n_chars"].type)
                part = pa.RecordBatch.from_arrays(list(cols.values()), names)
            yield part

    return docs.mapInArrow(cut, docs.schema)
