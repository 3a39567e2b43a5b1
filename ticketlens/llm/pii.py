"""PII: a character-level bidirectional LSTM with CRF transitions, in numpy.

Spans told by form (``pii_spans``) always count.  They are also the labelled
spans the network learns from, as they stand and rewritten the way people
write them past the forms: an address with its ``@`` and dots spelled out, an
IP address with other separators, a card with a mistyped digit or other
groups, a phone number without its ``+``.  What looks like a card but fails its
check digit is neither a span nor a counterexample: windows with one are left out.

The network reads characters in overlapping windows around every mark: digits,
``@`` and spelled-out dots.  Each kind of span, rewritten or not, holds one, so
text far from them has the tag "outside" by construction.  Overlapping windows'
scores are averaged, weighted towards each window's middle, and one Viterbi
pass decodes a whole region; a span that is sure by a margin and touches no
span told by form is added.

The network is fitted on a bounded sample: of each kind, plain and rewritten,
and of regions without a span, at most SAMPLE different windows in hash order
of their content.  ``measure`` gives recall and precision on other windows.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticketlens.llm.pii_spans import KINDS, Span, base_spans, failed_cards

WINDOW = 64
STRIDE = 32
REACH = 24
#: Windows of each kind, plain and rewritten, and twice as many of none, that are fitted on, at most.
SAMPLE = 300
#: One in so many windows, by hash, is kept from the fit to measure on.
HELD_OUT = 5
#: How much likelier (natural logarithm) an added span must be than no span.
MARGIN = 8.0

_TAGS = 1 + 2 * len(KINDS)  # outside; first and further characters of each kind
_CHARS = 132
_HIDDEN, _EMBED = 16, 12
_MARKS = re.compile(r"[0-9@]+|\b(?i:dot)\b")


def _codes(text: str) -> np.ndarray:
    """Character classes: ASCII as it is, 128 for other letters, 129 for the rest, 0 for padding."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    high = points >= 128
    if high.any():
        points[high] = [128 if chr(p).isalpha() else 129 for p in points[high].tolist()]
    return np.where(points == 0, 129, points)


def regions(text: str) -> list[tuple[int, int]]:
    """Stretches within REACH of a mark, joined where they overlap."""
    out: list[list[int]] = []
    for m in _MARKS.finditer(text):
        a, b = max(0, m.start() - REACH), min(len(text), m.end() + REACH)
        if out and a <= out[-1][1]:
            out[-1][1] = b
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _starts(a: int, b: int) -> range:
    return range(a, max(a + 1, b - WINDOW + STRIDE), STRIDE)


def _tags(spans: list[Span], n: int) -> np.ndarray:
    tags, end = np.zeros(n, np.int8), 0
    for a, b, kind in spans:
        if a >= end:
            k = 1 + 2 * KINDS.index(kind)
            tags[a:b], tags[a], end = k + 1, k, b
    return tags


# labelled spans past the forms ------------------------------------------------

_ATS = (" at ", " (at) ", "[at]", " @ ", " AT ")
_DOTS = (" dot ", " (dot) ", "[dot]", " . ", " DOT ")
_BETWEEN = (" . ", ",", "[.]", "-", ". ")


def rewritten(found: str, kind: str, pick: int) -> str:
    """The text of a span as someone might write it who keeps to no form; ``pick`` chooses the way."""
    way = pick % 5
    if kind == "email":
        local, _, domain = found.partition("@")
        return local + _ATS[way] + domain.replace(".", _DOTS[way])
    if kind == "ip":
        return found.replace(".", _BETWEEN[way])
    digits = [c for c in found if "0" <= c <= "9"]
    if kind == "card":
        at = (pick // 5) % len(digits)
        digits[at] = str((int(digits[at]) + 1 + (pick // 100) % 9) % 10)
        return ("", "", " ", ".", "-")[way].join("".join(digits[k : k + 4]) for k in range(0, len(digits), 4))
    bare = found[1:].replace("(", "").replace(")", "")
    groups = re.findall("[0-9]+", bare)
    if len(groups) < 3:  # too few to tell a number without its sign from any other
        digits = "".join(digits)
        groups = [digits[:-7], digits[-7:-4], digits[-4:]]
    return ("", "00", "", "0", "")[way] + (" ", " ", ".", "/", "-")[way].join(g for g in groups if g)


def _examples(text: str) -> Iterator[tuple[str, str, str, np.ndarray]]:
    """(kind, form, text, tags) of each region's training windows: as it stands and, with its first span, rewritten."""
    found = regions(text)
    if not found:
        return
    spans, failed = base_spans(text), failed_cards(text)
    starts, ends = [s[0] for s in spans], [b for _, b in failed]
    tags = _tags(spans, len(text))
    for a, b in found:
        own = spans[bisect_left(starts, a) : bisect_left(starts, b)]
        kind, first = (own[0][2], own[0][0]) if own else ("none", a + REACH)
        pick = xxhash.xxh32_intdigest(text[a:b].encode("utf-8", "surrogatepass"))
        at = max(0, first - pick % STRIDE)
        near = bisect_right(ends, at)  # the first that ends inside or behind the window
        if near < len(failed) and failed[near][0] < at + WINDOW:
            continue
        yield kind, "plain", text[at : at + WINDOW], tags[at : at + WINDOW]
        k = 1 + 2 * KINDS.index(kind) if own else 0
        if own and tags[first] == k:
            end = own[0][1]
            other = rewritten(text[first:end], kind, pick // STRIDE)
            own_tags = np.full(len(other), k + 1, np.int8)
            own_tags[0] = k
            yield kind, "rewritten", (text[at:first] + other + text[end : end + WINDOW])[:WINDOW], np.concatenate([tags[at:first], own_tags, tags[end : end + WINDOW]])[:WINDOW]


# the network ----------------------------------------------------------------


def _allowed() -> np.ndarray:
    """1 where tag j may follow tag i: a further character follows its own kind only."""
    ok = np.ones((_TAGS, _TAGS), np.float32)
    for k in range(len(KINDS)):
        ok[:, 2 + 2 * k] = 0
        ok[1 + 2 * k, 2 + 2 * k] = ok[2 + 2 * k, 2 + 2 * k] = 1
    return ok


_OK = _allowed()
_NEVER = np.where(_OK > 0, 0.0, -1e4).astype(np.float32)
_START = np.array([0.0] + [0.0, 0.0] * len(KINDS), np.float32)  # a window may begin inside a span


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-x))


def _new(seed: int) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    p = {"embed": rng.normal(0, 0.3, (_CHARS, _EMBED)), "out": rng.normal(0, 0.2, (2 * _HIDDEN, _TAGS)), "out_b": np.zeros(_TAGS), "trans": np.zeros((_TAGS, _TAGS))}
    for d in "fb":
        p[f"x{d}"] = rng.normal(0, 0.25, (_EMBED, 4 * _HIDDEN))
        p[f"h{d}"] = rng.normal(0, 0.2, (_HIDDEN, 4 * _HIDDEN))
        p[f"c{d}"] = np.concatenate([np.zeros(_HIDDEN), np.ones(_HIDDEN), np.zeros(2 * _HIDDEN)])
    return {k: v.astype(np.float32) for k, v in p.items()}


def _lstm(p: dict, d: str, x: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
    """Hidden states (batch, time, hidden) of one direction; x: (batch, time, embed)."""
    n, w, _ = x.shape
    gates = x @ p[f"x{d}"] + p[f"c{d}"]
    h, c = np.zeros((n, _HIDDEN), np.float32), np.zeros((n, _HIDDEN), np.float32)
    out, tape = np.empty((n, w, _HIDDEN), np.float32), []
    for t in range(w) if d == "f" else range(w - 1, -1, -1):
        z = gates[:, t] + h @ p[f"h{d}"]
        s = _sigmoid(z[:, : 3 * _HIDDEN])
        i, f, o, g = s[:, :_HIDDEN], s[:, _HIDDEN : 2 * _HIDDEN], s[:, 2 * _HIDDEN :], np.tanh(z[:, 3 * _HIDDEN :])
        before, h_before = c, h
        c = f * c + i * g
        tc = np.tanh(c)
        h = o * tc
        out[:, t] = h
        if keep:
            tape.append((t, i, f, o, g, before, tc, h_before))
    return out, tape


def emissions(p: dict, codes: np.ndarray, keep: bool = False) -> tuple:
    x = p["embed"][codes]
    hf, tape_f = _lstm(p, "f", x, keep)
    hb, tape_b = _lstm(p, "b", x, keep)
    both = np.concatenate([hf, hb], axis=2)
    return both @ p["out"] + p["out_b"], (x, both, tape_f, tape_b)


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + np.squeeze(top, axis)


def _crf(em: np.ndarray, trans: np.ndarray, tags: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Negative log-likelihood per window, its gradients by emissions and transitions."""
    n, w, _ = em.shape
    a = trans + _NEVER
    alpha, beta = np.empty_like(em), np.zeros_like(em)
    alpha[:, 0] = em[:, 0] + _START
    for t in range(1, w):
        alpha[:, t] = em[:, t] + _lse(alpha[:, t - 1, :, None] + a, 1)
    for t in range(w - 2, -1, -1):
        beta[:, t] = _lse(a + (em[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
    z = _lse(alpha[:, -1], 1)
    unary = np.exp(alpha + beta - z[:, None, None])
    g_trans = np.zeros_like(a)
    for t in range(1, w):
        g_trans += np.exp(alpha[:, t - 1, :, None] + a + (em[:, t] + beta[:, t])[:, None, :] - z[:, None, None]).sum(axis=0)
    rows = np.arange(n)[:, None]
    gold = em[rows, np.arange(w), tags].sum() + a[tags[:, :-1], tags[:, 1:]].sum()
    np.subtract.at(g_trans, (tags[:, :-1], tags[:, 1:]), 1.0)
    unary[rows, np.arange(w), tags] -= 1.0
    return float(z.sum() - gold) / n, unary / n, g_trans * _OK / n


def _lstm_back(p: dict, d: str, x: np.ndarray, tape: list, grad: np.ndarray, out: dict) -> np.ndarray:
    """Adds the gradients of one direction to out; returns the one by x."""
    g_gates = np.empty((x.shape[0], x.shape[1], 4 * _HIDDEN), np.float32)
    dh, dc = np.zeros_like(grad[:, 0]), np.zeros_like(grad[:, 0])
    g_h = np.zeros_like(p[f"h{d}"])
    for t, i, f, o, g, before, tc, h_before in reversed(tape):
        dh = dh + grad[:, t]
        dc = dc + dh * o * (1 - tc * tc)
        dz = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], axis=1)
        g_gates[:, t] = dz
        g_h += h_before.T @ dz
        dh, dc = dz @ p[f"h{d}"].T, dc * f
    flat = g_gates.reshape(-1, 4 * _HIDDEN)
    out[f"h{d}"], out[f"x{d}"], out[f"c{d}"] = g_h, x.reshape(-1, _EMBED).T @ flat, flat.sum(axis=0)
    return g_gates @ p[f"x{d}"].T


def gradients(p: dict, codes: np.ndarray, tags: np.ndarray) -> tuple[float, dict]:
    em, (x, both, tape_f, tape_b) = emissions(p, codes, True)
    loss, g_em, g_trans = _crf(em, p["trans"], tags)
    g = {"trans": g_trans, "out": both.reshape(-1, 2 * _HIDDEN).T @ g_em.reshape(-1, _TAGS), "out_b": g_em.sum(axis=(0, 1))}
    g_both = g_em @ p["out"].T
    g_x = _lstm_back(p, "f", x, tape_f, g_both[:, :, :_HIDDEN], g) + _lstm_back(p, "b", x, tape_b, g_both[:, :, _HIDDEN:], g)
    g["embed"] = np.zeros_like(p["embed"])
    np.add.at(g["embed"], codes, g_x)
    return loss, g


def train(codes: np.ndarray, tags: np.ndarray, epochs: int = 12, rate: float = 0.015, seed: int = 11) -> dict[str, np.ndarray]:
    """Adam over batches of 64 windows (n, WINDOW)."""
    p, rng, step = _new(seed), np.random.default_rng(seed), 0
    m, v = ({k: np.zeros_like(x) for k, x in p.items()} for _ in range(2))
    for epoch in range(epochs):
        order = rng.permutation(len(codes))
        for at in range(0, len(order), 64):
            some = order[at : at + 64]
            _, g = gradients(p, codes[some], tags[some])
            size = np.sqrt(sum(float((x * x).sum()) for x in g.values()))
            scale, step = min(1.0, 5.0 / max(size, 1e-9)), step + 1
            for k in p:
                m[k] = 0.9 * m[k] + 0.1 * scale * g[k]
                v[k] = 0.99 * v[k] + 0.01 * (scale * g[k]) ** 2
                p[k] -= (rate * (1 - epoch / epochs) * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return p


# decoding -------------------------------------------------------------------

_WEIGHT = np.minimum(np.arange(1, WINDOW + 1), np.arange(WINDOW, 0, -1)).astype(np.float32)


def _region_scores(p: dict, codes: list[np.ndarray]) -> list[np.ndarray]:
    """Tag scores (length, tags) of each region: its windows' scores, averaged."""
    where = [(r, s) for r, c in enumerate(codes) for s in _starts(0, len(c))]
    total = [np.zeros((len(c), _TAGS), np.float32) for c in codes]
    weight = [np.zeros((len(c), 1), np.float32) for c in codes]
    for at in range(0, len(where), 512):
        some = where[at : at + 512]
        block = np.zeros((len(some), WINDOW), np.int64)
        for k, (r, s) in enumerate(some):
            part = codes[r][s : s + WINDOW]
            block[k, : len(part)] = part
        em, _ = emissions(p, block)
        for k, (r, s) in enumerate(some):
            n = min(WINDOW, len(codes[r]) - s)
            total[r][s : s + n] += em[k, :n] * _WEIGHT[:n, None]
            weight[r][s : s + n] += _WEIGHT[:n, None]
    return [t / w for t, w in zip(total, weight, strict=True)]


def _viterbi(em: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """Best tags of regions (batch, time, tags) side by side."""
    n, w, _ = em.shape
    a = trans + _NEVER
    best, back = em[:, 0].copy(), np.zeros((n, w, _TAGS), np.int8)
    best[:, 2::2] -= 1e4  # a region begins outside or with a first character
    for t in range(1, w):
        step = best[:, :, None] + a
        back[:, t] = step.argmax(axis=1)
        best = step.max(axis=1) + em[:, t]
    tags = np.empty((n, w), np.int8)
    tags[:, -1] = best.argmax(axis=1)
    for t in range(w - 1, 0, -1):
        tags[:, t - 1] = back[np.arange(n), t, tags[:, t]]
    return tags


def _sure(em: np.ndarray, trans: np.ndarray, tags: np.ndarray, a: int, b: int, margin: float) -> bool:
    """Whether the span's tags are likelier than "outside" by the margin."""
    path, out = tags[a:b].astype(int), np.zeros(b - a, int)
    score = lambda y: float(em[np.arange(a, b), y].sum() + trans[y[:-1], y[1:]].sum() + (trans[0, y[0]] if a else 0.0) + (trans[y[-1], 0] if b < len(em) else 0.0))
    return score(path) - score(out) >= margin


def _whole(text: str, a: int, b: int) -> tuple[int, int]:
    """The span with numbers that it cuts taken whole."""
    digit = lambda k: "0" <= text[k] <= "9"
    while 0 < a and digit(a) and digit(a - 1):
        a -= 1
    while b < len(text) and digit(b - 1) and digit(b):
        b += 1
    return a, b


def _free(spans: list[Span], a: int, b: int) -> bool:
    """Whether a stretch touches none of the spans (by start)."""
    near = bisect_left(spans, (b,))
    return all(y <= a for _, y, _ in spans[max(0, near - 2 * len(KINDS)) : near])


def added_spans(p: dict, texts: list[str], base: list[list[Span]], margin: float = MARGIN) -> list[list[Span]]:
    """Spans that the network is sure of and that touch none told by form."""
    where = [(d, a, b) for d, t in enumerate(texts) for a, b in regions(t)]
    out: list[list[Span]] = [[] for _ in texts]
    scores = _region_scores(p, [_codes(texts[d][a:b]) for d, a, b in where])
    order = sorted(range(len(where)), key=lambda r: len(scores[r]))
    at = 0
    while at < len(order):
        # regions of like length side by side, about 2**18 cells at once
        upto = at + 1
        while upto < len(order) and (upto - at + 1) * len(scores[order[upto]]) <= 1 << 15:
            upto += 1
        group = order[at:upto]
        em = np.zeros((len(group), len(scores[group[-1]]), _TAGS), np.float32)
        em[:, :, 1:] = -1e4
        for k, r in enumerate(group):
            em[k, : len(scores[r])] = scores[r]
        for k, (r, tags) in enumerate(zip(group, _viterbi(em, p["trans"]), strict=True)):
            d, a, b = where[r]
            tags = tags[: b - a]
            firsts = np.flatnonzero(tags % 2 == 1)
            for s in firsts.tolist():
                e = s + 1
                while e < len(tags) and tags[e] == tags[s] + 1:
                    e += 1
                kind, x, y = KINDS[tags[s] // 2], *_whole(texts[d], a + s, a + e)
                if y - x > 6 and _MARKS.search(texts[d], x, y) and _free(base[d], x, y) and _free(out[d][-1:], x, y) and _sure(scores[r], p["trans"], tags, s, e, margin):
                    out[d].append((x, y, kind))
        at = upto
    return out


def find_spans(p: dict | None, texts: list[str]) -> tuple[list[list[Span]], list[list[Span]]]:
    """(told by form, added) of each text."""
    base = [base_spans(t) for t in texts]
    return base, added_spans(p, texts, base) if p else [[] for _ in texts]


# Spark ----------------------------------------------------------------------


def _sampler(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Training windows of every text."""
    names = ["kind", "form", "part", "tags"]
    for batch in batches:
        rows = [(kind, form, part, tags.tobytes()) for text in batch.column(0).to_pylist() for kind, form, part, tags in _examples(text)]
        columns = list(zip(*rows, strict=True)) or [(), (), (), ()]
        yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.string()) for c in columns[:3]), pa.array(columns[3], pa.binary())], names=names)


def sample(docs: DataFrame, text_col: str = "text", held_out: bool = False) -> list:
    """kind, form, part, tags of the windows that are fitted on, or of as many kept from the fit.

    Windows that copies of a text repeat count once.
    """
    given = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    windows = given.mapInArrow(_sampler, "kind string, form string, part string, tags binary").dropDuplicates()
    apart = F.pmod(F.crc32("part"), F.lit(HELD_OUT)) == 0
    order = Window.partitionBy("kind", "form").orderBy(F.xxhash64("part"), "part", "tags")
    ranked = windows.where(apart if held_out else ~apart).withColumn("n", F.row_number().over(order))
    rows = ranked.where(F.col("n") <= F.when(F.col("kind") == "none", 2 * SAMPLE).otherwise(SAMPLE)).drop("n").collect()
    return sorted(rows, key=lambda r: (r["kind"], r["form"], r["part"], bytes(r["tags"])))


def arrays(rows: list) -> tuple[np.ndarray, np.ndarray]:
    """(codes, tags) of windows, padded to WINDOW."""
    codes, tags = np.zeros((len(rows), WINDOW), np.int64), np.zeros((len(rows), WINDOW), np.int64)
    for k, r in enumerate(rows):
        codes[k, : len(r["part"])] = _codes(r["part"])
        tags[k, : len(r["part"])] = np.frombuffer(r["tags"], np.int8)
    return codes, tags


def learn(rows: list) -> dict[str, np.ndarray]:
    """The network, from sampled windows, in two rounds.

    A window without a labelled span may hold one that no form tells.  Where
    the first round sees one after all, against that window's own tags, it is
    no counterexample to the second.
    """
    none = [r["part"] for r in rows if r["kind"] == "none"]
    found = added_spans(train(*arrays(rows), epochs=6), none, [[] for _ in none], 0.0)
    doubted = {part for part, spans in zip(none, found, strict=True) if spans}
    return train(*arrays([r for r in rows if r["kind"] != "none" or r["part"] not in doubted]))


def fit(docs: DataFrame, text_col: str = "text") -> dict[str, np.ndarray] | None:
    """The network, from windows of all documents; None if no text has a span."""
    rows = sample(docs, text_col)
    return learn(rows) if any(r["kind"] != "none" for r in rows) else None


def measure(p: dict, rows: list) -> dict[str, tuple[int, int, int]]:
    """kind/form → (windows, labelled spans found, spans found that are not labelled), with the forms switched off.

    A labelled span counts as found if a span of its kind covers at least half of it.
    """
    out: dict[str, tuple[int, int, int]] = {}
    texts = [r["part"] for r in rows]
    for r, found in zip(rows, added_spans(p, texts, [[] for _ in texts]), strict=True):
        tags = np.frombuffer(r["tags"], np.int8)
        k = 2 + 2 * KINDS.index(r["kind"]) if r["kind"] != "none" else 0
        own = (tags == k) | (tags == k - 1) if k else np.zeros(len(tags), bool)
        hit = any(kind == r["kind"] and 2 * own[a:b].sum() >= own.sum() for a, b, kind in found)
        wrong = sum(not (tags[a:b] > 0).any() for a, b, _ in found)
        n, hits, misses = out.get(key := f"{r['kind']}/{r['form']}", (0, 0, 0))
        out[key] = n + 1, hits + hit, misses + wrong
    return out


_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))


def _finder(model: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        as_rows = lambda found: [[{"start": a, "end": b, "kind": k} for a, b, k in spans] for spans in found]
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                some = batch.slice(at, 1024)
                base, added = find_spans(model.value, some.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(as_rows(base), _SPANS), pa.array(as_rows(added), _SPANS)], names=["doc_id", "base", "added"])

    return run


_FOUND = "array<struct<start:int,end:int,kind:string>>"


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, base (spans told by form), added (spans the network adds), in code points, end exclusive.

    Null and empty texts have no spans; rows that repeat get the same spans;
    without any span to learn from, only the forms count.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, text_col))
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return given.mapInArrow(_finder(model), f"doc_id long, base {_FOUND}, added {_FOUND}")


def masked(text: str, spans: list[Span]) -> str:
    """The text with each span, or run of overlapping spans, replaced by its kind in brackets."""
    out, end = [], 0
    for a, b, kind in sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]))):
        if a >= end:
            out += [text[end:a], f"[{kind.upper()}]"]
        end = max(end, b)
    return "".join([*out, text[end:]])


def mask(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents with personal data masked in the text; null texts stay null, other columns stay as they are."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, text_col))

    @F.pandas_udf("string")
    def masker(texts):  # noqa: ANN001, ANN202
        import pandas as pd

        given = [t for t in texts if t is not None]
        base, added = find_spans(model.value, given)
        done = iter([masked(t, [*a, *b]) for t, a, b in zip(given, base, added, strict=True)])
        return pd.Series([None if t is None else next(done) for t in texts], dtype=object)

    return docs.withColumn(text_col, masker(F.col(text_col)))
