"""SentencePiece encoding and decoding by a weighted finite-state transducer.

The compiled machine has three parts:

* the normaliser: a space becomes the piece alphabet's space mark, a mark is
  put in front (the model's own switches decide);
* the pieces: an arc over each piece's characters that writes its id;
* byte fallback: a character that no piece covers writes its UTF-8 bytes' ids.

Composed with an input it is an acyclic lattice over the input's positions,
and the tropical-semiring shortest path gives the ids.  Weights:

* unigram models: the negative score of each piece, so the path is the most
  likely segmentation;
* BPE models: an arc weighs 0 if its piece may follow the piece before it,
  else infinity.  u may follow t if merging their joint text by the model's
  merge order gives t, u again; a segmentation is the result of the merges if
  and only if each neighbouring pair passes, so the path of weight 0 is unique,
  for every prefix of the input as well, and is the model's own encoding.  The
  follow weights are compiled as pairs are first met and kept.

No piece holds a space mark behind another character, so texts are cut before
each run of spaces; equal stretches share one path through a bounded memory.
Paths and decoding are linear in the length of the text.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
#: Largest model file that is broadcast to the tasks.
MAX_MODEL_BYTES = 64 << 20
_PATHS = 300_000
_FOLLOWS = 1 << 20
_INF = float("inf")

_ENCODED = "doc_id long, n_ids long, ids array<int>, decoded string, round_trip boolean"


def _fields(blob: bytes) -> Iterator[tuple[int, object]]:
    """(field number, value) of a protobuf message, one level deep."""
    at = 0

    def varint() -> int:
        nonlocal at
        out = shift = 0
        while True:
            byte = blob[at]
            at += 1
            out |= (byte & 127) << shift
            if byte < 128:
                return out
            shift += 7

    while at < len(blob):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(kind) or varint()
            yield tag >> 3, blob[at : at + size]
            at += size


class Transducer:
    """A SentencePiece model compiled to arcs; ``encode`` and ``decode`` one text."""

    UNIGRAM, BPE = 1, 2
    _NORMAL, _UNKNOWN, _CONTROL, _USER, _BYTE, _UNUSED = 1, 2, 3, 4, 6, 5

    def __init__(self, blob: bytes):
        self.pieces: list[tuple[str, float, int]] = []
        kind, prefix, squeeze, escape, charsmap = self.UNIGRAM, True, True, True, b""
        for field, value in _fields(blob):
            if field == 1:
                piece = dict(_fields(value))
                score = float(np.frombuffer(piece.get(2, b"\0\0\0\0"), "<f4")[0])
                self.pieces.append((bytes(piece.get(1, b"")).decode(), score, piece.get(3, self._NORMAL)))
            elif field == 2:
                kind = dict(_fields(value)).get(3, kind)
            elif field == 3:
                spec = dict(_fields(value))
                charsmap = bytes(spec.get(2, b""))
                prefix, squeeze, escape = (bool(spec.get(n, 1)) for n in (3, 4, 5))
        if charsmap or kind not in (self.UNIGRAM, self.BPE) or not escape:
            raise ValueError("only identity-normalised unigram and BPE models with escaped spaces are compiled")
        self.kind, self.prefix, self.squeeze = kind, prefix, squeeze
        self.arcs = {p: i for i, (p, _, t) in enumerate(self.pieces) if t in (self._NORMAL, self._USER) and p}
        self.longest = max(map(len, self.arcs), default=1)
        if any(MARK in p.lstrip(MARK) for p in self.arcs):
            raise ValueError("a piece spans a space; texts cannot be cut there")
        self.bytes_ = {int(p[3:5], 16): i for i, (p, _, t) in enumerate(self.pieces) if t == self._BYTE}
        self.unknown = next((i for i, (_, _, t) in enumerate(self.pieces) if t == self._UNKNOWN), 0)
        self.floor = min((s for _, s, t in self.pieces if t == self._NORMAL), default=0.0) - 10.0
        self.paths: dict[str, bytes] = {}
        self.follows: dict[int, bool] = {}
        if kind == self.BPE:  # a piece that its own merges do not reach never is an arc
            self.arcs = {p: i for p, i in self.arcs.items() if self._merged(p) == [p]}
            if any(c not in self.arcs for p in self.arcs for c in p):
                raise ValueError("a piece holds a character that has no piece of its own")
        self.lengths = [len(p) for p, _, _ in self.pieces]
        #: a piece's longest proper prefix that is a piece; the pieces by their characters (0: the id)
        self.shorter: dict[int, int] = {}
        self.trie: dict = {}
        for p, i in self.arcs.items():
            node = self.trie
            for c in p:
                node = node.setdefault(c, {})
            node[0] = i
            prefix_ids = (self.arcs.get(p[:j]) for j in range(len(p) - 1, 0, -1))
            found = next((u for u in prefix_ids if u is not None), None)
            if found is not None:
                self.shorter[i] = found
        # the output side: what each id writes when decoded
        self.texts = [p.replace(MARK, " ").encode() if t in (self._NORMAL, self._USER) else bytes([int(p[3:5], 16)]) if t == self._BYTE else b"" for p, _, t in self.pieces]
        if self.pieces:
            self.texts[self.unknown] = " ⁇ ".encode()

    # input side -------------------------------------------------------------

    def normalised(self, text: str) -> str:
        if self.squeeze:
            text = " ".join(w for w in text.split(" ") if w)
        if not text:
            return ""
        return (MARK if self.prefix else "") + text.replace(" ", MARK)

    _STRETCH = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")

    def encode(self, text: str) -> array:
        out, paths = [], self.paths
        for stretch in self._STRETCH.findall(self.normalised(text)):
            ids = paths.get(stretch)
            if ids is None:
                ids = array("i", self.shortest_path(stretch)).tobytes()
                if len(stretch) <= 64:
                    if len(paths) >= _PATHS:
                        paths.clear()
                    paths[stretch] = ids
            out.append(ids)
        return array("i", b"".join(out))

    def shortest_path(self, s: str) -> list[int]:
        """Ids along the shortest path through the lattice of one stretch."""
        return self._unigram_path(s) if self.kind == self.UNIGRAM else self._bpe_path(s)

    def _fallback(self, c: str) -> list[int]:
        raw = c.encode("utf-8", "surrogatepass")
        return [self.bytes_[b] for b in raw] if self.bytes_ else [self.unknown]

    def _unigram_path(self, s: str) -> list[int]:
        n, arcs, pieces = len(s), self.arcs, self.pieces
        best, back = [0.0] + [_INF] * n, [(0, -1)] * (n + 1)
        for i in range(n):
            for j in range(i + 1, min(n, i + self.longest) + 1):
                u = arcs.get(s[i:j])
                if u is not None and best[i] - pieces[u][1] < best[j]:
                    best[j], back[j] = best[i] - pieces[u][1], (i, u)
            if s[i] not in arcs and best[i] - self.floor < best[i + 1]:
                best[i + 1], back[i + 1] = best[i] - self.floor, (i, -1)
        return self._ids(s, back)

    def _bpe_path(self, s: str) -> list[int]:
        """The path of weight 0, searched depth first over the longest arcs.

        It is unique up to every position, so a position from which no arc of
        weight 0 leads on is not on it and never looked at again.
        """
        n, follows, lengths, shorter, longest = len(s), self.follows, self.lengths, self.shorter, self._longest_arc
        ids: list[int] = []
        starts: list[int] = []
        dead: set[int] = set()
        at, u = 0, longest(s, 0, n)
        while at < n:
            t = ids[-1] if ids else -1
            while u is not None:
                end = at + lengths[u] if u >= 0 else at + 1
                if end not in dead:
                    if t < 0 or u < 0:
                        break
                    pair = t << 32 | u
                    may = follows.get(pair)
                    if may is None:
                        may = self._may_follow(pair, t, u)
                    if may:
                        break
                u = shorter.get(u)
            if u is None:
                dead.add(at)
                at = starts.pop()
                u = shorter.get(ids.pop())
            else:
                ids.append(u)
                starts.append(at)
                at = end
                if at < n:
                    u = longest(s, at, n)
        if min(ids, default=0) < 0:
            return [x for u, i in zip(ids, starts, strict=True) for x in ([u] if u >= 0 else self._fallback(s[i]))]
        return ids

    def _longest_arc(self, s: str, at: int, n: int) -> int:
        """The longest piece from here; -1 (byte fallback) if there is none."""
        node, best = self.trie, -1
        while at < n:
            node = node.get(s[at])
            if node is None:
                break
            best = node.get(0, best)
            at += 1
        return best

    def _ids(self, s: str, back: list[tuple[int, int]]) -> list[int]:
        out, j = [], len(s)
        while j:
            i, u = back[j]
            out.append([u] if u >= 0 else self._fallback(s[i:j]))
            j = i
        return [x for ids in reversed(out) for x in ids]

    def _may_follow(self, pair: int, t: int, u: int) -> bool:
        a, b = self.pieces[t][0], self.pieces[u][0]
        may = self._merged(a + b) == [a, b]
        if len(self.follows) >= _FOLLOWS:
            self.follows.clear()
        self.follows[pair] = may
        return may

    def _merged(self, s: str) -> list[str]:
        """The merges of a short text: the best-scored pair first, the left one of equals."""
        parts, arcs, pieces = list(s), self.arcs, self.pieces
        while len(parts) > 1:
            top, at = -_INF, -1
            for k in range(len(parts) - 1):
                u = arcs.get(parts[k] + parts[k + 1])
                if u is not None and pieces[u][1] > top:
                    top, at = pieces[u][1], k
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    # output side ------------------------------------------------------------

    def decode(self, ids: array) -> str:
        """The inverse machine: ids to text; bytes that form no character become U+FFFD."""
        text = b"".join(map(self.texts.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text


_MACHINES: dict[int, Transducer] = {}


def _coder(model: Broadcast):
    schema = pa.schema([("doc_id", pa.int64()), ("n_ids", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string()), ("round_trip", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blob = model.value
        key = hash(blob)
        if key not in _MACHINES:
            _MACHINES[key] = Transducer(blob)
        machine = _MACHINES[key]
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                some = batch.slice(at, 1024)
                ids, back, same = [], [], []
                for text in some.column(1):
                    found = machine.encode(text.as_py())
                    ids.append(np.frombuffer(found, np.int32))
                    back.append(machine.decode(found))
                    same.append(back[-1] == text.as_py())
                sizes = np.fromiter(map(len, ids), np.int64, len(ids))
                offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
                lists = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(ids) if ids else np.empty(0, np.int32)))
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(sizes), lists, pa.array(back, pa.string()), pa.array(same, pa.bool_())], schema=schema)

    return run


def encode_decode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_ids, ids, decoded (the text made from the ids again) and round_trip (it is the text) of every row.

    A text that itself holds the space mark decodes to spaces there.  Null and empty texts have no ids and decode to an empty text.  Rows that
    repeat are encoded alike.  The model file (its path is the caller's) is
    read once by the driver and broadcast; its size is checked.
    """
    with open(model_path, "rb") as f:
        blob = f.read(MAX_MODEL_BYTES + 1)
    if len(blob) > MAX_MODEL_BYTES:
        raise ValueError(f"{model_path} has more than {MAX_MODEL_BYTES} bytes")
    model = docs.sparkSession.sparkContext.broadcast(blob)
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return given.mapInArrow(_coder(model), _ENCODED)
