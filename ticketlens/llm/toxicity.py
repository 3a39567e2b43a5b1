"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A document's features are the distinct hashed 1-grams, 2-grams and skip-grams
(one word left out) of its words, lower-cased and without punctuation at
their ends.  Words are hashed once each; the hashes of longer grams are made
from them for a whole batch of documents at a time.

Fitting: a bounded sample of labelled rows (each class, in hash order of
their ids) is hashed by the tasks and passed row by row through FTRL-proximal
on the driver: a learning rate per coordinate, L1 keeps all but some
hundred or thousand weights at zero.  Only those are broadcast.  Where one
class is drawn at a lower rate than the other, the bias is moved by the log of
the ratio of the rates, so scores refer to the labels' own mix at any size.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CELLS = 1 << 22
#: Labelled rows that are fitted on, at most, of each class.
SAMPLE_TOXIC = 6000
SAMPLE_CLEAN = 6000
_VOCABULARY = 1 << 18
_PAIR, _SKIP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)

_EDGES = re.compile(rb"^[!-/:-@\[-`{-~]+|[!-/:-@\[-`{-~]+$")


class _Words(dict):
    """word → hash of its lower-case form without ASCII punctuation at its ends (0: nothing left)."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _VOCABULARY:
            self.clear()
        core = _EDGES.sub(b"", word).decode().lower().encode()
        value = self[word] = xxhash.xxh64_intdigest(core) | 1 if core else 0
        return value


_WORDS = _Words()


def _grams(texts: Iterator[str]) -> tuple[np.ndarray, np.ndarray]:
    """(cells, documents) of every gram of the texts, not yet distinct."""
    lists = [t.encode().split() for t in texts]
    h = np.fromiter((_WORDS[w] for ws in lists for w in ws), np.uint64, sum(map(len, lists)))
    doc = np.repeat(np.arange(len(lists)), [len(ws) for ws in lists])
    held = h != 0
    h, doc = h[held], doc[held]
    cells, docs = [h], [doc]
    for gap, mark in ((1, _PAIR), (2, _SKIP)):
        same = doc[gap:] == doc[:-gap]
        cells.append(((h[:-gap] * mark) ^ (h[gap:] + (mark >> np.uint64(7))))[same])
        docs.append(doc[gap:][same])
    every = np.concatenate(cells)
    every = (every ^ (every >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (every >> np.uint64(64 - (CELLS.bit_length() - 1))).astype(np.int64), np.concatenate(docs)


@dataclass
class Ftrl:
    """FTRL-proximal for logistic loss over sets of cells.

    The defaults have the least log loss on a part of the training rows.
    """

    alpha: float = 2.0
    beta: float = 1.0
    l1: float = 8.0
    l2: float = 1.0
    passes: int = 6

    def fit(self, rows: list[np.ndarray], labels: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """(cells, weights, bias); the weights of all other cells are 0."""
        z, n = np.zeros(CELLS), np.zeros(CELLS)
        bias = bias_n = 0.0
        order = np.random.default_rng(7)
        for _ in range(self.passes):
            for i in order.permutation(len(rows)).tolist():
                at = rows[i]
                if not len(at):
                    continue
                w = self._weights(z[at], n[at])
                p = 1.0 / (1.0 + math.exp(-max(-35.0, min(35.0, bias + float(w.sum())))))
                g = p - float(labels[i])
                old = n[at]
                new = old + g * g
                z[at] += g - (np.sqrt(new) - np.sqrt(old)) / self.alpha * w
                n[at] = new
                bias_n += g * g
                bias -= 0.05 * g / math.sqrt(1.0 + bias_n)
        w = self._weights(z, n)
        kept = np.flatnonzero(w)
        return kept, w[kept].astype(np.float32), bias

    def _weights(self, z: np.ndarray, n: np.ndarray) -> np.ndarray:
        sure = np.maximum(np.abs(z) - self.l1, 0.0)
        return -np.sign(z) * sure / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)


def _hasher(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            some = batch.slice(at, 256)
            cells, docs = _grams(some.column(1).to_pylist())
            order = np.argsort(docs, kind="stable")
            ends = np.searchsorted(docs[order], np.arange(some.num_rows + 1))
            sets = [np.unique(cells[order[a:b]]).astype("<i4").tobytes() for a, b in zip(ends, ends[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([some.column(0), some.column(2), pa.array(sets, pa.binary())], names=["doc_id", "label", "cells"])


def fit(labelled: DataFrame, ftrl: Ftrl | None = None) -> tuple[np.ndarray, np.ndarray, float]:
    """Weights from rows (doc_id, text, label 0 or 1); rows without a label are left out."""
    rows = labelled.where("label in (0, 1)").select(F.col("doc_id"), F.coalesce("text", F.lit("")).alias("text"), F.col("label").cast("int"))
    found = rows.mapInArrow(_hasher, "doc_id long, label int, cells binary").collect()
    found.sort(key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, bytes(r["cells"]), r["label"]))
    return (ftrl or Ftrl()).fit([np.frombuffer(r["cells"], "<i4") for r in found], np.array([r["label"] for r in found]))


def _scorer(model: Broadcast):
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("n_hits", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, values, bias = model.value
        weights = np.zeros(CELLS, np.float32)
        weights[cells] = values
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                some = batch.slice(at, 512)
                found, docs = _grams(some.column(1).to_pylist())
                hit = np.flatnonzero(weights[found])
                pairs = np.unique(docs[hit] * CELLS + found[hit])  # a cell counts once a document
                owner = pairs // CELLS
                total = bias + np.bincount(owner, weights[pairs % CELLS].astype(np.float64), some.num_rows)
                score = 1.0 / (1.0 + np.exp(-np.clip(total, -35, 35)))
                columns = [some.column(0), pa.array(score), pa.array(np.bincount(owner, minlength=some.num_rows))]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run


def _given(labels: DataFrame) -> DataFrame:
    """One row for each different labelling of an id."""
    return labels.select(F.col("doc_id").alias("__id"), F.col("label").alias("__label")).where("__label in (0, 1) and __id is not null").distinct()


def sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text, label of at most SAMPLE_TOXIC + SAMPLE_CLEAN labelled rows, in hash order of their ids."""
    given = _given(labels)
    ordered = lambda y, n: given.where(F.col("__label") == y).orderBy(F.xxhash64("__id"), "__id").limit(n)
    chosen = ordered(1, SAMPLE_TOXIC).union(ordered(0, SAMPLE_CLEAN))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.join(F.broadcast(chosen), F.col("doc_id") == F.col("__id")).select("doc_id", "text", F.col("__label").alias("label"))


def rate_shift(toxic: int, clean: int) -> float:
    """What the sampling adds to the log odds: the log of the toxic rows' rate over the clean rows' rate."""
    rate = lambda held, most: min(1.0, most / held) if held else 1.0
    return math.log(rate(toxic, SAMPLE_TOXIC) / rate(clean, SAMPLE_CLEAN))


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score (0 to 1), n_hits (weighted features found) for every row of docs.

    ``labels``: doc_id and label (0, 1 or null).  Texts are the only input of
    a score; null and empty texts get the bias alone.  Rows that repeat are
    scored alike; where the fitted rows hold one class only, or none, all
    scores stay on that class's side or at 0.5.
    """
    cells, weights, bias = fit(sample(docs, labels, id_col, text_col))
    of = {r["__label"]: r["count"] for r in _given(labels).groupBy("__label").count().collect()}
    bias -= rate_shift(of.get(1, 0), of.get(0, 0))
    model = docs.sparkSession.sparkContext.broadcast((cells, weights, bias))
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return given.mapInArrow(_scorer(model), "doc_id long, score double, n_hits long")
