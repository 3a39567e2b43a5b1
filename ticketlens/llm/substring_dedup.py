"""Substring dedup: Rabin-Karp hashes of every fixed-length token window.

1. Per task, texts are cut into words and each word gets a 64-bit hash; the
   hashes of all windows follow from prefix sums of a polynomial modulo 2**64
   (odd base, so it can be divided out again).
2. Every window goes to the partition its hash names, packed as 7 bytes per
   window; document ids are sent once per task and partition, not per window.
   Windows that a task has seen in a smaller id already are settled there, so
   a passage that a third of all documents share costs one entry per task.
3. Each partition counts its windows by hash; those that occur in a smaller
   document go back, as hashes packed by destination, to the partitions that
   the documents themselves are dealt to by id.
4. Each document marks the windows, and overlapping ones merge into maximal
   removal intervals.

A window is told apart by 56 bits and its partition (62 bits at 64
partitions); within one document, by 56 bits.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketlens.llm.common import NULL_ID, partitions

WINDOW = 13
#: Words hashed at once in a task, which bounds its memory (a longer document is taken alone).
CHUNK_WORDS = 1 << 20
_VOCABULARY = 1 << 19
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_LOW = np.uint64((1 << 56) - 1)

_SENT = "part int, settled boolean, ids binary, counts binary, hashes binary"
_KEPT = "doc_id long, n_words long, n_removed long, removed array<struct<start:int,end:int>>, kept string"


class WordHashes(dict):
    """word → 64-bit hash, remembered for up to a fixed number of words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _VOCABULARY:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_WORDS = WordHashes()


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Polynomial hash of each window of ``width`` word hashes, by prefix sums."""
    n = len(words)
    if n < width:
        return np.empty(0, np.uint64)
    powers = np.full(n, _BASE, np.uint64)
    powers[0] = 1
    powers = np.cumprod(powers, dtype=np.uint64)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(words * powers, dtype=np.uint64, out=sums[1:])
    back = np.full(n - width + 1, _INVERSE, np.uint64)
    back[0] = 1
    back = np.cumprod(back, dtype=np.uint64)
    h = (sums[width:] - sums[:-width]) * back
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def _word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))


def _pack(hashes: np.ndarray) -> bytes:
    """7 bytes each: the low 56 bits."""
    return np.ascontiguousarray(hashes, "<u8").view(np.uint8).reshape(-1, 8)[:, :7].tobytes()


def _unpack(blob: bytes) -> np.ndarray:
    wide = np.zeros((len(blob) // 7, 8), np.uint8)
    wide[:, :7] = np.frombuffer(blob, np.uint8).reshape(-1, 7)
    return wide.reshape(-1).view("<u8")


def _numbers(values: np.ndarray) -> bytes:
    """Non-negative numbers in the fewest whole bytes (1, 2, 4 or 8), with that width in front."""
    top = int(values.max(initial=0))
    width = 1 if top < 1 << 8 else 2 if top < 1 << 16 else 4 if top < 1 << 32 else 8
    return bytes([width]) + values.astype(f"<u{width}").tobytes()


def _read_numbers(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, f"<u{blob[0]}", offset=1)


def _ids(ids: np.ndarray) -> bytes:
    """Ascending ids: the first, then the gaps."""
    return ids[:1].astype("<i8").tobytes() + _numbers(np.diff(ids.astype(np.uint64)))


def _read_ids(blob: bytes) -> np.ndarray:
    first = np.frombuffer(blob, "<u8", 1)
    gaps = _read_numbers(blob[8:]).astype(np.uint64)
    return np.cumsum(np.concatenate([first, gaps]), dtype=np.uint64).astype(np.int64)


def _send(docs: list[tuple[int, np.ndarray]], n_parts: int, width: int) -> Iterator[tuple]:
    """The rows that leave a task for some documents' (id, word hashes)."""
    docs.sort(key=lambda d: d[0])
    lengths = np.array([len(w) for _, w in docs])
    ids, rank = np.unique(np.array([i for i, _ in docs], np.int64), return_inverse=True)
    every = window_hashes(np.concatenate([w for _, w in docs]), width)
    ends = np.cumsum(lengths)
    doc = np.repeat(np.arange(len(docs)), lengths)[: len(every)]
    inside = np.arange(len(every)) + width <= ends[doc]
    h, owner = every[inside], rank[doc[inside]]
    order = np.argsort(h, kind="stable")  # owners ascend within equal hashes
    h, owner = h[order], owner[order]
    new = np.ones(len(h), bool)
    new[1:] = h[1:] != h[:-1]
    group = np.cumsum(new) - 1
    least = owner[np.flatnonzero(new)][group] if len(h) else owner
    again = np.zeros(len(h), bool)
    again[1:] = ~new[1:] & (owner[1:] == owner[:-1])
    later = (owner > least) & ~again
    dest = _destination(ids.tolist(), n_parts)
    yield from _packed(dest[owner[later]], True, ids, owner[later], h[later])
    h, owner = h[new], owner[new]
    part = ((h >> np.uint64(32)) * np.uint64(n_parts)) >> np.uint64(32)
    yield from _packed(part.astype(np.int64), False, ids, owner, h)


def _destination(ids: list[int], n_parts: int) -> np.ndarray:
    """The partition that a document is dealt to: as the SQL function crc32 has it."""
    return np.array([zlib.crc32(str(i).encode()) % n_parts for i in ids], np.int64)


def _packed(part: np.ndarray, settled: bool, ids: np.ndarray, owner: np.ndarray, h: np.ndarray) -> Iterator[tuple]:
    """One row for each part: the owners' ids, their numbers of windows, the windows."""
    order = np.lexsort((owner, part))
    h, owner, part = h[order], owner[order], part[order]
    cuts = np.flatnonzero(np.diff(part)) + 1
    for a, b in zip([0, *cuts], [*cuts, len(part)], strict=True):
        if a < b:
            held, counts = np.unique(owner[a:b], return_counts=True)
            yield int(part[a]), settled, _ids(ids[held]), _numbers(counts), _pack(h[a:b])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


_SENT_ARROW = pa.schema([("part", pa.int32()), ("settled", pa.bool_()), ("ids", pa.binary()), ("counts", pa.binary()), ("hashes", pa.binary())])
_KEPT_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
     ("removed", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), ("kept", pa.string())]
)


def _sender(n_parts: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for id_, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = text.as_py().encode().split()
                if len(words) < width:
                    continue
                held.append((id_, _word_hashes(words)))
                size += len(words)
                if size >= CHUNK_WORDS:
                    yield _batch(list(_send(held, n_parts, width)), _SENT_ARROW)
                    held, size = [], 0
        if held:
            yield _batch(list(_send(held, n_parts, width)), _SENT_ARROW)

    return run


def _counter(n_parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One partition: sends on the windows that a smaller id holds too."""
        ids, hashes = [], []
        for batch in batches:
            settled = []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[1]:
                    settled.append(row)
                else:
                    ids.append(np.repeat(_read_ids(row[2]), _read_numbers(row[3])))
                    hashes.append(_unpack(row[4]))
            if settled:
                yield _batch(settled, _SENT_ARROW)
        if not ids:
            return
        owner, h = np.concatenate(ids), np.concatenate(hashes)
        ids.clear(), hashes.clear()
        order = np.argsort(h)
        h, owner = h[order], owner[order]
        starts = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        counts = np.diff(np.append(starts, len(h)))
        flagged = owner > np.repeat(np.minimum.reduceat(owner, starts), counts)
        known, rank = np.unique(owner[flagged], return_inverse=True)
        rows = list(_packed(_destination(known.tolist(), n_parts)[rank], True, known, rank, h[flagged]))
        for at in range(0, len(rows), 1000):
            yield _batch(rows[at : at + 1000], _SENT_ARROW)

    return run


def _remover(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One partition: first the flagged windows of its documents, then the documents."""
        flags: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            rows = []
            for kind, id_, doc_id, text, ids, counts, blob in zip(*batch.columns, strict=True):
                if not kind.as_py():
                    ends = np.cumsum(_read_numbers(counts.as_py()).astype(np.int64))
                    for key, some in zip(_read_ids(ids.as_py()).tolist(), np.split(_unpack(blob.as_py()), ends[:-1]), strict=True):
                        flags.setdefault(key, []).append(some)
                    continue
                words = text.as_py().encode().split()
                spans: list[dict] = []
                removed = 0
                flagged = flags.get(id_.as_py())
                if flagged and len(words) >= width:
                    at = np.flatnonzero(np.isin(window_hashes(_word_hashes(words), width) & _LOW, np.concatenate(flagged)))
                    if len(at):  # windows that overlap or touch make one interval
                        cuts = np.flatnonzero(np.diff(at) > width) + 1
                        starts, ends = at[[0, *cuts]], at[[*(cuts - 1), -1]] + width
                        gone = np.zeros(len(words) + 1, np.int32)
                        gone[starts] += 1
                        gone[ends] -= 1
                        gone = np.cumsum(gone[:-1]) > 0
                        spans = [{"start": s, "end": e} for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]
                        removed = int(gone.sum())
                        words = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
                rows.append((doc_id.as_py(), len(words) + removed, removed, spans, b" ".join(words).decode()))
            if rows:
                yield _batch(rows, _KEPT_ARROW)

    return run


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WINDOW) -> DataFrame:
    """Remove every word covered by a window that also starts in a document with a smaller id.

    Words are ``[^\\x20\\x09-\\x0D]+``.  Windows are judged on the input.
    Returns doc_id, n_words, n_removed, removed (maximal intervals of word
    positions, end exclusive) and kept (the kept words, one space between).

    Null and empty texts have no words.  A null id counts as larger than any
    other; rows that share an id (or have none) never remove each other's
    words but lose the same windows.  A text shorter than a window keeps all.
    An empty table gives an empty result.
    """
    spark = docs.sparkSession
    n_parts = partitions(spark)
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    key = F.coalesce("doc_id", F.lit(NULL_ID))
    sent = given.select(key.alias("id"), "text").mapInArrow(_sender(n_parts, width), _SENT)
    flagged = sent.repartitionById(n_parts, F.col("part")).mapInArrow(_counter(n_parts), _SENT)
    own = given.select(F.pmod(F.crc32(key.cast("string")), F.lit(n_parts)).cast("int").alias("part"), F.lit(1).alias("kind"), key.alias("id"), "doc_id", "text")
    both = own.unionByName(flagged.drop("settled").withColumn("kind", F.lit(0)), allowMissingColumns=True)
    dealt = both.repartitionById(n_parts, F.col("part")).sortWithinPartitions("kind")
    return dealt.select("kind", "id", "doc_id", "text", "ids", "counts", "hashes").mapInArrow(_remover(width), _KEPT)
