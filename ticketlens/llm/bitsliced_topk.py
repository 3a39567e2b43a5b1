"""Exact top-k search by inner product over a bit-sliced index.

The index keeps blocks of vectors as bitmaps: for every component, one bitmap
per bit of its (offset, so non-negative) quantised value.  A query adds the
slices, shifted by the set bits of its own components, into a bit-sliced sum
with carry-save adders, so one machine word adds 64 vectors at once.  The top
rows are then found from the most significant slice of the sum downward: rows
that are certain to be in, rows on the border; the border is resolved by the
smaller id.

Blocks of the index are small (a bit per component and slice, no vectors) and
query blocks large, so that an index block is sent to few tasks; neither side
is broadcast and only k rows per query and block leave a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticketlens.llm.common import written

SCALE = 1024
K = 10
#: Vectors in a block of the index and queries in a block of queries, about.
INDEX_BLOCK = 16384
QUERY_BLOCK = 8192
#: Quantised components are below this in size, so differences of two fit 64 bits.
LIMIT = 1 << 62

_SCORED = "query_id long, vec_id long, score long"


def quantised(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, x: floor(SCALE * component) of the vectors that take part.

    Null ids, null vectors and vectors with a null or non-finite component do
    not.  A finite component whose quantised value is LIMIT or more fails the query.
    """
    scaled = lambda c: c.cast("double") * SCALE
    too_large = F.raise_error(F.lit("a vector's component is too large for 64 bits")).cast("bigint")
    x = F.transform(F.col(vector_col), lambda c: F.when(F.abs(scaled(c)) < F.lit(float(LIMIT)), F.floor(scaled(c))).otherwise(too_large))
    # a comparison with a null component is not true, nor is one of NaN, the largest number, or infinity
    fine = F.forall(vector_col, lambda c: F.coalesce(F.abs(c.cast("double")) < F.lit(float("inf")), F.lit(False)))
    kept = F.when(fine, x)
    rows = df.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).select(F.col(id_col).cast("long").alias("vec_id"), kept.alias("x"))
    return rows.where(F.col("x").isNotNull())


def slices(x: np.ndarray) -> tuple[np.ndarray, int]:
    """Bitmaps (component, bit, words) of the rows' components less the offset, and that offset."""
    low = int(x.min(initial=0))
    up = (x - np.int64(low)).astype(np.uint64)
    n_bits = max(1, int(up.max(initial=0)).bit_length())
    rows = np.zeros((x.shape[1], n_bits, -(-len(x) // 64) * 64), np.uint8)
    for b in range(n_bits):
        rows[:, b, : len(x)] = ((up >> np.uint64(b)) & np.uint64(1)).T
    return np.packbits(rows, axis=2, bitorder="little").view("<u8"), low


class Sum:
    """A bit-sliced sum of many bitmaps, added with carry-save counters.

    ``pending[b]`` holds up to two bitmaps of weight 2**b; a third one is
    folded with them by a full adder into one of that weight and a carry.
    """

    def __init__(self, words: int):
        self.words = words
        self.pending: list[list[np.ndarray]] = []

    def add(self, bitmap: np.ndarray, bit: int) -> None:
        while True:
            while len(self.pending) <= bit:
                self.pending.append([])
            held = self.pending[bit]
            if len(held) < 2:
                held.append(bitmap)
                return
            a, b = held
            half = a ^ b
            held[:] = [half ^ bitmap]
            bitmap = (a & b) | (half & bitmap)
            bit += 1

    def total(self) -> np.ndarray:
        """The sum's slices (bit, words): what is pending is added bit by bit."""
        out, bit = [], 0
        while bit < len(self.pending):
            held = self.pending[bit]
            while len(held) > 1:
                a, b = held.pop(), held.pop()
                held.append(a ^ b)
                self.add_carry(a & b, bit + 1)
            out.append(held[0] if held else np.zeros(self.words, np.uint64))
            bit += 1
        return np.array(out) if out else np.zeros((1, self.words), np.uint64)

    def add_carry(self, bitmap: np.ndarray, bit: int) -> None:
        while len(self.pending) <= bit:
            self.pending.append([])
        self.pending[bit].append(bitmap)
        while len(self.pending[bit]) > 2:
            a, b, c = (self.pending[bit].pop() for _ in range(3))
            half = a ^ b
            self.pending[bit].append(half ^ c)
            self.add_carry((a & b) | (half & c), bit + 1)


def _bits(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def top_rows(total: np.ndarray, alive: np.ndarray, k: int) -> np.ndarray:
    """Rows of the k largest sums among the alive ones; of equal sums on the border, those that come first."""
    sure, border, n_sure = np.zeros_like(alive), alive.copy(), 0
    for plane in total[::-1]:
        ones = border & plane
        n = int(np.bitwise_count(ones).sum())
        if n_sure + n > k:
            border = ones
        else:
            sure, n_sure = sure | ones, n_sure + n
            border &= ~plane
            if n_sure == k:
                return _bits(sure)
    return np.concatenate([_bits(sure), _bits(border)[: k - n_sure]])


def _values(total: np.ndarray, rows: np.ndarray) -> list[int]:
    """The sums of some rows, read from the slices, however many bits they have."""
    bits = (total[:, rows // 64] >> (rows % 64).astype(np.uint64)) & np.uint64(1)
    if len(total) < 63:
        return (bits << np.arange(len(total), dtype=np.uint64)[:, None]).sum(axis=0, dtype=np.uint64).tolist()
    return [sum(1 << b for b in np.flatnonzero(column).tolist()) for column in bits.T]


def search(ids: np.ndarray, bitmaps: np.ndarray, low: int, queries: np.ndarray, query_ids: np.ndarray, k: int) -> Iterator[tuple]:
    """query id, vector ids and scores of the block's k best rows for each query (rows in order of id)."""
    words = -(-len(ids) // 64)
    alive_all = np.packbits(np.arange(words * 64) < len(ids), bitorder="little").view("<u8")
    for q, query_id in zip(queries, query_ids.tolist(), strict=True):
        sums = Sum(words), Sum(words)
        for d, v in enumerate(q.tolist()):
            into, size, bit = sums[v < 0], abs(v), 0
            while size:
                if size & 1:
                    for b in range(bitmaps.shape[1]):
                        into.add(bitmaps[d, b], bit + b)
                size >>= 1
                bit += 1
        plus, minus = (s.total() for s in sums)
        own = np.flatnonzero(ids == query_id)
        alive = alive_all.copy()
        np.bitwise_and.at(alive, own // 64, ~(np.uint64(1) << (own % 64).astype(np.uint64)))
        rows = top_rows(_less(plus, minus), alive, k)
        if len(rows):
            offset = low * sum(q.tolist())
            # a score beyond 64 bits is an OverflowError
            scores = np.array([p - m + offset for p, m in zip(_values(plus, rows), _values(minus, rows), strict=True)], np.int64)
            yield query_id, ids[rows], scores


def _less(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a - b bit by bit, plus a constant that keeps it non-negative: a + ~b has the same order as a - b."""
    n = max(len(a), len(b))
    words = a.shape[1]
    out, carry, ones = [], np.zeros(words, np.uint64), ~np.zeros(words, np.uint64)
    for i in range(n):
        p = a[i] if i < len(a) else np.zeros(words, np.uint64)
        m = ~b[i] if i < len(b) else ones
        half = p ^ m
        out.append(half ^ carry)
        carry = (p & m) | (half & carry)
    return np.array([*out, carry])


def _matrix(cells: pa.Array) -> np.ndarray:
    flat = cells.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(cells), len(flat) // max(len(cells), 1))


def _indexer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of vectors → blocks of the index: rows in order of id, with their bitmaps."""
    for batch in batches:
        for row in range(batch.num_rows):
            dim, block, ids, xs = (batch.column(c)[row] for c in range(4))
            ids, x = ids.values.to_numpy(), _matrix(xs.values)
            order = np.argsort(ids, kind="stable")
            ids, x = ids[order], x[order]
            bitmaps, low = slices(x)
            values = [[dim.as_py()], [block.as_py()], [ids], [low], [bitmaps.shape[1]], [bitmaps.tobytes()]]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, _INDEX_TYPES, strict=True)], names=_INDEX_NAMES)


_INDEX = "dim int, block long, ids array<long>, low long, bits int, bitmaps binary"
_INDEX_NAMES = [c.split()[0] for c in _INDEX.split(", ")]
_INDEX_TYPES = [pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.int32(), pa.binary()]


def _searcher(k: int):
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        """One block of the index with one block of queries."""
        out = []
        for index in left.to_pylist():
            ids = np.array(index["ids"], np.int64)
            bitmaps = np.frombuffer(index["bitmaps"], "<u8").reshape(index["dim"], index["bits"], -(-len(ids) // 64))
            for asked in right.to_batches():
                for qids, qs in zip(asked.column("qids"), asked.column("qs"), strict=True):
                    q = _matrix(qs.values).astype(np.int64)
                    out += search(ids, bitmaps, index["low"], q, qids.values.to_numpy(), k)
        counts = [len(v) for _, v, _ in out]
        cols = [np.repeat([f[0] for f in out], counts), *(np.concatenate([f[c] for f in out]) for c in (1, 2))] if out else [[]] * 3
        return pa.table([pa.array(c, pa.int64()) for c in cols], schema=schema)

    return run


def _blocks(rows: DataFrame, size: int) -> DataFrame:
    """Rows gathered into hashed blocks of about ``size`` vectors of one length (dim)."""
    rows = rows.withColumn("dim", F.size("x"))
    counts = rows.groupBy("dim").count().select(F.col("dim").alias("d"), F.ceil(F.col("count") / size).cast("long").alias("n"))
    # one row per length of a vector is broadcast
    dealt = rows.join(F.broadcast(counts), F.col("dim") == F.col("d")).withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("n")))
    return dealt.groupBy("dim", "block").agg(F.collect_list(F.struct("vec_id", "x")).alias("rows")).select("dim", "block", F.col("rows.vec_id").alias("ids"), F.col("rows.x").alias("xs"))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding", index_block: int = INDEX_BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k highest inner products, ties to the smaller id.

    A row is no candidate of its own id; a query meets the vectors that have
    as many components as it has; a query row that repeats is one query, a
    vector row that repeats may be listed for each copy.  Fewer than k
    candidates: all of them.  Vectors with null or non-finite components take no
    part on either side; all others do, whatever the size of their components.
    A component or a listed score that does not fit 64 bits fails the query.
    """
    index = written(_blocks(quantised(vectors, id_col, vector_col), index_block).mapInArrow(_indexer, _INDEX), "index")
    asked = _blocks(quantised(queries, id_col, vector_col).dropDuplicates(["vec_id"]), query_block)
    asked = written(asked.select("dim", F.col("block").alias("asked"), F.col("ids").alias("qids"), F.col("xs").alias("qs")), "queries")
    # each query block meets every index block of its vectors' length
    of_index, of_queries = (df.groupBy("dim").agg(F.collect_list(c).alias(to)) for df, c, to in ((index, "block", "to"), (asked, "asked", "by")))
    sent = asked.join(of_index, "dim").select("dim", "asked", "qids", "qs", F.explode("to").alias("block"))
    held = index.join(of_queries, "dim").select(*index.columns, F.explode("by").alias("asked"))
    cell = ["dim", "block", "asked"]
    scored = held.groupBy(*cell).cogroup(sent.groupBy(*cell)).applyInArrow(_searcher(k), _SCORED)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
