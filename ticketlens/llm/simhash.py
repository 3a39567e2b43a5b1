"""SimHash near-dedup with bit-sliced comparison.

Fingerprints are made once and written as a narrow table; equal ones collapse
to one row.  64 bits are cut into ``BLOCKS`` blocks: two fingerprints at most
``radius`` bits apart agree on at least BLOCKS - radius whole blocks, so every
choice of that many blocks is a join key and no link is lost.  Rows that share
a key are compared where they lie: the bits are stored as vertical planes (bit
b of 64 rows in one word), the planes of all rows are compared with those of
the rows s places further on, differing bits are added up by carry-save
counters for 64 pairs per machine word, and words in which every pair has
passed the radius are dropped before the remaining planes.

A key's rows are cut into chunks of bounded size, each pair of chunks being a
task's work of its own, so no group has to fit in one task.  Each chunk
pair reports a spanning forest of the links it found, not all pairs;
components follow by rounds of contraction.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketlens.llm.common import partitions, written

SHINGLE = 4
RADIUS = 4
BLOCKS = 6
#: Rows of one key compared by one task at once.
CHUNK = 2048
_SEED = 42
_WORDS_AT_ONCE = 1 << 14

_EDGE_ARROW = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of the text's word shingles (0 without words)."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        hashes = [digest(joined, _SEED)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.concatenate([[0], ends[:-1]])
        hashes = [digest(joined[a:b], _SEED) for a, b in zip(starts[: len(words) - shingle + 1].tolist(), (ends[shingle - 1 :] - 1).tolist(), strict=True)]
    total = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        some = np.array(hashes[at : at + (1 << 16)], "<u8")
        total += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprinter(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((fingerprint(t.as_py(), shingle) for t in batch.column(0)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([pa.array(fps.view(np.int64)), *batch.columns[1:]], names=["fp", *batch.schema.names[1:]])

    return run


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, row: Column | None = None) -> DataFrame:
    """fp (the 64 bits as a signed long), doc_id and, where it is given, the binary column ``row``."""
    given = docs.select(F.col(text_col).alias("text"), F.col(id_col).cast("long").alias("doc_id"), *([] if row is None else [row.alias("row")]))
    return given.mapInArrow(_fingerprinter(shingle), "fp long, doc_id long" + ("" if row is None else ", row binary"))


def _planes(fps: np.ndarray) -> np.ndarray:
    """64 planes of one bit per row, 64 rows to a word, one spare word at the end."""
    n = -(-len(fps) // 64) + 1
    bits = np.zeros((n * 64, 64), np.uint8)
    bits[: len(fps)] = np.unpackbits(np.ascontiguousarray(fps, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little")).view("<u8")


def _bit_rows(words: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Row numbers of the set bits of words that lie at the word numbers ``at``."""
    some = np.flatnonzero(words)
    bits = np.unpackbits(np.ascontiguousarray(words[some], "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    row, bit = np.nonzero(bits)
    return at[some[row]] * 64 + bit


def _within(planes: np.ndarray, other: np.ndarray, shift: int, at: np.ndarray, alive: np.ndarray, radius: int) -> tuple:
    """Pairs (row i of planes, row i + shift of other) at most radius bits apart.

    at: the words to look at; alive: for each, the rows that have a partner.
    """
    word, bit = divmod(shift, 64)
    n_counters = max(1, radius.bit_length())
    counters = [np.zeros(len(at), np.uint64) for _ in range(n_counters)]
    over = ~alive
    for b in range(64):
        moved = other[b, at + word]
        if bit:
            moved = (moved >> np.uint64(bit)) | (other[b, at + word + 1] << np.uint64(64 - bit))
        carry = planes[b, at] ^ moved
        for c in range(n_counters):
            counters[c], carry = counters[c] ^ carry, counters[c] & carry
        over |= carry
        if b % 8 == 7:  # abandon the words in which every pair is over the radius
            over |= _exceeds(counters, radius)
            left = np.flatnonzero(~over)
            if len(left) < 0.7 * len(at):
                at, over, counters = at[left], over[left], [c[left] for c in counters]
                if not len(at):
                    break
    return at, ~(over | _exceeds(counters, radius))


def _exceeds(counters: list[np.ndarray], radius: int) -> np.ndarray:
    """Where the counters, read as binary numbers, are above radius."""
    more = np.zeros_like(counters[0])
    equal = ~more
    for c in range(len(counters) - 1, -1, -1):
        if radius >> c & 1:
            equal &= counters[c]
        else:
            more |= equal & counters[c]
            equal &= ~counters[c]
    return more


def _shifted(planes: np.ndarray, other: np.ndarray, ends: np.ndarray, first: int, radius: int) -> Iterator[tuple]:
    """Close pairs (i, j): row i of planes with each row j of other from i + first below ends[i]."""
    n_words = planes.shape[1]
    spare = np.zeros((64, 1), other.dtype)
    other = np.concatenate([other, spare], axis=1)
    span = np.zeros((n_words * 64,), np.int64)
    span[: len(ends)] = np.maximum(ends - np.arange(len(ends)), 0)
    longest = span.reshape(-1, 64).max(axis=1)
    for shift in range(first, int(span.max(initial=0))):
        at = np.flatnonzero(longest > shift)
        for k in range(0, len(at), _WORDS_AT_ONCE):
            some = at[k : k + _WORDS_AT_ONCE]
            alive = np.packbits(span.reshape(-1, 64)[some] > shift, axis=1, bitorder="little").view("<u8").reshape(-1)
            left, close = _within(planes, other, shift, some, alive, radius)
            rows = _bit_rows(close, left)
            if len(rows):
                yield rows, rows + shift


def _forest(a: np.ndarray, b: np.ndarray, root: dict) -> list[tuple[int, int]]:
    """Those of the links that join two trees so far apart."""
    new = []
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        p, q = x, y
        while (r := root.get(p, p)) != p:
            root[p] = root.get(r, r)
            p = r
        while (r := root.get(q, q)) != q:
            root[q] = root.get(r, r)
            q = r
        if p != q:
            root[max(p, q)] = min(p, q)
            new.append((x, y))
    return new


def close_rows(fps: np.ndarray, group: np.ndarray, radius: int = RADIUS) -> list[tuple[int, int]]:
    """A spanning forest, as fingerprints, of the links within runs of equal group."""
    n = len(fps)
    starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if n else np.empty(0, int)
    ends = np.repeat(np.append(starts[1:], n), np.diff(np.append(starts, n))) if n else starts
    planes, root, out = _planes(fps), {}, []
    signed = fps.view(np.int64)
    for a, b in _shifted(planes, planes, ends, 1, radius):
        out += _forest(signed[a], signed[b], root)
    return out


def close_between(left: np.ndarray, right: np.ndarray, radius: int = RADIUS) -> list[tuple[int, int]]:
    """A spanning forest of the links between two chunks: every row of one with every row of the other."""
    root, out = {}, []
    a, b = left.view(np.int64), right.view(np.int64)
    planes = _planes(left)
    twice = np.concatenate([right, right])  # row i meets right[i + s] for s below len(right)
    for k in range(0, len(left), len(right)):
        part = left[k : k + len(right)]
        ends = np.arange(len(part)) + len(right)
        for x, y in _shifted(_planes(part) if k or len(part) < len(left) else planes, _planes(twice), ends, 0, radius):
            out += _forest(a[k + x], b[y % len(right)], root)
    return out


def _comparer(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by (key, i, j, side): one group after the other."""
        rest = None
        for batch in batches:
            cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if rest is not None:
                cols = [np.concatenate([r, c]) for r, c in zip(rest, cols, strict=True)]
            last = np.flatnonzero((cols[0] != cols[0][-1]) | (cols[1] != cols[1][-1]) | (cols[2] != cols[2][-1]))
            cut = last[-1] + 1 if len(last) else 0
            rest = [c[cut:] for c in cols]
            if cut:
                yield _edges([c[:cut] for c in cols], radius)
        if rest is not None:
            yield _edges(rest, radius)

    return run


def _edges(cols: list[np.ndarray], radius: int) -> pa.RecordBatch:
    key, i, j, side, fp = cols
    fp = np.ascontiguousarray(fp).view(np.uint64)
    out = []
    same = i == j
    if same.any():
        chunk = np.concatenate([[0], np.cumsum((key[same][1:] != key[same][:-1]) | (i[same][1:] != i[same][:-1]))])
        out += close_rows(fp[same], chunk, radius)
    if not same.all():
        at = np.flatnonzero(~same)
        cuts = np.flatnonzero((np.diff(key[at]) != 0) | (np.diff(i[at]) != 0) | (np.diff(j[at]) != 0)) + 1
        for some in np.split(at, cuts):
            out += close_between(fp[some[side[some] == 0]], fp[some[side[some] == 1]], radius)
    a, b = (list(x) for x in zip(*out, strict=True)) if out else ([], [])
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], schema=_EDGE_ARROW)


def links(distinct: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, chunk: int = CHUNK) -> DataFrame:
    """Links a, b between distinct fingerprints (column fp) that together connect all pairs within the radius."""
    edges = [round(64 * k / blocks) for k in range(blocks + 1)]
    masks = []
    for chosen in combinations(range(blocks), blocks - radius):
        mask = sum(((1 << edges[k + 1]) - (1 << edges[k])) for k in chosen)
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    keys = [F.xxhash64(F.lit(n), F.col("fp").bitwiseAND(F.lit(m))) for n, m in enumerate(masks)]
    rows = distinct.select("fp", F.explode(F.array(*keys)).alias("key"))
    sizes = written(rows.groupBy("key").count().where("count > 1"), "key-sizes")
    parts = F.ceil(F.col("count") / F.lit(chunk)).cast("int")
    mine = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    # chunk c meets (c, c) and every other chunk: as side 0 those after it, as side 1 those before it
    met = F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1),
        lambda o: F.struct(F.least(o, F.col("mine")).alias("i"), F.greatest(o, F.col("mine")).alias("j"), (o < F.col("mine")).cast("int").alias("side")),
    )
    pairs = (
        rows.join(sizes.select("key", parts.alias("parts")), "key")
        .select("key", "fp", "parts", mine.alias("mine"))
        .select("key", "fp", F.explode(met).alias("m"))
        .select("key", "m.i", "m.j", "m.side", "fp")
        .repartition(partitions(distinct.sparkSession), "key", "i", "j")
        .sortWithinPartitions("key", "i", "j", "side", "fp")
    )
    return pairs.mapInArrow(_comparer(radius), "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """node, root (one node of the component, the same for all of them) for the nodes of the links a, b.

    Each round maps every node to the neighbour, or itself, that is first in
    a hash order of that round's own, and the links to links of the images:
    about half of the nodes go each round, whatever the shape of the graph.
    The maps are written tables; applied one after the other they give the root.
    """
    links = written(edges.where("a <> b").distinct(), "links")
    maps: list[DataFrame] = []
    while not links.isEmpty():
        order = F.lit(len(maps))
        both = links.union(links.select("b", "a"))
        first = both.groupBy("a").agg(F.min(F.struct(F.xxhash64(order, "b").alias("h"), F.col("b").alias("n"))).alias("m"))
        own = F.struct(F.xxhash64(order, "a").alias("h"), F.col("a").alias("n"))
        maps.append(written(first.select("a", F.least("m", own)["n"].alias("to")), "map"))
        left, right = maps[-1].toDF("a", "x"), maps[-1].toDF("b", "y")
        moved = links.join(left, "a").join(right, "b").where("x <> y")
        links = written(moved.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "links")
    if not maps:
        return links.toDF("node", "root")
    found = maps[-1].toDF("node", "root")
    for step in reversed(maps[:-1]):
        found = step.join(found, step["to"] == found["node"], "left").select(step["a"].alias("node"), F.coalesce("root", "to").alias("root"))
    return found


def _rooted(made: DataFrame, radius: int) -> DataFrame:
    """fp, least (the smallest id that has it) and root (a fingerprint that names its component) of the distinct fingerprints."""
    distinct = made.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(links(distinct.select("fp"), radius))
    named = distinct.join(roots, distinct.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    return written(named, "named")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """doc_id, fp, component_id (the smallest id reachable over links of at most radius bits).

    A null text, and a text without words, has fingerprint 0 and is linked
    like any other.  Null ids are kept and never name a component unless no
    other id is in it (then it is null).  Rows that repeat an id are rows of
    their own.  An empty table gives an empty result.
    """
    made = written(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    named = _rooted(made, radius)
    ids = written(named.groupBy("root").agg(F.min("least").alias("component_id")), "component-ids")
    return made.join(named.join(ids, "root").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def _row_key(docs: DataFrame, id_col: str, text_col: str) -> Column:
    """16 bytes that name a row by all its columns."""
    rest = F.to_json(F.struct(F.lit(0).alias("any"), *[F.col(c) for c in docs.columns if c != text_col]))
    parts = (F.col(id_col).isNull(), F.col(text_col).isNull(), F.col(text_col), rest)
    return F.unhex(F.concat(*[F.lpad(F.hex(F.xxhash64(F.lit(k), *parts)), 16, "0") for k in (1, 2)]))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row of each group of near duplicates, the one with the smallest id; same columns as the input.

    Of rows that share the id the one with the smallest digest of all columns
    stays, so the choice does not depend on the order of the rows; rows that are
    equal in every column count once.  A null id comes after all others.

    Who stays is decided on narrow rows; the documents are exchanged once, by
    the digest, which serves the join and the count of equal rows.
    """
    key = "__row"
    while key in docs.columns:
        key += "_"
    made = written(fingerprints(docs, id_col, text_col, shingle, _row_key(docs, id_col, text_col)), "fingerprints")
    named = _rooted(made, radius).select("fp", "root")
    order = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("id"), F.col("row").alias("row"))
    first = made.join(named, "fp").groupBy("root").agg(F.min(order).alias("first")).select(F.col("first.row").alias(key))
    keyed = docs.select("*", _row_key(docs, id_col, text_col).alias(key))
    kept = keyed.join(first, key, "left_semi")
    again = key + "n"
    numbered = kept.withColumn(again, F.row_number().over(Window.partitionBy(key).orderBy(key)))
    return numbered.where(F.col(again) == 1).select(*docs.columns)
