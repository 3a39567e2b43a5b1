"""Conversation prefix trie on ternary search trees.

Conversations are range-partitioned by their path (the digests of their turns)
and id, so a shard holds neighbours of the trie, and any number of equal
conversations is dealt over several shards.  A shard encodes its turns by a
dictionary of its own, inserts its distinct paths into one ternary search tree,
the median of every stretch first, which keeps sibling trees balanced, and walks
the tree with an explicit stack to add up members, leaves and savings.

A node on the path of a shard's first or last conversation may lie in other
shards too: those boundary nodes leave the shard with partial sums and are
merged by key.  All other nodes are complete where they are.  What a merged node
itself gives to the sums above it is added along its chain of keys.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketlens.llm.common import partitions, written
from ticketlens.llm.turns import DIGEST, in_order, path_of, turns_of

#: Conversations of a hundred share the first turns of the first of them, up to five.
FAMILY, MOST_SHARED = 100, 6
_NOTHING = hashlib.sha256(b"").hexdigest()
_ROOT = b"\0" * DIGEST
_LARGEST = 2**63 - 1
_BATCH = 4096

#: Kinds of rows a shard gives: a whole node, one below a boundary node, a part of a boundary node, ids that end at one.
WHOLE, BELOW, BOUNDARY, ENDS = range(4)
_ROWS = (
    "kind int, shard int, key binary, parent_key binary, chain array<binary>, conv_id long, depth long, parent_conv_id long, "
    "n_convs long, n_children long, n_leaves long, saved_tokens long, chars long, ends_sha256 string, first_id long, ids string"
)
_SCHEMA = pa.schema(
    [
        ("kind", pa.int32()), ("shard", pa.int32()), ("key", pa.binary()), ("parent_key", pa.binary()), ("chain", pa.list_(pa.binary())),
        *[(c, pa.int64()) for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "chars")],
        ("ends_sha256", pa.string()), ("first_id", pa.int64()), ("ids", pa.string()),
    ]
)


class TernaryTree:
    """Sequences of ids; the children of a node are a binary tree (less, more), ``equal`` leads to the next turn.

    Node 0 is the root, the empty sequence.
    """

    def __init__(self) -> None:
        self.turn, self.less, self.equal, self.more = [-1], [0], [0], [0]
        self.parent, self.depth = [-1], [0]

    def _new(self, turn: int, parent: int) -> int:
        self.turn.append(turn)
        for links in (self.less, self.equal, self.more):
            links.append(0)
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1)
        return len(self.turn) - 1

    def insert(self, path: list[int]) -> int:
        """The node of the path's end."""
        turn, less, equal, more = self.turn, self.less, self.equal, self.more
        node = 0
        for t in path:
            at = equal[node]
            if not at:
                equal[node] = node = self._new(t, node)
                continue
            while (here := turn[at]) != t:
                side = less if t < here else more
                if not side[at]:
                    side[at] = self._new(t, node)
                at = side[at]
            node = at
        return node

    def insert_balanced(self, paths: list[list[int]]) -> list[int]:
        """End nodes of sorted distinct paths, inserted median first."""
        ends = [0] * len(paths)
        waiting = [(0, len(paths))]
        for low, high in waiting:
            if low < high:
                middle = (low + high) // 2
                ends[middle] = self.insert(paths[middle])
                waiting += [(low, middle), (middle + 1, high)]
        return ends

    def walk(self) -> list[int]:
        """All nodes, each after its parent, by a stack over the three links."""
        out, stack = [0], [self.equal[0]]
        while stack:
            at = stack.pop()
            if at:
                out.append(at)
                stack += [self.more[at], self.equal[at], self.less[at]]
        return out


class _Runs:
    """The shard's rows, sorted by path and id, as distinct paths with what is known of the ids that end there."""

    def __init__(self) -> None:
        self.paths: list[bytes] = []
        self.sizes: list[list[int]] = []
        self.least: list[int] = []
        self.count: list[int] = []
        self.digest: list[str | None] = []
        #: the ids of the first and the last path, which other shards may have more of
        self.open: dict[int, tuple[int, str]] = {}
        self._ids = array("q")

    def add(self, path: bytes, sizes: list[int], conv_id: int) -> None:
        if not self.paths or path != self.paths[-1]:
            self.close(last=False)
            self.paths.append(path)
            self.sizes.append(sizes)
            self.least.append(conv_id)
        self._ids.append(conv_id)

    def close(self, last: bool) -> None:
        if not self.paths:
            return
        ids = ",".join(map(str, self._ids))
        at = len(self.paths) - 1
        if last or not at:
            self.open[at] = (self._ids[0], ids)
        self.digest.append(None if at in self.open else hashlib.sha256(ids.encode()).hexdigest())
        self.count.append(len(self._ids))
        self._ids = array("q")


def _split(path: bytes) -> list[bytes]:
    return [path[k : k + DIGEST] for k in range(0, len(path), DIGEST)]


def _grow(runs: _Runs) -> tuple[TernaryTree, list[int]]:
    """The shard's tree over dictionary-encoded turns, and the node of each distinct path."""
    pieces = [_split(p) for p in runs.paths]
    code = {d: k for k, d in enumerate(sorted({d for p in pieces for d in p}))}
    tree = TernaryTree()
    return tree, tree.insert_balanced([[code[d] for d in p] for p in pieces])


def _shard_rows(shard: int, runs: _Runs) -> Iterator[dict]:
    tree, ends = _grow(runs)
    n, parent = len(tree.turn), tree.parent
    chars = [-1] * n
    for end, sizes in zip(ends, runs.sizes, strict=True):
        for size in reversed(sizes):
            if chars[end] >= 0:
                break
            chars[end], end = size, parent[end]
    keys, chains = {0: _ROOT}, {0: [_ROOT]}
    for k in (0, -1):  # the boundary nodes
        nodes, end = [], ends[k]
        while end > 0:
            nodes.append(end)
            end = parent[end]
        for node, turn in zip(reversed(nodes), _split(runs.paths[k]), strict=True):
            if node not in keys:
                keys[node] = hashlib.sha256(keys[parent[node]] + turn).digest()[:DIGEST]
                chains[node] = [*chains[parent[node]], keys[node]]

    members, least, digest = [0] * n, [_LARGEST] * n, [None] * n
    for k, end in enumerate(ends):
        members[end], least[end], digest[end] = runs.count[k], runs.least[k], runs.digest[k]
    order = tree.walk()
    children, whole, leaves, saved = [0] * n, [0] * n, [0] * n, [0] * n
    for node in reversed(order):  # children before their parents
        up, complete = parent[node], node not in keys
        if complete:
            leaves[node] += children[node] == 0
            saved[node] += (members[node] - 1) * chars[node]
        if up >= 0:
            members[up] += members[node]
            least[up] = min(least[up], least[node])
            leaves[up] += leaves[node]
            saved[up] += saved[node]
            children[up] += 1
            whole[up] += complete

    for node in order:
        up = parent[node]
        row = {
            "shard": shard, "conv_id": least[node], "depth": tree.depth[node], "n_convs": members[node], "n_children": children[node],
            "n_leaves": leaves[node], "saved_tokens": saved[node], "ends_sha256": digest[node],
        }
        if node in keys:
            yield row | {"kind": BOUNDARY, "key": keys[node], "parent_key": keys.get(up), "chain": chains[node], "n_children": whole[node], "chars": max(chars[node], 0)}
        elif up in keys:
            yield row | {"kind": BELOW, "parent_key": keys[up]}
        else:
            yield row | {"kind": WHOLE, "parent_conv_id": least[up]}
    for k, (first_id, ids) in runs.open.items():
        yield {"kind": ENDS, "key": keys[ends[k]], "first_id": first_id, "ids": ids}


def _trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (shard, path, sizes, conv_id) of one shard, sorted by path and id, to rows of its tree."""
    runs, shard = _Runs(), 0
    for batch in batches:
        for shard, path, sizes, conv_id in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            runs.add(path, sizes, conv_id)
    if runs.paths:
        runs.close(last=True)
        rows = _shard_rows(shard, runs)
        while some := list(islice(rows, _BATCH)):
            yield pa.RecordBatch.from_pylist(some, schema=_SCHEMA)


def _end_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, first_id, ids) sorted by key and first id; a key's lists go through one running hash."""
    key, running = None, None
    for batch in batches:
        out = []
        for k, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if k == key:
                running.update(b"," + ids.encode())
                continue
            if key is not None:
                out.append((key, running.hexdigest()))
            key, running = k, hashlib.sha256(ids.encode())
        yield _digests(out)
    yield _digests([] if key is None else [(key, running.hexdigest())])


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.string())], names=["key", "listed"])


def rebuilt(conversations: DataFrame) -> DataFrame:
    """conv_id and ``turns``: the first h turns of the family's first conversation, then the own ones after the first h.

    One exchange, by family, serves the grouping of the turns and the join.
    """
    spark = conversations.sparkSession
    turns = turns_of(conversations).where("conv_id is not null")
    family = F.col("conv_id") - F.col("conv_id") % FAMILY
    narrow = turns.select(family.alias("family"), "conv_id", "turn", "digest", F.length("text").cast("long").alias("chars"))
    own = narrow.repartition(partitions(spark), "family").groupBy("family", "conv_id").agg(in_order("chars").alias("turns"))
    first = own.where("conv_id = family").select("family", F.slice("turns", 1, MOST_SHARED - 1).alias("first"))
    h = (F.crc32(F.col("conv_id").cast("string")) % MOST_SHARED).cast("int")
    shared = F.coalesce(F.slice("first", F.lit(1), h), F.array().cast(own.schema["turns"].dataType))
    rest = F.slice("turns", h + 1, F.greatest(F.size("turns") - h, F.lit(0)))
    return own.join(first, "family", "left").select("conv_id", F.concat(shared, rest).alias("turns"))


def trie(paths: DataFrame) -> DataFrame:
    """The nodes of the trie over conv_id and ``turns`` (structs with digest and chars); see ``conversation_trie``."""
    spark = paths.sparkSession
    n = partitions(spark)
    rows = paths.select(path_of(F.col("turns")).alias("path"), F.transform("turns", lambda t: t["chars"]).alias("sizes"), "conv_id")
    dealt = rows.repartitionByRange(n, "path", "conv_id").sortWithinPartitions("path", "conv_id")
    made = written(dealt.select(F.spark_partition_id().alias("shard"), "path", "sizes", "conv_id").mapInArrow(_trees, _ROWS), "trie")

    parts = made.where(F.col("kind") == BOUNDARY)
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    same = [F.first(c).alias(c) for c in ("parent_key", "chain", "depth", "chars")]
    merged = written(parts.groupBy("key").agg(F.min("conv_id").alias("conv_id"), *sums, *same, F.max("ends_sha256").alias("ends_sha256")), "boundary")
    lists = made.where(F.col("kind") == ENDS).select("key", "first_id", "ids").repartition(n, "key").sortWithinPartitions("key", "first_id")
    listed = lists.mapInArrow(_end_digests, "key binary, listed string")
    more = merged.groupBy(F.col("parent_key").alias("key")).agg(F.count("*").alias("more"))
    counted = merged.join(more, "key", "left").withColumn("n_children", F.col("n_children") + F.coalesce("more", F.lit(0)))
    given = counted.select("chain", (F.col("n_children") == 0).cast("long").alias("leaf"), ((F.col("n_convs") - 1) * F.col("chars")).alias("own"))
    above = given.where("leaf + own > 0").select(F.explode("chain").alias("key"), "leaf", "own")
    above = above.groupBy("key").agg(F.sum("leaf").alias("leaf"), F.sum("own").alias("own"))
    names = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    boundary = counted.join(above, "key", "left").join(listed, "key", "left").join(names, "parent_key", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
        (F.col("n_leaves") + F.coalesce("leaf", F.lit(0))).alias("n_leaves"),
        (F.col("saved_tokens") + F.coalesce("own", F.lit(0))).alias("saved_tokens"),
        F.coalesce("listed", "ends_sha256").alias("ends_sha256"),
    )

    # a boundary node's children meet its name by shard and key, so a node with very many of them is no hot key
    local = parts.select("shard", F.col("key").alias("parent_key")).join(names, "parent_key")
    below = made.where(F.col("kind") == BELOW).drop("parent_conv_id").join(local, ["shard", "parent_key"])
    columns = boundary.columns
    nodes = made.where(F.col("kind") == WHOLE).select(*columns).unionByName(below.select(*columns)).unionByName(boundary)
    return nodes.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_NOTHING)))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations: conv_id (the smallest member), depth,
    parent_conv_id (null for the root), n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Turns are ordered by number, a null one first and equal ones by the digest of
    role and text, so repeated rows are turns of their own.  A null role or text
    is empty.  Rows without a conv_id belong to no conversation and are left out.
    The remainder of a negative conv_id has its sign.  A conversation is held by
    one task as the digests of its turns.  No conversation, no node: an empty
    table gives an empty result.
    """
    return trie(rebuilt(conversations))
