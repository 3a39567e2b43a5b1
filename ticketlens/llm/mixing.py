"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

1. Sizes per source give the targets: weights share all sizes, a target stops
   at MAX_REPEATS times its source, the excess is shared again.
2. Each source's documents fall into hashed blocks, and the blocks into a
   permuted order; a target buys whole passes over the source, then blocks in
   that order, then documents of the block on the border.
3. The tree splits the shards in halves again and again; at each node a
   multivariate-hypergeometric draw deals the sources' block quotas to the
   halves, down to exact quotas for each shard.
4. A shard takes its quota as the next blocks in the permuted order, so
   shards are disjoint, and shuffles its documents by hash.

The driver holds one row per source and one number per source and shard,
never a document.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketlens.llm.common import partitions, written

WEIGHTS = (5.0, 2.0, 1.0)
MAX_REPEATS = 3
#: Documents of a block, on average.
BLOCK_DOCS = 256
#: A source's blocks are ranked by 2**RANGE_BITS ranges of their order, so no task orders a whole source.
RANGE_BITS = 12
SHARDS = 64
SEED = 20240607


def word_count(text: Column) -> Column:
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), "[ \\t-\\r]+"), "")).cast("long")


def targets(sizes: Sequence[int], weights: Sequence[float], most: float = MAX_REPEATS) -> list[float]:
    """Shares of sum(sizes) by weight, none above most * size; the excess is reshared by weight."""
    total, open_, out = float(sum(sizes)), set(range(len(sizes))), [0.0] * len(sizes)
    while open_:
        left = total - sum(out[i] for i in range(len(sizes)) if i not in open_)
        by = sum(weights[i] for i in open_)
        if by <= 0:
            break
        over = {i for i in open_ if left * weights[i] / by > most * sizes[i]}
        for i in over or open_:
            out[i] = float(most * sizes[i]) if over else left * weights[i] / by
        if not over:
            break
        open_ -= over
    return out


def split_quotas(blocks: Sequence[int], shards: int, seed: int = SEED) -> np.ndarray:
    """blocks[source] dealt to shards: an array (shards, sources) whose columns sum to blocks.

    Shards get equal numbers of blocks, or one apart.
    """
    out = np.zeros((shards, len(blocks)), np.int64)

    def split(lo: int, hi: int, held: np.ndarray) -> None:
        if hi - lo == 1:
            out[lo] = held
            return
        mid, all_ = (lo + hi) // 2, int(held.sum())
        share = all_ * (mid - lo) // (hi - lo)
        rng = np.random.default_rng([seed, lo, hi])
        left, open_ = np.zeros_like(held), all_
        for s, n in enumerate(held.tolist()):  # the draw's margins, one source after the other
            rest = open_ - n
            left[s] = _drawn(rng, n, rest, share)
            open_, share = rest, share - int(left[s])
        split(lo, mid, left)
        split(mid, hi, held - left)

    split(0, shards, np.array(blocks, np.int64))
    return out


def _drawn(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """Good ones among n drawn from good + bad: exact at any size (numpy's own sampler stops at 1e9)."""
    if good + bad < 10**9:
        return int(rng.hypergeometric(good, bad, n)) if good + bad else 0
    return inverse_draw(rng.random(), good, bad, n)


def inverse_draw(u: float, good: int, bad: int, n: int) -> int:
    """The hypergeometric quantile of u, from probabilities relative to the mode's.

    Neighbours' ratios are summed up as logarithms, 40 deviations to each side:
    beyond, no double holds what is left.
    """
    low, high = max(0, n - bad), min(good, n)
    mode = min(max((n + 1) * (good + 1) // (good + bad + 2), low), high)
    p = good / (good + bad)
    reach = 40 * math.ceil(math.sqrt(n * p * (1 - p)) + 1)
    k = np.arange(max(low, mode - reach), min(high, mode + reach) + 1, dtype=np.float64)
    a = k[:-1]  # log of P(a + 1) / P(a)
    steps = np.log(good - a) + np.log(n - a) - np.log(a + 1) - np.log(bad - n + a + 1)
    logs = np.concatenate([[0.0], np.cumsum(steps)])
    mass = np.cumsum(np.exp(logs - logs.max()))
    return int(k[min(np.searchsorted(mass, u * mass[-1], "right"), len(k) - 1)])


def _place(seed: int, id_col: str, text_col: str, source_col: str) -> Column:
    """A row's place in its source's hashed order; rows that are alike share it."""
    return F.xxhash64(F.lit(seed), F.col(id_col).cast("long"), F.xxhash64(text_col), F.col(source_col))


def _ranked(blocks: DataFrame) -> DataFrame:
    """``rank`` (from 0) and ``upto`` (sizes so far) of the blocks of each k in the order of (at, block).

    Offsets of ranges of the order come from the ranges' totals, at most
    2**RANGE_BITS rows a source; inside, each range is a window of its own.
    """
    blocks = blocks.withColumn("range", F.shiftright("at", 64 - RANGE_BITS))
    before = Window.partitionBy("k").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    totals = blocks.groupBy("k", "range").agg(F.count("*").alias("n"), F.sum("block_size").alias("held"))
    offsets = totals.select("k", "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n_before"), F.coalesce(F.sum("held").over(before), F.lit(0)).alias("held_before"))
    inside = Window.partitionBy("k", "range").orderBy("at", "block")
    rank = F.col("n_before") + F.row_number().over(inside) - 1
    upto = F.col("held_before") + F.sum("block_size").over(inside)
    joined = blocks.join(offsets, ["k", "range"])
    return joined.select("k", "block", "block_size", "rest", rank.alias("rank"), upto.alias("upto"))


def _border_picks(inside: DataFrame) -> DataFrame:
    """k, place of the documents of the border blocks that fill ``room`` best, from large to small.

    One block per source comes together here, about BLOCK_DOCS documents.
    """
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("size")).alias("neg"), "place")))
    listed = inside.groupBy("k").agg(F.first("room").alias("room"), ordered.alias("docs"))
    start = F.struct(
        F.col("room").alias("left"), F.array().cast("array<bigint>").alias("taken"),
        F.lit(None).cast("bigint").alias("spare"), F.lit(None).cast("bigint").alias("spare_size"),
    )
    fits = lambda a, x: -x["neg"] <= a["left"]
    step = lambda a, x: F.struct(
        F.when(fits(a, x), a["left"] + x["neg"]).otherwise(a["left"]).alias("left"),
        F.when(fits(a, x), F.concat(a["taken"], F.array(x["place"]))).otherwise(a["taken"]).alias("taken"),
        F.when(fits(a, x), a["spare"]).otherwise(x["place"]).alias("spare"),
        F.when(fits(a, x), a["spare_size"]).otherwise(-x["neg"]).alias("spare_size"),
    )
    # the smallest that didn't fit goes in where it brings the total nearer
    end = lambda a: F.when(a["spare_size"] < 2 * a["left"], F.concat(a["taken"], F.array(a["spare"]))).otherwise(a["taken"])
    return listed.select("k", F.explode(F.aggregate("docs", start, step, end)).alias("place")).distinct()


def plan_mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    most: int = MAX_REPEATS,
    shards: int = SHARDS,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    seed: int = SEED,
) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, takes, taken, place, placements.

    size: words ``[^\\x20\\x09-\\x0D]+`` (null text: 0).  Sources in code point
    order (null last, a source like any other) weigh ``weights``, repeating.
    takes: how often the mix holds the document; taken: takes * size.
    placements: for each take its shard and pass.  Rows that are alike in id,
    text and source are taken alike.  Sources without words have target 0.
    An empty table gives an empty result.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).alias("source"),
        word_count(F.col(text_col)).alias("size"), _place(seed, id_col, text_col, source_col).alias("place"),
    )
    rows = written(rows, "mix-sizes")
    found = rows.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()
    # code point order of names is the order of their UTF-8 bytes
    found = sorted(found, key=lambda r: (r["source"] is None, (r["source"] or "").encode()))
    goal = targets([r["size"] for r in found], [float(weights[i % len(weights)]) for i in range(len(found))], most)
    stats = []
    for k, (r, t) in enumerate(zip(found, goal, strict=True)):
        passes = min(int(t // r["size"]), most) if r["size"] else 0
        stats.append((r["source"], k, r["size"], t, passes, t - passes * r["size"], max(1, -(-r["n"] // BLOCK_DOCS))))
    sources = spark.createDataFrame(stats, "name string, k int, source_size long, target double, passes int, rest double, n_blocks long")
    named = rows.join(sources, F.col("source").eqNullSafe(F.col("name"))).withColumn("block", F.pmod("place", F.col("n_blocks")))

    # blocks in permuted order: those inside the rest are taken whole, the next one is the border
    blocks = named.groupBy("k", "block").agg(F.sum("size").alias("block_size"), F.first("rest").alias("rest"))
    blocks = _ranked(blocks.withColumn("at", F.xxhash64(F.lit(seed + 1), "k", "block")))
    room = F.col("rest") - (F.col("upto") - F.col("block_size"))
    blocks = blocks.select("k", "block", "rank", (F.col("upto") <= F.col("rest")).alias("whole"), ((room >= 0) & (F.col("upto") > F.col("rest"))).alias("border"), room.alias("room"))
    blocks = written(blocks, "mix-blocks")
    picks = _border_picks(named.join(blocks.where("border").select("k", "block", "room"), ["k", "block"]).select("k", "place", "size", "room"))
    picks = written(picks.withColumn("picked", F.lit(1)), "mix-picks")

    # exact block quotas of every shard
    held = {r["k"]: r for r in blocks.groupBy("k").agg(F.count("*").alias("n"), F.sum((F.col("whole") | F.col("border")).cast("int")).alias("part")).collect()}
    quotas = split_quotas([s[4] * held[s[1]]["n"] + held[s[1]]["part"] for s in stats], shards, seed)
    ends = [(s[1], held[s[1]]["n"], upto) for s, upto in zip(stats, np.cumsum(quotas, axis=0).T.tolist(), strict=True)]
    ends = spark.createDataFrame(ends, "k int, held long, ends array<long>")

    marked = named.join(blocks.select("k", "block", "rank", "whole"), ["k", "block"]).join(picks, ["k", "place"], "left").join(ends, "k")
    more = F.when(F.col("whole"), 1).otherwise(F.coalesce("picked", F.lit(0)))
    marked = marked.withColumn("takes", F.least(F.col("passes") + more, F.lit(most)))
    # the n-th block bought from a source goes to the shard whose quota covers n
    shard = lambda turn: F.size(F.filter("ends", lambda e: e <= turn * F.col("held") + F.col("rank")))
    turns = F.when(F.col("takes") > 0, F.sequence(F.lit(0), F.col("takes") - 1)).otherwise(F.array().cast("array<int>"))
    placements = F.transform(turns, lambda t: F.struct(F.least(shard(t), F.lit(shards - 1)).alias("shard"), t.alias("turn")))
    return marked.select("doc_id", "source", "size", "source_size", "target", "takes", (F.col("takes") * F.col("size")).alias("taken"), "place", placements.alias("placements"))


def mix(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, **options: object) -> DataFrame:
    """The documents as the mix holds them: same columns, a row for each take, shard by shard, shuffled inside.

    A shard is cut into hashed ranges of its shuffled order, so it may span
    several partitions: at least 16, and in step with the session's shuffle
    partitions.  Names of the documents' columns are free.
    """
    plan = plan_mix(docs, shards=shards, seed=seed, **options)
    id_col, text_col, source_col = (options.get(c, c[:-4] if c != "id_col" else "doc_id") for c in ("id_col", "text_col", "source_col"))
    chosen = plan.where("takes > 0").select(F.col("place").alias("p"), F.col("placements").alias("t")).dropDuplicates(["p"])
    rows = docs.select(_place(seed, id_col, text_col, source_col).alias("p"), F.struct("*").alias("row")).join(chosen, "p")
    rows = rows.select("row", "p", F.explode("t").alias("at"))
    rows = rows.select("row", F.col("at.shard").alias("shard"), F.xxhash64(F.lit(seed + 2), "p", "at.turn").alias("key"))
    bits = max(4, (4 * partitions(docs.sparkSession) // shards).bit_length())
    rows = rows.withColumn("range", F.shiftright("key", 64 - bits))
    return rows.repartition("shard", "range").sortWithinPartitions("shard", "key").select("row.*")
