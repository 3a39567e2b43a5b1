"""Sharding by rendezvous hashing (DataFrame functions only).

Every shard draws a hash for every key; the key goes to the shard with the
least ``-ln(u) / weight``.  A shard that is added only competes with the
winner so far, so rows move into the new shard and nowhere else; with n equal
shards about 1/(n+1) of the rows move.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketlens.llm.common import partitions, written

SHARDS = 24


def _draw(key: Column, shard: int, weight: float) -> Column:
    """(-ln(u) / weight, shard) with u in (0, 1) from the key's hash for that shard."""
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(shard)), 11).cast("double")
    u = (bits + F.lit(0.5)) * F.lit(2.0**-53)
    return F.struct((-F.log(u) / F.lit(float(weight))).alias("s"), F.lit(shard).alias("shard"))


def shard_of(key: Column, weights: Sequence[float]) -> Column:
    """The (score, shard) of the key's shard; shards of weight 0 or less get nothing."""
    draws = [_draw(key, i, w) for i, w in enumerate(weights) if w > 0]
    if not draws:
        raise ValueError("no shard has a positive weight")
    return draws[0] if len(draws) == 1 else F.least(*draws)


def assign_shards(
    docs: DataFrame,
    weights: Sequence[float] = (1.0,) * SHARDS,
    new_weight: float = 1.0,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot and grown_shard (the shard if one of ``new_weight`` is added).

    size: UTF-8 bytes of the text plus 8.  The id and the weights alone name
    the shard; rows that share an id share it, null ids too.  slot numbers a
    shard's rows from 0 without gaps, in an order that depends on the rows
    only.  A null text has no bytes (size 8, checksum 0).

    Slots are numbered inside ranges of a hash of the row, and the ranges'
    counts give the offsets, so no shard has to fit in a task, and the slots do
    not depend on the number of ranges, which is that of the shuffle partitions.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    key = F.col(id_col).cast("long")
    best = shard_of(key, weights)
    rows = docs.select(
        key.alias("doc_id"),
        (F.octet_length(text).cast("long") + 8).alias("size"),
        F.crc32(text).alias("text_crc32"),
        best.alias("best"),
        F.least(best, _draw(key, len(weights), new_weight))["shard"].alias("grown_shard"),
    )
    n_sub = partitions(docs.sparkSession)
    rows = rows.select(
        "doc_id", "size", "text_crc32", F.col("best.shard").alias("shard"), "grown_shard",
        F.shiftrightunsigned(F.xxhash64("doc_id", "text_crc32", "size"), 1).alias("place"),
    )
    # ranges of equal width in the order of the places: their number does not change a slot
    rows = rows.withColumn("sub", F.shiftright(F.shiftright("place", 32) * F.lit(n_sub).cast("long"), 31))
    rows = written(rows, "shards")
    counts = rows.groupBy("shard", "sub").count()
    before = Window.partitionBy("shard").orderBy("sub").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "sub", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("shard", "sub").orderBy("place", "doc_id", "text_crc32", "size")
    placed = rows.withColumn("at", F.row_number().over(inside) - 1).join(offsets, ["shard", "sub"])
    return placed.select("doc_id", "size", "text_crc32", "shard", (F.col("base") + F.col("at")).alias("slot"), "grown_shard")
