"""Conversations as one row each, for the operators that share their initial turns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of a turn's digest; a conversation's path is its turns' digests one after the other.
DIGEST = 16


def turn_digest(role: Column, text: Column) -> Column:
    """16 bytes of SHA-256 over role and text (told apart by the role's length), in hex."""
    keyed = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return F.substring(F.sha2(keyed, 256), 1, 2 * DIGEST)


def turns_of(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, digest; a null role or text becomes empty, other columns are not read."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    return rows.withColumn("digest", turn_digest(F.col("role"), F.col("text")))


def in_order(*columns: str) -> Column:
    """Aggregate: a conversation's turns in order (null turn first, equal ones by digest), as structs with the columns."""
    return F.array_sort(F.collect_list(F.struct("turn", "digest", *columns)))


def path_of(turns: Column) -> Column:
    """The digests one after the other as bytes, which sort like the sequence."""
    return F.unhex(F.array_join(F.transform(turns, lambda t: t["digest"]), ""))
