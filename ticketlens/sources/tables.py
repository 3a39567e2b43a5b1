"""Scans of the driver tables and the adapters that present them as tickets.

All scans are plain Parquet reads: Catalyst prunes columns and pushes filters
into the scan, so adapters only declare what they need.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import stored_bytes

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_bytes(spark: SparkSession, sf_dir: str) -> int:
    """Stored size of the documents."""
    return stored_bytes(spark, f"{sf_dir.rstrip('/')}/documents.parquet")


_TEXT_SIZES: dict[tuple, int] = {}


def text_size(spark: SparkSession, sf_dir: str) -> int:
    """UTF-8 bytes of all texts, counted: stored texts may be a small part of that, repeated ones above all.

    One scan of the texts a session, folder and stored size.
    """
    key = (spark.sparkContext.applicationId, sf_dir, text_bytes(spark, sf_dir))
    if key not in _TEXT_SIZES:
        _TEXT_SIZES[key] = int(table(spark, sf_dir, "documents").agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    return _TEXT_SIZES[key]


def register_views(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    for name in names:
        table(spark, sf_dir, name).createOrReplaceTempView(name)


def split_subject_body(text: Column) -> tuple[Column, Column]:
    """First line → subject, rest → body; one-line text → (null, text)."""
    pos = F.instr(text, "\n")
    subject = F.when(pos > 0, text.substr(F.lit(1), pos - 1))
    body = F.when(pos > 0, text.substr(pos + 1, F.length(text))).otherwise(text)
    return subject, body


def ticket_view(spark: SparkSession, sf_dir: str, with_targets: bool = True) -> DataFrame:
    """documents (+ labels) as tickets: id, subject, body, language[, quality, toxic].

    Targets come from a left join on ``labels``; most documents have none.
    ``labels`` is keyed by doc_id, so the join is 1:1 and Spark may broadcast
    it only when AQE measures it under the broadcast threshold.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    subject, body = split_subject_body(F.col("text"))
    tickets = docs.select(
        F.col("doc_id").alias("id"),
        subject.alias("subject"),
        body.alias("body"),
        F.col("lang").alias("language"),
    )
    if not with_targets:
        return tickets
    labels = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("id"),
        F.col("quality").cast("string").alias("quality"),
        F.col("toxic").cast("string").alias("toxic"),
    )
    return tickets.join(labels, "id", "left")


# The explicit priority order used as an ordinal target,
# lowest first.
ORDER_PRIORITY_ORDER = ("5-LOW", "4-NOT SPECIFIED", "3-MEDIUM", "2-HIGH", "1-URGENT")


def orders_with_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders ⋈ customer ⋈ nation ⋈ region → (id, priority, status, price, region).

    customer is the only side that grows with the data; nation and region
    are fixed 25- and 5-row dimensions, which Spark broadcasts.
    """
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        "o_custkey",
        F.col("o_orderpriority").alias("priority"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("price"),
    )
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey")
    )
    nation = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_regionkey").alias("r_regionkey"))
    region = table(spark, sf_dir, "region").select("r_regionkey", F.col("r_name").alias("region"))
    return (
        orders.join(customer, "o_custkey", "left")
        .join(F.broadcast(nation), "n_nationkey", "left")
        .join(F.broadcast(region), "r_regionkey", "left")
        .drop("o_custkey", "n_nationkey", "r_regionkey")
    )
