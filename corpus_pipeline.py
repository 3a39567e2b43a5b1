"""The corpus pipeline: documents in, token ids out.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it
kept.  ``run`` writes every stage's rows as Parquet in the shared checkpoint
folder and reads them again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketlens.llm import mixing, pii, quality, sentencepiece_fst, simhash
from ticketlens.llm.common import table, written
from ticketlens.llm.queries import tokenizer_path

PIECES = "piece_bpe_32k.model"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or the target likelihood go; the verdict is that of the operator's own query."""
    labels = table(spark, sf_dir, "labels")
    trusted, rejected = (labels.where(F.col("quality") == q).select("doc_id") for q in (1, 0))
    return quality.keep(docs, trusted, rejected=rejected)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the smallest id."""
    return simhash.keep_one(docs)


def mask_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is masked; n_chars follows the text."""
    return pii.mask(docs).withColumn("n_chars", F.length("text").cast("long"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: a row for each time the mix takes a document."""
    return mixing.mix(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every text, and the text decoded from them."""
    return sentencepiece_fst.encode_decode(docs, tokenizer_path(PIECES))


STAGES = [
    ("quality rules", quality_rules),
    ("simhash near-dedup", near_dedup),
    ("pii", mask_pii),
    ("source mixing", mix_sources),
    ("sentencepiece", encode_pieces),
]

#: Hashing, a trained network and a tokenizer's merges cannot be expressed in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
