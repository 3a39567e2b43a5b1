"""Flagship: tickets → normalised text → 1–3-gram TF-IDF → top terms per language."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import views as V

TOP_TERMS = 20


def top_terms_per_language(spark: SparkSession, d: str, k: int = TOP_TERMS) -> DataFrame:
    """(language, rank, term, weight): the k terms with the largest summed weight.

    ``row_number() <= k`` lets Spark insert a partial WindowGroupLimit before
    the shuffle, so each task forwards at most k rows per language.
    """
    per_lang = V.language_weights(spark, d).groupBy("language", "term").agg(F.round(F.sum("weight"), 6).alias("weight"))
    rank = F.row_number().over(Window.partitionBy("language").orderBy(F.col("weight").desc(), F.col("term")))
    return per_lang.withColumn("rank", rank).where(F.col("rank") <= k).select(
        "language", F.col("rank").cast("int").alias("rank"), "term", "weight"
    )
