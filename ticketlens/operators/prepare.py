"""Ticket text preparation as one narrow projection (no shuffle)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..sources.tickets import require_columns, with_optional_columns

COMBINED = "ticket_text"
CLEANED = "ticket_text_clean"
LENGTH = "ticket_text_length"
WORDS = "words"


def prepare_tickets(
    df: DataFrame,
    subject: str = "subject",
    body: str = "body",
    language: str = "language",
    use_nfkc: bool = True,
    keep_words: bool = True,
    partition_by: str | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Add ticket_text, ticket_text_clean, ticket_text_length (and the word array).

    body is required (KeyError at plan time); subject and language are
    optional. Stop words are removed per language prefix after the
    character normalisation. ``partitions``: of the exchange by ``partition_by``, which
    AQE then leaves as they are.
    """
    require_columns(df, (body,))
    out = with_optional_columns(df, subject, language)
    lang_for_text = tx.language_for_text(F.col(language))
    out = out.withColumn(COMBINED, tx.combine_text(F.col(subject), F.col(body)))
    # each step is its own column so no expression is evaluated twice per row
    out = out.withColumn("_nfkc", tx.nfkc(F.col(COMBINED)) if use_nfkc else F.col(COMBINED))
    if partition_by is not None:
        # Shuffle text-sized rows once, after the Python step (which does not
        # report its output partitioning) and before the n-gram blow-up, so
        # every later per-document step runs without another exchange.
        out = out.repartition(partitions, partition_by) if partitions else out.repartition(partition_by)
    out = out.withColumn("_chars", tx.normalize_chars(F.col("_nfkc"), use_nfkc=False)).drop("_nfkc")
    out = out.withColumn("_split", tx.split_words(F.col("_chars")))
    out = out.withColumn(WORDS, tx.remove_stop_words(F.col("_split"), lang_for_text)).drop("_chars", "_split")
    out = out.withColumn(CLEANED, F.array_join(F.col(WORDS), " "))
    out = out.withColumn(LENGTH, F.length(CLEANED))
    return out if keep_words else out.drop(WORDS)


def with_grams(df: DataFrame, ngram_range=(1, 3), words_col: str = WORDS, out_col: str = "grams") -> DataFrame:
    """Feature tokens (≥ 2 chars) → word n-grams in [min_n, max_n]."""
    out = df.withColumn("_feat", tx.feature_tokens(F.col(words_col)))
    return out.withColumn(out_col, tx.ngrams_1_to(F.col("_feat"), ngram_range[1], ngram_range[0])).drop("_feat")
