"""Registered queries on tickets without text, repeated and null ids, built here."""

import pytest

import __spark_entry__ as entry


@pytest.fixture
def odd_dir(spark, tmp_path):
    docs = [(1, "a subject\nprinter broken again"), (2, ""), (3, None), (4, "\n"), (5, "x"), (5, "network slow today"), (None, "network slow")]
    rows = [(i, text, "fr", "web", len(text or "")) for i, text in docs]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (5, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def test_length_vectors_of_tickets_without_words(spark, odd_dir):
    rows = entry.queries()["length_vectors"](spark, odd_dir).collect()
    # the longest cleaned text is "a subject printer broken again", 30 characters
    assert sorted(round(r["length_feature"] * 30) for r in rows) == [0, 0, 0, 1, 12, 18, 30]
    assert len({r["columns"] for r in rows}) == 1


def test_exchanges_grow_with_the_text(spark, odd_dir, monkeypatch):
    """Pieces of an exchange follow the stored size, not the session's number; nothing stays cached."""
    from ticketlens import session
    from ticketlens.plans import views

    monkeypatch.setattr(session, "TEXT_BYTES", 64)
    rows = entry.queries()["tfidf_l2"](spark, odd_dir).collect()
    assert {r["id"] for r in rows} == {1, 5, None}
    pieces = views.text_pieces(spark, odd_dir)
    assert pieces > 8 and views.term_frequency(spark, odd_dir).rdd.getNumPartitions() == pieces
    assert int(spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum")) >= pieces
    assert not views._SHARED


def test_normalisation_is_linear_in_a_run_without_blanks(spark):
    import time

    from pyspark.sql import functions as F

    from ticketlens.functions import text as tx

    begun = time.time()
    rows = spark.range(1).select(F.expr("concat(repeat('a.', 150000), '@ b@c')").alias("t"))
    clean = rows.select(tx.normalize_chars(F.col("t"), use_nfkc=False).alias("c")).first()["c"]
    assert clean.split() == ["a"] * 150000 + ["email"] and time.time() - begun < 20
