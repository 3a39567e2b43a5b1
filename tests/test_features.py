"""TF-IDF tables against a brute-force computation in plain Python."""

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ticketlens.operators import features as fe
from ticketlens.plans import views as V


@pytest.fixture(scope="module")
def grams(spark, sf_dir):
    return {r.id: list(r.grams) for r in V.prepared(spark, sf_dir).select("id", "grams").collect()}


def brute_force(grams, max_df=0.95):
    n = len(grams)
    tf = {i: Counter(g) for i, g in grams.items()}
    df = Counter(t for c in tf.values() for t in c)
    idf = {t: math.log((1 + n) / (1 + d)) + 1 for t, d in df.items() if d <= max_df * n}
    out = {}
    for i, c in tf.items():
        w = {t: k * idf[t] for t, k in c.items() if t in idf}
        norm = math.sqrt(sum(v * v for v in w.values()))
        out.update({(i, t): v / norm for t, v in w.items()})
    return idf, out


def test_tfidf_matches_brute_force(spark, sf_dir, grams):
    idf_ref, w_ref = brute_force(grams)
    tf = V.term_frequency(spark, sf_dir)
    idf = fe.idf_table(tf, fe.corpus_size(V.tickets(spark, sf_dir, False)))
    got_idf = {r.term: r.idf for r in idf.collect()}
    assert got_idf.keys() == idf_ref.keys()
    assert all(got_idf[t] == pytest.approx(v, rel=1e-12) for t, v in idf_ref.items())
    got = {(r.id, r.term): r.weight for r in fe.tfidf_l2(tf, idf).collect()}
    assert got.keys() == w_ref.keys()
    assert all(got[k] == pytest.approx(v, rel=1e-9) for k, v in w_ref.items())


def test_row_norms_are_one(spark, sf_dir):
    tf = V.term_frequency(spark, sf_dir)
    idf = fe.idf_table(tf, fe.corpus_size(V.tickets(spark, sf_dir, False)))
    norms = fe.tfidf_l2(tf, idf).groupBy("id").agg(F.sum(F.col("weight") ** 2).alias("n2")).collect()
    assert all(r.n2 == pytest.approx(1.0) for r in norms)


def test_vocabulary_index_is_sorted_order(spark, sf_dir):
    tf = V.term_frequency(spark, sf_dir)
    idf = fe.idf_table(tf, fe.corpus_size(V.tickets(spark, sf_dir, False)))
    got = {r.term: r.feature_id for r in fe.vocabulary_index(idf).collect()}
    assert got == {t: i for i, t in enumerate(sorted(got))}


def test_topk_and_length_feature(spark, sf_dir, grams):
    tf = V.term_frequency(spark, sf_dir)
    idf = fe.idf_table(tf, fe.corpus_size(V.tickets(spark, sf_dir, False)))
    idf_ref, _ = brute_force(grams)
    totals = Counter(t for g in grams.values() for t in g if t in idf_ref)
    expected = sorted(totals.items(), key=lambda kv: (-kv[1], kv[0]))[:25]
    got = [(r.term, r.corpus_tf) for r in fe.vocabulary_topk(tf, idf, 25).collect()]
    assert got == expected
    df = spark.createDataFrame([(0, True), (0, False), (10, False)], "ticket_text_length int, train boolean")
    vals = [r.length_feature for r in fe.length_feature(df, "train").collect()]
    assert vals == [0.0, 0.0, 10.0]  # train max 0 → scale floored at 1.0


def test_sublinear_tf_and_df_bounds(spark):
    docs = spark.createDataFrame(
        [(1, ["aa", "aa", "bb"]), (2, ["aa", "cc"]), (3, ["aa", "bb"]), (4, ["dd"])], "id long, grams array<string>"
    )
    tf = {(r.id, r.term): r.tf for r in fe.term_frequency(docs, sublinear=True).collect()}
    assert tf[(1, "aa")] == pytest.approx(1 + math.log(2)) and tf[(1, "bb")] == pytest.approx(1.0)
    raw = fe.term_frequency(docs)
    kept = {r.term for r in fe.idf_table(raw, 4, min_df=0.5, max_df=0.95).collect()}
    assert kept == {"aa", "bb"}  # df ≥ 2 and df ≤ 3.8
    kept = {r.term for r in fe.idf_table(raw, 4, min_df=1, max_df=2).collect()}
    assert kept == {"bb", "cc", "dd"}  # absolute max_df: aa (df 3) dropped


def test_exact_vectors(spark):
    from pyspark.sql import functions as F

    from ticketlens.operators import features as fe

    weights = spark.createDataFrame([(1, "b", 0.6), (1, "a", 0.8), (2, "c", 1.0), (2, "unknown", 9.0)], "id long, term string, weight double")
    vocabulary = spark.createDataFrame([("a", 0), ("b", 1), ("c", 2), ("d", 3)], "term string, feature_id long")
    ids = spark.createDataFrame([(1, 0.0), (2, 1.0), (3, 1.0)], "id long, label_id double")
    got = {r.id: r for r in fe.exact_vectors(weights, vocabulary, ids, 4).collect()}
    assert {i: (r.features.size, r.features.indices.tolist(), r.features.values.tolist()) for i, r in got.items()} == {
        1: (4, [0, 1], [0.8, 0.6]), 2: (4, [2], [1.0]), 3: (4, [], [])
    }
    assert got[2].label_id == 1.0
    assert fe.exact_vectors(weights.limit(0), vocabulary, ids.limit(0), 4).count() == 0


def test_files_that_lack_columns(spark, tmp_path):
    import pytest

    from ticketlens.sources import tickets as tk

    path = str(tmp_path / "mixed")
    rows = spark.createDataFrame([(1, "s", "b", "de"), (2, "t", "c", "en")], tk.REQUEST_SCHEMA)
    rows.where("id = 1").drop("subject").write.parquet(path)
    rows.where("id = 2").drop("language").write.mode("append").parquet(path)
    assert sorted(map(tuple, tk.read_tickets(spark, path, tk.REQUEST_SCHEMA).collect())) == [(1, None, "b", "de"), (2, "t", "c", None)]
    rows.drop("body").coalesce(1).write.mode("append").parquet(path)
    with pytest.raises(Exception, match="files without a body"):
        tk.read_tickets(spark, path, tk.REQUEST_SCHEMA).collect()
    rows.drop("body").write.parquet(path + "2")
    with pytest.raises(KeyError, match="body"):
        tk.read_tickets(spark, path + "2", tk.REQUEST_SCHEMA)


def test_texts_are_counted_an_id_at_a_time(spark, monkeypatch):
    """The counts of the n-gram arrays, with repeated and null ids and ids counted a part of their terms at a time."""
    from ticketlens.operators import prepare as pr

    texts = [(1, "ab c ab ab"), (1, "ab ab"), (2, ""), (3, None), (None, "xy zz"), (None, "zz xy"), (4, "aa bb cc dd " * 40)]
    df = spark.createDataFrame([(i, None, t, "zz") for i, t in texts], "id long, subject string, body string, language string")
    prepared = pr.prepare_tickets(df, partition_by="id", partitions=3)
    expected = {(r.id, r.term): r.tf for r in fe.term_frequency(pr.with_grams(prepared)).collect()}
    for chars in (1 << 23, 50):
        monkeypatch.setattr(fe, "CHARS", chars)
        got = fe.text_term_frequency(prepared).collect()
        assert {(r.id, r.term): r.tf for r in got} == expected and len(got) == len(expected)
    kept = fe.text_term_frequency(prepared, keep=("language",), outer=True).collect()
    assert {(r.id, r.language) for r in kept if r.term is None} == {(2, "zz"), (3, "zz")} and len(kept) == len(expected) + 2


def test_pairs_are_exchanged_once(spark, sf_dir):
    """The document frequencies and the join with them read one exchange of the pairs."""
    import __spark_entry__ as entry

    for name in ("tfidf_l2", "top2_margin"):
        df = entry.queries()[name](spark, sf_dir)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        final = plan.split("\n+- == Initial Plan ==")[0]
        assert final.count("MapInArrow") == 1 and "ReusedExchange" in final


def test_partitions_follow_the_text_not_its_stored_size(spark, tmp_path):
    """A text stored once and repeated takes as many partitions as so many texts."""
    from ticketlens import session
    from ticketlens.plans import views

    text = "a printer is broken " * 500
    spark.range(2000).selectExpr("id AS doc_id", f"'{text}' AS text").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    assert views.text_pieces(spark, str(tmp_path)) >= 2000 * len(text) // session.TEXT_BYTES > 2


@pytest.fixture(scope="module")
def odd_texts(spark):
    """Prepared texts with repeated and null ids, without words, in other scripts and with a very long word."""
    from ticketlens.operators import prepare as pr

    texts = [(1, "ab c ab ab"), (1, "ab ab zz"), (2, ""), (3, None), (None, "xy zz"), (None, "zz xy"), (4, "aa bb cc dd " * 40), (0, "xy größe 数据 数据 ab"), (-7, "w" * 70000 + " ab")]
    df = spark.createDataFrame([(i, None, t, "zz") for i, t in texts], "id long, subject string, body string, language string")
    return pr.prepare_tickets(df, partition_by="id", partitions=3)


def test_packed_pairs_give_the_relational_tables(spark, odd_texts):
    tf = fe.text_term_frequency(odd_texts)
    idf = fe.idf_table(tf, 9, max_df=0.3, totals=True)
    packed = fe.packed_pairs(odd_texts, 5)
    dfs = fe.packed_document_frequency(packed, 5)
    assert sorted(map(tuple, dfs.collect())) == sorted(map(tuple, fe.document_frequency(tf, totals=True).collect()))
    assert sorted(map(tuple, fe.idf_of(dfs, 9, max_df=0.3).collect())) == sorted(map(tuple, idf.collect()))
    expected = {(r.id, r.term): (r.tf, r.weight) for r in fe.tfidf_l2(tf, idf).collect()}
    rows = fe.packed_tfidf_l2(odd_texts, 9, 4, max_df=0.3).collect()
    got = {(r.id, r.term): (r.tf, r.weight) for r in rows}
    assert len(rows) == len(got) and got.keys() == expected.keys() and (None, "xy") in got and (1, "ab") not in got
    assert all(got[k] == (expected[k][0], pytest.approx(expected[k][1], rel=1e-9)) for k in got)
    vocabulary = fe.vocabulary_index(idf)
    column = {r.term: r.feature_id for r in vocabulary.collect()}
    rows = fe.packed_tfidf_l2(odd_texts, 9, 4, max_df=0.3, vocabulary=vocabulary).collect()
    assert sorted((r.id or 0.5, r.feature_id) for r in rows) == sorted((i or 0.5, column[t]) for i, t in expected)
    assert fe.packed_tfidf_l2(odd_texts.limit(0), 9, 4).count() == 0
    some = vocabulary.where("term = 'xy'")
    assert sorted((r.id or 0.5, r.feature_id) for r in fe.packed_tfidf_l2(odd_texts, 9, 4, max_df=0.3, vocabulary=some).collect()) == [(0.5, column["xy"])] * 2


def test_packed_weights_by_label(spark):
    """Sums by label equal the join of all pairs with their ids' rows, repeated, null and wordless ids included."""
    from ticketlens.operators import prepare as pr

    texts = [(1, "ab zz", "en"), (1, "ab", "de"), (1, "yy", "de"), (2, "", "fr"), (None, "xy zz", "en"), (4, "xy xy yy ab", "en"), (5, "ab qq", "es")]
    df = spark.createDataFrame([(i, None, t, l) for i, t, l in texts], "id long, subject string, body string, language string")
    prepared = pr.prepare_tickets(df, partition_by="id", partitions=3)
    joined = fe.packed_tfidf_l2(prepared, 7, 4, max_df=3).join(df.select("id", "language"), "id")
    expected = {(r.language, r.term): r.w for r in joined.groupBy("language", "term").agg(F.sum("weight").alias("w")).collect()}
    sums = fe.packed_tfidf_l2(prepared, 7, 4, max_df=3, label="language").groupBy("language", "term").agg(F.sum("weight").alias("w"))
    got = {(r.language, r.term): r.w for r in sums.collect()}
    assert got.keys() == expected.keys() and ("de", "ab zz") in got and ("fr", "ab") not in got
    assert all(got[k] == pytest.approx(expected[k]) for k in got)


def test_packed_pairs_are_small(spark):
    """A pair travels in a few bytes, its term included."""
    import random

    from ticketlens.operators import prepare as pr

    rng = random.Random(3)
    vocabulary = ["".join(rng.choices("abcdefgh", k=7)) for _ in range(3000)]
    rows = [(i, None, " ".join(rng.choices(vocabulary, k=200)), "zz") for i in range(300)]
    prepared = pr.prepare_tickets(spark.createDataFrame(rows, "id long, subject string, body string, language string"), partition_by="id", partitions=2)
    sizes = fe.packed_pairs(prepared, 8).selectExpr("sum(n) n", "sum(length(ids) + length(lengths) + length(terms) + length(tf)) bytes").first()
    assert sizes.n == fe.text_term_frequency(prepared).count() and sizes.bytes < 14 * sizes.n


def test_vocabularies_are_not_checkpointed_as_rows(spark, sf_dir, monkeypatch):
    """Exact vectors and vocabularies take packed pairs; sorted terms are written, not checkpointed."""
    import __spark_entry__ as entry

    monkeypatch.setattr(type(spark.range(1)), "checkpoint", lambda *a, **b: pytest.fail("a table is checkpointed"))
    for name in ("vocabulary_index", "exact_vectors", "document_frequency", "idf_table", "top_terms_per_language"):
        plan = entry.queries()[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
        assert "RepartitionByExpression [term" not in plan
