"""Streaming replay equals the batch result; registry queries equal their oracles."""

import math

import duckdb
import pytest

import __spark_entry__ as entry

FAST = [
    "combine_text", "normalize_text", "stopword_filter", "validate_tickets", "labelled_rows", "metric_slug", "slugify",
    "token_counts", "ngram_counts", "term_frequency", "document_frequency", "idf_table", "tfidf_l2",
    "vocabulary_index", "feature_count", "vocabulary_topk", "tfidf_transform_unseen", "length_feature",
    "encode_alpha", "encode_ordered", "unknown_labels", "decode_labels", "class_distribution", "class_weights",
    "stratum_key", "small_strata", "stratified_folds", "fold_split_counts", "prediction_alignment",
    "fold_metrics", "per_class_metrics", "confusion_dense", "ovr_confusion", "language_metrics",
    "metrics_grouping_sets", "cv_overall", "cv_per_class", "cv_ovr", "cv_confusion_long",
    "confusion_matrix_mean", "confusion_matrix_std", "cv_language", "metrics_long", "top_terms_per_language",
    "linear_scores", "top2_margin", "run_metrics", "headline_metrics", "leaderboard", "promoted_runs",
    "ticket_scan", "dataset_profile", "confusion_unpivot", "streaming_triage", "language_norm",
    "zero_support_metrics", "zero_support_language", "missing_targets", "cv_idf_by_subtraction",
    "promotion_mismatches", "triage_requests", "fit_svc_checks", "cv_fold_checks", "aligned_outcomes",
    "grouping_sets_null_targets", "run_tables_rewritten", "committed_leaderboard", "promoted_current",
    "streaming_promotion", "streaming_counts", "mixed_ticket_scan", "exact_vectors", "length_vectors",
]


def norm(rows):
    def v(x):
        if isinstance(x, float):
            return 0.0 if round(x, 6) == 0 else round(x, 6)
        return x
    return sorted((tuple(v(x) for x in r) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    for t in entry.TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return c


def test_every_query_has_oracle_or_is_a_fit():
    q, o = ({n: f for n, f in d.items() if n != "pipeline" and not n.startswith("op")} for d in (entry.queries(), entry.oracle_sql()))
    assert set(o) <= set(q)
    assert set(q) - set(o) == {"fit_logreg", "fit_linear_svc", "fit_linear_svc_multiclass", "fit_linear_svc_ordinal", "cv_predictions", "cv_predictions_svc", "cv_model_metrics", "triage_batch",
                               "model_roundtrip", "streaming_model_triage"}


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, sf_dir, con, name):
    sdf = entry.queries()[name](spark, sf_dir)
    cols = sdf.columns
    srows = [tuple(r) for r in sdf.collect()]
    cur = con.execute(entry.oracle_sql()[name])
    ocols = [c[0] for c in cur.description]
    assert sorted(cols) == sorted(ocols)
    so = sorted(range(len(cols)), key=lambda i: cols[i])
    oo = sorted(range(len(ocols)), key=lambda i: ocols[i])
    assert norm([[r[i] for i in so] for r in srows]) == norm([[r[i] for i in oo] for r in cur.fetchall()])


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["language", "rank", "term", "weight"]
    assert df.count() > 0
