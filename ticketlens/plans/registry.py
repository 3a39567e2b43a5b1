"""Registered queries: one Spark plan per operator, each with its DuckDB oracle.

Every query reads the driver tables (or data Spark derives from them) in
full. Doubles are rounded to 6 digits on both sides; counts are BIGINT.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import evaluation as ev
from ..operators import features as fe
from ..operators import folds as fo
from ..operators import labels as lb
from ..operators import prepare as pr
from ..sources import tables
from ..sources import tickets as tk
from . import sql as S
from . import views as V

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, Callable[[], str]] = {}

LABELS = V.PRIORITY_LABELS


def register(name: str, oracle: Callable[[], str] | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn

    return deco


def _r(col):
    return F.round(col, 6)


# ------------------------------------------------------------------ text (P, C)


@register(
    "combine_text",
    lambda: f"WITH {S.TICKETS} SELECT id, {S.combine_text('subject', 'body')} AS ticket_text FROM tickets",
)
def q_combine_text(spark, d):
    t = V.tickets(spark, d, False)
    return t.select("id", tx.combine_text(F.col("subject"), F.col("body")).alias("ticket_text"))


@register(
    "normalize_text",
    lambda: f"WITH {S.prepared_ctes()} SELECT id, ticket_text_clean, ticket_text_length FROM prepared",
)
def q_normalize_text(spark, d):
    return V.prepared(spark, d, grams=False).select("id", pr.CLEANED, F.col(pr.LENGTH).cast("long").alias(pr.LENGTH))


@register(
    "language_norm",
    lambda: f"""SELECT doc_id AS id, {S.language_for_text('lang')} AS language_text,
               {S.language_for_slices('lang')} AS language_slice FROM documents""",
)
def q_language_norm(spark, d):
    docs = tables.table(spark, d, "documents")
    return docs.select(
        F.col("doc_id").alias("id"),
        tx.language_for_text(F.col("lang")).alias("language_text"),
        tx.language_for_slices(F.col("lang")).alias("language_slice"),
    )


@register(
    "stopword_filter",
    lambda: f"""WITH {S.prepared_ctes()}
    SELECT id, CAST(len(split) - len(words) AS BIGINT) AS removed, ticket_text_clean FROM prepared""",
)
def q_stopword_filter(spark, d):
    t = V.tickets(spark, d, False)
    t = t.withColumn("_c", tx.combine_text(F.col("subject"), F.col("body")))
    t = t.withColumn("_n", tx.nfkc(F.col("_c"))).repartition(V.text_pieces(spark, d), "id")
    t = t.withColumn("_s", tx.split_words(tx.normalize_chars(F.col("_n"), use_nfkc=False)))
    t = t.withColumn("_w", tx.remove_stop_words(F.col("_s"), tx.language_for_text(F.col("language"))))
    return t.select(
        "id",
        (F.size("_s") - F.size("_w")).cast("long").alias("removed"),
        F.array_join("_w", " ").alias("ticket_text_clean"),
    )


@register(
    "validate_tickets",
    lambda: f"""WITH {S.TICKETS}
    SELECT id, reason IS NULL AS accepted, reason FROM (
      SELECT id, CASE WHEN subject IS NULL THEN 'missing subject' WHEN length(subject) < 1 THEN 'empty subject'
                      WHEN body IS NULL THEN 'missing body' WHEN length(body) < 1 THEN 'empty body' END AS reason
      FROM tickets)""",
)
def q_validate_tickets(spark, d):
    return tk.validate_requests(V.tickets(spark, d, False)).select("id", "accepted", "reason")


@register(
    "labelled_rows",
    lambda: f"WITH {S.TICKETS} SELECT id, quality, toxic FROM tickets WHERE quality IS NOT NULL",
)
def q_labelled_rows(spark, d):
    return lb.non_null_target(V.tickets(spark, d, True), "quality").select("id", "quality", "toxic")


@register(
    "metric_slug",
    lambda: f"""SELECT r_name AS name, {S.metric_slug('r_name')} AS slug FROM region
    UNION ALL SELECT label, {S.metric_slug('label')} FROM (SELECT DISTINCT o_orderpriority AS label FROM orders)""",
)
def q_metric_slug(spark, d):
    region = tables.table(spark, d, "region").select(F.col("r_name").alias("name"))
    prio = tables.table(spark, d, "orders").select(F.col("o_orderpriority").alias("name")).distinct()
    both = region.unionByName(prio)
    return both.select("name", tx.metric_slug(F.col("name")).alias("slug"))


@register(
    "slugify",
    lambda: f"""SELECT n.n_nationkey AS id, {S.run_slug("r.r_name || ' / ' || n.n_name || ' (' || CAST(n.n_nationkey AS VARCHAR) || ')'")} AS slug
    FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey""",
)
def q_slugify(spark, d):
    n = tables.table(spark, d, "nation")
    r = tables.table(spark, d, "region")
    label = F.concat(F.col("r_name"), F.lit(" / "), F.col("n_name"), F.lit(" ("), F.col("n_nationkey").cast("string"), F.lit(")"))
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.col("n_nationkey").alias("id"), tx.run_slug(label).alias("slug")
    )


# ------------------------------------------------------------------ features (F)


@register(
    "token_counts",
    lambda: f"""WITH {S.prepared_ctes()}
    SELECT id, CAST(len(words) AS BIGINT) AS n_words,
           CAST(len(list_filter(words, lambda t: length(t) >= 2)) AS BIGINT) AS n_feature_tokens FROM prepared""",
)
def q_token_counts(spark, d):
    p = V.prepared(spark, d, grams=False)
    return p.select(
        "id",
        F.size(pr.WORDS).cast("long").alias("n_words"),
        F.size(tx.feature_tokens(F.col(pr.WORDS))).cast("long").alias("n_feature_tokens"),
    )


@register(
    "ngram_counts",
    lambda: f"""WITH {S.prepared_ctes()}
    SELECT id, CAST(len(grams) AS BIGINT) AS n_grams,
           CAST(len(list_filter(grams, lambda g: length(g) - length(replace(g, ' ', '')) = 1)) AS BIGINT) AS n_bigrams,
           CAST(len(list_filter(grams, lambda g: length(g) - length(replace(g, ' ', '')) = 2)) AS BIGINT) AS n_trigrams
    FROM grams""",
)
def q_ngram_counts(spark, d):
    p = V.prepared(spark, d)
    spaces = lambda g: F.length(g) - F.length(F.regexp_replace(g, " ", ""))
    return p.select(
        "id",
        F.size("grams").cast("long").alias("n_grams"),
        F.size(F.filter("grams", lambda g: spaces(g) == 1)).cast("long").alias("n_bigrams"),
        F.size(F.filter("grams", lambda g: spaces(g) == 2)).cast("long").alias("n_trigrams"),
    )


@register("term_frequency", lambda: f"WITH {S.tf_ctes()} SELECT id, term, tf FROM tf")
def q_term_frequency(spark, d):
    return V.term_frequency(spark, d)


@register("document_frequency", lambda: f"WITH {S.tf_ctes()} SELECT term, df FROM dfs")
def q_document_frequency(spark, d):
    return fe.packed_document_frequency(V.packed_terms(spark, d), V.text_pieces(spark, d)).select("term", "df")


def _idf(spark, d, **options):
    tf = V.term_frequency(spark, d)
    return tf, fe.idf_table(tf, fe.corpus_size(V.tickets(spark, d, False)), **options)


@register("idf_table", lambda: f"WITH {S.tf_ctes()} SELECT term, df, round(idf, 6) AS idf FROM idf")
def q_idf_table(spark, d):
    return V.text_idf(spark, d).select("term", "df", _r(F.col("idf")).alias("idf"))


@register("tfidf_l2", lambda: f"WITH {S.tf_ctes()} SELECT id, term, tf, round(weight, 6) AS weight FROM tfidf")
def q_tfidf_l2(spark, d):
    tf, idf = V.weighted_terms(spark, d)
    return fe.tfidf_l2(tf, idf).select("id", "term", "tf", _r(F.col("weight")).alias("weight"))


@register(
    "vocabulary_index",
    lambda: f"WITH {S.tf_ctes()} SELECT term, CAST(row_number() OVER (ORDER BY term) - 1 AS BIGINT) AS feature_id FROM idf",
)
def q_vocabulary_index(spark, d):
    return fe.vocabulary_index(V.text_idf(spark, d))


@register("feature_count", lambda: f"WITH {S.tf_ctes()} SELECT CAST(count(*) AS BIGINT) AS feature_count FROM idf")
def q_feature_count(spark, d):
    return V.text_idf(spark, d).agg(F.count(F.lit(1)).alias("feature_count"))


@register(
    "exact_vectors",
    lambda: f"""WITH {S.tf_ctes()}, v AS (SELECT term, row_number() OVER (ORDER BY term) - 1 AS feature_id FROM idf)
    SELECT id, CAST(feature_id AS INTEGER) AS feature_id, round(weight, 6) AS weight FROM tfidf JOIN v USING (term)""",
)
def q_exact_vectors(spark, d):
    """Sparse vectors over the exact vocabulary of all documents, read back as (id, column, weight)."""
    vocabulary = fe.vocabulary_index(V.text_idf(spark, d))
    rows = V.tickets(spark, d, False).select("id")
    made = fe.exact_vectors(V.text_weights(spark, d, vocabulary), vocabulary, rows, vocabulary.count())
    v = F.unwrap_udt("features")
    entries = F.zip_with(v["indices"], v["values"], lambda i, w: F.struct(i.alias("i"), w.alias("w")))
    return made.select("id", F.explode(entries).alias("e")).select("id", F.col("e.i").alias("feature_id"), _r(F.col("e.w")).alias("weight"))


TOPK = 1000


@register(
    "vocabulary_topk",
    lambda: f"""WITH {S.tf_ctes()}
    SELECT term, CAST(sum(tf) AS BIGINT) AS corpus_tf FROM tf WHERE term IN (SELECT term FROM idf)
    GROUP BY term ORDER BY corpus_tf DESC, term LIMIT {TOPK}""",
)
def q_vocabulary_topk(spark, d):
    return fe.vocabulary_topk(V.term_frequency(spark, d), V.text_idf(spark, d), TOPK).select("term", F.col("corpus_tf").cast("long").alias("corpus_tf"))


def _doc_fold_sql() -> str:
    return f"""{S.tf_ctes()},
doc_folds AS {S.folds_sql('tickets', 'id', V.DOC_STRATA)}"""


@register(
    "tfidf_transform_unseen",
    lambda: f"""WITH {_doc_fold_sql()},
    tr_tf AS (SELECT tf.* FROM tf JOIN doc_folds f USING (id) WHERE f.fold <> 1),
    tr_n AS (SELECT count(*) AS n FROM doc_folds WHERE fold <> 1),
    tr_idf AS (SELECT term, ln((1.0 + (SELECT n FROM tr_n)) / (1.0 + df)) + 1.0 AS idf
               FROM (SELECT term, count(*) AS df FROM tr_tf GROUP BY term) WHERE df <= 0.95 * (SELECT n FROM tr_n)),
    te_tf AS (SELECT tf.* FROM tf JOIN doc_folds f USING (id) WHERE f.fold = 1)
    SELECT id, term, tf, round(w / sqrt(sum(w * w) OVER (PARTITION BY id)), 6) AS weight
    FROM (SELECT te_tf.id, te_tf.term, te_tf.tf, te_tf.tf * tr_idf.idf AS w FROM te_tf JOIN tr_idf USING (term))""",
)
def q_tfidf_transform_unseen(spark, d):
    """Fit idf on folds 2..k, transform fold 1: terms unseen in training drop out."""
    folds = V.doc_folds(spark, d).select("id", "fold")
    tagged = V.fold_term_frequency(spark, d).select("id", "term", "tf", F.explode("folds").alias("fold"))
    train_docs = folds.where(F.col("fold") != 1)
    idf = fe.idf_table(tagged.where(F.col("fold") != 1), fe.corpus_size(train_docs))
    test_tf = tagged.where(F.col("fold") == 1).drop("fold")
    return fe.tfidf_l2(test_tf, idf).select("id", "term", "tf", _r(F.col("weight")).alias("weight"))


@register(
    "length_feature",
    lambda: f"""WITH {_doc_fold_sql()},
    j AS (SELECT p.id, p.ticket_text_length, f.fold FROM prepared p JOIN doc_folds f USING (id))
    SELECT id, ticket_text_length,
           round(ticket_text_length / greatest((SELECT max(ticket_text_length) FROM j WHERE fold <> 1)::DOUBLE, 1.0), 6) AS length_feature
    FROM j""",
)
def q_length_feature(spark, d):
    p = V.prepared(spark, d, grams=False).select("id", pr.LENGTH)
    folds = V.doc_folds(spark, d).select("id", "fold")
    j = p.join(folds, "id").withColumn("_train", F.col("fold") != 1)
    out = fe.length_feature(j, "_train", pr.LENGTH)
    return out.select("id", F.col(pr.LENGTH).cast("long").alias(pr.LENGTH), _r(F.col("length_feature")).alias("length_feature"))


# ------------------------------------------------------------- labels, folds (L)


@register(
    "encode_alpha",
    lambda: """SELECT doc_id AS id, lang AS label, CAST(dense_rank() OVER (ORDER BY lang) - 1 AS INTEGER) AS label_id
               FROM documents WHERE lang IS NOT NULL""",
)
def q_encode_alpha(spark, d):
    docs = tables.table(spark, d, "documents").select(F.col("doc_id").alias("id"), F.col("lang").alias("label"))
    return lb.encode_alphabetical(docs.where(F.col("label").isNotNull()), "label")


@register(
    "encode_ordered",
    lambda: f"SELECT o_orderkey AS id, o_orderpriority AS label, {S.priority_code('o_orderpriority')} AS label_id FROM orders",
)
def q_encode_ordered(spark, d):
    o = tables.table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("label"))
    return lb.encode_ordered(o, "label", tables.ORDER_PRIORITY_ORDER)


PARTIAL_ORDER = ("3-MEDIUM", "2-HIGH", "1-URGENT")


@register(
    "unknown_labels",
    lambda: f"SELECT DISTINCT o_orderpriority AS label FROM orders WHERE o_orderpriority NOT IN ({', '.join(S.q(v) for v in PARTIAL_ORDER)})",
)
def q_unknown_labels(spark, d):
    o = tables.table(spark, d, "orders")
    return lb.unknown_labels(o, "o_orderpriority", PARTIAL_ORDER)


@register(
    "decode_labels",
    lambda: f"""WITH {S.outcomes_ctes()}
    SELECT id, list_extract({S.str_list(tables.ORDER_PRIORITY_ORDER)}, y + 1) AS actual_label,
               list_extract({S.str_list(tables.ORDER_PRIORITY_ORDER)}, yhat + 1) AS predicted_label FROM outcomes""",
)
def q_decode_labels(spark, d):
    o = V.outcomes(spark, d)
    names = tables.ORDER_PRIORITY_ORDER
    o = lb.decode_labels(o, "y", names, "actual_label")
    return lb.decode_labels(o, "yhat", names, "predicted_label").select("id", "actual_label", "predicted_label")


@register(
    "class_distribution",
    lambda: "SELECT o_orderpriority AS label, CAST(count(*) AS BIGINT) AS count FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY 1",
)
def q_class_distribution(spark, d):
    return lb.class_distribution(tables.table(spark, d, "orders"), "o_orderpriority")


@register(
    "class_weights",
    lambda: """SELECT label, count, round((SELECT count(*) FROM orders WHERE o_orderpriority IS NOT NULL)::DOUBLE
                      / ((SELECT count(DISTINCT o_orderpriority) FROM orders) * count), 6) AS weight
               FROM (SELECT o_orderpriority AS label, CAST(count(*) AS BIGINT) AS count FROM orders
                     WHERE o_orderpriority IS NOT NULL GROUP BY 1)""",
)
def q_class_weights(spark, d):
    w = lb.balanced_weights(tables.table(spark, d, "orders"), "o_orderpriority")
    return w.select("label", "count", _r(F.col("weight")).alias("weight"))


@register(
    "stratum_key",
    lambda: """SELECT o_orderkey AS id, coalesce(o_orderpriority, '__missing__') || '__|__' || coalesce(o_orderstatus, '__missing__') AS stratum
               FROM orders""",
)
def q_stratum_key(spark, d):
    o = tables.table(spark, d, "orders")
    return o.select(F.col("o_orderkey").alias("id"), fo.stratum_key(o, ["o_orderpriority", "o_orderstatus"]).alias("stratum"))


SMALL_STRATA_K = 10


@register(
    "small_strata",
    lambda: f"""WITH {S.TICKETS}
    SELECT stratum, CAST(count(*) AS BIGINT) AS count FROM (
      SELECT coalesce(quality, '__missing__') || '__|__' || coalesce(toxic, '__missing__') AS stratum FROM tickets)
    GROUP BY stratum HAVING count(*) < {SMALL_STRATA_K}""",
)
def q_small_strata(spark, d):
    return fo.small_strata(V.tickets(spark, d, True), V.DOC_STRATA, SMALL_STRATA_K)


@register(
    "stratified_folds",
    lambda: f"WITH {S.ORDERS_BASE}, f AS {S.folds_sql('order_rows', 'id', V.ORDER_STRATA)} SELECT id, stratum, fold FROM f",
)
def q_stratified_folds(spark, d):
    return V.order_folds(spark, d).select("id", "stratum", "fold")


@register(
    "fold_split_counts",
    lambda: f"""WITH {S.ORDERS_BASE}, f AS {S.folds_sql('order_rows', 'id', V.ORDER_STRATA)}
    SELECT fold, CAST(count(*) AS BIGINT) AS test_rows, CAST((SELECT count(*) FROM f) - count(*) AS BIGINT) AS train_rows
    FROM f GROUP BY fold""",
)
def q_fold_split_counts(spark, d):
    return fo.fold_split_counts(V.order_folds(spark, d))


@register(
    "prediction_alignment",
    lambda: """WITH truth AS (SELECT doc_id AS id, quality AS y FROM labels),
    pred AS (SELECT doc_id AS id, CAST(n_chars > 500 AS INTEGER) AS yhat FROM documents)
    SELECT CAST(count(*) FILTER (WHERE t.id IS NOT NULL AND p.id IS NOT NULL) AS BIGINT) AS aligned,
           CAST(count(*) FILTER (WHERE p.id IS NULL) AS BIGINT) AS truth_only,
           CAST(count(*) FILTER (WHERE t.id IS NULL) AS BIGINT) AS prediction_only,
           CAST(count(*) FILTER (WHERE t.y = p.yhat) AS BIGINT) AS agreeing
    FROM truth t FULL OUTER JOIN pred p ON t.id = p.id""",
)
def q_prediction_alignment(spark, d):
    """Truth (labels) ⋈ predictions (every document) on the row id.

    Rows present on one side only are counted instead of being silently
    paired by position; the reference raises on a length mismatch.
    """
    truth = tables.table(spark, d, "labels").select(F.col("doc_id").alias("id"), F.col("quality").alias("y"))
    pred = tables.table(spark, d, "documents").select(
        F.col("doc_id").alias("id"), (F.col("n_chars") > 500).cast("int").alias("yhat")
    )
    return ev.alignment_counts(truth, pred)


@register(
    "aligned_outcomes",
    lambda: """SELECT l.doc_id AS id, CAST(l.quality AS INTEGER) AS y, CAST(d.n_chars > 500 AS INTEGER) AS yhat
    FROM labels l JOIN documents d ON d.doc_id = l.doc_id""",
)
def q_aligned_outcomes(spark, d):
    """Every labelled row with its prediction; the query fails if a side lacks a row."""
    labels = tables.table(spark, d, "labels").select(F.col("doc_id").alias("id"), F.col("quality").cast("int").alias("y"))
    docs = tables.table(spark, d, "documents").join(labels.select(F.col("id").alias("doc_id")), "doc_id", "left_semi")
    return ev.align(labels, docs.select(F.col("doc_id").alias("id"), (F.col("n_chars") > 500).cast("int").alias("yhat")))


# ---------------------------------------------------------------- evaluation (E)


def _cube(spark, d, rule=0):
    # The cube has at most folds × languages × k² rows and feeds several
    # aggregates of one query; persisting it keeps the outcomes pass single.
    return ev.outcome_cube(V.outcomes(spark, d, rule)).persist(StorageLevel.MEMORY_AND_DISK)


@register(
    "fold_metrics",
    lambda: f"WITH {S.cube_ctes(LABELS)} SELECT fold, round(accuracy, 6) AS accuracy, round(macro_f1, 6) AS macro_f1 FROM fold_m",
)
def q_fold_metrics(spark, d):
    return ev.fold_metrics(_cube(spark, d), LABELS)


@register(
    "per_class_metrics",
    lambda: f"""WITH {S.cube_ctes(LABELS)}
    SELECT fold, label_id, label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
           CAST(support AS BIGINT) AS support FROM prf_f""",
)
def q_per_class_metrics(spark, d):
    return ev.per_class_metrics(_cube(spark, d), LABELS)


@register(
    "confusion_dense",
    lambda: f"""WITH {S.cube_ctes(LABELS)}
    SELECT f.fold, a.label_id AS actual_label_id, a.label AS actual_label, p.label_id AS predicted_label_id, p.label AS predicted_label,
           CAST(coalesce((SELECT sum(n) FROM cube c WHERE c.fold = f.fold AND c.y = a.label_id AND c.yhat = p.label_id), 0) AS BIGINT) AS count
    FROM (SELECT DISTINCT fold FROM cube) f, lbl a, lbl p""",
)
def q_confusion_dense(spark, d):
    return ev.confusion_dense(_cube(spark, d), LABELS)


@register(
    "ovr_confusion",
    lambda: f"""WITH {S.cube_ctes(LABELS)}
    SELECT fold, label_id, label, CAST(tp AS BIGINT) AS tp, CAST(predicted - tp AS BIGINT) AS fp,
           CAST(support - tp AS BIGINT) AS fn, CAST(total - predicted - support + tp AS BIGINT) AS tn FROM stats_f""",
)
def q_ovr_confusion(spark, d):
    return ev.ovr_confusion(_cube(spark, d), LABELS)


@register(
    "language_metrics",
    lambda: f"""WITH {S.cube_ctes(LABELS)}
    SELECT fold, language, round(accuracy, 6) AS accuracy, round(macro_f1, 6) AS macro_f1, CAST(sample_count AS BIGINT) AS sample_count
    FROM lang_m""",
)
def q_language_metrics(spark, d):
    return ev.language_metrics(_cube(spark, d), LABELS)


@register(
    "metrics_grouping_sets",
    lambda: f"""WITH {S.cube_ctes(LABELS)}
    SELECT fold, 'overall' AS slice, round(accuracy, 6) AS accuracy, round(macro_f1, 6) AS macro_f1, CAST(sample_count AS BIGINT) AS sample_count FROM fold_m
    UNION ALL
    SELECT fold, language, round(accuracy, 6), round(macro_f1, 6), CAST(sample_count AS BIGINT) FROM lang_m""",
)
def q_metrics_grouping_sets(spark, d):
    return ev.metrics_grouping_sets(V.outcomes(spark, d), LABELS)


@register(
    "grouping_sets_null_targets",
    lambda: f"""WITH {S.cube_ctes(QUALITY_LABELS, outcomes=_quality_outcomes_sql())}
    SELECT fold, 'overall' AS slice, round(accuracy, 6) AS accuracy, round(macro_f1, 6) AS macro_f1, CAST(sample_count AS BIGINT) AS sample_count FROM fold_m
    UNION ALL
    SELECT fold, language, round(accuracy, 6), round(macro_f1, 6), CAST(sample_count AS BIGINT) FROM lang_m""",
)
def q_grouping_sets_null_targets(spark, d):
    """All documents, most without a target: only those with one count."""
    folds = V.doc_folds(spark, d).select("id", "fold", "language", F.col("quality").cast("int").alias("y"))
    docs = tables.table(spark, d, "documents").select(F.col("doc_id").alias("id"), (F.col("n_chars") > 500).cast("int").alias("yhat"))
    return ev.metrics_grouping_sets(folds.join(docs, "id"), QUALITY_LABELS)


@register(
    "cv_overall",
    lambda: f"WITH {S.cube_ctes(LABELS)} SELECT {S.ms('accuracy')}, {S.ms('macro_f1')} FROM fold_m",
)
def q_cv_overall(spark, d):
    return ev.cv_overall(_cube(spark, d), LABELS)


@register(
    "cv_per_class",
    lambda: f"""WITH {S.cube_ctes(LABELS)}
    SELECT label_id, label, {S.ms('precision')}, {S.ms('recall')}, {S.ms('f1')}, {S.ms('support')}
    FROM (SELECT label_id, label, precision, recall, f1, support::DOUBLE AS support FROM prf_f) GROUP BY label_id, label""",
)
def q_cv_per_class(spark, d):
    return ev.cv_per_class(_cube(spark, d), LABELS)


@register(
    "cv_ovr",
    lambda: f"""WITH {S.cube_ctes(LABELS)}
    SELECT label_id, label, {S.ms('tp')}, {S.ms('fp')}, {S.ms('fn')}, {S.ms('tn')}
    FROM (SELECT label_id, label, tp, predicted - tp AS fp, support - tp AS fn, total - predicted - support + tp AS tn FROM stats_f)
    GROUP BY label_id, label""",
)
def q_cv_ovr(spark, d):
    return ev.cv_ovr(_cube(spark, d), LABELS)


def _confusion_long_sql() -> str:
    return f"""{S.cube_ctes(LABELS)},
dense AS (SELECT f.fold, a.label_id AS actual_label_id, a.label AS actual_label, p.label_id AS predicted_label_id, p.label AS predicted_label,
           coalesce((SELECT sum(n) FROM cube c WHERE c.fold = f.fold AND c.y = a.label_id AND c.yhat = p.label_id), 0) AS count
          FROM (SELECT DISTINCT fold FROM cube) f, lbl a, lbl p),
conf AS (SELECT actual_label_id, actual_label, predicted_label_id, predicted_label, {S.ms('count')} FROM dense GROUP BY ALL)"""


@register("cv_confusion_long", lambda: f"WITH {_confusion_long_sql()} SELECT * FROM conf")
def q_cv_confusion_long(spark, d):
    return ev.cv_confusion_long(_cube(spark, d), LABELS)


def _pivot_sql(stat: str) -> str:
    names = sorted(n for _, n in LABELS)
    cols = ", ".join(
        f"coalesce(max(CASE WHEN predicted_label = {S.q(n)} THEN count_{stat} END), 0.0) AS \"{n}\"" for n in names
    )
    return f"WITH {_confusion_long_sql()} SELECT actual_label, {cols} FROM conf GROUP BY actual_label"


@register("confusion_matrix_mean", lambda: _pivot_sql("mean"))
def q_confusion_matrix_mean(spark, d):
    return ev.confusion_matrix(_cube(spark, d), LABELS, "mean")


@register("confusion_matrix_std", lambda: _pivot_sql("std"))
def q_confusion_matrix_std(spark, d):
    return ev.confusion_matrix(_cube(spark, d), LABELS, "std")


@register(
    "cv_language",
    lambda: f"""WITH {S.cube_ctes(LABELS)}
    SELECT language, {S.ms('accuracy')}, {S.ms('macro_f1')}, {S.ms('sample_count')}
    FROM (SELECT language, accuracy, macro_f1, sample_count::DOUBLE AS sample_count FROM lang_m) GROUP BY language""",
)
def q_cv_language(spark, d):
    return ev.cv_language(_cube(spark, d), LABELS)


def _metrics_long_sql() -> str:
    def slug(x):
        return S.metric_slug(x)

    def rows(src, name_expr, metrics, infix):
        parts = []
        for m in metrics:
            for stat in ("mean", "std"):
                key = f"'cv_{m}_{stat}{infix}' || {name_expr}" if name_expr else f"'cv_{m}_{stat}'"
                parts.append(f"SELECT {key} AS key, CAST({m}_{stat} AS DOUBLE) AS value FROM {src}")
        return " UNION ALL ".join(parts)

    return f"""WITH {_confusion_long_sql()},
overall AS (SELECT {S.ms('accuracy')}, {S.ms('macro_f1')} FROM fold_m),
lang AS (SELECT language, {S.ms('accuracy')}, {S.ms('macro_f1')}, {S.ms('sample_count')}
         FROM (SELECT language, accuracy, macro_f1, sample_count::DOUBLE AS sample_count FROM lang_m) GROUP BY language),
pc AS (SELECT label, {S.ms('precision')}, {S.ms('recall')}, {S.ms('f1')}, {S.ms('support')}
       FROM (SELECT label_id, label, precision, recall, f1, support::DOUBLE AS support FROM prf_f) GROUP BY label_id, label),
ovr AS (SELECT label, {S.ms('tp')}, {S.ms('fp')}, {S.ms('fn')}, {S.ms('tn')}
        FROM (SELECT label_id, label, tp, predicted - tp AS fp, support - tp AS fn, total - predicted - support + tp AS tn FROM stats_f)
        GROUP BY label_id, label)
{rows('overall', None, ['accuracy', 'macro_f1'], '')}
UNION ALL {rows('lang', slug('language'), ['accuracy', 'macro_f1', 'sample_count'], '__lang_')}
UNION ALL {rows('pc', slug('label'), ['precision', 'recall', 'f1', 'support'], '__')}
UNION ALL {rows('ovr', slug('label'), ['tp', 'fp', 'fn', 'tn'], '__')}"""


@register("metrics_long", _metrics_long_sql)
def q_metrics_long(spark, d):
    return ev.metrics_long(_cube(spark, d), LABELS)


# ----------------------------------------------------------------- flagship


def _flagship_sql() -> str:
    from .flagship import TOP_TERMS

    return f"""WITH {S.tf_ctes()},
    per_lang AS (SELECT {S.language_for_slices('t.language')} AS language, w.term, round(sum(w.weight), 6) AS weight
                 FROM tfidf w JOIN tickets t USING (id) GROUP BY ALL)
    SELECT language, CAST(rank AS INTEGER) AS rank, term, weight FROM (
      SELECT *, row_number() OVER (PARTITION BY language ORDER BY weight DESC, term) AS rank FROM per_lang)
    WHERE rank <= {TOP_TERMS}"""


@register("top_terms_per_language", _flagship_sql)
def q_top_terms_per_language(spark, d):
    from .flagship import top_terms_per_language

    return top_terms_per_language(spark, d)


# ------------------------------------------------------------ scoring (J4, M8-9)

from ..operators import runs as rn  # noqa: E402
from ..operators import scoring as sc  # noqa: E402
from ..session import scratch_path  # noqa: E402

# The classes scored by the coefficient table (alphabetical
# language codes of the documents table).
SCORE_LABELS = ("de", "en", "es", "fr")


def _scoring_model(idf):
    """(term, idf, coefs): the corpus idf with the deterministic coefficients."""
    return sc.hashed_coefficients(idf.select("term", "idf"), len(SCORE_LABELS))


def _linear_scores_wide(spark, d):
    tf, idf = V.weighted_terms(spark, d)
    ids = tables.table(spark, d, "documents").select(F.col("doc_id").alias("id"))
    return sc.linear_scores_wide(tf, _scoring_model(idf), ids, sc.hashed_intercepts(len(SCORE_LABELS)))


def _scores_sql() -> str:
    k = len(SCORE_LABELS)
    classes = ", ".join(f"({c}, {sc.hashed_intercepts(k)[c]})" for c in range(k))
    return f"""{S.tf_ctes()},
cls AS (SELECT * FROM (VALUES {classes}) AS c(class_id, intercept)),
coef AS (SELECT idf.term, cls.class_id,
                ('0x' || substr(md5(idf.term || ':' || CAST(cls.class_id AS VARCHAR)), 1, 6))::BIGINT / 16777216.0 - 0.5 AS coef
         FROM idf, cls),
sums AS (SELECT w.id, coef.class_id, sum(w.weight * coef.coef) AS s FROM tfidf w JOIN coef USING (term) GROUP BY ALL),
scores AS (SELECT d.doc_id AS id, cls.class_id, coalesce(sums.s, 0.0) + cls.intercept AS score
           FROM documents d CROSS JOIN cls LEFT JOIN sums ON sums.id = d.doc_id AND sums.class_id = cls.class_id)"""


@register(
    "linear_scores",
    lambda: f"WITH {_scores_sql()} SELECT id, CAST(class_id AS INTEGER) AS class_id, round(score, 6) AS score FROM scores",
)
def q_linear_scores(spark, d):
    return sc.scores_long(_linear_scores_wide(spark, d))


def _top2_sql() -> str:
    names = S.str_list(SCORE_LABELS)
    return f"""WITH {_scores_sql()},
ranked AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, class_id DESC) AS r FROM scores)
SELECT b.id, list_extract({names}, b.class_id + 1) AS label, list_extract({names}, s.class_id + 1) AS runner_up_label,
       round(b.score - s.score, 6) AS margin_gap
FROM ranked b JOIN ranked s ON b.id = s.id AND b.r = 1 AND s.r = 2"""


@register("top2_margin", _top2_sql)
def q_top2_margin(spark, d):
    wide = _linear_scores_wide(spark, d)
    t = sc.top2(F.col("scores"), SCORE_LABELS)
    return wide.select("id", t["label"].alias("label"), t["runner_up_label"].alias("runner_up_label"), t["margin_gap"].alias("margin_gap"))


# ------------------------------------------------------------- runs (R4-R6)

# The candidate runs — one task, five prediction rules, each
# with its feature-space size.
RUN_RULES = (0, 1, 2, 3, 4)
RUN_TASK = "priority"


def _run_id(rule: int) -> str:
    return f"{RUN_TASK}-rule-{rule}"


def _feature_columns(rule: int) -> int:
    return 1000 * (rule % 3 + 1)


def _run_outcomes(spark, d):
    folded = V.order_folds(spark, d).withColumn("y", V.priority_code(F.col("priority")))
    rules = F.explode(F.array(*[F.lit(r) for r in RUN_RULES])).alias("_rule")
    wide = folded.select("*", rules)
    exact = F.pmod(F.col("id") + F.col("_rule"), F.lit(5)) < 3
    guess = F.pmod(F.floor(F.col("price")) + F.col("_rule"), F.lit(5)).cast("int")
    return wide.select(
        F.concat(F.lit(f"{RUN_TASK}-rule-"), F.col("_rule").cast("string")).alias("run_id"),
        "fold",
        "id",
        "y",
        F.when(exact, F.col("y")).otherwise(guess).cast("int").alias("yhat"),
    )


def _runs_table(spark, d):
    """The runs are parameters: no pass over the outcomes lists them."""
    rows = [(f"{RUN_TASK}-rule-{r}", RUN_TASK, "rule", 1000 * (r % 3 + 1)) for r in RUN_RULES]
    return spark.createDataFrame(rows, "run_id string, task string, algorithm string, feature_columns long")


def _run_metrics(spark, d):
    return rn.overall_metrics_by_run(_run_outcomes(spark, d), LABELS)


def _run_sql(rules=RUN_RULES) -> str:
    lv = S.labels_values(LABELS)
    rules = ", ".join(f"({r})" for r in rules)
    return f"""{S.ORDERS_BASE},
order_folds AS {S.folds_sql('order_rows', 'id', V.ORDER_STRATA)},
ro AS (SELECT '{RUN_TASK}-rule-' || CAST(rr.r AS VARCHAR) AS run_id, fold, id, y,
              CAST(CASE WHEN (id + rr.r) % 5 < 3 THEN y ELSE (CAST(floor(price) AS BIGINT) + rr.r) % 5 END AS INTEGER) AS yhat, rr.r AS rule
       FROM (SELECT *, {S.priority_code('priority')} AS y FROM order_folds), (VALUES {rules}) AS rr(r)),
lbl AS (SELECT * FROM {lv}),
st AS (SELECT run_id, fold, label_id,
              sum(CASE WHEN y = label_id AND yhat = label_id THEN 1 ELSE 0 END) AS tp,
              sum(CASE WHEN y = label_id THEN 1 ELSE 0 END) AS support,
              sum(CASE WHEN yhat = label_id THEN 1 ELSE 0 END) AS predicted
       FROM ro, lbl GROUP BY run_id, fold, label_id),
pf AS (SELECT run_id, fold, avg({S.f1_expr()}) AS macro_f1 FROM st GROUP BY run_id, fold),
acc AS (SELECT run_id, fold, avg(CASE WHEN y = yhat THEN 1.0 ELSE 0.0 END) AS accuracy FROM ro GROUP BY run_id, fold),
per_fold AS (SELECT * FROM pf JOIN acc USING (run_id, fold)),
wide AS (SELECT run_id, avg(accuracy) AS cv_accuracy_mean, stddev_pop(accuracy) AS cv_accuracy_std,
                avg(macro_f1) AS cv_macro_f1_mean, stddev_pop(macro_f1) AS cv_macro_f1_std FROM per_fold GROUP BY run_id),
run_metrics AS (SELECT run_id, key, round(value, 6) AS value FROM wide
                UNPIVOT (value FOR key IN (cv_accuracy_mean, cv_accuracy_std, cv_macro_f1_mean, cv_macro_f1_std))),
runs AS (SELECT DISTINCT run_id, '{RUN_TASK}' AS task, 'rule' AS algorithm, CAST(1000 * (rule % 3 + 1) AS BIGINT) AS feature_columns FROM ro),
head AS (SELECT run_id,
                max(CASE WHEN key = 'cv_accuracy_mean' THEN value END) AS accuracy_mean,
                max(CASE WHEN key = 'cv_accuracy_std' THEN value END) AS accuracy_std,
                max(CASE WHEN key = 'cv_macro_f1_mean' THEN value END) AS macro_f1_mean,
                max(CASE WHEN key = 'cv_macro_f1_std' THEN value END) AS macro_f1_std
         FROM run_metrics GROUP BY run_id),
board AS (SELECT r.*, h.accuracy_mean, h.accuracy_std, h.macro_f1_mean, h.macro_f1_std,
                 CAST(row_number() OVER (PARTITION BY r.task ORDER BY round(h.macro_f1_mean, {rn.RANK_DIGITS}) DESC,
                                         h.accuracy_mean DESC, r.feature_columns ASC, r.run_id) AS INTEGER) AS rank
          FROM runs r JOIN head h USING (run_id))"""


@register("run_metrics", lambda: f"WITH {_run_sql()} SELECT run_id, key, value FROM run_metrics")
def q_run_metrics(spark, d):
    return _run_metrics(spark, d)


@register("headline_metrics", lambda: f"WITH {_run_sql()} SELECT * FROM head")
def q_headline_metrics(spark, d):
    return rn.headline_metrics(_run_metrics(spark, d))


@register("leaderboard", lambda: f"WITH {_run_sql()} SELECT * FROM board")
def q_leaderboard(spark, d):
    return rn.leaderboard(_runs_table(spark, d), _run_metrics(spark, d))


@register(
    "promoted_runs",
    lambda: f"WITH {_run_sql()} SELECT task, run_id, accuracy_mean, accuracy_std, macro_f1_mean, macro_f1_std FROM board WHERE rank = 1",
)
def q_promoted_runs(spark, d):
    return rn.promoted_runs(rn.leaderboard(_runs_table(spark, d), _run_metrics(spark, d)))


@register(
    "promotion_mismatches",
    lambda: f"""WITH {_run_sql()},
    p AS (SELECT task, run_id AS promoted_run FROM board WHERE rank = 1),
    s AS (SELECT task, run_id AS serving_run FROM (SELECT *, row_number() OVER (PARTITION BY task
            ORDER BY accuracy_mean, run_id) AS worst FROM board) WHERE worst = 1)
    SELECT task, promoted_run, serving_run FROM p FULL OUTER JOIN s USING (task)
    WHERE promoted_run IS DISTINCT FROM serving_run""",
)
def q_promotion_mismatches(spark, d):
    """Promoted runs held against a serving list that still names the least accurate run of each task."""
    board = rn.leaderboard(_runs_table(spark, d), _run_metrics(spark, d))
    serving = board.groupBy("task").agg(F.min_by("run_id", F.struct("accuracy_mean", "run_id")).alias("run_id"))
    return rn.promotion_mismatches(rn.promoted_runs(board), serving)


@register(
    "run_tables_rewritten",
    lambda: f"WITH {_run_sql()} SELECT run_id, '{RUN_TASK}' AS task, key, value FROM run_metrics",
)
def q_run_tables_rewritten(spark, d):
    """The run metrics written, one run of them written again, as by a task that is retried, and read back."""
    path = scratch_path(spark, "run-metrics")
    rows = _run_metrics(spark, d).withColumn("task", F.lit(RUN_TASK))
    rn.write_table(rows, path)
    rn.write_table(rows.where(F.col("run_id") == _run_id(RUN_RULES[1])), path)
    return rn.read_table(spark, path).select("run_id", "task", "key", "value")


#: The run that is staged and never committed.
KILLED_RULE = 4


def _run_store(spark, d) -> str:
    """A store with the rule runs: all staged, all but one committed, one of them written twice."""
    store = scratch_path(spark, "runs")
    named = {"runs": _runs_table(spark, d), "run_metrics": _run_metrics(spark, d).withColumn("task", F.lit(RUN_TASK))}
    attempt = rn.stage_run(store, named)
    for rule in RUN_RULES:
        if rule != KILLED_RULE:
            rn.commit_run(spark, store, _run_id(rule), RUN_TASK, attempt)
    again = rn.stage_run(store, {name: df.where(F.col("run_id") == _run_id(0)) for name, df in named.items()})
    rn.commit_run(spark, store, _run_id(0), RUN_TASK, again)
    return store


def _stored_board(spark, store):
    metrics = rn.read_run_table(spark, store, "run_metrics").drop("task")
    return rn.leaderboard(rn.read_run_table(spark, store, "runs"), metrics)


@register(
    "committed_leaderboard",
    lambda: f"""WITH {_run_sql([r for r in RUN_RULES if r != KILLED_RULE])}
    SELECT run_id, task, algorithm, feature_columns, accuracy_mean, accuracy_std, macro_f1_mean, macro_f1_std, rank FROM board""",
)
def q_committed_leaderboard(spark, d):
    """Ranking of the committed runs of a store: a killed run is not seen, one written twice counts once."""
    board = _stored_board(spark, _run_store(spark, d))
    return board.select("run_id", "task", "algorithm", "feature_columns", "accuracy_mean", "accuracy_std", "macro_f1_mean", "macro_f1_std", "rank")


@register(
    "promoted_current",
    lambda: f"""WITH {_run_sql([r for r in RUN_RULES if r != KILLED_RULE])}
    SELECT task, run_id, accuracy_mean, accuracy_std, macro_f1_mean, macro_f1_std FROM board WHERE rank = 1""",
)
def q_promoted_current(spark, d):
    """What is promoted after a first promotion, a second one, and one that is refused."""
    store = _run_store(spark, d)
    board = _stored_board(spark, store)
    last = board.where(F.col("rank") == board.agg(F.max("rank")).scalar()).withColumn("rank", F.lit(1))
    rn.promote(spark, store, rn.promoted_runs(last))
    best = rn.promoted_runs(board)
    rn.promote(spark, store, best, serving=best.select("task", "run_id"))
    try:
        rn.promote(spark, store, rn.promoted_runs(last), serving=best.select("task", "run_id"))
    except ValueError:
        return rn.read_promoted(spark, store)
    raise AssertionError("a promotion that differs from the serving list was taken")


# ------------------------------------------------------------ scans, sinks (S)


@register(
    "ticket_scan",
    lambda: f"""WITH {S.TICKETS}
    SELECT id, coalesce(subject, '') AS subject, coalesce(body, '') AS body, language FROM tickets""",
)
def q_ticket_scan(spark, d):
    """Tickets written as header CSV (quoted multi-line bodies) and scanned back.

    As after the reference's CSV read, text nulls read as '' (an empty
    quoted field and a missing one are the same thing in CSV).
    """
    path = scratch_path(spark, "tickets-csv")
    t = V.tickets(spark, d, False)
    tk.write_tickets_csv(t, path)
    back = tk.read_tickets_csv(spark, path, schema=tk.REQUEST_SCHEMA)
    return back.select("id", tx.text_or_empty(F.col("subject")).alias("subject"), tx.text_or_empty(F.col("body")).alias("body"), "language")


def _mixed_sql() -> str:
    return f"""WITH {S.TICKETS}, m AS (SELECT id, CASE WHEN id % 3 <> 1 THEN subject END AS subject, body, CASE WHEN id % 3 <> 2 THEN language END AS language FROM tickets)
    SELECT id, {S.combine_text('subject', 'body')} AS ticket_text, {S.language_for_text('language')} AS language FROM m"""


@register("mixed_ticket_scan", _mixed_sql)
def q_mixed_ticket_scan(spark, d):
    """A folder whose files differ: some lack the subject, some the language; what is missing is read as null."""
    path = scratch_path(spark, "mixed-tickets")
    t = V.tickets(spark, d, False)
    t.where("id % 3 = 0").write.parquet(path)
    t.where("id % 3 = 1").drop("subject").write.mode("append").parquet(path)
    t.where("id % 3 = 2").drop("language").write.mode("append").parquet(path)
    back = tk.read_tickets(spark, path, tk.REQUEST_SCHEMA)
    return back.select("id", tx.combine_text(F.col("subject"), F.col("body")).alias("ticket_text"), tx.language_for_text(F.col("language")).alias("language"))


@register(
    "dataset_profile",
    lambda: "SELECT 'documents' AS dataset_id, CAST(count(*) AS BIGINT) AS dataset_row_count FROM documents",
)
def q_dataset_profile(spark, d):
    return tk.dataset_profile(tables.table(spark, d, "documents"), f"{d}/documents.parquet").select("dataset_id", "dataset_row_count")


@register(
    "confusion_unpivot",
    lambda: f"WITH {_confusion_long_sql()} SELECT actual_label, predicted_label, count_mean AS value FROM conf",
)
def q_confusion_unpivot(spark, d):
    """The mean confusion matrix written as CSV, scanned back and unpivoted."""
    matrix = ev.confusion_matrix(_cube(spark, d), LABELS, "mean")
    path = scratch_path(spark, "confusion-csv")
    matrix.coalesce(1).write.option("header", True).csv(path)  # k rows: one small file
    back = spark.read.option("header", True).option("enforceSchema", False).csv(path)
    labels = [c for c in back.columns if c != "actual_label"]
    long = back.unpivot("actual_label", labels, "predicted_label", "value")
    return long.withColumn("value", F.round(F.col("value").cast("double"), 6))


# ------------------------------------------------------ models (M1-M7, M10, S7)

from concurrent.futures import ThreadPoolExecutor  # noqa: E402


from ..streaming import triage as st  # noqa: E402
from . import models as ml  # noqa: E402

def _ml_tickets(spark, d):
    """Tickets with two targets: ``quality`` (binary, mostly missing) and ``lang`` (4 classes)."""
    rows = V.tickets(spark, d, True).withColumn("lang", F.col("language"))
    # a solver's pass runs on as many tasks as there are partitions, whatever the files are
    return rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))


@register(
    "length_vectors",
    lambda: f"""WITH {S.prepared_ctes()}
    SELECT id, CAST({ml.NUM_FEATURES + 1} AS INTEGER) AS columns,
           round(ticket_text_length / greatest((SELECT max(ticket_text_length) FROM prepared)::DOUBLE, 1.0), 6) AS length_feature FROM prepared""",
)
def q_length_vectors(spark, d):
    """Text vector and scaled length put together: the number of columns and the last of them."""
    from pyspark.ml import Pipeline

    rows = V.prepared(spark, d)
    made = Pipeline(stages=ml.feature_stages(length_feature=True)).fit(rows).transform(rows)
    v = F.unwrap_udt("features")
    dense = v["type"] == 1
    columns = F.when(dense, F.size(v["values"])).otherwise(v["size"])
    end = F.lit(-1)  # a ticket without words has a sparse vector without entries
    last = F.when(dense | (F.try_element_at(v["indices"], end) == columns - 1), F.try_element_at(v["values"], end)).otherwise(F.lit(0.0))
    return made.select("id", columns.alias("columns"), _r(last).alias("length_feature"))


@register("fit_logreg")
def q_fit_logreg(spark, d):
    """Multinomial logistic regression on the language target, fitted on all rows."""
    rows = _ml_tickets(spark, d)
    model, labels = ml.fit_task(rows, "lang", "logreg")
    return _with_convergence(model.transform(rows).select("id", F.col("lang").alias("label"), "predicted_label"), model)


def _with_convergence(df: DataFrame, model) -> DataFrame:
    used, converged = ml.iterations(model)
    return df.withColumn("iterations", F.lit(used)).withColumn("converged", F.lit(converged))


@register("fit_linear_svc_multiclass")
def q_fit_linear_svc_multiclass(spark, d):
    """One-vs-rest linear SVM on the language target, per-class weights, fitted on all rows."""
    rows = _ml_tickets(spark, d)
    model, labels = ml.fit_task(rows, "lang", "linear_svc")
    scored = ml.predictions(model, rows, labels)
    return _with_convergence(scored.select("id", F.col("lang").alias("label"), F.col("triage.label").alias("predicted_label"),
        F.col("triage.runner_up_label").alias("runner_up_label"), F.col("triage.margin_gap").alias("margin_gap")), model)


@register("fit_linear_svc")
def q_fit_linear_svc(spark, d):
    """Binary linear SVM on the quality target, applied to every ticket."""
    rows = _ml_tickets(spark, d)
    model, labels = ml.fit_task(rows, "quality", "linear_svc")
    scored = ml.predictions(model, rows, labels)
    return _with_convergence(scored.select(
        "id", F.col("quality").alias("label"), "predicted_label",
        F.col("triage.runner_up_label").alias("runner_up_label"), F.col("triage.margin_gap").alias("margin_gap"),
    ), model)


# The order of the ordinal target.
CARE_ORDER = ("fine", "poor", "toxic")


def _care(quality, toxic):
    return F.when(toxic == 1, "toxic").when(quality == 1, "fine").when(quality == 0, "poor")


def _care_fit(spark, d):
    rows = _ml_tickets(spark, d).withColumn("care", _care(F.col("quality"), F.col("toxic")))
    lb.check_known_labels(rows, "care", CARE_ORDER)
    model, labels = ml.fit_task(rows, "care", "linear_svc", order=CARE_ORDER)
    return model, ml.predictions(model, rows, labels)


@register("fit_linear_svc_ordinal")
def q_fit_linear_svc_ordinal(spark, d):
    """One-vs-rest linear SVM on an ordered target, applied to every ticket."""
    model, scored = _care_fit(spark, d)
    return _with_convergence(scored.select("id", F.col("care").alias("label"), F.col("triage.label").alias("predicted_label"),
        F.col("triage.runner_up_label").alias("runner_up_label"), F.col("triage.margin_gap").alias("margin_gap")), model)


@register(
    "fit_svc_checks",
    lambda: """SELECT CAST(count(*) AS BIGINT) AS n, CAST(count(DISTINCT d.doc_id) AS BIGINT) AS ids,
    CAST(count(l.quality) AS BIGINT) AS labelled, CAST(0 AS BIGINT) AS out_of_order, CAST(0 AS BIGINT) AS wrong_top,
    true AS converged, true AS beats_majority FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
)
def q_fit_svc_checks(spark, d):
    """What must hold of the ordinal SVM's output whatever its coefficients:
    one row a ticket, labels of the given order, the best score on top, more
    labelled rows right than the largest class has."""
    model, scored = _care_fit(spark, d)
    order = F.array(*[F.lit(x) for x in CARE_ORDER])
    best = F.element_at("scores", F.array_position(order, F.col("triage.label")).cast("int")) == F.array_max("scores")
    hits = F.count_if(F.col("care") == F.col("triage.label"))
    largest = F.greatest(*[F.count_if(F.col("care") == x) for x in CARE_ORDER])
    return scored.agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("id").alias("ids"), F.count("quality").alias("labelled"),
        F.count_if(~F.col("triage.label").isin(*CARE_ORDER)).alias("out_of_order"), F.count_if(~best).alias("wrong_top"),
        (hits > largest).alias("beats_majority"),
    ).withColumn("converged", F.lit(ml.iterations(model)[1]))


@register(
    "fit_exact_checks",
    lambda: f"""WITH {S.prepared_ctes()}, g AS (SELECT id, unnest(grams) AS term FROM grams WHERE quality IS NOT NULL),
    n AS (SELECT count(*) AS n FROM tickets WHERE quality IS NOT NULL),
    v AS (SELECT term FROM g GROUP BY term HAVING count(DISTINCT id) <= 0.95 * (SELECT n FROM n))
    SELECT (SELECT CAST(count(*) AS BIGINT) FROM v) AS feature_columns, CAST(count(*) AS BIGINT) AS n, CAST(count(quality) AS BIGINT) AS labelled,
    true AS beats_majority, true AS converged FROM tickets""",
)
def q_fit_exact_checks(spark, d):
    """A linear SVM over the exact vocabulary of its training rows: its columns, and that every ticket is scored."""
    rows = _ml_tickets(spark, d)
    model = ml.fit_exact(rows, "quality")
    scored = st.relational_scorer(model.table, model.intercepts, model.labels)(rows).join(rows.select("id", "quality"), "id")
    right = F.count_if(F.col("quality") == F.col("label"))
    largest = F.greatest(*[F.count_if(F.col("quality") == x) for x in model.labels])
    checks = scored.agg(F.count(F.lit(1)).alias("n"), F.count("quality").alias("labelled"), (right > largest).alias("beats_majority"))
    return checks.select(F.lit(model.feature_columns).cast("long").alias("feature_columns"), "*", F.lit(model.converged).alias("converged"))


CV_STORE = "cv-runs"


def _cv_run(spark, d, algorithm):
    """(store, run_id) of the cross-validated language model, which records itself once a session."""
    key = (spark.sparkContext.applicationId, d, CV_STORE)
    if key not in V._SHARED:
        V._SHARED[key] = scratch_path(spark, CV_STORE)
    store, run_id = V._SHARED[key], f"lang-{algorithm}"
    if key + (algorithm,) not in V._SHARED:
        folds = V.doc_folds(spark, d).withColumn("lang", F.col("language"))
        prepared = pr.with_grams(pr.prepare_tickets(folds, partition_by="id", partitions=V.text_pieces(spark, d)))
        V._SHARED[key + (algorithm,)] = ml.record_cross_validation(spark, store, run_id, prepared, "lang", algorithm)
    return store, run_id, V._SHARED[key + (algorithm,)]


def _cv(spark, d, algorithm="logreg"):
    store, run_id, labels = _cv_run(spark, d, algorithm)
    out = rn.read_run_table(spark, store, "outcomes").where(F.col("run_id") == run_id)
    return out.select("fold", "id", "language", "y", "yhat"), labels


@register("cv_predictions")
def q_cv_predictions(spark, d):
    """Out-of-fold predictions for every labelled row (5 fits, features per fold)."""
    out, _ = _cv(spark, d)
    return out


@register("cv_predictions_svc")
def q_cv_predictions_svc(spark, d):
    """Out-of-fold predictions of the one-vs-rest linear SVM."""
    out, _ = _cv(spark, d, algorithm="linear_svc")
    return out


def _fold_checks_sql() -> str:
    return f"""WITH {S.TICKETS}, doc_folds AS {S.folds_sql('tickets', 'id', V.DOC_STRATA)}
    SELECT fold, CAST(count(*) AS BIGINT) AS n, CAST(count(DISTINCT id) AS BIGINT) AS ids, CAST(sum(id) AS BIGINT) AS id_sum,
           true AS beats_majority, true AS converged FROM doc_folds WHERE language IS NOT NULL GROUP BY fold"""


def _fold_checks(spark, d, algorithm):
    """Fold membership of the out-of-fold predictions, that each fold gets more
    rows right than its largest class has, and that its fit met its tolerance."""
    store, run_id, labels = _cv_run(spark, d, algorithm)
    out, _ = _cv(spark, d, algorithm)
    largest = F.greatest(*[F.count_if(F.col("y") == i) for i in range(len(labels))])
    checks = out.groupBy("fold").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("id").alias("ids"), F.sum("id").alias("id_sum"),
        (F.count_if(F.col("y") == F.col("yhat")) > largest).alias("beats_majority"),
    )
    fits = rn.read_run_table(spark, store, "fits").where(F.col("run_id") == run_id).select("fold", "converged")
    return checks.join(fits, "fold")


@register("cv_fold_checks", _fold_checks_sql)
def q_cv_fold_checks(spark, d):
    return _fold_checks(spark, d, "logreg")


@register("cv_svc_fold_checks", _fold_checks_sql)
def q_cv_svc_fold_checks(spark, d):
    return _fold_checks(spark, d, "linear_svc")


@register(
    "cv_run_checks",
    lambda: """SELECT run_id, 'lang' AS task, CAST((SELECT count(*) FROM documents WHERE lang IS NOT NULL) AS BIGINT) AS outcomes,
    CAST(5 AS BIGINT) AS fits, CAST(4 + 6 * n_lang + 16 * n_lang AS BIGINT) AS metric_keys, true AS ranked
    FROM (VALUES ('lang-linear_svc'), ('lang-logreg')) r(run_id), (SELECT count(DISTINCT lang) AS n_lang FROM documents)""",
)
def q_cv_run_checks(spark, d):
    """The two cross-validations as they recorded themselves: tables of each run and its place in the leaderboard."""
    for algorithm in ("linear_svc", "logreg"):
        store, _, _ = _cv_run(spark, d, algorithm)
    counts = [
        rn.read_run_table(spark, store, name).groupBy("run_id", "task").agg(F.count(F.lit(1)).alias(alias))
        for name, alias in (("outcomes", "outcomes"), ("fits", "fits"), ("run_metrics", "metric_keys"))
    ]
    board = _stored_board(spark, store).select("run_id", (F.col("rank") >= 1).alias("ranked"))
    return counts[0].join(counts[1], ["run_id", "task"]).join(counts[2], ["run_id", "task"]).join(board, "run_id")


@register("cv_model_metrics")
def q_cv_model_metrics(spark, d):
    """All CV metric keys of the fitted language model (metrics over cv_predictions)."""
    store, run_id, _ = _cv_run(spark, d, "logreg")
    return rn.read_run_table(spark, store, "run_metrics").where(F.col("run_id") == run_id).select("key", "value")


@register("triage_batch")
def q_triage_batch(spark, d):
    """Both task models applied to every ticket: label, runner-up and margin per task."""
    rows = _ml_tickets(spark, d)
    with ThreadPoolExecutor(max_workers=2) as pool:  # two independent fits overlap
        fq = pool.submit(ml.fit_task, rows, "quality", "linear_svc")
        fl = pool.submit(ml.fit_task, rows, "lang", "logreg")
        (quality, q_labels), (lang, l_labels) = fq.result(), fl.result()
    prepared = ml.TicketTextPrep().transform(V.tickets(spark, d, False))
    return _apply_tasks(prepared, {"quality": (quality, q_labels), "lang": (lang, l_labels)})


def _apply_tasks(prepared: DataFrame, models: dict) -> DataFrame:
    """Every task's model on the one prepared row: no join, so null and repeated ids stay as they are."""
    out = prepared
    for name, (model, labels) in models.items():
        before = out.columns
        scored = ml.predictions(PipelineModelTail(model), out, labels)
        out = scored.withColumnRenamed("triage", name).select(*before, name)
    return out.select(
        "id",
        *[F.col(f"{t}.{f}").alias(f"{t}_{f}") for t in models for f in ("label", "runner_up_label", "margin_gap")],
    )


def PipelineModelTail(model):
    """The fitted stages after text preparation (input already prepared)."""
    from pyspark.ml import PipelineModel

    return PipelineModel([s for s in model.stages if not isinstance(s, ml.TicketTextPrep)])


@register("model_roundtrip")
def q_model_roundtrip(spark, d):
    """Fitted pipeline saved to the shared folder, loaded back and applied."""
    from pyspark.ml import PipelineModel

    rows = _ml_tickets(spark, d)
    model, _ = ml.fit_task(rows, "lang", "logreg")
    path = scratch_path(spark, "model-lang")
    model.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    return loaded.transform(rows).select("id", "predicted_label")


# ------------------------------------------------------------ streaming (X1)


#: Most buckets that Spark allows a table by default.
MAX_BUCKETS = 100_000


def _streaming_sql() -> str:
    return f"""{_top2_sql()}
WHERE b.id IN (SELECT id FROM tickets WHERE length(subject) >= 1 AND length(body) >= 1)"""


def _stored_model(spark, d):
    """The scoring model, written once for all micro-batches, in buckets by term: no batch exchanges it.

    Only (term, idf) is stored; the coefficients, four times as wide and made from the
    term, are added where the rows meet. There are as many buckets as the exchange
    that counts the terms has partitions, so a task writes whole buckets.
    """
    _, idf = _idf(spark, d)
    buckets = int(spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum"))
    path = scratch_path(spark, "scoring-model")
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    stored = idf.select("term", "idf").write.format("parquet").option("path", path).option("compression", "zstd")
    stored.bucketBy(min(buckets, MAX_BUCKETS), "term").saveAsTable(name)
    return _scoring_model(spark.table(name)).hint("shuffle_hash")


def _replay(spark, d):
    """The (accepted, rejected) sinks after the tickets ran through the stream."""
    model = _stored_model(spark, d)
    source = st.write_request_files(V.tickets(spark, d, False), scratch_path(spark, "requests"))
    scorer = st.relational_scorer(model, sc.hashed_intercepts(len(SCORE_LABELS)), SCORE_LABELS, V.text_pieces(spark, d))
    return st.run_triage_stream(spark, source, scorer)


@register("streaming_triage", _streaming_sql)
def q_streaming_triage(spark, d):
    """Tickets replayed as a stream; accepted ones scored with the corpus model.

    The model (idf + coefficient tables) is fitted on the batch corpus and
    written; the stream re-prepares each micro-batch and joins against it.
    """
    accepted, _ = _replay(spark, d)
    return spark.read.parquet(accepted).drop("epoch")


def _triage_requests_sql() -> str:
    return f"""WITH {S.TICKETS}, v AS (
    SELECT id, CASE WHEN subject IS NULL THEN 'missing subject' WHEN length(subject) < 1 THEN 'empty subject'
                    WHEN body IS NULL THEN 'missing body' WHEN length(body) < 1 THEN 'empty body' END AS reason FROM tickets)
    SELECT v.id, v.reason IS NULL AS accepted, v.reason, CASE WHEN v.reason IS NULL THEN b.label END AS label
    FROM v LEFT JOIN ({_top2_sql()}) b ON b.id = v.id"""


@register("triage_requests", _triage_requests_sql)
def q_triage_requests(spark, d):
    """Every request of the stream: the accepted ones with their label, the rejected ones with the reason."""
    accepted, rejected = _replay(spark, d)
    rows = spark.read.parquet(accepted).select("id", F.lit(True).alias("accepted"), F.lit(None).cast("string").alias("reason"), "label")
    return rows.unionByName(spark.read.parquet(rejected).select("id", F.lit(False).alias("accepted"), "reason", F.lit(None).cast("string").alias("label")))


# ------------------------------------- second outcomes set: zero-support class

# Quality labels with a third class that never occurs.
QUALITY_LABELS = [(0, "0"), (1, "1"), (2, "2")]


def _quality_outcomes(spark, d):
    """labels ⋈ documents: y = quality, yhat = (n_chars > 500), folds on (quality, toxic)."""
    folds = V.doc_folds(spark, d).select("id", "fold", "language")
    labels = tables.table(spark, d, "labels").select(F.col("doc_id").alias("id"), F.col("quality").cast("int").alias("y"))
    docs = tables.table(spark, d, "documents").select(F.col("doc_id").alias("id"), "n_chars")
    return labels.join(docs, "id").join(folds, "id").select(
        "fold", "id", "language", "y", (F.col("n_chars") > 500).cast("int").alias("yhat")
    )


def _quality_outcomes_sql() -> str:
    return f"""{S.TICKETS},
doc_folds AS {S.folds_sql('tickets', 'id', V.DOC_STRATA)},
outcomes AS (SELECT f.fold, l.doc_id AS id, f.language, CAST(l.quality AS INTEGER) AS y,
                    CAST(d.n_chars > 500 AS INTEGER) AS yhat
             FROM labels l JOIN documents d ON l.doc_id = d.doc_id JOIN doc_folds f ON f.id = l.doc_id)"""


@register(
    "zero_support_metrics",
    lambda: f"""WITH {S.cube_ctes(QUALITY_LABELS, outcomes=_quality_outcomes_sql())}
    SELECT fold, label_id, label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
           CAST(support AS BIGINT) AS support FROM prf_f""",
)
def q_zero_support_metrics(spark, d):
    cube = ev.outcome_cube(_quality_outcomes(spark, d)).persist(StorageLevel.MEMORY_AND_DISK)
    return ev.per_class_metrics(cube, QUALITY_LABELS)


@register(
    "zero_support_language",
    lambda: f"""WITH {S.cube_ctes(QUALITY_LABELS, outcomes=_quality_outcomes_sql())}
    SELECT language, {S.ms('accuracy')}, {S.ms('macro_f1')}, {S.ms('sample_count')}
    FROM (SELECT language, accuracy, macro_f1, sample_count::DOUBLE AS sample_count FROM lang_m) GROUP BY language""",
)
def q_zero_support_language(spark, d):
    cube = ev.outcome_cube(_quality_outcomes(spark, d)).persist(StorageLevel.MEMORY_AND_DISK)
    return ev.cv_language(cube, QUALITY_LABELS)


def _missing_targets_sql() -> str:
    return f"""WITH {S.TICKETS},
doc_folds AS {S.folds_sql('tickets', 'id', V.DOC_STRATA)}
SELECT f.fold, CAST(count(*) FILTER (l.quality IS NULL) AS BIGINT) AS n_missing_target, CAST(count(*) AS BIGINT) AS n
FROM doc_folds f LEFT JOIN labels l ON l.doc_id = f.id GROUP BY f.fold"""


@register("missing_targets", _missing_targets_sql)
def q_missing_targets(spark, d):
    """Documents without a quality target, by fold: what fit and evaluation leave out."""
    labels = tables.table(spark, d, "labels").select(F.col("doc_id").alias("id"), F.col("quality").alias("y"))
    return ev.missing_targets(V.doc_folds(spark, d).select("id", "fold").join(labels, "id", "left"))


@register(
    "cv_idf_by_subtraction",
    lambda: f"""WITH {_doc_fold_sql()},
    ks AS (SELECT DISTINCT fold AS k FROM doc_folds),
    tr AS (SELECT ks.k AS fold, tf.term, count(*) AS df FROM tf JOIN doc_folds f USING (id), ks WHERE f.fold <> ks.k GROUP BY ks.k, tf.term),
    ntr AS (SELECT ks.k AS fold, count(*) AS n FROM doc_folds f, ks WHERE f.fold <> ks.k GROUP BY ks.k)
    SELECT tr.fold, tr.term, CAST(tr.df AS BIGINT) AS df, round(ln((1.0 + ntr.n) / (1.0 + tr.df)) + 1.0, 6) AS idf
    FROM tr JOIN ntr USING (fold) WHERE tr.df <= 0.95 * ntr.n""",
)
def q_cv_idf_by_subtraction(spark, d):
    """The k training-side IDF tables of the shared folds from one aggregate."""
    folds = V.doc_folds(spark, d).select("id", "fold")
    out = fe.fold_idf_tables(V.fold_term_frequency(spark, d), folds, V.N_FOLDS)
    return out.select("fold", "term", "df", _r(F.col("idf")).alias("idf"))


@register("streaming_model_triage")
def q_streaming_model_triage(spark, d):
    """Request files replayed as a stream and scored by the fitted task models
    (language: logistic regression; quality: linear SVM) in each micro-batch —
    the serving pipeline, no oracle (model fits)."""
    rows = _ml_tickets(spark, d)
    with ThreadPoolExecutor(max_workers=2) as pool:
        fq = pool.submit(ml.fit_task, rows, "quality", "linear_svc")
        fl = pool.submit(ml.fit_task, rows, "lang", "logreg")
        models = {"quality": fq.result(), "lang": fl.result()}

    def score(batch: DataFrame) -> DataFrame:
        return _apply_tasks(ml.TicketTextPrep().transform(batch), models)

    source = st.write_request_files(V.tickets(spark, d, False), scratch_path(spark, "model-requests"))
    accepted, _ = st.run_triage_stream(spark, source, score)
    return spark.read.parquet(accepted).drop("epoch")


# Intercept lead of the two promoted scorers, each for a class of its own.
PROMOTED_LEADS = ((0, 5.0), (2, 5.0))


def _led_intercepts(version: int) -> list[float]:
    at, lead = PROMOTED_LEADS[version]
    return [b + (lead if c == at else 0.0) for c, b in enumerate(sc.hashed_intercepts(len(SCORE_LABELS)))]


def _promoted_stream_sql() -> str:
    at = [f"CASE WHEN id % 2 = 0 THEN {list_[0]} ELSE {list_[1]} END" for list_ in zip(_led_intercepts(0), _led_intercepts(1))]
    shift = " ".join(f"WHEN {c} THEN {e} - ({b})" for c, (e, b) in enumerate(zip(at, sc.hashed_intercepts(len(SCORE_LABELS)))))
    names = S.str_list(SCORE_LABELS)
    return f"""WITH {_scores_sql()},
led AS (SELECT id, class_id, score + CASE class_id {shift} END AS score FROM scores),
ranked AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, class_id DESC) AS r FROM led)
SELECT id, CAST(id % 2 AS BIGINT) AS epoch, list_extract({names}, class_id + 1) AS label FROM ranked
WHERE r = 1 AND id IN (SELECT id FROM tickets WHERE length(subject) >= 1 AND length(body) >= 1)"""


@register("streaming_promotion", _promoted_stream_sql)
def q_streaming_promotion(spark, d):
    """A stream of two epochs, even ids and then odd ones; a second scorer is promoted when the first
    epoch is done, and the second epoch is scored with it."""
    model = _stored_model(spark, d)
    store, source = scratch_path(spark, "serving"), scratch_path(spark, "requests")

    def promote(version: int) -> None:
        rows = [("triage", f"lead-{version}", _led_intercepts(version))]
        rn.promote(spark, store, spark.createDataFrame(rows, "task string, run_id string, intercepts array<double>"))

    def load(promoted: DataFrame):
        return st.relational_scorer(model, promoted.first()["intercepts"], SCORE_LABELS, V.text_pieces(spark, d))

    follow = st.promoted_scorer(spark, store, load)
    requests = V.tickets(spark, d, False)
    promote(0)
    sinks = scratch_path(spark, "promotion-sink"), scratch_path(spark, "promotion-checkpoint")
    for epoch in (0, 1):  # the stream goes on from its checkpoint
        st.write_request_files(requests.where(F.col("id") % 2 == epoch), f"{source}/part={epoch}")
        accepted, _ = st.run_triage_stream(spark, f"{source}/part=*", follow, *sinks)
        promote(1)
    return spark.read.parquet(accepted).select("id", F.col("epoch").cast("long").alias("epoch"), "label")


@register(
    "streaming_counts",
    lambda: f"""WITH {S.TICKETS} SELECT CAST(0 AS BIGINT) AS epoch, CAST(count(*) AS BIGINT) AS requests,
    CAST(count(*) FILTER (length(subject) >= 1 AND length(body) >= 1) AS BIGINT) AS accepted,
    CAST(count(*) - count(*) FILTER (length(subject) >= 1 AND length(body) >= 1) AS BIGINT) AS rejected FROM tickets""",
)
def q_streaming_counts(spark, d):
    """Requests, accepted and rejected rows of every epoch, observed while the epoch was scored."""
    accepted, _ = _replay(spark, d)
    counts = spark.read.parquet(accepted.replace("/accepted", "/counts"))
    return counts.select(F.col("epoch").cast("long").alias("epoch"), "requests", "accepted", "rejected")
