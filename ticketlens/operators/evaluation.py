"""Fold evaluation and cross-validation summaries as DataFrame aggregations.

Input: one outcomes table ``(fold, id, language, y, yhat)`` with integer
class ids, plus the label list ``[(label_id, label), ...]`` (a parameter,
in the order that defines the ids).

The only pass over the outcomes is ``outcome_cube``: a partial + final
aggregate to ``(fold, language, y, yhat, n)``. Its size is bounded by
folds × languages × k², independent of the corpus, and every table below is
derived from it with conditional sums over the given label list, or a join of
the label grid with the cube (classes absent from a fold keep their zero
rows), so nothing joins or densifies against the raw rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx

ROUND = 6


def _r(col: Column) -> Column:
    return F.round(col, ROUND)


def _safe_div(num: Column, den: Column) -> Column:
    return F.when(den == 0, F.lit(0.0)).otherwise(num.cast("double") / den.cast("double"))


def outcome_cube(outcomes: DataFrame, language_col: str | None = "language") -> DataFrame:
    """(fold, language, y, yhat, n); language normalised for slicing, rows without a target left out."""
    lang = tx.language_for_slices(F.col(language_col)) if language_col else F.lit(None).cast("string")
    outcomes = outcomes.where(F.col("y").isNotNull())
    return outcomes.groupBy(F.col("fold"), lang.alias("language"), F.col("y"), F.col("yhat")).agg(
        F.count(F.lit(1)).alias("n")
    )


def missing_targets(outcomes: DataFrame) -> DataFrame:
    """(fold, n_missing_target, n): rows that the metrics leave out, by fold."""
    return outcomes.groupBy("fold").agg(F.count_if(F.col("y").isNull()).alias("n_missing_target"), F.count(F.lit(1)).alias("n"))


def alignment_counts(truth: DataFrame, predicted: DataFrame, id_col: str = "id") -> DataFrame:
    """One row (aligned, truth_only, prediction_only, agreeing) over (id, y) and (id, yhat)."""
    j = _sides(truth, predicted, id_col)
    return j.agg(
        F.count_if(F.col("_t").isNotNull() & F.col("_p").isNotNull()).alias("aligned"),
        F.count_if(F.col("_p").isNull()).alias("truth_only"),
        F.count_if(F.col("_t").isNull()).alias("prediction_only"),
        F.count_if(F.col("y") == F.col("yhat")).alias("agreeing"),
    )


def align(truth: DataFrame, predicted: DataFrame, id_col: str = "id") -> DataFrame:
    """truth ⋈ predicted on the row id; a row that the other side lacks fails the query and is named.

    Ids have to be unique on both sides, as rows are paired by them; a null id pairs with none.
    """
    j = _sides(truth, predicted, id_col)
    lacks = F.when(F.col("_p").isNull(), F.lit("no prediction for the row ")).when(F.col("_t").isNull(), F.lit("no truth for the row "))
    name = F.coalesce(F.col("_t.id"), F.col("_p.id")).cast("string")
    checked = F.when(lacks.isNotNull(), F.raise_error(F.concat(lacks, F.coalesce(name, F.lit("without an id"))))).otherwise(F.col("_t.id"))
    kept = [c for c in truth.columns if c != id_col] + [c for c in predicted.columns if c != id_col]
    return j.select(checked.cast(truth.schema[id_col].dataType).alias(id_col), *kept)


def _sides(truth: DataFrame, predicted: DataFrame, id_col: str) -> DataFrame:
    t = truth.select(F.struct(F.col(id_col).alias("id")).alias("_t"), *[c for c in truth.columns if c != id_col])
    p = predicted.select(F.struct(F.col(id_col).alias("id")).alias("_p"), *[c for c in predicted.columns if c != id_col])
    return t.join(p, F.col("_t.id") == F.col("_p.id"), "full_outer")


def _label_ids(labels):
    return [int(i) for i, _ in labels]


def class_stats(cube: DataFrame, labels, group_cols) -> DataFrame:
    """(group…, label_id, label, tp, support, predicted, total) for every listed class."""
    aggs = [F.sum("n").alias("total"), F.sum(F.when(F.col("y") == F.col("yhat"), F.col("n")).otherwise(0)).alias("correct")]
    for i in _label_ids(labels):
        aggs += [
            F.sum(F.when((F.col("y") == i) & (F.col("yhat") == i), F.col("n")).otherwise(0)).alias(f"tp_{i}"),
            F.sum(F.when(F.col("y") == i, F.col("n")).otherwise(0)).alias(f"sup_{i}"),
            F.sum(F.when(F.col("yhat") == i, F.col("n")).otherwise(0)).alias(f"pred_{i}"),
        ]
    wide = cube.groupBy(*group_cols).agg(*aggs)
    rows = F.array(
        *[
            F.struct(
                F.lit(i).cast("int").alias("label_id"),
                F.lit(str(name)).alias("label"),
                F.col(f"tp_{i}").alias("tp"),
                F.col(f"sup_{i}").alias("support"),
                F.col(f"pred_{i}").alias("predicted"),
            )
            for i, name in labels
        ]
    )
    return wide.select(*group_cols, "total", "correct", F.inline(rows))


def _prf(stats: DataFrame) -> DataFrame:
    p = _safe_div(F.col("tp"), F.col("predicted"))
    r = _safe_div(F.col("tp"), F.col("support"))
    f1 = _safe_div(2 * F.col("tp"), 2 * F.col("tp") + (F.col("predicted") - F.col("tp")) + (F.col("support") - F.col("tp")))
    return stats.withColumn("precision", p).withColumn("recall", r).withColumn("f1", f1)


def per_class_metrics(cube: DataFrame, labels) -> DataFrame:
    """(fold, label_id, label, precision, recall, f1, support); zero-support rows kept."""
    stats = _prf(class_stats(cube, labels, ["fold"]))
    return stats.select(
        "fold",
        "label_id",
        "label",
        _r(F.col("precision")).alias("precision"),
        _r(F.col("recall")).alias("recall"),
        _r(F.col("f1")).alias("f1"),
        F.col("support").cast("long").alias("support"),
    )


def _slice_metrics(cube: DataFrame, labels, group_cols) -> DataFrame:
    stats = _prf(class_stats(cube, labels, group_cols))
    return stats.groupBy(*group_cols).agg(
        _safe_div(F.first("correct"), F.first("total")).alias("accuracy"),
        F.avg("f1").alias("macro_f1"),
        F.first("total").cast("long").alias("sample_count"),
    )


def fold_metrics(cube: DataFrame, labels) -> DataFrame:
    """(fold, accuracy, macro_f1): macro-F1 over the given label list."""
    m = _slice_metrics(cube, labels, ["fold"])
    return m.select("fold", _r(F.col("accuracy")).alias("accuracy"), _r(F.col("macro_f1")).alias("macro_f1"))


def language_metrics(cube: DataFrame, labels) -> DataFrame:
    """(fold, language, accuracy, macro_f1, sample_count) per language slice."""
    m = _slice_metrics(cube, labels, ["fold", "language"])
    return m.select(
        "fold",
        "language",
        _r(F.col("accuracy")).alias("accuracy"),
        _r(F.col("macro_f1")).alias("macro_f1"),
        "sample_count",
    )


def metrics_grouping_sets(outcomes: DataFrame, labels) -> DataFrame:
    """Overall and per-language slices from ONE grouping-sets aggregate.

    (fold, slice, accuracy, macro_f1, sample_count) where slice is
    'overall' or the language. Rows without a target are left out.
    """
    lang = tx.language_for_slices(F.col("language"))
    base = outcomes.where(F.col("y").isNotNull()).select("fold", lang.alias("language"), "y", "yhat")
    cube = (
        base.groupingSets([["fold", "y", "yhat"], ["fold", "language", "y", "yhat"]], "fold", "language", "y", "yhat")
        .agg(F.count(F.lit(1)).alias("n"), F.grouping("language").alias("_g"))
        .withColumn("slice", F.when(F.col("_g") == 1, F.lit("overall")).otherwise(F.col("language")))
    )
    m = _slice_metrics(cube, labels, ["fold", "slice"])
    return m.select(
        "fold", "slice", _r(F.col("accuracy")).alias("accuracy"), _r(F.col("macro_f1")).alias("macro_f1"), "sample_count"
    )


def confusion_dense(cube: DataFrame, labels) -> DataFrame:
    """(fold, actual_label_id, actual_label, predicted_label_id, predicted_label, count): k² rows per fold."""
    listed = F.array(*[F.struct(F.lit(int(i)).alias("id"), F.lit(str(name)).alias("label")) for i, name in labels])
    grid = cube.select("fold").distinct().select("fold", F.explode(listed).alias("a")).select("fold", "a", F.explode(listed).alias("p"))
    cells = cube.groupBy(F.col("fold").alias("_fold"), "y", "yhat").agg(F.sum("n").alias("n"))
    same = F.col("fold").eqNullSafe(F.col("_fold")) & (F.col("a.id") == F.col("y")) & (F.col("p.id") == F.col("yhat"))
    return grid.join(cells, same, "left").select(
        "fold", F.col("a.id").alias("actual_label_id"), F.col("a.label").alias("actual_label"), F.col("p.id").alias("predicted_label_id"),
        F.col("p.label").alias("predicted_label"), F.coalesce("n", F.lit(0)).cast("long").alias("count"),
    )


def ovr_confusion(cube: DataFrame, labels) -> DataFrame:
    """(fold, label_id, label, tp, fp, fn, tn) one-vs-rest per class."""
    stats = class_stats(cube, labels, ["fold"])
    return stats.select(
        "fold",
        "label_id",
        "label",
        F.col("tp").cast("long").alias("tp"),
        (F.col("predicted") - F.col("tp")).cast("long").alias("fp"),
        (F.col("support") - F.col("tp")).cast("long").alias("fn"),
        (F.col("total") - F.col("predicted") - F.col("support") + F.col("tp")).cast("long").alias("tn"),
    )


def _mean_std(col: str):
    return [_r(F.avg(col)).alias(f"{col}_mean"), _r(F.stddev_pop(col)).alias(f"{col}_std")]


def cv_overall(cube: DataFrame, labels) -> DataFrame:
    """One row: accuracy and macro-F1 mean and population std over folds; without a fold the query fails."""
    m = _slice_metrics(cube, labels, ["fold"])
    wide = m.agg(*_mean_std("accuracy"), *_mean_std("macro_f1"), F.count(F.lit(1)).alias("_folds"))
    none = F.raise_error(F.lit("no fold to summarise")).cast("double")
    return wide.select(*[F.when(F.col("_folds") == 0, none).otherwise(F.col(c)).alias(c) for c in wide.columns[:-1]])


def cv_per_class(cube: DataFrame, labels) -> DataFrame:
    stats = _prf(class_stats(cube, labels, ["fold"])).withColumn("support", F.col("support").cast("double"))
    return stats.groupBy("label_id", "label").agg(
        *_mean_std("precision"), *_mean_std("recall"), *_mean_std("f1"), *_mean_std("support")
    )


def cv_ovr(cube: DataFrame, labels) -> DataFrame:
    o = ovr_confusion(cube, labels)
    return o.groupBy("label_id", "label").agg(*_mean_std("tp"), *_mean_std("fp"), *_mean_std("fn"), *_mean_std("tn"))


def cv_confusion_long(cube: DataFrame, labels) -> DataFrame:
    c = confusion_dense(cube, labels)
    return c.groupBy("actual_label_id", "actual_label", "predicted_label_id", "predicted_label").agg(
        *_mean_std("count")
    )


def confusion_matrix(cube: DataFrame, labels, stat: str = "mean") -> DataFrame:
    """Pivot of the CV confusion summary: rows and columns sorted by label name."""
    longform = cv_confusion_long(cube, labels)
    names = sorted(str(n) for _, n in labels)
    return (
        longform.groupBy("actual_label")
        .pivot("predicted_label", names)
        .agg(F.first(f"count_{stat}"))
        .na.fill(0.0, subset=names)
    )


def cv_language(cube: DataFrame, labels) -> DataFrame:
    """Per language mean/std over the folds where the language occurs."""
    m = _slice_metrics(cube, labels, ["fold", "language"]).withColumn(
        "sample_count", F.col("sample_count").cast("double")
    )
    return m.groupBy("language").agg(*_mean_std("accuracy"), *_mean_std("macro_f1"), *_mean_std("sample_count"))


def _long(df: DataFrame, name_col: Column, metrics, suffix_fmt: str) -> DataFrame:
    """Unpivot wide mean/std columns to (key, value) with a slug suffix."""
    pairs = F.array(
        *[
            F.struct(
                F.concat(F.lit(f"cv_{m}_"), F.lit(stat), F.lit(suffix_fmt), name_col).alias("key"),
                F.col(f"{m}_{stat}").cast("double").alias("value"),
            )
            for m in metrics
            for stat in ("mean", "std")
        ]
    )
    return df.select(F.inline(pairs))


def metrics_long(cube: DataFrame, labels) -> DataFrame:
    """All CV metrics as (key, value): overall, per language, per class, one-vs-rest."""
    overall = cv_overall(cube, labels)
    overall_long = _long(overall, F.lit(""), ["accuracy", "macro_f1"], "")
    lang = _long(cv_language(cube, labels), tx.metric_slug(F.col("language")), ["accuracy", "macro_f1", "sample_count"], "__lang_")
    per_class = _long(cv_per_class(cube, labels), tx.metric_slug(F.col("label")), ["precision", "recall", "f1", "support"], "__")
    ovr = _long(cv_ovr(cube, labels), tx.metric_slug(F.col("label")), ["tp", "fp", "fn", "tn"], "__")
    return reduce(DataFrame.unionByName, [overall_long, lang, per_class, ovr])
