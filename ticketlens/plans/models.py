"""Spark ML pipelines for the two kinds of task (nominal and ordinal targets).

Serving pipeline (one per task, persisted with ``PipelineModel.save``):

    TicketTextPrep → HashingTF → SmoothIdf (→ ElementwiseProduct) → Normalizer(2)
    → LogisticRegression | LinearSVC | OneVsRest(LinearSVC) → IndexToString

* Features are hashed (``HashingTF``): no vocabulary is collected on the
  driver, so the feature space is a parameter, not a function of the data.
* ``SmoothIdf`` fits Spark's ``IDF`` only for its document frequencies and
  returns a standard ``ElementwiseProduct`` with ln((1+n)/(1+df)) + 1 per
  bucket and 0 for buckets above max_df — the smoothed IDF with pruning.
* Targets are indexed and weighted outside the pipeline (training only), so
  the serving path never needs a target column.
* ``solver`` finds the coefficients; Spark ML's own model classes carry them.
  The penalty is 1 / (C · Σw); with balanced weights Σw = n.
"""

from __future__ import annotations

import uuid
import warnings
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import LinearSVC, LinearSVCModel, LogisticRegressionModel, OneVsRest, OneVsRestModel
from pyspark.ml.feature import (
    IDF,
    CountVectorizerModel,
    ElementwiseProduct,
    HashingTF,
    IndexToString,
    Normalizer,
    SQLTransformer,
    VectorAssembler,
    StringIndexer,
    StringIndexerModel,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseMatrix, Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import evaluation as ev
from ..operators import features as fe
from ..operators import prepare as pr
from ..operators import runs as rn
from ..operators import scoring as sc
from ..session import scratch_path
from . import solver as so


@dataclass(frozen=True)
class TargetKind:
    """The inverse penalty C of a kind of target under either loss."""

    log_loss: float
    hinge: float

    def inverse_penalty(self, algorithm: str) -> float:
        return self.log_loss if algorithm == "logreg" else self.hinge


KINDS = {"nominal": TargetKind(log_loss=2.0, hinge=16.0), "ordinal": TargetKind(log_loss=2.0, hinge=12.0)}
MAX_ITER = 5000
#: Largest gradient entry at which a fit stops: of the mean log loss as it is, of the squared hinge relative to the first gradient's.
TOL = {"logreg": 1e-4, "linear_svc": 1e-3}
NUM_FEATURES = 1 << 18


class TicketTextPrep(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """subject/body/language → words → 1–3-gram array ``grams`` (no shuffle)."""

    ngramMin = Param(Params._dummy(), "ngramMin", "smallest n-gram", TypeConverters.toInt)
    ngramMax = Param(Params._dummy(), "ngramMax", "largest n-gram", TypeConverters.toInt)

    def __init__(self, ngramMin: int = 1, ngramMax: int = 3):
        super().__init__()
        self._setDefault(ngramMin=1, ngramMax=3)
        self._set(ngramMin=ngramMin, ngramMax=ngramMax)

    def _transform(self, df: DataFrame) -> DataFrame:
        out = pr.prepare_tickets(df)
        return pr.with_grams(out, (self.getOrDefault("ngramMin"), self.getOrDefault("ngramMax")))


class SmoothIdf(Estimator, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Smoothed IDF with max_df pruning, fitted into an ElementwiseProduct."""

    maxDf = Param(Params._dummy(), "maxDf", "max document frequency (proportion)", TypeConverters.toFloat)

    def __init__(self, inputCol: str = "tf", outputCol: str = "tfidf", maxDf: float = fe.MAX_DF):
        super().__init__()
        self._setDefault(maxDf=fe.MAX_DF)
        self._set(inputCol=inputCol, outputCol=outputCol, maxDf=maxDf)

    def _fit(self, df: DataFrame) -> Transformer:
        model = IDF(inputCol=self.getInputCol(), outputCol="_idf_unused").fit(df)
        n = float(model.numDocs)
        dfreq = np.asarray(model.docFreq, dtype=float)
        idf = np.log((1.0 + n) / (1.0 + dfreq)) + 1.0
        keep = (dfreq >= 1) & (dfreq <= self.getOrDefault("maxDf") * n)
        scale = np.where(keep, idf, 0.0)
        return ElementwiseProduct(
            scalingVec=Vectors.dense(scale), inputCol=self.getInputCol(), outputCol=self.getOutputCol()
        )


def target_indexer(target: str, order=None):
    """Alphabetical codes for nominal targets, an explicit order for ordinal ones."""
    if order is None:
        return StringIndexer(inputCol=target, outputCol="label_id", stringOrderType="alphabetAsc", handleInvalid="error")
    return StringIndexerModel.from_labels(list(order), inputCol=target, outputCol="label_id", handleInvalid="error")


def class_counts(df: DataFrame, label_col: str = "label_id") -> dict[int, int]:
    """Rows of every class (k rows, bounded by the classes)."""
    return {int(r[0]): int(r[1]) for r in df.groupBy(label_col).count().collect()}


def task_loss(algorithm: str, kind: str, counts: dict[int, int], n_classes: int) -> so.Loss:
    """The objective of a task: balanced classes, penalty 1 / (C * total weight).

    Two classes make one column. More make one softmax, or one squared-hinge
    column a class, in which its rows weigh n / (k * n_c) and all others 1.
    """
    n, c_value = sum(counts.values()), KINDS[kind].inverse_penalty(algorithm)
    present = max(1, sum(1 for v in counts.values() if v))
    held = [counts.get(c, 0) for c in range(n_classes)]
    weight = [n / (present * h) if h else 1.0 for h in held]
    if n_classes == 2:
        total = sum(w * h for w, h in zip(weight, held))
        shape = "logistic" if algorithm == "logreg" else "squared_hinge"
        return so.Loss(shape, (1,), (weight[1] / total,), (weight[0] / total,), (1.0 / (c_value * total),))
    every = tuple(range(n_classes))
    if algorithm == "logreg":
        total = sum(w * h for w, h in zip(weight, held))
        return so.Loss("softmax", every, tuple(w / total for w in weight), (0.0,) * n_classes, (1.0 / (c_value * total),) * n_classes)
    totals = [w * h + n - h for w, h in zip(weight, held)]
    return so.Loss(
        "squared_hinge", every, tuple(w / t for w, t in zip(weight, totals)), tuple(1.0 / t for t in totals),
        tuple(1.0 / (c_value * t) for t in totals),
    )


def _stock_model(algorithm: str, coefs: np.ndarray):
    """The coefficients as Spark ML's own model, which scores and persists."""
    def svc(row):
        return LinearSVCModel._create_from_java_class(
            "org.apache.spark.ml.classification.LinearSVCModel", f"LinearSVC_{uuid.uuid4().hex[:12]}", Vectors.dense(row[:-1]), float(row[-1])
        )

    if algorithm == "logreg":
        k, width = coefs.shape
        matrix = DenseMatrix(k, width - 1, np.ascontiguousarray(coefs[:, :-1]).ravel(), isTransposed=True)
        return LogisticRegressionModel._create_from_java_class(
            "org.apache.spark.ml.classification.LogisticRegressionModel", f"LogisticRegression_{uuid.uuid4().hex[:12]}",
            matrix, Vectors.dense(coefs[:, -1]), max(2, k), k > 1,
        )
    if len(coefs) == 1:
        return svc(coefs[0])
    shape = OneVsRest(classifier=LinearSVC(), featuresCol="features", labelCol="label_id")
    return shape._copyValues(OneVsRestModel(models=[svc(row) for row in coefs]))


def fit_classifier(vectors: DataFrame, algorithm: str, kind: str, n_classes: int, max_iter: int = MAX_ITER, counts: dict[int, int] | None = None):
    """(model, iterations, converged) on the persisted (features, label_id) rows; ``counts``: of the classes, if known."""
    loss = task_loss(algorithm, kind, class_counts(vectors) if counts is None else counts, n_classes)
    width = vectors.select("features").first()[0].size
    coefs, used, converged = so.fit(vectors, loss, width, TOL[algorithm], max_iter)
    return _stock_model(algorithm, coefs), used, converged


def fit_counts(counted: DataFrame, scale: np.ndarray, algorithm: str, kind: str, n_classes: int, max_iter: int = MAX_ITER):
    """``fit_classifier`` on (tf, label_id) rows whose features are the counts times ``scale``, brought to length 1."""
    loss = task_loss(algorithm, kind, class_counts(counted), n_classes)
    coefs, used, converged = so.fit_all(so.sparse_rows(counted, "tf"), [so.Problem(loss, None, scale)], len(scale), TOL[algorithm], max_iter)[0]
    return _stock_model(algorithm, coefs), used, converged


def written_counts(counted: DataFrame, *by: str) -> DataFrame:
    """Rows with count vectors, written to the shared folder: some three bytes an entry, on disk and not in the executors' heaps.

    ``by``: a folder for each value of these columns, so that their rows are read without the others.
    """
    path = scratch_path(counted.sparkSession, "counts")
    counted.write.option("compression", "zstd").partitionBy(*by).parquet(path)
    return counted.sparkSession.read.schema(counted.schema).parquet(path)


def iterations(model: PipelineModel) -> tuple[int, bool]:
    """Iterations of a fit of this session, and whether it met its tolerance."""
    return model.iterations, model.converged


class LengthScaler(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """length / max(max training length, 1.0), fitted into a SQLTransformer."""

    def _fit(self, df: DataFrame) -> Transformer:
        top = df.agg(F.max(F.col(pr.LENGTH).cast("double"))).first()[0]
        scale = max(float(top or 0.0), 1.0)
        return SQLTransformer(
            statement=f"SELECT *, CAST({pr.LENGTH} AS DOUBLE) / {scale!r} AS length_feature FROM __THIS__"
        )


def exact_vocabulary(prepared_rows: DataFrame, max_features: int, id_col: str = "id") -> list[str]:
    """The ``max_features`` most frequent terms after df pruning, term order.

    Computed relationally (distributed top-k); only k terms reach the driver,
    k being a parameter, so exact-vocabulary fits stay bounded.
    """
    tf = fe.term_frequency(prepared_rows.select(id_col, "grams"), id_col)
    idf = fe.idf_table(tf, fe.corpus_size(prepared_rows))
    return sorted(r.term for r in fe.vocabulary_topk(tf, idf, max_features).collect())


def feature_stages(num_features: int = NUM_FEATURES, length_feature: bool = False, vocabulary=None):
    """N-gram TF-IDF (L2) → ``features``; optionally ‖ the scaled length.

    Hashed buckets by default; with ``vocabulary`` (a bounded term list) the
    counts use exactly those terms, in that order.
    """
    text_out = "text_features" if length_feature else "features"
    counts = (
        CountVectorizerModel.from_vocabulary(list(vocabulary), inputCol="grams", outputCol="tf")
        if vocabulary is not None
        else HashingTF(inputCol="grams", outputCol="tf", numFeatures=num_features)
    )
    stages = [
        counts,
        SmoothIdf(inputCol="tf", outputCol="tfidf"),
        Normalizer(inputCol="tfidf", outputCol=text_out, p=2.0),
    ]
    if length_feature:
        stages += [
            LengthScaler(),
            VectorAssembler(inputCols=[text_out, "length_feature"], outputCol="features"),
        ]
    return stages


def fit_task(
    rows: DataFrame,
    target: str,
    algorithm: str = "logreg",
    order=None,
    with_text: bool = True,
    num_features: int = NUM_FEATURES,
    max_iter: int = MAX_ITER,
    kind: str | None = None,
    length_feature: bool = False,
    max_features: int | None = None,
):
    """Fit one task on the rows with a target; returns (PipelineModel, labels).

    ``rows`` are raw tickets when ``with_text`` else already prepared (with
    a ``grams`` column), which lets cross-validation prepare text once.
    """
    if target not in rows.columns:
        raise KeyError(f"no target column '{target}'")
    labelled = rows.where(F.col(target).isNotNull())
    if not labelled.limit(1).collect():
        raise ValueError(f"no row has a value for the target '{target}'")
    text_stage = TicketTextPrep() if with_text else None
    indexer = target_indexer(target, order)
    if isinstance(indexer, StringIndexer):
        indexer = indexer.fit(labelled)
    labels = list(indexer.labels)
    kind = kind or ("ordinal" if order is not None else "nominal")
    plain = not (length_feature or max_features)
    if text_stage is not None:
        prepared = text_stage.transform(labelled)
        kept = [c for c in ("id", target, "grams", pr.LENGTH) if c in prepared.columns]
        labelled = prepared.select(*dict.fromkeys(kept))
        if not plain:  # several passes over the n-grams themselves
            labelled = labelled.persist(StorageLevel.MEMORY_AND_DISK)
    indexed = indexer.transform(labelled)
    if plain:
        # The n-grams are six times the text: they are counted at once, and the later passes
        # (IDF, class counts, the solver's packed rows) read the counts.
        counter, smooth, normalizer = feature_stages(num_features)
        counted = written_counts(counter.transform(indexed).select("label_id", "tf"))
        weigh = smooth.fit(counted)
        feature_stages_fitted = [counter, weigh, normalizer]
        model, used, converged = fit_counts(counted, weigh.getScalingVec().toArray(), algorithm, kind, len(labels), max_iter)
    else:
        vocabulary = exact_vocabulary(indexed, max_features) if max_features else None
        feature_model = Pipeline(stages=feature_stages(num_features, length_feature, vocabulary)).fit(indexed)
        # The solver passes over the data once per evaluation: keep only the
        # vectors and the label for it.
        vectors = feature_model.transform(indexed).select("features", "label_id").persist(StorageLevel.MEMORY_AND_DISK)
        counts = class_counts(vectors)  # fills the cache; the texts are not needed beside it
        if text_stage is not None:
            labelled.unpersist()
        feature_stages_fitted = feature_model.stages
        model, used, converged = fit_classifier(vectors, algorithm, kind, len(labels), max_iter, counts)
        vectors.unpersist()
    if not converged:
        warnings.warn(f"the fit of '{target}' did not meet its tolerance in {used} iterations", stacklevel=2)
    stages = ([text_stage] if text_stage is not None else []) + feature_stages_fitted + [
        model,
        IndexToString(inputCol="prediction", outputCol="predicted_label", labels=labels),
    ]
    fitted = PipelineModel(stages)
    fitted.iterations, fitted.converged = used, converged
    return fitted, labels


@dataclass(frozen=True)
class ExactModel:
    """A linear model over an exact vocabulary: (term, idf, coefs), intercepts, labels."""

    table: DataFrame
    intercepts: list[float]
    labels: list[str]
    feature_columns: int
    iterations: int
    converged: bool


def fit_exact(rows: DataFrame, target: str, algorithm: str = "linear_svc", order=None, max_iter: int = MAX_ITER) -> ExactModel:
    """Fit a task on every term of its training rows, without hashing and without a vocabulary on the driver.

    Vectors are put together by a join with the vocabulary table; the coefficients,
    whose number is the vocabulary's, stay a table, which scores relationally
    (``streaming.triage.relational_scorer``). The driver holds numbers of labelled rows.
    """
    spark = rows.sparkSession
    path = scratch_path(spark, "labelled")  # written: the row key has to be the same wherever it is read
    rows.where(F.col(target).isNotNull()).withColumn("_row", F.monotonically_increasing_id()).write.parquet(path)
    labelled = spark.read.parquet(path)
    prepared = pr.with_grams(pr.prepare_tickets(labelled, partition_by="_row")).select("_row", target, "grams").persist(StorageLevel.MEMORY_AND_DISK)
    if prepared.isEmpty():
        raise ValueError(f"no row has a value for the target '{target}'")
    indexer = target_indexer(target, order)
    if isinstance(indexer, StringIndexer):
        indexer = indexer.fit(prepared)
    labels = list(indexer.labels)
    tf = fe.term_frequency(prepared, "_row")
    path = scratch_path(spark, "vocabulary")
    idf = fe.idf_table(tf, fe.corpus_size(prepared))
    fe.vocabulary_index(idf).join(idf.select("term", "idf"), "term").write.parquet(path)
    vocabulary = spark.read.parquet(path)
    width = vocabulary.count()
    coded = indexer.transform(prepared.select("_row", target)).select("_row", "label_id")
    vectors = fe.exact_vectors(fe.tfidf_l2(tf, vocabulary, "_row"), vocabulary, coded, width, "_row").persist(StorageLevel.MEMORY_AND_DISK)
    kind = "ordinal" if order is not None else "nominal"
    loss = task_loss(algorithm, kind, class_counts(vectors), len(labels))
    prepared.unpersist()
    coefs, intercepts, used, converged = so.fit_wide(vectors, loss, TOL[algorithm], max_iter, "_row")
    vectors.unpersist()
    table = vocabulary.join(coefs, "feature_id").select("term", "idf", "coefs")
    return ExactModel(table, intercepts, labels, width, used, converged)


def predictions(model: PipelineModel, rows: DataFrame, labels, target: str | None = None) -> DataFrame:
    """Scored rows with ``scores`` (array) and the top-2 struct ``triage``."""
    out = model.transform(rows)
    scores = sc.widen_binary(vector_to_array("rawPrediction"))
    out = out.withColumn("scores", scores).withColumn("triage", sc.top2(F.col("scores"), labels))
    return out


def fold_scales(tf: DataFrame, folds: list[int], num_features: int = NUM_FEATURES, max_df: float = fe.MAX_DF) -> dict[int, np.ndarray]:
    """The IDF scale of every fold's training side, from one pass over (fold, tf) rows.

    A task counts a bucket's documents in each fold (num_features x folds numbers) and one
    aggregate adds the tasks' counts up; a training side's frequency is the total less the fold's own.
    """
    def count(batches):
        inside = np.zeros((len(folds), num_features), np.int64)
        for batch in batches:
            of, lists = batch.column("fold").to_numpy(zero_copy_only=False), batch.column("idx")
            of = np.repeat(of, lists.value_lengths().to_numpy(zero_copy_only=False))
            idx = lists.flatten().to_numpy(zero_copy_only=False)
            for row, k in zip(inside, folds, strict=True):
                row += np.bincount(idx[of == k], minlength=num_features)
        at = np.flatnonzero(inside.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (at, *inside[:, at])], names=["bucket", *(f"n{k}" for k in folds)])

    schema = ", ".join(f"{c} long" for c in ("bucket", *(f"n{k}" for k in folds)))
    rows = tf.select("fold", F.unwrap_udt("tf")["indices"].alias("idx"))  # a vector has a bucket once
    parts = rows.coalesce(tf.sparkSession.sparkContext.defaultParallelism).mapInArrow(count, schema)
    counts = parts.groupBy("bucket").agg(*[F.sum(f"n{k}").alias(f"n{k}") for k in folds]).toArrow()
    sizes = {r["fold"]: r["count"] for r in tf.groupBy("fold").count().collect()}
    held = np.zeros((len(folds), num_features))
    held[:, counts["bucket"].to_numpy()] = [counts[f"n{k}"].to_numpy() for k in folds]
    total, n_docs = held.sum(axis=0), sum(sizes.values())
    scales = {}
    for k, own in zip(folds, held, strict=True):
        n, df = float(n_docs - sizes.get(k, 0)), total - own
        scales[k] = np.where((df >= 1) & (df <= max_df * n), np.log((1.0 + n) / (1.0 + df)) + 1.0, 0.0)
    return scales


def cross_validate(
    prepared_rows: DataFrame,
    target: str,
    algorithm: str = "logreg",
    order=None,
    n_folds: int = 5,
    num_features: int = NUM_FEATURES,
    max_iter: int = MAX_ITER,
):
    """(outcomes, labels, fits): (fold, id, language, y, yhat) of every labelled row, as a table
    in the shared folder, each fold predicted by a model fitted on the other folds only
    (features included).

    ``prepared_rows`` carries ``fold`` (1..n_folds) and ``grams``. Terms are counted
    once; every fold's IDF and class weights come from the counts by subtraction, and
    all folds are fitted over the one written table of counts, an evaluation of
    all of them being one Spark job. ``fits`` has (fold, iterations, converged).
    """
    if n_folds < 1:
        raise ValueError("n_folds must be 1 or more")
    base = prepared_rows.where(F.col(target).isNotNull())
    indexer = target_indexer(target, order)
    if isinstance(indexer, StringIndexer):
        indexer = indexer.fit(base)
    labels = list(indexer.labels)
    kind = "ordinal" if order is not None else "nominal"
    counter = HashingTF(inputCol="grams", outputCol="tf", numFeatures=num_features)
    tf = written_counts(counter.transform(indexer.transform(base)).select("id", F.col("fold").cast("int").alias("fold"), "language", "label_id", "tf"), "fold")
    folds = list(range(1, n_folds + 1))
    scales = fold_scales(tf, folds, num_features)
    counts = {(r["fold"], int(r["label_id"])): r["count"] for r in tf.groupBy("fold", "label_id").count().collect()}
    problems = []
    for k in folds:
        train = {c: sum(n for (f, of), n in counts.items() if of == c and f != k) for c in range(len(labels))}
        if not sum(train.values()):
            raise ValueError(f"fold {k} leaves no row to fit on")
        problems.append(so.Problem(task_loss(algorithm, kind, {c: n for c, n in train.items() if n}, len(labels)), k, scales[k]))
    fitted = so.fit_all(so.sparse_rows(tf, "tf", fold="fold"), problems, num_features, TOL[algorithm], max_iter)

    names = F.array(*[F.lit(x) for x in labels])
    parts = []
    for k, (coefs, _, _) in zip(folds, fitted, strict=True):
        model = PipelineModel([
            ElementwiseProduct(scalingVec=Vectors.dense(scales[k]), inputCol="tf", outputCol="tfidf"),
            Normalizer(inputCol="tfidf", outputCol="features", p=2.0),
            _stock_model(algorithm, coefs),
            IndexToString(inputCol="prediction", outputCol="predicted_label", labels=labels),
        ])
        scored = model.transform(tf.where(F.col("fold") == k))
        yhat = F.array_position(names, F.col("predicted_label")) - 1
        parts.append(scored.select("fold", "id", "language", F.col("label_id").cast("int").alias("y"), yhat.cast("int").alias("yhat")))
    fits = [(k, used, converged) for k, (_, used, converged) in zip(folds, fitted, strict=True)]
    path = scratch_path(prepared_rows.sparkSession, "outcomes")
    reduce(DataFrame.unionByName, parts).write.parquet(path)
    return prepared_rows.sparkSession.read.parquet(path), labels, fits


def record_cross_validation(spark, store: str, run_id: str, prepared_rows: DataFrame, target: str, algorithm: str, order=None, num_features: int = NUM_FEATURES, **options):
    """Cross-validate a task and commit the run to the store; returns the labels.

    Tables of the run: outcomes, fits, runs, run_metrics and the summaries per class,
    one-vs-rest, confusion and language. Nobody sees any of them before the commit.
    """
    outcomes, labels, fits = cross_validate(prepared_rows, target, algorithm, order, num_features=num_features, **options)
    named = list(enumerate(labels))
    cube = ev.outcome_cube(outcomes)
    tables = {
        "outcomes": outcomes,
        "fits": spark.createDataFrame(fits, "fold int, iterations int, converged boolean"),
        "runs": spark.createDataFrame([(algorithm, num_features)], "algorithm string, feature_columns long"),
        "run_metrics": ev.metrics_long(cube, named),
        "cv_per_class": ev.cv_per_class(cube, named),
        "cv_ovr": ev.cv_ovr(cube, named),
        "cv_confusion": ev.cv_confusion_long(cube, named),
        "cv_language": ev.cv_language(cube, named),
    }
    kind = "ordinal" if order is not None else "nominal"
    params = {"algorithm": algorithm, "C": KINDS[kind].inverse_penalty(algorithm), "num_features": num_features, "labels": labels}
    rn.write_run(spark, store, run_id, target, tables, params=params, metrics={"iterations": max(used for _, used, _ in fits)})
    return labels
