"""Spark ML pipelines on a small fixture: 10 teams, 3 requests each, 3 folds."""

import pytest
from pyspark.sql import functions as F

from ticketlens.operators import evaluation as ev
from ticketlens.operators import folds as fo
from ticketlens.operators import prepare as pr
from ticketlens.plans import models as ml

QUEUES = ["printing", "network", "payroll", "parking", "travel", "badges", "licences", "furniture", "phones", "catering"]
PRIORITIES = ["low", "medium", "high"]


@pytest.fixture(scope="module")
def smoke(spark):
    """Three requests per team; each names its team's subject and its urgency."""
    rows, urgency = [], dict(zip(PRIORITIES, ("whenever it suits", "sometime this week", "right now"), strict=True))
    for n in range(30):
        team, level = QUEUES[n // 3], PRIORITIES[(n // 3) % 3]
        rows.append((n, f"{team} desk", f"please look at the {team} matter {urgency[level]}", team, level, ("en", "de")[n % 2]))
    return spark.createDataFrame(rows, "id long, subject string, body string, queue string, priority string, language string")


@pytest.mark.parametrize("algorithm", ["logreg", "linear_svc"])
def test_fit_and_triage(spark, smoke, algorithm):
    model, labels = ml.fit_task(smoke, "queue", algorithm, num_features=1 << 12)
    assert labels == sorted(QUEUES)
    scored = ml.predictions(model, smoke.drop("queue", "priority"), labels).select("triage.*").collect()
    assert all(r.label != r.runner_up_label for r in scored)
    assert sum(r.label == q for r, q in zip(scored, [q for q in QUEUES for _ in range(3)])) >= 27


def test_ordinal_target_codes(spark, smoke):
    model, labels = ml.fit_task(smoke, "priority", "logreg", order=("low", "medium", "high"), num_features=1 << 12)
    assert labels == ["low", "medium", "high"]
    out = model.transform(smoke.select("id", "subject", "body")).select("predicted_label").distinct().collect()
    assert {r.predicted_label for r in out} <= set(PRIORITIES)


def test_cross_validation_beats_majority(spark, smoke):
    folded = fo.stratified_folds(smoke, "id", ["queue", "priority"], n_splits=3)
    prepared = pr.with_grams(pr.prepare_tickets(folded, partition_by="id"))
    out, labels, fits = ml.cross_validate(prepared, "queue", "logreg", n_folds=3, num_features=1 << 12)
    assert out.count() == 30 and [k for k, _, _ in fits] == [1, 2, 3] and all(converged for _, _, converged in fits)
    overall = ev.cv_overall(ev.outcome_cube(out), list(enumerate(labels))).first()
    assert overall.macro_f1_mean > 0.1  # the majority class scores 1/100 here


def test_model_save_load(spark, smoke, tmp_path):
    from pyspark.ml import PipelineModel

    model, _ = ml.fit_task(smoke, "queue", "logreg", num_features=1 << 12)
    model.write().overwrite().save(str(tmp_path / "m"))
    loaded = PipelineModel.load(str(tmp_path / "m"))
    a = [r.predicted_label for r in model.transform(smoke).orderBy("id").collect()]
    b = [r.predicted_label for r in loaded.transform(smoke).orderBy("id").collect()]
    assert a == b


def test_missing_language_is_scored(spark, smoke):
    model, labels = ml.fit_task(smoke, "queue", "logreg", num_features=1 << 12)
    req = spark.createDataFrame([("hello", "the network is down")], "subject string, body string")
    out = ml.predictions(model, req, labels).select("triage.*").first()
    assert out.label in QUEUES


def test_length_feature_is_appended(spark, smoke):
    model, labels = ml.fit_task(smoke, "queue", "logreg", num_features=1 << 10, length_feature=True)
    row = model.transform(smoke).select("features", "length_feature").first()
    assert row.features.size == (1 << 10) + 1
    assert 0.0 < row.length_feature <= 1.0


def test_fit_errors(spark, smoke):
    with pytest.raises(KeyError, match="no target column 'team'"):
        ml.fit_task(smoke, "team")
    empty = smoke.withColumn("queue", F.lit(None).cast("string"))
    with pytest.raises(ValueError, match="no row has a value for the target 'queue'"):
        ml.fit_task(empty, "queue")


def test_exact_vocabulary_fit(spark, smoke):
    model, labels = ml.fit_task(smoke, "queue", "logreg", max_features=40)
    vocab = model.stages[1].vocabulary
    assert len(vocab) == 40 and vocab == sorted(vocab)
    out = ml.predictions(model, smoke, labels).select("triage.label").collect()
    assert len(out) == 30


def test_one_vs_rest_weights_and_convergence(spark, smoke):
    model, labels = ml.fit_task(smoke, "priority", "linear_svc", order=("low", "medium", "high"), num_features=1 << 10)
    assert labels == PRIORITIES and len(model.stages[-2].models) == 3
    used, converged = ml.iterations(model)
    assert 0 < used < ml.MAX_ITER and converged


def test_tasks_keep_null_and_repeated_ids(spark, smoke):
    from ticketlens.plans import registry

    models = {t: ml.fit_task(smoke, t, "logreg", num_features=1 << 10) for t in ("queue", "priority")}
    req = spark.createDataFrame([(1, "a", "network"), (1, "b", "travel"), (None, "c", "payroll")], "id long, subject string, body string")
    out = registry._apply_tasks(ml.TicketTextPrep().transform(req), models).collect()
    assert sorted(map(repr, (r["id"] for r in out))) == ["1", "1", "None"] and all(r["queue_label"] and r["priority_label"] for r in out)


def test_fold_scales_are_those_of_the_training_sides(spark, smoke):
    """Counting once and subtracting gives every training side's own IDF, max_df included."""
    from pyspark.ml import Pipeline

    folded = fo.stratified_folds(smoke, "id", ["queue", "priority"], n_splits=3)
    prepared = pr.with_grams(pr.prepare_tickets(folded, partition_by="id"))
    tf = ml.HashingTF(inputCol="grams", outputCol="tf", numFeatures=1 << 10).transform(prepared).select("fold", "tf")
    scales = ml.fold_scales(tf, [1, 2, 3], 1 << 10)
    for k in (1, 2, 3):
        own = Pipeline(stages=[ml.SmoothIdf(inputCol="tf", outputCol="x")]).fit(tf.where(F.col("fold") != k)).stages[0]
        assert abs(own.getScalingVec().toArray() - scales[k]).max() < 1e-12
    assert (scales[1] != scales[2]).any()


def test_fits_keep_no_rows_in_the_executors_heaps(spark, smoke, monkeypatch):
    """The n-grams are not cached, counts and packed rows lie on disk; folds are read one by one."""
    from pyspark import RDD

    levels, held = [], RDD.persist
    monkeypatch.setattr(RDD, "persist", lambda self, level: levels.append(level) or held(self, level))
    monkeypatch.setattr(type(smoke), "persist", lambda self, *a: pytest.fail("a table is cached"))
    ml.fit_task(smoke, "queue", "logreg", num_features=1 << 10)
    folded = fo.stratified_folds(smoke, "id", ["queue", "priority"], n_splits=3)
    ml.cross_validate(pr.with_grams(pr.prepare_tickets(folded, partition_by="id")), "priority", "logreg", n_folds=3, num_features=1 << 10)
    assert len(levels) == 2 and not any(level.useMemory for level in levels)
    counts = ml.written_counts(smoke.selectExpr("id", "cast(id % 3 as int) as fold"), "fold")
    assert len(counts.where("fold = 1").inputFiles()) >= 1 and sorted(r.id for r in counts.where("fold = 1").collect()) == list(range(1, 30, 3))
