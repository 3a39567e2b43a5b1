"""Evaluation tables against the literal two-fold fixture with known numbers."""

import pytest

from ticketlens.operators import evaluation as ev

LABELS = [(0, "low"), (1, "medium"), (2, "high")]
ROWS = [
    (1, 1, "en", 0, 0), (1, 2, "en", 0, 1), (1, 3, "de", 1, 1), (1, 4, "de", 1, 1),
    (2, 5, "en", 0, 0), (2, 6, "de", 1, 2), (2, 7, "en", 2, 2), (2, 8, "de", 2, 1),
]
SCHEMA = "fold int, id long, language string, y int, yhat int"


@pytest.fixture(scope="module")
def cube(spark):
    return ev.outcome_cube(spark.createDataFrame(ROWS, SCHEMA))


def by(rows, *keys):
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in rows}


def test_zero_support_rows_kept(cube):
    pc = by(ev.per_class_metrics(cube, LABELS).collect(), "fold", "label")
    high = pc[(1, "high")]
    assert (high.support, high.precision, high.recall) == (0, 0.0, 0.0)
    ovr = by(ev.ovr_confusion(cube, LABELS).collect(), "fold", "label")
    h = ovr[(1, "high")]
    assert (h.tp, h.fp, h.fn, h.tn) == (0, 0, 0, 4)
    assert len(pc) == 6


def test_language_slices(cube):
    lm = by(ev.language_metrics(cube, LABELS).collect(), "fold", "language")
    assert lm[(1, "en")].accuracy == pytest.approx(0.5)
    assert lm[(1, "de")].accuracy == pytest.approx(1.0)
    assert (lm[(1, "en")].sample_count, lm[(1, "de")].sample_count) == (2, 2)


def test_overall_mean_std(cube):
    o = ev.cv_overall(cube, LABELS).first()
    assert o.accuracy_mean == pytest.approx(0.625)
    assert o.accuracy_std == pytest.approx(0.125)
    assert o.macro_f1_mean == pytest.approx(0.494444, abs=1e-6)
    assert o.macro_f1_std == pytest.approx(0.005556, abs=1e-6)


def test_per_class_summary(cube):
    pc = by(ev.cv_per_class(cube, LABELS).collect(), "label")
    assert pc["high"].support_mean == pytest.approx(1.0)
    assert pc["high"].support_std == pytest.approx(1.0)


def test_confusion_summaries(cube):
    mean = by(ev.confusion_matrix(cube, LABELS, "mean").collect(), "actual_label")
    std = by(ev.confusion_matrix(cube, LABELS, "std").collect(), "actual_label")
    assert mean["low"]["low"] == pytest.approx(1.0)
    assert mean["low"]["medium"] == pytest.approx(0.5)
    assert std["low"]["medium"] == pytest.approx(0.5)
    ovr = by(ev.cv_ovr(cube, LABELS).collect(), "label")
    assert (ovr["high"].tp_mean, ovr["high"].tp_std) == (pytest.approx(0.5), pytest.approx(0.5))
    assert (ovr["high"].tn_mean, ovr["high"].tn_std) == (pytest.approx(2.5), pytest.approx(1.5))
    dense = ev.confusion_dense(cube, LABELS).collect()
    assert len(dense) == 2 * 9 and sum(r["count"] for r in dense) == 8


def test_language_summary_and_keys(cube):
    lang = by(ev.cv_language(cube, LABELS).collect(), "language")
    assert (lang["en"].accuracy_mean, lang["en"].accuracy_std) == (pytest.approx(0.75), pytest.approx(0.25))
    assert (lang["de"].accuracy_mean, lang["de"].accuracy_std) == (pytest.approx(0.5), pytest.approx(0.5))
    assert lang["en"].sample_count_mean == pytest.approx(2.0)
    keys = {r.key: r.value for r in ev.metrics_long(cube, LABELS).collect()}
    for key in ("cv_accuracy_mean", "cv_macro_f1_mean", "cv_precision_mean__high", "cv_tp_mean__high",
                "cv_accuracy_mean__lang_en", "cv_macro_f1_mean__lang_de"):
        assert key in keys
    assert keys["cv_accuracy_mean"] == pytest.approx(0.625)


def test_grouping_sets_equal_separate_slices(spark, cube):
    gs = by(ev.metrics_grouping_sets(spark.createDataFrame(ROWS, SCHEMA), LABELS).collect(), "fold", "slice")
    fm = by(ev.fold_metrics(cube, LABELS).collect(), "fold")
    lm = by(ev.language_metrics(cube, LABELS).collect(), "fold", "language")
    for f, row in fm.items():
        assert gs[(f, "overall")].macro_f1 == row.macro_f1
    for (f, lang), row in lm.items():
        assert gs[(f, lang)].accuracy == row.accuracy


def test_invariants_on_orders(spark, sf_dir):
    from ticketlens.plans import views as V

    cube = ev.outcome_cube(V.outcomes(spark, sf_dir))
    labels = V.PRIORITY_LABELS
    n = V.order_rows(spark, sf_dir).count()
    for r in ev.ovr_confusion(cube, labels).collect():
        assert r.tp + r.fp + r.fn + r.tn == sum(
            x["count"] for x in ev.confusion_dense(cube, labels).where(f"fold = {r.fold}").collect()
        )
    assert sum(r["count"] for r in ev.confusion_dense(cube, labels).collect()) == n


def test_guards_of_the_evaluation(spark):
    import pytest

    schema = "fold int, id long, language string, y int, yhat int"
    nothing = ev.outcome_cube(spark.createDataFrame([], schema))
    with pytest.raises(Exception, match="no fold to summarise"):
        ev.cv_overall(nothing, [(0, "a"), (1, "b")]).collect()
    truth = spark.createDataFrame([(1, 0, "x"), (2, 1, "y")], "id long, y int, t string")
    predicted = spark.createDataFrame([(1, 0, "p"), (2, 0, "q")], "id long, yhat int, z string")
    assert sorted(map(tuple, ev.align(truth, predicted).collect())) == [(1, 0, "x", 0, "p"), (2, 1, "y", 0, "q")]
    assert tuple(ev.alignment_counts(truth, predicted).first()) == (2, 0, 0, 1)
    for t, p, message in ((truth, predicted.where("id = 1"), "no prediction for the row 2"), (truth.where("id = 2"), predicted, "no truth for the row 1")):
        with pytest.raises(Exception, match=message):
            ev.align(t, p).collect()
    with pytest.raises(Exception, match="no truth for the row without an id"):
        ev.align(truth, predicted.union(spark.createDataFrame([(None, 1, "n")], predicted.schema))).collect()


def test_grouping_sets_leave_out_null_targets(spark):
    rows = [(1, 1, "en", 0, 0), (1, 2, "en", 1, 1), (1, 3, "de", None, 1)]
    df = spark.createDataFrame(rows, "fold int, id long, language string, y int, yhat int")
    got = {r.slice: (r.accuracy, r.sample_count) for r in ev.metrics_grouping_sets(df, [(0, "a"), (1, "b")]).collect()}
    assert got == {"overall": (1.0, 2), "en": (1.0, 2)}
