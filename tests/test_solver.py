"""The distributed solver: derivatives by differences, optimum of a plain objective, the limit."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.linalg import Vectors

from ticketlens.plans import models as ml
from ticketlens.plans import solver as so

CASES = [("logreg", 2), ("logreg", 3), ("linear_svc", 2), ("linear_svc", 3)]


@pytest.mark.parametrize("algorithm, k", CASES)
def test_slopes_are_the_derivatives(algorithm, k):
    rng = np.random.default_rng(3)
    y = rng.integers(0, k, 12)
    loss = ml.task_loss(algorithm, "nominal", {c: int((y == c).sum()) for c in range(k)}, k)
    m = rng.normal(size=(12, len(loss.positive)))
    _, slope = loss.at(m, y)
    for i in range(m.shape[0]):
        for c in range(m.shape[1]):
            up, down = m.copy(), m.copy()
            up[i, c] += 1e-6
            down[i, c] -= 1e-6
            assert slope[i, c] == pytest.approx((loss.at(up, y)[0] - loss.at(down, y)[0]) / 2e-6, abs=1e-7)


@pytest.mark.parametrize("algorithm, k", CASES)
def test_fit_reaches_the_optimum(spark, algorithm, k):
    rng = np.random.default_rng(5)
    x, y = rng.normal(size=(40, 5)) * (rng.random((40, 5)) < 0.6), rng.integers(0, k, 40)
    rows = [(Vectors.sparse(5, {j: v for j, v in enumerate(r) if v}) if i % 2 else Vectors.dense(r), float(c)) for i, (r, c) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, ["features", "label_id"]).repartition(3)
    loss = ml.task_loss(algorithm, "nominal", {c: int((y == c).sum()) for c in range(k)}, k)
    w, used, converged = so.fit(df, loss, 5, 1e-6, 500)
    assert converged and 0 < used < 500
    reg, free = np.asarray(loss.reg)[:, None], np.array([1.0] * 5 + [loss.kind == "squared_hinge"])

    def objective(w):
        return loss.at(x @ w[:, :-1].T + w[:, -1], y)[0] + 0.5 * (reg * free * w * w).sum()

    best = objective(w)
    for _ in range(200):
        assert objective(w + rng.normal(size=w.shape) * 1e-3) >= best - 1e-12


def test_limit_is_reported(spark):
    df = spark.createDataFrame([(Vectors.dense([1.0, 0.5]), 0.0), (Vectors.dense([0.2, 1.0]), 1.0)], ["features", "label_id"])
    loss = ml.task_loss("logreg", "nominal", {0: 1, 1: 1}, 2)
    assert so.fit(df, loss, 2, 1e-9, 1)[1:] == (1, False)


def test_folds_share_one_evaluation(spark):
    """Models fitted together equal those fitted one by one on their own rows and scaled features."""
    rng = np.random.default_rng(7)
    x, y, fold = rng.random((60, 8)) * (rng.random((60, 8)) < 0.7), rng.integers(0, 3, 60), rng.integers(1, 4, 60)
    x[5] = 0.0  # a row without terms
    scales = {k: rng.random(8) for k in (1, 2, 3)}
    rows = [(Vectors.sparse(8, {j: v for j, v in enumerate(r) if v}), float(c), int(f)) for r, c, f in zip(x, y, fold)]
    table = so.sparse_rows(spark.createDataFrame(rows, ["tf", "label_id", "fold"]).repartition(5), "tf", fold="fold").persist()
    problems = []
    for k in (1, 2, 3):
        counts = {c: int(((y == c) & (fold != k)).sum()) for c in range(3)}
        problems.append(so.Problem(ml.task_loss("linear_svc", "nominal", counts, 3), k, scales[k]))
    together = so.fit_all(table, problems, 8, 1e-3, 500)
    assert all(converged for _, _, converged in together)
    p, w = problems[1], together[1][0]
    v = x[fold != p.without] * p.scale
    length = np.linalg.norm(v, axis=1, keepdims=True)
    v, own = v / np.where(length > 0, length, 1.0), y[fold != p.without]
    reg = np.asarray(p.loss.reg)[:, None]
    _, slope = p.loss.at(v @ w[:, :-1].T + w[:, -1], own)  # the gradient on the training side alone, in plain numpy
    left = np.abs(np.hstack([slope.T @ v, slope.sum(axis=0)[:, None]]) + reg * w).max()
    _, slope = p.loss.at(np.zeros((len(own), 3)), own)
    assert left <= 1.01e-3 * np.abs(np.hstack([slope.T @ v, slope.sum(axis=0)[:, None]])).max()


def test_evaluations_run_on_the_cores(spark):
    """The tasks of an evaluation, and what they hand over, do not grow with the partitions of the rows."""
    df = spark.range(4000).selectExpr("0 as fold", "cast(id % 2 as int) as y", "array(cast(id % 9000 as int)) as idx", "array(1.0d) as val").repartition(200)
    loss = ml.task_loss("logreg", "nominal", {0: 2000, 1: 2000}, 2)
    shared = spark.sparkContext.broadcast([so.Problem(loss)])
    value, grad = so.evaluate(df, shared, {0: np.zeros((1, 9001))})[0]
    assert value == pytest.approx(np.log(2)) and grad[0, 4000:9000].any() == 0 and np.abs(grad[0, :4000]).min() > 0
    assert df.coalesce(spark.sparkContext.defaultParallelism).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


@pytest.mark.parametrize("kind, positive", [("softmax", (0, 1, 2)), ("logistic", (1,)), ("squared_hinge", (0, 1, 2))])
def test_wide_fit_stops_at_a_minimum(spark, kind, positive):
    """Coefficients that stay with the features: the gradient of the plain objective is within the tolerance there."""
    rng = np.random.default_rng(5)
    rows = [(10 * i, _random_row(rng), int(rng.integers(0, 3))) for i in range(60)] + [(7, Vectors.sparse(6, [], []), 1)]
    df = spark.createDataFrame(rows, ["_row", "features", "label_id"]).repartition(3).persist()
    k = len(positive)
    loss = so.Loss(kind, positive, (1 / 61,) * k, (0.0 if kind == "softmax" else 1 / 61,) * k, (0.05,) * k)
    table, intercepts, _, converged = so.fit_wide(df, loss, 1e-3, 500, "_row")
    w = np.zeros((k, 7))
    for r in table.collect():
        w[:, r["feature_id"]] = r["coefs"]
    w[:, -1] = intercepts
    x = np.array([[*r[1].toArray(), 1.0] for r in rows])
    y = np.array([r[2] for r in rows])

    def gradient(at):
        value, slope = loss.at(x @ at.T, y)
        return np.abs(so._penalised(loss, at, value, slope.T @ x)[1]).max()

    limit = 1e-3 * (gradient(np.zeros((k, 7))) if kind == "squared_hinge" else 1)
    assert converged and gradient(w) <= 1.0001 * limit


def _random_row(rng):
    at = sorted(set(rng.integers(0, 6, 3).tolist()))
    return Vectors.sparse(6, at, rng.random(len(at)).tolist())


def test_an_intercept_that_bends_the_loss_most_costs_few_steps():
    rng = np.random.default_rng(2)
    x = np.hstack([rng.random((400, 300)) * (rng.random((400, 300)) < 0.03), np.ones((400, 1))])
    x[:, :-1] /= np.maximum(np.linalg.norm(x[:, :-1], axis=1, keepdims=True), 1e-9)
    y = (rng.random(400) < 0.85).astype(int)
    loss = so.Loss("squared_hinge", (1,), (1 / 400,), (5 / 400,), (2e-5,))

    def evaluations(bend):
        running, asked = so.lbfgs(np.zeros((1, 301)), 1e-3, 2000, True, bend), 0
        point = next(running)
        while True:
            asked += 1
            value, slope = loss.at(x @ point.T, y)
            try:
                point = running.send(so._penalised(loss, point, value, slope.T @ x))
            except StopIteration as done:
                assert done.value[2]
                return asked

    assert so.intercept_curvature(ml.NUM_FEATURES) == 100 and so.intercept_curvature(5) == 1
    assert evaluations(100.0) < 0.8 * evaluations(1.0)


def test_long_batches_are_added_in_pieces(monkeypatch):
    batch = pa.RecordBatch.from_pydict({"fold": pa.array([1, 2, 1, 1], pa.int32()), "y": pa.array([0, 1, 1, 0], pa.int32()), "idx": pa.array([[0, 1], [], [0, 1, 2, 3], [3]], pa.list_(pa.int32())), "val": pa.array([[0.5, 1.0], [], [1.0, 2.0, 3.0, 4.0], [2.0]])})
    loss = so.Loss("logistic", (1,), (0.25,), (0.25,), (0.1,))
    whole, cut = (so._Partial([so.Problem(loss)], [np.full((1, 5), 0.1)]) for _ in range(2))
    whole.add(batch)
    monkeypatch.setattr(so, "PIECE", 3)
    cut.add_pieces(batch)
    assert cut.values == pytest.approx(whole.values) and cut.grads == pytest.approx(whole.grads)


def test_packed_rows_give_the_evaluation_of_the_rows(spark, monkeypatch):
    """Scales, folds, empty rows and values that single precision cannot hold; added up by reducers or by the driver."""
    rng = np.random.default_rng(5)
    made = [(int(i % 3), int(i % 2), sorted(map(int, rng.choice(9000, i % 7, replace=False)))) for i in range(40)]
    rows = [(f, y, idx, [float(v) for v in rng.random(len(idx)) + 0.1]) for f, y, idx in made]
    df = spark.createDataFrame(rows, "fold int, y int, idx array<int>, val array<double>").repartition(3)
    loss = so.Loss("logistic", (1,), (0.05,), (0.05,), (0.1,))
    shared = spark.sparkContext.broadcast([so.Problem(loss), so.Problem(loss, 1, rng.random(9000))])
    asked = {m: rng.random((1, 9001)) for m in (0, 1)}
    expected = so.evaluate(df, shared, asked)
    packed = so.packed_rows(df, shared)
    for direct in (1 << 26, 0):
        monkeypatch.setattr(so, "DIRECT", direct)
        got = so.evaluate(packed, shared, asked)
        for m in asked:
            assert got[m][0] == pytest.approx(expected[m][0]) and np.allclose(got[m][1], expected[m][1], atol=1e-6)
    assert set(so.evaluate(packed, shared, {1: asked[1]})) == {1}


def test_long_rows_of_many_columns_give_the_plain_sums(monkeypatch):
    """Rows taken one by one, all models' columns at once, in single precision for a while: the gradient of dense numpy."""
    rng = np.random.default_rng(9)
    x = rng.integers(1, 4, (30, 70000)) * (rng.random((30, 70000)) < 0.002)
    fold, y = rng.integers(1, 3, 30), rng.integers(0, 3, 30)
    loss = so.Loss("squared_hinge", (0, 1, 2), (0.1,) * 3, (0.05,) * 3, (0.1,) * 3)
    problems = [so.Problem(loss, k, rng.random(70000)) for k in (1, 2)]
    coefs = [rng.normal(size=(3, 70001)) for _ in problems]
    sizes, idx = (x > 0).sum(axis=1), np.nonzero(x)[1]
    val = x[x > 0].astype(float)
    assert len(idx) >= so.LONG_ROWS * len(y) and sum(len(c) for c in coefs) >= so.WIDE_COLUMNS
    monkeypatch.setattr(so, "RECENT", 2000)  # several times on the way
    part = so._Partial(problems, coefs)
    for some in (slice(0, 12), slice(12, 30)):
        first, last = sizes[: some.start].sum(), sizes[: some.stop].sum()
        lengths = so._lengths(problems, idx[first:last], val[first:last], sizes[some])
        part.add_rows(fold[some], y[some], sizes[some], idx[first:last], val[first:last], lengths)
    part.settle()
    for m, (p, w) in enumerate(zip(problems, coefs, strict=True)):
        v = x * p.scale / np.linalg.norm(x * p.scale, axis=1, keepdims=True)
        value, slope = loss.at(v @ w[:, :-1].T + w[:, -1], y, fold != p.without)
        assert part.values[m] == pytest.approx(value, rel=1e-5)
        own = part.grads[:-1, 3 * m : 3 * m + 3] * p.scale[:, None]
        assert np.allclose(own, v.T @ slope, atol=1e-5 * np.abs(v.T @ slope).max())


def test_packed_counts_take_four_bytes_and_any_partitions(spark):
    """Counts are packed in a third of what arrays take, and an evaluation has a task a core, however many partitions they have."""
    df = spark.range(4000).selectExpr("1 as fold", "cast(id % 2 as int) as y", "sequence(0, 199000, 1000) as idx", "array_repeat(2.0d, 200) as val").repartition(30)
    loss = ml.task_loss("logreg", "nominal", {0: 2000, 1: 2000}, 2)
    shared = spark.sparkContext.broadcast([so.Problem(loss)])
    packed = so.packed_rows(df, shared)
    pieces = packed.collect()
    assert packed.getNumPartitions() == 30 and sum(len(p[1]) + len(p[2]) + len(p[3]) for p in pieces) == 4 * 200 * 4000
    value, grad = so.evaluate(packed, shared, {0: np.zeros((1, 200000))})[0]
    assert value == pytest.approx(np.log(2)) and np.count_nonzero(grad[0, :-1]) in (0, 200)


def test_ids_and_values_come_back_as_they_were():
    for idx in ([], [0, 65535, 65536, (1 << 24) - 1], [1 << 24, (1 << 31) - 1]):
        idx = np.array(idx, np.int32)
        assert np.array_equal(so._ids(*so._packed_ids(idx)), idx)
    for val, kind in (([1.0, 255.0], "u1"), ([256.0, 0.5], "f4"), ([-1.0], "f4"), ([0.1], "f8"), ([2.0**40 + 1], "f8"), ([float("inf")], "f4")):
        held, of = so._packed_values(np.array(val))
        assert of == kind and np.frombuffer(held, of).astype(float).tolist() == val
