"""Linear models by distributed L-BFGS on the features as they are.

Spark's own solvers scale every feature by its deviation, also with
``standardization=False``, and undo it in the penalty. On TF-IDF rows, whose
rare terms deviate a hundred times less than frequent ones, that makes a
well-conditioned problem an ill-conditioned one: their fits ran into every
limit tried. Here the objective is minimised unscaled,

    sum of weight * loss(margin) / total weight + sum(reg / 2 * |w|^2),

with the softmax or logistic loss (intercepts free) or the squared hinge
(intercepts penalised, one column for each one-vs-rest problem, all columns in
one pass). Several models may be fitted over the same rows, as the folds of a
cross-validation are: each has its own scale of the features (its training
side's IDF), leaves out the rows of its own fold, and advances by itself, while
one Spark job evaluates all of them.

An evaluation runs on as many tasks as the cluster has cores, however many
partitions the rows have. The rows are packed once, as arrays and with the lengths
that each model's scale gives them, so that an evaluation reads bytes, not lists;
they lie on the executors' disks, four bytes an entry, and not in their heaps. A task adds up the gradients of its rows in numpy
(all models' columns of an entry at once, a row being a product of a vector and a small matrix) and
hands over the columns it has touched; blocks of columns are summed on several
reducers. The driver holds vectors of models x columns x (features + 1), which
are parameters of the models, not of the data.
"""

from __future__ import annotations

from collections import deque
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path

BLOCK = 1 << 12  # features whose gradient entries travel together
BLOCK_SCHEMA = "block int, at binary, g binary"
MEMORY = 10  # pairs that L-BFGS keeps
PIECE = 1 << 19  # entries that a task works on at once
_NO_FOLD = -1


@dataclass(frozen=True)
class Loss:
    """``kind``: softmax, logistic or squared_hinge. Column c counts the class
    ``positive[c]`` with ``on[c]`` and the others with ``off[c]`` (divided by the
    column's total weight already); ``reg[c]`` is its penalty."""

    kind: str
    positive: tuple[int, ...]
    on: tuple[float, ...]
    off: tuple[float, ...]
    reg: tuple[float, ...]

    def at(self, margins: np.ndarray, y: np.ndarray, counted: np.ndarray | None = None) -> tuple[float, np.ndarray]:
        """Weighted loss and its derivative by the margins, rows x columns; ``counted``: the rows that count."""
        mine = y[:, None] == np.asarray(self.positive)[None, :]
        part = np.ones(len(y)) if counted is None else counted.astype(float)
        if self.kind == "softmax":
            weight = (mine * np.asarray(self.on)).sum(axis=1) * part
            shifted = margins - margins.max(axis=1, keepdims=True)
            log_p = shifted - np.log(np.exp(shifted).sum(axis=1, keepdims=True))
            return float(-(weight * (mine * log_p).sum(axis=1)).sum()), weight[:, None] * (np.exp(log_p) - mine)
        weight = np.where(mine, np.asarray(self.on), np.asarray(self.off)) * part[:, None]
        sign = np.where(mine, 1.0, -1.0)
        if self.kind == "logistic":
            z = -sign * margins
            return float((weight * np.logaddexp(0.0, z)).sum()), -weight * sign * np.exp(-np.logaddexp(0.0, -z))
        short = np.maximum(0.0, 1.0 - sign * margins)
        return float((weight * short**2).sum()), -2.0 * weight * sign * short


@dataclass(frozen=True)
class Problem:
    """One model: its loss, the fold it leaves out and the scale of its features (None: as they are).

    Scaled rows are brought to length 1 again, as TF-IDF rows are.
    """

    loss: Loss
    without: int | None = None
    scale: np.ndarray | None = None


def sparse_rows(vectors: DataFrame, features: str = "features", label: str = "label_id", fold: str | None = None) -> DataFrame:
    """(fold, y, idx, val) of the vectors, dense ones included."""
    v = F.unwrap_udt(features)
    idx = F.when(v["type"] == 0, v["indices"]).otherwise(F.sequence(F.lit(0), F.size(v["values"]) - 1))
    of = F.lit(_NO_FOLD) if fold is None else F.col(fold).cast("int")
    return vectors.select(of.alias("fold"), F.col(label).cast("int").alias("y"), idx.alias("idx"), v["values"].alias("val"))


def _lengths(problems: list[Problem], idx: np.ndarray, val: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Models x rows: a row's length under each model's scale, 1 if it has none or nothing is left of the row."""
    out, (rows, starts) = np.ones((len(problems), len(sizes))), _starts(sizes)
    scaled = [m for m, p in enumerate(problems) if p.scale is not None]
    if not scaled or not len(rows):
        return out
    squares, squared = val**2, np.empty((len(rows), len(scaled)))
    if len(scaled) > 1 and len(idx) >= LONG_ROWS * len(rows):
        scales = np.stack([problems[m].scale for m in scaled], axis=1) ** 2
        for r, (start, end) in enumerate(zip(starts, starts + sizes[rows])):
            squared[r] = squares[start:end] @ scales.take(idx[start:end], axis=0)
    else:
        for c, m in enumerate(scaled):
            squared[:, c] = np.add.reduceat(squares * problems[m].scale[idx] ** 2, starts)
    norm = np.sqrt(squared)
    out[np.ix_(scaled, rows)] = np.where(norm > 0, norm, 1.0).T
    return out


def _starts(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows with entries, and where those begin."""
    rows = np.flatnonzero(sizes)
    return rows, (np.cumsum(sizes) - sizes)[rows]


#: Columns of all models and entries of a row from which rows are taken one by one, all columns at once.
WIDE_COLUMNS = 4
LONG_ROWS = 32
#: Entries whose gradient is summed in single precision: half the memory, which is what the cores share.
RECENT = 1 << 23


class _Partial:
    """One task's part of the gradients: columns of ``grads`` are the models' columns one after the other."""

    def __init__(self, problems: list[Problem], coefs: list[np.ndarray]) -> None:
        self.problems, self.coefs = problems, coefs
        self.first = np.cumsum([0] + [len(c) for c in coefs])
        self.values = np.zeros(len(problems))
        self.width = coefs[0].shape[1]
        self.grads = np.zeros((self.width, self.first[-1]))
        self.touched = np.zeros(self.width, bool)
        # a scaled feature's coefficient is that of the feature as it is times the scale
        scaled = [c[:, :-1] if p.scale is None else (c[:, :-1] * p.scale) for p, c in zip(problems, coefs, strict=True)]
        self.wide = self.first[-1] >= WIDE_COLUMNS
        self.points = np.ascontiguousarray(np.concatenate(scaled).T, np.float32) if self.wide else np.concatenate(scaled)
        self.recent, self.held = np.zeros((self.width - 1, self.first[-1]) if self.wide else (0, 0), np.float32), 0

    def settle(self) -> None:
        """Sums of the last rows, in single precision, are added to those of all rows before single precision tells."""
        if self.held:
            self.grads[:-1] += self.recent
            self.recent[:], self.held = 0.0, 0

    def add(self, batch: pa.RecordBatch) -> None:
        lists = batch.column("idx")
        idx, val = lists.flatten().to_numpy(zero_copy_only=False), batch.column("val").flatten().to_numpy(zero_copy_only=False)
        sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
        fold, y = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("fold", "y"))
        self.add_rows(fold, y, sizes, idx, val, _lengths(self.problems, idx, val, sizes))

    def add_rows(self, fold: np.ndarray, y: np.ndarray, sizes: np.ndarray, idx: np.ndarray, val: np.ndarray, lengths: np.ndarray) -> None:
        self.touched[idx], self.touched[-1] = True, True
        rows, starts = _starts(sizes)
        by_row = self.wide and len(idx) >= LONG_ROWS * len(rows)
        margins = np.zeros((len(y), self.first[-1]))
        ends = starts + sizes[rows]
        if by_row:
            short = val.astype(np.float32)
            for r, start, end in zip(rows, starts, ends):
                margins[r] = short[start:end] @ self.points.take(idx[start:end], axis=0)
        elif len(rows):
            for c in range(self.first[-1]):
                point = self.points[:, c] if self.wide else self.points[c]
                margins[rows, c] = np.add.reduceat(val * point[idx], starts)
        slopes = np.empty_like(margins)
        for m, p in enumerate(self.problems):
            own = slice(self.first[m], self.first[m + 1])
            value, slope = p.loss.at(margins[:, own] / lengths[m][:, None] + self.coefs[m][:, -1], y, fold != p.without if p.without is not None else None)
            self.values[m] += value
            self.grads[-1, own] += slope.sum(axis=0)
            slopes[:, own] = slope / lengths[m][:, None]
        if by_row:
            short_slopes = slopes.astype(np.float32)
            for r, start, end in zip(rows, starts, ends):
                at = idx[start:end]  # a row has a feature once
                sums = self.recent.take(at, axis=0)
                sums += np.multiply.outer(short[start:end], short_slopes[r])
                self.recent[at] = sums
            self.held += len(idx)
            if self.held >= RECENT:
                self.settle()
        else:
            for c in range(self.first[-1]):
                self.grads[:-1, c] += np.bincount(idx, weights=val * np.repeat(slopes[:, c], sizes), minlength=self.width - 1)

    def add_pieces(self, batch: pa.RecordBatch) -> None:
        """The rows in pieces of bounded size: a batch has as many rows as the session says, however long."""
        ends = np.cumsum(batch.column("idx").value_lengths().to_numpy(zero_copy_only=False))
        first = 0
        while first < len(ends):
            before = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, before + PIECE, side="right")))
            self.add(batch.slice(first, last - first))
            first = last

    def blocks(self):
        """(block, positions, entries of all models at them); block -1 has the losses."""
        self.settle()
        for m, p in enumerate(self.problems):
            if p.scale is not None:
                self.grads[:-1, self.first[m] : self.first[m + 1]] *= p.scale[:, None]
        yield -1, b"", self.values.tobytes()
        for start in range(0, self.width, BLOCK):
            at = np.flatnonzero(self.touched[start : start + BLOCK])
            if len(at):
                entries = np.ascontiguousarray(self.grads[start + at].T, np.float32)
                yield start // BLOCK, at.astype(np.uint16).tobytes(), entries.tobytes()


def _rows(triples) -> pa.RecordBatch:
    blocks, at, g = zip(*triples, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(blocks, pa.int32()), pa.array(at, pa.binary()), pa.array(g, pa.binary())], names=["block", "at", "g"])


def _add_blocks(batches):
    """Sums of the blocks of one reducer; a block's parts stream by."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, at, g in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if block < 0:
                sums[block] = sums.get(block, 0.0) + np.frombuffer(g)
                continue
            where = np.frombuffer(at, np.uint16)
            part = np.frombuffer(g, np.float32).reshape(-1, len(where))
            if block not in sums:
                sums[block] = np.zeros((len(part), BLOCK))
            sums[block][:, where] += part
    if sums:
        yield _rows((b, b"", (v if b < 0 else v.astype(np.float32)).tobytes()) for b, v in sums.items())


ROWS_SCHEMA = "ints binary, low binary, high binary, val binary, kind string, lengths binary"


def _packed_ids(idx: np.ndarray) -> tuple[bytes, bytes]:
    """Feature ids in three bytes where they fit, else in four."""
    high = idx >> 16
    return idx.astype(np.uint16).tobytes(), high.astype(np.uint8 if not len(idx) or idx.max() < 1 << 24 else np.uint16).tobytes()


def _ids(low: bytes, high: bytes) -> np.ndarray:
    out = np.frombuffer(low, np.uint16).astype(np.int32)
    return out | np.frombuffer(high, np.uint8 if len(high) < len(low) else np.uint16).astype(np.int32) << 16


def _packed_values(val: np.ndarray) -> tuple[bytes, str]:
    """The values in as few bytes as hold them exactly: counts mostly take one."""
    for kind in ("u1", "f4"):
        with np.errstate(invalid="ignore", over="ignore"):
            short = val.astype(kind)
        if np.array_equal(short, val):
            return short.tobytes(), kind
    return val.astype("f8").tobytes(), "f8"


def _pack_rows(shared_problems):
    """Rows of ``sparse_rows`` as arrays of bounded size: (fold, y, entries) of the rows, entries, the rows' lengths by model."""

    def pack(batches):
        for batch in batches:
            lists = batch.column("idx")
            ends, first = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False)), 0
            while first < len(ends):
                before = ends[first - 1] if first else 0
                last = max(first + 1, int(np.searchsorted(ends, before + PIECE, side="right")))
                some = batch.slice(first, last - first)
                idx, val = (some.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("idx", "val"))
                sizes = some.column("idx").value_lengths().to_numpy(zero_copy_only=False)
                ints = np.stack([some.column("fold").to_numpy(zero_copy_only=False), some.column("y").to_numpy(zero_copy_only=False), sizes])
                values, kind = _packed_values(val)
                held = (ints.astype(np.int32).tobytes(), *_packed_ids(idx), values, kind, _lengths(shared_problems.value, idx, val, sizes).tobytes())
                arrays = [pa.array([x], pa.string() if isinstance(x, str) else pa.binary()) for x in held]
                yield pa.RecordBatch.from_arrays(arrays, names=["ints", "low", "high", "val", "kind", "lengths"])
                first = last

    return pack


def packed_rows(rows: DataFrame, shared_problems) -> RDD:
    """The rows as ``evaluate`` reads them fastest. They keep their partitions, which a core takes one after the other."""
    return rows.mapInArrow(_pack_rows(shared_problems), ROWS_SCHEMA).rdd.map(tuple)


def _add_packed(part: _Partial, piece, names: list[int], n_problems: int) -> None:
    ints, low, high, val, kind, lengths = piece
    fold, y, sizes = np.frombuffer(ints, np.int32).reshape(3, -1)
    val = np.frombuffer(val, kind).astype(np.float64)
    part.add_rows(fold, y, sizes, _ids(low, high), val, np.frombuffer(lengths).reshape(n_problems, -1)[names])


#: Bytes of all tasks' gradients up to which the driver adds them up itself.
DIRECT = 1 << 26


def evaluate(rows: DataFrame | RDD, shared_problems, asked: dict[int, np.ndarray]) -> dict[int, tuple[float, np.ndarray]]:
    """Loss and gradient, without the penalty, of the asked models at their coefficients: one Spark job.

    ``rows``: as of ``sparse_rows``, or pieces of ``packed_rows``, whose jobs need no query plan.
    """
    packed = isinstance(rows, RDD)
    sc, names = rows.context if packed else rows.sparkSession.sparkContext, sorted(asked)
    points = sc.broadcast([asked[m].astype(np.float32) for m in names])
    first = np.cumsum([0] + [len(asked[m]) for m in names])
    width = asked[names[0]].shape[1]

    def partial():
        return _Partial([shared_problems.value[m] for m in names], points.value)

    def task(batches):
        part = partial()
        for batch in batches:
            if batch.num_rows:
                part.add_pieces(batch)
        yield _rows(part.blocks())

    def packed_task(pieces):
        part = partial()
        for piece in pieces:
            _add_packed(part, piece, names, len(shared_problems.value))
        return ((block, (at, g)) for block, at, g in part.blocks())

    reducers = min(sc.defaultParallelism, 2 * int(first[-1]))  # they follow the models' size: the session's number follows the text's
    if packed:
        rows = rows.coalesce(sc.defaultParallelism)  # a task hands over a gradient, however many partitions it reads
        parts = rows.mapPartitions(packed_task)
        if rows.getNumPartitions() * int(first[-1]) * width * 4 > DIRECT:
            parts = parts.partitionBy(reducers, lambda block: block + 1).mapPartitions(_add_keyed)
        summed = _add_keyed(parts.collect())  # the models' size, times the tasks if that is little
    else:
        parts = rows.coalesce(sc.defaultParallelism).mapInArrow(task, BLOCK_SCHEMA)
        table = parts.repartition(reducers, "block").mapInArrow(_add_blocks, BLOCK_SCHEMA).toArrow()  # the models' size
        summed = ((b, (at, g)) for b, at, g in zip(*(table[c].to_pylist() for c in ("block", "at", "g")), strict=True))
    grads, values = np.zeros((first[-1], width)), np.zeros(len(names))
    for block, (_, g) in summed:
        if block < 0:
            values = np.frombuffer(g)
        else:
            start = block * BLOCK
            grads[:, start : start + BLOCK] = np.frombuffer(g, np.float32).reshape(first[-1], BLOCK)[:, : width - start]
    points.destroy()
    return {m: (float(values[k]), grads[first[k] : first[k + 1]]) for k, m in enumerate(names)}


def _add_keyed(parts):
    """``_add_blocks`` of (block, (positions, entries)) pairs; sums are given as such pairs, whole blocks."""
    for batch in _add_blocks(_rows([(block, *part)]) for block, part in parts):
        for block, at, g in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            # a sum has every position of its block
            yield block, (at if block < 0 else _EVERY, g)


_EVERY = np.arange(BLOCK, dtype=np.uint16).tobytes()


def intercept_curvature(n_features: int) -> float:
    """An intercept's curvature against a feature's: rows of length 1 share theirs among all features, but a few have most of it."""
    return min(100.0, max(1.0, n_features / 100))


def _first_guess(vector: np.ndarray, bend: float) -> np.ndarray:
    """The vector by the first guess of the inverse curvature; the last column is the intercepts'."""
    out = vector.copy()
    out[..., -1] /= bend
    return out


def lbfgs(start: np.ndarray, tol: float, max_iter: int, relative: bool = False, bend: float = 1.0, dot=np.vdot, top=lambda grad: np.abs(grad).max()):
    """L-BFGS with backtracking as a generator: it yields a point, is sent (value, gradient)
    there, and returns (point, iterations, converged).

    It stops when no gradient entry is above ``tol``, of the first gradient's largest
    entry if ``relative``. The absolute rule is that of the reference's logistic
    solver, whose objective is a mean as this one is; the entries of a squared hinge
    with a weak penalty shrink with the rows, so its rule is relative. ``dot`` and
    ``top``, the largest entry, are given for vectors that are not held as such.

    An intercept belongs to every row and bends the loss more than a feature does,
    ``bend`` times. Unless the first guess of the curvature knows, most steps go into that.
    """
    x = start
    value, grad = yield x
    limit = tol * float(top(grad)) if relative else tol
    pairs, part = deque(maxlen=MEMORY), np.empty_like(x)  # one buffer for all products: the vectors are long
    for used in range(max_iter):
        if top(grad) <= limit:
            return x, used, True
        step, alphas = -grad, []
        for s, y, rho in reversed(pairs):
            alphas.append(rho * dot(s, step))
            step -= np.multiply(y, alphas[-1], out=part)
        step = _first_guess(step, bend)
        if pairs:
            s, y, rho = pairs[-1]
            step /= rho * dot(y, _first_guess(y, bend))
        else:
            step /= np.sqrt(-dot(grad, step))
        for (s, y, rho), alpha in zip(pairs, reversed(alphas)):
            step += np.multiply(s, alpha - rho * dot(y, step), out=part)
        slope, length = dot(grad, step), 1.0
        while True:
            new_value, new_grad = yield x + length * step
            if new_value <= value + 1e-4 * length * slope:
                break
            length /= 2
            if length < 1e-10:  # no descent left at this precision
                return x, used, False
        if length < 1.0:
            step *= length
        y = new_grad - grad
        curvature = dot(step, y)
        if curvature > 0:
            pairs.append((step, y, 1.0 / curvature))
        x, value, grad = x + step, new_value, new_grad
    return x, max_iter, bool(top(grad) <= limit)


def _penalised(loss: Loss, w: np.ndarray, value: float, grad: np.ndarray) -> tuple[float, np.ndarray]:
    """Value and gradient with the penalty; only the squared hinge penalises the intercepts."""
    reg, free = np.asarray(loss.reg), loss.kind != "squared_hinge"
    square = np.array([np.vdot(row, row) for row in w]) - (w[:, -1] ** 2 if free else 0.0)
    out = np.multiply(w, reg[:, None])
    if free:
        out[:, -1] = 0.0
    out += grad
    return value + 0.5 * float((reg * square).sum()), out


def _advance(running, loss: Loss, w: np.ndarray, answer: tuple[float, np.ndarray]):
    """The next point a model asks for, or what it has found."""
    try:
        return running.send(_penalised(loss, w, *answer)), None
    except StopIteration as done:
        return None, done.value


def fit_all(rows: DataFrame, problems: list[Problem], n_features: int, tol: float, max_iter: int) -> list[tuple[np.ndarray, int, bool]]:
    """(coefficients with the intercept last, one row a column; iterations; converged) of every model.

    ``rows`` as of ``sparse_rows``, packed and held while the models are fitted. Every round evaluates
    the points that the unfinished models ask for; the models' own steps are
    vector arithmetic on the driver, a thread for each.
    """
    shared = rows.sparkSession.sparkContext.broadcast(problems)
    rows = packed_rows(rows, shared).persist(StorageLevel.DISK_ONLY)
    running, asked, found = {}, {}, {}
    for m, p in enumerate(problems):
        running[m] = lbfgs(np.zeros((len(p.loss.positive), n_features + 1)), tol, max_iter, p.loss.kind == "squared_hinge", intercept_curvature(n_features))
        asked[m] = next(running[m])
    with ThreadPoolExecutor(max_workers=len(problems)) as pool:
        while asked:
            answers = evaluate(rows, shared, asked)
            steps = {m: pool.submit(_advance, running[m], problems[m].loss, asked[m], answers[m]) for m in asked}
            for m, step in steps.items():
                point, done = step.result()
                if point is None:
                    found[m] = done
                    del asked[m]
                else:
                    asked[m] = point
    rows.unpersist()
    shared.destroy()
    return [found[m] for m in range(len(problems))]


def fit(vectors: DataFrame, loss: Loss, n_features: int, tol: float, max_iter: int) -> tuple[np.ndarray, int, bool]:
    """One model over (features, label_id) rows, persisted by the caller."""
    return fit_all(sparse_rows(vectors), [Problem(loss)], n_features, tol, max_iter)[0]


# ------------------------------------------- more features than a driver holds

PACKED_SCHEMA = "ids binary, counts binary, at binary, val binary"
PACK = 1 << 20  # entries of a packed piece


def _pack(keys):
    """Rows (row, feature, value) sorted by feature → pieces of whole features: ids, entries of each, row positions, values."""

    def pack(batches):
        held, size, limit = [], 0, PACK

        def cut(last):
            nonlocal held, size
            ids, at, val = (np.concatenate(c) for c in zip(*held, strict=True))
            end = len(ids) if last else int(np.searchsorted(ids, ids[-1]))  # the last feature may go on
            held, size = [(ids[end:], at[end:], val[end:])], len(ids) - end
            if end:
                starts = np.flatnonzero(np.r_[True, ids[1:end] != ids[: end - 1]])
                counts = np.diff(np.r_[starts, end])
                columns = (ids[starts].astype(np.int64), counts.astype(np.int32), at[:end].astype(np.int32), val[:end].astype(np.float64))
                yield pa.RecordBatch.from_arrays([pa.array([c.tobytes()], pa.binary()) for c in columns], names=["ids", "counts", "at", "val"])

        for batch in batches:
            if batch.num_rows:
                row, ids, val = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
                held.append((ids, np.searchsorted(keys.value, row), val))
                size += len(ids)
                if size >= limit:
                    yield from cut(False)
                    limit = size + PACK
        if size:
            yield from cut(True)

    return pack


def _pieces(batch: pa.RecordBatch):
    """(ids, entries of each feature, where each begins, row positions, values) of the packed pieces."""
    for ids, counts, at, val in zip(*(c.to_pylist() for c in batch.columns), strict=True):
        counts = np.frombuffer(counts, np.int32)
        yield np.frombuffer(ids, np.int64), counts, np.cumsum(counts) - counts, np.frombuffer(at, np.int32), np.frombuffer(val)


def _add_margins(batches):
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, g in zip(batch.column("block").to_pylist(), batch.column("g").to_pylist(), strict=True):
            part = np.frombuffer(g)
            if block in sums:
                sums[block] = np.maximum(sums[block], part) if block < 0 else sums[block] + part
            else:
                sums[block] = part
    if sums:
        yield _rows((b, b"", v.tobytes()) for b, v in sums.items())


def _margins(packed: DataFrame, of_rows: np.ndarray) -> tuple[np.ndarray, float]:
    """X Xᵀ a of row weights a (columns x rows), and the largest entry of Xᵀ a: one Spark job."""
    sc = packed.sparkSession.sparkContext
    shared, (k, n) = sc.broadcast(of_rows), of_rows.shape

    def task(batches):
        a, sums, largest = shared.value, np.zeros((k, n)), 0.0
        for batch in batches:
            for _, counts, starts, at, val in _pieces(batch):
                for c in range(k):
                    w = np.add.reduceat(val * a[c, at], starts)
                    largest = max(largest, float(np.abs(w).max()))
                    sums[c] += np.bincount(at, weights=val * np.repeat(w, counts), minlength=n)
        yield _rows([(-1, b"", np.array([largest]).tobytes())] + [(s // BLOCK, b"", sums[:, s : s + BLOCK].tobytes()) for s in range(0, n, BLOCK)])

    parts = packed.coalesce(sc.defaultParallelism).mapInArrow(task, BLOCK_SCHEMA)
    summed = parts.repartition("block").mapInArrow(_add_margins, BLOCK_SCHEMA).toArrow()  # a number a row and column
    shared.destroy()
    out, largest = np.zeros((k, n)), 0.0
    for block, g in zip(summed["block"].to_pylist(), summed["g"].to_pylist(), strict=True):
        if block < 0:
            largest = float(np.frombuffer(g)[0])
        else:
            out[:, block * BLOCK : (block + 1) * BLOCK] = np.frombuffer(g).reshape(k, -1)
    return out, largest


def fit_wide(vectors: DataFrame, loss: Loss, tol: float, max_iter: int, row: str) -> tuple[DataFrame, list[float], int, bool]:
    """((feature_id, coefs), intercepts, iterations, converged) of one model over (row, features, label_id).

    For more features than a driver can hold vectors of: coefficients, gradients and
    steps are all sums of rows, so the driver keeps their row weights and margins, two
    numbers a labelled row and column, and the features stay where their entries are.
    The table of coefficients is written; ``row`` is a unique key.
    """
    spark = vectors.sparkSession
    coded = vectors.select(row, "label_id").toArrow().sort_by(row)
    y, keys = coded["label_id"].to_numpy(), spark.sparkContext.broadcast(coded[row].to_numpy())
    k, n = len(loss.positive), len(y)
    v = F.unwrap_udt("features")
    total, width = vectors.select(F.sum(F.size(v["indices"])), F.max(v["size"])).first()
    entries = vectors.select(row, F.explode(F.arrays_zip(v["indices"].alias("feature_id"), v["values"].alias("value"))).alias("e"))
    entries = entries.select(row, "e.feature_id", "e.value")
    pieces = max(spark.sparkContext.defaultParallelism, (total or 0) // (2 * PACK))
    packed = entries.repartition(pieces, "feature_id").sortWithinPartitions("feature_id").mapInArrow(_pack(keys), PACKED_SCHEMA)
    packed = packed.persist(StorageLevel.MEMORY_AND_DISK)
    reg, free, largest = np.asarray(loss.reg), loss.kind != "squared_hinge", 0.0

    def dot(a, b):  # of the vectors themselves: row weights of one by margins of the other
        return np.vdot(a[:, :n], b[:, n : 2 * n]) + np.vdot(a[:, -1], b[:, -1])

    running = lbfgs(np.zeros((k, 2 * n + 1)), tol, max_iter, not free, intercept_curvature(width or 0), dot, lambda _: largest)
    x, done = next(running), None
    while done is None:
        weights, margins, intercepts = x[:, :n], x[:, n : 2 * n], x[:, -1]
        value, slope = loss.at((margins + intercepts[:, None]).T, y)
        held = np.zeros(k) if free else intercepts
        value += 0.5 * float((reg * ((weights * margins).sum(axis=1) + held**2)).sum())
        grad = slope.T + reg[:, None] * weights
        grad_margins, largest = _margins(packed, grad)
        last = slope.sum(axis=0) + reg * held
        largest = max(largest, float(np.abs(last).max()))
        try:
            x = running.send((value, np.concatenate([grad, grad_margins, last[:, None]], axis=1)))
        except StopIteration as stop:
            done = stop.value
    found, used, converged = done
    shared = spark.sparkContext.broadcast(np.ascontiguousarray(found[:, :n]))

    def coefficients(batches):
        for batch in batches:
            for ids, _, starts, at, val in _pieces(batch):
                w = np.stack([np.add.reduceat(val * a[at], starts) for a in shared.value], axis=1)
                lists = pa.FixedSizeListArray.from_arrays(w.ravel(), len(shared.value)).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([pa.array(ids), lists], names=["feature_id", "coefs"])

    path = scratch_path(spark, "coefficients")
    packed.mapInArrow(coefficients, "feature_id long, coefs array<double>").write.parquet(path)
    packed.unpersist()
    shared.destroy()
    keys.destroy()
    return spark.read.parquet(path), found[:, -1].tolist(), used, converged
