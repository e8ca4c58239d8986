"""Regularised logistic regressions side by side: many penalties and left-out folds, few passes over the rows.

Each pass adds up loss, gradient and curvature of all fits that are still open; only these sums come to the driver, which takes
a Newton step for each (with an L1 penalty, the minimum of the penalised quadratic). A fit needs about ten passes where a first-order
method needs hundreds, and open fits share them. Rows are blocks of arrays kept in memory between passes, as for trees.

A fit minimises mean loss + penalty on its rows; the intercept is free.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from scorelake.session import ship_by_value

ship_by_value(__name__)

PASSES = 200
#: A step that promises less than this much of the mean loss is the last one.
LEAST_STEP = 1e-12


@dataclass(frozen=True)
class Fit:
    """What to fit: weight of the L1 and of half the squared L2 norm, and the fold whose rows are left out (None: no fold)."""

    l1: float
    l2: float
    without: int | None = None


def pack_blocks(data: DataFrame, x: str, label: str, fold: str, width: int) -> RDD:
    """Blocks of (rows with a last column of ones, labels, folds), kept in memory as long as passes read them."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = [batch.column(0).flatten().to_numpy(zero_copy_only=False), *(c.to_numpy(zero_copy_only=False) for c in batch.columns[1:])]
            yield pa.RecordBatch.from_arrays([pa.array([c.tobytes()], pa.binary()) for c in cells], ["x", "y", "fold"])

    def decoded(row: tuple) -> tuple[np.ndarray, ...]:
        values, y, own = np.frombuffer(row[0]), np.frombuffer(row[1]), np.frombuffer(row[2], dtype=np.int32)
        return np.column_stack([values.reshape(len(y), width), np.ones(len(y))]), y, own

    chosen = data.select(vector_to_array(x), F.col(label).cast("double"), F.col(fold).cast("int"))
    return chosen.mapInArrow(pack, "x binary, y binary, fold binary").rdd.map(decoded).persist(StorageLevel.MEMORY_AND_DISK)


def _sums(blocks: RDD, at: Mapping[Fit, np.ndarray]) -> dict[Fit, np.ndarray]:
    """Loss, gradient and curvature of each fit at its point, summed over its rows: one row for each fit comes back."""
    by_fold: dict[int | None, list[Fit]] = {}
    for fit in at:
        by_fold.setdefault(fit.without, []).append(fit)
    points = {fold: np.stack([at[fit] for fit in fits], axis=1) for fold, fits in by_fold.items()}
    place = {fit: i for i, fit in enumerate(at)}
    places = {fold: [place[fit] for fit in fits] for fold, fits in by_fold.items()}

    def add(parts: Iterator[tuple]) -> Iterator[tuple[int, np.ndarray]]:
        out: dict[int, np.ndarray] = {}
        for x, y, own in parts:
            for fold, point in points.items():
                rows, labels = (x, y) if fold is None else (x[own != fold], y[own != fold])
                margin = rows @ point
                loss = (np.logaddexp(0.0, margin) - labels[:, None] * margin).sum(axis=0)
                p = 0.5 * (1.0 + np.tanh(0.5 * margin))
                slope, bend = rows.T @ (p - labels[:, None]), p * (1.0 - p)
                for i, to in enumerate(places[fold]):
                    curve = rows.T @ (rows * bend[:, i : i + 1])
                    total = np.concatenate([[loss[i]], slope[:, i], curve.reshape(-1)])
                    out[to] = out[to] + total if to in out else total
        yield from out.items()

    merged = blocks.mapPartitions(add).reduceByKey(np.add, min(len(at), blocks.context.defaultParallelism))
    found = dict(merged.collect())
    return {fit: found[i] for fit, i in place.items()}


def _step(point: np.ndarray, slope: np.ndarray, curve: np.ndarray, l1: float) -> np.ndarray:
    """Minimum of the quadratic at ``point`` plus ``l1`` times the L1 norm of all but the last entry (the intercept)."""
    size = len(point)
    weight = np.append(np.full(size - 1, l1), 0.0)
    constant = curve @ point - slope  # The quadratic is z' curve z / 2 - constant' z.

    def solved(rows: np.ndarray, right: np.ndarray) -> np.ndarray:
        return np.linalg.lstsq(curve[np.ix_(rows, rows)], right, rcond=1e-15)[0]

    if not l1:
        return solved(np.arange(size), constant)
    z, room = point.copy(), 1e-12 + 1e-9 * l1
    for _ in range(500):
        for _ in range(20):
            for j in (size - 1, *range(size - 1)):
                left = constant[j] - curve[j] @ z + curve[j, j] * z[j]
                z[j] = math.copysign(max(abs(left) - weight[j], 0.0), left) / curve[j, j] if curve[j, j] > 0 else 0.0
        # With the right columns and signs the rest is linear.
        kept = np.flatnonzero((z != 0) | (weight == 0))
        exact = np.zeros(size)
        exact[kept] = solved(kept, constant[kept] - weight[kept] * np.sign(z[kept]))
        rest = constant - curve @ exact
        signs = (np.sign(exact[kept]) == np.sign(z[kept])) | (weight[kept] == 0)
        others = np.abs(rest) <= weight + room
        if signs.all() and others.all() and np.abs(rest[kept] - weight[kept] * np.sign(exact[kept])).max() <= room:
            return exact
    return z


def fit_all(blocks: RDD, fits: Sequence[Fit], width: int) -> dict[Fit, np.ndarray]:
    """Coefficients and, last, the intercept of each fit. With labels of one class only the intercept counts, and is infinite."""
    def counts(parts: Iterator[tuple]) -> Iterator[tuple[int, np.ndarray]]:
        for _, y, own in parts:
            for fold in np.unique(own).tolist():
                yield fold, np.array([(own == fold).sum(), y[own == fold].sum()])

    # One row a fold.
    seen = dict(blocks.mapPartitions(counts).reduceByKey(np.add, 1).collect())
    held = {fit: sum((c for fold, c in seen.items() if fold != fit.without), np.zeros(2)) for fit in fits}
    done: dict[Fit, np.ndarray] = {}
    point, trial = {}, {}
    for fit in dict.fromkeys(fits):
        rows, positive = held[fit]
        if not rows:
            raise ValueError(f"no rows without fold {fit.without}")
        if positive in (0, rows):
            done[fit] = np.append(np.zeros(width), math.inf if positive else -math.inf)
        else:
            trial[fit] = np.append(np.zeros(width), math.log(positive / (rows - positive)))
    best: dict[Fit, tuple] = {}

    def cost(fit: Fit, at: np.ndarray) -> float:
        return fit.l1 * np.abs(at[:-1]).sum() + 0.5 * fit.l2 * (at[:-1] ** 2).sum()

    for _ in range(PASSES):
        if not trial:
            return done
        for fit, total in _sums(blocks, trial).items():
            total = total / held[fit][0]
            value = total[0] + cost(fit, trial[fit])
            if fit in best:
                old, direction, length, promised = best[fit]
                if not value <= old + 1e-4 * length * promised:
                    # Too far: half the way.
                    best[fit] = old, direction, length / 2, promised
                    trial[fit] = point[fit] + length / 2 * direction
                    continue
            at = point[fit] = trial[fit]
            free = np.append(np.full(width, fit.l2), 0.0)
            slope, curve = total[1 : width + 2] + free * at, total[width + 2 :].reshape(width + 1, width + 1) + np.diag(free)
            direction = _step(at, slope, curve, fit.l1) - at
            promised = slope @ direction + fit.l1 * (np.abs(at + direction)[:-1].sum() - np.abs(at[:-1]).sum())
            trial[fit] = at + direction
            best[fit] = value, direction, 1.0, promised
            if promised > -LEAST_STEP:
                done[fit] = trial.pop(fit)
    raise ArithmeticError(f"{len(trial)} fits did not settle in {PASSES} passes")


def margins(data: DataFrame, x: str, label: str, fold: str, models: Mapping[int, Sequence[np.ndarray]]) -> DataFrame:
    """(fold, combo, score, label): each row with the models of its own fold, numbered as given. Equal rows score alike."""
    folds = {own: [m.tolist() for m in each] for own, each in models.items()}

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y, own = (c.to_numpy(zero_copy_only=False) for c in batch.columns[1:])
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(len(y), -1)
            for fold, each in folds.items():
                mine = own == fold
                columns = x[mine].T
                for i, (*weights, total) in enumerate(each):
                    margin = np.full(mine.sum(), total)
                    for c, w in zip(columns, weights):
                        margin += c * w
                    made = [np.full(len(margin), fold, np.int32), np.full(len(margin), i, np.int32), margin, y[mine].astype(np.int32)]
                    yield pa.RecordBatch.from_arrays([pa.array(v) for v in made], ["fold", "combo", "score", "label"])

    chosen = data.select(vector_to_array(x), F.col(label).cast("double"), F.col(fold).cast("int"))
    return chosen.mapInArrow(score, "fold int, combo int, score double, label int")
