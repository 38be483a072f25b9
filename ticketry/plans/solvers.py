"""Linear classifiers on sparse rows: squared hinge and softmax, fitted by L-BFGS with gradients summed over the cluster.

The matrix is turned once into blocks of compressed rows, which stay with the executors. One pass over the blocks gives
loss and gradient of all problems that are still running, classes and settings alike; partial sums meet in a tree. Only the
coefficients, one number per feature and class, are on the driver. A matrix of one block (``BLOCK_ENTRIES`` entries at
most) is one task anyway: its passes run one after the other inside that task, by the same code.

Rows carry the number of times they occur with each label, so equal rows are one, whatever their labels.
"""

from __future__ import annotations

from collections.abc import Generator, Iterator, Sequence
from dataclasses import dataclass, field
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

BLOCK_ENTRIES = 1 << 18


# -- blocks -------------------------------------------------------------------------------
@dataclass
class Block:
    """Compressed rows: entries of row i stand at starts[i] to starts[i + 1]; each row ends with the constant feature.

    Row of[j] occurs times[j] times with label[j].
    """

    starts: np.ndarray
    indices: np.ndarray
    values: np.ndarray
    of: np.ndarray
    label: np.ndarray
    times: np.ndarray

    def margins(self, w: np.ndarray) -> np.ndarray:
        """[rows, columns] products with the columns of ``w``."""
        return np.add.reduceat(self.values[:, None] * w[self.indices], self.starts, axis=0)

    def spread(self, r: np.ndarray, features: int) -> np.ndarray:
        """[features, columns] sums over the rows, each times its factors in ``r``."""
        row = np.repeat(np.arange(len(self.starts)), np.diff(np.append(self.starts, len(self.indices))))
        return np.stack([np.bincount(self.indices, self.values * c[row], features) for c in r.T], axis=1)


def _encode(batches: Iterator[pa.RecordBatch], constant: int) -> Iterator[pa.RecordBatch]:
    names = ("starts", "indices", "values", "of", "label", "times")
    for batch in batches:
        rows = list(zip(*[batch.column(c).to_pylist() for c in ("indices", "values", "labels", "times")], strict=True))
        while rows:
            size, n = 0, 0
            while n < len(rows) and (n == 0 or size + len(rows[n][0]) < BLOCK_ENTRIES):
                size += len(rows[n][0]) + 1
                n += 1
            part, rows = rows[:n], rows[n:]
            lengths = np.array([len(r[0]) + 1 for r in part])
            made = (np.cumsum(lengths) - lengths, np.concatenate([[*r[0], constant] for r in part]), np.concatenate([[*r[1], 1.0] for r in part]),
                    np.repeat(np.arange(n), [len(r[2]) for r in part]), np.concatenate([r[2] for r in part]), np.concatenate([r[3] for r in part]))
            kinds = ("<i8", "<i4", "<f8", "<i4", "<i4", "<f8")
            yield pa.record_batch([pa.array([a.astype(k).tobytes()], pa.binary()) for a, k in zip(made, kinds, strict=True)], names=list(names))


def _decode(row) -> Block:
    kinds = {"starts": "<i8", "indices": "<i4", "values": "<f8", "of": "<i4", "label": "<i4", "times": "<f8"}
    return Block(**{c: np.frombuffer(row[c], k) for c, k in kinds.items()})


class Matrix:
    """Blocks of a frame with indices, values, label (class number) and times, or both as lists of one length. Use as a context: blocks
    are released at its end.

    The frame is read twice: for its size, which says how many tasks it takes, and for the blocks.
    """

    def __init__(self, rows: DataFrame, features: int, classes: int) -> None:
        self.features, self.classes = features, classes
        constant = features  # the place behind the last feature
        listed = F.col if isinstance(rows.schema["label"].dataType, ArrayType) else F.array
        frame = rows.select(F.col("indices").cast("array<int>"), F.col("values").cast("array<double>"), listed("label").cast("array<int>").alias("labels"),
                            listed("times").cast("array<double>").alias("times"))
        entries = frame.agg(F.sum(F.size("indices") + 1)).first()[0] or 0
        self.tasks = max(1, -(-entries // BLOCK_ENTRIES))
        coded = frame.coalesce(self.tasks).mapInArrow(lambda batches: _encode(batches, constant), "starts binary, indices binary, values binary, of binary, label binary, times binary")
        self.blocks = coded.rdd.map(_decode).persist(StorageLevel.MEMORY_AND_DISK)
        self.context = rows.sparkSession.sparkContext

    def __enter__(self) -> Matrix:
        return self

    def __exit__(self, *_) -> None:
        self.blocks.unpersist()

    def sums(self, of, *given) -> list[np.ndarray]:
        """The sums of the arrays ``of(block, *given)`` over all blocks. They meet on the executors: the driver gets them once a pass."""
        shared = self.context.broadcast(given)
        parts = self.blocks.mapPartitions(lambda blocks: [total] if (total := added(blocks, of, shared.value)) is not None else [])
        try:
            if (n := self.blocks.getNumPartitions()) > 64:
                parts = _met(parts, ceil(sqrt(n)))
            if n > 1:
                parts = _met(parts, 1)
            return parts.collect()[0]
        finally:
            shared.destroy()


def _met(parts, n: int):
    """The arrays of ``parts`` added up to those of ``n`` tasks."""
    dealt = parts.mapPartitionsWithIndex(lambda i, found: ((i % n, arrays) for arrays in found))
    return dealt.reduceByKey(lambda a, b: [x + y for x, y in zip(a, b, strict=True)], n).values()


class Local:
    """The same inside a task: blocks in its memory."""

    def __init__(self, blocks: Sequence[Block], features: int) -> None:
        self.blocks, self.features = blocks, features

    def sums(self, of, *given) -> list[np.ndarray]:
        return added(self.blocks, of, given)


def added(blocks, of, given) -> list[np.ndarray] | None:
    total = None
    for block in blocks:
        made = of(block, *given)
        total = made if total is None else [a + b for a, b in zip(total, made, strict=True)]
    return total


# -- problems ----------------------------------------------------------------------------
@dataclass(frozen=True)
class Problem:
    """hinge: one class (``target``) against the rest; softmax: all classes. Penalty 1/2 |w|^2, loss times ``c`` and the class's weight.

    The squared hinge penalises the constant like any feature; softmax leaves it free.
    """

    loss: str
    c: float
    class_weights: tuple[float, ...]
    target: int = 0

    @property
    def columns(self) -> int:
        return 1 if self.loss == "hinge" else len(self.class_weights)

    def row_weights(self, label: np.ndarray) -> np.ndarray:
        """The weight of a class counts for its own rows; between two classes each has its own, else the rest weigh 1."""
        weight = np.array(self.class_weights)
        if self.loss == "hinge" and len(weight) > 2:
            weight = np.where(np.arange(len(weight)) == self.target, weight, 1.0)
        return weight[label]

    def at(self, margins: np.ndarray, of: np.ndarray, label: np.ndarray, times: np.ndarray) -> tuple[float, np.ndarray]:
        """Loss and its derivative by the margins."""
        s, n = self.c * self.row_weights(label) * times, len(margins)
        if self.loss == "hinge":
            mine = label == self.target
            of_class, of_rest = np.bincount(of, s * mine, n), np.bincount(of, s * ~mine, n)
            low, high = np.maximum(0.0, 1.0 - margins[:, 0]), np.maximum(0.0, 1.0 + margins[:, 0])
            return float((of_class * low * low + of_rest * high * high).sum()), (2.0 * (of_rest * high - of_class * low))[:, None]
        top = margins.max(axis=1, keepdims=True)
        e = np.exp(margins - top)
        total = e.sum(axis=1, keepdims=True)
        k, whole = margins.shape[1], np.bincount(of, s, n)
        told = np.bincount(of * k + label, s, n * k).reshape(n, k)
        loss = (whole * (np.log(total[:, 0]) + top[:, 0])).sum() - (told * margins).sum()
        return float(loss), whole[:, None] * e / total - told


@dataclass
class Solution:
    """Coefficients [features + 1, columns], the constant last, and how the fit went."""

    problem: Problem
    w: np.ndarray
    loss: float
    first_gradient: float
    last_gradient: float
    steps: int
    converged: bool
    history: list[float] = field(default_factory=list)


def lbfgs(x: np.ndarray, scale: np.ndarray, tolerance: float, most: int, memory: int = 10) -> Generator[np.ndarray, tuple[float, np.ndarray], tuple]:
    """Yields points, is sent (value, gradient) and returns (x, value, first norm, last norm, steps, history).

    ``scale`` is an estimate of the curvature per coordinate. Steps are shortened until the value falls enough.
    """
    value, gradient = yield x
    first = float(np.linalg.norm(gradient))
    pairs: list[tuple[np.ndarray, np.ndarray, float]] = []
    history, steps = [value], 0
    while steps < most and np.linalg.norm(gradient) > tolerance * first:
        q, marks = gradient.copy(), []
        for s, y, rho in reversed(pairs):
            a = rho * (s @ q)
            q -= a * y
            marks.append(a)
        q /= scale
        if pairs:
            s, y, rho = pairs[-1]
            q *= 1.0 / (rho * (y @ (y / scale)))
        for (s, y, rho), a in zip(pairs, reversed(marks), strict=True):
            q += (a - rho * (y @ q)) * s
        slope = -(gradient @ q)
        if slope >= 0:
            q, slope, pairs = gradient / scale, -(gradient @ (gradient / scale)), []
        t, tries = 1.0, 0
        while True:
            trial = x - t * q
            new_value, new_gradient = yield trial
            if new_value <= value + 1e-4 * t * slope or tries == 30:
                break
            # the minimum of the parabola through both values and the slope, kept within bounds
            t = float(np.clip(-slope * t * t / (2 * (new_value - value - slope * t)), 0.1 * t, 0.5 * t))
            tries += 1
        if new_value > value:
            break
        s, y = trial - x, new_gradient - gradient
        x, value, gradient = trial, new_value, new_gradient
        steps += 1
        history.append(value)
        if s @ y > 1e-12 * np.linalg.norm(s) * np.linalg.norm(y):
            pairs = [*pairs[-(memory - 1):], (s, y, 1.0 / (s @ y))]
        if not s.any():
            break
    return x, value, first, float(np.linalg.norm(gradient)), steps, history


def _squares(block: Block, problems: Sequence[Problem], d: int) -> list[np.ndarray]:
    """Sums of squares per feature, weighted as each problem weights its rows."""
    r = np.stack([np.bincount(block.of, p.c * p.row_weights(block.label) * block.times, len(block.starts)) for p in problems], axis=1)
    return [Block(block.starts, block.indices, block.values**2, block.of, block.label, block.times).spread(r, d)]


def _pass(block: Block, problems: Sequence[Problem], w: np.ndarray) -> list[np.ndarray]:
    """Losses and gradients of the problems at their columns of ``w``."""
    margins, slopes, losses, at = block.margins(w), [], [], 0
    for p in problems:
        loss, slope = p.at(margins[:, at:at + p.columns], block.of, block.label, block.times)
        losses.append(loss)
        slopes.append(slope)
        at += p.columns
    return [np.array(losses), block.spread(np.concatenate(slopes, axis=1), len(w))]


def solve(matrix: Matrix, problems: Sequence[Problem], tolerance: float = 1e-4, most: int = 1000) -> list[Solution]:
    """All problems side by side: each pass over the matrix serves every one that has not converged.

    A fit has converged when the norm of its gradient is at most ``tolerance`` of the norm at zero coefficients.
    """
    problems, features = list(problems), matrix.features
    if matrix.tasks > 1:
        return _solve(matrix, problems, tolerance, most)
    found = matrix.blocks.mapPartitions(lambda blocks: [_solve(Local(kept, features), problems, tolerance, most)] if (kept := list(blocks)) else []).collect()
    if not found:
        raise ValueError("no training rows")
    return found[0]


def _solve(matrix: Matrix | Local, problems: list[Problem], tolerance: float, most: int) -> list[Solution]:
    d = matrix.features + 1
    curvature = matrix.sums(_squares, problems, d)[0]
    free = np.zeros(d)
    free[-1] = 1.0
    runs, out, asked = {}, {}, {}
    for i, p in enumerate(problems):
        penalty = np.ones(d) if p.loss == "hinge" else 1.0 - free
        bend = (2.0 if p.loss == "hinge" else 0.25) * curvature[:, i] + penalty + 1e-12
        runs[i] = (lbfgs(np.zeros(d * p.columns), np.repeat(bend, p.columns), tolerance, most), penalty)
        asked[i] = next(runs[i][0])
    while asked:
        order = sorted(asked)
        w = np.concatenate([asked[i].reshape(d, -1) for i in order], axis=1)
        losses, gradients = matrix.sums(_pass, [problems[i] for i in order], w)
        at = 0
        for i, loss in zip(order, losses.tolist(), strict=True):
            p, x = problems[i], asked[i].reshape(d, -1)
            run, penalty = runs[i]
            value = loss + 0.5 * float((penalty[:, None] * x * x).sum())
            gradient = gradients[:, at:at + p.columns] + penalty[:, None] * x
            at += p.columns
            try:
                asked[i] = run.send((value, gradient.ravel()))
            except StopIteration as end:
                del asked[i]
                x, value, first, last, steps, history = end.value
                out[i] = Solution(p, x.reshape(d, -1), value, first, last, steps, last <= tolerance * first, history)
    return [out[i] for i in range(len(problems))]
