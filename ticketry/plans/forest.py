"""Random forests over categories and binned numbers, whole trees grown side by side in the tasks.

Equal rows are one cell with a count per class, so a bootstrap draws one Poisson number per cell instead of one per row, and the
table that a tree learns from grows with the different rows, not with the rows. A table within ``MOST_CELLS`` goes to every task
that grows trees; whoever has more different rows asks for another method (``fits`` says so). Trees stay in a table and votes
are sums over packs of trees: no tree comes to the driver.

The trees are Spark's: Gini gain, Poisson bootstrap, the root of the number of columns (one per category value or number) tried
at every node, a leaf where none of them helps, leaves of one parent that predict alike joined.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketry.operators.lookups import lookup_join
from ticketry.session import settled

MOST_CELLS = 1 << 19  # different rows, and different rows times classes / 16
MOST_DRAWS = 1 << 22  # random numbers held at once
BINS = 32
PACKS = 64
BLOCK_ROWS = 1 << 14
MOST_BLOCKS = 256  # of rows to score, beyond which they are not broadcast


@dataclass(frozen=True)
class Tree:
    """Nodes in order of depth: column tested (-1: leaf), code, first child (rows that fail go there, others to the next node), and class shares."""

    column: np.ndarray
    code: np.ndarray
    child: np.ndarray
    shares: np.ndarray

    def votes(self, codes: np.ndarray, equal: np.ndarray) -> np.ndarray:
        at = np.zeros(len(codes), np.int64)
        going = np.flatnonzero(self.column[at] >= 0)
        while len(going):
            here = at[going]
            c = self.column[here]
            x, v = codes[going, c], self.code[here]
            at[going] = self.child[here] + np.where(equal[c], x == v, x > v)
            going = going[self.column[at[going]] >= 0]
        return self.shares[at]


@dataclass
class ForestModel:
    """``trees``: pack, trees (pickled); ``categories`` and ``numbers`` as codes and borders; ``classes``."""

    classes: int
    categories: dict[str, dict[str, int]]
    numbers: dict[str, list[float]]
    trees: DataFrame

    @property
    def equal(self) -> np.ndarray:
        return np.array([True] * len(self.categories) + [False] * len(self.numbers))


# -- one tree ------------------------------------------------------------------------------
def _sums(groups: np.ndarray, w: np.ndarray, n: int) -> np.ndarray:
    """[n, classes] sums of the rows of ``w`` by group; every group has a row."""
    order = np.argsort(groups, kind="stable")
    return np.add.reduceat(w[order], np.searchsorted(groups[order], np.arange(n)), axis=0)


def _gini(w: np.ndarray) -> np.ndarray:
    """Weight times impurity."""
    total = w.sum(axis=1)
    return total - (w * w).sum(axis=1) / np.maximum(total, 1e-300)


def _tried(rng: np.random.Generator, nodes: int, columns: int) -> np.ndarray:
    """[nodes, columns] whether a node may use a column: the root of their number each, drawn anew."""
    m, out = ceil(sqrt(columns)), np.zeros((nodes, columns), bool)
    step = max(1, MOST_DRAWS // columns)
    for a in range(0, nodes, step):
        drawn = rng.random((min(step, nodes - a), columns))
        np.put_along_axis(out[a:a + step], np.argpartition(drawn, m - 1, axis=1)[:, :m], True, axis=1)
    return out


def _best(codes: np.ndarray, w: np.ndarray, node: np.ndarray, total: np.ndarray, sizes: Sequence[int], equal: Sequence[bool],
          rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Per node the column and code of the best test, column -1 where none gains. Ties: the first column, the smallest code."""
    n = len(total)
    widths = [s if e else 1 for s, e in zip(sizes, equal, strict=True)]
    tried = _tried(rng, n, sum(widths))
    gain, column, code = np.full(n, 1e-12), np.full(n, -1, np.int32), np.zeros(n, np.int32)
    whole, weight, at = _gini(total), total.sum(axis=1), 0
    for c, (size, width) in enumerate(zip(sizes, widths, strict=True)):
        place = codes[:, c]
        if equal[c]:
            use = (place >= 0) & tried[node, at + np.maximum(place, 0)]
        else:
            use = tried[node, at]
        at += width
        if not use.any():
            continue
        # code -1 (a missing number) is below every border
        pairs, inverse = np.unique(node[use] * (size + 1) + place[use] + 1, return_inverse=True)
        mine, value, found = pairs // (size + 1), pairs % (size + 1) - 1, _sums(inverse, w[use], len(pairs))
        if equal[c]:
            right = found
        else:
            run = np.cumsum(found, axis=0)
            first = np.searchsorted(mine, mine)
            right = total[mine] - (run - (run[first] - found[first]))
        left = total[mine] - right
        now = (whole[mine] - _gini(np.maximum(left, 0.0)) - _gini(np.maximum(right, 0.0))) / weight[mine]
        now[(right.sum(axis=1) <= 1e-9 * weight[mine]) | (left.sum(axis=1) <= 1e-9 * weight[mine])] = -1.0
        order = np.lexsort((value, -now, mine))
        order = order[np.r_[True, np.diff(mine[order]) > 0]]
        order = order[now[order] > gain[mine[order]] + 1e-12]
        gain[mine[order]], column[mine[order]], code[mine[order]] = now[order], c, value[order]
    return column, code


def grow(codes: np.ndarray, w: np.ndarray, sizes: Sequence[int], equal: Sequence[bool], depth: int, rng: np.random.Generator) -> Tree:
    """A tree from rows with weights [rows, classes], level by level."""
    kept = w.any(axis=1)
    codes, w = codes[kept], w[kept]
    if not len(codes):
        return Tree(np.array([-1], np.int32), np.zeros(1, np.int32), np.zeros(1, np.int32), np.full((1, w.shape[1]), 1.0 / w.shape[1]))
    node, first, n = np.zeros(len(codes), np.int64), 0, 1
    levels = []
    for d in range(depth + 1):
        total = _sums(node, w, n)
        column, code = np.full(n, -1, np.int32), np.zeros(n, np.int32)
        mixed = (total > 0).sum(axis=1) > 1
        if d < depth and mixed.any():
            names, rows = np.cumsum(mixed) - 1, mixed[node]
            column[mixed], code[mixed] = _best(codes[rows], w[rows], names[node[rows]], total[mixed], sizes, equal, rng)
        split = column >= 0
        children = 2 * (np.cumsum(split) - 1)
        levels.append((column, code, np.where(split, first + n + children, 0).astype(np.int32), total))
        if not split.any():
            break
        rows = split[node]
        codes, w, node = codes[rows], w[rows], node[rows]
        x, v = codes[np.arange(len(node)), column[node]], code[node]
        right = np.where(np.array(equal)[column[node]], x == v, x > v)
        node, first, n = children[node] + right, first + n, 2 * int(split.sum())
    column, code, child, total = (np.concatenate(x) for x in zip(*levels, strict=True))
    return _joined(column, code, child, total, np.cumsum([0, *[len(x[0]) for x in levels]]))


def _joined(column: np.ndarray, code: np.ndarray, child: np.ndarray, total: np.ndarray, starts: np.ndarray) -> Tree:
    """Parents of two leaves with the same prediction become leaves, from the deepest level up; what nobody reaches goes."""
    said = total.argmax(axis=1)
    for a, b in zip(starts[-2::-1], starts[:0:-1], strict=True):
        inner = np.arange(a, b)[column[a:b] >= 0]
        one = child[inner]
        alike = (column[one] < 0) & (column[one + 1] < 0) & (said[one] == said[one + 1])
        column[inner[alike]] = -1
    reached = np.zeros(len(column), bool)
    reached[0] = True
    for a, b in zip(starts[:-1], starts[1:], strict=True):
        inner = np.arange(a, b)[(column[a:b] >= 0) & reached[a:b]]
        reached[child[inner]] = reached[child[inner] + 1] = True
    new = np.cumsum(reached) - 1
    child = np.where(column >= 0, new[child], 0).astype(np.int32)
    shares = total / total.sum(axis=1, keepdims=True)
    return Tree(column[reached], code[reached], child[reached], shares[reached])


# -- rows ----------------------------------------------------------------------------------
def _below(x: Column):
    return lambda n, border: n + (border < x).cast("int")


def coded(rows: DataFrame, categories: dict[str, dict[str, int]], numbers: dict[str, list[float]]) -> DataFrame:
    """``rows`` with the codes _x0, _x1, ...: -1 for unknown or missing values."""
    spark, columns = rows.sparkSession, rows.columns
    for i, (c, of) in enumerate(categories.items()):
        table = spark.createDataFrame(list(of.items()), f"_v{i} string, _x{i} int")
        rows = lookup_join(rows.withColumn(f"_v{i}", F.col(c).cast("string")), table, [f"_v{i}"], columns)
        rows = rows.withColumn(f"_x{i}", F.coalesce(f"_x{i}", F.lit(-1))).drop(f"_v{i}")
    for i, (c, of) in enumerate(numbers.items(), len(categories)):
        x = F.col(c).cast("double")
        rows = rows.withColumn(f"_x{i}", F.when(x.isNull(), -1).otherwise(F.aggregate(F.lit(of).cast("array<double>"), F.lit(0), _below(x))))
    return rows


def borders(rows: DataFrame, numbers: Sequence[str]) -> dict[str, list[float]]:
    """All values but the largest where there are few, quantiles elsewhere; a row is above a border or not."""
    if not numbers:
        return {}
    inner = F.array(*[F.lit((i + 1) / BINS) for i in range(BINS - 1)])
    x = [F.col(c).cast("double") for c in numbers]
    row = rows.agg(*[F.percentile_approx(v, inner, F.lit(10_000)).alias(f"_q{i}") for i, v in enumerate(x)], *[F.max(v).alias(f"_m{i}") for i, v in enumerate(x)]).first()
    out = {}
    for i, c in enumerate(numbers):
        few = [r[0] for r in rows.select(x[i].alias("v")).where("v IS NOT NULL").distinct().limit(BINS + 1).collect()]
        out[c] = sorted(v for v in set(few if len(few) <= BINS else row[f"_q{i}"] or []) if v < row[f"_m{i}"])
    return out


def _packed(batches: Iterator[pa.RecordBatch], names: Sequence[str]) -> Iterator[pa.RecordBatch]:
    """All cells of the task as one row, in an order of their own."""
    found = [np.stack([b.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in names], axis=1) for b in batches]
    cells = np.concatenate(found) if found else np.zeros((0, len(names)), np.int64)
    yield pa.record_batch([pa.array([np.ascontiguousarray(cells[np.lexsort(cells.T[::-1])]).tobytes()], pa.binary())], names=["cells"])


# -- fit and score ---------------------------------------------------------------------------
def cells(rows: DataFrame, label: Column, classes: int, categories: dict[str, dict[str, int]], numbers: dict[str, list[float]]) -> tuple[DataFrame, bool]:
    """The different rows with their class number and count, and whether they are few enough for ``fit``. Runs a job."""
    names = [f"_x{i}" for i in range(len(categories) + len(numbers))]
    found = coded(rows.withColumn("_label", label.cast("int")), categories, numbers).groupBy(*names, "_label").agg(F.count(F.lit(1)).alias("_n"))
    found = settled(found)
    n, combinations = found.count(), found.select(*names).distinct().count()
    return found, n <= MOST_CELLS and combinations * classes <= 16 * MOST_CELLS


def fit(found: DataFrame, weights: Sequence[float], categories: dict[str, dict[str, int]], numbers: dict[str, list[float]], trees: int, depth: int, seed: int = 42) -> ForestModel:
    """Learn from the ``cells`` that are few enough; ``weights``: what a row counts, by class. Each tree has a seed of its own."""
    spark, classes = found.sparkSession, len(weights)
    names = [*[f"_x{i}" for i in range(len(categories) + len(numbers))], "_label", "_n"]
    equal = [True] * len(categories) + [False] * len(numbers)
    sizes = [len(v) for v in categories.values()] + [len(b) + 1 for b in numbers.values()]
    packs = min(trees, PACKS)

    def grown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pack, given in zip(batch.column("pack").to_pylist(), batch.column("cells").to_pylist(), strict=True):
                rows = np.frombuffer(given, np.int64).reshape(-1, len(names))
                codes, at = np.unique(rows[:, :-2], axis=0, return_inverse=True)
                at, made = at.ravel(), []
                for tree in range(pack, trees, packs):
                    rng = np.random.default_rng([seed, tree])
                    w = np.zeros((len(codes), classes))
                    w[at, rows[:, -2]] = rng.poisson(rows[:, -1]) * np.array(weights)[rows[:, -2]]
                    made.append(grow(codes, w, sizes, equal, depth, rng))
                yield pa.record_batch([pa.array([pack], pa.int64()), pa.array([pickle.dumps(made)], pa.binary())], names=["pack", "trees"])

    one = found.select(*[F.col(c).cast("long").alias(c) for c in names]).coalesce(1).mapInArrow(lambda b: _packed(b, names), "cells binary")
    each = spark.range(0, packs, 1, packs).withColumnRenamed("id", "pack").crossJoin(F.broadcast(one))
    return ForestModel(classes, categories, numbers, settled(each.mapInArrow(grown, "pack long, trees binary")))


def with_margins(model: ForestModel, rows: DataFrame, out: str = "_margins") -> DataFrame:
    """``rows`` with the votes per class, summed over the trees' shares. Equal rows are scored once."""
    columns, width, equal = rows.columns, len(model.categories) + len(model.numbers), model.equal
    names = [f"_x{i}" for i in range(width)]
    rows = coded(rows, model.categories, model.numbers)
    key = F.concat_ws(",", *names)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(a, BLOCK_ROWS)
                made = np.stack([part.column(c).to_numpy(zero_copy_only=False) for c in names], axis=1).astype("<i4")
                yield pa.record_batch([pa.array([made.tobytes()], pa.binary())], names=["codes"])

    def voted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for given, trees in zip(batch.column("codes").to_pylist(), batch.column("trees").to_pylist(), strict=True):
                codes = np.frombuffer(given, "<i4").reshape(-1, width)
                votes = sum(t.votes(codes, equal) for t in pickle.loads(trees))
                yield pa.record_batch([pa.array([",".join(map(str, c)) for c in codes.tolist()]), pa.array(votes.tolist(), pa.list_(pa.float64()))], names=["_key", "votes"])

    table = settled(rows.select(*names).distinct().mapInArrow(blocks, "codes binary"))
    table = F.broadcast(table) if table.count() <= MOST_BLOCKS else table
    votes = model.trees.repartition(PACKS, "pack").crossJoin(table).mapInArrow(voted, "_key string, votes array<double>")
    # rounded, so that the order of the sums decides no tie
    sums = settled(votes.groupBy("_key").agg(F.array(*[F.round(F.sum(F.col("votes")[k]), 9) for k in range(model.classes)]).alias(out)))
    return lookup_join(rows.withColumn("_key", key), sums, ["_key"], columns).select(*columns, out)
