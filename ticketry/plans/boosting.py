"""Softmax boosting of symmetric trees over categories and binned numbers.

Each round grows one tree for all classes: a leaf holds one value per class. All nodes of a level share their test, the one
with the best gain summed over the nodes. A level costs one aggregate over the rows: sums of gradients and curvatures by
node, column and value, added up per task and then in a tree. Equal rows are one row with a count, so a popular combination
weighs no more than a rare one in work.

Rows stay in blocks with the executors. A task keeps the margins of the blocks it has seen and brings them up to date with
the trees that came since; a lost worker starts again from the first tree, with the same result. Rows that fit one block
(``BLOCK_ROWS`` different ones at most) are one task anyway: all rounds run inside that task, by the same code.
"""

from __future__ import annotations

import json
import uuid
from collections import OrderedDict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketry.session import settled

MOST_HISTOGRAM_BYTES = 256 << 20
MARGIN_BYTES = 256 << 20
BLOCK_ROWS = 1 << 16


@dataclass(frozen=True)
class Test:
    """Whether a row goes right: its code equals ``code`` (categories) or is above it (numbers)."""

    column: int
    code: int
    equal: bool

    def of(self, codes: np.ndarray) -> np.ndarray:
        mine = codes[:, self.column]
        return mine == self.code if self.equal else mine > self.code


@dataclass(frozen=True)
class Tree:
    """Tests from the root down; leaf i has the bit of test t set where rows go right at it; values [leaves, classes]."""

    tests: tuple[Test, ...]
    values: np.ndarray

    def leaves(self, codes: np.ndarray) -> np.ndarray:
        at = np.zeros(len(codes), np.int64)
        for i, test in enumerate(self.tests):
            at |= test.of(codes).astype(np.int64) << i
        return at


@dataclass(frozen=True)
class Boosting:
    """Settings; ``l2`` is added to the curvature of a leaf, ``borders`` bounds the bins of a number."""

    rounds: int = 300
    depth: int = 6
    step: float = 0.1
    l2: float = 3.0
    borders: int = 254


@dataclass
class BoostedModel:
    """Columns with their category codes or borders, trees, and the loss per row after each round."""

    classes: int
    categories: dict[str, dict[str, int]]
    numbers: dict[str, list[float]]
    trees: list[Tree] = field(default_factory=list)
    losses: list[float] = field(default_factory=list)

    def margins(self, codes: np.ndarray) -> np.ndarray:
        out = np.zeros((len(codes), self.classes))
        for tree in self.trees:
            out += tree.values[tree.leaves(codes)]
        return out

    def codes(self, columns: Sequence[pd.Series]) -> np.ndarray:
        """[rows, columns] codes; unknown categories and missing numbers are -1."""
        out, n = [], len(self.categories)
        for values, of in zip(columns[:n], self.categories.values(), strict=True):
            out.append(values.map(lambda v, of=of: of.get(v, -1) if v is not None else -1))
        for values, of in zip(columns[n:], self.numbers.values(), strict=True):
            x = values.to_numpy(float)
            out.append(np.where(np.isnan(x), -1, np.searchsorted(np.array(of), x, "left")))
        return np.stack([np.asarray(c, np.int32) for c in out], axis=1) if out else np.zeros((len(columns[0]) if columns else 0, 0), np.int32)

    def write_to(self, spark: SparkSession, folder: str) -> None:
        trees = [{"tests": [[t.column, t.code, t.equal] for t in tree.tests], "values": tree.values.tolist()} for tree in self.trees]
        kept = {"classes": self.classes, "categories": self.categories, "numbers": self.numbers, "trees": trees, "losses": self.losses}
        spark.createDataFrame([(json.dumps(kept, ensure_ascii=False),)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/metadata")

    @staticmethod
    def read_from(spark: SparkSession, folder: str) -> BoostedModel:
        kept = json.loads(spark.read.option("wholetext", True).text(f"{folder}/metadata").first()[0])
        trees = [Tree(tuple(Test(c, v, bool(e)) for c, v, e in t["tests"]), np.array(t["values"])) for t in kept["trees"]]
        return BoostedModel(kept["classes"], kept["categories"], kept["numbers"], trees, kept["losses"])


# -- one block -----------------------------------------------------------------------------
def softmax(margins: np.ndarray) -> np.ndarray:
    e = np.exp(margins - margins.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


_MARGINS: OrderedDict[str, tuple[int, np.ndarray]] = OrderedDict()


def margins_so_far(key: str, codes: np.ndarray, trees: Sequence[Tree], classes: int) -> np.ndarray:
    """The block's margins after ``trees``, from what this worker kept of it."""
    done, margins = _MARGINS.pop(key, (0, None))
    if margins is None or done > len(trees):
        done, margins = 0, np.zeros((len(codes), classes))
    for tree in trees[done:]:
        margins = margins + tree.values[tree.leaves(codes)]
    _MARGINS[key] = (len(trees), margins)
    while len(_MARGINS) > 1 and sum(m.nbytes for _, m in _MARGINS.values()) > MARGIN_BYTES:
        _MARGINS.popitem(last=False)
    return margins


def histogram(codes: np.ndarray, label: np.ndarray, weight: np.ndarray, margins: np.ndarray, nodes: np.ndarray, n_nodes: int, sizes: Sequence[int]) -> list[np.ndarray]:
    """Weighted loss, then per column [nodes, codes + 1, 2 * classes]: sums of gradients and curvatures; code -1 comes last."""
    p = softmax(margins)
    rows = np.arange(len(label))
    loss = -(weight * np.log(np.maximum(p[rows, label], 1e-300))).sum()
    curvature = weight[:, None] * p * (1.0 - p)
    gradient = weight[:, None] * p
    gradient[rows, label] -= weight
    both = np.concatenate([gradient, curvature], axis=1)
    out = [np.array([loss, weight.sum()])]
    for c, size in enumerate(sizes):
        at = nodes * (size + 1) + np.where(codes[:, c] < 0, size, codes[:, c])
        out.append(np.stack([np.bincount(at, x, n_nodes * (size + 1)) for x in both.T], axis=1).reshape(n_nodes, size + 1, -1))
    return out


def best_test(column: int, hist: np.ndarray, equal: bool, l2: float) -> tuple[float, Test, np.ndarray] | None:
    """Gain over all nodes of a column's best test (the smallest code on ties), the test, and the sums left and right of it, [2, nodes, 2 * classes]."""
    k = hist.shape[2] // 2

    def worth(s: np.ndarray) -> np.ndarray:
        return (s[..., :k] ** 2 / (s[..., k:] + l2)).sum(axis=-1)

    total = hist.sum(axis=1, keepdims=True)
    # right: the rows of one code, or those above it; a missing number is never above
    right = hist[:, :-1] if equal else total - hist[:, -1:] - np.cumsum(hist[:, :-1], axis=1)
    gains = (worth(right) + worth(total - right) - worth(total)).sum(axis=0)
    if not len(gains) or gains.max() <= 1e-12:
        return None
    code = int(np.argmax(gains))
    return float(gains[code]), Test(column, code, equal), np.stack([total[:, 0] - right[:, code], right[:, code]])


# -- fit -----------------------------------------------------------------------------------
def _count_below(x: Column):
    return lambda n, border: n + (border < x).cast("int")


def _blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a in range(0, batch.num_rows, BLOCK_ROWS):
            part = batch.slice(a, BLOCK_ROWS)
            codes = np.stack([part.column(f"_x{i}").to_numpy() for i in range(width)], axis=1).astype("<i4")
            yield pa.record_batch([pa.array([codes.tobytes()]), pa.array([part.column("label").to_numpy().astype("<i4").tobytes()]), pa.array([part.column("weight").to_numpy().astype("<f8").tobytes()])],
                                  names=["codes", "label", "weight"])


def fit(rows: DataFrame, label: Column, weight: Column, classes: int, categories: dict[str, list[str]], numbers: Sequence[str], how: Boosting) -> BoostedModel:
    """Learn from ``rows``: ``label`` is the class number, ``weight`` what a row counts. Category values are given (they have been
    checked to be few); borders of numbers are their quantiles."""
    spark = rows.sparkSession
    inner = F.array(*[F.lit((i + 1) / (how.borders + 1)) for i in range(how.borders)])
    found = rows.agg(*[F.percentile_approx(F.col(c).cast("double"), inner, F.lit(10_000)).alias(f"_q{i}") for i, c in enumerate(numbers)]).first() if numbers else []
    borders = {c: sorted(set(q or [])) for c, q in zip(numbers, found, strict=True)}
    model = BoostedModel(classes, {c: {v: i for i, v in enumerate(values)} for c, values in categories.items()}, borders)
    sizes = [len(v) for v in categories.values()] + [len(b) + 1 for b in borders.values()]
    equal = [True] * len(categories) + [False] * len(borders)
    if sum(s + 1 for s in sizes) * 2 ** (how.depth - 1) * 2 * classes * 8 > MOST_HISTOGRAM_BYTES:
        raise ValueError(f"too many values for histograms of {classes} classes: bucket the rare ones first ({sizes})")
    coded = []
    for c, of in model.categories.items():
        table = spark.createDataFrame([(v, i) for v, i in of.items()], "_v string, _code int")
        rows = rows.join(F.broadcast(table.withColumnRenamed("_code", f"_code_{len(coded)}").withColumnRenamed("_v", f"_v_{len(coded)}")),
                         F.col(c).cast("string") == F.col(f"_v_{len(coded)}"), "left")
        coded.append(F.coalesce(f"_code_{len(coded)}", F.lit(-1)))
    for c, of in borders.items():
        x = F.col(c).cast("double")
        above = F.aggregate(F.lit(of).cast("array<double>"), F.lit(0), _count_below(x))
        coded.append(F.when(x.isNull(), -1).otherwise(above))
    keys = [f"_x{i}" for i in range(len(coded))]
    frame = rows.select(*[c.cast("int").alias(k) for c, k in zip(coded, keys, strict=True)], label.cast("int").alias("label"), weight.cast("double").alias("weight"))
    frame = settled(frame.groupBy(*keys, "label").agg(F.sum("weight").alias("weight")))
    width = len(keys)
    if not width:
        raise ValueError("no columns to learn from")
    few = max(1, -(-frame.count() // BLOCK_ROWS))  # no more tasks than there are blocks
    raw = frame.coalesce(few).mapInArrow(lambda batches: _blocks(batches, width), "codes binary, label binary, weight binary").rdd
    blocks = raw.zipWithIndex().map(lambda x: (f"{x[1]}", np.frombuffer(x[0]["codes"], "<i4").reshape(-1, width), np.frombuffer(x[0]["label"], "<i4"),
                                               np.frombuffer(x[0]["weight"], "<f8"))).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if few == 1:
            grown = blocks.mapPartitions(lambda part: [_grow(list(part), classes, sizes, equal, how)]).collect()
            model.trees, model.losses = grown[0]
        else:
            model.trees, model.losses = _grow(_Spread(blocks), classes, sizes, equal, how)
    finally:
        blocks.unpersist()
    return model


class _Spread:
    """Blocks in several tasks; ``best`` makes a level's job of them."""

    def __init__(self, blocks) -> None:
        self.blocks, self.run = blocks, f"{blocks.id()}-"

    def best(self, tests: tuple[Test, ...], trees: Sequence[Tree], classes: int, sizes: Sequence[int], equal: Sequence[bool], l2: float):
        shared, run = self.blocks.context.broadcast(trees), self.run
        parts = self.blocks.mapPartitions(lambda found: enumerate(_sums(found, run, tests, shared.value, classes, sizes) or [], -1))
        # the sums of a column meet in one task, which hands on that column's best test
        met = parts.reduceByKey(lambda a, b: a + b, min(self.blocks.getNumPartitions(), len(sizes) + 1))
        found = met.map(lambda x: (x[0], x[1] if x[0] < 0 else best_test(x[0], x[1], equal[x[0]], l2))).collect()
        shared.destroy()
        return dict(found)


def _sums(found, run: str, tests: tuple[Test, ...], trees: Sequence[Tree], classes: int, sizes: Sequence[int]) -> list[np.ndarray] | None:
    total = None
    for key, codes, label, weight in found:
        margins = margins_so_far(run + key, codes, trees, classes)
        nodes = Tree(tests, np.zeros(0)).leaves(codes)
        made = histogram(codes, label, weight, margins, nodes, 1 << len(tests), sizes)
        total = made if total is None else [a + b for a, b in zip(total, made, strict=True)]
    return total


def _grow(blocks, classes: int, sizes: Sequence[int], equal: Sequence[bool], how: Boosting) -> tuple[list[Tree], list[float]]:
    """(trees, losses) from the blocks of a task or from those that are spread over several."""
    trees, losses, run = [], [], f"{uuid.uuid4().hex}-"

    def level(tests: tuple[Test, ...]) -> tuple[np.ndarray | None, tuple | None]:
        """Loss and weight of all rows, and the best test of all columns (the first one on ties)."""
        if isinstance(blocks, _Spread):
            found = blocks.best(tests, trees, classes, sizes, equal, how.l2)
        else:
            sums = _sums(blocks, run, tests, trees, classes, sizes) or []
            found = {c: x if c < 0 else best_test(c, x, equal[c], how.l2) for c, x in enumerate(sums, -1)}
        best = [found[c] for c in sorted(found) if c >= 0 and found[c]]
        return found.get(-1), max(best, key=lambda x: x[0], default=None)

    for _ in range(how.rounds):
        tests, sides = (), None
        for depth in range(how.depth):
            loss, best = level(tests)
            if depth == 0 and loss is not None:
                losses.append(float(loss[0] / loss[1]))
            if best is None:
                break
            tests, sides = (*tests, best[1]), best[2]
        if sides is None:
            break
        # [2, nodes, ...]: the last test's bit is the highest one of a leaf's number
        leaf = sides.reshape(-1, 2 * classes)
        trees.append(Tree(tests, -how.step * leaf[:, :classes] / (leaf[:, classes:] + how.l2)))
    return trees, losses


def with_margins(model: BoostedModel, rows: DataFrame, out: str = "_margins") -> DataFrame:
    """``rows`` with one score per class; only the model's own columns go to the Python workers, in batches."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("array<double>")
    def score(*columns: pd.Series) -> pd.Series:
        made = shared.value.margins(shared.value.codes(columns))
        return pd.Series(list(made))

    given = [F.col(c).cast("string") for c in model.categories] + [F.col(c).cast("double") for c in model.numbers]
    return rows.withColumn(out, score(*given))
