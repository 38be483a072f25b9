"""Least squares for many penalties and feature sets at once, from one aggregate of centred products.

The rows are read once for the sums of all pairs of columns, per target and split strategy, and once more to judge all
solutions. What comes to the driver has the size of the feature set squared, whatever the number of rows or penalties.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_COLUMNS = 512


@dataclass(frozen=True)
class Sample:
    """Rows that a fit learns from: those under ``rows`` whose target is known."""

    name: str
    target: str
    rows: Column


@dataclass
class Moments:
    """Mean of each column and centred products of each pair, per sample; the target is the last column."""

    columns: list[str]
    n: dict[str, int]
    mean: dict[str, np.ndarray]
    products: dict[str, np.ndarray]

    def solve(self, sample: str, features: Sequence[str], alpha: float) -> tuple[np.ndarray, float]:
        """(coefficients, constant) of the least sum of squares plus ``alpha`` times the coefficients' squares."""
        at = [self.columns.index(f) for f in features]
        if sample not in self.n:
            raise ValueError(f"no rows to learn from in {sample}")
        a = self.products[sample][np.ix_(at, at)] + alpha * np.eye(len(at))
        b = self.products[sample][at, -1]
        w = np.linalg.solve(a, b) if alpha > 0 else np.linalg.lstsq(a, b, rcond=1e-12)[0]
        return w, float(self.mean[sample][-1] - self.mean[sample][at] @ w)


def moments(rows: DataFrame, columns: Sequence[str], samples: Sequence[Sample]) -> Moments:
    """One aggregate over ``rows``: each task adds up its own pairs, so only sums are shuffled. Columns have no NULL."""
    columns = list(columns)
    if len(columns) > MOST_COLUMNS:
        raise ValueError(f"{len(columns)} columns: pairs of more than {MOST_COLUMNS} are too many")
    x = [F.col(c).cast("double") for c in columns]
    each = F.array(*[F.struct(F.lit(s.name).alias("sample"), (s.rows & F.col(s.target).isNotNull()).alias("use"), F.array(*x, F.col(s.target).cast("double")).alias("x")) for s in samples])
    last = len(columns)
    pairs = (rows.select(F.inline(each)).where("use").withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(last))))
             .withColumn("j", F.explode(F.sequence(F.col("i"), F.lit(last)))).select("sample", "i", "j", F.get("x", F.col("i")).alias("a"), F.get("x", F.col("j")).alias("b")))
    found = pairs.groupBy("sample", "i", "j").agg(F.count(F.lit(1)).alias("n"), F.avg("a").alias("mean"), (F.covar_pop("a", "b") * F.count(F.lit(1))).alias("s")).collect()
    out = Moments(columns, {}, {}, {})
    for r in found:
        if r["sample"] not in out.n:
            out.n[r["sample"]], out.mean[r["sample"]], out.products[r["sample"]] = r["n"], np.zeros(last + 1), np.zeros((last + 1, last + 1))
        out.products[r["sample"]][r["i"], r["j"]] = out.products[r["sample"]][r["j"], r["i"]] = r["s"]
        if r["i"] == r["j"]:
            out.mean[r["sample"]][r["i"]] = r["mean"]
    return out


def predicted(features: Sequence[str], w: np.ndarray, constant: float) -> Column:
    total = F.lit(constant)
    for f, v in zip(features, w.tolist(), strict=True):
        total = total + F.lit(v) * F.col(f).cast("double")
    return total
