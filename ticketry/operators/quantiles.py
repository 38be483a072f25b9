"""Exact linear-interpolated quantiles that never gather a group's values in one task.

The built-in exact ``percentile`` keeps a value -> count map per group in one buffer. Here the
values are counted first (hash-partitioned by group and value). Every value has two digits that follow
its order: a coarse one, about one percent wide, and a fine one inside it. A histogram of the coarse
digit finds the bin of each wanted rank in each group, a histogram of the fine digit finds the small
bin inside that, and only the few values of the small bin are ordered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Coarse digits per doubling of a value, and fine digits per coarse one.
COARSE, FINE = 64, 1 << 16


def _digits(v: Column) -> tuple[Column, Column]:
    """Two digits that order values as they are ordered; NaN comes last, as in a sort."""
    v = v.cast("double")
    place = F.when(F.isnan(v), F.lit(1e9)).otherwise(F.signum(v) * F.log2(F.lit(1.0) + F.abs(v)) * COARSE)
    coarse = F.floor(place)
    return coarse, F.floor((place - coarse) * FINE)


def exact_quantiles(
    df: DataFrame, value: str, probs: dict[str, float], by: Sequence[str] = (), weight: str | None = None,
) -> DataFrame:
    """One row per group with one column per entry of ``probs``.

    No task orders more than the values of one group that agree in both digits, which differ by about
    one in six million. A group of narrow range is split by the fine digit. A hot group is a hot key of
    the two joins with the bins, of which there are two per group and quantile; adaptive execution splits it.
    """
    by = list(by)
    ordered = _ranked_values(df, value, probs, by, weight)
    picked = ordered.where((F.col("_hi") - F.col("_n") <= F.col("_rank")) & (F.col("_rank") < F.col("_hi")))
    return picked.groupBy(*by).agg(*[_interpolated(name).alias(name) for name in probs])


def _ranked_values(df: DataFrame, value: str, probs: dict[str, float], by: list[str], weight: str | None = None) -> DataFrame:
    """The values beside each wanted rank with the number of rows up to them (_hi)."""
    n = F.sum(weight) if weight else F.count(F.lit(1))
    counts = (
        df.where(F.col(value).isNotNull())
        .groupBy(*by, F.col(value).alias("_v")).agg(n.cast("long").alias("_n"))
        .where("_n > 0")  # reads both columns, so that all readers share one exchange
    )
    coarse, fine = _digits(F.col("_v"))
    counts = counts.withColumns({"_coarse": coarse, "_fine": fine})
    group = Window.partitionBy(*by)
    bins = (
        counts.groupBy(*by, "_coarse").agg(F.sum("_n").alias("_bn"))
        .withColumn("_upto", F.sum("_bn").over(group.orderBy("_coarse").rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .withColumn("_total", F.sum("_bn").over(group))
        .withColumn("_before", F.col("_upto") - F.col("_bn"))
    )
    wanted = F.array(*[
        F.struct(F.lit(name).alias("name"), F.lit(low).alias("low"),
                 (F.lit(float(p)) * (F.col("_total") - 1)).alias("pos"))
        for name, p in probs.items() for low in (True, False)
    ])
    ranks = (
        bins.withColumn("_w", F.explode(wanted))
        .withColumn("_rank", F.when(F.col("_w.low"), F.floor("_w.pos")).otherwise(F.ceil("_w.pos")))
        .where((F.col("_before") <= F.col("_rank")) & (F.col("_rank") < F.col("_upto")))
        .select(*by, "_coarse", "_before", "_rank", F.col("_w.name").alias("_name"), F.col("_w.low").alias("_low"),
                (F.col("_w.pos") - F.floor("_w.pos")).alias("_frac"))
    )
    near = _within(counts, ranks, [*by, "_coarse"], by)

    rank = Window.partitionBy(*by, "_name", "_low")
    parts = (
        near.groupBy(*by, "_name", "_low", "_fine").agg(F.sum("_n").alias("_bn"), F.min("_before").alias("_before"), F.min("_rank").alias("_rank"))
        .withColumn("_upto", F.col("_before") + F.sum("_bn").over(rank.orderBy("_fine").rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .where((F.col("_upto") - F.col("_bn") <= F.col("_rank")) & (F.col("_rank") < F.col("_upto")))
        .select(*by, "_name", "_low", "_fine", (F.col("_upto") - F.col("_bn")).alias("_start"))
    )
    nearest = _within(near, parts, [*by, "_name", "_low", "_fine"], by)
    inside = rank.orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return nearest.withColumn("_hi", F.col("_start") + F.sum("_n").over(inside))


def _within(rows: DataFrame, bins: DataFrame, keys: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Rows that fall into a wanted bin, with the bin's other columns; a NULL group is a group."""
    if not by:
        bins = F.broadcast(bins)  # two rows per quantile
    renamed = bins.select(*[F.col(c).alias(f"_b{i}") for i, c in enumerate(keys)], *[c for c in bins.columns if c not in keys])
    same = F.lit(True)
    for i, c in enumerate(keys):
        same = same & (F.col(c).eqNullSafe(F.col(f"_b{i}")) if c in by else F.col(c) == F.col(f"_b{i}"))
    return rows.join(renamed, same).drop(*[f"_b{i}" for i in range(len(keys))])


def _interpolated(name: str) -> Column:
    mine = F.col("_name") == name
    low = F.max(F.when(mine & F.col("_low"), F.col("_v"))).cast("double")
    high = F.max(F.when(mine & ~F.col("_low"), F.col("_v"))).cast("double")
    frac = F.max(F.when(mine, F.col("_frac")))
    return low + (high - low) * frac


def approx_quantiles(df: DataFrame, value: str, probs: dict[str, float], by: Sequence[str] = (), accuracy: int = 10000) -> DataFrame:
    """Sketch-based variant: one pass, rank error at most 1 / accuracy."""
    return df.groupBy(*by).agg(*[
        F.percentile_approx(value, F.lit(p), F.lit(accuracy)).cast("double").alias(name) for name, p in probs.items()
    ])
