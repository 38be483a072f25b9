"""Forecast and classification quality, per any slice, from aggregates only.

Classification works on confusion counts: one shuffle of the (slice, real, predicted) counts,
then arithmetic on a handful of rows. ``weight`` lets already counted rows be passed in.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketry.functions import columns as C


def regression(df: DataFrame, real: str, predicted: str, by: Sequence[str] = (), digits: int = 3) -> DataFrame:
    """MAE, RMSE, sMAPE in percent, R2 and n per slice. R2 is NaN for fewer than two rows."""
    y, p = F.col(real).cast("double"), F.col(predicted).cast("double")
    err = y - p
    size = F.abs(y) + F.abs(p)
    smape = F.when(size == 0, F.lit(0.0)).otherwise(F.lit(2.0) * F.abs(err) / F.nullif(size, F.lit(0.0)))
    out = df.groupBy(*by).agg(
        F.avg(F.abs(err)).alias("_mae"), F.sqrt(F.avg(err * err)).alias("_rmse"), (F.avg(smape) * 100).alias("_smape"),
        F.sum(err * err).alias("_sse"), (F.var_pop(y) * F.count(y)).alias("_sst"), F.count(F.lit(1)).alias("n"))
    r2 = (
        F.when(F.col("n") <= 1, F.lit(float("nan")))
        .when(F.col("_sst") == 0, F.when(F.col("_sse") == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
        .otherwise(F.lit(1.0) - F.col("_sse") / F.nullif(F.col("_sst"), F.lit(0.0)))
    )
    return out.select(
        *by, F.round("_mae", digits).alias("mae"), F.round("_rmse", digits).alias("rmse"),
        F.round("_smape", digits).alias("smape_pct"), F.round(r2, digits).alias("r2"), "n")


def confusion(df: DataFrame, real: str, predicted: str, by: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    n = F.sum(weight) if weight else F.count(F.lit(1))
    return df.groupBy(*by, F.col(real).alias("real"), F.col(predicted).alias("previsto")).agg(n.cast("long").alias("n"))


def per_class(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1 and support of every class seen on either side."""
    hit = F.when(F.col("real") == F.col("previsto"), F.col("n")).otherwise(0)
    sides = counts.select(*by, F.inline(F.array(
        F.struct(F.col("real").alias("classe"), F.col("n").alias("real_n"), F.lit(0).cast("long").alias("prev_n"), hit.cast("long").alias("hit_n")),
        F.struct(F.col("previsto").alias("classe"), F.lit(0).cast("long").alias("real_n"), F.col("n").alias("prev_n"), F.lit(0).cast("long").alias("hit_n")),
    )))
    sums = sides.groupBy(*by, "classe").agg(F.sum("real_n").alias("suporte"), F.sum("prev_n").alias("previstos"), F.sum("hit_n").alias("acertos"))
    zero = F.lit(0.0)
    return sums.select(
        *by, "classe", "suporte", "previstos", "acertos",
        F.coalesce(C.ratio(F.col("acertos"), F.col("previstos")), zero).alias("precision"),
        F.coalesce(C.ratio(F.col("acertos"), F.col("suporte")), zero).alias("recall"),
        F.coalesce(C.ratio(F.lit(2) * F.col("acertos"), F.col("suporte") + F.col("previstos")), zero).alias("f1"))


def classification(
    df: DataFrame, real: str, predicted: str, by: Sequence[str] = (), labels: Sequence[str] | None = None,
    weight: str | None = None, digits: int = 3,
) -> DataFrame:
    """Accuracy, balanced accuracy, macro and weighted F1 and n per slice.

    With ``labels`` the F1 means are over exactly those classes, absent ones counting as 0;
    otherwise over the classes seen. Balanced accuracy averages the classes present in ``real``.
    """
    classes = per_class(confusion(df, real, predicted, by, weight), by)
    scored = F.col("classe").isin(*labels) if labels else F.lit(True)
    f1 = F.when(scored, F.col("f1"))
    macro = F.coalesce(F.sum(f1), F.lit(0.0)) / F.lit(float(len(labels))) if labels else F.avg(f1)
    support = F.when(scored, F.col("suporte"))
    return classes.groupBy(*by).agg(
        F.round(C.ratio(F.sum("acertos"), F.sum("suporte")), digits).alias("accuracy"),
        F.round(F.avg(F.when(F.col("suporte") > 0, F.col("recall"))), digits).alias("balanced_accuracy"),
        F.round(macro, digits).alias("f1_macro"),
        F.round(C.ratio(F.sum(f1 * support), F.sum(support)), digits).alias("f1_weighted"),
        F.sum("suporte").alias("n"))


def class_recall(df: DataFrame, real: str, predicted: str, labels: Sequence[str], by: Sequence[str] = (),
                 weight: str | None = None, digits: int = 3) -> DataFrame:
    """Recall of the listed classes as columns ``recall_1 ..``; an absent class has 0."""
    classes = per_class(confusion(df, real, predicted, by, weight), by)
    return classes.groupBy(*by).agg(*[
        F.round(F.coalesce(F.max(F.when(F.col("classe") == label, F.col("recall"))), F.lit(0.0)), digits).alias(f"recall_{i + 1}")
        for i, label in enumerate(labels)])


SLICE = "recorte"


def with_slices(df: DataFrame, seen: str, weight: str = "n") -> DataFrame:
    """Each counted row once under COMPLETE and once under SEEN or NEW. Pass counts, not tickets."""
    which = F.array(F.lit("COMPLETE"), F.when(F.col(seen), F.lit("SEEN")).otherwise(F.lit("NEW")))
    return df.withColumn(SLICE, F.explode(which))


def sliced_classification(df: DataFrame, real: str, predicted: str, seen: str, by: Sequence[str] = (),
                          labels: Sequence[str] | None = None, weight: str | None = None, digits: int = 3) -> DataFrame:
    counts = df.groupBy(*by, seen, real, predicted).agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("n"))
    return classification(with_slices(counts, seen), real, predicted, [*by, SLICE], labels, "n", digits)


def confusion_matrix(df: DataFrame, real: str, predicted: str, labels: Sequence[str], names: Sequence[str],
                     normalised: bool = False) -> DataFrame:
    """Real classes as rows, the listed predictions as columns; optionally as row shares."""
    counts = confusion(df, real, predicted).where(F.col("real").isin(*labels) & F.col("previsto").isin(*labels))
    wide = counts.groupBy("real").agg(*[
        F.coalesce(F.sum(F.when(F.col("previsto") == v, F.col("n"))), F.lit(0)).alias(n) for v, n in zip(labels, names)])
    if not normalised:
        return wide
    whole = sum((F.col(n) for n in names), F.lit(0))
    return wide.select("real", *[C.ratio(F.col(n), whole).alias(n) for n in names])


def top_class_confusion(df: DataFrame, real: str, predicted: str, top: int = 15) -> DataFrame:
    """Row-normalised confusion in long form among the ``top`` most frequent real classes."""
    counts = confusion(df, real, predicted)
    biggest = counts.groupBy("real").agg(F.sum("n").alias("_n")).orderBy(F.desc("_n"), F.asc("real")).limit(top).select("real")
    kept = counts.join(F.broadcast(biggest), "real", "left_semi").join(
        F.broadcast(biggest.select(F.col("real").alias("previsto"))), "previsto", "left_semi")
    whole = Window.partitionBy("real")
    return kept.select("real", "previsto", "n", C.ratio(F.col("n"), F.sum("n").over(whole)).alias("fracao"))


def transitions(df: DataFrame, real: str, predicted: str, top: int | None = None) -> DataFrame:
    """Wrong (real, predicted) pairs by falling count."""
    wrong = confusion(df, real, predicted).where(F.col("real") != F.col("previsto"))
    if top is None:
        return wrong
    return wrong.orderBy(F.desc("n"), F.asc("real"), F.asc("previsto")).limit(top)


def class_mix(df: DataFrame, real: str, predicted: str) -> DataFrame:
    """Share in percent of every class among the real and among the predicted labels."""
    classes = per_class(confusion(df, real, predicted))
    whole = classes.agg(F.sum("suporte").alias("_real"), F.sum("previstos").alias("_previsto"))
    pct = F.lit(100.0)
    return classes.crossJoin(F.broadcast(whole)).select(
        "classe", (pct * C.ratio(F.col("suporte"), F.col("_real"))).alias("pct_real"),
        (pct * C.ratio(F.col("previstos"), F.col("_previsto"))).alias("pct_previsto"))


def error_rate_by(df: DataFrame, group: str, real: str, predicted: str, min_rows: int = 30, top: int | None = 10) -> DataFrame:
    """Error rate per group with at least ``min_rows`` rows, worst first."""
    wrong = (F.col(real) != F.col(predicted)).cast("int")
    out = df.groupBy(group).agg(F.avg(wrong).alias("taxa_erro"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_rows)
    return out if top is None else out.orderBy(F.desc("taxa_erro"), F.asc(group)).limit(top)


def accuracy_by(df: DataFrame, group: str, real: str, predicted: str) -> DataFrame:
    return df.groupBy(group).agg(F.avg((F.col(real) == F.col(predicted)).cast("int")).alias("accuracy"), F.count(F.lit(1)).alias("n"))


def error_share_by(df: DataFrame, group: str, real: str, predicted: str) -> DataFrame:
    """Each group's share of the errors next to its share of all rows, in percent."""
    wrong = F.col(real) != F.col(predicted)
    counts = df.groupBy(group).agg(F.count_if(wrong).alias("erros"), F.count(F.lit(1)).alias("n"))
    whole = counts.agg(F.sum("erros").alias("_erros"), F.sum("n").alias("_n"))
    pct = F.lit(100.0)
    return counts.crossJoin(F.broadcast(whole)).select(
        group, "erros", "n", (pct * C.ratio(F.col("erros"), F.col("_erros"))).alias("pct_erros"),
        (pct * C.ratio(F.col("n"), F.col("_n"))).alias("pct_base"))


def peak_and_valley(df: DataFrame, real: str, predicted: str) -> DataFrame:
    """MAE on the days at or above the median of the real values, and below it."""
    y, p = F.col(real).cast("double"), F.col(predicted).cast("double")
    middle = df.agg(F.percentile(y, F.lit(0.5)).alias("mediana"))
    high = y >= F.col("mediana")
    err = F.abs(y - p)
    return df.crossJoin(F.broadcast(middle)).agg(
        F.max("mediana").alias("mediana"), F.avg(F.when(high, err)).alias("mae_pico"), F.avg(F.when(~high, err)).alias("mae_vale"),
        F.count_if(high).alias("n_pico"), F.count_if(~high).alias("n_vale"))


def top_k_hit(labels: Column, real: Column, k: int = 3) -> Column:
    """Whether ``real`` is among the first ``k`` of a ranked label list."""
    return F.coalesce(F.array_contains(F.slice(labels, 1, k), real), F.lit(False))


def experiment_pivot(results: DataFrame, name: str = "experimento", score: str = "f1_macro") -> DataFrame:
    """One row per experiment with its score on COMPLETE, SEEN, NEW and the SEEN - NEW gap."""
    parts = ["COMPLETE", "SEEN", "NEW"]
    wide = results.groupBy(name).pivot(SLICE, parts).agg(F.first(score))
    return wide.withColumn("gap_seen_menos_new", F.col("SEEN") - F.col("NEW"))
