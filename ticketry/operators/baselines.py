"""Lookup baselines: majority class, mode per value, dictionary of texts, top-3 lists.

For quality figures the scored rows are counted per (key, label) first, so a popular key is
one row when it meets the learned table. Row-level predictions use the skew-aware lookup.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketry.functions import columns as C
from ticketry.operators.lookups import lookup_join
from ticketry.operators.novelty import known_keys
from ticketry.operators.stats import mode_by, top_labels_by


def predict_mode(train: DataFrame, rows: DataFrame, key: str | None, label: str, row_id: str, out: str = "previsto") -> DataFrame:
    """Most frequent training label of the row's key, else the overall most frequent one."""
    overall = F.broadcast(mode_by(train, None, label, out="_overall"))
    if key is None:
        return rows.crossJoin(overall).withColumnRenamed("_overall", out)
    learned = mode_by(train, key, label, out="_mode")
    joined = lookup_join(rows, learned, [key], [row_id]).crossJoin(overall)
    return joined.withColumn(out, F.coalesce("_mode", "_overall")).drop("_mode", "_overall")


def mode_counts(train: DataFrame, rows: DataFrame, key: str | None, label: str, by: Sequence[str]) -> DataFrame:
    """(by, label, previsto, n): the mode prediction on counted rows, for the metrics."""
    overall = F.broadcast(mode_by(train, None, label, out="_overall"))
    keys = [key] if key else []
    counts = rows.groupBy(*dict.fromkeys([*by, *keys, label])).agg(F.count(F.lit(1)).alias("n")).crossJoin(overall)
    if key:
        counts = counts.join(mode_by(train, key, label, out="_mode"), key, "left")
        counts = counts.withColumn("previsto", F.coalesce("_mode", "_overall"))
    else:
        counts = counts.withColumn("previsto", F.col("_overall"))
    return counts.groupBy(*by, label, "previsto").agg(F.sum("n").alias("n"))


def dictionary_or_model(train: DataFrame, scored: DataFrame, key: str, label: str, model_label: str, row_id: str,
                        out: str = "previsto") -> DataFrame:
    """The dictionary's answer where the key was trained on, the model's answer elsewhere."""
    learned = mode_by(train, key, label, out="_mode")
    joined = lookup_join(scored, learned, [key], [row_id])
    return joined.withColumn(out, F.coalesce("_mode", model_label)).withColumn(
        "no_dicionario", F.col("_mode").isNotNull()).drop("_mode")


def coverage(train: DataFrame, rows: DataFrame, key: str, by: Sequence[str] = ()) -> DataFrame:
    """Share of rows whose key is in the dictionary."""
    counts = rows.groupBy(*by, key).agg(F.count(F.lit(1)).alias("n"))
    joined = counts.join(known_keys(train, [key], "_known"), key, "left")
    hit = F.when(F.col("_known"), F.col("n")).otherwise(0)
    return joined.groupBy(*by).agg(C.ratio(F.sum(hit), F.sum("n")).alias("cobertura"), F.sum("n").alias("n"))


def top_list_hit_rate(train: DataFrame, rows: DataFrame, key: str, label: str, k: int = 3, by: Sequence[str] = ()) -> DataFrame:
    """Share of rows whose label is among the ``k`` commonest training labels of their key.

    An unknown key is answered with the overall most frequent label alone.
    """
    overall = F.broadcast(mode_by(train, None, label, out="_overall"))
    counts = rows.where(F.col(label).isNotNull()).groupBy(*dict.fromkeys([*by, key, label])).agg(F.count(F.lit(1)).alias("n"))
    joined = counts.join(top_labels_by(train, key, label, k, out="_top"), key, "left").crossJoin(overall)
    answer = F.coalesce("_top", F.array("_overall"))
    hit = F.when(F.array_contains(answer, F.col(label)), F.col("n")).otherwise(0)
    return joined.groupBy(*by).agg(C.ratio(F.sum(hit), F.sum("n")).alias("acerto_top"), F.sum("n").alias("n"))


def class_weights(train: DataFrame, label: str, out: str = "peso") -> DataFrame:
    """rows / (classes * rows of the class), per class."""
    counts = train.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    whole = F.broadcast(counts.agg(F.sum("_n").alias("_all"), F.count(F.lit(1)).alias("_k")))
    return counts.crossJoin(whole).select(label, (F.col("_all") / (F.col("_k") * F.col("_n"))).alias(out))
