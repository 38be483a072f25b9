"""What a later split has that the training split had not: texts, templates, classes."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketry.functions import text as T
from ticketry.operators.lookups import digested, known_keys, lookup_join
from ticketry.schema import LEAKAGE_COLUMNS
from ticketry.session import settled

# --- fixed values: the four novelty classes, nearest first -------------------------------
EXACT = "Exact Match"
SAME_TEMPLATE = "Candidate Normalized Match"
SAME_PREFIX = "Candidate Template"
NOVEL = "Genuinely Novel"


def _ladder() -> Column:
    return (
        F.when(F.col("_exact"), F.lit(EXACT)).when(F.col("_norm_known"), F.lit(SAME_TEMPLATE))
        .when(F.col("_prefix_known"), F.lit(SAME_PREFIX)).otherwise(F.lit(NOVEL))
    )


def text_novelty(train: DataFrame, texts: DataFrame, column: str) -> DataFrame:
    """Novelty class of each distinct non-NULL text of ``texts``.

    Both sides are reduced to distinct keys before they meet, so a text that fills a third of
    the table is one row here. Many texts can still share a template or a prefix; those two
    lookups spread a hot key by the text itself.
    """
    distinct = texts.where(F.col(column).isNotNull()).select(column).distinct()
    keyed = distinct.withColumns({"_norm": T.as_template(column), "_prefix": T.before_colon(column)})
    seen = settled(train.select(column).where(F.col(column).isNotNull()).distinct())
    norms = seen.select(T.as_template(column).alias("_norm")).distinct().withColumn("_norm_known", F.lit(True))
    prefixes = seen.select(T.before_colon(column).alias("_prefix")).distinct().withColumn("_prefix_known", F.lit(True))
    out = keyed.join(seen.withColumn("_exact", F.lit(True)), column, "left")
    out = lookup_join(out, norms, ["_norm"], [column])
    out = lookup_join(out, prefixes, ["_prefix"], [column])
    return out.select(column, _ladder().alias("categoria_novidade"))


def with_novelty(train: DataFrame, rows: DataFrame, column: str, row_id: str) -> DataFrame:
    """``rows`` with their novelty class and the flag ``seen_in_train``; NULL text is novel."""
    classes = text_novelty(train, rows, column)
    out = lookup_join(rows, classes, [column], [row_id])
    out = out.withColumn("categoria_novidade", F.coalesce("categoria_novidade", F.lit(NOVEL)))
    return out.withColumn("seen_in_train", F.col("categoria_novidade") == EXACT)


def novelty_counts(train: DataFrame, rows: DataFrame, column: str, by: Sequence[str]) -> DataFrame:
    """Rows per slice and novelty class, counted per distinct text before the join."""
    counts = rows.groupBy(*by, column).agg(F.count(F.lit(1)).alias("_n"))
    classes = text_novelty(train, counts, column)
    joined = counts.join(classes, column, "left")
    return joined.groupBy(*by, F.coalesce("categoria_novidade", F.lit(NOVEL)).alias("categoria_novidade")).agg(
        F.sum("_n").alias("n"))


def with_seen_flag(train: DataFrame, rows: DataFrame, column: str, row_id: str, flag: str = "seen_in_train",
                   long_text: bool = False) -> DataFrame:
    """``rows`` plus whether their value of ``column`` occurs in ``train``.

    ``long_text`` compares digests and so keeps the texts themselves out of the shuffle.
    """
    key = column
    if long_text:
        key = "_digest"
        rows = rows.withColumn(key, F.sha2(column, 256))
        train = train.select(F.sha2(column, 256).alias(key))
    out = lookup_join(rows, known_keys(train, [key], flag), [key], [row_id]).withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))
    return out.drop("_digest") if long_text else out


def seen_counts(train: DataFrame, rows: DataFrame, column: str, by: Sequence[str], long_text: bool = False) -> DataFrame:
    """Rows per slice with a value known from ``train``, and without."""
    if long_text:
        train, rows = digested(train, column), digested(rows, column)
    counts = rows.groupBy(*by, column).agg(F.count(F.lit(1)).alias("_n"))
    known = known_keys(train, [column], "_known")
    return counts.join(known, column, "left").groupBy(
        *by, F.coalesce("_known", F.lit(False)).alias("seen_in_train")).agg(F.sum("_n").alias("n"))


def cold_start(train: DataFrame, other: DataFrame, label: str) -> DataFrame:
    """One row: labels of ``other`` that ``train`` never had, and the rows they hold."""
    counts = other.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    new = counts.join(train.select(label).distinct(), label, "left_anti")
    return new.agg(F.count(F.lit(1)).alias("classes_novas"), F.coalesce(F.sum("n"), F.lit(0)).alias("linhas_afetadas"))


def never_again(train: DataFrame, others: Sequence[DataFrame], label: str) -> DataFrame:
    """Labels of ``train`` that none of the other splits has."""
    out = train.where(F.col(label).isNotNull()).select(label).distinct()
    for other in others:
        out = out.join(other.select(label).distinct(), label, "left_anti")
    return out


def common_keys(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur on both sides."""
    return a.select(*keys).intersect(b.select(*keys))


def require_disjoint(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> None:
    if not a.select(*keys).join(b.select(*keys), list(keys), "left_semi").limit(1).isEmpty():
        raise ValueError(f"training and scored rows share keys in {list(keys)}")


def require_no_leakage(features: Iterable[str], forbidden: Iterable[str] = LEAKAGE_COLUMNS) -> None:
    bad = sorted(set(features) & set(forbidden))
    if bad:
        raise ValueError(f"columns that only exist after the outcome are no features: {bad}")


def kept_values(train: DataFrame, column: str, min_rows: int) -> DataFrame:
    """Values with at least ``min_rows`` rows in ``train``, with their count."""
    return (
        train.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n_train"))
        .where(F.col("_n_train") >= min_rows)
    )


def bucket_rare(train: DataFrame, rows: DataFrame, column: str, row_id: str, min_rows: int = 20,
                rare: str = "Outros", missing: str | None = "Desconhecido", out: str | None = None) -> DataFrame:
    """Values frequent in ``train`` stay, all others become ``rare``; NULL becomes ``missing``."""
    kept = kept_values(train, column, min_rows).select(column, F.lit(True).alias("_kept"))
    joined = lookup_join(rows, kept, [column], [row_id])
    value = F.when(F.col("_kept"), F.col(column))
    if missing is not None:
        value = value.when(F.col(column).isNull(), F.lit(missing))
    return joined.withColumn(out or column, value.otherwise(F.lit(rare))).drop("_kept")


def bucket_rare_labels(train: DataFrame, rows: DataFrame, label: str, row_id: str, cut: int = 50,
                       rare: str = "OUTRAS_RARAS", out: str | None = None) -> DataFrame:
    """Labels with fewer than ``cut`` training rows, and labels never trained on, share one class."""
    return bucket_rare(train, rows, label, row_id, cut, rare, None, out)


def with_frequency(train: DataFrame, rows: DataFrame, column: str, row_id: str, default_value: str = "RARO",
                   out: str = "freq_log") -> DataFrame:
    """log(1 + rows in ``train``) of the value; an unknown value takes the count of ``default_value``."""
    counts = train.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n_train"))
    fallback = counts.agg(F.coalesce(F.max(F.when(F.col(column) == default_value, F.col("_n_train"))), F.lit(1)).alias("_default"))
    joined = lookup_join(rows, counts, [column], [row_id]).crossJoin(F.broadcast(fallback))
    return joined.withColumn(out, F.log1p(F.coalesce("_n_train", "_default").cast("double"))).drop("_n_train", "_default")
