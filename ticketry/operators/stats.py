"""Profiles, crosstabs, modes and association measures. Counts come first, then arithmetic."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketry.functions import columns as C
from ticketry.operators.quantiles import exact_quantiles


def counted(df: DataFrame, *keys: str, out: str = "n") -> DataFrame:
    """Rows per key; the reduction that most reports start from."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def frequency(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """Value, count and share in percent, NULL included; optionally only the ``top`` values.

    Ties are put in order of the value.
    """
    counts = counted(df, column, out="qtd")
    whole = counts.agg(F.sum("qtd").alias("_all"))
    out = counts.crossJoin(F.broadcast(whole)).select(
        column, "qtd", (F.lit(100.0) * F.col("qtd") / F.col("_all")).alias("pct"))
    if top is not None:
        out = out.orderBy(F.desc("qtd"), F.asc_nulls_first(column)).limit(top)
    return out


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Counts of every value of every column as (coluna, valor, qtd): one scan, one shuffle."""
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("coluna"), F.col(c).cast("string").alias("valor")) for c in columns
    ])).alias("cell")).select("cell.coluna", "cell.valor")
    return counted(long, "coluna", "valor", out="qtd")


def profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column: rows, nulls, distinct values (NULL counts as one), top value, flags.

    Works on the value counts, so a heavy value costs one row per map task.
    """
    columns = list(columns or df.columns)
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    counts = value_counts(df, columns)
    missing = F.when(F.col("valor").isNull(), F.col("qtd")).otherwise(0)
    present = F.col("valor").isNotNull()
    per_column = counts.groupBy("coluna").agg(
        F.sum("qtd").alias("linhas"),
        F.sum(missing).alias("nulos"),
        F.count(F.lit(1)).alias("distintos"),
        F.max(F.when(present, F.col("qtd"))).alias("freq_top"),
        F.min(F.when(present, F.col("valor"))).alias("menor"),
        F.max(F.when(present, F.col("valor"))).alias("maior"),
    )
    tops = (
        counts.where(present).join(per_column.select("coluna", "freq_top"), "coluna")
        .where(F.col("qtd") == F.col("freq_top")).groupBy("coluna").agg(F.min("valor").alias("top"))
    )
    pct = F.lit(100.0) / F.col("linhas")
    kind = F.try_element_at(F.create_map(*[F.lit(x) for c in columns for x in (c, types[c])]), F.col("coluna"))
    return per_column.join(tops, "coluna", "left").select(
        "coluna", kind.alias("tipo"), "linhas", "nulos", F.round(F.col("nulos") * pct, 2).alias("pct_nulos"),
        "distintos", F.round(F.col("distintos") * pct, 2).alias("pct_distintos"), "top", "freq_top", "menor", "maior",
        (F.col("distintos") >= F.lit(0.8) * F.col("linhas")).alias("quase_unica"),
        (F.col("distintos") <= 10).alias("poucos_valores"),
        (F.col("nulos") * pct >= 30).alias("alerta_nulos"),
    )


def approx_distinct(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Sketch-based distinct counts (NULL not counted), for columns too wide to count exactly."""
    return df.agg(*[F.approx_count_distinct(c).alias(c) for c in columns])


def time_range(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(column).alias("inicio"), F.max(column).alias("fim"))


def duplicate_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows that repeat an earlier row in all columns, and their share in percent."""
    counts = counted(df, *(columns or df.columns))
    return counts.agg(F.sum("n").alias("linhas"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicadas")).select(
        "linhas", "duplicadas", F.round(F.lit(100.0) * C.ratio(F.col("duplicadas"), F.col("linhas")), 2).alias("pct"))


def describe_numeric(df: DataFrame, column: str) -> DataFrame:
    """count, mean, std, min, quartiles, max, median, bias-corrected skew and kurtosis, CV."""
    v = F.col(column).cast("double")
    n = F.col("n").cast("double")
    moments = df.agg(
        F.count(v).alias("n"), F.avg(v).alias("media"), F.stddev_samp(v).alias("desvio"), F.min(v).alias("minimo"),
        F.max(v).alias("maximo"), F.skewness(v).alias("_g1"), F.kurtosis(v).alias("_g2"))
    quartiles = exact_quantiles(df, column, {"p25": 0.25, "mediana": 0.5, "p75": 0.75})
    g1, g2 = F.col("_g1"), F.col("_g2")
    skew = F.when(n > 2, g1 * F.sqrt(n * (n - 1)) / (n - 2))
    kurt = F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6))
    return moments.crossJoin(F.broadcast(quartiles)).select(
        "n", "media", "desvio", "minimo", "p25", "mediana", "p75", "maximo",
        skew.alias("assimetria"), kurt.alias("curtose"), C.ratio(F.col("desvio"), F.col("media")).alias("cv"))


def null_rate(df: DataFrame, column: str, by: Sequence[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.avg(F.col(column).isNull().cast("int")).alias("taxa_nulos"))


def distinct_by_group(df: DataFrame, column: str, by: Sequence[str]) -> DataFrame:
    """Distinct non-NULL values per group, counted from the distinct pairs."""
    return counted(df, *by, column).groupBy(*by).agg(F.count(column).alias("distintos"))


def repetition_rate(df: DataFrame, column: str) -> DataFrame:
    """1 - distinct non-NULL values / rows."""
    counts = counted(df, column)
    return counts.agg(F.count(column).alias("distintos"), F.sum("n").alias("linhas")).select(
        "distintos", "linhas", (F.lit(1.0) - C.ratio(F.col("distintos"), F.col("linhas"))).alias("taxa_repeticao"))


def crosstab(df: DataFrame, row: str, column: str, values: Sequence, names: Sequence[str] | None = None) -> DataFrame:
    """Counts of ``row`` against the listed ``values`` of ``column``; absent pairs are 0."""
    names = list(names or [str(v) for v in values])
    return df.groupBy(row).agg(*[F.count_if(F.col(column) == v).alias(n) for v, n in zip(values, names)])


def month_matrix(df: DataFrame, day: str, column: str, values: Sequence, names: Sequence[str], shares: bool = False) -> DataFrame:
    """Month by value counts, or each month's shares of the listed values."""
    wide = crosstab(df.withColumn("mes_ref", C.month_start(day)), "mes_ref", column, values, names)
    if not shares:
        return wide
    whole = sum((F.col(n) for n in names), F.lit(0))
    return wide.select("mes_ref", *[C.ratio(F.col(n), whole).alias(n) for n in names])


def months_filled(df: DataFrame, day: str) -> DataFrame:
    """Rows per calendar month from the first to the last, empty months as 0."""
    counts = counted(df.select(C.month_start(day).alias("mes_ref")).where("mes_ref is not null"), "mes_ref", out="total")
    months = counts.agg(F.min("mes_ref").alias("a"), F.max("mes_ref").alias("b")).select(
        F.explode(F.expr("sequence(a, b, interval 1 month)")).alias("mes_ref"))
    return months.join(counts, "mes_ref", "left").fillna({"total": 0})


def by_year(df: DataFrame, day: str) -> DataFrame:
    return counted(df.select(F.year(day).alias("ano")), "ano", out="total")


def histogram(df: DataFrame, column: str, bins: int = 40) -> DataFrame:
    """Equal-width bins from minimum to maximum; the last bin holds the maximum too."""
    v = F.col(column).cast("double")
    edge = df.agg(F.min(v).alias("_a"), F.max(v).alias("_b"))
    step = (F.col("_b") - F.col("_a")) / F.lit(float(bins))
    place = F.when(step == 0, F.lit(1)).otherwise(
        F.least(F.floor((v - F.col("_a")) / F.nullif(step, F.lit(0.0))) + 1, F.lit(bins)))
    placed = df.where(v.isNotNull()).crossJoin(F.broadcast(edge)).select(place.cast("int").alias("faixa"), "_a", step.alias("_s"))
    return placed.groupBy("faixa").agg(F.count(F.lit(1)).alias("qtd"), F.min("_a").alias("_a"), F.min("_s").alias("_s")).select(
        "faixa", "qtd", (F.col("_a") + F.col("_s") * (F.col("faixa") - 1)).alias("inicio"))


def mode_by(df: DataFrame, group: str | None, label: str, weight: str | None = None, out: str = "moda") -> DataFrame:
    """Most frequent non-NULL label per group (one row without a group); ties go to the smallest."""
    keys = [group] if group else []
    n = F.sum(weight) if weight else F.count(F.lit(1))
    present = F.col(label).isNotNull()
    if group:
        present = present & F.col(group).isNotNull()
    counts = df.where(present).groupBy(*keys, label).agg(n.alias("_n"))
    w = Window.partitionBy(*keys).orderBy(F.desc("_n"), F.asc(label))
    best = counts.withColumn("_rn", F.row_number().over(w)).where("_rn = 1")
    return best.select(*keys, F.col(label).alias(out))


def top_labels_by(df: DataFrame, group: str, label: str, k: int = 3, weight: str | None = None, out: str = "top") -> DataFrame:
    """The ``k`` most frequent labels per group as a list, most frequent first."""
    n = F.sum(weight) if weight else F.count(F.lit(1))
    counts = df.where(F.col(label).isNotNull() & F.col(group).isNotNull()).groupBy(group, label).agg(n.alias("_n"))
    w = Window.partitionBy(group).orderBy(F.desc("_n"), F.asc(label))
    best = counts.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k)
    ordered = F.array_sort(F.collect_list(F.struct("_rn", label)))
    return best.groupBy(group).agg(F.transform(ordered, lambda x: x[label]).alias(out))


def nmi(df: DataFrame, a: str, b: str) -> DataFrame:
    """Mutual information of two columns over the mean of their entropies."""
    joint = counted(df.select(F.col(a).cast("string").alias("_x"), F.col(b).cast("string").alias("_y")).dropna(), "_x", "_y")
    whole = F.broadcast(joint.agg(F.sum("n").alias("_N")))

    def entropy(counts: DataFrame, name: str) -> DataFrame:
        p = F.col("n") / F.col("_N")
        return counts.crossJoin(whole).agg((-F.sum(p * F.log(p))).alias(name))

    hx = entropy(joint.groupBy("_x").agg(F.sum("n").alias("n")), "_hx")
    hy = entropy(joint.groupBy("_y").agg(F.sum("n").alias("n")), "_hy")
    hxy = entropy(joint, "_hxy")
    mean = (F.col("_hx") + F.col("_hy")) / 2
    value = F.when(mean == 0, F.lit(1.0)).otherwise((F.col("_hx") + F.col("_hy") - F.col("_hxy")) / F.nullif(mean, F.lit(0.0)))
    return hx.crossJoin(hy).crossJoin(hxy).select(F.lit(a).alias("a"), F.lit(b).alias("b"), value.alias("nmi"))


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every ordered pair, one aggregate over one scan."""
    pairs = [(a, b) for a in columns for b in columns]
    row = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}|{b}") for a, b in pairs])
    cells = F.array(*[
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"`{a}|{b}`").alias("corr")) for a, b in pairs])
    return row.select(F.inline(cells))


def rare_cut_report(train: DataFrame, label: str, cuts: Sequence[int] = (10, 20, 30, 50)) -> DataFrame:
    """Per cut: classes below it, classes kept, and the share of rows the rare ones hold."""
    counts = counted(train.where(F.col(label).isNotNull()), label)
    each = counts.select("n", F.explode(F.array(*[F.lit(c) for c in cuts])).alias("corte"))
    rare = F.col("n") < F.col("corte")
    return each.groupBy("corte").agg(
        F.count_if(rare).alias("agrupadas"), F.count_if(~rare).alias("principais"),
        (F.lit(100.0) * F.sum(F.when(rare, F.col("n")).otherwise(0)) / F.sum("n")).alias("pct_volume"))


def slice_excess(df: DataFrame, inside: Column, after: Column) -> DataFrame:
    """How much of the growth between two periods one slice accounts for."""
    inside = F.coalesce(inside, F.lit(False))
    return df.agg(
        F.count_if(inside & after).alias("recorte_pos"),
        F.count_if(inside & ~after).alias("recorte_pre"),
        (F.count_if(after) - F.count_if(~after)).alias("aumento_total"))


def pareto(totals: DataFrame, label: str, total: str, top: int | None = None) -> DataFrame:
    """Share and running share by falling total. Equal totals share one running value.

    ``totals`` has one row per class. Only the distinct totals are ordered in one task; classes
    whose totals differ are few, since n such classes hold at least n * n / 2 tickets.
    """
    levels = totals.groupBy(F.col(total).alias("_level")).agg(F.sum(total).alias("_sum"))
    running = Window.orderBy(F.desc_nulls_last("_level")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    levels = levels.select("_level", F.sum("_sum").over(running).alias("_run"))
    whole = totals.agg(F.sum(total).alias("_all"))
    out = totals.join(levels, F.col(total).eqNullSafe(F.col("_level"))).crossJoin(F.broadcast(whole)).select(
        label, total,
        F.round(F.lit(100.0) * F.col(total) / F.col("_all"), 1).alias("pct_do_total"),
        F.round(F.lit(100.0) * F.col("_run") / F.col("_all"), 1).alias("pct_acumulado"))
    if top is None:
        return out
    return out.orderBy(F.desc(total), F.asc(label)).limit(top)


def share_of_total(totals: DataFrame, label: str, total: str) -> DataFrame:
    whole = totals.agg(F.sum(total).alias("_all"))
    return totals.crossJoin(F.broadcast(whole)).select(
        label, total, F.round(F.lit(100.0) * F.col(total) / F.col("_all"), 1).alias("pct_do_total"))


def latest_by(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The newest row per key; the map tasks already keep one row per key."""
    w = Window.partitionBy(*keys).orderBy(F.desc(order))
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
