"""Daily series: dense grid, lags, targets, rolling windows, naive forecasts.

Every window here runs over rows already reduced to one per day, inside one series.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticketry.functions import columns as C
from ticketry.schema import Rules

DAY = "data_abertura"
KEY = "serie"
VALUE = "volume_total"


def daily_volume(silver: DataFrame, rules: Rules = Rules(), serie: str = "total") -> DataFrame:
    """Tickets per day in the population the forecast is built on. Both filters reach the scan."""
    return (
        silver.where((F.col(DAY) >= F.lit(rules.start).cast("date")) & ~F.col("prioridade").isin(*rules.excluded_priorities))
        .groupBy(DAY).agg(F.count(F.lit(1)).alias(VALUE))
        .select(F.lit(serie).alias(KEY), DAY, VALUE)
    )


def spine(series: DataFrame) -> DataFrame:
    """Every day from the first to the last of each series."""
    return series.groupBy(KEY).agg(F.min(DAY).alias("_a"), F.max(DAY).alias("_b")).select(
        KEY, F.explode(F.sequence("_a", "_b")).alias(DAY))


def missing_days(series: DataFrame) -> DataFrame:
    return spine(series).join(series.select(KEY, DAY), [KEY, DAY], "left_anti")


def dense(series: DataFrame, fill: float | int | None = None) -> DataFrame:
    """The series on a gap-free daily grid.

    Without ``fill`` a missing day fails the job that reads the result; with it, the value of a
    missing day is ``fill``.
    """
    out = spine(series).join(series, [KEY, DAY], "left")
    if fill is None:
        text = F.concat(F.lit("no ticket on "), F.col(DAY).cast("string"), F.lit(" in series "), F.col(KEY))
        return out.where(F.when(F.col(VALUE).isNotNull(), F.lit(True)).otherwise(F.raise_error(text).cast("boolean")))
    return out.fillna({VALUE: fill})


def require_dense(series: DataFrame) -> None:
    gaps = [r[DAY].isoformat() for r in missing_days(series).orderBy(KEY, DAY).limit(5).collect()]
    if gaps:
        raise ValueError(f"days without a ticket in the series, starting with {gaps}")


def _along(df_key: str = KEY):
    return Window.partitionBy(df_key).orderBy(DAY)


def with_lags(series: DataFrame, lags: Sequence[int], value: str = VALUE) -> DataFrame:
    return series.withColumns({f"lag_{k}": F.lag(value, k).over(_along()) for k in lags})


def with_targets(series: DataFrame, value: str = VALUE, horizons: Sequence[int] = (1, 7)) -> DataFrame:
    return series.withColumns({f"target_d{h}": F.lead(value, h).over(_along()) for h in horizons})


def with_rolling(series: DataFrame, widths: Sequence[int] = (7, 14, 28), value: str = VALUE) -> DataFrame:
    """Mean and sample deviation of the ``w`` days ending yesterday, and the weekly trend.

    A window that is not complete gives NULL.
    """
    new = {}
    for w in widths:
        past = _along().rowsBetween(-w, -1)
        full = F.count(value).over(past) == w
        new[f"rolling_mean_{w}"] = F.when(full, F.avg(value).over(past))
        new[f"rolling_std_{w}"] = F.when(full, F.stddev_samp(value).over(past))
    out = series.withColumns(new)
    if 7 in widths:
        out = out.withColumn("trend_7d", F.col("rolling_mean_7") - F.lag("rolling_mean_7", 7).over(_along()))
    return out


def with_regime(series: DataFrame, rules: Rules = Rules()) -> DataFrame:
    return series.withColumn("periodo_pos_set_2025", C.after_cut_flag(DAY, rules.regime_cut))


def with_calendar(series: DataFrame, day: str = DAY) -> DataFrame:
    return series.withColumns({
        "day_of_week": C.monday_zero(day), "is_weekend": C.is_weekend(day), "month": F.month(day)})


def with_naive(series: DataFrame, value: str = VALUE, back_d7: int = 6) -> DataFrame:
    """Persistence for tomorrow, and the value ``back_d7`` days ago for the day in a week."""
    return series.withColumns({"naive_d1": F.col(value), "naive_d7": F.lag(value, back_d7).over(_along())})


def drop_warm_up(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(columns))


def volume_features(series: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Lags and regime flag of a dense series, warm-up rows dropped."""
    return drop_warm_up(with_regime(with_lags(series, rules.lags), rules), rules.lag_columns).select(
        KEY, DAY, *rules.d7_features)


def volume_dataset(series: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Features and both targets from the same window pass."""
    df = with_targets(with_regime(with_lags(series, rules.lags), rules))
    return drop_warm_up(df, rules.lag_columns)


def last_day(df: DataFrame) -> DataFrame:
    """The rows of the last available day of each series."""
    newest = df.groupBy(KEY).agg(F.max(DAY).alias(DAY))
    return df.join(newest, [KEY, DAY], "left_semi")


def trailing_mean(df: DataFrame, value: str, days: int, by: Sequence[str] = (), out: str | None = None) -> DataFrame:
    """Mean of this and the previous ``days - 1`` rows; the first rows average what there is."""
    w = Window.partitionBy(*by).orderBy(DAY).rowsBetween(-(days - 1), 0)
    return df.withColumn(out or f"media_movel_{days}", F.avg(value).over(w))


def centred_mean(series: DataFrame, days: int = 7, value: str = VALUE) -> DataFrame:
    half = days // 2
    w = _along().rowsBetween(-half, half)
    return series.withColumn(f"media_centrada_{days}", F.when(F.count(value).over(w) == days, F.avg(value).over(w)))


def composition(silver: DataFrame, levels: dict[str, str], monitored: str, manual: str,
                parent: str = "incidente_pai") -> DataFrame:
    """Per day: volume, counts and shares by priority level, by channel, and with a parent ticket."""
    channel = F.lower("aberto_por")
    counts = silver.groupBy(DAY).agg(
        F.count(F.lit(1)).alias(VALUE),
        *[F.count_if(F.col("prioridade") == label).alias(f"volume_p_{name}") for name, label in levels.items()],
        F.count_if(channel == monitored).alias("volume_monitoramento"),
        F.count_if(channel == manual).alias("volume_manual"),
        F.count(parent).alias("volume_incidente_pai"),
    )
    whole = F.col(VALUE)
    return counts.withColumns({
        **{f"share_p_{name}": C.ratio(F.col(f"volume_p_{name}"), whole) for name in levels},
        "share_monitoramento": C.ratio(F.col("volume_monitoramento"), whole),
        "share_incidente_pai": C.ratio(F.col("volume_incidente_pai"), whole),
    })


def regime_stats(series: DataFrame, rules: Rules = Rules(), value: str = VALUE) -> DataFrame:
    """One row per statistic with both regimes side by side and their ratio."""
    side = series.select(C.regime_label(DAY, rules.regime_cut, "pre", "pos").alias("regime"), F.col(value).cast("double").alias("v"))
    stats = side.groupBy("regime").agg(
        F.count("v").cast("double").alias("n_dias"), F.avg("v").alias("media"), F.stddev_samp("v").alias("desvio"),
        F.percentile("v", F.lit(0.5)).alias("mediana"), F.min("v").alias("minimo"), F.max("v").alias("maximo"))
    long = stats.unpivot("regime", ["n_dias", "media", "desvio", "mediana", "minimo", "maximo"], "estatistica", "valor")
    wide = long.groupBy("estatistica").pivot("regime", ["pre", "pos"]).agg(F.first("valor"))
    return wide.withColumn(
        "razao", F.when(F.col("estatistica") != "n_dias", C.ratio(F.col("pos"), F.col("pre"))))
