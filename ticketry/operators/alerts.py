"""Alert thresholds and the alert queries on top of them."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticketry.functions import columns as C
from ticketry.operators.stats import latest_by
from ticketry.schema import RULE_ERROR_D7, RULE_VOLUME, THRESHOLD_SCHEMA, Rules

DAY, VALUE = "data_abertura", "volume_total"


def _stamped(df: DataFrame) -> DataFrame:
    return df.withColumn("calculado_em", F.current_timestamp().cast("timestamp_ntz")).select(*THRESHOLD_SCHEMA.fieldNames())


def volume_statistics(series: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """One row: mean, deviation, mean + 2 deviations, high percentiles and days above, over the
    current regime of a daily series."""
    v = F.col(VALUE).cast("double")
    current = series.where(F.col(DAY) >= F.lit(rules.regime_cut).cast("date"))
    stats = current.agg(
        F.avg(v).alias("media"), F.stddev_samp(v).alias("desvio"), F.count(F.lit(1)).alias("qtd_dias"),
        *[F.percentile(v, F.lit(p)).alias(f"p{round(p * 100)}") for p in (0.90, 0.95, 0.99)])
    limit = F.col("media") + 2 * F.col("desvio")
    above = current.crossJoin(F.broadcast(stats)).agg(F.count_if(v > limit).alias("qtd_dias_acima"))
    return stats.crossJoin(above).withColumn("threshold", limit)


def volume_threshold(series: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The volume rule as a row of the threshold log, rounded for display."""
    s = volume_statistics(series, rules)
    note = F.lit(f"Baseline restricted to the current regime (data_abertura >= {rules.regime_cut}).")
    return _stamped(s.select(
        F.lit(RULE_VOLUME).alias("regra"),
        *[F.round(c, 1).alias(c) for c in ("threshold", "media", "desvio", "p90", "p95", "p99")],
        F.col("qtd_dias").alias("qtd_dias_historico"), F.col("qtd_dias_acima").alias("qtd_dias_acima_historico"),
        F.round(F.lit(100.0) * C.ratio(F.col("qtd_dias_acima"), F.col("qtd_dias")), 2).alias("pct_dias_acima_historico"),
        F.lit(rules.regime_cut).cast("date").alias("regime_data_corte"), note.alias("detalhe")))


def error_threshold(metrics: DataFrame) -> DataFrame:
    """Twice the MAE of an evaluation row (mae, n); nothing is measured again."""
    empty = {c: F.lit(None).cast("double").alias(c) for c in ("media", "desvio", "p90", "p95", "p99", "pct_dias_acima_historico")}
    text = F.concat(F.lit("2 x MAE of the out-of-sample evaluation (MAE="), F.col("mae").cast("string"),
                    F.lit(", n="), F.col("n").cast("string"), F.lit(")"))
    return _stamped(metrics.select(
        F.lit(RULE_ERROR_D7).alias("regra"), F.round(F.lit(2.0) * F.col("mae"), 1).alias("threshold"), *empty.values(),
        F.col("n").alias("qtd_dias_historico"), F.lit(None).cast("long").alias("qtd_dias_acima_historico"),
        F.lit(None).cast("date").alias("regime_data_corte"), text.alias("detalhe")))


def latest_threshold(thresholds: DataFrame, rule: str) -> DataFrame:
    return latest_by(thresholds.where(F.col("regra") == rule), ["regra"], "calculado_em").select("threshold")


def _newest(df: DataFrame) -> DataFrame:
    return latest_by(df, ["serie", "horizonte"], "data_alvo")


def forecast_above_normal(forecasts: DataFrame, thresholds: DataFrame, horizon: str, serie: str = "total") -> DataFrame:
    """Newest forecast of a horizon minus the newest volume threshold; firing above zero."""
    mine = forecasts.where((F.col("serie") == serie) & (F.col("horizonte") == horizon))
    margin = F.col("valor_previsto") - F.col("threshold")
    return _newest(mine).crossJoin(F.broadcast(latest_threshold(thresholds, RULE_VOLUME))).select(
        "serie", "horizonte", "data_alvo", margin.alias("margem"), (margin > 0).alias("disparado"))


def real_against_forecast(forecasts: DataFrame, actual: DataFrame, pending: bool = False) -> DataFrame:
    """Forecasts next to the volume of their target day; with ``pending`` also those without one yet."""
    real = actual.select(F.col(DAY).alias("data_alvo"), F.col(VALUE).alias("valor_real"))
    return forecasts.join(real, "data_alvo", "left" if pending else "inner").withColumn(
        "erro_abs", F.abs(F.col("valor_previsto") - F.col("valor_real")))


def error_above_expected(forecasts: DataFrame, actual: DataFrame, thresholds: DataFrame, horizon: str = "D+7",
                         serie: str = "total") -> DataFrame:
    """Error of the newest forecast whose day has passed minus the newest error threshold."""
    mine = forecasts.where((F.col("serie") == serie) & (F.col("horizonte") == horizon))
    margin = F.col("erro_abs") - F.col("threshold")
    return _newest(real_against_forecast(mine, actual)).crossJoin(
        F.broadcast(latest_threshold(thresholds, RULE_ERROR_D7))).select(
        "serie", "horizonte", "data_alvo", margin.alias("margem"), (margin > 0).alias("disparado"))


def notifications(evaluations: DataFrame, repeat_hours: float = 4.0) -> DataFrame:
    """Which evaluations notify: the first firing one of a run, then each that comes ``repeat_hours`` or more after the last notice.

    ``evaluations`` is a log (alerta, avaliado_em, disparado). Runs are numbered by counting the changes of state. The
    firing evaluations of a run are folded in their order; what is carried on is the time of the last notice, so a run of
    any length needs no memory. Evaluations of the same time are one notice. A NULL state doesn't fire.
    """
    w = Window.partitionBy("alerta").orderBy("avaliado_em")
    fires = F.coalesce("disparado", F.lit(False))
    changed = (F.coalesce(F.lag(fires).over(w), F.lit(False)) != fires).cast("int")
    runs = evaluations.select("alerta", "avaliado_em", "disparado", changed.alias("_changed")).withColumn(
        "_run", F.sum("_changed").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    key = ["alerta", "_run"]
    firing = runs.where(fires).select(*key, "avaliado_em", "disparado").repartition(*key).sortWithinPartitions(*key, "avaliado_em")
    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in evaluations.select("alerta", "avaliado_em", "disparado").schema.fields), "notifica boolean"])
    repeat = pd.Timedelta(hours=repeat_hours)

    def fold(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        run, last = None, None
        for frame in frames:
            marks = []
            for *now, at in frame[[*key, "avaliado_em"]].itertuples(index=False):
                first = now != run
                if notify := first or at - last >= repeat:
                    run, last = now, at
                marks.append(notify)
            yield frame.assign(notifica=marks).drop(columns="_run")

    quiet = evaluations.where(~fires).select("alerta", "avaliado_em", "disparado", F.lit(False).alias("notifica"))
    return firing.mapInPandas(fold, schema).unionByName(quiet)


def require_predictions(n: int, what: str) -> None:
    if n == 0:
        raise RuntimeError(f"no {what} were produced")
