"""The 43 dashboard panels.

Each panel takes ``read`` (a function from a table name to a DataFrame) and a day range. The
range is applied to the day column right after the table, from where it reaches the scan.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticketry.functions import columns as C
from ticketry.operators import stats as S
from ticketry.operators.series import trailing_mean

Read = Callable[[str], DataFrame]
DAY, N = "data_abertura", "total_incidentes"

TOTAL = "incidentes_diario_total"
KPI = "incidentes_diario_kpi"
SUMMARY = "kpi_resumo"
SILVER = "incidentes_tratados"


def from_lake(lake) -> Read:
    """Panel tables out of a loaded lake."""
    return lambda name: lake.table("silver" if name == SILVER else "gold", name)


def _in_range(read: Read, table: str, low: str | None, high: str | None) -> DataFrame:
    return read(table).where(C.between_days(DAY, low, high))


def _sum(df: DataFrame, out: str) -> DataFrame:
    return df.agg(F.sum(N).alias(out))


def total(read: Read, low=None, high=None) -> DataFrame:
    return _sum(_in_range(read, TOTAL, low, high), "total")


def priority_count(level: str):
    def panel(read: Read, low=None, high=None) -> DataFrame:
        return _in_range(read, SILVER, low, high).where(F.col("prioridade") == level).agg(F.count(F.lit(1)).alias("n"))
    return panel


def resolution_rate(read: Read, low=None, high=None) -> DataFrame:
    return _in_range(read, SUMMARY, low, high).agg(F.avg("taxa_resolucao").alias("v"))


def violation_rate(read: Read, low=None, high=None) -> DataFrame:
    """Mean of the daily rates, each day weighing the same."""
    return _in_range(read, SUMMARY, low, high).agg(F.avg("taxa_kpi_violado").alias("v"))


def daily_trend(days: int):
    def panel(read: Read, low=None, high=None) -> DataFrame:
        rows = _in_range(read, TOTAL, low, high).select(F.col(DAY).alias("time"), DAY, N)
        return trailing_mean(rows, N, days, out="media_movel").select("time", N, "media_movel")
    return panel


def mean_duration_hours(since: str | None = None):
    def panel(read: Read, low=None, high=None) -> DataFrame:
        rows = _in_range(read, SUMMARY, low, high).where(C.between_days(DAY, since, None))
        return rows.agg(F.round(F.avg("duracao_media_segundos") / 3600.0, 1).alias("horas"))
    return panel


def median_duration_hours(read: Read, low=None, high=None) -> DataFrame:
    return _in_range(read, SUMMARY, low, high).agg(F.round(F.avg("duracao_mediana_segundos") / 3600.0, 1).alias("horas"))


def in_kpi(read: Read, low=None, high=None) -> DataFrame:
    return _sum(_in_range(read, KPI, low, high).where("entrou_kpi"), "n")


def outside_kpi(read: Read, low=None, high=None) -> DataFrame:
    return _sum(_in_range(read, KPI, low, high).where("NOT entrou_kpi"), "n")


def violated(read: Read, low=None, high=None) -> DataFrame:
    return _sum(_in_range(read, KPI, low, high).where("kpi_violado"), "n")


def violated_or_within(read: Read, low=None, high=None) -> DataFrame:
    rows = _in_range(read, KPI, low, high).where("entrou_kpi")
    return rows.groupBy(C.outcome_label("kpi_violado", "Violado", "Dentro do indicador").alias("resultado")).agg(
        F.sum(N).alias("total")).orderBy(F.desc("total"))


def mean_per_day(read: Read, low=None, high=None) -> DataFrame:
    return _in_range(read, TOTAL, low, high).agg(F.round(F.avg(N), 1).alias("media"))


def days_with_tickets(read: Read, low=None, high=None) -> DataFrame:
    return _in_range(read, TOTAL, low, high).agg(F.count(F.lit(1)).alias("dias"))


def long_series(table: str, dimension: str):
    """(time, metric, value) of a daily count table."""
    def panel(read: Read, low=None, high=None) -> DataFrame:
        return _in_range(read, table, low, high).select(
            F.col(DAY).alias("time"), F.col(dimension).alias("metric"), F.col(N).alias("value")).orderBy("time", "metric")
    return panel


def totals_by(table: str, dimension: str, top: int | None = None):
    """Totals of a dimension by falling size; ties in order of the name."""
    def panel(read: Read, low=None, high=None) -> DataFrame:
        out = _in_range(read, table, low, high).groupBy(dimension).agg(F.sum(N).alias("total")).orderBy(
            F.desc("total"), F.asc(dimension))
        return out if top is None else out.limit(top)
    return panel


def daily_raw(read: Read, low=None, high=None) -> DataFrame:
    return _in_range(read, TOTAL, low, high).select(F.col(DAY).alias("time"), N).orderBy("time")


def peak_days(read: Read, low=None, high=None, top: int = 10) -> DataFrame:
    """The busiest days with their split by priority."""
    total_ = _in_range(read, TOTAL, low, high)
    split = _in_range(read, "incidentes_diario_prioridade", low, high).groupBy(DAY).agg(*[
        F.coalesce(F.sum(F.when(F.col("prioridade") == level, F.col(N))), F.lit(0)).alias(name)
        for level, name in (("2 - Alta", "p2_alta"), ("3 - Média", "p3_media"), ("4 - Baixa", "p4_baixa"))])
    return total_.join(split, DAY, "left").fillna(0, ["p2_alta", "p3_media", "p4_baixa"]).select(
        DAY, N, "p2_alta", "p3_media", "p4_baixa").orderBy(F.desc(N), F.asc(DAY)).limit(top)


def violation_rate_per_day(read: Read, low=None, high=None) -> DataFrame:
    return _in_range(read, SUMMARY, low, high).select(F.col(DAY).alias("time"), "taxa_kpi_violado").orderBy("time")


def by_month(read: Read, low=None, high=None) -> DataFrame:
    return _in_range(read, TOTAL, low, high).groupBy(C.month_label(DAY).alias("mes")).agg(F.sum(N).alias("total")).orderBy("mes")


def by_hour(read: Read, low=None, high=None) -> DataFrame:
    return _in_range(read, SILVER, low, high).groupBy(F.hour("aberto").alias("hora")).agg(
        F.count(F.lit(1)).alias("total")).orderBy("hora")


def by_weekday(read: Read, low=None, high=None) -> DataFrame:
    return _in_range(read, SILVER, low, high).groupBy("dia_semana").agg(F.count(F.lit(1)).alias("total")).orderBy("dia_semana")


def year_over_year(read: Read, low=None, high=None) -> DataFrame:
    return _in_range(read, TOTAL, low, high).select(
        C.year_free_date(DAY).alias("time"), F.year(DAY).cast("string").alias("metric"), F.col(N).alias("value")
    ).orderBy("time", "metric")


def month_over_month(read: Read, low=None, high=None) -> DataFrame:
    """The last two months and the change in percent; the range does not apply here."""
    months = read(TOTAL).groupBy(C.month_start(DAY).alias("mes_atual")).agg(F.sum(N).alias("total_atual"))
    w = Window.orderBy("mes_atual")
    pairs = months.select(
        "mes_atual", "total_atual", F.lag("mes_atual").over(w).alias("mes_anterior"),
        F.lag("total_atual").over(w).alias("total_anterior"))
    change = F.lit(100.0) * C.ratio(F.col("total_atual") - F.col("total_anterior"), F.col("total_anterior"))
    return pairs.orderBy(F.desc("mes_atual")).limit(1).withColumn("variacao_pct", F.round(change, 1))


def category_pareto(read: Read, low=None, high=None, top: int = 15) -> DataFrame:
    rows = _in_range(read, "incidentes_diario_categoria", low, high).groupBy("categoria").agg(F.sum(N).alias("total"))
    return S.pareto(rows, "categoria", "total", top)


def group_share(read: Read, low=None, high=None) -> DataFrame:
    rows = _in_range(read, "incidentes_diario_grupo_full", low, high).groupBy("grupo_designado").agg(F.sum(N).alias("total"))
    return S.share_of_total(rows, "grupo_designado", "total").orderBy(F.desc("total"), F.asc("grupo_designado"))


def duration_three_ways(read: Read, low=None, high=None) -> DataFrame:
    hours = lambda c: F.round(F.col(c) / 3600.0, 2)
    return _in_range(read, SUMMARY, low, high).select(
        F.col(DAY).alias("time"), hours("duracao_media_segundos").alias("oficial"),
        hours("duracao_mediana_segundos").alias("mediana"),
        hours("duracao_media_aparada_p99_segundos").alias("aparada_p99")).orderBy("time")


def outlier_pct(read: Read, low=None, high=None) -> DataFrame:
    return _in_range(read, SILVER, low, high).agg(
        F.round(F.lit(100.0) * F.avg(F.col("duracao_outlier_flag").cast("int")), 2).alias("pct"))


def outlier_count(read: Read, low=None, high=None) -> DataFrame:
    return _in_range(read, SILVER, low, high).agg(F.count_if("duracao_outlier_flag").alias("n"))


def longest_days(read: Read, low=None, high=None) -> DataFrame:
    return _in_range(read, SILVER, low, high).agg(F.round(F.max("duracao_dias"), 1).alias("max_dias"))


def outliers_per_day(read: Read, low=None, high=None) -> DataFrame:
    return _in_range(read, SILVER, low, high).groupBy(F.col(DAY).alias("time")).agg(
        F.count_if("duracao_outlier_flag").alias("outliers")).orderBy("time")


def group_by_priority(read: Read, low=None, high=None) -> DataFrame:
    level = lambda v: F.count_if(F.col("prioridade") == v)
    return _in_range(read, SILVER, low, high).groupBy("grupo_designado").agg(
        level("2 - Alta").alias("p2_alta"), level("3 - Média").alias("p3_media"), level("4 - Baixa").alias("p4_baixa"),
        F.count(F.lit(1)).alias("total")).orderBy(F.desc("total"), F.asc("grupo_designado"))


_PRIORITY, _GROUP, _FULL = "incidentes_diario_prioridade", "incidentes_diario_grupo", "incidentes_diario_grupo_full"

# panel number -> (name, function)
PANELS = {
    1: ("total_tickets", total),
    2: ("critical_count", priority_count("1 - Crítica")),
    3: ("resolution_rate", resolution_rate),
    4: ("violation_rate", violation_rate),
    5: ("daily_evolution_7d", daily_trend(7)),
    6: ("mean_duration_hours", mean_duration_hours()),
    7: ("mean_duration_hours_since", mean_duration_hours("2025-01-01")),
    8: ("tickets_in_kpi", in_kpi),
    9: ("mean_per_day", mean_per_day),
    10: ("days_with_tickets", days_with_tickets),
    11: ("operations_total", total),
    12: ("operations_critical_count", priority_count("1 - Crítica")),
    13: ("high_count", priority_count("2 - Alta")),
    14: ("daily_by_priority", long_series(_PRIORITY, "prioridade")),
    15: ("totals_by_status", totals_by("incidentes_diario_status", "status")),
    16: ("daily_raw", daily_raw),
    17: ("peak_days", peak_days),
    18: ("special_group_vs_others", long_series(_GROUP, "grupo_categoria")),
    19: ("monitored_in_kpi", in_kpi),
    20: ("outside_kpi", outside_kpi),
    21: ("violated_or_within", violated_or_within),
    22: ("violated_count", violated),
    23: ("sla_violation_rate", violation_rate),
    24: ("violation_rate_per_day", violation_rate_per_day),
    25: ("median_duration_hours", median_duration_hours),
    26: ("sla_mean_duration_hours", mean_duration_hours()),
    27: ("by_month", by_month),
    28: ("by_hour", by_hour),
    29: ("by_weekday", by_weekday),
    30: ("year_over_year", year_over_year),
    31: ("daily_trend_30d", daily_trend(30)),
    32: ("month_over_month", month_over_month),
    33: ("totals_by_group", totals_by(_FULL, "grupo_designado")),
    34: ("category_pareto", category_pareto),
    35: ("totals_by_channel", totals_by("incidentes_diario_aberto_por", "aberto_por")),
    36: ("group_share", group_share),
    37: ("top_closing_codes", totals_by("incidentes_diario_codigo_fechamento", "codigo_fechamento", 12)),
    38: ("duration_three_ways", duration_three_ways),
    39: ("outlier_pct", outlier_pct),
    40: ("outlier_count", outlier_count),
    41: ("longest_days", longest_days),
    42: ("outliers_per_day", outliers_per_day),
    43: ("group_by_priority", group_by_priority),
}
