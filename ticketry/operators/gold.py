"""Daily aggregates of the typed tickets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketry.functions import columns as C
from ticketry.operators.quantiles import exact_quantiles
from ticketry.schema import GOLD_SCHEMAS, Rules

TOTAL = "total_incidentes"
DAY = "data_abertura"

# gold table -> the dimension counted next to the day
DAILY_TABLES = {
    "incidentes_diario_total": None,
    "incidentes_diario_prioridade": "prioridade",
    "incidentes_diario_grupo": "grupo_categoria",
    "incidentes_diario_grupo_full": "grupo_designado",
    "incidentes_diario_aberto_por": "aberto_por",
    "incidentes_diario_status": "status",
    "incidentes_diario_categoria": "categoria",
    "incidentes_diario_codigo_fechamento": "codigo_fechamento",
}


def with_group_bucket(silver: DataFrame, rules: Rules = Rules()) -> DataFrame:
    return silver.withColumn(
        "grupo_categoria", C.two_buckets("grupo_designado", rules.special_group, rules.other_groups))


def daily_count(silver: DataFrame, dimension: str | None = None) -> DataFrame:
    """Tickets per day, or per day and dimension; a NULL dimension is a group of its own."""
    keys = [DAY] + ([dimension] if dimension else [])
    return silver.groupBy(*keys).agg(F.count(F.lit(1)).alias(TOTAL))


def daily_kpi(silver: DataFrame) -> DataFrame:
    return silver.groupBy(DAY, "entrou_kpi", "kpi_violado").agg(F.count(F.lit(1)).alias(TOTAL))


def hourly(silver: DataFrame) -> DataFrame:
    """Tickets per hour of day and weekday; rows without either key are left out."""
    return (
        silver.select(F.hour("aberto").alias("hora"), "dia_semana").dropna()
        .groupBy("hora", "dia_semana").agg(F.count(F.lit(1)).alias(TOTAL))
    )


def duration_limit(silver: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """One row: the duration quantile over all tickets, valid or not."""
    return exact_quantiles(silver, "duracao_segundos", {"_limit": rules.outlier_quantile})


def kpi_summary(silver: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """One row per day with the official mean duration, two robust ones and two rates.

    The means and rates are one conditional aggregate; the daily medians come from the exact
    quantile operator, which holds up when one day has most of the rows.
    """
    slim = silver.select(DAY, "duracao_segundos", "duracao_valida", "foi_resolvido", "entrou_kpi", "kpi_violado")
    valid = F.col("duracao_valida")
    seconds = F.col("duracao_segundos")
    means = (
        slim.crossJoin(F.broadcast(duration_limit(slim, rules)))
        .groupBy(DAY)
        .agg(
            F.avg(F.when(valid, seconds)).alias("duracao_media_segundos"),
            F.avg(F.when(valid & (seconds <= F.col("_limit")), seconds)).alias("duracao_media_aparada_p99_segundos"),
            F.avg(F.col("foi_resolvido").cast("int")).alias("taxa_resolucao"),
            F.avg(F.when(F.col("entrou_kpi"), F.col("kpi_violado").cast("double"))).alias("taxa_kpi_violado"),
        )
    )
    medians = exact_quantiles(
        slim.where(valid), "duracao_segundos", {"duracao_mediana_segundos": 0.5}, by=[DAY])
    return means.join(medians, DAY, "left").select(*GOLD_SCHEMAS["kpi_resumo"].fieldNames())


def weighted_rates(silver: DataFrame) -> DataFrame:
    """Ratio-of-sums version of the two daily rates, next to the mean of daily rates."""
    daily = silver.groupBy(DAY).agg(
        F.avg(F.col("foi_resolvido").cast("int")).alias("r"),
        F.avg(F.when(F.col("entrou_kpi"), F.col("kpi_violado").cast("double"))).alias("v"),
        F.count(F.lit(1)).alias("n"), F.count_if("foi_resolvido").alias("nr"),
        F.count_if(F.col("entrou_kpi") & F.col("kpi_violado").isNotNull()).alias("nk"),
        F.count_if(F.col("entrou_kpi") & F.col("kpi_violado")).alias("nv"),
    )
    return daily.agg(
        F.avg("r").alias("taxa_resolucao_media_diaria"),
        C.ratio(F.sum("nr"), F.sum("n")).alias("taxa_resolucao_ponderada"),
        F.avg("v").alias("taxa_kpi_media_diaria"),
        C.ratio(F.sum("nv"), F.sum("nk")).alias("taxa_kpi_ponderada"),
    )


_SETS = [d for d in DAILY_TABLES.values() if d]
_KPI_SET = ("entrou_kpi", "kpi_violado")
_HOUR_SET = ("hora", "dia_semana")


def all_counts(silver: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Every count table of the gold layer from one scan, as one long frame.

    GROUPING SETS counts each grouping in the map tasks before the shuffle. The set a row
    belongs to is told by its grouping id, since a NULL dimension and a rolled-up one look alike.
    """
    base = with_group_bucket(silver, rules).select(
        DAY, *_SETS, *_KPI_SET, F.hour("aberto").alias("hora"), "dia_semana")
    columns = [DAY, *_SETS, *_KPI_SET, *_HOUR_SET]
    sets = [[DAY]] + [[DAY, d] for d in _SETS] + [[DAY, *_KPI_SET], [*_HOUR_SET]]
    return base.groupingSets(
        [[F.col(c) for c in s] for s in sets], *[F.col(c) for c in columns]
    ).agg(F.grouping_id(*[F.col(c) for c in columns]).alias("_set"), F.count(F.lit(1)).alias(TOTAL))


def _set_id(present: list[str]) -> int:
    """Grouping id of a set: one bit per column, set when the column is rolled up."""
    bits = 0
    for c in [DAY, *_SETS, *_KPI_SET, *_HOUR_SET]:
        bits = bits * 2 + (0 if c in present else 1)
    return bits


def count_sets() -> dict[str, list[str]]:
    """Count table -> its keys."""
    daily = {name: [DAY] + ([dimension] if dimension else []) for name, dimension in DAILY_TABLES.items()}
    return {**daily, "incidentes_diario_kpi": [DAY, *_KPI_SET], "incidentes_horario": [*_HOUR_SET]}


def stacked_counts(long: DataFrame) -> DataFrame:
    """(tabela, chave, total_incidentes) of all count tables in one pass over ``all_counts``."""
    table = key = None
    for name, keys in count_sets().items():
        mine = F.col("_set") == _set_id(keys)
        text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in keys])
        table = F.when(mine, F.lit(name)) if table is None else table.when(mine, F.lit(name))
        key = F.when(mine, text) if key is None else key.when(mine, text)
    whole = (F.col("_set") != _set_id([*_HOUR_SET])) | (F.col("hora").isNotNull() & F.col("dia_semana").isNotNull())
    return long.where(whole).select(table.alias("tabela"), key.alias("chave"), TOTAL)


def split_counts(long: DataFrame) -> dict[str, DataFrame]:
    """The count tables back out of ``all_counts``. Write or cache ``long`` first."""
    tables = {name: long.where(F.col("_set") == _set_id(keys)).select(*keys, TOTAL) for name, keys in count_sets().items()}
    tables["incidentes_horario"] = tables["incidentes_horario"].dropna()
    return tables
