"""Frames and comparison CTEs that the registered queries share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketry.functions import text as T
from ticketry.operators import gold, series as TS
from ticketry.plans import tickets_ml as ML
from ticketry.schema import STAND_IN_RULES as R
from ticketry.sources import stand_ins as SI

Query = Callable[[SparkSession, str], DataFrame]


class Catalog:
    """Name -> (query, comparison SQL or None)."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.oracles: dict[str, str] = {}

    def add(self, name: str, query: Query, sql: str | None = None) -> None:
        if name in self.queries:
            raise ValueError(f"query registered twice: {name}")
        self.queries[name] = query
        if sql is not None:
            self.oracles[name] = sql


def rounded(df: DataFrame, digits: int = 6, *columns: str) -> DataFrame:
    """Round the named columns, or every double."""
    names = columns or [f.name for f in df.schema.fields if f.dataType.simpleString() == "double"]
    return df.withColumns({c: F.round(c, digits) for c in names}) if names else df


# -- Spark side --------------------------------------------------------------------------
def volume(spark: SparkSession, folder: str) -> DataFrame:
    return TS.daily_volume(SI.tickets(spark, folder, "data_abertura", "prioridade"), R)


def dense_volume(spark: SparkSession, folder: str) -> DataFrame:
    """The modelled series; the stand-in tickets have days without any, which count as 0."""
    return TS.dense(volume(spark, folder), fill=0)


def modelled(spark: SparkSession, folder: str, *extra: str) -> DataFrame:
    """The classification population with its split."""
    columns = ["numero", "aberto", "data_abertura", "prioridade", "produto", "descricao_resumida", *extra]
    return ML.with_split(ML.population(SI.tickets(spark, folder, *columns), R, extra), R)


def gold_reader(spark: SparkSession, folder: str, outliers: bool = False):
    """Gold and silver tables computed on demand from the stand-in tickets."""
    def read(name: str) -> DataFrame:
        if name == "incidentes_tratados":
            silver = SI.tickets(spark, folder, "prioridade", "grupo_designado", "aberto", "data_abertura", "dia_semana",
                                "duracao_segundos", "duracao_dias")
            if not outliers:
                return silver
            limit = gold.duration_limit(SI.tickets(spark, folder, "duracao_segundos"), R)
            return silver.crossJoin(F.broadcast(limit)).withColumn(
                "duracao_outlier_flag", F.col("duracao_segundos") > F.col("_limit")).drop("_limit")
        if name == "kpi_resumo":
            return gold.kpi_summary(SI.tickets(spark, folder, "data_abertura", "duracao_segundos", "duracao_valida",
                                               "foi_resolvido", "entrou_kpi", "kpi_violado"), R)
        if name == "incidentes_diario_kpi":
            return gold.daily_kpi(SI.tickets(spark, folder, "data_abertura", "entrou_kpi", "kpi_violado"))
        if name == "incidentes_horario":
            return gold.hourly(SI.tickets(spark, folder, "aberto", "dia_semana"))
        dimension = gold.DAILY_TABLES[name]
        if dimension == "grupo_categoria":
            return gold.daily_count(gold.with_group_bucket(SI.tickets(spark, folder, "data_abertura", "grupo_designado"), R), dimension)
        return gold.daily_count(SI.tickets(spark, folder, "data_abertura", *([dimension] if dimension else [])), dimension)
    return read


# -- comparison side ---------------------------------------------------------------------
TICKETS = SI.tickets_cte()
BRONZE = SI.bronze_cte()
EXCLUDED = ", ".join(f"'{p}'" for p in R.excluded_priorities)
CLASSES = ", ".join(f"'{p}'" for p in R.priority_classes)

SILVER = (
    "silver AS (SELECT t.*, duracao_segundos > (SELECT quantile_cont(duracao_segundos, 0.99) FROM tickets) AS duracao_outlier_flag, "
    "CASE WHEN grupo_designado = 'Team14' THEN grupo_designado ELSE 'Outros' END AS grupo_categoria, "
    "cast(extract(hour from aberto) as int) AS hora FROM tickets t)"
)


def daily_cte(name: str, dimension: str | None) -> str:
    keys = "data_abertura" + (f", {dimension}" if dimension else "")
    return f"{name} AS (SELECT {keys}, count(*) AS total_incidentes FROM silver GROUP BY {keys})"


KPI_CTE = "incidentes_diario_kpi AS (SELECT data_abertura, entrou_kpi, kpi_violado, count(*) AS total_incidentes FROM silver GROUP BY ALL)"
HOUR_CTE = "incidentes_horario AS (SELECT hora, dia_semana, count(*) AS total_incidentes FROM silver GROUP BY ALL)"
SUMMARY_CTE = (
    "kpi_resumo AS (SELECT data_abertura, avg(duracao_segundos) FILTER (WHERE duracao_valida) AS duracao_media_segundos, "
    "median(duracao_segundos) FILTER (WHERE duracao_valida) AS duracao_mediana_segundos, "
    "avg(duracao_segundos) FILTER (WHERE duracao_valida AND duracao_segundos <= (SELECT quantile_cont(duracao_segundos, 0.99) FROM silver)) "
    "AS duracao_media_aparada_p99_segundos, avg(cast(foi_resolvido as int)) AS taxa_resolucao, "
    "avg(cast(kpi_violado as int)) FILTER (WHERE entrou_kpi) AS taxa_kpi_violado FROM silver GROUP BY data_abertura)"
)
GOLD_CTES = [daily_cte(n, d) for n, d in gold.DAILY_TABLES.items()] + [KPI_CTE, HOUR_CTE, SUMMARY_CTE]


def with_ctes(body: str, *ctes: str) -> str:
    return f"WITH {', '.join(ctes)} {body}"


def on_tickets(body: str, *ctes: str) -> str:
    return with_ctes(body, TICKETS, *ctes)


def on_silver(body: str, *ctes: str) -> str:
    return with_ctes(body, TICKETS, SILVER, *ctes)


def on_gold(body: str, *ctes: str) -> str:
    return with_ctes(body, TICKETS, SILVER, *GOLD_CTES, *ctes)


def half_up(expression: str, digits: int) -> str:
    """Rounding half away from zero on the decimal value, as a double."""
    return f"cast(round(cast({expression} as decimal(30, 12)), {digits}) as double)"


VOLUME = (
    f"vol AS (SELECT data_abertura, count(*) AS volume_total FROM tickets WHERE data_abertura >= DATE '{R.start}' "
    f"AND prioridade NOT IN ({EXCLUDED}) GROUP BY 1)"
)
GRID = (
    "grid AS (SELECT cast(unnest(generate_series(a, b, INTERVAL 1 DAY)) as date) AS data_abertura "
    "FROM (SELECT min(data_abertura) AS a, max(data_abertura) AS b FROM vol))"
)
SERIES = (
    "serie AS (SELECT 'total' AS serie, g.data_abertura, coalesce(v.volume_total, 0) AS volume_total "
    "FROM grid g LEFT JOIN vol v ON g.data_abertura = v.data_abertura)"
)


def on_series(body: str, *ctes: str) -> str:
    return with_ctes(body, TICKETS, VOLUME, GRID, SERIES, *ctes)


def _months(values) -> str:
    return ", ".join(f"'{m}'" for m in values)


POP = (
    "pop AS (SELECT *, CASE "
    f"WHEN strftime(aberto, '%Y-%m') IN ({_months(R.priority_train_months)}) THEN 'TRAIN' "
    f"WHEN strftime(aberto, '%Y-%m') IN ({_months(R.priority_val_months)}) THEN 'VAL' "
    f"WHEN strftime(aberto, '%Y-%m') IN ({_months(R.priority_test_months)}) THEN 'TEST' END AS split FROM tickets "
    f"WHERE prioridade IN ({CLASSES}) AND aberto >= TIMESTAMP '{R.priority_from}' AND aberto < TIMESTAMP '{R.priority_until}')"
)


def template_sql(column: str) -> str:
    """The template rules for a comparison engine whose word boundary is plain ASCII."""
    out = column
    for pattern, label in T.TEMPLATE_RULES:
        plain = pattern.replace("(?U)", "")
        out = f"regexp_replace({out}, '{plain}', '{label}', 'g')"
    return out


def mode_cte(name: str, source: str, key: str | None, label: str, out: str) -> str:
    """Most frequent label per key, smallest on ties."""
    keys = f"{key}, " if key else ""
    part = f"PARTITION BY {key} " if key else ""
    where = f"WHERE {label} IS NOT NULL" + (f" AND {key} IS NOT NULL" if key else "")
    return (
        f"{name} AS (SELECT {keys}{label} AS {out} FROM (SELECT {keys}{label}, row_number() OVER ({part}ORDER BY count(*) DESC, {label}) AS rn "
        f"FROM {source} {where} GROUP BY {keys}{label}) WHERE rn = 1)"
    )


def on_population(body: str, *ctes: str) -> str:
    return with_ctes(body, TICKETS, POP, "tr AS (SELECT * FROM pop WHERE split = 'TRAIN')",
                     "ev AS (SELECT * FROM pop WHERE split IN ('VAL', 'TEST'))", *ctes)
