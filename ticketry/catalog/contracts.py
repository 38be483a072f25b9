"""Column contracts, broken forecast rows, finalists of both horizons, and sketches over real ranges."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketry.catalog.base import Catalog, dense_volume, gold_reader, on_gold, on_series, on_tickets
from ticketry.catalog.learning import _on_path
from ticketry.operators import checks, gold, novelty, series as TS, sketches as SK
from ticketry.plans import volume as V
from ticketry.schema import GOLD_SCHEMAS, STAND_IN_RULES as R
from ticketry.sources import raw, stand_ins as SI

catalog = Catalog()
add = catalog.add


# -- contracts -----------------------------------------------------------------------------------
#: A contract that the orders table breaks on both sides.
WANTED = ("o_orderkey", "o_custkey", "o_orderstatus", "o_total", "o_orderdate")


def _differences(spark, d) -> DataFrame:
    """Columns that a contract misses or does not know, with the rows of those that are there."""
    orders = spark.read.parquet(f"{d}/orders.parquet")
    missing, extra = raw.column_differences(orders.columns, list(WANTED))
    parts = [orders.agg(F.lit(c).alias("coluna"), F.lit("ausente").alias("situacao"), F.lit(0).cast("long").alias("preenchidos")) for c in missing]
    parts += [orders.agg(F.lit(c).alias("coluna"), F.lit("inesperada").alias("situacao"), F.count(c).alias("preenchidos")) for c in extra]
    return reduce(DataFrame.unionByName, parts)


_WANTED = ", ".join(f"'{c}'" for c in WANTED)
add("s02_contract_differences", _differences,
    f"WITH c AS (SELECT column_name AS coluna FROM (DESCRIBE SELECT * FROM orders)), f AS (SELECT 'o_totalprice' AS coluna, count(o_totalprice) AS n FROM orders UNION ALL SELECT 'o_orderpriority', count(o_orderpriority) FROM orders) "
    f"SELECT w.coluna, 'ausente' AS situacao, 0::BIGINT AS preenchidos FROM (SELECT unnest([{_WANTED}]) AS coluna) w WHERE w.coluna NOT IN (SELECT coluna FROM c) "
    f"UNION ALL SELECT c.coluna, 'inesperada', f.n FROM c LEFT JOIN f USING (coluna) WHERE c.coluna NOT IN ({_WANTED})")
add("s03_renamed_source", lambda spark, d: raw.read_source(spark, f"{d}/labels.parquet", "parquet", {"toxic": "toxico", "doc_id": "numero", "quality": "qualidade"}).drop(raw.INGEST_SEQ),
    "SELECT cast(toxic as varchar) AS toxico, cast(doc_id as varchar) AS numero, cast(quality as varchar) AS qualidade FROM labels")
add("p38_trimmed_names", lambda spark, d: raw.without(raw.trimmed(spark.read.parquet(f"{d}/labels.parquet").toDF(" doc_id", "quality  ", " toxic ")), ["toxic"]), "SELECT doc_id, quality FROM labels")


def _allowed(spark, d) -> DataFrame:
    """Filled rows of the columns that may be features: what the guard refuses is left out one by one."""
    tickets = SI.tickets(spark, d)

    def passes(c: str) -> bool:
        try:
            novelty.require_no_leakage([c])
        except ValueError:
            return False
        return True

    names = [c for c in tickets.columns if passes(c)]
    row = tickets.agg(*[F.count(c).alias(c) for c in names])
    return row.select(F.inline(F.array(*[F.struct(F.lit(c).alias("coluna"), F.col(c).alias("preenchidos")) for c in names])))


# Fixed here as the comparison's own list: what stands in a ticket before its outcome is known.
_KNOWN_EARLY = ("numero", "prioridade", "produto", "grupo_designado", "item_configuracao", "descricao_resumida", "aberto", "aberto_por", "data_abertura", "ano", "mes", "dia_semana")
add("p28_columns_without_leakage", _allowed, on_tickets(" UNION ALL ".join(f"SELECT '{c}' AS coluna, count({c}) AS preenchidos FROM tickets" for c in _KNOWN_EARLY)))


def _schemas(spark, d) -> DataFrame:
    """Each count table of gold against its contract, and its rows."""
    read = gold_reader(spark, d)
    parts = []
    for name in gold.DAILY_TABLES:
        table = read(name)
        wrong = checks.schema_differences(table, GOLD_SCHEMAS[name])
        swapped = checks.schema_differences(table.select(*reversed(table.columns)).withColumn("total_incidentes", F.col("total_incidentes").cast("int")), GOLD_SCHEMAS[name])
        parts.append(table.agg(F.lit(name).alias("tabela"), F.lit(len(wrong)).cast("long").alias("diferencas"), F.lit(len(swapped)).cast("long").alias("diferencas_trocada"), F.count(F.lit(1)).alias("linhas")))
    return reduce(DataFrame.unionByName, parts)


add("v13_gold_schemas", _schemas, on_gold(" UNION ALL ".join(
    f"SELECT '{name}' AS tabela, 0::BIGINT AS diferencas, 2::BIGINT AS diferencas_trocada, count(*) AS linhas FROM {name}" for name in gold.DAILY_TABLES)))


# -- checks that must turn red -----------------------------------------------------------------------
def _broken_forecasts(spark, d) -> DataFrame:
    """Persistence rows of which some lost their model, some are negative and some D+1 rows come from another model."""
    series = dense_volume(spark, d)
    rows = V.persistence_rows(series, series)
    day = F.dayofmonth("data_referencia")
    broken = rows.withColumns({
        "modelo_utilizado": F.when(day == 3, F.lit(" ")).when(day == 4, F.lit("ridge_d7")).otherwise(F.col("modelo_utilizado")),
        "versao_modelo": F.when(day == 5, F.lit(None).cast("string")).otherwise(F.col("versao_modelo")),
        "valor_previsto": F.when(day == 6, -F.col("valor_previsto") - 1).otherwise(F.col("valor_previsto"))})
    return checks.forecast_table(broken)


_DAY = "day(data_abertura)"
add("v11_broken_forecasts_are_found", _broken_forecasts, on_series(
    "SELECT 'dois_horizontes' AS checagem, false AS ok, 'D+1=' || count(*)::VARCHAR || ' | D+7=0' AS mensagem FROM serie UNION ALL "
    f"SELECT 'modelo_e_versao', count(*) = 0, 'linhas: ' || count(*)::VARCHAR FROM serie WHERE {_DAY} IN (3, 5) UNION ALL "
    f"SELECT 'd1_e_persistencia', count(*) = 0, 'linhas: ' || count(*)::VARCHAR FROM serie WHERE {_DAY} IN (3, 4) UNION ALL "
    f"SELECT 'previsao_nao_negativa', count(*) = 0, 'linhas: ' || count(*)::VARCHAR FROM serie WHERE {_DAY} = 6"))


def _broken_ticket_forecasts(spark, d) -> DataFrame:
    """Tickets scored with their own class; by the day some have no real class, no model, or a class that is none of the model's."""
    day = F.dayofmonth("data_abertura")
    rows = SI.tickets(spark, d, "numero", "data_abertura", "prioridade").select(
        "numero", F.when(day != 3, F.col("prioridade")).alias("prioridade_real"), F.col("prioridade").alias("prioridade_prevista"),
        F.when(day != 4, F.lit("m")).alias("modelo_utilizado"), F.lit("v1").alias("versao_modelo"))
    return checks.ticket_forecast_table(rows, R)


_CLASSES = ", ".join(f"'{c}'" for c in R.priority_classes)
add("v14_broken_ticket_forecasts_are_found", _broken_ticket_forecasts, on_tickets(
    "SELECT 'tabela_nao_vazia' AS checagem, count(*) > 0 AS ok, 'linhas: ' || count(*)::VARCHAR AS mensagem FROM tickets UNION ALL "
    f"SELECT 'classe_real_presente', count(*) = 0, 'linhas: ' || count(*)::VARCHAR FROM tickets WHERE {_DAY} = 3 OR prioridade IS NULL UNION ALL "
    f"SELECT 'modelo_e_versao', count(*) = 0, 'linhas: ' || count(*)::VARCHAR FROM tickets WHERE {_DAY} = 4 UNION ALL "
    f"SELECT 'classe_prevista_valida', count(*) = 0, 'linhas: ' || count(*)::VARCHAR FROM tickets WHERE prioridade NOT IN ({_CLASSES})"))


# -- finalists -----------------------------------------------------------------------------------------
def _finalists(spark, d) -> DataFrame:
    """Naive, the production penalty and a strong one, on both horizons."""
    exps = [e for h, columns in (("D+1", R.lag_columns), ("D+7", R.d7_features)) for e in (
        V.VolumeExperiment("naive", (), V.Regressor("naive", naive="naive_d1" if h == "D+1" else "naive_d7"), h), *V.alpha_grid(columns, (R.ridge_alpha, 100), h))]
    out = V.finalists(V.experiment_table(TS.with_naive(TS.volume_dataset(dense_volume(spark, d), R)), exps, R))
    return out.withColumn("delta_val_test", F.round("delta_val_test", 3))


_FIN = (f"SELECT 'ridge_' || n AS experimento, horizonte, 'ridge' AS modelo, data_abertura, y, greatest(0, b + list_sum(list_transform(w, lambda v, i: v * x[i]))) AS p FROM h JOIN c USING (horizonte) "
        f"JOIN (SELECT unnest([{R.ridge_alpha}, 100])::DOUBLE AS alpha, unnest(['{R.ridge_alpha}', '100']) AS n) USING (alpha) "
        "UNION ALL SELECT 'naive', 'D+1', 'naive', data_abertura, y1, v FROM nv WHERE lag_28 IS NOT NULL UNION ALL SELECT 'naive', 'D+7', 'naive', data_abertura, y7, lag_6 FROM nv WHERE lag_28 IS NOT NULL")
add("m14_finalists_of_both_horizons", _finalists, _on_path(
    "SELECT experimento, horizonte, 'II' AS estrategia, modelo, val_mae, test_mae, round(test_mae - val_mae, 3) AS delta_val_test, val_mae <= min(val_mae) OVER (PARTITION BY horizonte) * 1.03 AS equivalente_ao_melhor FROM ("
    f"SELECT experimento, horizonte, modelo, round(avg(abs(y - p)) FILTER (WHERE data_abertura >= DATE '{R.train_end}' AND data_abertura < DATE '{R.val_end}'), 3) AS val_mae, "
    f"round(avg(abs(y - p)) FILTER (WHERE data_abertura >= DATE '{R.val_end}'), 3) AS test_mae FROM ("
    "WITH nv AS (SELECT data_abertura, volume_total AS v, lag(volume_total, 6) OVER w AS lag_6, lag(volume_total, 28) OVER w AS lag_28, lead(volume_total, 1) OVER w AS y1, lead(volume_total, 7) OVER w AS y7 "
    f"FROM serie WINDOW w AS (ORDER BY data_abertura)) {_FIN}) WHERE y IS NOT NULL GROUP BY 1, 2, 3)"))


# -- sketches over ranges -----------------------------------------------------------------------------------
_PROBS = (0.25, 0.5, 0.9, 0.99)


def _yearly(spark, d) -> tuple[DataFrame, DataFrame]:
    rows = SI.tickets(spark, d, "numero", "data_abertura", "duracao_segundos", "item_configuracao")
    daily = SK.daily(rows, ["data_abertura"], ["duracao_segundos"], ["numero", "item_configuracao"])
    return rows.withColumn("ano", F.year("data_abertura")), SK.over(daily, [F.year("data_abertura").alias("ano")])


def _range_quantiles(spark, d) -> DataFrame:
    """Per year, from daily sketches: tickets, values seen, and whether the rank of each quantile is within its bound."""
    rows, merged = _yearly(spark, d)
    found = merged.select("ano", "n", SK.values_seen("duracao_segundos").cast("long").alias("valores"), F.explode(F.array(*[
        F.struct(F.lit(p).alias("p"), SK.quantile("duracao_segundos", p).alias("q")) for p in _PROBS])).alias("e")).select("ano", "n", "valores", "e.p", "e.q")
    v = F.col("duracao_segundos")
    ranks = rows.join(F.broadcast(found), "ano").groupBy("ano", "n", "valores", "p").agg((F.count_if(v < F.col("q")) / F.count(v)).alias("a"), (F.count_if(v <= F.col("q")) / F.count(v)).alias("b"))
    return ranks.select("ano", "n", "valores", "p", ((F.col("a") <= F.col("p") + SK.RANK_ERROR) & (F.col("b") >= F.col("p") - SK.RANK_ERROR)).alias("no_limite"))


add("a05_quantiles_from_daily_sketches", _range_quantiles, on_tickets(
    f"SELECT year(data_abertura)::INT AS ano, count(*) AS n, count(duracao_segundos) AS valores, unnest([{', '.join(map(str, _PROBS))}])::DOUBLE AS p, true AS no_limite FROM tickets GROUP BY 1"))


def _range_distinct(spark, d) -> DataFrame:
    """Per year and column: exact distinct values beside whether the merged sketches are within their bound of them."""
    rows, merged = _yearly(spark, d)
    columns = ["numero", "item_configuracao"]
    exact = rows.groupBy("ano").agg(*[F.count_distinct(c).alias(c) for c in columns])
    both = exact.join(merged.select("ano", *[SK.distinct(c).alias(f"_{c}") for c in columns]), "ano")
    return both.select("ano", F.inline(F.array(*[F.struct(F.lit(c).alias("coluna"), F.col(c).alias("distintos"), (F.abs(F.col(f"_{c}") - F.col(c)) <= SK.DISTINCT_ERROR * F.col(c)).alias("no_limite")) for c in columns])))


add("a24_distinct_from_daily_sketches", _range_distinct, on_tickets(" UNION ALL ".join(
    f"SELECT year(data_abertura)::INT AS ano, '{c}' AS coluna, count(DISTINCT {c}) AS distintos, true AS no_limite FROM tickets GROUP BY 1" for c in ("numero", "item_configuracao"))))
