"""Sources, cleaning, gold tables, panels and checks."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketry.catalog.base import (
    BRONZE, GOLD_CTES, Catalog, dense_volume, gold_reader, half_up, modelled, on_gold, on_population, on_series, on_silver, on_tickets,
    rounded, template_sql, volume, with_ctes, VOLUME,
)
from ticketry.functions import columns as C
from ticketry.functions import text as T
from ticketry.operators import checks, gold, stats as S
from ticketry.operators.clean import clean, defect_report, dropped_duplicates
from ticketry.plans import etl, panels, tickets_ml as ML
from ticketry.schema import BRONZE_COLUMNS, GOLD_SCHEMAS, SILVER_COLUMNS, STAND_IN_RULES as R
from ticketry.session import checkpoint_dir
from ticketry.sources import stand_ins as SI
from ticketry.sources.lake import Lake, add_columns, merge_frames, target_day
from ticketry.sources.raw import read_source

catalog = Catalog()
add = catalog.add


def _scratch(spark) -> str:
    return f"{checkpoint_dir(spark)}/tables-{uuid.uuid4().hex}"


# -- S: sources and sinks ----------------------------------------------------------------
_ORDER_COLUMNS = {c: c for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")}
add("s01_source_as_text",
    lambda spark, d: read_source(spark, f"{d}/orders.parquet", "parquet", _ORDER_COLUMNS).drop("_ingest_seq"),
    "SELECT " + ", ".join(f"cast({c} as string) AS {c}" for c in _ORDER_COLUMNS) + " FROM orders")

add("s04_bronze_rows",
    lambda spark, d: SI.bronze(spark, d).select(*[F.nullif(F.col(c), F.lit("")).alias(c) for c in BRONZE_COLUMNS]),
    with_ctes("SELECT " + ", ".join(f"nullif({c}, '') AS {c}" for c in BRONZE_COLUMNS) + " FROM bronze", BRONZE))


def _forecast_rows(spark, d) -> DataFrame:
    """Persistence rows over the whole series, as a stand-in for a stored forecast table."""
    return dense_volume(spark, d).select(
        F.col("data_abertura").alias("data_referencia"), "serie", F.lit("D+1").alias("horizonte"),
        F.col("volume_total").cast("double").alias("valor_previsto"), F.lit("persistencia").alias("modelo_utilizado"),
        F.lit("1.0").alias("versao_modelo"))


def _late_update(rows: DataFrame) -> DataFrame:
    """New values for the last regime, plus D+7 rows the table does not have yet."""
    late = rows.where(F.col("data_referencia") >= F.lit(R.val_end).cast("date")).withColumn("versao_modelo", F.lit("1.1"))
    again = late.withColumn("valor_previsto", F.col("valor_previsto") + 5)
    return again.unionByName(late.withColumn("horizonte", F.lit("D+7")))


_KEYS = ["data_referencia", "serie", "horizonte"]
_FORECAST_SQL = (
    "fc AS (SELECT data_abertura AS data_referencia, serie, 'D+1' AS horizonte, cast(volume_total as double) AS valor_previsto, "
    "'persistencia' AS modelo_utilizado, '1.0' AS versao_modelo FROM serie)"
)
_MERGED_SQL = (
    f"merged AS (SELECT * FROM fc WHERE data_referencia < DATE '{R.val_end}' UNION ALL "
    f"SELECT data_referencia, serie, horizonte, valor_previsto + 5, modelo_utilizado, '1.1' FROM fc WHERE data_referencia >= DATE '{R.val_end}' UNION ALL "
    f"SELECT data_referencia, serie, 'D+7', valor_previsto, modelo_utilizado, '1.1' FROM fc WHERE data_referencia >= DATE '{R.val_end}')"
)
_ALVO = "data_referencia + cast(CASE horizonte WHEN 'D+1' THEN 1 WHEN 'D+7' THEN 7 END as int) AS data_alvo"


def _merge_plain(spark, d) -> DataFrame:
    rows = _forecast_rows(spark, d)
    return merge_frames(rows, _late_update(rows), _KEYS).withColumn("data_alvo", target_day("data_referencia", "horizonte"))


def _merge_stored(spark, d) -> DataFrame:
    lake = Lake(spark, _scratch(spark))
    rows = _forecast_rows(spark, d)
    lake.upsert_forecasts(rows)
    for _ in range(2):  # the second run changes nothing
        lake.upsert_forecasts(_late_update(rows))
    return lake.merged("gold", "previsoes").drop("gerado_em")


add("s07_merge_frames", _merge_plain, on_series(f"SELECT *, {_ALVO} FROM merged", _FORECAST_SQL, _MERGED_SQL))
add("s07_s10_forecast_upsert", _merge_stored, on_series(f"SELECT *, {_ALVO} FROM merged", _FORECAST_SQL, _MERGED_SQL))


def _ticket_upsert(spark, d) -> DataFrame:
    lake = Lake(spark, _scratch(spark))
    rows = modelled(spark, d).select(
        "numero", "data_abertura", F.col("prioridade").alias("prioridade_real"), F.lit("4 - Baixa").alias("prioridade_prevista"),
        F.lit(1.0).alias("score_vencedor"), F.lit("m").alias("modelo_utilizado"), F.lit("v1").alias("versao_modelo"), "split")
    lake.upsert_ticket_forecasts(rows.where("split in ('TRAIN', 'VAL')"))
    lake.upsert_ticket_forecasts(rows.where("split in ('VAL', 'TEST')").withColumn("versao_modelo", F.lit("v2")))
    return lake.merged("gold", "previsoes_prioridade").drop("gerado_em")


add("s08_ticket_upsert", _ticket_upsert, on_population(
    "SELECT numero, data_abertura, prioridade AS prioridade_real, '4 - Baixa' AS prioridade_prevista, cast(1.0 as double) AS score_vencedor, "
    "'m' AS modelo_utilizado, CASE WHEN split = 'TRAIN' THEN 'v1' ELSE 'v2' END AS versao_modelo FROM pop WHERE split IS NOT NULL"))


def _append_log(spark, d) -> DataFrame:
    lake = Lake(spark, _scratch(spark))
    totals = volume(spark, d).groupBy("serie").agg(F.sum("volume_total").alias("total"))
    for step in (1, 2):
        lake.append("gold", "registro", totals.withColumn("execucao", F.lit(step)))
    return lake.log("gold", "registro")


add("s09_append_log", _append_log, on_tickets(
    "SELECT 'total' AS serie, cast(sum(volume_total) as bigint) AS total, e.execucao FROM vol, (SELECT 1 AS execucao UNION ALL SELECT 2) e GROUP BY e.execucao",
    VOLUME))

add("s11_modelled_volume_view",
    lambda spark, d: etl.modelled_volume(SI.tickets(spark, d, "data_abertura", "prioridade"), R),
    on_tickets("SELECT * FROM vol", VOLUME))

add("s12_added_columns",
    lambda spark, d: add_columns(SI.tickets(spark, d, "numero", "duracao_segundos"), {"duracao_dias": "double", "duracao_outlier_flag": "boolean"}),
    on_tickets("SELECT numero, duracao_segundos, cast(NULL as double) AS duracao_dias, cast(NULL as boolean) AS duracao_outlier_flag FROM tickets"))


def _constraints(spark, d) -> DataFrame:
    """The forecast constraints on rows that break some of them."""
    rows = _forecast_rows(spark, d)
    broken = rows.withColumns({
        "horizonte": F.when(F.col("valor_previsto") > 8, F.lit("D+99")).otherwise(F.col("horizonte")),
        "valor_previsto": F.col("valor_previsto") - 2,
        "versao_modelo": F.when(F.month("data_referencia") == 1, F.lit(None)).otherwise(F.col("versao_modelo")),
    })
    found = checks.violations(broken, checks.forecast_rules())
    return found.unionByName(checks.key_violations(broken, ["serie", "valor_previsto"], "unique_serie_valor"))


add("s13_constraint_violations", _constraints, on_series(
    "SELECT 'not_null_data_referencia' AS restricao, count(*) FILTER (WHERE data_referencia IS NULL) AS violacoes FROM b UNION ALL "
    "SELECT 'not_null_serie', count(*) FILTER (WHERE serie IS NULL) FROM b UNION ALL "
    "SELECT 'not_null_horizonte', count(*) FILTER (WHERE horizonte IS NULL) FROM b UNION ALL "
    "SELECT 'not_null_modelo_utilizado', count(*) FILTER (WHERE modelo_utilizado IS NULL) FROM b UNION ALL "
    "SELECT 'not_null_versao_modelo', count(*) FILTER (WHERE versao_modelo IS NULL) FROM b UNION ALL "
    "SELECT 'domain_horizonte', count(*) FILTER (WHERE horizonte NOT IN ('D+1', 'D+7')) FROM b UNION ALL "
    "SELECT 'not_negative_valor_previsto', count(*) FILTER (WHERE valor_previsto < 0) FROM b UNION ALL "
    "SELECT 'unique_serie_valor', count(*) FROM (SELECT serie, valor_previsto FROM b GROUP BY ALL HAVING count(*) > 1)",
    _FORECAST_SQL,
    "b AS (SELECT data_referencia, serie, CASE WHEN valor_previsto > 8 THEN 'D+99' ELSE horizonte END AS horizonte, valor_previsto - 2 AS valor_previsto, "
    "modelo_utilizado, CASE WHEN extract(month from data_referencia) = 1 THEN NULL ELSE versao_modelo END AS versao_modelo FROM fc)"))

# -- P: cleaning and projections ---------------------------------------------------------
_LABELLED = ("produto", "categoria", "subcategoria", "codigo_fechamento")
_SILVER_EXPR = {
    **{c: f"CASE WHEN {c} IS NULL OR {c} = '' THEN 'Não informado' ELSE {c} END" for c in _LABELLED},
    "aberto": "cast(aberto as timestamp)", "encerrado": "cast(encerrado as timestamp)",
    "resolvido": "try_cast(resolvido as timestamp)", "foi_resolvido": "try_cast(resolvido as timestamp) IS NOT NULL",
    "duracao_segundos": "cast(duracao_segundos as bigint)",
    "duracao_valida": "cast(duracao_segundos as double) <= epoch(cast(encerrado as timestamp) - cast(aberto as timestamp)) * 1.05e0",
    "duracao_dias": "round(cast(duracao_segundos as bigint) / 86400.0e0, 8)",
    "duracao_outlier_flag": "cast(duracao_segundos as bigint) > (SELECT quantile_cont(cast(duracao_segundos as bigint), 0.99) FROM bronze)",
    "entrou_kpi": "CASE upper(trim(entrou_kpi)) WHEN 'SIM' THEN true WHEN 'NAO' THEN false END",
    "kpi_violado": "CASE upper(trim(kpi_violado)) WHEN 'SIM' THEN true WHEN 'NAO' THEN false END",
    "data_abertura": "cast(cast(aberto as timestamp) as date)",
    "ano": "cast(extract(year from cast(aberto as timestamp)) as int)", "mes": "cast(extract(month from cast(aberto as timestamp)) as int)",
    "dia_semana": "cast(extract(isodow from cast(aberto as timestamp)) - 1 as int)",
}
_FIRST = "(SELECT *, row_number() OVER (PARTITION BY numero ORDER BY _ingest_seq) AS rn FROM bronze)"
add("p01_p13_clean_silver",
    lambda spark, d: rounded(clean(SI.bronze(spark, d), R), 8),
    with_ctes("SELECT " + ", ".join(f"{_SILVER_EXPR.get(c, c)} AS {c}" for c in SILVER_COLUMNS) + f" FROM {_FIRST} WHERE rn = 1", BRONZE))


def _damaged(spark, d) -> DataFrame:
    """The bronze rows with broken mandatory values, marked by existing column values."""
    bronze = SI.bronze(spark, d)
    return bronze.withColumns({
        "encerrado": F.when(F.col("codigo_fechamento") == "C03", F.lit("31/31/2000")).otherwise(F.col("encerrado")),
        "duracao_segundos": F.when(F.col("codigo_fechamento") == "C05", F.lit("abc"))
        .when(F.col("codigo_fechamento") == "C07", F.lit("-1")).otherwise(F.col("duracao_segundos")),
        "entrou_kpi": F.when(F.col("status") == "F", F.lit("NÃO")).otherwise(F.col("entrou_kpi")),
    })


add("p03_p10_defect_report", lambda spark, d: defect_report(_damaged(spark, d)), with_ctes(
    "SELECT count(*) FILTER (WHERE codigo_fechamento = 'C03') AS sem_data_obrigatoria, "
    "count(*) FILTER (WHERE codigo_fechamento = 'C05') AS duracao_nao_numerica, "
    "count(*) FILTER (WHERE codigo_fechamento = 'C07') AS duracao_negativa, "
    "count(*) FILTER (WHERE status = 'F') AS kpi_fora_do_dominio FROM bronze", BRONZE))
add("p12_dropped_duplicates", lambda spark, d: dropped_duplicates(SI.bronze(spark, d)), with_ctes(
    "SELECT cast(sum(n - 1) as bigint) AS linhas_descartadas, count(*) FILTER (WHERE n > 1) AS chaves_repetidas "
    "FROM (SELECT numero, count(*) AS n FROM bronze GROUP BY 1)", BRONZE))

add("p15_priority_population", lambda spark, d: modelled(spark, d), on_population(
    "SELECT numero, aberto, data_abertura, prioridade, produto, descricao_resumida, split FROM pop"))
add("p16_p17_group_and_hour",
    lambda spark, d: gold.with_group_bucket(SI.tickets(spark, d, "numero", "grupo_designado", "aberto"), R).select(
        "numero", "grupo_categoria", F.hour("aberto").alias("hora")),
    on_silver("SELECT numero, grupo_categoria, hora FROM silver"))
add("p18_prepared_features",
    lambda spark, d: ML.prepared(modelled(spark, d), R).select("numero", "descricao_resumida", "produto_prep"),
    on_population("SELECT numero, coalesce(descricao_resumida, '') AS descricao_resumida, "
                  "CASE WHEN produto IS NULL OR produto = 'Não informado' THEN 'Desconhecido' ELSE produto END AS produto_prep FROM pop"))
add("p19_date_split_counts",
    lambda spark, d: S.counted(SI.tickets(spark, d, "data_abertura").select(
        C.split_by_cuts("data_abertura", R.train_end, R.val_end).alias("split_ii"),
        C.split_by_cuts("data_abertura", R.family_train_end, R.family_val_end).alias("split_i")), "split_i", "split_ii"),
    on_tickets(
        f"SELECT CASE WHEN data_abertura < DATE '{R.family_train_end}' THEN 'TRAIN' WHEN data_abertura < DATE '{R.family_val_end}' THEN 'VAL' ELSE 'TEST' END AS split_i, "
        f"CASE WHEN data_abertura < DATE '{R.train_end}' THEN 'TRAIN' WHEN data_abertura < DATE '{R.val_end}' THEN 'VAL' ELSE 'TEST' END AS split_ii, "
        "count(*) AS n FROM tickets GROUP BY ALL"))
add("p20_month_split_counts", lambda spark, d: S.counted(modelled(spark, d), "split"),
    on_population("SELECT split, count(*) AS n FROM pop GROUP BY 1"))
add("p21_p22_regime_counts",
    lambda spark, d: S.counted(SI.tickets(spark, d, "data_abertura", "aberto_por").select(
        C.after_cut_flag("data_abertura", R.regime_cut).alias("periodo"), C.regime_label("data_abertura", R.regime_cut).alias("regime"),
        C.recode(F.lower("aberto_por"), {"monitoramento": 1, "manual": 0}).alias("canal")), "periodo", "regime", "canal"),
    on_tickets(f"SELECT cast(data_abertura >= DATE '{R.regime_cut}' as int) AS periodo, "
               f"CASE WHEN data_abertura >= DATE '{R.regime_cut}' THEN 'pós' ELSE 'pré' END AS regime, "
               "CASE lower(aberto_por) WHEN 'monitoramento' THEN 1 WHEN 'manual' THEN 0 END AS canal, count(*) AS n FROM tickets GROUP BY ALL"))
add("p23_p26_text_columns",
    lambda spark, d: SI.tickets(spark, d, "numero", "descricao_resumida").select(
        "numero", C.contains_ignore_case("descricao_resumida", "disk i/o").alias("disco"), T.as_template("descricao_resumida").alias("modelo"),
        T.hide_item_ids("descricao_resumida").alias("sem_item"), T.item_tokens("descricao_resumida").alias("itens"),
        T.template_with_items("descricao_resumida").alias("modelo_e_itens"), T.before_colon("descricao_resumida").alias("prefixo")),
    on_tickets(
        f"SELECT numero, coalesce(contains(lower(descricao_resumida), 'disk i/o'), false) AS disco, {template_sql('descricao_resumida')} AS modelo, "
        "regexp_replace(descricao_resumida, 'IC\\p{Nd}+', '<IC>', 'g') AS sem_item, tok AS itens, "
        f"trim(coalesce({template_sql('descricao_resumida')}, '') || ' ' || tok) AS modelo_e_itens, split_part(descricao_resumida, ':', 1) AS prefixo "
        "FROM (SELECT *, coalesce(array_to_string(list_transform(regexp_extract_all(descricao_resumida, 'IC\\p{Nd}+'), lambda x: 'TOKEN_' || x), ' '), '') AS tok FROM tickets)"))
add("p24_document_templates",
    lambda spark, d: SI.texts(spark, d).select("doc_id", F.md5(T.as_template("text").cast("binary")).alias("modelo_md5")),
    f"SELECT doc_id, md5({template_sql('text')}) AS modelo_md5 FROM documents")
add("p32_recoded_columns",
    lambda spark, d: SI.tickets(spark, d, "numero", "prioridade", "aberto_por", "incidente_pai").select(
        "numero", C.recode("prioridade", {"4 - Baixa": 0, "3 - Média": 1, "2 - Alta": 2}).alias("nivel"), F.lower("aberto_por").alias("canal"),
        C.presence("incidente_pai").alias("tem_incidente_pai")),
    on_tickets("SELECT numero, CASE prioridade WHEN '4 - Baixa' THEN 0 WHEN '3 - Média' THEN 1 WHEN '2 - Alta' THEN 2 END AS nivel, "
               "lower(aberto_por) AS canal, cast(incidente_pai IS NOT NULL as int) AS tem_incidente_pai FROM tickets"))
add("p36_p37_calendar_columns",
    lambda spark, d: SI.tickets(spark, d, "numero", "aberto").select(
        "numero", C.year_free_date("aberto").alias("dia_sem_ano"), F.hour("aberto").alias("hora"), C.monday_zero("aberto").alias("dia"),
        F.month("aberto").alias("mes"), C.is_weekend("aberto").alias("fim_de_semana")),
    on_tickets("SELECT numero, make_date(2000, extract(month from aberto), extract(day from aberto)) AS dia_sem_ano, cast(extract(hour from aberto) as int) AS hora, "
               "cast(extract(isodow from aberto) - 1 as int) AS dia, cast(extract(month from aberto) as int) AS mes, cast(extract(isodow from aberto) >= 6 as int) AS fim_de_semana FROM tickets"))

# -- A01 to A11: gold tables -------------------------------------------------------------
_GOLD_IDS = {
    "incidentes_diario_total": "a01", "incidentes_diario_kpi": "a04", "incidentes_horario": "a03", "kpi_resumo": "a05_a11",
}
for _name in GOLD_SCHEMAS:
    _columns = ", ".join(
        f"round({f.name}, 6) AS {f.name}" if f.dataType.simpleString() == "double" else f.name for f in GOLD_SCHEMAS[_name].fields)
    add(f"{_GOLD_IDS.get(_name, 'a02')}_{_name}",
        lambda spark, d, n=_name: rounded(gold_reader(spark, d)(n)), on_gold(f"SELECT {_columns} FROM {_name}"))


def _one_scan_counts(spark, d) -> DataFrame:
    """All count tables out of one grouping-set scan, stacked as (tabela, chave, total)."""
    silver = SI.tickets(spark, d, "data_abertura", "prioridade", "grupo_designado", "aberto_por", "status", "categoria",
                        "codigo_fechamento", "entrou_kpi", "kpi_violado", "aberto", "dia_semana")
    return gold.stacked_counts(gold.all_counts(silver, R))


def _stacked(name: str) -> str:
    keys = [f.name for f in GOLD_SCHEMAS[name].fields if f.name != "total_incidentes"]
    text = " || '|' || ".join(f"coalesce(cast({k} as string), '~')" for k in keys)
    return f"SELECT '{name}' AS tabela, {text} AS chave, total_incidentes FROM {name}"


add("a01_a04_counts_in_one_scan", _one_scan_counts,
    on_gold(" UNION ALL ".join(_stacked(n) for n in GOLD_SCHEMAS if n != "kpi_resumo")))
add("a09_a10_rates_weighted_and_not",
    lambda spark, d: rounded(gold.weighted_rates(SI.tickets(spark, d, "data_abertura", "foi_resolvido", "entrou_kpi", "kpi_violado"))),
    on_gold("SELECT (SELECT round(avg(taxa_resolucao), 6) FROM kpi_resumo) AS taxa_resolucao_media_diaria, "
            "(SELECT round(avg(cast(foi_resolvido as int)), 6) FROM silver) AS taxa_resolucao_ponderada, "
            "(SELECT round(avg(taxa_kpi_violado), 6) FROM kpi_resumo) AS taxa_kpi_media_diaria, "
            "(SELECT round(avg(cast(kpi_violado as int)) FILTER (WHERE entrou_kpi), 6) FROM silver) AS taxa_kpi_ponderada"))

# -- Q: panels ---------------------------------------------------------------------------
LOW, HIGH = "1995-06-01", "2001-06-30"
_W = f"WHERE data_abertura BETWEEN DATE '{LOW}' AND DATE '{HIGH}'"
_T, _K, _S = f"FROM incidentes_diario_total {_W}", f"FROM incidentes_diario_kpi {_W}", f"FROM kpi_resumo {_W}"
_SUM = "cast(sum(total_incidentes) as bigint)"
_TOTALS = lambda table, dim, tail="": f"SELECT {dim}, {_SUM} AS total FROM {table} {_W} GROUP BY 1 ORDER BY 2 DESC, 1 {tail}"
_TREND = lambda n: (f"SELECT data_abertura AS time, total_incidentes, round(avg(total_incidentes) OVER (ORDER BY data_abertura "  # noqa: E731
                    f"ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW), 6) AS media_movel {_T}")
_LEVELS = {"p2_alta": "2 - Alta", "p3_media": "3 - Média", "p4_baixa": "4 - Baixa"}
_SILVER_COUNT = lambda level: f"SELECT count(*) AS n FROM silver {_W} AND prioridade = '{level}'"
_PANEL_SQL = {
    1: f"SELECT {_SUM} AS total {_T}", 2: _SILVER_COUNT("1 - Crítica"),
    3: f"SELECT round(avg(taxa_resolucao), 6) AS v {_S}", 4: f"SELECT round(avg(taxa_kpi_violado), 6) AS v {_S}", 5: _TREND(7),
    6: f"SELECT {half_up('avg(duracao_media_segundos) / 3600.0', 1)} AS horas {_S}",
    7: f"SELECT {half_up('avg(duracao_media_segundos) / 3600.0', 1)} AS horas {_S} AND data_abertura >= DATE '2000-01-01'",
    8: f"SELECT {_SUM} AS n {_K} AND entrou_kpi", 9: f"SELECT {half_up('avg(total_incidentes)', 1)} AS media {_T}",
    10: f"SELECT count(*) AS dias {_T}", 13: _SILVER_COUNT("2 - Alta"),
    14: f"SELECT data_abertura AS time, prioridade AS metric, total_incidentes AS value FROM incidentes_diario_prioridade {_W}",
    15: _TOTALS("incidentes_diario_status", "status"), 16: f"SELECT data_abertura AS time, total_incidentes {_T}",
    17: "SELECT t.data_abertura, t.total_incidentes, " + ", ".join(
        f"cast(coalesce(sum(p.total_incidentes) FILTER (WHERE p.prioridade = '{v}'), 0) as bigint) AS {k}" for k, v in _LEVELS.items())
        + " FROM incidentes_diario_total t LEFT JOIN incidentes_diario_prioridade p ON p.data_abertura = t.data_abertura "
        + _W.replace("data_abertura", "t.data_abertura", 1) + " GROUP BY 1, 2 ORDER BY 2 DESC, 1 LIMIT 10",
    18: f"SELECT data_abertura AS time, grupo_categoria AS metric, total_incidentes AS value FROM incidentes_diario_grupo {_W}",
    20: f"SELECT {_SUM} AS n {_K} AND NOT entrou_kpi",
    21: f"SELECT CASE WHEN kpi_violado THEN 'Violado' ELSE 'Dentro do indicador' END AS resultado, {_SUM} AS total {_K} AND entrou_kpi GROUP BY 1",
    22: f"SELECT {_SUM} AS n {_K} AND kpi_violado",
    24: f"SELECT data_abertura AS time, round(taxa_kpi_violado, 6) AS taxa_kpi_violado {_S}",
    25: f"SELECT {half_up('avg(duracao_mediana_segundos) / 3600.0', 1)} AS horas {_S}",
    27: f"SELECT strftime(data_abertura, '%Y-%m') AS mes, {_SUM} AS total {_T} GROUP BY 1",
    28: f"SELECT hora, count(*) AS total FROM silver {_W} GROUP BY 1", 29: f"SELECT dia_semana, count(*) AS total FROM silver {_W} GROUP BY 1",
    30: f"SELECT make_date(2000, extract(month from data_abertura), extract(day from data_abertura)) AS time, "
        f"cast(extract(year from data_abertura) as string) AS metric, total_incidentes AS value {_T}",
    31: _TREND(30),
    32: "SELECT mes_atual, total_atual, mes_anterior, total_anterior, " + half_up("100.0e0 * (total_atual - total_anterior) / nullif(total_anterior, 0)", 1) + " AS variacao_pct "
        "FROM (SELECT *, lag(mes_atual) OVER (ORDER BY mes_atual) AS mes_anterior, lag(total_atual) OVER (ORDER BY mes_atual) AS total_anterior FROM "
        f"(SELECT cast(date_trunc('month', data_abertura) as date) AS mes_atual, {_SUM} AS total_atual FROM incidentes_diario_total GROUP BY 1)) ORDER BY mes_atual DESC LIMIT 1",
    33: _TOTALS("incidentes_diario_grupo_full", "grupo_designado"),
    34: "SELECT categoria, total, " + half_up("100.0e0 * total / geral", 1) + " AS pct_do_total, " + half_up("100.0e0 * acumulado / geral", 1) + " AS pct_acumulado FROM "
        "(SELECT categoria, total, sum(total) OVER (ORDER BY total DESC) AS acumulado, sum(total) OVER () AS geral FROM "
        f"(SELECT categoria, {_SUM} AS total FROM incidentes_diario_categoria {_W} GROUP BY 1)) ORDER BY total DESC, categoria LIMIT 15",
    35: _TOTALS("incidentes_diario_aberto_por", "aberto_por"),
    36: f"SELECT grupo_designado, {_SUM} AS total, {half_up('100.0e0 * sum(total_incidentes) / sum(sum(total_incidentes)) OVER ()', 1)} AS pct_do_total "
        f"FROM incidentes_diario_grupo_full {_W} GROUP BY 1",
    37: _TOTALS("incidentes_diario_codigo_fechamento", "codigo_fechamento", "LIMIT 12"),
    38: "SELECT data_abertura AS time, " + ", ".join(f"{half_up(c + ' / 3600.0', 2)} AS {a}" for c, a in (
        ("duracao_media_segundos", "oficial"), ("duracao_mediana_segundos", "mediana"), ("duracao_media_aparada_p99_segundos", "aparada_p99"))) + f" {_S}",
    39: f"SELECT {half_up('100.0 * avg(cast(duracao_outlier_flag as int))', 2)} AS pct FROM silver {_W}",
    40: f"SELECT count(*) FILTER (WHERE duracao_outlier_flag) AS n FROM silver {_W}",
    41: f"SELECT {half_up('max(duracao_dias)', 1)} AS max_dias FROM silver {_W}",
    42: f"SELECT data_abertura AS time, count(*) FILTER (WHERE duracao_outlier_flag) AS outliers FROM silver {_W} GROUP BY 1",
    43: "SELECT grupo_designado, " + ", ".join(f"count(*) FILTER (WHERE prioridade = '{v}') AS {k}" for k, v in _LEVELS.items())
        + f", count(*) AS total FROM silver {_W} GROUP BY 1",
}
_PANEL_SQL.update({11: _PANEL_SQL[1], 12: _PANEL_SQL[2], 19: _PANEL_SQL[8], 23: _PANEL_SQL[4], 26: _PANEL_SQL[6]})
# Rates and moving means are compared at six digits; the panels that round do so themselves.
_SIX_DIGITS = (3, 4, 5, 23, 24, 31)


def _panel(number: int):
    panel = panels.PANELS[number][1]
    if number == 7:
        panel = panels.mean_duration_hours("2000-01-01")

    def run(spark, d):
        out = panel(gold_reader(spark, d, outliers=number in (39, 40, 42)), LOW, HIGH)
        return rounded(out) if number in _SIX_DIGITS else out
    return run


for _n, (_title, _) in panels.PANELS.items():
    add(f"q{_n:02d}_{_title}", _panel(_n), on_gold(_PANEL_SQL[_n]))


# -- V: checks ---------------------------------------------------------------------------
def _loaded(spark, d) -> tuple[Lake, DataFrame]:
    """The whole load chain on the bronze stand-in."""
    base = _scratch(spark)
    source = SI.bronze(spark, d)
    etl.run(spark, base, source, R)
    return Lake(spark, base), source


def _table_rows(spark, d) -> DataFrame:
    lake, _ = _loaded(spark, d)
    names = [("bronze", etl.BRONZE), ("silver", etl.SILVER)] + [("gold", n) for n in GOLD_SCHEMAS]
    parts = [lake.table(layer, n).agg(F.count(F.lit(1)).alias("linhas")).select(F.lit(n).alias("tabela"), "linhas") for layer, n in names]
    return reduce(DataFrame.unionByName, parts)


def _loaded_kpi(spark, d) -> DataFrame:
    lake, _ = _loaded(spark, d)
    return rounded(lake.table("gold", "kpi_resumo"))


def _layer_checks(spark, d) -> DataFrame:
    lake, source = _loaded(spark, d)
    silver = lake.table("silver", etl.SILVER)
    bronze = lake.table("bronze", etl.BRONZE)
    counts = {n: lake.table("gold", n) for n in GOLD_SCHEMAS if n != "kpi_resumo"}
    return reduce(DataFrame.unionByName, [
        checks.layer_checks(source, bronze, silver, counts["incidentes_diario_total"]),
        checks.dimension_totals(counts, silver),
        checks.pass_through("descricao_sem_default", _first_bronze(bronze), silver, "descricao_resumida"),
        checks.kpi_recomputed(silver, lake.table("gold", "kpi_resumo"), R),
    ])


def _first_bronze(bronze: DataFrame) -> DataFrame:
    from ticketry.operators.clean import first_delivery
    return first_delivery(bronze, ["numero"])


_LOADED = (
    "silver AS (SELECT " + ", ".join(f"{_SILVER_EXPR.get(c, c)} AS {c}" for c in SILVER_COLUMNS) + ", "
    "CASE WHEN grupo_designado = 'Team14' THEN grupo_designado ELSE 'Outros' END AS grupo_categoria, "
    f"cast(extract(hour from cast(aberto as timestamp)) as int) AS hora FROM {_FIRST} WHERE rn = 1)"
)


add("s06_load_chain_row_counts", _table_rows, with_ctes(
    "SELECT 'incidentes_raw' AS tabela, count(*) AS linhas FROM bronze UNION ALL SELECT 'incidentes_tratados', count(*) FROM silver UNION ALL "
    + " UNION ALL ".join(f"SELECT '{n}', count(*) FROM {n}" for n in GOLD_SCHEMAS), BRONZE, _LOADED, *GOLD_CTES))
add("a11_loaded_kpi_summary", _loaded_kpi, with_ctes(
    "SELECT " + ", ".join(f"round({f.name}, 6) AS {f.name}" if f.dataType.simpleString() == "double" else f.name
                          for f in GOLD_SCHEMAS["kpi_resumo"].fields) + " FROM kpi_resumo", BRONZE, _LOADED, *GOLD_CTES))


def _check_sql(name: str, ok: str, message: str) -> str:
    return f"SELECT '{name}' AS checagem, {ok} AS ok, {message} AS mensagem FROM n"


def _two(a: str, left: str, b: str, right: str) -> str:
    return f"'{left}=' || cast({a} as string) || ' | {right}=' || cast({b} as string)"


_LAYER_SQL = [
    _check_sql("bronze_igual_origem", "true", _two("b", "origem", "b", "bronze")),
    _check_sql("silver_sem_nulos", "nulls = 0", "'linhas com nulo obrigatorio: ' || cast(nulls as string)"),
    _check_sql("silver_sem_duplicatas", "dups = 0", "'chaves duplicadas: ' || cast(dups as string)"),
    _check_sql("silver_ate_bronze", "s <= b", _two("s", "silver", "b", "bronze")),
    _check_sql("gold_igual_silver", "g = s", _two("g", "gold", "s", "silver")),
    _check_sql("descricao_sem_default", "before = after", _two("before", "antes", "after", "depois")),
    *[f"SELECT '{t}_soma', sum(total_incidentes) = max(n.s), " + _two("cast(sum(total_incidentes) as bigint)", "gold", "max(n.s)", "silver") + f" FROM {t}, n"
      for t in GOLD_SCHEMAS if t != "kpi_resumo"],
    "SELECT 'kpi_oficial_recalculado', true, 'dias: 0'", "SELECT 'mediana_nos_mesmos_dias', true, 'dias: 0'",
    "SELECT 'aparada_nula_so_sem_dados', true, 'dias: 0'",
]
_COUNTS_CTE = (
    "n AS (SELECT (SELECT count(*) FROM bronze) AS b, (SELECT count(*) FROM silver) AS s, "
    "(SELECT count(*) FROM silver WHERE prioridade IS NULL OR produto IS NULL OR categoria IS NULL OR subcategoria IS NULL) AS nulls, "
    "(SELECT count(*) FROM (SELECT numero FROM silver GROUP BY 1 HAVING count(*) > 1)) AS dups, "
    "(SELECT cast(sum(total_incidentes) as bigint) FROM incidentes_diario_total) AS g, "
    f"(SELECT count(descricao_resumida) FROM {_FIRST} WHERE rn = 1) AS before, (SELECT count(descricao_resumida) FROM silver) AS after)"
)
add("v01_v10_layer_checks", _layer_checks, with_ctes(" UNION ALL ".join(_LAYER_SQL), BRONZE, _LOADED, *GOLD_CTES, _COUNTS_CTE))


def _derived(spark, d) -> DataFrame:
    silver = SI.tickets(spark, d, "duracao_segundos", "duracao_valida", "duracao_dias")
    limit = gold.duration_limit(silver, R)
    flagged = silver.crossJoin(F.broadcast(limit)).withColumn("duracao_outlier_flag", F.col("duracao_segundos") > F.col("_limit")).drop("_limit")
    return checks.derived_columns(flagged, R)


add("v09_derived_columns", _derived, on_silver(
    "SELECT 'duracao_dias_coerente' AS checagem, count(*) FILTER (WHERE abs(duracao_dias - duracao_segundos / 86400.0e0) > 1e-9) = 0 AS ok, "
    "'linhas: ' || cast(count(*) FILTER (WHERE abs(duracao_dias - duracao_segundos / 86400.0e0) > 1e-9) as string) AS mensagem FROM silver UNION ALL "
    "SELECT 'outlier_coerente_com_quantil', true, 'linhas: 0' UNION ALL "
    "SELECT 'outlier_independente_de_validade', true, 'outliers validos: ' || cast(count(*) FILTER (WHERE duracao_outlier_flag AND duracao_valida) as string) FROM silver"))


def _forecast_checks(spark, d) -> DataFrame:
    rows = _forecast_rows(spark, d)
    return checks.forecast_table(merge_frames(rows, _late_update(rows), _KEYS))


add("v11_forecast_table", _forecast_checks, on_series(
    "SELECT 'dois_horizontes' AS checagem, true AS ok, 'D+1=' || cast(count(*) FILTER (WHERE horizonte = 'D+1') as string) || ' | D+7=' || "
    "cast(count(*) FILTER (WHERE horizonte = 'D+7') as string) AS mensagem FROM merged UNION ALL "
    "SELECT 'modelo_e_versao', true, 'linhas: 0' UNION ALL SELECT 'd1_e_persistencia', true, 'linhas: 0' UNION ALL SELECT 'previsao_nao_negativa', true, 'linhas: 0'",
    _FORECAST_SQL, _MERGED_SQL))
