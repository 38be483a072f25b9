"""Series, statistics, quality measures, novelty, baselines and alerts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketry.catalog.base import (
    Catalog, VOLUME, dense_volume, mode_cte, modelled, on_population, on_series, on_tickets, rounded,
    template_sql, volume, with_ctes,
)
from ticketry.functions import columns as C
from ticketry.functions import text as T
from ticketry.operators import alerts, baselines as B, checks, metrics as M, novelty as N, quantiles as Q, series as TS, stats as S
from ticketry.operators.alerts import (
    error_above_expected, error_threshold, forecast_above_normal, notifications, real_against_forecast, volume_threshold,
)
from ticketry.operators.lookups import digested
from ticketry.plans import tickets_ml as ML
from ticketry.schema import STAND_IN_RULES as R
from ticketry.sources import stand_ins as SI
from ticketry.sources.lake import target_day

catalog = Catalog()
add = catalog.add

CLASSES = list(R.priority_classes)


# -- W: series ---------------------------------------------------------------------------
def _lags_sql(column: str = "volume_total") -> str:
    return ", ".join(f"lag({column}, {k}) OVER (ORDER BY data_abertura) AS lag_{k}" for k in R.lags)


add("a12_w01_dense_volume", dense_volume, on_series("SELECT * FROM serie"))
add("w01_missing_days", lambda spark, d: TS.missing_days(volume(spark, d)),
    on_tickets("SELECT 'total' AS serie, data_abertura FROM grid WHERE data_abertura NOT IN (SELECT data_abertura FROM vol)", VOLUME,
               "grid AS (SELECT cast(unnest(generate_series(a, b, INTERVAL 1 DAY)) as date) AS data_abertura FROM (SELECT min(data_abertura) AS a, max(data_abertura) AS b FROM vol))"))
add("w02_w14_volume_features", lambda spark, d: TS.volume_features(dense_volume(spark, d), R),
    on_series(f"SELECT * FROM (SELECT serie, data_abertura, {_lags_sql()}, cast(data_abertura >= DATE '{R.regime_cut}' as int) AS periodo_pos_set_2025 FROM serie) WHERE lag_28 IS NOT NULL"))
add("w03_targets", lambda spark, d: TS.with_targets(dense_volume(spark, d)),
    on_series("SELECT *, lead(volume_total, 1) OVER (ORDER BY data_abertura) AS target_d1, lead(volume_total, 7) OVER (ORDER BY data_abertura) AS target_d7 FROM serie"))


def _rolling_sql() -> str:
    parts = []
    for w in (7, 14, 28):
        over = f"OVER (ORDER BY data_abertura ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING)"
        parts.append(f"CASE WHEN count(volume_total) {over} = {w} THEN avg(volume_total) {over} END AS rolling_mean_{w}")
        parts.append(f"CASE WHEN count(volume_total) {over} = {w} THEN stddev_samp(volume_total) {over} END AS rolling_std_{w}")
    return ", ".join(parts)


add("w04_rolling_windows", lambda spark, d: rounded(TS.with_rolling(dense_volume(spark, d))),
    on_series("SELECT serie, data_abertura, volume_total, " + ", ".join(f"round(rolling_{s}_{w}, 6) AS rolling_{s}_{w}" for w in (7, 14, 28) for s in ("mean", "std"))
              + ", round(rolling_mean_7 - lag(rolling_mean_7, 7) OVER (ORDER BY data_abertura), 6) AS trend_7d FROM r", f"r AS (SELECT *, {_rolling_sql()} FROM serie)"))
add("w05_pareto_all_classes",
    lambda spark, d: S.pareto(S.counted(SI.tickets(spark, d, "categoria"), "categoria", out="total"), "categoria", "total"),
    on_tickets("SELECT categoria, total, cast(round(cast(100.0e0 * total / sum(total) OVER () as decimal(30, 12)), 1) as double) AS pct_do_total, "
               "cast(round(cast(100.0e0 * sum(total) OVER (ORDER BY total DESC) / sum(total) OVER () as decimal(30, 12)), 1) as double) AS pct_acumulado "
               "FROM (SELECT categoria, count(*) AS total FROM tickets GROUP BY 1)"))
add("w07_trailing_means_by_event_type",
    lambda spark, d: rounded(TS.trailing_mean(S.counted(SI.signals(spark, d), "tipo", "data_abertura", out="total"), "total", 7, ["tipo"])),
    with_ctes("SELECT tipo, data_abertura, total, round(avg(total) OVER (PARTITION BY tipo ORDER BY data_abertura ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 6) AS media_movel_7 "
              "FROM (SELECT tipo, data_abertura, count(*) AS total FROM signals GROUP BY ALL)", SI.SIGNALS_CTE))
add("w09_centred_mean", lambda spark, d: rounded(TS.centred_mean(dense_volume(spark, d))),
    on_series("SELECT *, round(CASE WHEN count(*) OVER w = 7 THEN avg(volume_total) OVER w END, 6) AS media_centrada_7 FROM serie "
              "WINDOW w AS (ORDER BY data_abertura ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)"))
add("w10_latest_ticket_per_group",
    lambda spark, d: S.latest_by(SI.tickets(spark, d, "grupo_designado", "aberto", "numero").withColumn(
        "_pos", F.struct("aberto", "numero")), ["grupo_designado"], "_pos").drop("_pos"),
    on_tickets("SELECT grupo_designado, aberto, numero FROM (SELECT grupo_designado, aberto, numero, row_number() OVER "
               "(PARTITION BY grupo_designado ORDER BY aberto DESC, numero DESC) AS rn FROM tickets) WHERE rn = 1"))
add("w11_naive_forecasts", lambda spark, d: TS.with_naive(dense_volume(spark, d)),
    on_series("SELECT *, volume_total AS naive_d1, lag(volume_total, 6) OVER (ORDER BY data_abertura) AS naive_d7 FROM serie"))
add("w13_last_day_features", lambda spark, d: TS.last_day(TS.volume_features(dense_volume(spark, d), R)),
    on_series(f"SELECT serie, data_abertura, {_lags_sql()}, cast(data_abertura >= DATE '{R.regime_cut}' as int) AS periodo_pos_set_2025 FROM serie ORDER BY data_abertura DESC LIMIT 1"))
add("w02_event_type_lags",
    lambda spark, d: TS.with_lags(TS.dense(S.counted(SI.signals(spark, d).withColumnRenamed("tipo", "serie"), "serie", "data_abertura", out="volume_total"), 0), (1, 7)),
    with_ctes("SELECT *, lag(volume_total, 1) OVER w AS lag_1, lag(volume_total, 7) OVER w AS lag_7 FROM (SELECT g.serie, g.data_abertura, coalesce(c.volume_total, 0) AS volume_total FROM "
              "(SELECT tipo AS serie, cast(unnest(generate_series(a, b, INTERVAL 1 DAY)) as date) AS data_abertura FROM (SELECT tipo, min(data_abertura) AS a, max(data_abertura) AS b FROM signals GROUP BY 1)) g "
              "LEFT JOIN (SELECT tipo AS serie, data_abertura, count(*) AS volume_total FROM signals GROUP BY ALL) c USING (serie, data_abertura)) "
              "WINDOW w AS (PARTITION BY serie ORDER BY data_abertura)", SI.SIGNALS_CTE))

# -- A13 to A16: composition, regimes, thresholds ------------------------------------------
LEVELS = {"baixa": "4 - Baixa", "media": "3 - Média", "alta": "2 - Alta"}
_COMPOSITION_SQL = (
    "comp AS (SELECT data_abertura, count(*) AS volume_total, "
    + ", ".join(f"count(*) FILTER (WHERE prioridade = '{v}') AS volume_p_{k}" for k, v in LEVELS.items())
    + ", count(*) FILTER (WHERE lower(aberto_por) = 'monitoramento') AS volume_monitoramento, count(*) FILTER (WHERE lower(aberto_por) = 'manual') AS volume_manual, "
      f"count(incidente_pai) AS volume_incidente_pai FROM tickets WHERE prioridade IN ({', '.join(repr(c) for c in CLASSES)}) GROUP BY 1)"
)


def composition(spark, d) -> DataFrame:
    rows = SI.tickets(spark, d, "data_abertura", "prioridade", "aberto_por", "incidente_pai").where(F.col("prioridade").isin(*CLASSES))
    return TS.composition(rows, LEVELS, "monitoramento", "manual")


add("a13_daily_composition", lambda spark, d: rounded(composition(spark, d)), on_tickets(
    "SELECT *, " + ", ".join(f"round(volume_p_{k} / volume_total, 6) AS share_p_{k}" for k in LEVELS)
    + ", round(volume_monitoramento / volume_total, 6) AS share_monitoramento, round(volume_incidente_pai / volume_total, 6) AS share_incidente_pai FROM comp", _COMPOSITION_SQL))
add("v12_composition_adds_up", lambda spark, d: checks.composition_adds_up(composition(spark, d), list(LEVELS)),
    on_tickets("SELECT 'prioridades_somam_total' AS checagem, count(*) FILTER (WHERE volume_p_baixa + volume_p_media + volume_p_alta <> volume_total) = 0 AS ok, "
               "'dias: ' || cast(count(*) FILTER (WHERE volume_p_baixa + volume_p_media + volume_p_alta <> volume_total) as string) AS mensagem FROM comp UNION ALL "
               "SELECT 'canais_somam_total', count(*) FILTER (WHERE volume_monitoramento + volume_manual <> volume_total) = 0, "
               "'dias: ' || cast(count(*) FILTER (WHERE volume_monitoramento + volume_manual <> volume_total) as string) FROM comp", _COMPOSITION_SQL))


def _regime_side(which: str, test: str) -> str:
    v = "cast(volume_total as double)"
    return (f"(SELECT unnest(['n_dias', 'media', 'desvio', 'mediana', 'minimo', 'maximo']) AS estatistica, unnest([cast(count(*) as double), avg({v}), stddev_samp({v}), "
            f"median({v}), min({v}), max({v})]) AS {which} FROM serie WHERE data_abertura {test} DATE '{R.regime_cut}')")


add("a14_regime_statistics", lambda spark, d: rounded(TS.regime_stats(dense_volume(spark, d), R)), on_series(
    "SELECT estatistica, round(pre, 6) AS pre, round(pos, 6) AS pos, round(CASE WHEN estatistica <> 'n_dias' THEN pos / nullif(pre, 0) END, 6) AS razao FROM "
    f"{_regime_side('pre', '<')} JOIN {_regime_side('pos', '>=')} USING (estatistica)"))
_STATS_SQL = (
    f"reg AS (SELECT cast(volume_total as double) AS v FROM serie WHERE data_abertura >= DATE '{R.regime_cut}')",
    "st AS (SELECT avg(v) AS media, stddev_samp(v) AS desvio, count(*) AS qtd_dias, quantile_cont(v, 0.9) AS p90, quantile_cont(v, 0.95) AS p95, quantile_cont(v, 0.99) AS p99 FROM reg)",
)
add("a15_volume_statistics", lambda spark, d: rounded(alerts.volume_statistics(dense_volume(spark, d), R)), on_series(
    "SELECT round(media, 6) AS media, round(desvio, 6) AS desvio, round(media + 2 * desvio, 6) AS threshold, round(p90, 6) AS p90, round(p95, 6) AS p95, round(p99, 6) AS p99, qtd_dias, "
    "(SELECT count(*) FROM reg WHERE v > st.media + 2 * st.desvio) AS qtd_dias_acima FROM st", *_STATS_SQL))
add("a15_volume_threshold_row", lambda spark, d: alerts.volume_threshold(dense_volume(spark, d), R).drop("calculado_em", "detalhe"), on_series(
    "SELECT 'volume_acima_do_normal' AS regra, round(media + 2 * desvio, 1) AS threshold, round(media, 1) AS media, round(desvio, 1) AS desvio, round(p90, 1) AS p90, "
    "round(p95, 1) AS p95, round(p99, 1) AS p99, qtd_dias AS qtd_dias_historico, acima AS qtd_dias_acima_historico, round(100.0 * acima / qtd_dias, 2) AS pct_dias_acima_historico, "
    f"DATE '{R.regime_cut}' AS regime_data_corte FROM (SELECT *, (SELECT count(*) FROM reg WHERE v > st.media + 2 * st.desvio) AS acima FROM st)", *_STATS_SQL))


def _naive_scored(spark, d) -> DataFrame:
    """Target and naive forecast of every day that has both, with its split."""
    df = TS.with_targets(TS.with_naive(dense_volume(spark, d))).dropna(subset=["target_d7", "naive_d7"])
    return df.withColumn("split", C.split_by_cuts("data_abertura", R.train_end, R.val_end))


_NAIVE_SQL = (
    "nv AS (SELECT * FROM (SELECT *, cast(lead(volume_total, 7) OVER (ORDER BY data_abertura) as double) AS y, cast(lag(volume_total, 6) OVER (ORDER BY data_abertura) as double) AS p, "
    f"CASE WHEN data_abertura < DATE '{R.train_end}' THEN 'TRAIN' WHEN data_abertura < DATE '{R.val_end}' THEN 'VAL' ELSE 'TEST' END AS split FROM serie) "
    "WHERE y IS NOT NULL AND p IS NOT NULL)"
)
_REG_SQL = ("round(avg(abs(y - p)), 3) AS mae, round(sqrt(avg((y - p) * (y - p))), 3) AS rmse, round(100 * avg(CASE WHEN abs(y) + abs(p) = 0 THEN 0 ELSE 2 * abs(y - p) / (abs(y) + abs(p)) END), 3) AS smape_pct, "
            "round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(y)), 3) AS r2, count(*) AS n")
add("a16_error_threshold_row",
    lambda spark, d: alerts.error_threshold(M.regression(_naive_scored(spark, d).where("split = 'TEST'"), "target_d7", "naive_d7")).select("regra", "threshold", "qtd_dias_historico"),
    on_series("SELECT 'erro_d7_acima_do_esperado' AS regra, round(2 * round(avg(abs(y - p)), 3), 1) AS threshold, count(*) AS qtd_dias_historico FROM nv WHERE split = 'TEST'", _NAIVE_SQL))
add("a32_regression_metrics", lambda spark, d: M.regression(_naive_scored(spark, d), "target_d7", "naive_d7", ["split"]),
    on_series(f"SELECT split, {_REG_SQL} FROM nv GROUP BY 1", _NAIVE_SQL))
add("a37_error_per_iso_week",
    lambda spark, d: rounded(_naive_scored(spark, d).where("split = 'TEST'").groupBy(F.weekofyear("data_abertura").alias("semana")).agg(
        F.avg(F.abs(F.col("target_d7") - F.col("naive_d7"))).alias("mae"), F.count(F.lit(1)).alias("n"))),
    on_series("SELECT cast(extract(week from data_abertura) as int) AS semana, round(avg(abs(y - p)), 6) AS mae, count(*) AS n FROM nv WHERE split = 'TEST' GROUP BY 1", _NAIVE_SQL))
add("a38_peak_and_valley_error", lambda spark, d: rounded(M.peak_and_valley(_naive_scored(spark, d).where("split = 'TEST'"), "target_d7", "naive_d7")),
    on_series("SELECT max(m) AS mediana, round(avg(abs(y - p)) FILTER (WHERE y >= m), 6) AS mae_pico, round(avg(abs(y - p)) FILTER (WHERE y < m), 6) AS mae_vale, "
              "count(*) FILTER (WHERE y >= m) AS n_pico, count(*) FILTER (WHERE y < m) AS n_vale FROM nv, (SELECT median(y) AS m FROM nv WHERE split = 'TEST') WHERE split = 'TEST'", _NAIVE_SQL))

# -- A20 to A31, A42 to A47: statistics ----------------------------------------------------
_PRI = ["1 - Crítica", *CLASSES, "5 - Muito Baixa"]
_PNAMES = [f"p{i + 1}" for i in range(5)]
_COUNTS_SQL = lambda values, names, col: ", ".join(f"count(*) FILTER (WHERE {col} = '{v}') AS {n}" for v, n in zip(values, names))
add("a20_months_filled", lambda spark, d: S.months_filled(SI.tickets(spark, d, "data_abertura"), "data_abertura"), on_tickets(
    "SELECT m.mes_ref, coalesce(c.total, 0) AS total FROM (SELECT cast(unnest(generate_series(a, b, INTERVAL 1 MONTH)) as date) AS mes_ref FROM (SELECT min(mes_ref) AS a, max(mes_ref) AS b FROM c)) m "
    "LEFT JOIN c ON m.mes_ref = c.mes_ref", "c AS (SELECT cast(date_trunc('month', data_abertura) as date) AS mes_ref, count(*) AS total FROM tickets GROUP BY 1)"))
add("a20_by_year", lambda spark, d: S.by_year(SI.tickets(spark, d, "data_abertura"), "data_abertura"),
    on_tickets("SELECT cast(extract(year from data_abertura) as int) AS ano, count(*) AS total FROM tickets GROUP BY 1"))
add("a21_month_priority_matrix", lambda spark, d: S.month_matrix(SI.tickets(spark, d, "data_abertura", "prioridade"), "data_abertura", "prioridade", _PRI, _PNAMES),
    on_tickets(f"SELECT cast(date_trunc('month', data_abertura) as date) AS mes_ref, {_COUNTS_SQL(_PRI, _PNAMES, 'prioridade')} FROM tickets GROUP BY 1"))
add("a21_month_channel_shares",
    lambda spark, d: rounded(S.month_matrix(SI.tickets(spark, d, "data_abertura", "aberto_por"), "data_abertura", "aberto_por", ["Monitoramento", "Manual"], ["monitoramento", "manual"], shares=True)),
    on_tickets("SELECT cast(date_trunc('month', data_abertura) as date) AS mes_ref, round(count(*) FILTER (WHERE aberto_por = 'Monitoramento') / count(*), 6) AS monitoramento, "
               "round(count(*) FILTER (WHERE aberto_por = 'Manual') / count(*), 6) AS manual FROM tickets GROUP BY 1"))
add("a22_crosstab_channel_regime",
    lambda spark, d: S.crosstab(SI.tickets(spark, d, "data_abertura", "aberto_por").withColumn("periodo", C.regime_label("data_abertura", R.regime_cut, "pre", "pos")), "aberto_por", "periodo", ["pre", "pos"]),
    on_tickets(f"SELECT aberto_por, count(*) FILTER (WHERE data_abertura < DATE '{R.regime_cut}') AS pre, count(*) FILTER (WHERE data_abertura >= DATE '{R.regime_cut}') AS pos FROM tickets GROUP BY 1"))
add("a23_frequency_with_nulls", lambda spark, d: rounded(S.frequency(SI.tickets(spark, d, "item_configuracao"), "item_configuracao")),
    on_tickets("SELECT item_configuracao, count(*) AS qtd, round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS pct FROM tickets GROUP BY 1"))
add("a23_top_texts", lambda spark, d: rounded(S.frequency(SI.tickets(spark, d, "descricao_resumida"), "descricao_resumida", 15)),
    on_tickets("SELECT descricao_resumida, count(*) AS qtd, round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS pct FROM tickets GROUP BY 1 ORDER BY 2 DESC, 1 NULLS FIRST LIMIT 15"))
add("a23_top_document_texts", lambda spark, d: rounded(S.frequency(SI.texts(spark, d), "text", 15)).withColumn("text", F.md5(F.col("text").cast("binary"))),
    with_ctes("SELECT md5(text) AS text, qtd, pct FROM (SELECT text, count(*) AS qtd, round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS pct FROM texts GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15)", SI.TEXTS_CTE))

_PROFILED = ["numero", "prioridade", "produto", "categoria", "grupo_designado", "item_configuracao", "descricao_resumida", "resolvido", "duracao_segundos", "kpi_violado", "incidente_pai"]
_TYPES = {"resolvido": "timestamp_ntz", "duracao_segundos": "bigint", "kpi_violado": "boolean"}


def _profile_sql(c: str) -> str:
    return (f"SELECT '{c}' AS coluna, '{_TYPES.get(c, 'string')}' AS tipo, cast(sum(q) as bigint) AS linhas, cast(coalesce(sum(q) FILTER (WHERE v IS NULL), 0) as bigint) AS nulos, count(*) AS distintos, "
            f"max(q) FILTER (WHERE v IS NOT NULL) AS freq_top, arg_min(v, (-q, v)) FILTER (WHERE v IS NOT NULL) AS top, min(v) AS menor, max(v) AS maior "
            f"FROM (SELECT cast({c} as string) AS v, count(*) AS q FROM tickets GROUP BY 1)")


add("a24_column_profile", lambda spark, d: S.profile(SI.tickets(spark, d, *_PROFILED)), on_tickets(
    "SELECT coluna, tipo, linhas, nulos, cast(round(cast(100.0e0 / linhas * nulos as decimal(30, 12)), 2) as double) AS pct_nulos, distintos, "
    "cast(round(cast(100.0e0 / linhas * distintos as decimal(30, 12)), 2) as double) AS pct_distintos, top, freq_top, menor, maior, "
    "distintos >= 0.8 * linhas AS quase_unica, distintos <= 10 AS poucos_valores, nulos * (100.0e0 / linhas) >= 30 AS alerta_nulos FROM ("
    + " UNION ALL ".join(_profile_sql(c) for c in _PROFILED) + ")"))
add("a24_time_range", lambda spark, d: S.time_range(SI.tickets(spark, d, "aberto"), "aberto"), on_tickets("SELECT min(aberto) AS inicio, max(aberto) AS fim FROM tickets"))
add("a24_approx_distinct", lambda spark, d: S.approx_distinct(SI.tickets(spark, d, "numero", "item_configuracao"), ["numero", "item_configuracao"]))
add("a25_duplicate_documents", lambda spark, d: S.duplicate_rows(digested(SI.texts(spark, d), "text"), ["text", "lang"]), with_ctes(
    "SELECT cast(sum(n) as bigint) AS linhas, cast(sum(n - 1) as bigint) AS duplicadas, cast(round(cast(100.0e0 * sum(n - 1) / sum(n) as decimal(30, 12)), 2) as double) AS pct FROM (SELECT count(*) AS n FROM texts GROUP BY text, lang)", SI.TEXTS_CTE))


def _describe_sql(column: str, source: str) -> str:
    return ("SELECT n, " + ", ".join(f"round({e}, 4) AS {a}" for a, e in {
        "media": "m", "desvio": "s", "minimo": "a", "p25": "q1", "mediana": "q2", "p75": "q3", "maximo": "b", "assimetria": "sk", "curtose": "ku", "cv": "s / m"}.items())
        + f" FROM (SELECT count(v) AS n, avg(v) AS m, stddev_samp(v) AS s, min(v) AS a, max(v) AS b, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS q2, quantile_cont(v, 0.75) AS q3, "
          f"skewness(v) AS sk, kurtosis(v) AS ku FROM (SELECT cast({column} as double) AS v FROM {source}))")


add("a26_describe_duration", lambda spark, d: rounded(S.describe_numeric(SI.tickets(spark, d, "duracao_segundos"), "duracao_segundos"), 4), on_tickets(_describe_sql("duracao_segundos", "tickets")))
add("a26_describe_daily_volume", lambda spark, d: rounded(S.describe_numeric(dense_volume(spark, d), "volume_total"), 4), on_series(_describe_sql("volume_total", "serie")))
add("a05_duration_quantiles",
    lambda spark, d: rounded(Q.exact_quantiles(SI.tickets(spark, d, "prioridade", "duracao_segundos"), "duracao_segundos", {"p50": 0.5, "p90": 0.9, "p99": 0.99}, ["prioridade"])),
    on_tickets("SELECT prioridade, round(quantile_cont(duracao_segundos, 0.5), 6) AS p50, round(quantile_cont(duracao_segundos, 0.9), 6) AS p90, round(quantile_cont(duracao_segundos, 0.99), 6) AS p99 FROM tickets GROUP BY 1"))
# Expression and digits: a quantile of cents lies on hundredths of a cent, so that rounding meets no halves.
_MONEY = {"desconto": ("cast(l_discount as double)", 4), "preco": ("cast(l_extendedprice as double)", 4),
          "amplo": ("cast(l_extendedprice as double) * cast(l_extendedprice as double) * 100", -1)}


def _money_quantiles(spark, d) -> DataFrame:
    """Columns of a small, a middle and a very wide range, per return flag."""
    rows = spark.read.parquet(f"{d}/lineitem.parquet")
    parts = [rounded(Q.exact_quantiles(rows.select("l_returnflag", F.expr(e).alias("v")), "v", {"p25": 0.25, "p50": 0.5, "p99": 0.99}, ["l_returnflag"]), digits).select(
        F.lit(name).alias("coluna"), "l_returnflag", "p25", "p50", "p99") for name, (e, digits) in _MONEY.items()]
    return reduce(DataFrame.unionByName, parts)


add("a05_money_quantiles", _money_quantiles, " UNION ALL ".join(
    f"SELECT '{name}' AS coluna, l_returnflag, round(quantile_cont({e}, 0.25), {n}) AS p25, round(quantile_cont({e}, 0.5), {n}) AS p50, round(quantile_cont({e}, 0.99), {n}) AS p99 FROM lineitem GROUP BY 2"
    for name, (e, n) in _MONEY.items()))
add("a05_duration_quantile_sketch", lambda spark, d: Q.approx_quantiles(SI.tickets(spark, d, "duracao_segundos"), "duracao_segundos", {"p99": 0.99}))


def _categorical(spark, d) -> DataFrame:
    return S.profile(SI.tickets(spark, d, "prioridade", "status", "aberto_por"), ["prioridade", "status", "aberto_por"]).select(
        "coluna", (F.col("linhas") - F.col("nulos")).alias("n"), "distintos", "top", "freq_top")


add("a27_categorical_summary", _categorical, on_tickets(
    " UNION ALL ".join(f"SELECT '{c}' AS coluna, cast(sum(q) as bigint) AS n, count(*) AS distintos, arg_min(v, (-q, v)) AS top, max(q) AS freq_top "
                       f"FROM (SELECT {c} AS v, count(*) AS q FROM tickets GROUP BY 1)" for c in ("prioridade", "status", "aberto_por"))))
add("a28_null_rate_by_channel_and_regime",
    lambda spark, d: rounded(S.null_rate(SI.tickets(spark, d, "data_abertura", "aberto_por", "item_configuracao").withColumn("regime", C.regime_label("data_abertura", R.regime_cut)), "item_configuracao", ["regime", "aberto_por"])),
    on_tickets(f"SELECT CASE WHEN data_abertura >= DATE '{R.regime_cut}' THEN 'pós' ELSE 'pré' END AS regime, aberto_por, round(avg(cast(item_configuracao IS NULL as int)), 6) AS taxa_nulos FROM tickets GROUP BY ALL"))
add("a29_distinct_groups_by_channel", lambda spark, d: S.distinct_by_group(SI.tickets(spark, d, "aberto_por", "grupo_designado"), "grupo_designado", ["aberto_por"]),
    on_tickets("SELECT aberto_por, count(DISTINCT grupo_designado) AS distintos FROM tickets GROUP BY 1"))
add("a30_mode_by_item", lambda spark, d: S.mode_by(SI.tickets(spark, d, "item_configuracao", "prioridade"), "item_configuracao", "prioridade"),
    on_tickets("SELECT * FROM m", mode_cte("m", "tickets", "item_configuracao", "prioridade", "moda")))
add("a30_overall_mode", lambda spark, d: S.mode_by(SI.tickets(spark, d, "categoria"), None, "categoria"),
    on_tickets("SELECT * FROM m", mode_cte("m", "tickets", None, "categoria", "moda")))
add("a31_top3_categories_by_product",
    lambda spark, d: S.top_labels_by(SI.tickets(spark, d, "produto", "categoria"), "produto", "categoria").withColumn("top", F.array_join("top", "|")),
    on_tickets("SELECT produto, string_agg(categoria, '|' ORDER BY rn) AS top FROM (SELECT produto, categoria, row_number() OVER (PARTITION BY produto ORDER BY count(*) DESC, categoria) AS rn "
               "FROM tickets GROUP BY produto, categoria) WHERE rn <= 3 GROUP BY 1"))


def _nmi_sql(a: str, b: str) -> str:
    h = lambda keys: f"(SELECT -sum(n / t * ln(n / t)) FROM (SELECT cast(count(*) as double) AS n, (SELECT cast(count(*) as double) FROM x) AS t FROM x GROUP BY {keys}))"
    return f"SELECT '{a}' AS a, '{b}' AS b, round(({h(a)} + {h(b)} - {h(a + ', ' + b)}) / (({h(a)} + {h(b)}) / 2), 6) AS nmi"


add("a42_nmi_product_category", lambda spark, d: rounded(S.nmi(SI.tickets(spark, d, "produto", "categoria"), "produto", "categoria")),
    on_tickets(_nmi_sql("produto", "categoria"), "x AS (SELECT produto, categoria FROM tickets)"))
add("a42_nmi_hour_category", lambda spark, d: rounded(S.nmi(SI.tickets(spark, d, "aberto", "categoria").withColumn("hora", F.hour("aberto")), "hora", "categoria")),
    on_tickets(_nmi_sql("hora", "categoria"), "x AS (SELECT extract(hour from aberto) AS hora, categoria FROM tickets)"))
_CORR = ["lag_1", "lag_7", "lag_28", "volume_total"]
add("a43_feature_correlations",
    lambda spark, d: rounded(S.correlations(TS.drop_warm_up(TS.with_lags(dense_volume(spark, d), (1, 7, 28)), ["lag_28"]), _CORR)),
    on_series(" UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS corr FROM f" for a in _CORR for b in _CORR),
              "f AS (SELECT * FROM (SELECT *, lag(volume_total, 1) OVER (ORDER BY data_abertura) AS lag_1, lag(volume_total, 7) OVER (ORDER BY data_abertura) AS lag_7, "
              "lag(volume_total, 28) OVER (ORDER BY data_abertura) AS lag_28 FROM serie) WHERE lag_28 IS NOT NULL)"))
add("a44_text_repetition", lambda spark, d: rounded(S.repetition_rate(SI.tickets(spark, d, "descricao_resumida"), "descricao_resumida")),
    on_tickets("SELECT count(DISTINCT descricao_resumida) AS distintos, count(*) AS linhas, round(1 - count(DISTINCT descricao_resumida) / count(*), 6) AS taxa_repeticao FROM tickets"))
add("a44_document_repetition", lambda spark, d: rounded(S.repetition_rate(digested(SI.texts(spark, d), "text"), "text")),
    with_ctes("SELECT count(DISTINCT text) AS distintos, count(*) AS linhas, round(1 - count(DISTINCT text) / count(*), 6) AS taxa_repeticao FROM texts", SI.TEXTS_CTE))
add("a45_duration_histogram", lambda spark, d: rounded(S.histogram(SI.tickets(spark, d, "duracao_segundos"), "duracao_segundos")),
    on_tickets("SELECT faixa, count(*) AS qtd, round(max(a) + (max(b) - max(a)) / 40.0e0 * (faixa - 1), 6) AS inicio FROM (SELECT cast(least(floor((duracao_segundos - a) / ((b - a) / 40.0e0)) + 1, 40) as int) AS faixa, a, b "
               "FROM tickets, (SELECT cast(min(duracao_segundos) as double) AS a, cast(max(duracao_segundos) as double) AS b FROM tickets)) GROUP BY 1"))
add("a46_rare_cut_report", lambda spark, d: rounded(S.rare_cut_report(SI.tickets(spark, d, "item_configuracao"), "item_configuracao")),
    on_tickets("SELECT corte, count(*) FILTER (WHERE n < corte) AS agrupadas, count(*) FILTER (WHERE n >= corte) AS principais, round(100.0 * coalesce(sum(n) FILTER (WHERE n < corte), 0) / sum(n), 6) AS pct_volume "
               "FROM (SELECT count(*) AS n FROM tickets WHERE item_configuracao IS NOT NULL GROUP BY item_configuracao), (SELECT unnest([10, 20, 30, 50]) AS corte) GROUP BY 1"))
add("a47_slice_excess",
    lambda spark, d: S.slice_excess(SI.tickets(spark, d, "data_abertura", "aberto_por", "grupo_designado", "prioridade"),
                                    (F.col("aberto_por") == "Monitoramento") & (F.col("grupo_designado") == R.special_group) & (F.col("prioridade") == "4 - Baixa"),
                                    F.col("data_abertura") >= F.lit(R.regime_cut).cast("date")),
    on_tickets(f"SELECT count(*) FILTER (WHERE s AND p) AS recorte_pos, count(*) FILTER (WHERE s AND NOT p) AS recorte_pre, count(*) FILTER (WHERE p) - count(*) FILTER (WHERE NOT p) AS aumento_total FROM "
               f"(SELECT aberto_por = 'Monitoramento' AND grupo_designado = 'Team14' AND prioridade = '4 - Baixa' AS s, data_abertura >= DATE '{R.regime_cut}' AS p FROM tickets)"))

# -- P27 to P31, J: novelty and membership --------------------------------------------------
TEXT, LABEL = "descricao_resumida", "prioridade"


def _train(df: DataFrame) -> DataFrame:
    return df.where("split = 'TRAIN'")


def _judged(df: DataFrame) -> DataFrame:
    return df.where("split in ('VAL', 'TEST')")


_NOVELTY_SQL = (
    f"CASE WHEN {TEXT} IS NULL THEN 'Genuinely Novel' WHEN {TEXT} IN (SELECT {TEXT} FROM tr WHERE {TEXT} IS NOT NULL) THEN 'Exact Match' "
    f"WHEN {template_sql(TEXT)} IN (SELECT {template_sql(TEXT)} FROM tr WHERE {TEXT} IS NOT NULL) THEN 'Candidate Normalized Match' "
    f"WHEN split_part({TEXT}, ':', 1) IN (SELECT split_part({TEXT}, ':', 1) FROM tr WHERE {TEXT} IS NOT NULL) THEN 'Candidate Template' ELSE 'Genuinely Novel' END"
)
_EVN = f"evn AS (SELECT *, {_NOVELTY_SQL} AS categoria_novidade FROM ev)"


def with_seen(spark, d, *extra: str) -> DataFrame:
    pop = modelled(spark, d, *extra)
    return N.with_novelty(_train(pop), _judged(pop), TEXT, "numero")


add("p27_novelty_class",
    lambda spark, d: with_seen(spark, d).select("numero", "split", "categoria_novidade", "seen_in_train"),
    on_population("SELECT numero, split, categoria_novidade, categoria_novidade = 'Exact Match' AS seen_in_train FROM evn", _EVN))


def _novelty_counts(spark, d) -> DataFrame:
    pop = modelled(spark, d)
    return N.novelty_counts(_train(pop), _judged(pop), TEXT, ["split"])


add("p27_novelty_counts", _novelty_counts, on_population("SELECT split, categoria_novidade, count(*) AS n FROM evn GROUP BY ALL", _EVN))


def _documents_seen(spark, d) -> DataFrame:
    docs = SI.texts(spark, d)
    return N.with_seen_flag(_train(docs), _judged(docs), "text", "doc_id", long_text=True).select("doc_id", "split", "seen_in_train")


add("j07_documents_seen_in_train", _documents_seen, with_ctes(
    "SELECT doc_id, split, text IN (SELECT text FROM texts WHERE split = 'TRAIN' AND text IS NOT NULL) AS seen_in_train FROM texts WHERE split <> 'TRAIN'", SI.TEXTS_CTE))


def _documents_seen_counts(spark, d) -> DataFrame:
    docs = SI.texts(spark, d)
    return N.seen_counts(_train(docs), _judged(docs), "text", ["split", "lang"], long_text=True)


add("j07_documents_seen_counts", _documents_seen_counts, with_ctes(
    "SELECT split, lang, text IN (SELECT text FROM texts WHERE split = 'TRAIN' AND text IS NOT NULL) AS seen_in_train, count(*) AS n FROM texts WHERE split <> 'TRAIN' GROUP BY ALL", SI.TEXTS_CTE))


def _cold_start(spark, d) -> DataFrame:
    pop = modelled(spark, d, "item_configuracao")
    parts = [N.cold_start(_train(pop), pop.where(F.col("split") == s), "item_configuracao").withColumn("split", F.lit(s)) for s in ("VAL", "TEST")]
    return reduce(DataFrame.unionByName, parts)


add("j08_cold_start_items", _cold_start, on_population(
    " UNION ALL ".join(f"SELECT '{s}' AS split, count(DISTINCT item_configuracao) AS classes_novas, count(*) AS linhas_afetadas FROM ev WHERE split = '{s}' AND item_configuracao IS NOT NULL "
                       "AND item_configuracao NOT IN (SELECT item_configuracao FROM tr WHERE item_configuracao IS NOT NULL)" for s in ("VAL", "TEST"))))


def _never_again(spark, d) -> DataFrame:
    pop = modelled(spark, d, "item_configuracao")
    return N.never_again(_train(pop), [_judged(pop)], "item_configuracao")


add("t06_items_never_seen_again", _never_again, on_population(
    "SELECT item_configuracao FROM tr WHERE item_configuracao IS NOT NULL EXCEPT SELECT item_configuracao FROM ev"))


def _common(spark, d) -> DataFrame:
    pop = modelled(spark, d)
    return N.common_keys(_train(pop), _judged(pop), [TEXT])


add("t06_texts_on_both_sides", _common, on_population(f"SELECT {TEXT} FROM tr INTERSECT SELECT {TEXT} FROM ev"))
add("j09_days_with_critical_ticket",
    lambda spark, d: (lambda t: S.counted(t, "data_abertura").join(t.where("prioridade = '1 - Crítica'").select("data_abertura").distinct(), "data_abertura", "left_semi"))(
        SI.tickets(spark, d, "data_abertura", "prioridade")),
    on_tickets("SELECT data_abertura, count(*) AS n FROM tickets t WHERE EXISTS (SELECT 1 FROM tickets c WHERE c.data_abertura = t.data_abertura AND c.prioridade = '1 - Crítica') GROUP BY 1"))
add("t07_distinct_days", lambda spark, d: SI.tickets(spark, d, "data_abertura").distinct(), on_tickets("SELECT DISTINCT data_abertura FROM tickets"))
add("p14_volume_population_rows",
    lambda spark, d: SI.tickets(spark, d, "numero", "data_abertura", "prioridade").where(
        (F.col("data_abertura") >= F.lit(R.start).cast("date")) & ~F.col("prioridade").isin(*R.excluded_priorities)),
    on_tickets(f"SELECT numero, data_abertura, prioridade FROM tickets WHERE data_abertura >= DATE '{R.start}' AND prioridade NOT IN ('1 - Crítica', '5 - Muito Baixa')"))

_ITEM = "item_configuracao"


def _bucketed(spark, d) -> DataFrame:
    pop = modelled(spark, d, _ITEM)
    return N.bucket_rare(_train(pop), pop, _ITEM, "numero", 5, out="item_config_prep").select("numero", "item_config_prep")


add("p29_rare_items", _bucketed, on_population(
    f"SELECT numero, CASE WHEN {_ITEM} IS NULL THEN 'Desconhecido' WHEN {_ITEM} IN (SELECT {_ITEM} FROM tr WHERE {_ITEM} IS NOT NULL GROUP BY 1 HAVING count(*) >= 5) THEN {_ITEM} ELSE 'Outros' END AS item_config_prep FROM pop"))


def _rare_labels(spark, d) -> DataFrame:
    pop = modelled(spark, d, "categoria")
    return N.bucket_rare_labels(_train(pop), pop, "categoria", "numero", 30, out="alvo").select("numero", "alvo")


add("p30_rare_labels", _rare_labels, on_population(
    "SELECT numero, CASE WHEN categoria IN (SELECT categoria FROM tr GROUP BY 1 HAVING count(*) >= 30) THEN categoria ELSE 'OUTRAS_RARAS' END AS alvo FROM pop"))


def _frequency_feature(spark, d) -> DataFrame:
    pop = modelled(spark, d, _ITEM)
    bucketed = N.bucket_rare(_train(pop), pop, _ITEM, "numero", 5, "RARO", None, "_ic_bucket")
    return rounded(N.with_frequency(_train(bucketed), bucketed, "_ic_bucket", "numero").select("numero", "freq_log"))


add("p31_log_frequency", _frequency_feature, on_population(
    "SELECT numero, round(ln(1 + coalesce(n, (SELECT n FROM f WHERE b = 'RARO'), 1)), 6) AS freq_log FROM bk LEFT JOIN f USING (b)",
    f"bk AS (SELECT numero, split, CASE WHEN {_ITEM} IN (SELECT {_ITEM} FROM tr WHERE {_ITEM} IS NOT NULL GROUP BY 1 HAVING count(*) >= 5) THEN {_ITEM} ELSE 'RARO' END AS b FROM pop)",
    "f AS (SELECT b, count(*) AS n FROM bk WHERE split = 'TRAIN' GROUP BY 1)"))

# -- M11, J06, J12: lookup baselines; A33 to A41 on their predictions ------------------------
_KEYED = f"keyed AS (SELECT *, {template_sql(TEXT)} AS modelo, {TEXT} IN (SELECT {TEXT} FROM tr WHERE {TEXT} IS NOT NULL) AS seen FROM ev)"
_TRK = f"trk AS (SELECT *, {template_sql(TEXT)} AS modelo FROM tr)"
_SCORED_SQL = (
    _KEYED, _TRK, mode_cte("mk", "trk", "modelo", LABEL, "m"), mode_cte("mo", "trk", None, LABEL, "m"),
    f"sc AS (SELECT k.*, k.{LABEL} AS y, coalesce(mk.m, (SELECT m FROM mo)) AS p FROM keyed k LEFT JOIN mk USING (modelo))",
)


def template_scored(spark, d, *extra: str) -> DataFrame:
    """VAL and TEST tickets answered with the commonest class of their template in TRAIN."""
    pop = modelled(spark, d, *extra).withColumn("modelo", T.as_template(TEXT))
    return B.predict_mode(_train(pop), _judged(pop), "modelo", LABEL, "numero")


def scored_and_seen(spark, d, *extra: str) -> DataFrame:
    scored = template_scored(spark, d, *extra)
    return N.with_seen_flag(_train(modelled(spark, d)), scored, TEXT, "numero", "seen")


add("j06_mode_by_template", lambda spark, d: template_scored(spark, d).select("numero", LABEL, "previsto"),
    on_population(f"SELECT numero, {LABEL}, p AS previsto FROM sc", *_SCORED_SQL))


def _hybrid(spark, d) -> DataFrame:
    pop = modelled(spark, d)
    return B.dictionary_or_model(_train(pop), template_scored(spark, d), TEXT, LABEL, "previsto", "numero", "hibrido").select("numero", "hibrido", "no_dicionario")


add("j12_dictionary_or_model", _hybrid, on_population(
    f"SELECT numero, coalesce(d.m, p) AS hibrido, d.m IS NOT NULL AS no_dicionario FROM sc LEFT JOIN dic d USING ({TEXT})", *_SCORED_SQL, mode_cte("dic", "tr", TEXT, LABEL, "m")))


def _coverage(spark, d) -> DataFrame:
    pop = modelled(spark, d)
    return rounded(B.coverage(_train(pop), _judged(pop), TEXT, ["split"]))


add("a49_dictionary_coverage", _coverage, on_population(
    "SELECT split, round(avg(cast(coalesce(seen, false) as int)), 6) AS cobertura, count(*) AS n FROM keyed GROUP BY 1", _KEYED))


def _top3_hits(spark, d) -> DataFrame:
    pop = modelled(spark, d, _ITEM)
    return rounded(B.top_list_hit_rate(_train(pop), _judged(pop), _ITEM, LABEL, 2, ["split"]))


add("a31_top_list_hit_rate", _top3_hits, on_population(
    "SELECT split, round(avg(cast(hit as int)), 6) AS acerto_top, count(*) AS n FROM (SELECT e.split, CASE WHEN k.top IS NULL THEN e.y = mo.m ELSE list_contains(k.top, e.y) END AS hit "
    f"FROM (SELECT *, {LABEL} AS y FROM ev) e CROSS JOIN mo LEFT JOIN (SELECT {_ITEM}, list({LABEL}) AS top FROM (SELECT {_ITEM}, {LABEL}, row_number() OVER (PARTITION BY {_ITEM} ORDER BY count(*) DESC, {LABEL}) AS rn "
    f"FROM tr WHERE {_ITEM} IS NOT NULL GROUP BY {_ITEM}, {LABEL}) WHERE rn <= 2 GROUP BY 1) k USING ({_ITEM})) GROUP BY 1", mode_cte("mo", "tr", None, LABEL, "m")))
add("m21_class_weights", lambda spark, d: rounded(B.class_weights(_train(modelled(spark, d)), LABEL, "peso")),
    on_population(f"SELECT {LABEL}, round((SELECT count(*) FROM tr) / ((SELECT count(DISTINCT {LABEL}) FROM tr) * count(*)), 6) AS peso FROM tr GROUP BY 1"))


def metrics_sql(source: str, by: str, labels: list[str] | None, where: str = "") -> str:
    """Classification figures of (by, y, p) rows, from one row per class."""
    keys = f"{by}, " if by else ""
    scored = "c IN (" + ", ".join(f"'{x}'" for x in labels) + ")" if labels else "true"
    macro = f"sum(f1) FILTER (WHERE {scored}) / {float(len(labels))}e0" if labels else "avg(f1)"
    return (
        f"SELECT {keys}round(sum(tp) / sum(sup), 3) AS accuracy, round(avg(rec) FILTER (WHERE sup > 0), 3) AS balanced_accuracy, round({macro}, 3) AS f1_macro, "
        f"round(sum(f1 * sup) FILTER (WHERE {scored}) / sum(sup) FILTER (WHERE {scored}), 3) AS f1_weighted, cast(sum(sup) as bigint) AS n FROM "
        f"(SELECT *, coalesce(cast(tp as double) / nullif(sup, 0), 0) AS rec, coalesce(2.0e0 * tp / nullif(sup + prd, 0), 0) AS f1 FROM "
        f"(SELECT {keys}c, cast(sum(a) as double) AS sup, cast(sum(b) as double) AS prd, cast(sum(h) as double) AS tp FROM (SELECT {keys}y AS c, 1 AS a, 0 AS b, CASE WHEN y = p THEN 1 ELSE 0 END AS h FROM {source} {where} "
        f"UNION ALL SELECT {keys}p, 0, 1, 0 FROM {source} {where}) GROUP BY {keys}c)) " + (f"GROUP BY {by}" if by else "")
    )


add("a33_classification_metrics", lambda spark, d: M.classification(template_scored(spark, d), LABEL, "previsto", ["split"], CLASSES),
    on_population(metrics_sql("sc", "split", CLASSES), *_SCORED_SQL))


def _class_metrics(spark, d) -> DataFrame:
    return rounded(M.per_class(M.confusion(template_scored(spark, d), LABEL, "previsto", ["split"]), ["split"]))


add("a33_metrics_per_class", _class_metrics, on_population(
    "SELECT split, c AS classe, cast(sup as bigint) AS suporte, cast(prd as bigint) AS previstos, cast(tp as bigint) AS acertos, round(coalesce(tp / nullif(prd, 0), 0), 6) AS \"precision\", "
    "round(coalesce(tp / nullif(sup, 0), 0), 6) AS recall, round(coalesce(2 * tp / nullif(sup + prd, 0), 0), 6) AS f1 FROM (SELECT split, c, cast(sum(a) as double) AS sup, cast(sum(b) as double) AS prd, cast(sum(h) as double) AS tp "
    "FROM (SELECT split, y AS c, 1 AS a, 0 AS b, CASE WHEN y = p THEN 1 ELSE 0 END AS h FROM sc UNION ALL SELECT split, p, 0, 1, 0 FROM sc) GROUP BY ALL)", *_SCORED_SQL))
add("a33_recall_per_class", lambda spark, d: M.class_recall(template_scored(spark, d), LABEL, "previsto", CLASSES, ["split"]), on_population(
    "SELECT split, " + ", ".join(f"round(coalesce(avg(cast(p = y as int)) FILTER (WHERE y = '{c}'), 0), 3) AS recall_{i + 1}" for i, c in enumerate(CLASSES)) + " FROM sc GROUP BY 1", *_SCORED_SQL))
_SHORT = ["alta", "media", "baixa"]
add("a34_confusion_matrix", lambda spark, d: M.confusion_matrix(template_scored(spark, d), LABEL, "previsto", CLASSES, _SHORT),
    on_population(f"SELECT y AS real, {_COUNTS_SQL(CLASSES, _SHORT, 'p')} FROM sc GROUP BY 1", *_SCORED_SQL))
add("a34_confusion_matrix_shares", lambda spark, d: rounded(M.confusion_matrix(template_scored(spark, d), LABEL, "previsto", CLASSES, _SHORT, True)),
    on_population("SELECT y AS real, " + ", ".join(f"round(count(*) FILTER (WHERE p = '{c}') / count(*), 6) AS {n}" for c, n in zip(CLASSES, _SHORT)) + " FROM sc GROUP BY 1", *_SCORED_SQL))


def _category_scored(spark, d) -> DataFrame:
    """Category answered with the commonest one of the closing group: many classes."""
    rows = SI.tickets(spark, d, "numero", "grupo_designado", "categoria")
    return B.predict_mode(rows, rows, "grupo_designado", "categoria", "numero")


_CATEGORY_SQL = (mode_cte("cm", "tickets", "grupo_designado", "categoria", "p"), "cs AS (SELECT categoria AS y, p FROM tickets LEFT JOIN cm USING (grupo_designado))")
add("a34_confusion_of_top_classes", lambda spark, d: rounded(M.top_class_confusion(_category_scored(spark, d), "categoria", "previsto", 10)), on_tickets(
    "SELECT y AS real, p AS previsto, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY y), 6) AS fracao FROM cs WHERE y IN (SELECT y FROM b) AND p IN (SELECT y FROM b) GROUP BY 1, 2",
    *_CATEGORY_SQL, "b AS (SELECT y FROM cs GROUP BY 1 ORDER BY count(*) DESC, y LIMIT 10)"))
add("a35_top_confusion_pairs", lambda spark, d: M.transitions(_category_scored(spark, d), "categoria", "previsto", 15),
    on_tickets("SELECT y AS real, p AS previsto, count(*) AS n FROM cs WHERE y <> p GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 15", *_CATEGORY_SQL))
add("a35_error_transitions", lambda spark, d: M.transitions(template_scored(spark, d), LABEL, "previsto"),
    on_population("SELECT y AS real, p AS previsto, count(*) AS n FROM sc WHERE y <> p GROUP BY 1, 2", *_SCORED_SQL))
_SLICED_SQL = "sl AS (SELECT 'COMPLETE' AS recorte, split, y, p FROM sc UNION ALL SELECT CASE WHEN seen THEN 'SEEN' ELSE 'NEW' END, split, y, p FROM sc)"
add("a36_sliced_metrics", lambda spark, d: M.sliced_classification(scored_and_seen(spark, d), LABEL, "previsto", "seen", (), CLASSES),
    on_population(metrics_sql("sl", "recorte", CLASSES), *_SCORED_SQL, _SLICED_SQL))


def _weekly(spark, d) -> DataFrame:
    scored = template_scored(spark, d).where("split = 'TEST'")
    first = scored.agg(F.min("data_abertura").alias("_first"))
    weekly = scored.crossJoin(F.broadcast(first)).withColumn("semana", C.relative_week("data_abertura", "_first"))
    return M.classification(weekly, LABEL, "previsto", ["semana"], CLASSES)


add("a37_metrics_per_relative_week", _weekly, on_population(
    metrics_sql("wk", "semana", CLASSES), *_SCORED_SQL,
    "wk AS (SELECT cast(floor((data_abertura - (SELECT min(data_abertura) FROM sc WHERE split = 'TEST')) / 7) + 1 as int) AS semana, y, p FROM sc WHERE split = 'TEST')"))
add("a37_metrics_per_month", lambda spark, d: M.classification(template_scored(spark, d).withColumn("mes", F.month("aberto")), LABEL, "previsto", ["mes"]),
    on_population(metrics_sql("mt", "mes", None), *_SCORED_SQL, "mt AS (SELECT cast(extract(month from aberto) as int) AS mes, y, p FROM sc)"))
add("a39_error_rate_by_product", lambda spark, d: rounded(M.error_rate_by(template_scored(spark, d), "produto", LABEL, "previsto", 5)),
    on_population("SELECT produto, round(avg(cast(y <> p as int)), 6) AS taxa_erro, count(*) AS n FROM sc GROUP BY 1 HAVING count(*) >= 5 ORDER BY 2 DESC, 1 LIMIT 10", *_SCORED_SQL))
add("a39_accuracy_by_channel", lambda spark, d: rounded(M.accuracy_by(template_scored(spark, d, "aberto_por"), "aberto_por", LABEL, "previsto")),
    on_population("SELECT aberto_por, round(avg(cast(y = p as int)), 6) AS accuracy, count(*) AS n FROM sc GROUP BY 1", *_SCORED_SQL))


def _error_share(spark, d) -> DataFrame:
    scored = N.with_novelty(_train(modelled(spark, d)), template_scored(spark, d), TEXT, "numero")
    return rounded(M.error_share_by(scored, "categoria_novidade", LABEL, "previsto"))


add("a39_error_share_by_novelty", _error_share, on_population(
    "SELECT categoria_novidade, count(*) FILTER (WHERE y <> p) AS erros, count(*) AS n, round(100.0 * count(*) FILTER (WHERE y <> p) / sum(count(*) FILTER (WHERE y <> p)) OVER (), 6) AS pct_erros, "
    f"round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS pct_base FROM (SELECT sc.*, {_NOVELTY_SQL} AS categoria_novidade FROM sc) GROUP BY 1", *_SCORED_SQL))
add("a40_class_mix", lambda spark, d: rounded(M.class_mix(template_scored(spark, d), LABEL, "previsto")), on_population(
    "SELECT c AS classe, round(100.0 * sum(a) / (SELECT count(*) FROM sc), 6) AS pct_real, round(100.0 * sum(b) / (SELECT count(*) FROM sc), 6) AS pct_previsto FROM "
    "(SELECT y AS c, 1 AS a, 0 AS b FROM sc UNION ALL SELECT p, 0, 1 FROM sc) GROUP BY 1", *_SCORED_SQL))


def _baselines(spark, d) -> DataFrame:
    pop = modelled(spark, d, "aberto_por")
    train = _train(pop)
    judged = N.with_seen_flag(train, _judged(pop), TEXT, "numero", "seen")
    return ML.baseline_table(train, judged, LABEL, CLASSES, "seen")


def _baseline_sql() -> tuple[str, list[str]]:
    ctes, parts = [_KEYED, mode_cte("mo", "tr", None, LABEL, "m")], []
    for name, key in (("B1_Dummy", None), ("B2_Produto", "produto"), ("B3_Canal", "aberto_por"), ("B4_Dictionary", TEXT)):
        tag = name[:2].lower()
        if key:
            ctes.append(mode_cte(f"{tag}m", "tr", key, LABEL, "m"))
            ctes.append(f"{tag} AS (SELECT k.seen, k.{LABEL} AS y, coalesce(x.m, (SELECT m FROM mo)) AS p FROM keyed k LEFT JOIN {tag}m x USING ({key}))")
        else:
            ctes.append(f"{tag} AS (SELECT seen, {LABEL} AS y, (SELECT m FROM mo) AS p FROM keyed)")
        ctes.append(f"{tag}s AS (SELECT 'COMPLETE' AS recorte, y, p FROM {tag} UNION ALL SELECT CASE WHEN seen THEN 'SEEN' ELSE 'NEW' END, y, p FROM {tag})")
        parts.append(f"SELECT '{name}' AS experimento, * FROM ({metrics_sql(tag + 's', 'recorte', CLASSES)})")
    return " UNION ALL ".join(parts), ctes


_B_SQL, _B_CTES = _baseline_sql()
add("m11_baselines", _baselines, on_population(_B_SQL, *_B_CTES))
add("a48_experiment_pivot", lambda spark, d: rounded(M.experiment_pivot(_baselines(spark, d))), on_population(
    "SELECT experimento, max(f1_macro) FILTER (WHERE recorte = 'COMPLETE') AS COMPLETE, max(f1_macro) FILTER (WHERE recorte = 'SEEN') AS SEEN, max(f1_macro) FILTER (WHERE recorte = 'NEW') AS NEW, "
    "round(max(f1_macro) FILTER (WHERE recorte = 'SEEN') - max(f1_macro) FILTER (WHERE recorte = 'NEW'), 6) AS gap_seen_menos_new "
    f"FROM ({_B_SQL}) GROUP BY 1", *_B_CTES))

# -- M19: drift of one template --------------------------------------------------------------
add("m19_template_drift", lambda spark, d: ML.template_drift(modelled(spark, d), "disk i/o", CLASSES, _SHORT), on_population(
    f"SELECT cast(date_trunc('month', aberto) as date) AS mes_ref, regexp_replace({TEXT}, 'IC\\p{{Nd}}+', '<IC>', 'g') AS modelo, {_COUNTS_SQL(CLASSES, _SHORT, LABEL)} FROM pop WHERE contains(lower({TEXT}), 'disk i/o') GROUP BY 1, 2"))
add("m19_template_confusion", lambda spark, d: ML.template_slice(template_scored(spark, d), "disk i/o"), on_population(
    f"SELECT y AS real, p AS previsto, count(*) AS n FROM sc WHERE contains(lower({TEXT}), 'disk i/o') GROUP BY 1, 2", *_SCORED_SQL))

# -- J03 to J05, L: alerts --------------------------------------------------------------------

def _forecasts(spark, d) -> DataFrame:
    """Naive forecasts of both horizons for every day of the series."""
    series = dense_volume(spark, d)
    parts = [TS.with_naive(series).select(F.col("data_abertura").alias("data_referencia"), "serie", F.lit(h).alias("horizonte"), F.col(c).cast("double").alias("valor_previsto"))
             for h, c in (("D+1", "naive_d1"), ("D+7", "naive_d7"))]
    return parts[0].unionByName(parts[1]).dropna().withColumn("data_alvo", target_day("data_referencia", "horizonte"))


def _thresholds(spark, d) -> DataFrame:
    """Both rules, each computed twice; the later row is the one in force."""
    rows = volume_threshold(dense_volume(spark, d), R).unionByName(error_threshold(M.regression(_naive_scored(spark, d).where("split = 'TEST'"), "target_d7", "naive_d7")))
    old = rows.withColumns({"calculado_em": F.col("calculado_em") - F.expr("INTERVAL '1' DAY"), "threshold": F.col("threshold") + 100})
    return rows.unionByName(old)


_FC = ("fc AS (SELECT *, data_referencia + cast(CASE horizonte WHEN 'D+1' THEN 1 ELSE 7 END as int) AS data_alvo FROM ("
       "SELECT data_abertura AS data_referencia, serie, 'D+1' AS horizonte, cast(volume_total as double) AS valor_previsto FROM serie UNION ALL "
       "SELECT data_abertura, serie, 'D+7', cast(lag(volume_total, 6) OVER (ORDER BY data_abertura) as double) FROM serie) WHERE valor_previsto IS NOT NULL)")
_TH = ("thv AS (SELECT round(media + 2 * desvio, 1) AS threshold FROM st)",
       "the AS (SELECT round(2 * round(avg(abs(y - p)), 3), 1) AS threshold FROM nv WHERE split = 'TEST')")
for _h, _id in (("D+1", "l01"), ("D+7", "l02")):
    add(f"{_id}_alert_volume_{_h[0].lower()}{_h[2]}", lambda spark, d, h=_h: rounded(forecast_above_normal(_forecasts(spark, d), _thresholds(spark, d), h)),
        on_series(f"SELECT serie, horizonte, data_alvo, round(valor_previsto - threshold, 6) AS margem, valor_previsto - threshold > 0 AS disparado FROM fc, thv WHERE horizonte = '{_h}' ORDER BY data_alvo DESC LIMIT 1",
                  *_STATS_SQL, _FC, _TH[0]))
add("l03_alert_error_d7", lambda spark, d: rounded(error_above_expected(_forecasts(spark, d), dense_volume(spark, d), _thresholds(spark, d))), on_series(
    "SELECT f.serie, horizonte, data_alvo, round(abs(valor_previsto - volume_total) - threshold, 6) AS margem, abs(valor_previsto - volume_total) - threshold > 0 AS disparado "
    "FROM fc f JOIN serie s ON s.data_abertura = f.data_alvo, the WHERE horizonte = 'D+7' ORDER BY data_alvo DESC LIMIT 1", _FC, _NAIVE_SQL, _TH[1]))
add("j04_real_against_forecast", lambda spark, d: real_against_forecast(_forecasts(spark, d), dense_volume(spark, d).drop("serie"), pending=True), on_series(
    "SELECT data_alvo, data_referencia, f.serie, horizonte, valor_previsto, volume_total AS valor_real, abs(valor_previsto - volume_total) AS erro_abs FROM fc f LEFT JOIN serie s ON s.data_abertura = f.data_alvo", _FC))
add("j05_latest_threshold", lambda spark, d: alerts.latest_threshold(_thresholds(spark, d), "volume_acima_do_normal"), on_series("SELECT threshold FROM thv", *_STATS_SQL, _TH[0]))


def _evaluations(spark, d) -> DataFrame:
    """One evaluation per event type and hour: fires when the hour has more events than the type's mean hour."""
    hourly = S.counted(SI.signals(spark, d).withColumn("avaliado_em", F.date_trunc("hour", F.col("aberto")).cast("timestamp_ntz")).withColumnRenamed("tipo", "alerta"), "alerta", "avaliado_em")
    mean = hourly.groupBy("alerta").agg(F.avg("n").alias("media"))
    return hourly.join(mean, "alerta").select("alerta", "avaliado_em", (F.col("n") > F.col("media")).alias("disparado"))


add("l04_notifications", lambda spark, d: notifications(_evaluations(spark, d)), with_ctes(
    "SELECT alerta, avaliado_em, disparado, disparado AND t IS NOT NULL AS notifica FROM ru LEFT JOIN (SELECT alerta, run, t, t AS avaliado_em FROM no) USING (alerta, run, avaliado_em)",
    SI.SIGNALS_CTE, "ev AS (SELECT alerta, avaliado_em, n > avg(n) OVER (PARTITION BY alerta) AS disparado FROM (SELECT tipo AS alerta, date_trunc('hour', aberto) AS avaliado_em, count(*) AS n FROM signals GROUP BY ALL))",
    "ch AS (SELECT *, CASE WHEN coalesce(lag(disparado) OVER (PARTITION BY alerta ORDER BY avaliado_em), false) <> disparado THEN 1 ELSE 0 END AS ch FROM ev)",
    "ru AS (SELECT * EXCLUDE (ch), sum(ch) OVER (PARTITION BY alerta ORDER BY avaliado_em ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM ch)",
    "no AS (SELECT alerta, run, min(avaliado_em) AS t FROM ru WHERE disparado GROUP BY 1, 2 UNION ALL SELECT n.alerta, n.run, min(r.avaliado_em) FROM no n JOIN ru r "
    "ON r.alerta = n.alerta AND r.run = n.run AND r.avaliado_em >= n.t + INTERVAL 4 HOUR GROUP BY 1, 2)").replace("WITH ", "WITH RECURSIVE ", 1))
