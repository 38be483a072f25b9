"""The forecast jobs on a loaded lake, and what SQL can say of fitted models.

A fitted value has no counterpart in SQL. Keys, counts, real classes, dictionary answers and model
names have; beside them stand conditions on the fitted values (normal equations, order of ranks,
error of a sketch) that the comparison expects to hold.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketry.catalog.analysis import CLASSES, TEXT, _STATS_SQL, _judged, _train
from ticketry.catalog.base import Catalog, dense_volume, mode_cte, on_gold, on_population, on_series, on_tickets, rounded
from ticketry.catalog.learning import _experiment_rows, _fit_here, _suggestions, category_frames, daily_dataset
from ticketry.operators import metrics as M, quantiles as Q
from ticketry.plans import etl, jobs, panels, tickets_ml as ML, volume as V
from ticketry.schema import STAND_IN_RULES as R
from ticketry.session import checkpoint_dir
from ticketry.sources import stand_ins as SI
from ticketry.sources.lake import Lake

catalog = Catalog()
add = catalog.add


def _lake(spark, d, *columns: str) -> tuple[Lake, str]:
    """A lake with the stand-in tickets as its silver table, and a folder for models."""
    base = f"{checkpoint_dir(spark)}/jobs-{uuid.uuid4().hex}"
    lake = Lake(spark, f"{base}/lake")
    lake.replace("silver", etl.SILVER, SI.tickets(spark, d, *columns))
    return lake, f"{base}/models"


# -- the volume job ------------------------------------------------------------------------
def _volume_job(spark, d) -> Lake:
    """Train and store a model, then run the job twice."""
    lake, models = _lake(spark, d, "data_abertura", "prioridade")
    V.save(spark, models, V.train(jobs.volume_series(lake, R, 0), R), R)
    for _ in range(2):
        jobs.forecast_volume(lake, models, R, 0)
    return lake


_UNSEEN = ("un AS (SELECT data_abertura, serie, cast(volume_total as double) AS v, y FROM (SELECT *, lead(volume_total, 7) OVER (ORDER BY data_abertura) AS y, "
           f"max(data_abertura) OVER () AS fim FROM serie) WHERE (y IS NOT NULL AND data_abertura >= DATE '{R.val_end}') OR data_abertura = fim)")
add("l05_volume_forecast_job",
    lambda spark, d: jobs.forecasts(_volume_job(spark, d)).select(
        "data_referencia", "serie", "horizonte", "modelo_utilizado", "versao_modelo", "data_alvo",
        F.when(F.col("horizonte") == "D+1", F.col("valor_previsto")).alias("valor_d1"), (F.col("valor_previsto") >= 0).alias("valido")),
    on_series("SELECT data_abertura AS data_referencia, serie, 'D+1' AS horizonte, 'persistencia' AS modelo_utilizado, '1.0' AS versao_modelo, data_abertura + 1 AS data_alvo, v AS valor_d1, v >= 0 AS valido FROM un "
              "UNION ALL SELECT data_abertura, serie, 'D+7', 'ridge_d7', 'v1', data_abertura + 7, NULL, true FROM un", _UNSEEN))
add("s09_threshold_log_of_the_job",
    lambda spark, d: jobs.thresholds(_volume_job(spark, d)).select(
        "regra", (F.col("threshold") > 0).alias("positivo"), "media", "desvio", "p90", "p95", "p99", "qtd_dias_historico", "regime_data_corte"),
    on_series("SELECT x.* FROM (SELECT 'volume_acima_do_normal' AS regra, media + 2 * desvio > 0 AS positivo, round(media, 1) AS media, round(desvio, 1) AS desvio, round(p90, 1) AS p90, round(p95, 1) AS p95, "
              f"round(p99, 1) AS p99, qtd_dias AS qtd_dias_historico, DATE '{R.regime_cut}' AS regime_data_corte FROM st UNION ALL "
              "SELECT 'erro_d7_acima_do_esperado', true, NULL, NULL, NULL, NULL, NULL, count(y), NULL FROM un) x, (SELECT unnest([1, 2])) e", *_STATS_SQL, _UNSEEN))


# -- the ticket job --------------------------------------------------------------------------
def _ticket_job(spark, d) -> DataFrame:
    """Train and store a model, then run the job twice."""
    lake, models = _lake(spark, d, "numero", "aberto", "data_abertura", "prioridade", "produto", TEXT)
    ML.save(spark, models, ML.train(lake.table("silver", etl.SILVER), R), R)
    for _ in range(2):
        jobs.forecast_tickets(lake, models, R)
    return jobs.ticket_forecasts(lake).select(
        "numero", "data_abertura", "prioridade_real", "modelo_utilizado", "versao_modelo", F.col("prioridade_prevista").isin(*CLASSES).alias("classe_valida"))


add("j11_ticket_forecast_job", _ticket_job, on_population(
    "SELECT numero, data_abertura, prioridade AS prioridade_real, 'linearsvc_prioridade' AS modelo_utilizado, 'v1' AS versao_modelo, true AS classe_valida FROM ev"))


# -- panels on a loaded lake -------------------------------------------------------------------
_GOLD_INPUTS = ("prioridade", "grupo_designado", "aberto_por", "status", "categoria", "codigo_fechamento", "entrou_kpi", "kpi_violado", "aberto",
                "data_abertura", "dia_semana", "duracao_segundos", "duracao_valida", "foi_resolvido")


def _loaded_panels(spark, d) -> DataFrame:
    """Some panels, stacked, read from the tables that the gold load wrote."""
    lake, _ = _lake(spark, d, *_GOLD_INPUTS)
    etl.load_gold(lake, R)
    read = panels.from_lake(lake)
    parts = [
        panels.total(read).select(F.lit("total").alias("painel"), F.lit(None).cast("string").alias("rotulo"), F.col("total").cast("double").alias("valor")),
        panels.priority_count("1 - Crítica")(read).select(F.lit("criticos").alias("painel"), F.lit(None).cast("string").alias("rotulo"), F.col("n").cast("double").alias("valor")),
        panels.resolution_rate(read).select(F.lit("resolucao").alias("painel"), F.lit(None).cast("string").alias("rotulo"), F.col("v").alias("valor")),
        panels.category_pareto(read).select(F.lit("pareto").alias("painel"), F.col("categoria").alias("rotulo"), F.col("total").cast("double").alias("valor")),
    ]
    return rounded(reduce(DataFrame.unionByName, parts))


add("q01_q34_panels_on_a_loaded_lake", _loaded_panels, on_gold(
    "SELECT 'total' AS painel, NULL::VARCHAR AS rotulo, cast(count(*) as double) AS valor FROM silver UNION ALL SELECT 'criticos', NULL, cast(count(*) as double) FROM silver WHERE prioridade = '1 - Crítica' "
    "UNION ALL SELECT 'resolucao', NULL, round(avg(taxa_resolucao), 6) FROM kpi_resumo UNION ALL "
    "SELECT 'pareto', categoria, cast(total as double) FROM (SELECT categoria, count(*) AS total FROM silver GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15)"))


# -- fitted models -------------------------------------------------------------------------------
def _normal_equations(spark, d) -> DataFrame:
    """At the minimum of the penalised squares, each feature's product with the residuals is alpha times its coefficient."""
    train = V.training_frame(dense_volume(spark, d), R).where("split = 'TRAIN'")
    model = V.fit(train, R.d7_features, "target_d7", V.Regressor("ridge", alpha=R.ridge_alpha))
    weights = model.stages[-1].coefficients.toArray().tolist()
    rows = model.transform(train).withColumn("_r", F.col("target_d7") - F.col("prediction"))
    named = [("intercepto", F.lit(1.0), 0.0)] + [(f, F.col(f).cast("double"), w) for f, w in zip(R.d7_features, weights)]
    off = [F.abs(F.sum(x * F.col("_r")) - F.lit(R.ridge_alpha * w)) / (F.sum(F.abs(x * F.col("target_d7"))) + 1) for _, x, w in named]
    sums = rows.agg(F.count(F.lit(1)).alias("n"), *[c.alias(f"_o{i}") for i, c in enumerate(off)])
    return sums.select("n", F.inline(F.array(*[F.struct(F.lit(f).alias("feature"), (F.col(f"_o{i}") < 1e-6).alias("no_minimo")) for i, (f, _, _) in enumerate(named)])))


add("m15_ridge_normal_equations", _normal_equations, on_series(
    "SELECT n, unnest([" + ", ".join(f"'{f}'" for f in ["intercepto", *R.d7_features]) + "]) AS feature, true AS no_minimo FROM (SELECT count(*) AS n FROM (SELECT data_abertura, "
    f"lead(volume_total, 7) OVER w AS y, lag(volume_total, 28) OVER w AS x FROM serie WINDOW w AS (ORDER BY data_abertura)) WHERE y IS NOT NULL AND x IS NOT NULL AND data_abertura < DATE '{R.train_end}')"))

add("m02_m12_volume_experiment_rows",
    lambda spark, d: V.experiment_table(daily_dataset(spark, d), [e for e in V.standard_experiments(R) if e.model.kind in ("naive", "linear")], R).select(
        "experimento", "horizonte", "estrategia", "split", "n"),
    on_tickets(
        "SELECT experimento, horizonte, estrategia, CASE WHEN data_abertura < CASE estrategia WHEN 'II' THEN DATE '{0}' ELSE DATE '{2}' END THEN 'TRAIN' "
        "WHEN data_abertura < CASE estrategia WHEN 'II' THEN DATE '{1}' ELSE DATE '{3}' END THEN 'VAL' ELSE 'TEST' END AS split, count(*) AS n "
        "FROM ds, (SELECT unnest(['E00', 'E00', 'E01', 'E02', 'E03', 'E04', 'E05', 'E08']) AS experimento, unnest(['I', 'II', 'I', 'I', 'I', 'I', 'I', 'II']) AS estrategia) e, "
        "(SELECT 'D+1' AS horizonte, 1 AS k UNION ALL SELECT 'D+7', 7) h WHERE data_abertura + k <= fim GROUP BY ALL".format(R.train_end, R.val_end, R.family_train_end, R.family_val_end),
        "ds AS (SELECT *, max(data_abertura) OVER () AS fim FROM (SELECT cast(unnest(generate_series(a, b, INTERVAL 1 DAY)) as date) AS data_abertura, a FROM "
        f"(SELECT min(data_abertura) AS a, max(data_abertura) AS b FROM tickets WHERE data_abertura >= DATE '{R.start}' AND prioridade IN ({', '.join(repr(c) for c in CLASSES)}))) WHERE data_abertura >= a + 28)"))


def _ranked_shape(spark, d) -> DataFrame:
    model, rows = _fit_here(spark, d)
    scored = ML.score(model, _judged(rows))
    marks = F.transform("ranking", lambda x: x["score"])
    return scored.select("numero", F.size(F.array_distinct(F.transform("ranking", lambda x: x["classe"]))).cast("long").alias("classes"),
                         (F.sort_array(marks, asc=False) == marks).alias("melhor_primeiro"), (F.col("previsto") == F.col("ranking")[0]["classe"]).alias("primeira_e_prevista"))


add("m16_ranked_class_shape", _ranked_shape, on_population(
    "SELECT numero, (SELECT count(DISTINCT prioridade) FROM tr) AS classes, true AS melhor_primeiro, true AS primeira_e_prevista FROM ev"))


def _suggestion_shape(spark, d) -> DataFrame:
    marks = F.transform("_s", lambda x: x["score"])
    out = _suggestions(spark, d).withColumn("_s", F.from_json("sugestoes", "array<struct<score: double, classe: string>>"))
    return out.select("numero", F.size("_s").cast("long").alias("sugeridas"), (F.sort_array(marks, asc=False) == marks).alias("melhor_primeiro"))


_TWO = ", ".join(f"'{c}'" for c in CLASSES[:2])
add("m17_suggestion_shape", _suggestion_shape, on_tickets(
    "SELECT numero, least(3, (SELECT count(DISTINCT CASE WHEN n >= 50 THEN categoria ELSE '~' END) FROM kn)) AS sugeridas, true AS melhor_primeiro FROM ca "
    f"WHERE NOT rotulado AND data_abertura >= DATE '{R.regime_cut}'",
    f"ca AS (SELECT *, categoria IS NOT NULL AND categoria <> '{R.default_label}' AS rotulado FROM tickets WHERE prioridade IN ({_TWO}))",
    f"kn AS (SELECT categoria, count(*) AS n FROM ca WHERE rotulado AND data_abertura < DATE '{R.family_val_end}' GROUP BY 1)"))


def _dictionary_part(spark, d) -> DataFrame:
    model, rows = _fit_here(spark, d)
    both = ML.hybrid(_train(rows), ML.score(model, _judged(rows)).drop("ranking"))
    return both.select("numero", "no_dicionario", F.when(F.col("no_dicionario"), F.col("previsto_hibrido")).alias("do_dicionario"),
                       F.col("previsto_hibrido").isin(*CLASSES).alias("classe_valida"))


add("j12_dictionary_part", _dictionary_part, on_population(
    "SELECT numero, m IS NOT NULL AS no_dicionario, m AS do_dicionario, true AS classe_valida FROM ev LEFT JOIN md ON coalesce(descricao_resumida, '') = txt",
    "trx AS (SELECT *, coalesce(descricao_resumida, '') AS txt FROM tr)", mode_cte("md", "trx", "txt", "prioridade", "m")))

_SLICES = ("SELECT experimento, recorte, n FROM (SELECT 'COMPLETE' AS recorte, count(*) AS n FROM vs UNION ALL SELECT CASE WHEN visto THEN 'SEEN' ELSE 'NEW' END, count(*) FROM vs GROUP BY 1), "
           "(SELECT unnest([{0}]) AS experimento) e")
_TEXT_VAL = f"vs AS (SELECT {TEXT} IN (SELECT {TEXT} FROM tr WHERE {TEXT} IS NOT NULL) AS visto FROM pop WHERE split = 'VAL')"
add("m12_text_experiment_rows", lambda spark, d: ML.experiment_table(*_experiment_rows(spark, d), ML.standard_experiments(), CLASSES).select("experimento", M.SLICE, "n"),
    on_population(_SLICES.format(", ".join(f"'{e.name}'" for e in ML.standard_experiments())), _TEXT_VAL))

add("a41_category_top3",
    lambda spark, d: (lambda out: out.select("experimento", M.SLICE, "n", F.col("top3").between(0, 1).alias("valido")))(
        ML.top_k_table(*category_frames(spark, d), next(e for e in ML.category_experiments() if e.name == "C1_hibrido_LR"))),
    on_tickets("SELECT 'C1_hibrido_LR' AS experimento, recorte, n, true AS valido FROM (SELECT 'COMPLETE' AS recorte, count(*) AS n FROM vs UNION ALL SELECT CASE WHEN visto THEN 'SEEN' ELSE 'NEW' END, count(*) FROM vs GROUP BY 1)",
               f"ca AS (SELECT * FROM tickets WHERE prioridade IN ({_TWO}) AND categoria IS NOT NULL AND categoria <> '{R.default_label}')",
               f"vs AS (SELECT coalesce({TEXT}, '') IN (SELECT coalesce({TEXT}, '') FROM ca WHERE data_abertura < DATE '{R.family_train_end}') AS visto FROM ca "
               f"WHERE data_abertura >= DATE '{R.family_train_end}' AND data_abertura < DATE '{R.family_val_end}')"))


# -- sketches ----------------------------------------------------------------------------------------
def _sketch_error(spark, d) -> DataFrame:
    """The share of rows up to the sketched quantile is within its bound of 0.99."""
    rows = SI.tickets(spark, d, "duracao_segundos").where("duracao_segundos IS NOT NULL")
    sketch = F.broadcast(Q.approx_quantiles(rows, "duracao_segundos", {"p99": 0.99}))
    v = F.col("duracao_segundos")
    return rows.crossJoin(sketch).agg(F.count(v).alias("n"), F.count_if(v < F.col("p99")).alias("_a"), F.count_if(v <= F.col("p99")).alias("_b")).select(
        "n", ((F.col("_a") <= (0.99 + 1e-4) * F.col("n")) & (F.col("_b") >= (0.99 - 1e-4) * F.col("n") - 1)).alias("no_limite"))


add("a05_sketch_error", _sketch_error, on_tickets("SELECT count(duracao_segundos) AS n, true AS no_limite FROM tickets"))


def _distinct_error(spark, d) -> DataFrame:
    """Exact distinct values beside whether the sketch is within 3 standard errors of 5 percent."""
    columns = ["numero", "item_configuracao"]
    rows = SI.tickets(spark, d, *columns)
    sketch = rows.agg(*[F.approx_count_distinct(c).alias(f"_{c}") for c in columns])
    exact = reduce(DataFrame.unionByName, [rows.agg(F.lit(c).alias("coluna"), F.count_distinct(c).alias("distintos")) for c in columns])
    about = reduce(lambda out, c: out.when(F.col("coluna") == c, F.col(f"_{c}")), columns[1:], F.when(F.col("coluna") == columns[0], F.col(f"_{columns[0]}")))
    return exact.crossJoin(F.broadcast(sketch)).select("coluna", "distintos", (F.abs(about - F.col("distintos")) <= 0.15 * F.col("distintos")).alias("no_limite"))


add("a24_approx_distinct_error", _distinct_error, on_tickets(
    "SELECT 'numero' AS coluna, count(DISTINCT numero) AS distintos, true AS no_limite FROM tickets UNION ALL SELECT 'item_configuracao', count(DISTINCT item_configuracao), true FROM tickets"))
