"""Forecast and text models on the whole stand-in tables.

Fitted models have no counterpart in plain SQL; where a step does (single-feature regression,
naive forecasts) the comparison SQL is given.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketry.catalog.analysis import CLASSES, LEVELS, TEXT, _judged, _train
from ticketry.catalog.base import Catalog, dense_volume, modelled, on_population, on_series, rounded
from ticketry.operators import alerts, checks, metrics as M, novelty as N, series as TS
from ticketry.plans import registry, tickets_ml as ML, volume as V
from ticketry.schema import STAND_IN_RULES as R
from ticketry.session import checkpoint_dir
from ticketry.sources import stand_ins as SI

catalog = Catalog()
add = catalog.add


def _models_dir(spark) -> str:
    return f"{checkpoint_dir(spark)}/models-{uuid.uuid4().hex}"


# -- volume ------------------------------------------------------------------------------
def _stored_forecast(spark, d) -> V.Forecast:
    """Train, save, load, check the feature contract, forecast."""
    series = dense_volume(spark, d)
    base = _models_dir(spark)
    V.save(spark, base, V.train(series, R), R)
    loaded = registry.load(spark, base, V.FAMILY)
    features = TS.volume_features(series, R)
    registry.require_features(loaded.metadata, [c for c in features.columns if c not in (TS.KEY, TS.DAY)])
    return V.forecast(series, loaded.model, R, loaded.metadata["modelo"], loaded.metadata["versao"])


add("m01_m10_volume_forecast", lambda spark, d: _stored_forecast(spark, d).rows)
add("m09_volume_out_of_sample_metrics", lambda spark, d: _stored_forecast(spark, d).metrics)


add("w12_persistence_rows",
    lambda spark, d: (lambda s: V.persistence_rows(s, s.where(F.col("data_abertura") >= F.lit(R.val_end).cast("date"))))(dense_volume(spark, d)),
    on_series(f"SELECT data_abertura AS data_referencia, serie, 'D+1' AS horizonte, cast(volume_total as double) AS valor_previsto, 'persistencia' AS modelo_utilizado, "
              f"'1.0' AS versao_modelo FROM serie WHERE data_abertura >= DATE '{R.val_end}'"))


def _ridge_coefficients(spark, d) -> DataFrame:
    train = V.training_frame(dense_volume(spark, d), R).where("split = 'TRAIN'")
    return V.coefficients(V.fit(train, R.d7_features, "target_d7", V.Regressor("ridge", alpha=R.ridge_alpha)), R.d7_features, spark)


add("m15_ridge_coefficients", _ridge_coefficients)


def daily_dataset(spark, d) -> DataFrame:
    """All candidate features of the dense daily series, composition included."""
    rows = SI.tickets(spark, d, "data_abertura", "prioridade", "aberto_por", "incidente_pai").where(
        (F.col("data_abertura") >= F.lit(R.start).cast("date")) & F.col("prioridade").isin(*CLASSES))
    daily = TS.composition(rows, LEVELS, "monitoramento", "manual").withColumn(TS.KEY, F.lit("total"))
    filled = TS.spine(daily).join(daily, [TS.KEY, TS.DAY], "left").fillna(0)
    return V.experiment_dataset(filled, R)


_E00 = ("d AS (SELECT *, cast(lead(volume_total, 7) OVER w AS double) AS y, cast(lag(volume_total, 7) OVER w AS double) AS x, cast(lag(volume_total, 6) OVER w AS double) AS nv, "
        "lag(volume_total, 28) OVER w AS warm FROM serie WINDOW w AS (ORDER BY data_abertura))")


def _cut(strategy: str) -> str:
    a, b = (R.train_end, R.val_end) if strategy == "II" else (R.family_train_end, R.family_val_end)
    return f"CASE WHEN data_abertura < DATE '{a}' THEN 'TRAIN' WHEN data_abertura < DATE '{b}' THEN 'VAL' ELSE 'TEST' END"


def _small_experiments(spark, d) -> DataFrame:
    series = TS.drop_warm_up(TS.with_naive(TS.with_targets(TS.with_lags(dense_volume(spark, d), R.lags))), ["lag_28"])
    return V.experiment_table(series, [
        V.VolumeExperiment("E00", (), V.Regressor("naive"), "D+7", "II"),
        V.VolumeExperiment("E01", ("lag_7",), V.Regressor("linear"), "D+7", "I"),
    ], R).drop("horizonte", "estrategia", "modelo")


_EXP_SQL = ("round(avg(abs(y - p)), 3) AS mae, round(sqrt(avg((y - p) * (y - p))), 3) AS rmse, "
            "round(100 * avg(CASE WHEN abs(y) + abs(p) = 0 THEN 0 ELSE 2 * abs(y - p) / (abs(y) + abs(p)) END), 3) AS smape_pct, "
            "round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(y)), 3) AS r2, count(*) AS n")
add("m02_m12_single_lag_experiments", _small_experiments, on_series(
    f"SELECT 'E00' AS experimento, split, {_EXP_SQL} FROM (SELECT y, nv AS p, {_cut('II')} AS split FROM d WHERE warm IS NOT NULL AND y IS NOT NULL) GROUP BY 2 UNION ALL "
    f"SELECT 'E01', split, {_EXP_SQL} FROM (SELECT e.split, y, greatest(b0 + b1 * x, 0) AS p FROM e, (SELECT regr_slope(y, x) AS b1, regr_intercept(y, x) AS b0 FROM e WHERE split = 'TRAIN')) GROUP BY 2",
    _E00, f"e AS (SELECT y, x, {_cut('I')} AS split FROM d WHERE warm IS NOT NULL AND y IS NOT NULL)"))

add("m02_m12_volume_experiments", lambda spark, d: V.experiment_table(daily_dataset(spark, d), V.standard_experiments(R), R))


# Fixed values of the fine grids.
GRID_ALPHAS = (0.001, 0.01, 0.1, 0.5, 1, 2, 5, 10, 20, 50, 100)
GRID_DEPTHS, GRID_TREES = (2, 3, 4, 5, 6), (100, 200, 300)


def _grid(spark, d) -> DataFrame:
    return V.experiment_table(daily_dataset(spark, d), [
        e for h, columns in (("D+1", R.lag_columns), ("D+7", R.d7_features))
        for e in V.alpha_grid(columns, GRID_ALPHAS, h) + V.tree_grid(columns, GRID_DEPTHS, GRID_TREES, h)], R)


def _path(spark, d) -> tuple[DataFrame, list]:
    return TS.volume_dataset(dense_volume(spark, d), R), [
        e for h, columns in (("D+1", R.lag_columns), ("D+7", R.d7_features)) for e in V.alpha_grid(columns, GRID_ALPHAS, h)]


#: Elimination on lists: rows of the penalised products with the target's behind them, one pivot a step.
_SOLVED = (
    "f AS (SELECT data_abertura, {lags}, lead(volume_total, 1) OVER w AS y1, lead(volume_total, 7) OVER w AS y7, "
    "CASE WHEN data_abertura >= DATE '{cut}' THEN 1 ELSE 0 END AS periodo_pos_set_2025 FROM serie WINDOW w AS (ORDER BY data_abertura)),"
    "h AS (SELECT 'D+1' AS horizonte, 7 AS d, data_abertura, [{names}, 0, y1]::DOUBLE[] AS x, y1 AS y FROM f WHERE lag_28 IS NOT NULL UNION ALL "
    "SELECT 'D+7', 8, data_abertura, [{names}, periodo_pos_set_2025, y7]::DOUBLE[], y7 FROM f WHERE lag_28 IS NOT NULL),"
    "t AS (SELECT * FROM h WHERE y IS NOT NULL AND data_abertura < DATE '{end}'),"
    "p AS (SELECT horizonte, d, i, j, count(*) * covar_pop(x[i], x[CASE WHEN j > d THEN 9 ELSE j END]) AS s FROM t, range(1, 9) a(i), range(1, 10) b(j) WHERE i <= d AND j <= d + 1 GROUP BY ALL),"
    "al AS (SELECT unnest([{alphas}])::DOUBLE AS alpha),"
    "q AS (SELECT horizonte, d, alpha, i, list(s + CASE WHEN i = j THEN alpha ELSE 0 END ORDER BY j) AS r FROM p, al GROUP BY ALL),"
    "e AS (SELECT horizonte, d, alpha, list(r ORDER BY i) AS m, 1 AS k FROM q GROUP BY ALL UNION ALL "
    "SELECT horizonte, d, alpha, list_transform(m, lambda r, i: CASE WHEN i = k THEN list_transform(r, lambda v: v / r[k]) "
    "ELSE list_transform(r, lambda v, j: v - r[k] * m[k][j] / m[k][k]) END), k + 1 FROM e WHERE k <= d),"
    "w AS (SELECT horizonte, d, alpha, list_transform(m, lambda r: r[d + 1]) AS w FROM e WHERE k = d + 1),"
    "mu AS (SELECT horizonte, avg(y) AS ym, [{means}] AS xm FROM t GROUP BY 1),"
    "c AS (SELECT w.*, ym - list_sum(list_transform(w, lambda v, i: v * xm[i])) AS b FROM w JOIN mu USING (horizonte))"
).format(lags=", ".join(f"lag(volume_total, {k}) OVER w AS lag_{k}" for k in R.lags), cut=R.regime_cut, names=", ".join(R.lag_columns), end=R.train_end,
         alphas=", ".join(map(str, GRID_ALPHAS)), means=", ".join(f"avg(x[{i}])" for i in range(1, 9)))


def _on_path(body: str) -> str:
    return on_series(body, _SOLVED).replace("WITH ", "WITH RECURSIVE ", 1)


add("m13_ridge_path_coefficients", lambda spark, d: rounded(V.ridge_path(*_path(spark, d), R).select("horizonte", "alpha", "feature", "coef"), 5, "coef"), _on_path(
    f"SELECT horizonte, alpha, unnest([{', '.join(repr(f) for f in R.d7_features)}][1:d]) AS feature, round(unnest(w), 5) AS coef FROM c "
    "UNION ALL SELECT horizonte, alpha, '', round(b, 5) FROM c"))
add("m13_ridge_path_winner", lambda spark, d: V.best_on_val(V.experiment_table(*_path(spark, d), R)), _on_path(
    "SELECT horizonte, 'II' AS estrategia, arg_min(e, struct_pack(a := mae, b := e)) AS vencedor, min(mae) AS val_mae FROM (SELECT horizonte, 'ridge_' || a.n AS e, "
    "round(avg(abs(y - greatest(0, b + list_sum(list_transform(w, lambda v, i: v * x[i]))))), 3) AS mae FROM h JOIN c USING (horizonte) "
    f"JOIN (SELECT unnest([{', '.join(map(str, GRID_ALPHAS))}])::DOUBLE AS alpha, unnest([{', '.join(repr(str(a)) for a in GRID_ALPHAS)}]) AS n) a USING (alpha) "
    f"WHERE y IS NOT NULL AND data_abertura >= DATE '{R.train_end}' AND data_abertura < DATE '{R.val_end}' GROUP BY ALL) GROUP BY ALL"))
add("m13_best_alpha_and_tree", lambda spark, d: V.best_on_val(_grid(spark, d)))


def _finalists(spark, d) -> DataFrame:
    lags = tuple(R.d7_features)
    return V.finalists(V.experiment_table(daily_dataset(spark, d), [
        V.VolumeExperiment("naive", (), V.Regressor("naive")),
        V.VolumeExperiment("ridge", lags, V.Regressor("ridge", alpha=R.ridge_alpha)),
        V.VolumeExperiment("forest", lags, V.Regressor("forest", depth=4, trees=100, min_rows=2)),
    ], R))


add("m14_finalists", _finalists)


def _regression_thresholds(spark, d) -> DataFrame:
    forecast = _stored_forecast(spark, d)
    rows = alerts.volume_threshold(dense_volume(spark, d), R).unionByName(alerts.error_threshold(forecast.metrics))
    return rows.drop("calculado_em")


add("a15_a16_thresholds_of_the_model", _regression_thresholds)


def _volume_checks(spark, d) -> DataFrame:
    return checks.forecast_table(_stored_forecast(spark, d).rows)


# One row per unseen day whose target is known, and one ahead, per horizon.
add("v11_model_forecast_checks", _volume_checks, on_series(
    "SELECT 'dois_horizontes' AS checagem, n > 0 AS ok, 'D+1=' || cast(n as string) || ' | D+7=' || cast(n as string) AS mensagem FROM "
    f"(SELECT count(*) + 1 AS n FROM (SELECT data_abertura, lead(volume_total, 7) OVER (ORDER BY data_abertura) AS y FROM serie) WHERE y IS NOT NULL AND data_abertura >= DATE '{R.val_end}') "
    "UNION ALL SELECT 'modelo_e_versao', true, 'linhas: 0' UNION ALL SELECT 'd1_e_persistencia', true, 'linhas: 0' UNION ALL SELECT 'previsao_nao_negativa', true, 'linhas: 0'"))

# -- ticket text ---------------------------------------------------------------------------
_SILVER = ("numero", "aberto", "data_abertura", "prioridade", "produto", TEXT)


def silver(spark, d, *extra: str) -> DataFrame:
    return SI.tickets(spark, d, *_SILVER, *extra)


def fitted(spark, d) -> ML.FittedText:
    """The production model, through the store."""
    base = _models_dir(spark)
    ML.save(spark, base, ML.train(silver(spark, d), R), R)
    return ML.load(spark, base)


def _unseen(spark, d) -> DataFrame:
    return ML.predict_unseen(silver(spark, d), fitted(spark, d), R)[0]


add("m03_m08_ticket_forecast", _unseen)
add("m09_ticket_out_of_sample_metrics", lambda spark, d: ML.predict_unseen(silver(spark, d), fitted(spark, d), R)[1])
add("v14_ticket_forecast_checks", lambda spark, d: checks.ticket_forecast_table(_unseen(spark, d), R), on_population(
    "SELECT 'tabela_nao_vazia' AS checagem, count(*) > 0 AS ok, 'linhas: ' || cast(count(*) as string) AS mensagem FROM ev "
    "UNION ALL SELECT 'classe_real_presente', true, 'linhas: 0' UNION ALL SELECT 'modelo_e_versao', true, 'linhas: 0' UNION ALL SELECT 'classe_prevista_valida', true, 'linhas: 0'"))


def _prepared(spark, d, *extra: str) -> DataFrame:
    return ML.prepared(modelled(spark, d, *extra), R)


def _fit_here(spark, d) -> tuple[ML.FittedText, DataFrame]:
    rows = _prepared(spark, d)
    return ML.fit(_train(rows), ML.LABEL, ML.default_features(R), ML.TextModel("svc", c=R.svc_c)), rows


def _ranked(spark, d) -> DataFrame:
    model, rows = _fit_here(spark, d)
    scored = ML.score(model, _judged(rows))
    return scored.select("numero", "previsto", "score_vencedor", F.to_json("ranking").alias("ranking"))


def _top_terms(spark, d) -> DataFrame:
    model, _ = _fit_here(spark, d)
    return ML.top_terms(model, spark)


def _top_k(spark, d) -> DataFrame:
    model, rows = _fit_here(spark, d)
    scored = ML.score(model, _judged(rows))
    hit = M.top_k_hit(ML.top_labels(k=2), F.col(ML.LABEL), 2)
    return rounded(scored.groupBy("split").agg(F.avg(hit.cast("int")).alias("top2_accuracy"), F.count(F.lit(1)).alias("n")))


add("m15_top_terms_per_class", _top_terms)
add("m16_ranked_classes", _ranked)
add("a41_top_k_accuracy", _top_k)


_CATEGORY_COLUMNS = ("numero", "aberto", "data_abertura", "prioridade", "produto", "categoria", "item_configuracao", "aberto_por", TEXT)


def _category_rows(spark, d) -> DataFrame:
    return ML.prepared(ML.category_population(SI.tickets(spark, d, *_CATEGORY_COLUMNS), R, extra=("item_configuracao", "aberto_por")), R)


def _suggestions(spark, d) -> DataFrame:
    """Categories suggested for the tickets of the current regime that have none.

    A margin classifier over text, structure and frequency of the item, learned from TRAIN and VAL.
    """
    rows = _category_rows(spark, d)
    known = rows.where("rotulado AND split IN ('TRAIN', 'VAL')")
    items = lambda df: N.bucket_rare(known, df, "item_configuracao", "numero", 5, "RARO", None, "_ic_bucket")
    learned = items(known)
    learn = N.bucket_rare_labels(known, N.with_frequency(learned, learned, "_ic_bucket", "numero"), "categoria", "numero", 50)
    what = ML.TextFeatures(TEXT, ("prioridade", ML.PRODUCT), ("freq_log",), 1, 2, 5000)
    model = ML.fit(learn, "categoria", what, ML.TextModel("svc", balanced=True))
    open_ones = items(rows.where(~F.col("rotulado") & (F.col("data_abertura") >= F.lit(R.regime_cut).cast("date"))))
    open_ones = N.with_frequency(learned, open_ones, "_ic_bucket", "numero")
    return ML.suggest(model, open_ones).select("numero", F.to_json("sugestoes").alias("sugestoes"))


def category_frames(spark, d) -> tuple[DataFrame, DataFrame]:
    """TRAIN and VAL of the labelled tickets, rare labels grouped by the TRAIN counts."""
    known = _category_rows(spark, d).where("rotulado")
    train = known.where("split = 'TRAIN'")
    rows = N.bucket_rare(train, known, "item_configuracao", "numero", 5, "RARO", None, "_ic_bucket")
    rows = N.with_frequency(rows.where("split = 'TRAIN'"), rows, "_ic_bucket", "numero")
    rows = ML.with_calendar_labels(N.bucket_rare_labels(train, rows, "categoria", "numero", 30))
    judged = N.with_seen_flag(train, rows.where("split = 'VAL'"), TEXT, "numero")
    return rows.where("split = 'TRAIN'"), judged


def _category_experiments(spark, d) -> DataFrame:
    return ML.experiment_table(*category_frames(spark, d), ML.category_experiments())


def _internal_novelty(spark, d) -> DataFrame:
    """The production features judged inside TRAIN: earlier months against later ones."""
    months = R.priority_train_months
    early, late = ML.months_apart(_train(_prepared(spark, d)), months[:5], months[5:])
    return ML.experiment_table(early, late, [ML.TextExperiment("E09_Novidade_Interna", ML.default_features(R), ML.TextModel("svc"))], CLASSES)


add("m12_category_experiments", _category_experiments)
add("m12_internal_novelty", _internal_novelty)
add("m17_category_suggestions", _suggestions)


def _experiment_rows(spark, d) -> tuple[DataFrame, DataFrame]:
    pop = modelled(spark, d, "aberto_por", "item_configuracao")
    rows = ML.with_calendar(ML.prepared(pop, R).withColumn("texto_bruto", F.col(TEXT)))
    rows = N.bucket_rare(_train(pop), rows, "item_configuracao", "numero", 5, out="item_config_prep")
    rows = ML.text_variants(rows, "texto_bruto")
    judged = N.with_seen_flag(_train(pop), rows.where("split = 'VAL'"), TEXT, "numero")
    return _train(rows), judged


def _text_experiments(spark, d) -> DataFrame:
    return ML.experiment_table(*_experiment_rows(spark, d), ML.standard_experiments(), CLASSES)


add("m12_text_experiments", _text_experiments)
add("a48_text_experiment_pivot", lambda spark, d: M.experiment_pivot(ML.experiment_table(*_experiment_rows(spark, d), ML.standard_experiments(), CLASSES)))
add("m18_text_variants", lambda spark, d: ML.experiment_table(*_experiment_rows(spark, d), ML.variant_experiments(), CLASSES))
add("m13_svc_grid_winner", lambda spark, d: ML.best(ML.experiment_table(*_experiment_rows(spark, d), ML.svc_grid(), CLASSES)))
add("m13_class_weight_grid", lambda spark, d: ML.experiment_table(*_experiment_rows(spark, d), ML.weight_grid(), CLASSES))
add("m13_tfidf_grid_winner", lambda spark, d: ML.best(ML.experiment_table(*_experiment_rows(spark, d), ML.tfidf_grid(), CLASSES)))
add("m07_forest_on_structure", lambda spark, d: ML.experiment_table(*_experiment_rows(spark, d), [
    ML.TextExperiment("B2_estrut_RF", ML.TextFeatures(None, (ML.PRODUCT, "aberto_por", "item_config_prep")), ML.TextModel("forest", balanced=True)),
    ML.TextExperiment("B1_estrut_LR", ML.TextFeatures(None, (ML.PRODUCT, "aberto_por")), ML.TextModel("logistic", balanced=True)),
], CLASSES))
add("m07_boosted_on_structure", lambda spark, d: ML.experiment_table(*_experiment_rows(spark, d), [
    ML.TextExperiment("B3_estrut_boosted", ML.TextFeatures(None, (ML.PRODUCT, "aberto_por")), ML.TextModel("boosted", trees=300, depth=6, balanced=True))], CLASSES))


def _rare_cuts(spark, d) -> DataFrame:
    rows = _category_rows(spark, d).where("rotulado")
    what = ML.TextFeatures(TEXT, ("prioridade", ML.PRODUCT), (), 1, 2, 5000)
    return ML.rare_label_experiments(rows.where("split = 'TRAIN'"), rows.where("split = 'VAL'"), "categoria", "numero", what, ML.TextModel("logistic", max_iter=300, balanced=True), (10, 20, 30, 50))


add("p30_rare_cut_experiment", _rare_cuts)


def _hybrid(spark, d) -> DataFrame:
    model, rows = _fit_here(spark, d)
    scored = ML.score(model, _judged(rows)).drop("ranking")
    both = ML.hybrid(_train(rows), scored)
    return both.select("numero", "previsto", "previsto_hibrido", "no_dicionario")


add("j12_dictionary_with_model_fallback", _hybrid)
