"""Daily volume: ridge regression, naive baselines, forecast rows, experiments."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketry.functions import columns as C
from ticketry.operators import metrics, series as TS
from ticketry.plans import registry, ridge as RD
from ticketry.schema import Rules
from ticketry.session import settled

DAY, KEY, VALUE = TS.DAY, TS.KEY, TS.VALUE
FAMILY, MODEL_NAME, NAIVE_NAME, NAIVE_VERSION = "volume_d7", "ridge_d7", "persistencia", "1.0"
PREDICTION = "prediction"


def ridge(train: DataFrame, target: str, alpha: float) -> LinearRegression:
    """A Spark regression whose penalty equals ``alpha * |w|^2`` on the plain sum of squares.

    Spark minimises the mean squared error over 2 on a target scaled by its deviation, so the
    penalty is alpha / n times that deviation.
    """
    row = train.agg(F.count(target).alias("n"), F.stddev_pop(F.col(target).cast("double")).alias("s")).first()
    penalty = alpha / row["n"] * (row["s"] or 0.0) if row["n"] else 0.0
    return LinearRegression(featuresCol="features", labelCol=target, predictionCol=PREDICTION, elasticNetParam=0.0,
                            standardization=False, solver="normal", regParam=penalty)


@dataclass(frozen=True)
class Regressor:
    """One model family with its settings: linear, ridge, forest, boosted or naive."""

    kind: str
    alpha: float = 0.0
    depth: int = 4
    trees: int = 200
    min_rows: int = 3
    step: float = 0.05
    naive: str = "naive_d7"

    def estimator(self, train: DataFrame, target: str):
        if self.kind in ("linear", "ridge"):
            return ridge(train, target, self.alpha if self.kind == "ridge" else 0.0)
        if self.kind == "forest":
            return RandomForestRegressor(featuresCol="features", labelCol=target, predictionCol=PREDICTION, seed=42,
                                         numTrees=self.trees, maxDepth=self.depth, minInstancesPerNode=self.min_rows)
        if self.kind == "boosted":
            return GBTRegressor(featuresCol="features", labelCol=target, predictionCol=PREDICTION, seed=42,
                                maxIter=self.trees, maxDepth=self.depth, stepSize=self.step)
        raise ValueError(f"unknown model family: {self.kind}")


def fit(train: DataFrame, features: Sequence[str], target: str, model: Regressor) -> PipelineModel:
    train = train.withColumn(target, F.col(target).cast("double"))
    assemble = VectorAssembler(inputCols=list(features), outputCol="features")
    fitted = model.estimator(train, target).fit(assemble.transform(train))
    return PipelineModel([assemble, fitted])


def predict(model: PipelineModel, rows: DataFrame, out: str = "valor_previsto") -> DataFrame:
    """Predictions with negative values cut to 0."""
    return model.transform(rows).withColumn(out, C.clip_at_zero(PREDICTION)).drop("features", PREDICTION)


def split_column(rules: Rules, strategy: str) -> Column:
    cuts = (rules.train_end, rules.val_end) if strategy == "II" else (rules.family_train_end, rules.family_val_end)
    return C.split_by_cuts(DAY, *cuts)


def with_split(dataset: DataFrame, rules: Rules = Rules(), strategy: str = "II") -> DataFrame:
    """Strategy I cuts before the regime change is learnt, strategy II after it."""
    return dataset.withColumn("split", split_column(rules, strategy))


def training_frame(series: DataFrame, rules: Rules = Rules(), target: str = "target_d7") -> DataFrame:
    return with_split(TS.volume_dataset(series, rules), rules).dropna(subset=[target])


@dataclass
class Trained:
    model: PipelineModel
    metrics_val: dict
    metrics_test: dict
    period: dict


def train(series: DataFrame, rules: Rules = Rules(), target: str = "target_d7") -> Trained:
    """Fit on TRAIN for the figures, then on TRAIN + VAL for use. TEST is in neither fit."""
    data = settled(training_frame(series, rules, target))
    how = Regressor("ridge", alpha=rules.ridge_alpha)
    judged = fit(data.where("split = 'TRAIN'"), rules.d7_features, target, how)
    scores = {
        r["split"]: {k: r[k] for k in ("mae", "rmse", "smape_pct", "r2", "n")}
        for r in metrics.regression(predict(judged, data.where("split <> 'TRAIN'")), target, "valor_previsto", ["split"]).collect()
    }
    known = data.where("split <> 'TEST'")
    used = fit(known, rules.d7_features, target, how)
    span = known.agg(F.min(DAY).cast("string").alias("inicio"), F.max(DAY).cast("string").alias("fim")).first().asDict()
    return Trained(used, scores.get("VAL", {}), scores.get("TEST", {}), span)


def save(spark, base: str, trained: Trained, rules: Rules = Rules(), version: str = "v1") -> str:
    meta = registry.describe(
        MODEL_NAME, version, "regressao", "volume_total(t+7)", rules.d7_features, {"alpha": rules.ridge_alpha},
        trained.period, trained.metrics_val, trained.metrics_test,
        "Figures come from a fit on TRAIN only; the stored model is fitted on TRAIN and VAL.")
    return registry.save(spark, base, FAMILY, trained.model, meta)


def out_of_sample(series: DataFrame, rules: Rules = Rules(), target: str = "target_d7") -> DataFrame:
    """Rows the stored model never saw, the only ones it may be judged on."""
    return training_frame(series, rules, target).where("split = 'TEST'")


def _rows(df: DataFrame, value: str, horizon: str, model: str, version: str) -> DataFrame:
    return df.select(
        F.col(DAY).alias("data_referencia"), F.col(KEY).alias("serie"), F.lit(horizon).alias("horizonte"),
        F.col(value).cast("double").alias("valor_previsto"), F.lit(model).alias("modelo_utilizado"),
        F.lit(version).alias("versao_modelo"))


def persistence_rows(series: DataFrame, dates: DataFrame) -> DataFrame:
    """Tomorrow as today, for the given (serie, data_abertura)."""
    return _rows(series.join(dates.select(KEY, DAY), [KEY, DAY], "left_semi"), VALUE, "D+1", NAIVE_NAME, NAIVE_VERSION)


@dataclass
class Forecast:
    """Rows for the forecast table, figures on the unseen days, and the written frame behind both."""

    rows: DataFrame
    metrics: DataFrame
    scored: DataFrame


def forecast(series: DataFrame, model: PipelineModel, rules: Rules = Rules(), name: str = MODEL_NAME,
             version: str = "v1", target: str = "target_d7") -> Forecast:
    """Backfill on the unseen days, one forward row per series, and persistence on the same days.

    The unseen days are scored once; that frame feeds both the figures and the rows.
    """
    scored = settled(predict(model, out_of_sample(series, rules, target)))
    ahead = predict(model, TS.last_day(TS.volume_features(series, rules)))
    days = scored.select(KEY, DAY).unionByName(ahead.select(KEY, DAY))
    d7 = scored.select(KEY, DAY, "valor_previsto").unionByName(ahead.select(KEY, DAY, "valor_previsto"))
    rows = persistence_rows(series, days).unionByName(_rows(d7, "valor_previsto", "D+7", name, version))
    return Forecast(rows, metrics.regression(scored, target, "valor_previsto"), scored)


# -- experiments -------------------------------------------------------------------------
ROLLING_7 = ("rolling_mean_7", "rolling_std_7", "trend_7d")
CALENDAR = ("day_of_week", "is_weekend", "month")
OPERATIONS = ("volume_p_baixa", "volume_p_media", "volume_p_alta", "share_p_baixa", "share_monitoramento", "share_incidente_pai")


def experiment_dataset(daily: DataFrame, rules: Rules = Rules(), widths: Sequence[int] = (7, 14, 28)) -> DataFrame:
    """All candidate features, both targets and both naive forecasts of a dense daily frame."""
    df = TS.with_naive(TS.with_targets(TS.with_calendar(TS.with_regime(
        TS.with_rolling(TS.with_lags(daily, rules.lags), widths), rules))))
    rolling = [f"rolling_{s}_{w}" for w in widths for s in ("mean", "std")] + ["trend_7d"]
    return TS.drop_warm_up(df, [*rules.lag_columns, *rolling])


@dataclass(frozen=True)
class VolumeExperiment:
    name: str
    features: tuple[str, ...]
    model: Regressor
    horizon: str = "D+7"
    strategy: str = "II"

    @property
    def target(self) -> str:
        return "target_d1" if self.horizon == "D+1" else "target_d7"


def run_experiment(dataset: DataFrame, exp: VolumeExperiment, rules: Rules = Rules()) -> DataFrame:
    """Metrics per split of one experiment; the fit sees TRAIN only."""
    data = with_split(dataset, rules, exp.strategy).dropna(subset=[exp.target])
    if exp.model.kind == "naive":
        scored = data.withColumn("valor_previsto", F.col(exp.model.naive).cast("double"))
    else:
        scored = predict(fit(data.where("split = 'TRAIN'"), exp.features, exp.target, exp.model), data)
    return metrics.regression(scored, exp.target, "valor_previsto", ["split"]).select(
        F.lit(exp.name).alias("experimento"), F.lit(exp.horizon).alias("horizonte"), F.lit(exp.strategy).alias("estrategia"),
        F.lit(exp.model.kind).alias("modelo"), "split", "mae", "rmse", "smape_pct", "r2", "n")


def _linear_fits(dataset: DataFrame, exps: Sequence[VolumeExperiment], rules: Rules) -> list[tuple]:
    """(coefficients, constant) of linear and ridge experiments, all from one aggregate."""
    columns = list(dict.fromkeys(f for e in exps for f in e.features))
    samples = {(e.target, e.strategy): RD.Sample(f"{e.target}:{e.strategy}", e.target, split_column(rules, e.strategy) == "TRAIN") for e in exps}
    sums = RD.moments(dataset, columns, list(samples.values()))
    return [sums.solve(samples[e.target, e.strategy].name, e.features, e.model.alpha if e.model.kind == "ridge" else 0.0) for e in exps]


def _linear_table(dataset: DataFrame, exps: Sequence[VolumeExperiment], rules: Rules) -> DataFrame:
    """Metrics of all linear and ridge experiments: one scan for the fits and one for the figures."""
    rows = F.array(*[
        F.struct(F.lit(e.name).alias("experimento"), F.lit(e.horizon).alias("horizonte"), F.lit(e.strategy).alias("estrategia"), F.lit(e.model.kind).alias("modelo"),
                 split_column(rules, e.strategy).alias("split"), F.col(e.target).cast("double").alias("real"), C.clip_at_zero(RD.predicted(e.features, w, b)).alias("valor_previsto"))
        for e, (w, b) in zip(exps, _linear_fits(dataset, exps, rules), strict=True)])
    judged = dataset.select(F.inline(rows)).where("real IS NOT NULL")
    return metrics.regression(judged, "real", "valor_previsto", ["experimento", "horizonte", "estrategia", "modelo", "split"])


def ridge_path(dataset: DataFrame, exps: Sequence[VolumeExperiment], rules: Rules = Rules()) -> DataFrame:
    """experimento, horizonte, alpha, feature, coef of ridge experiments; the constant is feature ''."""
    rows = [(e.name, e.horizon, float(e.model.alpha), f, float(v)) for e, (w, b) in zip(exps, _linear_fits(dataset, exps, rules), strict=True)
            for f, v in [*zip(e.features, w, strict=True), ("", b)]]
    return dataset.sparkSession.createDataFrame(rows, "experimento string, horizonte string, alpha double, feature string, coef double")


def experiment_table(dataset: DataFrame, experiments: Sequence[VolumeExperiment], rules: Rules = Rules()) -> DataFrame:
    """One result table over all experiments; the dataset (one row per day) is written once.

    All linear and ridge experiments share two scans of it, whatever their number.
    """
    dataset = settled(dataset)
    linear = [e for e in experiments if e.model.kind in ("linear", "ridge")]
    parts = [_linear_table(dataset, linear, rules)] if linear else []
    parts += [run_experiment(dataset, e, rules) for e in experiments if e not in linear]
    return reduce(DataFrame.unionByName, parts)


def standard_experiments(rules: Rules = Rules(), horizons: Sequence[str] = ("D+1", "D+7")) -> list[VolumeExperiment]:
    """E00 to E05, E07 and E08: naive, then features added one block at a time, then families."""
    lags = tuple(rules.lag_columns)
    linear = Regressor("linear")
    out = []
    for h in horizons:
        naive = Regressor("naive", naive="naive_d1" if h == "D+1" else "naive_d7")
        least = ("lag_1",) if h == "D+1" else ("lag_7",)
        base = lags + ROLLING_7 if h == "D+1" else lags
        for s in ("I", "II"):
            out.append(VolumeExperiment("E00", (), naive, h, s))
        out += [
            VolumeExperiment("E01", least, linear, h, "I"),
            VolumeExperiment("E02", lags, linear, h, "I"),
            VolumeExperiment("E03", lags + ROLLING_7, linear, h, "I"),
            VolumeExperiment("E04", base + CALENDAR, linear, h, "I"),
            VolumeExperiment("E05", base + OPERATIONS, linear, h, "I"),
            VolumeExperiment("E07_forest", lags, Regressor("forest"), h, "I"),
            VolumeExperiment("E07_boosted", lags, Regressor("boosted", depth=3, trees=100), h, "I"),
            VolumeExperiment("E08", lags + ("periodo_pos_set_2025",), linear, h, "II"),
        ]
    return out


def alpha_grid(features: Sequence[str], alphas: Sequence[float], horizon: str = "D+7", strategy: str = "II") -> list[VolumeExperiment]:
    return [VolumeExperiment(f"ridge_{a}", tuple(features), Regressor("ridge", alpha=a), horizon, strategy) for a in alphas]


def tree_grid(features: Sequence[str], depths: Sequence[int], trees: Sequence[int], horizon: str = "D+7", strategy: str = "II") -> list[VolumeExperiment]:
    return [VolumeExperiment(f"forest_{d}_{t}", tuple(features), Regressor("forest", depth=d, trees=t, min_rows=2), horizon, strategy)
            for d in depths for t in trees]


def best_on_val(results: DataFrame, score: str = "mae", by: Sequence[str] = ("horizonte", "estrategia")) -> DataFrame:
    """The experiment with the lowest VAL score per group; TEST plays no part."""
    val = results.where("split = 'VAL'")
    return val.groupBy(*by).agg(F.min_by("experimento", F.struct(score, "experimento")).alias("vencedor"), F.min(score).alias(f"val_{score}"))


def finalists(results: DataFrame, tolerance: float = 0.03) -> DataFrame:
    """VAL and TEST MAE per finalist, their difference, and whether the VAL score is within
    ``tolerance`` of the best one of its horizon (then the simpler model may be kept)."""
    wide = results.groupBy("experimento", "horizonte", "estrategia", "modelo").pivot("split", ["VAL", "TEST"]).agg(F.first("mae"))
    best = wide.groupBy("horizonte").agg(F.min("VAL").alias("_best"))
    return wide.join(best, "horizonte").select(
        "experimento", "horizonte", "estrategia", "modelo", F.col("VAL").alias("val_mae"), F.col("TEST").alias("test_mae"),
        (F.col("TEST") - F.col("VAL")).alias("delta_val_test"),
        (F.col("VAL") <= F.col("_best") * (1 + tolerance)).alias("equivalente_ao_melhor"))


def coefficients(model: PipelineModel, features: Sequence[str], spark) -> DataFrame:
    """Coefficient per feature, largest absolute value first."""
    values = model.stages[-1].coefficients.toArray()
    return spark.createDataFrame([(f, float(v)) for f, v in zip(features, values)], "feature string, coef double").orderBy(
        F.desc(F.abs("coef")), "feature")
