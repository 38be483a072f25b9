import datetime as dt
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ticketry.operators import checks, series as TS
from ticketry.plans import tickets_ml as ML, volume as V
from ticketry.schema import Rules

RULES = Rules(start="2025-01-01")


def noisy_series(spark, days=365):
    rng = random.Random(5)
    rows = []
    for i in range(days):
        level = 100 if i < 243 else 700
        rows.append(("total", dt.date(2025, 1, 1) + dt.timedelta(i), int(level + 30 * math.sin(i / 3.5) + rng.randint(-20, 20))))
    return spark.createDataFrame(rows, "serie string, data_abertura date, volume_total long")


def test_ridge_matches_the_closed_form(spark):
    frame = V.training_frame(noisy_series(spark), RULES).where("split = 'TRAIN'")
    pdf = frame.toPandas()
    x, y = pdf[RULES.d7_features].to_numpy(float), pdf["target_d7"].to_numpy(float)
    for alpha in (0.001, 50.0):
        xc, yc = x - x.mean(0), y - y.mean()
        want = np.linalg.solve(xc.T @ xc + alpha * np.eye(x.shape[1]), xc.T @ yc)
        model = V.fit(frame, RULES.d7_features, "target_d7", V.Regressor("ridge", alpha=alpha)).stages[-1]
        assert model.coefficients.toArray() == pytest.approx(want, rel=1e-5, abs=1e-6)
        assert model.intercept == pytest.approx(y.mean() - x.mean(0) @ want, rel=1e-5)


def test_splits_and_forecast_rows(spark, base):
    series = noisy_series(spark)
    frame = V.training_frame(series, RULES)
    sizes = {r["split"]: r["count"] for r in frame.groupBy("split").count().collect()}
    assert sizes == {"TRAIN": 276, "VAL": 30, "TEST": 24}
    trained = V.train(series, RULES)
    assert trained.metrics_val["n"] == 30 and trained.metrics_test["n"] == 24
    assert trained.period == {"inicio": "2025-01-29", "fim": "2025-11-30"}
    V.save(spark, base, trained, RULES)
    from ticketry.plans import registry
    loaded = registry.load(spark, base, V.FAMILY)
    out = V.forecast(series, loaded.model, RULES)
    rows = out.rows.collect()
    assert len(rows) == 50 and Counter(r["horizonte"] for r in rows) == {"D+1": 25, "D+7": 25}
    assert min(r["data_referencia"] for r in rows) == dt.date(2025, 12, 1)
    assert max(r["data_referencia"] for r in rows) == dt.date(2025, 12, 31)
    checks.gate(checks.forecast_table(out.rows))
    assert out.metrics.first()["n"] == 24


def test_forecasts_are_never_negative(spark):
    series = noisy_series(spark)
    frame = V.training_frame(series, RULES)
    model = V.fit(frame, ["lag_1"], "target_d7", V.Regressor("linear"))
    low = frame.withColumn("lag_1", F.lit(-10**6))
    assert V.predict(model, low).agg(F.min("valor_previsto")).first()[0] == 0.0


def test_experiment_table_and_winner(spark):
    daily = noisy_series(spark)
    data = V.experiment_dataset(daily, RULES)
    results = V.experiment_table(data, [
        V.VolumeExperiment("naive", (), V.Regressor("naive")),
        V.VolumeExperiment("linear", tuple(RULES.lag_columns), V.Regressor("linear")),
        V.VolumeExperiment("boosted", tuple(RULES.lag_columns), V.Regressor("boosted", depth=3, trees=5)),
    ], RULES)
    assert results.count() == 9
    best = V.best_on_val(results).first()
    val = {r["experimento"]: r["mae"] for r in results.where("split = 'VAL'").collect()}
    assert best["vencedor"] == min(val, key=val.get)
    assert V.finalists(results).where("equivalente_ao_melhor").count() >= 1


# -- text --------------------------------------------------------------------------------
TRAIN_TEXTS = ["Disco cheio no servidor", "usuário sem acesso", "Disco lento", "acesso negado ao usuário", "servidor é lento x", ""]


def test_tfidf_matches_the_formula(spark):
    df = spark.createDataFrame([(i, t, "p1") for i, t in enumerate(TRAIN_TEXTS)], f"i int, {ML.TEXT} string, {ML.PRODUCT} string")
    what = ML.TextFeatures(categories=(), max_ngram=2)
    model = ML.fit_features(df, what)
    names = [n.removeprefix("texto__") for n in ML.feature_names(model, what)]
    import re

    def terms(t):
        words = re.findall(r"\b\w\w+\b", t.lower())
        return words + [" ".join(p) for p in zip(words, words[1:])]
    docs = [terms(t) for t in TRAIN_TEXTS]
    assert set(names) == {w for d in docs for w in d} and "usuário" in names
    n = len(docs)
    idf = {w: math.log((1 + n) / (1 + sum(w in d for d in docs))) + 1 for w in names}
    for row in model.transform(df).select("i", "features").collect():
        tf = Counter(docs[row["i"]])
        want = np.array([tf[w] * idf[w] for w in names])
        if want.any():
            want = want / np.linalg.norm(want)
        assert row["features"].toArray() == pytest.approx(want)


def test_unknown_category_has_no_column(spark):
    train = spark.createDataFrame([("a", "b1"), ("b", "b2"), ("c", "b1")], f"{ML.PRODUCT} string, canal string")
    what = ML.TextFeatures(None, (ML.PRODUCT, "canal"))
    model = ML.fit_features(train, what)
    assert ML.feature_names(model, what) == [f"{ML.PRODUCT}__a", f"{ML.PRODUCT}__b", f"{ML.PRODUCT}__c", "canal__b1", "canal__b2"]
    row = model.transform(spark.createDataFrame([("new", "b2")], f"{ML.PRODUCT} string, canal string")).first()
    assert list(row["features"].toArray()) == [0, 0, 0, 0, 1]


def tickets(spark):
    """Months Sep to Dec 2025; the class follows the text, but one template flips in December."""
    rows = []
    for month in (9, 10, 11, 12):
        for i in range(90):
            kind = i % 3
            text = [f"Disk I/O is overloaded on IC{i:05d}", "rede: falha geral", f"login do usuário {i % 7}"][kind]
            label = ["3 - Média" if month == 12 else "4 - Baixa", "2 - Alta", "3 - Média"][kind]
            rows.append((f"INC{month}{i:03d}", dt.datetime(2025, month, 1 + i % 28, i % 24), dt.date(2025, month, 1 + i % 28), label,
                         "Não informado" if i % 4 else f"prod{kind}", None if i == 5 else text))
    rows.append(("INCX", dt.datetime(2025, 12, 1), dt.date(2025, 12, 1), "1 - Crítica", "p", "raro"))
    return spark.createDataFrame(rows, f"numero string, aberto timestamp_ntz, data_abertura date, prioridade string, produto string, {ML.TEXT} string")


def test_ticket_model_end_to_end(spark, base):
    rules = Rules()
    silver = tickets(spark)
    trained = ML.train(silver, rules)
    assert trained.metrics_val["n"] == 90 and trained.metrics_val["f1_macro"] > 0.95
    assert trained.metrics_test["accuracy"] < 0.75  # the flipped template
    assert trained.period == {"inicio": "2025-09-01", "fim": "2025-10-28"}
    ML.save(spark, base, trained, rules)
    fitted = ML.load(spark, base)
    table, quality = ML.predict_unseen(silver, fitted, rules)
    assert table.count() == 180 and quality.first()["n"] == 180
    checks.gate(checks.ticket_forecast_table(table, rules))
    months = {r["m"] for r in table.select(F.month("data_abertura").alias("m")).distinct().collect()}
    assert months == {11, 12}
    suggested = ML.suggest(fitted, ML.prepared(ML.population(silver, rules), rules), 2).first()
    assert len(suggested["sugestoes"]) == 2 and suggested["sugestoes"][0]["score"] >= suggested["sugestoes"][1]["score"]
    assert suggested["sugestoes"][0]["classe"] == suggested["previsto"]
    terms = ML.top_terms(ML.FittedText(fitted.model, fitted.labels, ML.default_features(rules)), spark, 5)
    best = {r["classe"]: r["termo"] for r in terms.where("posicao = 1").collect()}
    assert any(w in best["2 - Alta"] for w in ("rede", "falha", "geral"))


def test_scoring_works_after_a_write_was_observed(spark):
    """Observed writes hang on the session; a scoring model must not carry the session along."""
    from pyspark.sql import Observation
    seen = Observation()
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get["n"] == 3
    rows = ML.prepared(tickets(spark).where(F.col("prioridade") != "1 - Crítica"), Rules())
    two = rows.where(F.col(ML.LABEL) != "2 - Alta")
    for how in (ML.TextModel("svc", max_iter=5), ML.TextModel("logistic", max_iter=5), ML.TextModel("hinge", max_iter=5)):
        fitted = ML.fit(two, ML.LABEL, ML.default_features(), how)
        assert len(fitted.labels) == 2 and len(ML.score(fitted, two).collect()) == 240
    fitted = ML.fit(two, ML.LABEL, ML.TextFeatures(None), ML.TextModel("forest", trees=2, depth=2))
    assert len(ML.score(fitted, two).collect()) == 240


def test_drift_slice(spark):
    out = ML.template_drift(tickets(spark), "disk i/o", ["4 - Baixa", "3 - Média"], ["baixa", "media"]).collect()
    assert {(r["mes_ref"].month, r["modelo"], r["baixa"] > 0, r["media"] > 0) for r in out} == {
        (m, "Disk I/O is overloaded on <IC>", m != 12, m == 12) for m in (9, 10, 11, 12)}


def test_experiments_with_weights_and_forest(spark):
    rows = ML.with_split(ML.prepared(ML.population(tickets(spark)), Rules()))
    train, judged = rows.where("split = 'TRAIN'"), rows.where("split = 'VAL'").withColumn("seen_in_train", F.col(ML.TEXT) != "")
    out = ML.experiment_table(train, judged, [
        ML.TextExperiment("svm", ML.TextFeatures(), ML.TextModel("svc", balanced=True, max_iter=10)),
        ML.TextExperiment("lr", ML.TextFeatures(categories=()), ML.TextModel("logistic", max_iter=10)),
        ML.TextExperiment("rf", ML.TextFeatures(None), ML.TextModel("forest", trees=3, depth=2)),
    ], Rules().priority_classes)
    assert {r["experimento"] for r in out.collect()} == {"svm", "lr", "rf"}
    assert ML.best(out).first()["experimento"] in ("svm", "lr")
    with pytest.raises(ValueError):
        ML.run_experiment(train, judged, ML.TextExperiment("bad", ML.TextFeatures("categoria"), ML.TextModel()))
    assert ML.simpler_if_close(0.70, 0.69) and not ML.simpler_if_close(0.80, 0.69)


def test_rare_cuts_are_fitted_as_in_the_reference(spark, monkeypatch):
    from ticketry.catalog import learning
    seen = []
    monkeypatch.setattr(learning, "_category_rows", lambda spark, d: spark.range(0).selectExpr("true AS rotulado", "'TRAIN' AS split"))
    monkeypatch.setattr(learning.ML, "rare_label_experiments", lambda *args: seen.append(args))
    learning._rare_cuts(spark, "")
    (*_, how, cuts), = seen
    assert (how.kind, how.max_iter, how.balanced, cuts) == ("logistic", 300, True, (10, 20, 30, 50))
