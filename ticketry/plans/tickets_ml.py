"""Ticket text classification: features, models, scoring, experiments."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    LinearSVC, OneVsRest, RandomForestClassifier,
)
from pyspark.ml.feature import (
    IDF, CountVectorizer, ElementwiseProduct, NGram, Normalizer, OneHotEncoder, RegexTokenizer, SQLTransformer,
    StringIndexer, VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticketry.functions import columns as C
from ticketry.functions import text as T
from ticketry.operators import baselines, metrics, novelty
from ticketry.plans import boosting as BT, forest as FO, linear_text as LT, registry
from ticketry.schema import Rules
from ticketry.session import keep, settled

FAMILY, MODEL_NAME = "prioridade", "linearsvc_prioridade"
LABEL, TEXT, PRODUCT = "prioridade", "descricao_resumida", "produto_prep"
FEATURES = [TEXT, PRODUCT]
#: Labels and category values become columns and are held on the driver; more of them are an error.
MOST_VALUES = 100_000


# -- population and features -------------------------------------------------------------
def population(silver: DataFrame, rules: Rules = Rules(), extra: Sequence[str] = ()) -> DataFrame:
    """Tickets of the modelled classes in the modelled period. Both filters reach the scan."""
    opened = F.col("aberto")
    return silver.where(
        F.col(LABEL).isin(*rules.priority_classes)
        & (opened >= F.lit(rules.priority_from).cast("timestamp_ntz"))
        & (opened < F.lit(rules.priority_until).cast("timestamp_ntz"))
    ).select("numero", "aberto", "data_abertura", LABEL, "produto", TEXT, *extra)


def category_population(silver: DataFrame, rules: Rules = Rules(), priorities: Sequence[str] | None = None,
                        extra: Sequence[str] = ()) -> DataFrame:
    """Tickets of the two upper modelled priorities with a flag for those that carry a category,
    split by opening day around the regime change."""
    priorities = list(priorities or rules.priority_classes[:2])
    labelled = F.col("categoria").isNotNull() & (F.col("categoria") != rules.default_label)
    return silver.where(F.col(LABEL).isin(*priorities)).select(
        "numero", "aberto", "data_abertura", LABEL, "produto", "categoria", TEXT, *extra,
        labelled.alias("rotulado"), C.split_by_cuts("data_abertura", rules.family_train_end, rules.family_val_end).alias("split"))


def prepared(df: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Text without NULLs; the default product label becomes the model's own unknown label."""
    product = F.coalesce(F.col("produto"), F.lit(rules.unknown_product))
    return df.withColumns({
        TEXT: F.coalesce(F.col(TEXT), F.lit("")),
        PRODUCT: F.when(product == rules.default_label, F.lit(rules.unknown_product)).otherwise(product),
    })


def with_split(df: DataFrame, rules: Rules = Rules()) -> DataFrame:
    return df.withColumn("split", C.split_by_months(
        "aberto", rules.priority_train_months, rules.priority_val_months, rules.priority_test_months))


def with_calendar(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "hora": F.hour("aberto"), "dia_semana": C.monday_zero("aberto"), "mes_abertura": F.month("aberto"),
        "fim_de_semana": C.is_weekend("aberto")})


def text_variants(df: DataFrame, column: str = TEXT) -> DataFrame:
    """The text as it is, as a template, and as a template followed by its item ids."""
    return df.withColumns({
        "texto_a": F.coalesce(F.col(column), F.lit("")),
        "texto_b": F.coalesce(T.as_template(column), F.lit("")),
        "texto_c": T.template_with_items(column),
    })


# -- feature matrix ----------------------------------------------------------------------
@dataclass(frozen=True)
class TextFeatures:
    """What goes into the matrix: a text block, one-hot blocks and plain numbers."""

    text: str | None = TEXT
    categories: tuple[str, ...] = (PRODUCT,)
    numbers: tuple[str, ...] = ()
    max_ngram: int = 2
    min_df: float = 1
    max_features: int | None = 20000

    @property
    def columns(self) -> list[str]:
        return [*([self.text] if self.text else []), *self.categories, *self.numbers]


def fit_features(train: DataFrame, what: TextFeatures) -> PipelineModel:
    """TF-IDF of the text beside one-hot categories and numbers as vectors, for classifiers that need them; learned on ``train``.

    Spark's stages hold the vocabulary on the driver, so a text needs a bound on its terms; the linear models have none.

    The inverse document frequency is ln((1 + n) / (1 + df)) + 1; Spark's own lacks the + 1, so
    the learned vector plus 1 is applied as a scaling stage, before rows are brought to length 1.
    A category not seen in ``train`` gets no column at all.
    """
    stages, blocks = [], []
    if what.text and what.max_features is None:
        raise ValueError("max_features bounds the vocabulary that this matrix keeps on the driver")
    if what.text:
        words = [RegexTokenizer(inputCol=what.text, outputCol="_w1", pattern=T.WORD, gaps=False, toLowercase=True)]
        for n in range(2, what.max_ngram + 1):
            words.append(NGram(n=n, inputCol="_w1", outputCol=f"_w{n}"))
        grams = ", ".join(f"_w{n}" for n in range(1, what.max_ngram + 1))
        words.append(SQLTransformer(statement=f"SELECT *, concat({grams}) AS _terms FROM __THIS__"))
        words.append(CountVectorizer(inputCol="_terms", outputCol="_tf", minDF=what.min_df,
                                     vocabSize=what.max_features))
        counted = Pipeline(stages=words).fit(train)
        idf = IDF(inputCol="_tf", outputCol="_idf").fit(counted.transform(train)).idf
        stages += counted.stages
        stages.append(ElementwiseProduct(inputCol="_tf", outputCol="_scaled", scalingVec=Vectors.dense(idf.toArray() + 1.0)))
        stages.append(Normalizer(inputCol="_scaled", outputCol="_text", p=2.0))
        blocks.append("_text")
    if what.categories:
        index = StringIndexer(inputCols=list(what.categories), outputCols=[f"_i_{c}" for c in what.categories],
                              handleInvalid="keep", stringOrderType="alphabetAsc").fit(train)
        hot = OneHotEncoder(inputCols=[f"_i_{c}" for c in what.categories], outputCols=[f"_h_{c}" for c in what.categories],
                            dropLast=True).fit(index.transform(train))
        stages += [index, hot]
        blocks += [f"_h_{c}" for c in what.categories]
    blocks += list(what.numbers)
    stages.append(VectorAssembler(inputCols=blocks, outputCol="features"))
    return PipelineModel(stages)


def feature_names(model: PipelineModel, what: TextFeatures) -> list[str]:
    """Column names of the matrix, in order."""
    names = []
    for stage in model.stages:
        if hasattr(stage, "vocabulary"):
            names += [f"texto__{w}" for w in stage.vocabulary]
    for stage in model.stages:
        if hasattr(stage, "labelsArray"):
            for column, labels in zip(what.categories, stage.labelsArray):
                names += [f"{column}__{v}" for v in labels]
    return names + list(what.numbers)


@dataclass(frozen=True)
class TextModel:
    """svc (squared hinge), logistic, hinge (Spark's own SVM), forest or boosted, with its settings.

    30 is the deepest that Spark's forests go, as good as unlimited for rows that fit a leaf before.
    """

    kind: str = "svc"
    c: float = 1.0
    balanced: bool = False
    max_iter: int = 1000
    trees: int = 300
    depth: int = 30

    @property
    def linear(self) -> bool:
        return self.kind in ("svc", "logistic")

    def estimator(self, rows: int, times: str | None = None):
        """Spark's classifier for so many rows; ``times``: the column that says how many of them one stands for."""
        weight = {"weightCol": "peso"} if self.balanced else {}
        if self.kind == "hinge":
            weight = weight or ({"weightCol": times} if times else {})
            one = LinearSVC(regParam=1.0 / (self.c * max(rows, 1)), maxIter=self.max_iter, standardization=False)
            return OneVsRest(classifier=one, labelCol="_y", featuresCol="features", parallelism=4, **weight)
        if self.kind == "forest":
            return RandomForestClassifier(labelCol="_y", featuresCol="features", numTrees=self.trees, maxDepth=self.depth,
                                          seed=42, **weight)
        raise ValueError(f"unknown model family: {self.kind}")


@dataclass
class FittedText:
    """A fitted matrix and classifier; ``labels`` maps class numbers to class names."""

    model: PipelineModel | LT.LinearModel | BT.BoostedModel | FO.ForestModel
    labels: list[str]
    what: TextFeatures = field(default_factory=TextFeatures)


def require_few_values(df: DataFrame, columns: Sequence[str], most: int = MOST_VALUES) -> None:
    """Raise if a column has more than about ``most`` values: bucket its rare ones first."""
    if columns:
        row = df.agg(*[F.approx_count_distinct(c).alias(c) for c in columns]).first()
        if bad := {c: row[c] for c in columns if row[c] > most}:
            raise ValueError(f"too many values for one column each: {bad}")


def fit_all(train: DataFrame, label: str, what: TextFeatures, hows: Sequence[TextModel]) -> list[FittedText]:
    """Fit the matrix once for the linear classifiers and once for the others, and every classifier on it."""
    train = train.where(F.col(label).isNotNull())
    require_few_values(train, [label, *what.categories])
    out: dict[int, FittedText] = {}
    linear = [i for i, how in enumerate(hows) if how.linear]
    if linear:
        labels, models = LT.fit_linear(train, label, what, [hows[i] for i in linear])
        out |= {i: FittedText(model, labels, what) for i, model in zip(linear, models, strict=True)}
    for i, how in enumerate(hows):
        if how.kind == "boosted":
            out[i] = _fit_boosted(train, label, what, how)
        elif how.kind == "forest" and not what.text and what.columns and (fitted := _fit_forest(train, label, what, how)):
            out[i] = fitted
    if others := [i for i in range(len(hows)) if i not in out]:
        out |= dict(zip(others, _fit_stages(train, label, what, [hows[i] for i in others]), strict=True))
    return [out[i] for i in range(len(hows))]


def _fit_boosted(train: DataFrame, label: str, what: TextFeatures, how: TextModel) -> FittedText:
    """One model over all classes; balanced classes weigh as much as the largest one. Text is no column for trees."""
    if what.text:
        raise ValueError("boosted trees take categories and numbers only")
    per_label = {r[0]: r[1] for r in train.groupBy(label).count().collect()}
    labels = sorted(per_label)
    place = F.create_map(*[x for i, v in enumerate(labels) for x in (F.lit(v), F.lit(i))])
    weight = F.create_map(*[x for v in labels for x in (F.lit(v), F.lit(max(per_label.values()) / per_label[v] if how.balanced else 1.0))])
    values = {c: sorted(r[0] for r in train.select(F.col(c).cast("string").alias("v")).where("v IS NOT NULL").distinct().collect()) for c in what.categories}
    model = BT.fit(train, F.element_at(place, F.col(label)), F.element_at(weight, F.col(label)), len(labels), values, what.numbers, BT.Boosting(how.trees, how.depth))
    return FittedText(model, labels, what)


def _fit_forest(train: DataFrame, label: str, what: TextFeatures, how: TextModel) -> FittedText | None:
    """Whole trees side by side where the different rows are few; None where they are not, which is work for Spark's own forest."""
    per_label = {r[0]: r[1] for r in train.groupBy(label).count().collect()}
    labels, total = sorted(per_label), sum(per_label.values())
    place = F.create_map(*[x for i, v in enumerate(labels) for x in (F.lit(v), F.lit(i))])
    found = {c: sorted(r[0] for r in train.select(F.col(c).cast("string").alias("v")).where("v IS NOT NULL").distinct().collect()) for c in what.categories}
    categories, numbers = {c: {v: i for i, v in enumerate(values)} for c, values in found.items()}, FO.borders(train, what.numbers)
    cells, few = FO.cells(train, F.element_at(place, F.col(label)), len(labels), categories, numbers)
    if not few:
        return None
    weights = [total / (len(labels) * per_label[v]) if how.balanced else 1.0 for v in labels]
    return FittedText(FO.fit(cells, weights, categories, numbers, how.trees, how.depth), labels, what)


def _fit_stages(train: DataFrame, label: str, what: TextFeatures, hows: Sequence[TextModel]) -> list[FittedText]:
    """Spark's own classifiers on a matrix of vectors, which is cached meanwhile.

    For margins, equal rows are one that weighs as often as it occurs; a forest draws its rows one by one.
    """
    weights = [c for c in ("peso",) if any(how.balanced for how in hows)]
    if weights:
        train = train.join(F.broadcast(baselines.class_weights(train, label)), label)
    index = StringIndexer(inputCol=label, outputCol="_y", stringOrderType="alphabetAsc", handleInvalid="error").fit(train)
    matrix = fit_features(train, what)
    n, rows, times = train.count(), train, []
    if all(how.kind == "hinge" for how in hows):
        rows = train.groupBy(label, *dict.fromkeys(c for c in what.columns if c != label), *weights).agg(F.count(F.lit(1)).cast("double").alias("_times"))
        times = ["_times"]
    each = F.col("_times") if times else F.lit(1.0)
    ready = keep(matrix.transform(index.transform(rows)).select("features", "_y", *times, *[(F.col(c) * each).alias(c) for c in weights]))
    try:
        return [FittedText(PipelineModel([*matrix.stages, *_scoring_stages(how.estimator(n, *times).fit(ready))]), list(index.labels), what)
                for how in hows]
    finally:
        ready.unpersist()


def fit(train: DataFrame, label: str, what: TextFeatures, how: TextModel) -> FittedText:
    """Fit matrix and classifier on ``train``."""
    return fit_all(train, label, what, [how])[0]


def _scoring_stages(fitted) -> list:
    """One stage per class for a one-against-rest model, so that scoring stays in the JVM.

    A fitted binary model drags its training summary, and with it the session, into every task;
    a copy leaves the summary behind.
    """
    if not hasattr(fitted, "models"):
        return [fitted.copy()]
    out = []
    for i, one in enumerate(fitted.models):
        one = one.copy().setFeaturesCol("features").setRawPredictionCol(f"_raw_{i}").setPredictionCol(f"_pred_{i}")
        out.append(one.setProbabilityCol(f"_prob_{i}") if hasattr(one, "setProbabilityCol") else one)
    return out


def _margins(stages: list):
    """Score of every class, in the order of the labels."""
    binary = [m for m in stages if hasattr(m, "getRawPredictionCol") and m.getRawPredictionCol().startswith("_raw_")]
    if not binary:
        return vector_to_array(F.col("rawPrediction"))
    return F.array(*[vector_to_array(F.col(m.getRawPredictionCol()))[1] for m in binary])


def score(fitted: FittedText, rows: DataFrame, out: str = "previsto") -> DataFrame:
    """Predicted class, its score and all classes ranked by score.

    The score of a margin classifier is no probability.
    """
    labels = F.array(*[F.lit(x) for x in fitted.labels])
    if not isinstance(fitted.model, PipelineModel):
        by = LT if isinstance(fitted.model, LT.LinearModel) else FO if isinstance(fitted.model, FO.ForestModel) else BT
        scored, scores = by.with_margins(fitted.model, rows), F.col("_margins")
    else:
        scored, scores = fitted.model.transform(rows), _margins(fitted.model.stages)
    by_rank = F.array_sort(F.arrays_zip(F.transform(scores, lambda x: -x).alias("menos"), labels.alias("classe")))
    ranked = F.transform(by_rank, lambda x: F.struct((-x["menos"]).alias("score"), x["classe"].alias("classe")))
    scored = scored.select(*rows.columns, ranked.alias("ranking"))
    return scored.withColumns({
        out: F.col("ranking")[0]["classe"], "score_vencedor": F.col("ranking")[0]["score"]})


def top_labels(ranking: str = "ranking", k: int = 3):
    return F.transform(F.slice(F.col(ranking), 1, k), lambda x: x["classe"])


# -- production flow ---------------------------------------------------------------------
def default_features(rules: Rules = Rules()) -> TextFeatures:
    return TextFeatures(TEXT, (PRODUCT,), (), rules.max_ngram, rules.min_df, rules.max_features)


@dataclass
class TrainedText:
    fitted: FittedText
    metrics_val: dict
    metrics_test: dict
    period: dict


def _report(scored: DataFrame, labels: Sequence[str]) -> dict[str, dict]:
    """Figures per split. The model runs once; everything else works on the confusion counts."""
    counts = settled(scored.groupBy("split", LABEL, "previsto").agg(F.count(F.lit(1)).alias("n")))
    overall = metrics.classification(counts, LABEL, "previsto", ["split"], labels, "n")
    recalls = metrics.class_recall(counts, LABEL, "previsto", labels, ["split"], "n")
    out = {}
    for r in overall.join(recalls, "split").collect():
        row = r.asDict()
        recall = {label: row.pop(f"recall_{i + 1}") for i, label in enumerate(labels)}
        out[row.pop("split")] = {**row, "recall_por_classe": recall}
    return out


def train(silver: DataFrame, rules: Rules = Rules(), what: TextFeatures | None = None, how: TextModel | None = None) -> TrainedText:
    """One fit on TRAIN, judged on VAL and TEST; there is no second fit for use."""
    what = what or default_features(rules)
    how = how or TextModel("svc", c=rules.svc_c)
    novelty.require_no_leakage(what.columns)
    data = settled(with_split(prepared(population(silver, rules), rules), rules))
    learn = data.where("split = 'TRAIN'")
    fitted = fit(learn, LABEL, what, how)
    scores = _report(score(fitted, data.where("split in ('VAL', 'TEST')")), rules.priority_classes)
    span = learn.agg(F.min("data_abertura").cast("string").alias("inicio"), F.max("data_abertura").cast("string").alias("fim")).first()
    return TrainedText(fitted, scores.get("VAL", {}), scores.get("TEST", {}), span.asDict())


def save(spark, base: str, trained: TrainedText, rules: Rules = Rules(), version: str = "v1") -> str:
    meta = registry.describe(
        MODEL_NAME, version, "classificacao", LABEL, trained.fitted.what.columns,
        {"C": rules.svc_c, "ngram": rules.max_ngram, "min_df": rules.min_df, "max_features": rules.max_features,
         "classes": trained.fitted.labels, "ajuste": trained.fitted.model.fits},
        trained.period, trained.metrics_val, trained.metrics_test,
        "For assisted triage only. The score is a margin, not a probability.")
    return registry.save(spark, base, FAMILY, trained.fitted.model, meta)


def load(spark, base: str) -> FittedText:
    loaded = registry.load(spark, base, FAMILY, LT.LinearModel.read_from)
    return FittedText(loaded.model, loaded.metadata["hiperparametros"]["classes"])


def predict_unseen(silver: DataFrame, fitted: FittedText, rules: Rules = Rules(), name: str = MODEL_NAME,
                   version: str = "v1") -> tuple[DataFrame, DataFrame]:
    """(rows for the forecast table, metrics) over VAL and TEST; TRAIN is never scored."""
    rows = with_split(prepared(population(silver, rules), rules), rules).where("split in ('VAL', 'TEST')")
    scored = settled(score(fitted, rows))
    table = scored.select(
        "numero", "data_abertura", F.col(LABEL).alias("prioridade_real"), F.col("previsto").alias("prioridade_prevista"),
        "score_vencedor", F.lit(name).alias("modelo_utilizado"), F.lit(version).alias("versao_modelo"))
    return table, metrics.classification(scored, LABEL, "previsto", (), rules.priority_classes)


def suggest(fitted: FittedText, rows: DataFrame, k: int = 3) -> DataFrame:
    """The ``k`` best classes of every row with their scores, best first."""
    return score(fitted, rows).withColumn("sugestoes", F.slice("ranking", 1, k)).drop("ranking")


def top_terms(fitted: FittedText, spark, k: int = 12) -> DataFrame:
    """The ``k`` features with the largest weight per class, from the model's tables; ties go by name."""
    model = fitted.model
    parts = [model.values.select(F.concat("coluna", F.lit("__"), "valor").alias("termo"), "w")]
    if model.terms is not None:
        parts.append(model.terms.select(F.concat(F.lit("texto__"), "term").alias("termo"), "w"))
    if model.numbers:
        parts.append(spark.createDataFrame(list(model.numbers.items()), "termo string, w array<double>"))
    each = reduce(DataFrame.unionByName, parts).select("termo", F.posexplode("w").alias("_k", "peso"))
    place = F.row_number().over(Window.partitionBy("_k").orderBy(F.desc("peso"), "termo"))
    best = each.withColumn("posicao", place).where(F.col("posicao") <= k)
    names = F.array(*[F.lit(x) for x in fitted.labels])
    return best.select(F.element_at(names, F.col("_k") + 1).alias("classe"), "posicao", "termo", "peso")


# -- experiments -------------------------------------------------------------------------
@dataclass(frozen=True)
class TextExperiment:
    name: str
    what: TextFeatures
    how: TextModel
    label: str = LABEL


def run_experiment(train_rows: DataFrame, judged: DataFrame, exp: TextExperiment, labels: Sequence[str] | None = None,
                   seen: str = "seen_in_train") -> DataFrame:
    """Metrics on COMPLETE, SEEN and NEW of one experiment."""
    novelty.require_no_leakage(exp.what.columns)
    return judged_by(fit(train_rows, exp.label, exp.what, exp.how), judged, exp, labels, seen)


def judged_by(fitted: FittedText, judged: DataFrame, exp: TextExperiment, labels: Sequence[str] | None = None,
              seen: str = "seen_in_train") -> DataFrame:
    scored = score(fitted, judged)
    return metrics.sliced_classification(scored, exp.label, "previsto", seen, (), labels).withColumn(
        "experimento", F.lit(exp.name))


def experiment_table(train_rows: DataFrame, judged: DataFrame, experiments: Sequence[TextExperiment],
                     labels: Sequence[str] | None = None, seen: str = "seen_in_train") -> DataFrame:
    """One result table; experiments on the same matrix share it."""
    train_rows, judged = settled(train_rows), settled(judged)
    alike: dict[tuple[str, TextFeatures], list[TextExperiment]] = {}
    for exp in experiments:
        alike.setdefault((exp.label, exp.what), []).append(exp)
    out = None
    for (label, what), group in alike.items():
        novelty.require_no_leakage(what.columns)
        for exp, fitted in zip(group, fit_all(train_rows, label, what, [e.how for e in group])):
            rows = judged_by(fitted, judged, exp, labels, seen)
            out = rows if out is None else out.unionByName(rows)
    return out


def top_k_table(train_rows: DataFrame, judged: DataFrame, exp: TextExperiment, k: int = 3, seen: str = "seen_in_train") -> DataFrame:
    """Share of rows whose class is among the ``k`` best, on COMPLETE, SEEN and NEW."""
    novelty.require_no_leakage(exp.what.columns)
    hit = metrics.top_k_hit(top_labels(k=k), F.col(exp.label), k)
    counts = score(fit(train_rows, exp.label, exp.what, exp.how), judged).groupBy(seen).agg(
        F.count_if(hit).alias("acertos"), F.count(F.lit(1)).alias("n"))
    return metrics.with_slices(counts, seen).groupBy(metrics.SLICE).agg(
        C.ratio(F.sum("acertos"), F.sum("n")).alias(f"top{k}"), F.sum("n").alias("n")).withColumn("experimento", F.lit(exp.name))


def baseline_table(train_rows: DataFrame, judged: DataFrame, label: str = LABEL, labels: Sequence[str] | None = None,
                   seen: str = "seen_in_train", product: str = "produto", channel: str = "aberto_por", text: str = TEXT) -> DataFrame:
    """B1 majority, B2 mode by product, B3 mode by channel, B4 dictionary of exact texts."""
    out = None
    for name, key in (("B1_Dummy", None), ("B2_Produto", product), ("B3_Canal", channel), ("B4_Dictionary", text)):
        counts = baselines.mode_counts(train_rows, judged, key, label, [seen])
        rows = metrics.sliced_classification(counts, label, "previsto", seen, (), labels, "n").withColumn("experimento", F.lit(name))
        out = rows if out is None else out.unionByName(rows)
    return out


def standard_experiments() -> list[TextExperiment]:
    """Text alone, then with product, config item, channel and calendar, then class weights."""
    svc, uni = TextModel("svc"), dict(max_ngram=1)
    calendar = ("hora", "dia_semana", "mes_abertura", "fim_de_semana")
    make = lambda cats, **kw: TextFeatures(TEXT, cats, **kw)
    return [
        TextExperiment("E01_TFIDF_LR", make((), **uni), TextModel("logistic")),
        TextExperiment("E02_TFIDF_SVM", make(()), svc),
        TextExperiment("E03_Texto_Produto", make((PRODUCT,)), svc),
        TextExperiment("E04_Texto_Produto_IC", make((PRODUCT, "item_config_prep")), svc),
        TextExperiment("E05_Hibrido_Completo", make((PRODUCT, "item_config_prep", "aberto_por")), svc),
        TextExperiment("E06_Texto_Canal", make(("aberto_por",)), svc),
        TextExperiment("E07_Texto_Produto_Temporais", make((PRODUCT,), numbers=calendar), svc),
        TextExperiment("E08_ClassWeight_balanced", make((PRODUCT,)), TextModel("svc", balanced=True)),
    ]


def category_experiments(max_iter: int = 500, trees: int = 300) -> list[TextExperiment]:
    """Category families: text, structure, both; then calendar columns one-hot, and no channel."""
    lr, svm = TextModel("logistic", balanced=True, max_iter=max_iter), TextModel("svc", balanced=True)
    text = dict(max_ngram=1, min_df=2, max_features=5000)
    structure, number = (LABEL, PRODUCT, "aberto_por"), ("freq_log",)
    calendar = ("hora_txt", "dia_txt", "mes_txt")

    def make(name, block, categories, how, numbers=number):
        return TextExperiment(name, TextFeatures(block, categories, numbers, **text), how, "categoria")

    return [
        make("A1_texto_LR", TEXT, (), lr, ()), make("A2_texto_SVM", TEXT, (), svm, ()),
        make("B1_estrut_LR", None, structure, lr),
        make("B2_estrut_RF", None, structure, TextModel("forest", balanced=True, trees=trees)),
        make("B3_estrut_boosted", None, structure, TextModel("boosted", balanced=True, trees=trees, depth=6)),
        make("C1_hibrido_LR", TEXT, structure, lr), make("C2_hibrido_SVM", TEXT, structure, svm),
        make("exp09_com_temporal", TEXT, structure + calendar, svm), make("exp12_sem_aberto_por", TEXT, structure[:2], svm),
    ]


def with_calendar_labels(df: DataFrame) -> DataFrame:
    """Hour, weekday and month as text, for one-hot blocks."""
    return df.withColumns({
        "hora_txt": F.hour("aberto").cast("string"), "dia_txt": C.monday_zero("aberto").cast("string"),
        "mes_txt": F.month("aberto").cast("string")})


def months_apart(train_rows: DataFrame, learn: Sequence[str], judge: Sequence[str], row_id: str = "numero") -> tuple[DataFrame, DataFrame]:
    """Split the training rows once more by month, with the seen flag against the earlier part."""
    month = C.month_label("aberto")
    early, late = train_rows.where(month.isin(*learn)), train_rows.where(month.isin(*judge))
    return early, novelty.with_seen_flag(early, late, TEXT, row_id)


def variant_experiments(how: TextModel | None = None) -> list[TextExperiment]:
    """The three text variants under one model, to see what the ids in the text carry."""
    how = how or TextModel("logistic")
    return [TextExperiment(f"E10_{name}", TextFeatures(column, ()), how)
            for name, column in (("A_Original", "texto_a"), ("B_Normalizada", "texto_b"), ("C_Normalizada_mais_IDs", "texto_c"))]


def svc_grid(cs: Sequence[float] = (0.1, 0.5, 1.0, 2.0, 5.0), ngrams: Sequence[int] = (1, 2), min_dfs: Sequence[int] = (1, 2, 5),
             categories: tuple[str, ...] = (PRODUCT,)) -> list[TextExperiment]:
    return [TextExperiment(f"svc_c{c}_n{n}_df{d}", TextFeatures(TEXT, categories, (), n, d), TextModel("svc", c=c))
            for c in cs for n in ngrams for d in min_dfs]


def weight_grid(cs: Sequence[float] = (0.03, 0.1, 0.3, 1.0, 3.0, 10.0), what: TextFeatures | None = None) -> list[TextExperiment]:
    what = what or TextFeatures()
    return [TextExperiment(f"svc_c{c}_{'balanced' if b else 'None'}", what, TextModel("svc", c=c, balanced=b))
            for c in cs for b in (True, False)]


def tfidf_grid(ngrams: Sequence[int] = (1, 2), min_dfs: Sequence[int] = (1, 2, 5), sizes: Sequence[int] = (5000, 10000, 20000),
               how: TextModel | None = None) -> list[TextExperiment]:
    how = how or TextModel("logistic")
    return [TextExperiment(f"tfidf_n{n}_df{d}_{size}", TextFeatures(TEXT, (), (), n, d, size), how)
            for n in ngrams for d in min_dfs for size in sizes]


def best(results: DataFrame, score: str = "f1_macro", then: str = "NEW") -> DataFrame:
    """The experiment with the best COMPLETE score; ties go to the better NEW score, then the name."""
    wide = results.groupBy("experimento").pivot(metrics.SLICE, ["COMPLETE", "SEEN", "NEW"]).agg(F.first(score))
    return wide.orderBy(F.desc("COMPLETE"), F.desc_nulls_last(then), F.asc("experimento")).limit(1)


def simpler_if_close(best_score: float, simple_score: float, margin: float = 0.03) -> bool:
    """Keep the simpler setting unless the better one wins by more than ``margin``, relatively."""
    return (best_score - simple_score) / simple_score <= margin


def rare_label_experiments(train_rows: DataFrame, judged: DataFrame, label: str, row_id: str, what: TextFeatures,
                           how: TextModel, cuts: Sequence[int] = (10, 20, 30, 50)) -> DataFrame:
    """F1 on VAL for every rare-label cut; the grouping is learned on the training rows."""
    train_rows, judged = settled(train_rows), settled(judged)
    out = None
    for cut in cuts:
        grouped = novelty.bucket_rare_labels(train_rows, train_rows, label, row_id, cut)
        tested = novelty.bucket_rare_labels(train_rows, judged, label, row_id, cut)
        scored = score(fit(grouped, label, what, how), tested)
        rows = metrics.classification(scored, label, "previsto").withColumn("corte", F.lit(cut))
        out = rows if out is None else out.unionByName(rows)
    return out


def template_slice(scored: DataFrame, needle: str, label: str = LABEL, text: str = TEXT) -> DataFrame:
    """Real against predicted class of the tickets of one template."""
    return metrics.confusion(scored.where(C.contains_ignore_case(text, needle)), label, "previsto")


def template_drift(rows: DataFrame, needle: str, classes: Sequence[str], names: Sequence[str], day: str = "aberto",
                   label: str = LABEL, text: str = TEXT) -> DataFrame:
    """Class counts of one template per month and id-free text."""
    mine = rows.where(C.contains_ignore_case(text, needle)).withColumn("modelo", T.hide_item_ids(text))
    return mine.groupBy(C.month_start(day).alias("mes_ref"), "modelo").agg(*[
        F.count_if(F.col(label) == v).alias(n) for v, n in zip(classes, names)])


def hybrid(train_rows: DataFrame, scored: DataFrame, label: str = LABEL, text: str = TEXT, row_id: str = "numero") -> DataFrame:
    """Dictionary where the text is known, model elsewhere."""
    return baselines.dictionary_or_model(train_rows, scored, text, label, "previsto", row_id, out="previsto_hibrido")
