"""Linear text classifiers whose features are tables: terms, category values and plain numbers.

Vocabulary and rows are built by joins (``operators.terms``), the fit is ``plans.solvers``, and scoring is a join of the
texts' terms with the coefficients. Terms never come to the driver; coefficients do, one number per feature and class.
Equal texts are one text and equal rows one row with a count, in the fit and in scoring.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketry.operators import terms as TM
from ticketry.operators.lookups import lookup_join
from ticketry.plans import solvers
from ticketry.session import settled

VALUES = "coluna string, valor string, lugar int"


@dataclass
class LinearModel:
    """``terms``: term, df, total, idf, index, w; ``values``: coluna, valor, lugar, w; w holds one coefficient per class.

    ``fits`` says per solved problem how the fit went: steps, gradient norms at the start and at the end, whether it converged.
    """

    terms: DataFrame | None
    values: DataFrame
    numbers: dict[str, list[float]]
    constant: list[float]
    text: str | None
    max_ngram: int
    fits: list[dict]

    @property
    def classes(self) -> int:
        return len(self.constant)

    def write_to(self, spark: SparkSession, folder: str) -> None:
        """Tables first, then the settings, without which a folder is no model."""
        if self.terms is not None:
            self.terms.write.mode("overwrite").parquet(f"{folder}/terms")
        self.values.write.mode("overwrite").parquet(f"{folder}/values")
        kept = {"numbers": self.numbers, "constant": self.constant, "text": self.text, "max_ngram": self.max_ngram, "fits": self.fits}
        spark.createDataFrame([(json.dumps(kept, ensure_ascii=False),)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/metadata")

    @staticmethod
    def read_from(spark: SparkSession, folder: str) -> LinearModel:
        kept = json.loads(spark.read.option("wholetext", True).text(f"{folder}/metadata").first()[0])
        terms = spark.read.parquet(f"{folder}/terms") if kept["text"] else None
        return LinearModel(terms, spark.read.parquet(f"{folder}/values"), kept["numbers"], kept["constant"], kept["text"], kept["max_ngram"], kept["fits"])


# -- fit ---------------------------------------------------------------------------------
@dataclass
class Matrix:
    """The training rows of one feature set: terms, values, the frame for the solver and its sizes."""

    terms: DataFrame | None
    values: DataFrame
    frame: DataFrame
    features: int
    n_terms: int
    n_values: int
    labels: list[str]
    per_label: list[int]


def matrix(train: DataFrame, label: str, what) -> Matrix:
    """Runs jobs: vocabulary, category values and the compressed rows, each written once."""
    numbers = [F.col(c).cast("double").alias(f"_n{i}") for i, c in enumerate(what.numbers)]
    kinds = [F.col(c).cast("string").alias(f"_c{i}") for i, c in enumerate(what.categories)]
    names = [f"_c{i}" for i in range(len(kinds))] + [f"_n{i}" for i in range(len(numbers))]
    rows = train.select(F.col(label).cast("string").alias("_label"), *([TM.text_id(what.text).alias(TM.TEXT_ID)] if what.text else []), *kinds, *numbers)
    keys = [*([TM.TEXT_ID] if what.text else []), *names]
    rows = settled(rows.groupBy("_label", *keys).agg(F.count(F.lit(1)).alias("times")))
    per_label = {r["_label"]: r["n"] for r in rows.groupBy("_label").agg(F.sum("times").alias("n")).collect()}
    labels = sorted(per_label)
    place = F.element_at(F.create_map(*[x for i, v in enumerate(labels) for x in (F.lit(v), F.lit(i))]), F.col("_label")) if labels else F.lit(0)
    cells = F.array_sort(F.collect_list(F.struct(place.alias("label"), "times")))
    rows = rows.groupBy(*keys).agg(cells.alias("_cells")) if keys else rows.agg(cells.alias("_cells")).where("size(_cells) > 0")

    terms, n_terms, spark = None, 0, train.sparkSession
    if what.text:
        counts = settled(TM.term_counts(TM.texts(train, what.text), what.max_ngram, "n"))
        terms = TM.vocabulary(counts, sum(per_label.values()), int(what.min_df), what.max_features)
        n_terms = terms.count()
        rows = rows.join(TM.sparse_rows(counts, terms), TM.TEXT_ID, "left")
    known = []
    for i, column in enumerate(what.categories):  # the caller has checked that there are few
        found = sorted(r[0] for r in rows.where(F.col(f"_c{i}").isNotNull()).select(f"_c{i}").distinct().collect())
        table = spark.createDataFrame([(column, v, n_terms + len(known) + j) for j, v in enumerate(found)], VALUES)
        known += [(column, v, n_terms + len(known) + j) for j, v in enumerate(found)]
        rows = lookup_join(rows, table.select(F.col("valor").alias(f"_c{i}"), F.col("lugar").alias(f"_l{i}")), [f"_c{i}"], rows.columns)
    none = lambda kind: F.array().cast(f"array<{kind}>")
    places = F.array(*[f"_l{i}" for i in range(len(kinds))]) if kinds else none("int")
    places = F.filter(places, lambda x: x.isNotNull())
    first = n_terms + len(known)
    number = lambda i: F.coalesce(f"_n{i}", F.raise_error(F.lit(f"no value in {what.numbers[i] if what.numbers else ''}")))
    indices = F.concat(F.coalesce("indices", none("int")) if what.text else none("int"), places, F.array(*[F.lit(first + i) for i in range(len(numbers))]).cast("array<int>"))
    values = F.concat(F.coalesce("values", none("double")) if what.text else none("double"), F.transform(places, lambda x: F.lit(1.0)),
                      F.array(*[number(i) for i in range(len(numbers))]).cast("array<double>"))
    frame = settled(rows.select(indices.alias("indices"), values.alias("values"), F.col("_cells.label").alias("label"), F.col("_cells.times").alias("times")))
    return Matrix(terms, spark.createDataFrame(known, VALUES), frame, first + len(numbers), n_terms, len(known), labels, [per_label[v] for v in labels])


def _problems(how, labels: Sequence[str], per_label: Sequence[int]) -> list[solvers.Problem]:
    k, total = len(labels), sum(per_label)
    weight = tuple(total / (k * n) if how.balanced else 1.0 for n in per_label)
    if how.kind == "logistic":
        return [solvers.Problem("softmax", how.c, weight)]
    if k == 2:  # the first class has the second one's coefficients with the other sign
        return [solvers.Problem("hinge", how.c, weight, 1)]
    return [solvers.Problem("hinge", how.c, weight, i) for i in range(k)]


def fit_linear(train: DataFrame, label: str, what, hows: Sequence) -> tuple[list[str], list[LinearModel]]:
    """Class names and one model per setting; settings with the same iteration limit share every pass over the rows."""
    made = matrix(train, label, what)
    if not made.labels:
        raise ValueError("no training rows")
    out: dict[int, LinearModel] = {}
    with solvers.Matrix(made.frame, made.features, len(made.labels)) as blocks:
        for most in sorted({how.max_iter for how in hows}):
            mine = [i for i, how in enumerate(hows) if how.max_iter == most]
            asked = {i: _problems(hows[i], made.labels, made.per_label) if len(made.labels) > 1 else [] for i in mine}
            every = [p for i in mine for p in asked[i]]
            found = solvers.solve(blocks, every, most=most) if every else []
            for i in mine:
                part, found = found[:len(asked[i])], found[len(asked[i]):]
                out[i] = _model(made, what, part)
    return made.labels, [out[i] for i in range(len(hows))]


def _model(made: Matrix, what, part: Sequence[solvers.Solution]) -> LinearModel:
    k = len(made.labels)
    w = np.concatenate([s.w for s in part], axis=1) if part else np.zeros((made.features + 1, k))
    if w.shape[1] < k:
        w = np.concatenate([-w, w], axis=1)
    fits = [{"classe": made.labels[s.problem.target] if s.problem.loss == "hinge" else None, "passos": s.steps, "gradiente_inicial": s.first_gradient,
             "gradiente_final": s.last_gradient, "convergiu": bool(s.converged), "perda": s.loss} for s in part]
    spark = made.values.sparkSession
    coefficient = spark.createDataFrame(pa.table({"_i": pa.array(np.arange(made.features), pa.int32()), "w": pa.array(w[:-1].tolist(), pa.list_(pa.float64()))})) \
        if made.features else spark.createDataFrame([], "_i int, w array<double>")
    terms = settled(made.terms.join(coefficient, F.col("index") == F.col("_i")).drop("_i")) if made.terms is not None else None
    values = settled(made.values.join(coefficient, F.col("lugar") == F.col("_i")).drop("_i"))
    first = made.n_terms + made.n_values
    numbers = {c: w[first + i].tolist() for i, c in enumerate(what.numbers)}
    return LinearModel(terms, values, numbers, w[-1].tolist(), what.text, what.max_ngram, fits)


# -- scores ------------------------------------------------------------------------------
def _add(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x + y)


def _times(c: Column):
    return lambda x: x * c


def with_margins(model: LinearModel, rows: DataFrame, out: str = "_margins") -> DataFrame:
    """``rows`` with one score per class. Unknown terms and values add nothing."""
    columns = rows.columns
    parts = [F.lit(model.constant).cast("array<double>")]
    zeros = F.array(*[F.lit(0.0)] * model.classes)
    if model.text:
        counts = TM.term_counts(TM.texts(rows, model.text), model.max_ngram)
        known = TM.weights(counts, model.terms, "w")
        sums = [F.sum(F.col("weight") * F.col("w")[k]) for k in range(model.classes)]
        scored = known.groupBy(F.col(TM.TEXT_ID).alias("_known")).agg(F.array(*sums).alias("_sums"), F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("_norm"))
        rows = rows.withColumn(TM.TEXT_ID, TM.text_id(model.text))
        rows = rows.join(scored, F.col(TM.TEXT_ID) == F.col("_known"), "left")
        parts.append(F.coalesce(F.transform("_sums", lambda s: s / F.col("_norm")), zeros))
    for i, column in enumerate(r["coluna"] for r in model.values.select("coluna").distinct().orderBy("coluna").collect()):
        table = model.values.where(F.col("coluna") == column).select(F.col("valor").alias(f"_v{i}"), F.col("w").alias(f"_w{i}"))
        rows = lookup_join(rows.withColumn(f"_v{i}", F.col(column).cast("string")), table, [f"_v{i}"], columns)
        parts.append(F.coalesce(F.col(f"_w{i}"), zeros))
    for column, w in model.numbers.items():
        parts.append(F.transform(F.lit(w).cast("array<double>"), _times(F.col(column).cast("double"))))
    return rows.select(*columns, reduce(_add, parts).alias(out))


def optimality(model: LinearModel, train: DataFrame, labels: Sequence[str], label: str, what, how) -> DataFrame:
    """classe, atributos, gradiente_inicial, gradiente_final: norms of the objective's gradient at zero and at the model.

    They come from scored rows by joins and sums, not from the solver's own passes. The squared hinge has one row per class,
    softmax one for all (classe is NULL). A fit is at its minimum where the final norm is a small share of the first one.
    """
    train = settled(train.where(F.col(label).isNotNull()))
    per_label = {r[0]: r[1] for r in train.groupBy(label).count().collect()}
    k, total = len(labels), sum(per_label.values())
    weight = {v: total / (k * n) if how.balanced else 1.0 for v, n in per_label.items()}
    own = F.coalesce(*[F.when(F.col(label) == v, w) for v, w in weight.items()])
    is_class = [F.col(label) == v for v in labels]
    margins = [F.col("_margins")[j] for j in range(k)]
    now, zero = [], []
    if how.kind == "logistic":
        top = F.array_max("_margins")
        whole = reduce(lambda a, b: a + b, [F.exp(m - top) for m in margins])
        for m, mine in zip(margins, is_class, strict=True):
            now.append(how.c * own * (F.exp(m - top) / whole - mine.cast("double")))
            zero.append(how.c * own * (F.lit(1.0 / k) - mine.cast("double")))
    else:
        for m, mine in zip(margins, is_class, strict=True):
            y = F.when(mine, 1.0).otherwise(-1.0)
            s = 2.0 * how.c * (own if k == 2 else F.when(mine, own).otherwise(1.0))
            now.append(-s * y * F.greatest(F.lit(0.0), 1.0 - y * m))
            zero.append(-s * y)
    marked = settled(with_margins(model, train).select("*", F.array(*now).alias("_now"), F.array(*zero).alias("_zero")))

    def sums(rows: DataFrame, x: Column | None = None, *by: Column) -> DataFrame:
        x = F.lit(1.0) if x is None else x
        return rows.groupBy(*by).agg(*[F.array(*[F.sum(F.col(c)[j] * x) for j in range(k)]).alias(c) for c in ("_now", "_zero")])

    fixed = lambda column, w: [F.lit(column).alias("coluna"), F.lit(w).cast("array<double>").alias("w")]
    parts = [sums(marked).select("_now", "_zero", *fixed(None, model.constant))]
    if what.text:
        counts = settled(TM.term_counts(TM.texts(train, what.text), what.max_ngram))
        by_text = sums(marked, None, TM.text_id(what.text).alias(TM.TEXT_ID))
        entries = by_text.join(TM.sparse_rows(counts, model.terms), TM.TEXT_ID).select("_now", "_zero", F.explode(F.arrays_zip("indices", "values")).alias("e"))
        parts.append(sums(entries, F.col("e.values"), F.col("e.indices").alias("index")).join(model.terms, "index").select("_now", "_zero", F.lit("texto").alias("coluna"), "w"))
    for column in what.categories:
        mine = model.values.where(F.col("coluna") == column).select("valor", "w", "coluna")
        parts.append(sums(marked, None, F.col(column).cast("string").alias("valor")).join(mine, "valor").select("_now", "_zero", "coluna", "w"))
    for column in what.numbers:
        parts.append(sums(marked, F.col(column).cast("double")).select("_now", "_zero", *fixed(column, model.numbers[column])))
    free = F.col("coluna").isNull() if how.kind == "logistic" else F.lit(False)  # softmax doesn't penalise the constant
    gradient = F.zip_with("_now", "w", lambda g, w: g + F.when(free, 0.0).otherwise(w))
    each = reduce(DataFrame.unionByName, parts).select(F.posexplode(F.arrays_zip(gradient.alias("g"), F.col("_zero").alias("z"))).alias("_k", "_e"))
    norm = lambda c: F.sqrt(F.sum(F.col(f"_e.{c}") * F.col(f"_e.{c}")))
    found = [norm("z").alias("gradiente_inicial"), norm("g").alias("gradiente_final")]
    if how.kind == "logistic":
        return each.agg(F.lit(None).cast("string").alias("classe"), (F.count(F.lit(1)) / k).cast("long").alias("atributos"), *found)
    names = F.array(*[F.lit(v) for v in labels])
    return each.groupBy("_k").agg(F.count(F.lit(1)).alias("atributos"), *found).select(F.element_at(names, F.col("_k") + 1).alias("classe"), "atributos", "gradiente_inicial", "gradiente_final")
