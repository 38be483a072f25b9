"""Vocabularies, text matrices and what SQL can say of a linear fit: its gradient at zero, its size, and that it is at its minimum."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketry.catalog.analysis import CLASSES, TEXT, _train
from ticketry.catalog.base import Catalog, on_population, rounded
from ticketry.catalog.learning import _experiment_rows, _prepared
from ticketry.operators import terms as TM
from ticketry.plans import linear_text as LT, tickets_ml as ML
from ticketry.schema import STAND_IN_RULES as R

catalog = Catalog()
add = catalog.add

#: The final norm of a gradient, as a share of the one at zero, at which a fit has converged.
CONVERGED = 1.01e-4


# -- comparison side -------------------------------------------------------------------------
def matrix_sql(what: ML.TextFeatures) -> list[str]:
    """CTEs: xt (training rows), vo (vocabulary), tv (terms of rows with their weights), en (all entries of the matrix, constant included)."""
    pairs = "list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))"
    limit = f"LIMIT {what.max_features}" if what.max_features else ""
    kinds = "".join(f" UNION ALL SELECT numero, '{c}', {c}, 1.0 FROM xt WHERE {c} IS NOT NULL" for c in what.categories)
    return [
        f"xt AS (SELECT numero, prioridade AS y, coalesce({TEXT}, '') AS t, aberto_por, CASE WHEN produto IS NULL OR produto = '{R.default_label}' THEN '{R.unknown_product}' ELSE produto END AS produto_prep FROM tr)",
        r"wd AS (SELECT numero, regexp_extract_all(lower(t), '[\p{L}\p{M}\p{N}_]{2,}') AS w FROM xt)",
        f"tm AS (SELECT numero, unnest({pairs if what.max_ngram == 2 else 'w'}) AS term FROM wd)",
        "tf AS (SELECT numero, term, count(*) AS tf FROM tm GROUP BY ALL)",
        f"vf AS (SELECT term, count(*) AS df, sum(tf)::BIGINT AS total FROM tf GROUP BY 1 HAVING count(*) >= {what.min_df} ORDER BY total DESC, term {limit})",
        "vo AS (SELECT term, df, total, ln((1 + n)::DOUBLE / (1 + df)) + 1 AS idf, (row_number() OVER (ORDER BY term) - 1)::INT AS index FROM vf, (SELECT count(*) AS n FROM xt))",
        "tv AS (SELECT numero, term, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY numero)) AS x FROM tf JOIN vo USING (term))",
        f"en AS (SELECT numero, 'texto' AS c, term AS f, x FROM tv{kinds} UNION ALL SELECT numero, '', '', 1.0 FROM xt)",
        "cl AS (SELECT y AS classe, count(*) AS n FROM xt GROUP BY 1)", "nk AS (SELECT sum(n) AS n, count(*) AS k FROM cl)",
    ]


def gradient_sql(what: ML.TextFeatures, how: ML.TextModel) -> str:
    """classe, atributos, gradiente_inicial, otimo over the CTEs of ``matrix_sql``."""
    own = "(SELECT nk.n::DOUBLE / (k * o.n) FROM cl o, nk WHERE o.classe = xt.y)" if how.balanced else "1.0"
    if how.kind == "logistic":
        g = f"SELECT classe, c, f, sum({how.c} * own * (1.0 / k - CASE WHEN y = classe THEN 1 ELSE 0 END) * x) AS g FROM rows, cl, nk GROUP BY ALL"
        body = "SELECT NULL::VARCHAR AS classe, (count(*) // any_value(k))::BIGINT AS atributos, round(sqrt(sum(g * g)), 3) AS gradiente_inicial, true AS otimo FROM g, nk"
    else:
        g = (f"SELECT classe, c, f, sum(2 * {how.c} * CASE WHEN k = 2 OR y = classe THEN own ELSE 1 END * CASE WHEN y = classe THEN -1 ELSE 1 END * x) AS g "
             "FROM rows, cl, nk GROUP BY ALL")
        body = "SELECT classe, count(*) AS atributos, round(sqrt(sum(g * g)), 3) AS gradiente_inicial, true AS otimo FROM g GROUP BY classe"
    return f"WITH rows AS (SELECT en.*, xt.y, {own} AS own FROM en JOIN xt USING (numero)), g AS ({g}) {body}"


# -- vocabulary and matrix ---------------------------------------------------------------------
PRODUCTION = ML.default_features(R)


def _vocabulary(spark, d) -> tuple[DataFrame, DataFrame, DataFrame]:
    rows = _train(_prepared(spark, d))
    counts = TM.term_counts(TM.texts(rows, TEXT), PRODUCTION.max_ngram, "n")
    return rows, counts, TM.vocabulary(counts, rows.count(), PRODUCTION.min_df, PRODUCTION.max_features)


def _text_rows(spark, d) -> DataFrame:
    """Per ticket of TRAIN: entries of its text, the largest one and their length."""
    rows, counts, vocabulary = _vocabulary(spark, d)
    known = rows.select("numero", TM.text_id(TEXT).alias(TM.TEXT_ID)).join(TM.sparse_rows(counts, vocabulary), TM.TEXT_ID)
    return known.select("numero", F.size("indices").cast("long").alias("entradas"), F.round(F.array_max("values"), 6).alias("maior"),
                        F.round(F.aggregate("values", F.lit(0.0), lambda s, x: s + x * x), 6).alias("comprimento"))


add("m03_vocabulary", lambda spark, d: rounded(_vocabulary(spark, d)[2], 9, "idf"),
    on_population("SELECT term, df, total, round(idf, 9) AS idf, index FROM vo", *matrix_sql(PRODUCTION)))
add("m20_text_rows", _text_rows,
    on_population("SELECT numero, count(*) AS entradas, round(max(x), 6) AS maior, round(sum(x * x), 6) AS comprimento FROM tv GROUP BY 1", *matrix_sql(PRODUCTION)))


# -- fits ----------------------------------------------------------------------------------------
def _certificate(fitted: ML.FittedText, train: DataFrame, what: ML.TextFeatures, how: ML.TextModel) -> DataFrame:
    out = LT.optimality(fitted.model, train, fitted.labels, ML.LABEL, what, how)
    return out.select("classe", "atributos", F.round("gradiente_inicial", 3).alias("gradiente_inicial"),
                      (F.col("gradiente_final") <= F.lit(CONVERGED) * F.col("gradiente_inicial")).alias("otimo"))


def _production(spark, d) -> DataFrame:
    rows, how = _train(_prepared(spark, d)), ML.TextModel("svc", c=R.svc_c)
    return _certificate(ML.fit(rows, ML.LABEL, PRODUCTION, how), rows, PRODUCTION, how)


add("m05_svm_optimality", _production, on_population(f"SELECT * FROM ({gradient_sql(PRODUCTION, ML.TextModel('svc', c=R.svc_c))})", *matrix_sql(PRODUCTION)))

CERTIFIED = ("E01_TFIDF_LR", "E02_TFIDF_SVM", "E03_Texto_Produto", "E06_Texto_Canal", "E08_ClassWeight_balanced")
_EXPERIMENTS = {e.name: e for e in ML.standard_experiments() if e.name in CERTIFIED}


def _experiments(spark, d) -> DataFrame:
    """Certificates of the standard experiments; those on the same matrix share a fit."""
    train, _ = _experiment_rows(spark, d)
    parts = []
    for what in dict.fromkeys(e.what for e in _EXPERIMENTS.values()):
        mine = [e for e in _EXPERIMENTS.values() if e.what == what]
        for e, fitted in zip(mine, ML.fit_all(train, ML.LABEL, what, [e.how for e in mine]), strict=True):
            parts.append(_certificate(fitted, train, what, e.how).select(F.lit(e.name).alias("experimento"), "*"))
    return reduce(DataFrame.unionByName, parts)


def _experiments_sql() -> str:
    """The CTEs of each experiment stand in a sub-query of its own."""
    each = [f"SELECT '{e.name}' AS experimento, * FROM (WITH {', '.join(matrix_sql(e.what))} SELECT * FROM ({gradient_sql(e.what, e.how)}))" for e in _EXPERIMENTS.values()]
    return on_population(" UNION ALL ".join(each))


add("m12_text_experiment_optimality", _experiments, _experiments_sql())


def _beside_hinge(spark, d) -> DataFrame:
    """The squared hinge of the reference's library beside Spark's plain hinge, on VAL."""
    return ML.experiment_table(*_experiment_rows(spark, d), [
        ML.TextExperiment("hinge_ao_quadrado", PRODUCTION, ML.TextModel("svc", c=R.svc_c)),
        ML.TextExperiment("hinge", PRODUCTION, ML.TextModel("hinge", c=R.svc_c, max_iter=50))], CLASSES)


add("m05_squared_hinge_beside_hinge", _beside_hinge)


def _convergence(spark, d) -> DataFrame:
    """How the production fit went, per class."""
    fitted = ML.fit(_train(_prepared(spark, d)), ML.LABEL, PRODUCTION, ML.TextModel("svc", c=R.svc_c))
    return spark.createDataFrame([tuple(f[c] for c in ("classe", "passos", "gradiente_inicial", "gradiente_final", "convergiu", "perda")) for f in fitted.model.fits],
                                 "classe string, passos long, gradiente_inicial double, gradiente_final double, convergiu boolean, perda double")


add("m05_svm_convergence", _convergence)
