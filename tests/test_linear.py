"""Vocabularies as tables, linear classifiers by their optimality conditions, ridge paths and boosted trees against plain versions."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ticketry.operators import terms as TM
from ticketry.plans import boosting as BT, forest as FO, linear_text as LT, ridge as RD, solvers, tickets_ml as ML, volume as V

TEXTS = ["Disco cheio no servidor", "usuário sem acesso", "Disco lento", "acesso negado ao usuário", "servidor é lento x", "", None, "Disco cheio no servidor"]


def plain_terms(text, most):
    words = re.findall(r"\b\w\w+\b", (text or "").lower())
    return [t for n in range(1, most + 1) for t in (" ".join(words[i:i + n]) for i in range(len(words) - n + 1))]


def texts(spark, values):
    return spark.createDataFrame([(i, t) for i, t in enumerate(values)], "i long, t string")


@pytest.mark.parametrize("most, min_df, limit", [(1, 1, None), (2, 1, None), (2, 2, None), (2, 1, 5), (3, 1, 7), (2, 9, None)])
def test_vocabulary_equals_a_plain_count(spark, most, min_df, limit):
    rows = texts(spark, TEXTS)
    counts = TM.term_counts(TM.texts(rows, "t"), most, "n")
    got = TM.vocabulary(counts, len(TEXTS), min_df, limit).collect()
    docs = [plain_terms(t, most) for t in TEXTS]
    total = Counter(t for d in docs for t in d)
    df = Counter(t for d in docs for t in set(d))
    kept = sorted((t for t in total if df[t] >= min_df), key=lambda t: (-total[t], t))[:limit]
    want = {t: (df[t], total[t], i) for i, t in enumerate(sorted(kept))}
    assert {r["term"]: (r["df"], r["total"], r["index"]) for r in got} == want
    assert all(r["idf"] == pytest.approx(math.log((1 + len(docs)) / (1 + r["df"])) + 1) for r in got)


def test_sparse_rows_are_normalised_tfidf(spark):
    rows = texts(spark, TEXTS)
    counts = TM.term_counts(TM.texts(rows, "t"), 2, "n")
    vocabulary = TM.vocabulary(counts, len(TEXTS))
    place = {r["term"]: (r["index"], r["idf"]) for r in vocabulary.collect()}
    got = {r[TM.TEXT_ID]: dict(zip(r["indices"], r["values"])) for r in TM.sparse_rows(counts, vocabulary).collect()}
    for row in rows.withColumn("k", TM.text_id("t")).collect():
        tf = Counter(plain_terms(row["t"], 2))
        weight = {place[t][0]: n * place[t][1] for t, n in tf.items()}
        norm = math.sqrt(sum(w * w for w in weight.values()))
        assert got.get(row["k"], {}) == pytest.approx({i: w / norm for i, w in weight.items()})


def test_places_are_dealt_by_ranges(spark):
    """No window over all rows: places come from ranges and their sizes."""
    df = spark.range(20_000).select(F.xxhash64("id").alias("v")).repartition(7)
    out = TM.numbered(df, [F.asc("v")], "place")
    values = [r["v"] for r in out.orderBy("place").collect()]
    assert values == sorted(values) and out.agg(F.min("place"), F.max("place"), F.count_distinct("place")).first() == (0, 19_999, 20_000)
    assert TM.numbered(df.limit(0), [F.asc("v")], "place").count() == 0


# -- solver ------------------------------------------------------------------------------
def sample(spark, rows=400, features=30, classes=3, seed=3):
    draw = np.random.default_rng(seed)
    label = draw.integers(0, classes, rows)
    x = np.zeros((rows, features))
    for i, y in enumerate(label):
        at = np.unique(np.concatenate([draw.integers(0, features, 4), [y * 5 + draw.integers(0, 7)]]))
        x[i, at] = draw.random(len(at))
    x[0] = 0  # a row without any feature
    times = draw.integers(1, 4, rows)
    frame = spark.createDataFrame([([int(j) for j in np.flatnonzero(r)], r[np.flatnonzero(r)].tolist(), int(y), int(t)) for r, y, t in zip(x, label, times)],
                                  "indices array<int>, values array<double>, label int, times long")
    return frame, x, label, times


@pytest.mark.parametrize("weights, entries", [((1.0, 1.0, 1.0), 1 << 18), ((0.5, 2.0, 3.0), 700)])
def test_fits_meet_their_optimality_conditions(spark, monkeypatch, weights, entries):
    """In one task and in several."""
    monkeypatch.setattr(solvers, "BLOCK_ENTRIES", entries)
    frame, x, label, times = sample(spark)
    problems = [solvers.Problem("hinge", 2.0, weights, k) for k in range(3)] + [solvers.Problem("softmax", 2.0, weights)]
    with solvers.Matrix(frame.repartition(3), x.shape[1], 3) as blocks:
        assert (blocks.tasks > 1) == (entries == 700)
        found = solvers.solve(blocks, problems, tolerance=1e-6)
        short = solvers.solve(blocks, problems[:1], tolerance=1e-12, most=2)
    assert not short[0].converged and short[0].steps == 2
    one = np.hstack([x, np.ones((len(x), 1))])
    for s in found:
        assert s.converged and s.history == sorted(s.history, reverse=True)
        w = s.w
        if s.problem.loss == "hinge":
            y = np.where(label == s.problem.target, 1.0, -1.0)
            c = 2.0 * times * np.where(y > 0, weights[s.problem.target], 1.0)
            gradient = lambda v: v - one.T @ (2 * c * y * np.maximum(0, 1 - y * (one @ v)))  # noqa: E731, B023
            now, zero = gradient(w[:, 0]), gradient(np.zeros(len(w)))
        else:
            m = one @ w
            p = np.exp(m - m.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            c = 2.0 * times * np.array(weights)[label]
            now = one.T @ (c[:, None] * (p - np.eye(3)[label])) + np.vstack([w[:-1], np.zeros((1, 3))])
            zero = one.T @ (c[:, None] * (1 / 3 - np.eye(3)[label]))
        assert np.linalg.norm(now) <= 1.01e-6 * np.linalg.norm(zero) and s.first_gradient == pytest.approx(np.linalg.norm(zero))


def tickets(spark, labels=("a", "b", "c")):
    draw = random.Random(2)
    words = {"a": ["disco", "cheio", "lento"], "b": ["rede", "fora", "lento"], "c": ["senha", "login", "acesso"]}
    rows = []
    for i in range(240):
        label = labels[i % len(labels)]
        rows.append((i, " ".join(draw.choices(words[label] + ["erro", "no", "sistema"], k=5)) if i % 11 else None, draw.choice(["p1", "p2", None]), label if i % 17 else None, float(i % 5)))
    return spark.createDataFrame(rows, "numero long, t string, p string, y string, z double")


@pytest.mark.parametrize("labels, balanced", [(("a", "b", "c"), False), (("a", "b", "c"), True), (("a", "b"), True)])
def test_text_models_score_what_was_learned(spark, labels, balanced):
    rows = tickets(spark, labels)
    what = ML.TextFeatures("t", ("p",), ("z",), 2, 1, None)
    hows = [ML.TextModel("svc", balanced=balanced), ML.TextModel("logistic", balanced=balanced)]
    fitted = ML.fit_all(rows, "y", what, hows)
    train = rows.where("y IS NOT NULL")
    for f in fitted:
        assert f.labels == list(labels) and all(x["convergiu"] for x in f.model.fits)
        scored = ML.score(f, train).collect()
        assert len(scored) == train.count() and np.mean([r["previsto"] == r["y"] for r in scored if r["t"]]) > 0.9
        assert all([s["score"] for s in r["ranking"]] == sorted((s["score"] for s in r["ranking"]), reverse=True) for r in scored)
    # gradients summed over scored rows vanish, and are those of the fit
    for f, how in zip(fitted, hows, strict=True):
        for r in LT.optimality(f.model, rows, labels, "y", what, how).collect():
            assert r["gradiente_final"] <= 1.01e-4 * r["gradiente_inicial"]
            for mine in (x for x in f.model.fits if x["classe"] == r["classe"]):
                assert r["gradiente_inicial"] == pytest.approx(mine["gradiente_inicial"]) and r["gradiente_final"] == pytest.approx(mine["gradiente_final"], rel=1e-5)
    unknown = spark.createDataFrame([(1, "palavra nunca vista", "px", 0.0), (2, None, None, 0.0)], "numero long, t string, p string, z double")
    margins = [r["_margins"] for r in LT.with_margins(fitted[0].model, unknown).collect()]
    assert margins[0] == margins[1] == pytest.approx(fitted[0].model.constant)


def test_text_model_survives_the_store(spark, base):
    rows = tickets(spark)
    fitted = ML.fit(rows, "y", ML.TextFeatures("t", ("p",), ("z",)), ML.TextModel("svc"))
    fitted.model.write_to(spark, f"{base}/m")
    again = LT.LinearModel.read_from(spark, f"{base}/m")
    order = lambda m: [tuple(r["_margins"]) for r in LT.with_margins(m, rows).orderBy("numero").collect()]
    assert np.array(order(fitted.model)) == pytest.approx(np.array(order(again))) and again.fits == fitted.model.fits
    top = ML.top_terms(fitted, spark, 3)
    first = {r["classe"]: r["termo"] for r in top.where("posicao = 1").collect()}
    assert set(first) == {"a", "b", "c"} and top.count() == 9 and "senha" in first["c"] + "login" + "acesso"


def test_one_class_and_no_rows(spark):
    rows = tickets(spark).where("y = 'a'")
    fitted = ML.fit(rows, "y", ML.TextFeatures("t", ("p",)), ML.TextModel("svc"))
    assert ML.score(fitted, rows).where("previsto = 'a'").count() == rows.count()
    with pytest.raises(ValueError, match="no training rows"):
        ML.fit(rows.limit(0), "y", ML.TextFeatures("t", ()), ML.TextModel("svc"))


def test_no_job_collects_terms(spark, monkeypatch):
    """Vocabulary and rows are built without bringing rows to the driver, whatever max_features is."""
    from pyspark.sql.classic.dataframe import DataFrame as Frame

    seen, real = [], Frame.collect
    monkeypatch.setattr(Frame, "collect", lambda self: seen.append(self.columns) or real(self))
    monkeypatch.setattr(Frame, "toPandas", None)
    ML.fit(tickets(spark), "y", ML.TextFeatures("t", ("p",), (), 2, 1, None), ML.TextModel("svc", max_iter=3))
    assert seen and not any("term" in c or "text" in c for columns in seen for c in columns)


# -- ridge path --------------------------------------------------------------------------
def test_paths_equal_the_closed_form(spark):
    draw = np.random.default_rng(4)
    x = draw.normal(50, 10, (200, 4))
    y = x @ [1.0, -2.0, 0.0, 0.5] + draw.normal(0, 3, 200)
    rows = [(*map(float, r), float(v) if i % 9 else None, i < 150) for i, (r, v) in enumerate(zip(x, y))]
    frame = spark.createDataFrame(rows, "a double, b double, c double, d double, y double, learn boolean")
    sums = RD.moments(frame, ["a", "b", "c", "d"], [RD.Sample("s", "y", F.col("learn"))])
    use = [i for i in range(150) if i % 9]
    for features, at in ((["a", "b", "c", "d"], [0, 1, 2, 3]), (["d", "a"], [3, 0])):
        for alpha in (0.0, 0.001, 1.0, 1000.0):
            xc, yc = x[use][:, at] - x[use][:, at].mean(0), y[use] - y[use].mean()
            want = np.linalg.solve(xc.T @ xc + alpha * np.eye(len(at)), xc.T @ yc)
            w, b = sums.solve("s", features, alpha)
            assert w == pytest.approx(want, rel=1e-8, abs=1e-10) and b == pytest.approx(y[use].mean() - x[use][:, at].mean(0) @ want)


def test_all_linear_experiments_share_one_aggregate(spark, monkeypatch):
    from tests.test_models import RULES, noisy_series

    data = V.experiment_dataset(noisy_series(spark), RULES)
    calls, real = [], RD.moments
    monkeypatch.setattr(V.RD, "moments", lambda *a: calls.append(a) or real(*a))
    exps = [e for h, c in (("D+1", RULES.lag_columns), ("D+7", RULES.d7_features)) for e in V.alpha_grid(c, (0.001, 1, 100), h)]
    got = V.experiment_table(data, exps, RULES)
    assert len(calls) == 1
    want = [V.run_experiment(data, e, RULES) for e in exps[::2]]
    table = {(r["experimento"], r["horizonte"], r["split"]): (r["mae"], r["rmse"], r["n"]) for r in got.collect()}
    for one in want:
        for r in one.collect():
            assert table[r["experimento"], r["horizonte"], r["split"]] == pytest.approx((r["mae"], r["rmse"], r["n"]), abs=2e-3)


# -- boosting ----------------------------------------------------------------------------
def plain_boosting(codes, label, weight, classes, sizes, equal, how):
    """The same rounds row by row: [rounds] of (tests, margins after the round)."""
    n, out = len(codes), []
    margins = [[0.0] * classes for _ in range(n)]
    for _ in range(how.rounds):
        grad, curve = [], []
        for m, y, w in zip(margins, label, weight):
            e = [math.exp(v - max(m)) for v in m]
            p = [v / sum(e) for v in e]
            grad.append([w * (p[k] - (k == y)) for k in range(classes)])
            curve.append([w * p[k] * (1 - p[k]) for k in range(classes)])
        leaf, tests, bits = [0] * n, [], []
        for depth in range(how.depth):
            def worth(rows):
                return sum(sum(grad[i][k] for i in rows) ** 2 / (sum(curve[i][k] for i in rows) + how.l2) for k in range(classes))
            best = None
            nodes = defaultdict(list)
            for i in range(n):
                nodes[leaf[i]].append(i)
            for c in range(len(sizes)):
                for code in range(sizes[c]):
                    right = lambda i: codes[i][c] == code if equal[c] else codes[i][c] > code  # noqa: E731, B023
                    gain = sum(worth([i for i in rows if right(i)]) + worth([i for i in rows if not right(i)]) - worth(rows) for rows in nodes.values())
                    if gain > (best[0] + 1e-9 if best else 1e-12):
                        best = (gain, c, code, [right(i) for i in range(n)])
            if best is None:
                break
            tests.append((best[1], best[2]))
            leaf = [at | go << depth for at, go in zip(leaf, best[3])]
        for node in set(leaf):
            mine = [i for i in range(n) if leaf[i] == node]
            step = [-how.step * sum(grad[i][k] for i in mine) / (sum(curve[i][k] for i in mine) + how.l2) for k in range(classes)]
            for i in mine:
                margins[i] = [a + b for a, b in zip(margins[i], step)]
        out.append((tests, [list(m) for m in margins]))
    return out


@pytest.mark.parametrize("block", [1 << 16, 20])
def test_boosting_equals_a_plain_version(spark, monkeypatch, block):
    """In one task and in several."""
    monkeypatch.setattr(BT, "BLOCK_ROWS", block)
    draw = random.Random(8)
    rows = [(draw.choice(["a", "b", "c", None]), draw.choice(["u", "v"]), draw.choice([0.0, 1.0, 2.5, 7.0, None])) for _ in range(90)]
    label = [(2 if r[0] == "a" else 1 if (r[2] or 0) > 2 else 0) if draw.random() < 0.8 else draw.randrange(3) for r in rows]
    weight = [1.0 + (y == 2) for y in label]
    frame = spark.createDataFrame([(*r, y, w) for r, y, w in zip(rows, label, weight)], "p string, q string, x double, y int, w double").repartition(4)
    how = BT.Boosting(rounds=5, depth=3, step=0.3, borders=10)
    model = BT.fit(frame, F.col("y"), F.col("w"), 3, {"p": ["a", "b", "c"], "q": ["u", "v"]}, ["x"], how)
    import pandas as pd

    codes = model.codes([pd.Series([r[i] for r in rows], dtype=object if i < 2 else float) for i in range(3)])
    borders = model.numbers["x"]
    assert codes[:, 2].tolist() == [-1 if r[2] is None else sum(b < r[2] for b in borders) for r in rows]
    want = plain_boosting(codes.tolist(), label, weight, 3, [3, 2, len(borders) + 1], [True, True, False], how)
    for i, (tests, margins) in enumerate(want):
        assert [(t.column, t.code) for t in model.trees[i].tests] == tests
        part = BT.BoostedModel(3, model.categories, model.numbers, model.trees[:i + 1])
        assert part.margins(codes) == pytest.approx(np.array(margins), abs=1e-9)
    assert model.losses == sorted(model.losses, reverse=True) and len(model.losses) == 5
    scored = BT.with_margins(model, frame)
    got = Counter((r["p"], r["q"], r["x"], tuple(round(m, 9) for m in r["_margins"])) for r in scored.collect())
    assert got == Counter((*r, tuple(round(m, 9) for m in want[-1][1][i])) for i, r in enumerate(rows))


def test_boosted_models_are_stored_and_bounded(spark, base, monkeypatch):
    rows = tickets(spark).where("y IS NOT NULL")
    fitted = ML.fit(rows, "y", ML.TextFeatures(None, ("p",), ("z",)), ML.TextModel("boosted", trees=4, depth=2, balanced=True))
    fitted.model.write_to(spark, f"{base}/b")
    again = BT.BoostedModel.read_from(spark, f"{base}/b")
    order = lambda m: [tuple(r["_margins"]) for r in BT.with_margins(m, rows).orderBy("numero").collect()]
    assert order(fitted.model) == order(again) and len(again.trees) == 4
    with pytest.raises(ValueError, match="categories and numbers"):
        ML.fit(rows, "y", ML.TextFeatures("t", ("p",)), ML.TextModel("boosted"))
    monkeypatch.setattr(BT, "MOST_HISTOGRAM_BYTES", 10)
    with pytest.raises(ValueError, match="too many values"):
        ML.fit(rows, "y", ML.TextFeatures(None, ("p",)), ML.TextModel("boosted", trees=1))


def test_a_lost_worker_starts_from_the_first_tree():
    draw = np.random.default_rng(0)
    codes = draw.integers(0, 4, (50, 2)).astype(np.int32)
    trees = [BT.Tree((BT.Test(0, i % 4, True), BT.Test(1, 1, False)), draw.normal(size=(4, 3))) for i in range(6)]
    step = BT.margins_so_far("k", codes, trees[:3], 3)
    assert step is BT.margins_so_far("k", codes, trees[:3], 3)
    kept = BT.margins_so_far("k", codes, trees, 3)
    BT._MARGINS.clear()
    assert (BT.margins_so_far("k", codes, trees, 3) == kept).all()
    assert (BT.margins_so_far("k", codes, trees[:2], 3) == BT.BoostedModel(3, {}, {}, trees[:2]).margins(codes)).all()


def test_a_tree_equals_a_plain_version():
    """All columns are tried, so that nothing is drawn: one row per pair of codes, two classes, an empty pair between them."""
    rng = np.random.default_rng(3)
    codes = np.array([(a, b) for a in range(-1, 4) for b in range(-1, 5)])
    w = rng.integers(0, 6, (len(codes), 2)).astype(float)
    equal = [True, False]

    def gini(x):
        return x.sum() - (x * x).sum() / x.sum() if x.sum() else 0.0

    def plain(rows, depth):
        total = w[rows].sum(axis=0)
        tests = [(0, v, codes[rows, 0] == v) for v in range(4)] + [(1, v, codes[rows, 1] > v) for v in range(-1, 5)]
        found = [(gini(total) - gini(w[rows[r]].sum(axis=0)) - gini(w[rows[~r]].sum(axis=0)), c, v, r) for c, v, r in tests if w[rows[r]].any() and w[rows[~r]].any()]
        top = max(found, key=lambda x: round(x[0], 9), default=(0,))
        if depth == 0 or top[0] <= 1e-9:
            return total / total.sum()
        left, right = plain(rows[~top[3]], depth - 1), plain(rows[top[3]], depth - 1)
        if isinstance(left, np.ndarray) and isinstance(right, np.ndarray) and left.argmax() == right.argmax():
            return total / total.sum()
        return top[1], top[2], left, right

    def at(tree, row):
        while isinstance(tree, tuple):
            c, v, left, right = tree
            tree = right if (row[c] == v if equal[c] else row[c] > v) else left
        return tree

    everything = lambda rng, nodes, columns: np.ones((nodes, columns), bool)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(FO, "_tried", everything)
        for depth in (1, 2, 5, 30):
            tree, expected = FO.grow(codes, w, [4, 5], equal, depth, rng), plain(np.flatnonzero(w.any(axis=1)), depth)
            np.testing.assert_allclose(tree.votes(codes, np.array(equal)), np.stack([at(expected, row) for row in codes.tolist()]))
    drawn = FO._tried(rng, 50, 30)
    assert (drawn.sum(axis=1) == 6).all() and drawn.any(axis=0).all()


def test_forests_grow_from_the_different_rows(spark, monkeypatch):
    """Repeats are counts, no tree is fitted by passes over the rows, and more different rows than allowed go to Spark's own forest."""
    rows = spark.range(4000).selectExpr("if(id % 7 = 0, null, concat('p', id % 3)) AS p", "cast(id % 50 AS double) AS z",
                                        "CASE WHEN id % 3 = 1 AND id % 50 > 20 THEN 'a' WHEN id % 50 > 35 THEN 'b' ELSE 'c' END AS y")
    what, how = ML.TextFeatures(None, ("p",), ("z",)), ML.TextModel("forest", trees=20, balanced=True)
    fitted = ML.fit(rows, "y", what, how)
    assert isinstance(fitted.model, FO.ForestModel)
    scored = ML.score(fitted, rows.unionByName(rows.limit(5).selectExpr("'unknown' AS p", "cast(null AS double) AS z", "y")))
    known = scored.where("p IS NOT NULL AND p != 'unknown'").agg(F.avg((F.col("y") == F.col("previsto")).cast("int")), F.count(F.lit(1))).first()
    assert scored.count() == 4005 and known[0] > 0.9 and known[1] > 3000
    one = scored.withColumn("votes", F.aggregate("ranking", F.lit(0.0), lambda a, x: a + x["score"]))
    assert one.where("abs(votes - 20) > 1e-6").count() == 0
    again = {tuple(r) for r in ML.score(ML.fit(rows, "y", what, how), rows).select("p", "z", F.to_json("ranking")).distinct().collect()}
    assert again == {tuple(r) for r in ML.score(fitted, rows).select("p", "z", F.to_json("ranking")).distinct().collect()}
    monkeypatch.setattr(FO, "MOST_CELLS", 10)
    rest = ML.fit(rows.where("p IS NOT NULL"), "y", what, ML.TextModel("forest", trees=2, depth=3))
    assert not isinstance(rest.model, FO.ForestModel) and ML.score(rest, rows.where("p IS NOT NULL")).count() > 3000


def test_rows_that_differ_in_the_label_only_are_one(spark):
    rows = spark.range(60).selectExpr("concat('disco ', id % 2) AS t", "if(id % 4 = 0, null, 'p') AS p", "concat('c', id % 5) AS y")
    made = LT.matrix(rows, "y", ML.TextFeatures("t", ("p",), (), 1, 1, None))
    frame = made.frame.collect()
    assert len(frame) == 3 and sum(sum(r["times"]) for r in frame) == 60 and all(list(r["label"]) == [0, 1, 2, 3, 4] for r in frame)
    plain = [([j for j in r["indices"]], [v for v in r["values"]], y, n) for r in frame for y, n in zip(r["label"], r["times"], strict=True)]
    each = spark.createDataFrame(plain, "indices array<int>, values array<double>, label int, times long")
    problems = [solvers.Problem("hinge", 1.0, (1.0, 2.0, 1.0, 1.0, 3.0), 1), solvers.Problem("softmax", 1.0, (1.0, 2.0, 1.0, 1.0, 3.0))]
    with solvers.Matrix(made.frame, made.features, 5) as a, solvers.Matrix(each, made.features, 5) as b:
        for x, y in zip(solvers.solve(a, problems, 1e-9), solvers.solve(b, problems, 1e-9), strict=True):
            assert x.loss == pytest.approx(y.loss) and x.w == pytest.approx(y.w, abs=1e-6)


def test_sums_meet_before_the_driver(spark, monkeypatch):
    """However many tasks hold blocks, one array a pass is collected."""
    from pyspark import RDD
    monkeypatch.setattr(solvers, "BLOCK_ENTRIES", 20)
    frame, x, *_ = sample(spark)
    got, real = [], RDD.collect
    monkeypatch.setattr(RDD, "collect", lambda self: got.append(real(self)) or got[-1])
    with solvers.Matrix(frame.repartition(70), x.shape[1], 3) as blocks:
        assert blocks.blocks.getNumPartitions() == 70
        total = blocks.sums(lambda block: [block.times.copy(), np.array([len(block.starts)])][1:])
    assert int(total[0][0]) == 400 and [len(g) for g in got] == [1]


def test_hinge_rows_weigh_as_often_as_they_occur(spark, monkeypatch):
    rows = spark.range(600).selectExpr("CASE id % 3 WHEN 0 THEN 'disco cheio' WHEN 1 THEN 'rede fora' ELSE 'senha' END AS t", "concat('c', if(id % 20 = 0, 0, id % 3)) AS y", "'p' AS p")
    seen, real = [], ML.keep
    monkeypatch.setattr(ML, "keep", lambda df: seen.append(df.count()) or real(df))
    for balanced in (False, True):
        fitted = ML.fit(rows, "y", ML.TextFeatures("t", ("p",), (), 1, 1, 100), ML.TextModel("hinge", balanced=balanced, max_iter=20))
        wrong = ML.score(fitted, rows).where("previsto != y").count()
        assert wrong == 20 and seen[-1] <= 9
