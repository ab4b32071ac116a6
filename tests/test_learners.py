"""Learners that pyspark.ml lacks, against plain NumPy versions."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from sparkexp.operators import neighbors as nb


def frame(spark, x, y, **more):
    rows = [(i, [float(v) for v in a], float(b)) for i, (a, b) in enumerate(zip(x, y, strict=True))]
    return spark.createDataFrame(rows, "id long, f array<double>, label double").select("id", array_to_vector("f").alias("features"), "label")


def p1(model, df):
    return {r.id: r.p for r in model.transform(df).select("id", vector_to_array("probability")[1].alias("p")).collect()}


def knn(x, y, q, k):
    """Distance-weighted vote; ties for the last places share them."""
    out = []
    for a in q:
        d = np.sqrt(((x - a) ** 2).sum(axis=1))
        u = np.unique(d)
        w = tot = seen = 0.0
        for v in u:
            n, p = (d == v).sum(), y[d == v].sum()
            take = min(n, k - seen)
            if take <= 0:
                break
            g = take if u[0] == 0 else take / v
            if u[0] != 0 or v == 0:
                w, tot = w + g * p / n, tot + g
            seen += n
        out.append(w / tot)
    return np.array(out)


@pytest.mark.parametrize("kind", ["smooth", "grid", "copies", "few"])
def test_neighbors_against_brute_force(spark, monkeypatch, kind):
    monkeypatch.setattr(nb, "BLOCK", 30)
    r = np.random.default_rng(3)
    n = {"few": 9}.get(kind, 400)
    x = r.normal(size=(n, 3))
    if kind == "grid":
        x = np.round(x)
    if kind == "copies":
        x[: n // 3] = x[0]
        x[n // 2 :, 2] = 0
    y = (x[:, 0] + r.normal(size=n) > 0).astype(float)
    q = np.concatenate([r.normal(size=(60, 3)), x[:40], x[:5], [[50, 50, 50]]])
    if kind == "grid":
        q = np.round(q)
    m = nb.NearestNeighbors(k=25, cell_rows=20).fit(frame(spark, x, y))
    assert len(m.pivots) > 3 or kind in ("few", "grid")
    got = p1(m, frame(spark, q, np.zeros(len(q))))
    assert np.allclose([got[i] for i in range(len(q))], knn(x, y, q, 25), atol=1e-12)


def test_neighbors_rule_cells_out(spark):
    """Far clusters are never asked: most cells are ruled out by their radius."""
    r = np.random.default_rng(5)
    x = np.concatenate([r.normal(size=(100, 2)) + [1000.0 * c, 0] for c in range(8)])
    m = nb.NearestNeighbors(k=5, cell_rows=50).fit(frame(spark, x, np.zeros(800)))
    stats = {s.cell: s.r for s in m.cells.groupBy("cell").agg(F.max("dist").alias("r")).collect()}
    radius = np.array([stats.get(c, 0.0) for c in range(len(m.pivots))])
    q = spark.createDataFrame([([0.1, 0.2], int(np.argmin(((m.pivots - [0.1, 0.2]) ** 2).sum(axis=1))), 5.0)], "q array<double>, cell int, bound double")
    asked = q.mapInArrow(nb._others(m.pivots, radius, np.ones(len(radius), bool)), "q array<double>, cell int, bound double")
    assert asked.count() <= (m.pivots[:, 0] < 500).sum()


def test_ridge_against_numpy(spark):
    from sparkexp.operators.boosting import RidgeClassifier

    r = np.random.default_rng(1)
    x = r.normal(size=(300, 4)) * [1, 3, 0.5, 1] + [0, 2, 0, 0]
    y = (x @ [1, -0.5, 0, 0.2] + r.normal(size=300) > 0).astype(float)
    m = RidgeClassifier(alpha=1.0).fit(frame(spark, x, y))
    c = x - x.mean(axis=0)
    t = 2 * y - 1
    w = np.linalg.solve(c.T @ c + np.eye(4), c.T @ (t - t.mean()))
    assert np.allclose(m.weights, w) and np.isclose(m.intercept, t.mean() - x.mean(axis=0) @ w)
    got = m.transform(frame(spark, x, y)).select("id", vector_to_array("rawPrediction")[1].alias("z"), "prediction").orderBy("id").collect()
    z = x @ w + m.intercept
    assert np.allclose([g.z for g in got], z) and [g.prediction for g in got] == [float(v > 0) for v in z]


def samme(x, y, rounds):
    """Stumps by weighted Gini over all halfway cuts; returns votes per row."""
    w, votes, total = np.ones(len(y)), np.zeros(len(y)), 0.0
    for t in range(rounds):
        best = None
        for j in range(x.shape[1]):
            v = np.unique(x[:, j])
            for c in (v[1:] + v[:-1]) / 2:
                left = x[:, j] <= c
                s = [[w[left & (y == k)].sum() for k in (0, 1)], [w[~left & (y == k)].sum() for k in (0, 1)]]
                g = sum(sum(a) - (a[0] ** 2 + a[1] ** 2) / sum(a) for a in s)
                if best is None or g < best[0] * (1 - 1e-12):
                    best = (g, left, int(s[0][1] > s[0][0]), int(s[1][1] > s[1][0]))
        pred = np.where(best[1], best[2], best[3])
        err = w[pred != y].sum() / w.sum()
        if err >= 0.5 and t:
            break
        a = np.log(max(1 - err, 1e-10) / max(err, 1e-10))
        votes, total = votes + a * (2 * pred - 1), total + abs(a)
        w = w * np.exp(a * (pred != y))
        if err <= 1e-10 or err >= 0.5:
            break
    return votes / total


def test_adaboost_against_numpy(spark):
    from sparkexp.operators.boosting import AdaBoost

    r = np.random.default_rng(2)
    x = np.round(r.normal(size=(250, 3)), 1)
    y = ((x[:, 0] * x[:, 1] > 0) | (x[:, 2] > 1)).astype(float)
    df = frame(spark, x, y)
    got = p1(AdaBoost(rounds=8, max_bins=120).fit(df), df)
    assert np.allclose([got[i] for i in range(250)], 1 / (1 + np.exp(-2 * samme(x, y, 8))))
    # Many distinct values: quantile cuts still learn the rule.
    big = r.normal(size=(2000, 2))
    yb = (np.abs(big[:, 0]) > 0.7).astype(float)
    got = p1(AdaBoost(rounds=12).fit(frame(spark, big, yb)), frame(spark, big, yb))
    assert np.mean([(got[i] > 0.5) == (yb[i] == 1) for i in range(2000)]) > 0.93
    one = AdaBoost().fit(frame(spark, x, x[:, 0] > 0))
    assert len(one.feature) == 1


def test_limits_keep_the_total_step():
    from sparkexp.operators.models import LIMITS, fit_settings, make_classifier

    full, own = fit_settings("uplift", "plain_boosting", full=True), fit_settings("uplift", "plain_boosting")
    assert own["maxIter"] == LIMITS["rounds"] and np.isclose(own["maxIter"] * own["stepSize"], full["maxIter"] * full["stepSize"])
    assert make_classifier("random_forest").getNumTrees() == LIMITS["numTrees"]
    assert make_classifier("random_forest", full=True).getNumTrees() == 300
    assert make_classifier("knn", k=3).k == 3


def test_bundles_score_the_same_when_loaded(spark, tmp_path):
    from sparkexp.operators import models as mo
    from sparkexp.operators.boosting import RidgeModel
    from sparkexp.operators.bundle import load_any
    from sparkexp.sources import io

    r = np.random.default_rng(9)
    rows = [(i, float(a), float(b), "xyz"[i % 3], int(i % 2), int(a + b * (i % 2) > 0)) for i, (a, b) in enumerate(r.normal(size=(240, 2)))]
    df = spark.createDataFrame(rows, "user_id long, a double, b double, c string, treatment int, converted int")
    feats = ["a", "b", "c"]
    x = mo.build_preprocessor(df, ["a", "b"], ["c"])
    prepared = x.transform(df).withColumn("label", df["converted"].cast("double"))
    cal = mo.platt_calibrate(prepared, mo.make_classifier("logistic_regression"), "label", "user_id")
    score = {
        "t": (mo.fit_t_learner(df, feats, "logistic_regression", calibrate=True), lambda m: m.transform(df).select("user_id", "uplift")),
        "x": (mo.fit_x_learner(df, feats, family="logistic_regression", effect={"maxIter": 2}), lambda m: m.transform(df).select("user_id", "uplift")),
        "final": (mo.FinalModel(x, cal, "logistic_regression", 0.4, {"auc": 0.5, "of": [1, (2, 3)]}), lambda m: m.score(df).select("user_id", "score")),
    }
    for fam in ("lda", "qda", "knn", "ridge", "adaboost"):
        score[fam] = (mo.make_classifier(fam).fit(prepared), lambda m: mo.score_with(m, prepared, "s").select("user_id", "s"))
    for name, (model, of) in score.items():
        path = str(tmp_path / name)
        io.save_model(model, path, {"threshold": 0.4})
        io.save_model(model, path, {"threshold": 0.5})  # overwrites
        back, meta = io.load_model(spark, path)
        assert type(back) is type(model) and meta["threshold"] == 0.5
        assert sorted(of(model).collect()) == sorted(of(back).collect()), name
    assert load_any(spark, str(tmp_path / "final" / "model")).record == {"auc": 0.5, "of": [1, (2, 3)]}
    with pytest.raises(TypeError):
        RidgeModel.load(str(tmp_path / "lda" / "model"))
