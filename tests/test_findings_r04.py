"""Each case failed before the findings of round 4 were mended."""

import datetime
from dataclasses import replace

import numpy as np

from tests.test_learners import frame


def _tables(spark, folder, n=400):
    """orders and customer as the driver writes them."""
    c = [(i, i % 25, float(i % 90) * 100 - 500, ["AUTO", "BIKE", "TOYS"][i % 3]) for i in range(40)]
    o = [(i, i // 2 % 40, "FFP"[(i * 7 // 3) % 3], 1000.0 + (i * 7919) % 400_000, datetime.datetime(1996, 1, 1), f"{i % 5 + 1}-P") for i in range(n)]
    spark.createDataFrame(c, "c_custkey long, c_nationkey int, c_acctbal double, c_mktsegment string").write.parquet(f"{folder}/customer.parquet")
    spark.createDataFrame(
        o, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"
    ).write.parquet(f"{folder}/orders.parquet")
    return str(folder)


def _people(spark, n=240):
    r = np.random.default_rng(9)
    rows = [(i, float(a), float(b), "xyz"[i % 3], int(i // 3 % 2), int(a + b * (i % 2) > 0)) for i, (a, b) in enumerate(r.normal(size=(n, 2)))]
    return spark.createDataFrame(rows, "user_id long, a double, b double, c string, treatment int, converted int")


def test_x_learner_boosts_all_rounds(spark):
    from sparkexp.operators import models as mo

    m = mo.fit_x_learner(_people(spark), ["a", "b", "c"], effect={"maxIter": 1})
    assert len(m.mu_treated.roots) == len(m.mu_control.roots) == mo.SETTINGS["uplift"]["boosting"]["maxIter"] == 300


def test_one_task_grows_the_same_trees(spark):
    from sparkexp.operators import histogram_boosting as hb

    r = np.random.default_rng(4)
    x = np.round(r.normal(size=(400, 3)), 1)
    df = frame(spark, x, (x[:, 0] * x[:, 1] > 0.1) ^ (r.random(400) < 0.1))
    for own in ({"max_leaves": 9}, {"max_leaves": 0, "max_depth": 3, "rows_share": 0.8, "features_share": 0.7}, {"max_leaves": 7, "max_depth": 3}):
        est = hb.HistogramBoosting(rounds=4, rate=0.3, min_rows=5, **own)
        one, many = replace(est, own_rows=400).fit(df), est.fit(df)
        assert len(one.roots) == 4
        assert all(np.array_equal(getattr(one, k), getattr(many, k)) for k in ("feature", "cut", "left", "right", "value", "roots", "depth"))


def test_second_order_boosting_grows_all_rounds(spark, monkeypatch, tmp_path):
    from sparkexp.operators.histogram_boosting import HistogramBoosting
    from sparkexp.plans import registry

    made, fit = [], HistogramBoosting.fit
    monkeypatch.setattr(HistogramBoosting, "fit", lambda self, df: made.append(self) or fit(self, df))
    assert registry.queries()["second_order_boosting"](spark, _tables(spark, tmp_path)).count() > 50
    assert sorted((m.rounds, m.max_depth, m.max_leaves) for m in made) == [(300, 5, 0), (350, 0, 31)]


def test_a_sweep_takes_the_settings_whole(spark, monkeypatch):
    from sparkexp.operators import models as mo

    df = _people(spark)
    made, make = [], mo.make_classifier
    monkeypatch.setattr(mo, "make_classifier", lambda *a, **b: made.append(make(*a, **b)) or make("logistic_regression"))
    out = mo.sweep_families(df, df, "converted", ["random_forest", "xgboost", "ExtraTrees"], mo.build_preprocessor(df, ["a", "b"], ["c"]))
    assert {r["status"] for r in out.collect()} == {"ok"}
    forest, boosted, extra = made
    assert (forest.getNumTrees(), forest.getMaxDepth(), forest.getMinInstancesPerNode()) == (400, mo.UNLIMITED_DEPTH, 2)
    assert (boosted.rounds, boosted.rate, boosted.max_depth) == (450, 0.05, 4)
    assert (extra.trees, extra.max_depth, extra.min_rows) == (400, mo.UNLIMITED_DEPTH, 2)


def test_every_registry_family_is_swept(spark, monkeypatch, tmp_path):
    from sparkexp.operators import models as mo
    from sparkexp.plans import registry

    asked = []
    monkeypatch.setattr(mo, "sweep_families", lambda *a, **b: asked.extend(a[3]) or a[0])
    registry.queries()["make_classifier"](spark, _tables(spark, tmp_path))
    groups = {mo.family_group(f) for f in asked}
    assert groups >= set(mo.FAMILY_GROUPS)
    assert {"LinearSVC", "KNeighborsClassifier", "AdaBoostClassifier", "RidgeClassifier", "GaussianNB", "DecisionTreeClassifier"} <= set(asked)
    for f in asked:
        mo.make_classifier(f, strict=True)


def test_forests_are_calibrated_one_fold_at_a_time(spark, monkeypatch):
    """Three folds at once, each with the nodes of every row, filled the disk."""
    from pyspark.ml.classification import RandomForestClassifier

    from sparkexp.operators import models as mo

    df = _people(spark)
    prepared = mo.build_preprocessor(df, ["a", "b"], ["c"]).transform(df).withColumn("label", df["converted"].cast("double"))
    open_, seen, fit = [], [], RandomForestClassifier.fit

    def counted(self, rows, *more):
        open_.append(1)
        seen.append((len(open_), self.getCacheNodeIds()))
        try:
            return fit(self, rows, *more)
        finally:
            open_.pop()

    monkeypatch.setattr(RandomForestClassifier, "fit", counted)
    est = mo.make_classifier("random_forest", numTrees=5)
    cal = mo.platt_calibrate(prepared, est, "label", "user_id")
    assert seen == [(1, False)] * 3
    assert est.getCacheNodeIds() and len(cal.bases) == 3


def test_a_block_of_neighbours_is_looked_up_in_boxes(monkeypatch):
    """Every query met every vector of a block, and a block handed on a row for each distance."""
    import pyarrow as pa

    from sparkexp.operators import neighbors as nb

    r = np.random.default_rng(2)
    made = lambda n: np.concatenate([np.round(r.random((n, 2)), 3), np.eye(2)[r.integers(0, 2, n)]], axis=1)
    x, q = np.unique(made(6000), axis=0), made(200)
    n, pos = r.integers(1, 4, len(x)), r.random(len(x))
    bound = np.where(np.arange(len(q)) % 2, np.inf, 0.02)
    lists = lambda v: pa.array(v.tolist(), pa.list_(pa.float64()))
    pairs, between = [], nb._between
    monkeypatch.setattr(nb, "_between", lambda a, b: pairs.append(len(a)) or between(a, b))
    out = nb._meet(25, 4)(pa.table({"q": lists(q), "bound": bound}), pa.table({"x": lists(x), "n": n, "pos": pos})).to_pylist()
    assert sum(pairs) < len(q) * len(x) / 10
    of = {tuple(h["q"]): h for h in out}
    assert len(of) == len(out)
    for v, b in zip(q, bound, strict=True):
        d = nb._distances(v[None], x)[0]
        order = np.argsort(d)
        order = order[d[order] <= b]
        enough = np.flatnonzero(np.cumsum(n[order]) >= 25)
        reach = d[order[enough[0]]] if len(enough) else np.inf
        order = order[d[order] <= reach]
        if not len(order):
            assert tuple(v) not in of
            continue
        h = of[tuple(v)]
        assert h["reach"] == reach and h["d"] == d[order].tolist()
        assert sorted(zip(h["d"], h["n"], h["pos"], strict=True)) == sorted(zip(d[order], n[order], pos[order], strict=True))
