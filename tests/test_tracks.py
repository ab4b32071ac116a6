"""Streams with late rows, latency, extra trees, sweeps by arm and finalised tracks."""

from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkexp.operators import models as mo
from sparkexp.operators.extra_trees import ExtraTrees
from sparkexp.streaming import drift as sd
from sparkexp.streaming.scoring import read_record_stream, run_windowed
from tests.test_learners import frame, p1


def test_late_rows_beyond_the_watermark_do_not_count(spark, tmp_path):
    day = lambda d, h=0: datetime(2024, 1, d, h)
    train = spark.createDataFrame([(float(v),) for v in range(100)], "x double")
    ref = sd.training_histogram(train, ["x"])
    assert ref.first().counts == [10] * 10
    src, out, ck = (str(tmp_path / n) for n in ("src", "out", "ck"))
    runs = [
        [(day(1), 5.0), (day(1), 95.0), (day(1), 500.0), (day(4), 5.0)],
        [(day(4), 15.0)],  # the watermark now stands at 2 January
        [(day(1), 25.0), (day(3), 35.0), (day(4), None)],  # too late, late, no value
    ]
    for rows in runs:
        spark.createDataFrame(rows, "ts timestamp, x double").coalesce(1).write.mode("append").parquet(src)
        stream = read_record_stream(spark, src, spark.read.parquet(src).schema, "parquet")
        run_windowed(sd.windowed_histogram(stream, ref, "ts", ["x"], "1 day", "2 days"), out, ck)
    got = {r.window_start.day: r for r in sd.latest_drift(spark, out, ref).collect()}
    assert {d: r.rows for d, r in got.items()} == {1: 3, 3: 1, 4: 2}
    e, a = np.full(10, 0.1), (np.array([1, 1] + [0] * 8) + 1e-6) / (2 + 1e-5)
    e = (np.full(10, 10) + 1e-6) / (100 + 1e-5)
    assert np.isclose(got[4].psi, ((a - e) * np.log(a / e)).sum()) and got[4].drift_level == "high"


def test_latency_counts_calls(spark):
    from sparkexp.operators.scoring import latency_distribution

    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    r = latency_distribution(spark.range(0, 1000, 1, 2), rows_per_call=100).first()
    assert (r.calls, r.rows) == (8, 800) and 0 < r.p50_latency_ms <= r.p95_latency_ms
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before
    r = latency_distribution(spark.range(0)).first()
    assert (r.calls, r.rows, r.p95_latency_ms) == (0, 0, None)


def test_extra_trees(spark, monkeypatch):
    r = np.random.default_rng(6)
    x = r.normal(size=(800, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    df = frame(spark, x, y)
    m = ExtraTrees(trees=40, max_depth=8, seed=1).fit(df)
    got = p1(m, df)
    assert np.mean([(got[i] > 0.5) == (y[i] == 1) for i in range(800)]) > 0.95
    again = ExtraTrees(trees=40, max_depth=8, seed=1).fit(df.repartition(7))
    assert all(np.array_equal(getattr(m, k), getattr(again, k)) for k in ("feature", "cut", "left", "right", "p1"))
    # Leaf values are the shares of the rows that end there, min_rows of them at least.
    from sparkexp.operators.extra_trees import _walk

    a = [np.asarray(v, int) if k != "cut" else v for k, v in (("feature", m.feature), ("cut", m.cut), ("left", m.left), ("right", m.right))]
    for t in (0, 17):
        leaf = _walk(x, t, *a, m.depth)
        for k in np.unique(leaf):
            own = y[leaf == k]
            assert len(own) >= 3 and np.isclose(m.p1[k], own.mean())
    even = ExtraTrees(trees=10, balanced=True).fit(frame(spark, x, (x[:, 0] > 1.3).astype(float)))
    assert np.isclose(even.p1[0], 0.5)
    one = ExtraTrees(trees=3).fit(frame(spark, x, np.ones(800)))
    assert list(one.feature) == [-1] * 3 and set(p1(one, df).values()) == {1.0}


@pytest.fixture(scope="module")
def arms(spark):
    r = np.random.default_rng(8)
    data = []
    for i, (a, b) in enumerate(r.normal(size=(900, 2))):
        t = i % 2
        data.append((i, float(a), float(b), "uv"[i % 3 == 0], t, int(a * (1 if t else -1) + 0.3 * b + r.normal() > 0)))
    df = spark.createDataFrame(data, "user_id long, a double, b double, c string, treatment int, converted int").cache()
    return [df.where(F.col("user_id") % 5 < 3), df.where(F.col("user_id") % 5 == 3), df.where(F.col("user_id") % 5 == 4)]


def test_sweep_by_arm_ranks_what_both_arms_show(arms):
    ranking, both = mo.sweep_families_by_arm(arms[0], arms[1], ["a", "b"], ["LogisticRegression", "RidgeClassifier", "DecisionTreeClassifier"], top_n=2)
    rows, tables = ranking.orderBy("selection_rank").collect(), both.collect()
    assert len(tables) == 6 and {t.status for t in tables} == {"ok"}
    mean = {f: np.mean([t.balanced_accuracy for t in tables if t.model_name == f]) for f in {t.model_name for t in tables}}
    assert all(np.isclose(r.balanced_accuracy_mean, mean[r.model_family]) for r in rows)
    top = [r.balanced_accuracy_mean for r in rows if not r.is_fallback]
    assert top == sorted(top, reverse=True) and sum(r.is_top for r in rows) == 2


CONFIGS = [("logistic_regression", {"regParam": 0.0}), ("logistic_regression", {"regParam": 0.1}), ("lda", {})]


def test_finalise_fits_all_rows(spark, arms):
    """The final base model is the one that all training rows give."""
    train, valid, hold = arms
    fm = mo.compare_tune_calibrate_finalize(train, valid, "converted", ["a", "b"], "user_id", ("logistic_regression",), configs=CONFIGS)
    assert len(fm.model.bases) == 1
    x = fm.preprocessor.transform(train).withColumn("label", F.col("converted").cast("double"))
    want = mo.make_classifier("logistic_regression", weight_col="_w", project="churn", **fm.record["config"]).fit(mo.balanced_weights(x, "label"))
    assert np.allclose(fm.model.bases[0].coefficients.toArray(), want.coefficients.toArray())
    scores = [r.score for r in fm.score(hold).collect()]
    assert all(0 < s < 1 for s in scores)


def test_finalized_and_engineered_labs(spark, arms):
    from sparkexp.operators import labs

    row, learner, shares, record = labs.run_finalized_lab(*arms, ["a", "b"], n_boot=10, families=("logistic_regression",), configs=CONFIGS)
    assert set(record) == {"treatment", "control"} and row.first().holdout_primary_metric > 0
    assert row.first().selected_target_fraction == shares.where("is_best").first().target_fraction
    rows, models, sweeps = labs.run_engineered_lab_churn(*arms, "converted", ["a", "b", "c"], ["logistic_regression", "lda"])
    got = {r.candidate_id: r for r in rows.collect()}
    assert set(got) == set(models) == {"manual::logistic_regression", "manual::lda"}
    from sparkexp.operators.classification import business_cost_per_1000

    for name, r in got.items():
        best = sweeps.where((F.col("candidate_id") == name) & F.col("is_best")).first()
        assert r.threshold == best.threshold == models[name].threshold
        cost = business_cost_per_1000(models[name].score(arms[2]), "converted", "score", r.threshold).first()[0]
        assert np.isclose(cost, r.holdout_primary_metric) and r.p95_latency_ms > 0
