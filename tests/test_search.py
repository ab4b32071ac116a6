"""Cross-validated search: equal to plain loops, fixed schedules repeat."""

import json

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from sparkexp.operators import models as mo
from sparkexp.operators import search as se


@pytest.fixture(scope="module")
def rows(spark):
    r = np.random.default_rng(0)
    x = r.normal(size=(360, 3))
    y = (x[:, 0] + 0.5 * x[:, 1] + r.normal(size=360) > 0).astype(float)
    data = [(i, [float(v) for v in a], float(b)) for i, (a, b) in enumerate(zip(x, y, strict=True))]
    return spark.createDataFrame(data, "id long, f array<double>, label double").select("id", array_to_vector("f").alias("features"), "label").cache()


GRID = [{"regParam": 0.0}, {"regParam": 0.3}, {"regParam": 3.0, "elasticNetParam": 0.5}]


def by_hand(metric, scored):
    s = sorted(((r["s"], r["label"]) for r in scored.collect()), reverse=True)
    p, y = np.array([a for a, _ in s]), np.array([b for _, b in s])
    if metric == "log_loss":
        q = np.clip(p, 1e-15, 1 - 1e-15)
        return float(-(y * np.log(q) + (1 - y) * np.log(1 - q)).mean())
    if metric == "business_cost":
        return float((((p >= 0.5) & (y == 0)).sum() * 65 + ((p < 0.5) & (y == 1)).sum() * 320) / len(y) * 1000)
    # Equal scores are one threshold.
    ends = [k for k in range(len(p)) if k + 1 == len(p) or p[k + 1] != p[k]]
    hits = np.cumsum(y)[ends]
    return float(sum((h - b) * h / (k + 1) for k, h, b in zip(ends, hits, [0, *hits[:-1]], strict=True)) / y.sum())


@pytest.mark.parametrize("metric", sorted(se.METRICS))
def test_fold_search_equals_the_loop(spark, rows, metric):
    folded = mo.stratified_folds(rows, ["label"], "id", 3, 7).cache()
    table, model = se.fold_search(folded, mo.make_classifier("logistic_regression"), GRID, se.METRICS[metric]())
    want = []
    for g in GRID:
        own = []
        for f in range(3):
            m = mo.make_classifier("logistic_regression", **g).fit(folded.where(F.col("fold") != f))
            own.append(by_hand(metric, mo.score_with(m, folded.where(F.col("fold") == f), "s")))
        want.append((np.mean(own), np.std(own)))
    got = table.orderBy("trial").collect()
    assert np.allclose([(r.metric_mean, r.metric_std) for r in got], want)
    best = [r.trial for r in got if r.is_best]
    means = [w[0] for w in want]
    assert best == [int(np.argmax(means) if metric == "average_precision" else np.argmin(means))]
    assert model.bestModel.getOrDefault("regParam") == GRID[best[0]]["regParam"]


def test_schedule():
    assert se.halving_schedule(9, 3, 1 / 9) == [(1 / 9, 9), (1 / 3, 3), (1.0, 1)]
    assert se.halving_schedule(1) == [(1.0, 1)] and se.halving_schedule(4, 2, 0.5) == [(0.5, 4), (1.0, 2)]
    drawn = se.sample_configs(["logistic_regression", "lda"], 6, 1)
    assert drawn == se.sample_configs(["logistic_regression", "lda"], 6, 1) and len({json.dumps(c) for c in drawn}) == len(drawn)


CONFIGS = [("logistic_regression", {"regParam": v}) for v in (0.0, 5.0)] + [("lda", {}), ("ridge", {"alpha": 1.0})]


def test_halving_repeats_and_equals_the_loop(spark, rows):
    run = lambda: se.halving_search(rows, "label", "id", CONFIGS, eta=2, least_share=0.25, seed=3).drop("seconds").orderBy("rung", "trial").collect()
    got = run()
    assert got == run()
    assert [(r.rung, r.share) for r in got if r.trial == got[-1].trial][-1] == (2, 1.0)
    left = range(len(CONFIGS))
    folded = mo.stratified_folds(rows, ["label"], "id", 3, 3).withColumn("at", F.pmod(F.xxhash64("id", F.lit(3)), F.lit(1 << 20))).cache()
    for rung, (share, n) in enumerate(se.halving_schedule(len(CONFIGS), 2, 0.25)):
        assert len(left) == n
        part = folded.where(F.col("at") < int(share * (1 << 20)))
        loss = {}
        for t in left:
            own = []
            for f in range(3):
                m = mo.make_classifier(CONFIGS[t][0], 3, **CONFIGS[t][1]).fit(part.where(F.col("fold") != f))
                own.append(by_hand("log_loss", mo.score_with(m, part.where(F.col("fold") == f), "s")))
            loss[t] = np.mean(own)
        mine = {r.trial: r for r in got if r.rung == rung}
        assert set(mine) == set(left) and all(np.isclose(mine[t].loss, loss[t]) for t in left)
        left = sorted(sorted(left, key=loss.get)[: max(1, -(-n // 2))])
        assert sorted(t for t, r in mine.items() if r.kept) == left
    assert [r.trial for r in got if r.is_best] == left[:1]


def test_budget_stops_after_the_first_rung(rows):
    got = se.halving_search(rows, "label", "id", CONFIGS[:3], metric="business_cost", budget_sec=0.0).collect()
    assert {r.rung for r in got} == {0} and sum(r.is_best for r in got) == 1 and len(got) == 3


def test_t_learner_arms_are_searched_apart(spark):
    r = np.random.default_rng(4)
    data = []
    for i, (a, b) in enumerate(r.normal(size=(600, 2))):
        t = i % 2
        data.append((i, float(a), float(b), t, int(a * (1 if t else -1) + 0.3 * b + r.normal() > 0)))
    df = spark.createDataFrame(data, "user_id long, a double, b double, treatment int, converted int")
    part = [df.where(F.col("user_id") % 5 < 3), df.where(F.col("user_id") % 5 == 3), df.where(F.col("user_id") % 5 == 4)]
    row, learner, shares, trials = se.search_t_learner(*part, ["a", "b"], CONFIGS[:3], n_boot=20, eta=3, least_share=1 / 3)
    r = row.first()
    assert r.candidate_key == "search::t_learner" and r.holdout_primary_metric > 0
    details = {d.arm: d for d in se.search_details(trials).collect()}
    assert set(details) == {"treatment", "control"} and details["control"].best_loss < 0.69
    best = shares.where("is_best").first().target_fraction
    assert r.selected_target_fraction == best
    assert learner.transform(part[2]).select(F.corr("uplift", "a")).first()[0] > 0.5
