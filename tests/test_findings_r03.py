"""Each case failed before the findings of round 3 were mended."""

import datetime

from pyspark.sql import functions as F

SEGMENTS = ["AUTO", "BIKE", "", None]


def _tables(spark, folder, n=400):
    """orders and customer as the driver writes them."""
    c = [(i, f"c{i}", i % 25, float(i % 90) * 100 - 500, SEGMENTS[i % 4]) for i in range(40)]
    o = [
        (i, i // 2 % 40, "FFP"[(i * 7 // 3) % 3], 1000.0 + (i * 7919) % 400_000, datetime.datetime(1996, 1, 1) + datetime.timedelta(days=i), f"{i % 5 + 1}-P")
        for i in range(n)
    ]
    spark.createDataFrame(c, "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string").write.parquet(f"{folder}/customer.parquet")
    spark.createDataFrame(
        o, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"
    ).write.parquet(f"{folder}/orders.parquet")
    return str(folder)


def test_log_run_logs_every_metric_of_every_segment(spark, tmp_path):
    from sparkexp.plans import registry
    from sparkexp.plans.q_io import _RUN_COLS

    rows = registry.queries()["log_run"](spark, _tables(spark, tmp_path)).collect()
    keys = [r["key"] for r in rows if r["kind"] == "metric"]
    for segment in ("", "AUTO:", "BIKE:", ":"):
        assert {f"{segment}{c}" for c in _RUN_COLS} <= set(keys)
    assert {r["key"] for r in rows if r["kind"] == "param"} == {"table", "seed", "alpha"}


def _explodes(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("Generate explode")


def test_lines_are_hashed_and_exploded_once(spark):
    from sparkexp.llm.line_dedup import dedup_lines

    docs = spark.createDataFrame([(i, f"same line\nown {i}") for i in range(12)], "doc_id long, text string")
    out = dedup_lines(docs)
    assert _explodes(out) == 0  # it was written before, and both readers read that
    assert {(r["text"], r["n_dropped"]) for r in out.collect()} == {(f"own {i}", 1) for i in range(12)}


def test_ranks_and_splits_are_read_without_a_shuffle_of_the_rows(spark):
    from sparkexp.operators.sampling import stratified_folds, stratified_split

    df = spark.range(4000).select(F.col("id"), F.when(F.col("id") % 7 > 0, F.col("id") % 3).alias("g"))
    split = stratified_split(df, ["g"], "id", 0.2, 0.2, 3)
    for out in (split, stratified_folds(df, ["g"], "id", 3, 3)):
        assert out.count() == 4000
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning" not in plan
    sizes = {(r["g"], r["split"]): r["count"] for r in split.groupBy("g", "split").count().collect()}
    for g, n in {r["g"]: r["count"] for r in df.groupBy("g").count().collect()}.items():
        test = int(n * 0.2 + 0.5)
        assert sizes[g, "test"] == test and sizes[g, "valid"] == int((n - test) * 0.25 + 0.5)


def test_boosting_draws_rows_as_before_and_walks_a_tree_once_for_its_scores(spark, monkeypatch):
    import numpy as np

    from sparkexp.operators import histogram_boosting as hb

    u = np.random.default_rng(1).integers(-(1 << 63), (1 << 63) - 1, 500)
    for seed, t in ((42, 3), (-7, 0), (1 << 40, 24)):
        draw = F.pmod(F.xxhash64("u", F.lit(seed), F.lit(t)), F.lit(1 << 30)) < F.lit(int(0.9 * (1 << 30)))
        want = [r["i"] for r in spark.createDataFrame([(i, int(v)) for i, v in enumerate(u)], "i int, u long").where(draw).orderBy("i").collect()]
        assert hb._drawn(u, seed, t, 0.9).tolist() == want

    # One-hot features share a byte, and a pass reads blocks, not rows.
    assert [a.tolist() for a in hb._pack(np.array([64, 100, 2, 2, 25]))] == [[0, 1, 2, 2, 3], [1, 1, 1, 2, 1], [64, 100, 4, 25]]
    seen = []
    kept = hb.HistogramBoosting._histograms
    monkeypatch.setattr(hb.HistogramBoosting, "_histograms", lambda self, rows, *a: (seen.append(rows), kept(self, rows, *a))[1])
    from tests.test_learners import frame

    r = np.random.default_rng(2)
    x = np.round(r.normal(size=(200, 3)), 1)
    hb.HistogramBoosting(rounds=4, max_leaves=4, min_rows=5, refresh=3).fit(frame(spark, x, (x[:, 0] > 0).astype(float)))
    assert all(rows.agg(F.sum("n")).first()[0] == 200 for rows in seen[-1:]) and all(rows.count() < 200 for rows in seen[-1:])
    assert len({id(rows) for rows in seen}) == 4  # each tree reads the scores that hold all earlier ones


def test_moments_of_a_class_are_summed_in_blocks(spark):
    import numpy as np
    from pyspark.ml.functions import array_to_vector

    from sparkexp.operators.discriminant import _moments

    r = np.random.default_rng(3)
    x, y = r.normal(size=(300, 3)), r.integers(0, 2, 300)
    df = spark.createDataFrame([(a.tolist(), float(b)) for a, b in zip(x, y, strict=True)], "a array<double>, label double").repartition(5)
    got = _moments(df.select(array_to_vector("a").alias("features"), "label"), "features", "label", 3)
    for k in (0, 1):
        n, s, q = got[k]
        assert n == (y == k).sum()
        np.testing.assert_allclose(s, x[y == k].sum(axis=0))
        np.testing.assert_allclose(q, x[y == k].T @ x[y == k])


def test_rows_are_prepared_once_for_all_steps_of_the_track(spark):
    from sparkexp.operators import models as mo
    from sparkexp.operators.features import build_preprocessor

    df = spark.createDataFrame([(i, float(i % 17), int(i * 7 % 23 + i % 17 > 18)) for i in range(300)], "unit_id long, a double, y int")
    train, valid = df.where("unit_id % 3 > 0"), df.where("unit_id % 3 = 0")
    fitted = build_preprocessor(train, ["a"], [])
    seen = []

    class Counted:
        def transform(self, d):
            seen.append(d)
            return fitted.transform(d)

    fm = mo.compare_tune_calibrate_finalize(
        train, valid, "y", ["a"], "unit_id", ("logistic_regression",), configs=[("logistic_regression", {"regParam": 0.1})], preprocessor=Counted()
    )
    assert len(seen) == 4  # train and valid, the rows of the last fit, and valid for the threshold
    assert fm.record["family"] == "logistic_regression" and 0 < fm.threshold < 1


def test_fold_search_reads_its_rows_once(spark):
    from pyspark.ml.functions import array_to_vector

    from sparkexp.operators import search as se
    from sparkexp.operators.models import make_classifier

    read = spark.sparkContext.accumulator(0)

    def costly(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    rows = spark.range(300).select((F.col("id") % 3).alias("fold"), (F.col("id") * 7 % 11 / 11.0).alias("a"), (F.col("id") % 5 > 2).cast("double").alias("label"))
    rows = rows.mapInArrow(costly, "fold long, a double, label double").select("fold", "label", array_to_vector(F.array("a")).alias("features"))
    table, _ = se.fold_search(rows, make_classifier("logistic_regression"), [{"regParam": 0.1}, {"regParam": 1.0}], se.LogLoss())
    assert table.count() == 2 and read.value == 300


def _scored(spark, n=3000):
    i = F.col("id")
    return spark.range(n).repartition(5).select(
        i, (i % 2).cast("int").alias("w"), (i * 7 % 3 == 0).cast("int").alias("y"), (i * 31 % 97 / 97.0).alias("p"), F.lit(0.4).alias("p1"), F.lit(0.3).alias("p0")
    )


def test_a_candidate_is_sorted_once_for_all_its_metrics(spark, monkeypatch):
    from sparkexp.operators import labs, ordering
    from sparkexp.operators import uplift as up

    df = _scored(spark)
    calls, ranged = [], ordering._ranged
    monkeypatch.setattr(ordering, "_ranged", lambda *a, **k: (calls.append(1), ranged(*a, **k))[1])
    row = labs.evaluate_uplift(df, "y", "w", "id", "k", "m", n_boot=30, score_col="p", p_treated_col="p1", p_control_col="p0")
    got = row.first()
    assert len(calls) == 1 and "rangepartitioning" not in row._jdf.queryExecution().executedPlan().toString()
    m = up.uplift_metrics(df, "y", "w", "p", "id").first()
    b = up.bootstrap_auuc(df, "y", "w", "p", "id", 30, 42).first()
    p = up.compare_policies(df, "y", "w", "p", "id").first()
    assert (got["holdout_primary_metric"], got["holdout_secondary_metric"], got["holdout_tertiary_metric"]) == (m["auuc"], m["qini"], m["uplift_at_top_decile"])
    assert (got["cv_metric_mean"], got["cv_metric_std"]) == (b["cv_metric_mean"], b["cv_metric_std"])
    assert got["policy_incremental_value"] == p["expected_incremental_value_targeted"]


def test_weights_of_replicates_are_those_of_the_distribution_function():
    import numpy as np

    from sparkexp.functions import hashing as hs

    r = np.random.default_rng(4)
    ids = r.integers(-(1 << 62), 1 << 62, 3000)
    base = hs.row_base_np(9, ids)
    u = hs.h32_np(base[:, None] ^ hs.rep_salt_np(70)[None, :]).astype(float) / hs.TWO_32
    want = np.searchsorted(hs.poisson1_cdf(), u, side="right")
    got = hs.poisson1_counts_np(base, hs.rep_salt_np(70))
    assert got.dtype == np.uint8 and got.max() > 5
    assert (got.T == want).all() and (hs.poisson1_weights_np(9, ids, 70) == want).all()


def test_few_distinct_values_are_ranked_for_a_median(spark):
    import numpy as np

    from sparkexp.operators import features as fe
    from sparkexp.operators.ordering import exact_quantiles

    r = np.random.default_rng(5)
    inf, nan = float("inf"), float("nan")
    odd = [[2.0, 5.0], [5.0, 1.0, 3.0], [-inf, 2.0, inf, nan], r.normal(size=4000).tolist()]
    for values in odd:
        df = spark.createDataFrame([(v, None, i % 3) for i, v in enumerate(values)] + [(None, None, None)], "a double, b double, c int").repartition(3)
        got = dict(fe.fit_medians(df, ["a", "b", "c"]).collect())
        want = {x["feature"]: x["value"] for x in exact_quantiles(df, ["a", "b", "c"], [0.5]).collect()}
        assert {k: repr(x) for k, x in got.items()} == {k: repr(x) for k, x in want.items()} and set(got) == {"a", "c"}
    assert fe._around_medians(df, ["a"]).distinct().count() < 200  # of 4000


def test_families_of_a_lab_share_the_prepared_rows(spark, monkeypatch):
    from sparkexp.operators import labs
    from sparkexp.operators import models as mo

    i = F.col("id")
    df = spark.range(600).select(i.alias("unit_id"), (i % 17).cast("double").alias("a"), (i % 2).cast("int").alias("treatment"), (i * 7 % 23 + i % 17 > 18).cast("int").alias("converted"))
    made, kept = [], mo._prepared
    monkeypatch.setattr(mo, "_prepared", lambda *a: (made.append(kept(*a)), made[-1])[1])
    out = labs.run_prototype_lab(df.where("unit_id % 3 > 0"), df.where("unit_id % 3 = 0"), ["a"], ["logistic_regression", "GaussianNB"], "unit_id", n_boot=5)
    assert out.count() == 2 and len(made) == 1 and not made[0].storageLevel.useMemory
    made.clear()
    split = [df.where(F.col("unit_id") % 3 == k) for k in range(3)]
    rows, errors = labs.run_engineered_lab(*split, ["a"], ["logistic_regression"], "unit_id", n_boot=5)
    assert rows.count() == 1 and errors.first()["status"] == "ok" and len(made) == 1


def test_a_seed_of_the_stability_run_scores_its_holdout_once(spark, monkeypatch):
    from sparkexp.operators import models as mo

    scored, transform = spark.sparkContext.accumulator(0), mo.TLearner.transform

    def counted(batches):
        for b in batches:
            scored.add(b.num_rows)
            yield b

    def transformed(self, df):
        out = transform(self, df)
        return out.mapInArrow(counted, out.schema)

    monkeypatch.setattr(mo.TLearner, "transform", transformed)
    i = F.col("id")
    df = spark.range(500).select(i, (i % 17).cast("double").alias("a"), (i % 2).cast("int").alias("treatment"), (i % 10 < 5).cast("int").alias("converted"))
    runs, _ = mo.seed_stability(df, ["a"], ["logistic_regression"], [3], "id")
    assert runs.first()["status"] == "ok" and scored.value == 100
