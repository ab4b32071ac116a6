"""A NULL group is a group like any other: results equal those of the same table
with a name in its place. And no operator leaves cached data behind."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sparkexp.operators import classification as cl
from sparkexp.operators import drift as dr
from sparkexp.operators import experiment as ex
from sparkexp.operators import ordering as od
from sparkexp.operators import uplift as up

G = ["g"]


@pytest.fixture(scope="module")
def table(spark):
    n = spark.range(600)
    return n.select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.concat(F.lit("g"), (F.col("id") % 3).cast("string"))).alias("g"),
        (F.pmod(F.hash("id"), F.lit(2))).cast("int").alias("w"),
        (F.pmod(F.hash("id", F.lit(1)), F.lit(3)) == 0).cast("int").alias("y"),
        (F.pmod(F.hash("id", F.lit(2)), F.lit(97)) / 97.0).alias("p"),
        F.pmod(F.hash("id", F.lit(3)), F.lit(1000)).cast("double").alias("x"),
        F.concat(F.lit("c"), F.pmod(F.hash("id", F.lit(4)), F.lit(4)).cast("string")).alias("c"),
    )


OPERATORS = {
    "threshold_sweep": lambda a, b: cl.threshold_sweep(a, "y", "p", G),
    "evaluate_classifier": lambda a, b: cl.evaluate_classifier(a, b, "y", "p", G),
    "experiment_summary": lambda a, b: ex.experiment_summary(a, "w", "y", "p", "id", G),
    "balance_check": lambda a, b: ex.balance_check(a, "w", ["x"], ["c"], G),
    "psi": lambda a, b: dr.population_stability_index(a, b, ["x"], group_cols=G),
    "categorical_shift": lambda a, b: dr.categorical_shift(a, b, ["c"], G),
    "drift_table": lambda a, b: dr.drift_table(a.select("g", "x", "c"), b.select("g", "x", "c"), group_cols=G),
    "quantiles": lambda a, b: od.exact_quantiles(a, ["x"], [0.1, 0.5, 0.9], G),
    "uplift_metrics": lambda a, b: up.uplift_metrics(a, "y", "w", "p", "id", G),
    "uplift_curve": lambda a, b: up.uplift_curve(a, "y", "w", "p", "id", G).withColumn("cumulative_gain", F.round("cumulative_gain", 6)),
}


def _rows(df):
    doubles = {c for c, t in df.dtypes if t == "double"}
    out = [tuple(round(v, 9) if c in doubles and v is not None else v for c, v in r.asDict().items()) for r in df.collect()]
    return sorted(out, key=str)


@pytest.mark.parametrize("name", list(OPERATORS))
def test_null_group_equals_a_named_group(spark, table, name):
    f = OPERATORS[name]
    a, b = table.where("id < 400"), table.where("id >= 300")
    cached = spark.sparkContext._jsc.getPersistentRDDs().size()
    got = f(a, b)
    named = f(*(t.withColumn("g", F.coalesce("g", F.lit("zzz"))) for t in (a, b)))
    want = named.withColumn("g", F.nullif("g", F.lit("zzz")))
    rows = _rows(got)
    assert rows == _rows(want)
    assert any(r[got.columns.index("g")] is None for r in rows)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == cached


def test_running_sums_match_a_window(spark, table):
    from pyspark.sql import Window

    got = od.global_rank(table, [F.col("x").asc(), F.col("id").asc()], G, "r", ["y", "x"], num_partitions=7)
    w = Window.partitionBy("g").orderBy("x", "id").rowsBetween(Window.unboundedPreceding, 0)
    want = table.withColumn("r", F.count("*").over(w)).withColumn("y_cum", F.sum("y").over(w)).withColumn("x_cum", F.sum("x").over(w))
    cols = ["id", "g", "r", "y_cum", "x_cum"]
    assert _rows(got.select(*cols)) == _rows(want.select(*cols))


def test_settings_are_the_fixed_ones():
    from sparkexp.operators.models import SETTINGS, UNLIMITED_DEPTH, make_classifier, wants_balanced_weights

    assert SETTINGS["churn"]["forest"] == {"numTrees": 400, "maxDepth": UNLIMITED_DEPTH, "minInstancesPerNode": 2}
    assert SETTINGS["churn"]["boosting"]["maxIter"] == 450 and SETTINGS["churn"]["boosting"]["stepSize"] == 0.05
    assert SETTINGS["uplift"]["forest"]["numTrees"] == 300 and SETTINGS["uplift"]["extra_trees"]["numTrees"] == 350
    assert SETTINGS["uplift"]["boosting"] == {"maxIter": 300, "maxDepth": 5, "stepSize": 0.05, "subsamplingRate": 0.9, "featureSubsetStrategy": "0.9"}
    assert wants_balanced_weights("random_forest", "churn") and not wants_balanced_weights("xgboost", "churn")
    assert not wants_balanced_weights("random_forest", "uplift")
    knn = make_classifier("KNeighborsClassifier")
    assert type(knn).__name__ == "NearestNeighbors" and knn.k == 25
    with pytest.raises(ValueError):
        make_classifier("NoSuchFamily", strict=True)
