"""Hand-checked values for the closed-form statistics."""

import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkexp.functions.distributions import chi2_sf, t_two_sided_p
from sparkexp.functions.normal import norm_sf_sql, two_sided_p_sql


def _duck(expr: str, x: float) -> float:
    return duckdb.sql(f"SELECT {expr.replace('X', f'CAST({x!r} AS DOUBLE)')} AS v").fetchall()[0][0]


@pytest.mark.parametrize("x", [-8.0, -3.1, -1.0, 0.0, 0.5, 1.959963984540054, 3.65, 7.5, 12.0, 40.0])
def test_normal_tail_matches_erfc(x):
    want = 0.5 * math.erfc(x / math.sqrt(2))
    got = _duck(norm_sf_sql("X"), x)
    assert got == pytest.approx(want, rel=1e-12, abs=1e-300) if abs(x) < 7 else got == pytest.approx(want, rel=1e-12)


def test_normal_tail_same_in_spark(spark):
    xs = [-2.0, 0.3, 1.7, 9.0]
    df = spark.createDataFrame([(x,) for x in xs], "X double")
    got = [r[0] for r in df.select(F.expr(norm_sf_sql("X"))).collect()]
    for x, g in zip(xs, got):
        assert g == pytest.approx(_duck(norm_sf_sql("X"), x), rel=1e-15)


def test_two_sided_p_of_readme_effect():
    # z = 3.6405 gives the published two-sided p of about 2.7e-4
    assert _duck(two_sided_p_sql("X"), 3.6405) == pytest.approx(2.72e-4, rel=0.01)


def test_t_and_chi2_tails():
    assert t_two_sided_p(2.0, 10) == pytest.approx(0.0733880347, rel=1e-8)
    assert t_two_sided_p(-1.0, 3.5) == pytest.approx(t_two_sided_p(1.0, 3.5))
    assert chi2_sf(3.841458820694124, 1) == pytest.approx(0.05, rel=1e-9)
    assert chi2_sf(10.0, 4) == pytest.approx(0.0404276819945128, rel=1e-9)
    # chi2 with 1 dof equals the two-sided normal tail of sqrt(x)
    assert chi2_sf(2.5, 1) == pytest.approx(math.erfc(math.sqrt(2.5) / math.sqrt(2)), rel=1e-10)


def test_ab_test_hand_case(spark):
    from sparkexp.operators.experiment import ab_test

    rows = [(0, 1)] * 30 + [(0, 0)] * 70 + [(1, 1)] * 45 + [(1, 0)] * 55 + [(None, 1), (1, None)]
    df = spark.createDataFrame(rows, "t int, y int")
    r = ab_test(df, "t", "y").collect()[0]
    assert (r.n_control, r.n_treatment) == (100, 100)
    assert r.absolute_lift == pytest.approx(0.15)
    assert r.relative_lift == pytest.approx(0.5)
    p = 0.375
    z = 0.15 / math.sqrt(p * (1 - p) * (2 / 100))
    assert r.p_value == pytest.approx(math.erfc(z / math.sqrt(2)), rel=1e-9)
    half = 1.959963984540054 * math.sqrt(0.45 * 0.55 / 100 + 0.3 * 0.7 / 100)
    assert r.ci_low == pytest.approx(0.15 - half)
    assert r.ci_high == pytest.approx(0.15 + half)


def test_ab_test_zero_control_rate_and_empty_arm(spark):
    from sparkexp.operators.experiment import ab_test

    df = spark.createDataFrame([(0, 0), (0, 0), (1, 1), (1, 0)], "t int, y int")
    r = ab_test(df, "t", "y").collect()[0]
    assert r.relative_lift is None
    one_arm = spark.createDataFrame([(1, 1), (1, 0)], "t int, y int")
    r = ab_test(one_arm, "t", "y").collect()[0]
    assert r.n_control == 0 and r.control_rate is None and r.p_value is None


def test_encode_treatment_types(spark):
    from sparkexp.functions.scalars import encode_treatment

    df = spark.createDataFrame([(" Test ", True, 1.0), ("control", False, 0.0), ("B", None, None)], "s string, b boolean, f double")
    got = df.select(*[encode_treatment(df, c, ).alias(c) for c in ("s", "b", "f")]).collect()
    assert [tuple(r) for r in got] == [(1, 1, 1), (0, 0, 0), (1, None, None)]


def test_chi_square_yates_only_for_2x2(spark):
    from sparkexp.operators.experiment import chi_square_stats

    rows = [(0, "a")] * 30 + [(0, "b")] * 20 + [(1, "a")] * 20 + [(1, "b")] * 30
    df = spark.createDataFrame(rows, "t int, c string")
    r = chi_square_stats(df, "t", ["c"]).collect()[0]
    # Yates-corrected 2x2: sum (|o-e|-0.5)^2/e with e = 25 everywhere
    assert r.chi2 == pytest.approx(4 * (4.5**2) / 25)
    assert r.dof == 1


def test_power_required_n_matches_normal_formula(spark):
    from sparkexp.operators.experiment import power_check

    ab = spark.createDataFrame([(0.30, 0.05, 1000, 1000)], "control_rate double, absolute_lift double, n_control long, n_treatment long")
    r = power_check(ab).collect()[0]
    h = 2 * math.asin(math.sqrt(0.35)) - 2 * math.asin(math.sqrt(0.30))
    n0 = 2 * ((1.959963984540054 + 0.8416212335729143) / h) ** 2
    assert r.required_n_per_group in (math.ceil(n0), math.ceil(n0) + 1)
    z = 1.959963984540054
    s = h * math.sqrt(1000 * 1.0 / 2.0)
    want = 0.5 * math.erfc((z - s) / math.sqrt(2)) + 0.5 * math.erfc((z + s) / math.sqrt(2))
    assert r.observed_power == pytest.approx(want, rel=1e-9)
    assert r.is_sample_adequate == (1000 >= r.required_n_per_group)


def test_average_precision_and_auc_four_rows(spark):
    from sparkexp.operators.classification import average_precision, roc_auc

    df = spark.createDataFrame([(0, 0.1), (0, 0.4), (1, 0.35), (1, 0.8)], "y int, p double")
    assert average_precision(df, "y", "p").collect()[0][0] == pytest.approx(0.8333333333)
    assert roc_auc(df, "y", "p").collect()[0][0] == pytest.approx(0.75)
    neg = df.withColumn("p", -F.col("p"))
    assert roc_auc(neg, "y", "p").collect()[0][0] == pytest.approx(0.25)
    one_class = spark.createDataFrame([(1, 0.2), (1, 0.3)], "y int, p double")
    assert roc_auc(one_class, "y", "p").collect()[0][0] is None


def test_threshold_sweep_grid_and_inclusive(spark):
    from sparkexp.operators.classification import sweep_thresholds, threshold_sweep

    ts = sweep_thresholds()
    assert len(ts) == 181 and ts[0] == 0.05 and ts[-1] == 0.95
    df = spark.createDataFrame([(1, ts[10]), (0, ts[10] - 1e-12), (1, 0.99), (0, 0.0)], "y int, p double")
    sw = {round(r.threshold, 10): r for r in threshold_sweep(df, "y", "p").collect()}
    r = sw[round(ts[10], 10)]
    assert r.recall == 1.0 and r.precision == 1.0  # p == threshold predicts 1
