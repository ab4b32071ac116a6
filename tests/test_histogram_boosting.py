"""Second-order boosting against a plain NumPy version that splits one leaf at a time."""

import numpy as np
import pytest

from sparkexp.operators.histogram_boosting import GRAIN, HistogramBoosting
from tests.test_learners import frame, p1


def boost(x, y, rounds, rate, leaves, depth, l2, min_rows):
    """Log odds of every row; all halfway cuts, best leaf first."""
    z = np.full(len(y), np.log(y.mean() / (1 - y.mean())))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-z))
        g, h = np.rint((p - y) * GRAIN) / GRAIN, np.rint(p * (1 - p) * GRAIN) / GRAIN

        def split(rows, level, g=g, h=h):
            best = (1e-9, None)
            if depth and level >= depth:
                return best
            of = lambda r: g[r].sum() ** 2 / (h[r].sum() + l2)
            for j in range(x.shape[1]):
                v = np.unique(x[:, j])
                for c in (v[1:] + v[:-1]) / 2:
                    a, b = rows[x[rows, j] <= c], rows[x[rows, j] > c]
                    if min(len(a), len(b)) < min_rows or min(h[a].sum(), h[b].sum()) < 1e-3:
                        continue
                    gain = of(a) + of(b) - of(rows)
                    if gain > best[0] * (1 + 1e-12):
                        best = (gain, (a, b))
            return best

        everyone = np.arange(len(y))
        tree = [(everyone, 0, *split(everyone, 0))]
        while len(tree) < (leaves or 1 << 20):
            k = max(range(len(tree)), key=lambda i: tree[i][2] if tree[i][3] else -1.0)
            _, level, _, parts = tree[k]
            if parts is None:
                break
            tree[k : k + 1] = [(r, level + 1, *split(r, level + 1)) for r in parts]
        for rows, *_ in tree:
            z[rows] -= rate * g[rows].sum() / (h[rows].sum() + l2)
    return z


@pytest.fixture(scope="module")
def data():
    r = np.random.default_rng(4)
    x = np.round(r.normal(size=(300, 3)), 1)
    y = ((x[:, 0] * x[:, 1] > 0.1) ^ (r.random(300) < 0.1)).astype(float)
    return x, y


@pytest.mark.parametrize(("leaves", "depth", "l2"), [(6, 0, 0.0), (0, 3, 1.0), (5, 3, 0.5)])
def test_against_numpy(spark, data, leaves, depth, l2):
    x, y = data
    df = frame(spark, x, y)
    m = HistogramBoosting(rounds=4, rate=0.3, max_leaves=leaves, max_depth=depth, l2=l2, min_rows=8, max_bins=100, refresh=3).fit(df)
    got = p1(m, df)
    want = 1 / (1 + np.exp(-boost(x, y, 4, 0.3, leaves, depth, l2, 8)))
    assert np.allclose([got[i] for i in range(300)], want, atol=1e-6)
    for a, b in zip(m.roots.astype(int), [*m.roots[1:].astype(int), len(m.feature)], strict=True):
        assert (m.feature[a:b] < 0).sum() <= (leaves or 8)


def test_repeats_and_learns(spark, data):
    x, y = data
    df = frame(spark, x, y)
    est = HistogramBoosting(rounds=12, rate=0.3, max_leaves=8, min_rows=5, rows_share=0.8, features_share=0.7, seed=3)
    a, b = est.fit(df), est.copy().fit(df.repartition(7))
    assert all(np.array_equal(getattr(a, k), getattr(b, k)) for k in ("feature", "cut", "left", "right", "value", "roots"))
    got = p1(a, df)
    assert np.mean([(got[i] > 0.5) == (y[i] == 1) for i in range(300)]) > 0.85


def test_edges_and_saving(spark, data, tmp_path):
    from sparkexp.operators import models as mo
    from sparkexp.sources import io

    x, y = data
    df = frame(spark, x, y)
    one = HistogramBoosting(rounds=3).fit(frame(spark, x, np.ones(300)))
    assert len(one.roots) == 0 and all(v > 0.999 for v in p1(one, df).values())
    flat = HistogramBoosting(rounds=3).fit(frame(spark, np.zeros((50, 2)), y[:50]))
    assert len(flat.roots) == 0 and np.allclose(list(p1(flat, df).values()), y[:50].mean())
    with pytest.raises(ValueError):
        HistogramBoosting().fit(df.limit(0))
    m = mo.make_classifier("LightGBM", rounds=2).fit(df)
    io.save_model(m, str(tmp_path / "m"), {"threshold": 0.5})
    back, _ = io.load_model(spark, str(tmp_path / "m"))
    assert p1(back, df) == p1(m, df)


def test_settings_reach_the_learner():
    from sparkexp.operators import models as mo

    xgb, lgbm = mo.make_classifier("xgboost", project="churn"), mo.make_classifier("LGBMClassifier")
    assert (xgb.rounds, xgb.max_depth, xgb.max_leaves, xgb.l2, xgb.rows_share, xgb.features_share) == (25, 4, 0, 1.0, 0.9, 0.85)
    assert (lgbm.max_leaves, lgbm.max_depth, lgbm.min_rows, lgbm.l2) == (31, 10, 20, 0.0)
    assert mo.make_classifier("xgboost", maxIter=7, stepSize=0.2, maxDepth=2).rounds == 7
    assert mo.make_classifier("xgboost", project="churn", full=True).rounds == 450
