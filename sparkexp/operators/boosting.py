"""Ridge classifier and adaptive boosting of stumps; ``pyspark.ml`` has neither.

Ridge: targets are -1 and 1. One aggregate gives the classes' counts, sums and
outer-product sums, the normal equations are solved on that small result, and rows
are scored by a dot product.

Adaptive boosting (SAMME with two classes): every feature is cut at most
``max_bins`` - 1 places, between distinct values where these are few. A round is one
aggregate over the rows: the weight of each (feature, bin, class). A row's weight
follows from the stumps so far, which travel with the task, so no table of weights
is kept or recomputed. The best stump of the bins' sums joins the ensemble.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkexp.operators.bundle import Bundle
from sparkexp.operators.discriminant import _dot, _lit_array, _moments
from sparkexp.session import cut_lineage


def _with_decision(df: DataFrame, z: Column) -> DataFrame:
    d = df.withColumn("rawPrediction", array_to_vector(F.array(-z, z)))
    return d.withColumn("prediction", (z > 0).cast("double"))


@dataclass
class RidgeModel(Bundle):
    weights: np.ndarray
    intercept: float
    features_col: str = "features"

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` plus ``rawPrediction`` (decision values) and ``prediction``."""
        z = _dot(vector_to_array(F.col(self.features_col)), _lit_array(self.weights)) + F.lit(float(self.intercept))
        return _with_decision(df, z)


@dataclass
class RidgeClassifier:
    """Least squares on -1 and 1 with an L2 penalty ``alpha`` on the weights, not on
    the intercept."""

    alpha: float = 1.0
    features_col: str = "features"
    label_col: str = "label"

    def fit(self, df: DataFrame) -> RidgeModel:
        first = df.select(F.size(vector_to_array(F.col(self.features_col))).alias("d")).first()
        if first is None:
            raise ValueError("empty training data")
        mom = _moments(df, self.features_col, self.label_col, int(first["d"]))
        if not set(mom) <= {0, 1}:
            raise ValueError("labels must be 0 and 1")
        sign = {0: -1.0, 1: 1.0}
        n = sum(v[0] for v in mom.values())
        mean = sum(v[1] for v in mom.values()) / n
        y = sum(sign[k] * v[0] for k, v in mom.items()) / n
        xx = sum(v[2] for v in mom.values()) - n * np.outer(mean, mean)
        xy = sum(sign[k] * v[1] for k, v in mom.items()) - n * mean * y
        w = np.linalg.solve(xx + self.alpha * np.eye(len(mean)), xy)
        return RidgeModel(w, float(y - mean @ w), self.features_col)

    def copy(self, extra=None):
        return RidgeClassifier(self.alpha, self.features_col, self.label_col)


# ---------------------------------------------------------------- boosting

def cut_points(df: DataFrame, features_col: str, max_bins: int = 64) -> list[np.ndarray]:
    """Per feature, ascending places to cut at: halfway between neighbouring values,
    of which approximate quantiles stand for more than ``max_bins``."""
    x = df.select(F.posexplode(vector_to_array(F.col(features_col))).alias("j", "v"))
    few = x.groupBy("j", "v").agg(F.lit(1)).groupBy("j").agg(F.count("*").alias("n"), F.approx_percentile("v", [k / max_bins for k in range(max_bins + 1)], 10 * max_bins).alias("q"))
    rows = {r["j"]: r for r in few.collect()}  # one row per feature
    small = [j for j, r in rows.items() if r["n"] <= max_bins]
    # At most max_bins values for each of these features.
    own = {r["j"]: r["v"] for r in x.where(F.col("j").isin(small)).groupBy("j").agg(F.sort_array(F.collect_set("v")).alias("v")).collect()} if small else {}
    out = []
    for j in sorted(rows):
        v = np.unique(np.array(own.get(j, rows[j]["q"]), float))
        out.append((v[1:] + v[:-1]) / 2)
    return out


@dataclass
class AdaBoostModel(Bundle):
    """Stumps: feature, cut, and the vote (-alpha or alpha) at or below and above it."""

    feature: np.ndarray
    cut: np.ndarray
    low: np.ndarray
    high: np.ndarray
    features_col: str = "features"

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` plus ``probability``, the logistic of twice the mean vote, and
        ``prediction``; equal votes are class 0."""
        x = vector_to_array(F.col(self.features_col))
        stumps = F.array(*[
            F.struct(F.lit(int(j)).alias("j"), F.lit(float(c)).alias("c"), F.lit(float(a)).alias("a"), F.lit(float(b)).alias("b"))
            for j, c, a, b in zip(self.feature, self.cut, self.low, self.high, strict=True)
        ])
        total = float(np.abs(self.low).sum()) or 1.0
        z = F.aggregate(stumps, F.lit(0.0), lambda s, t: s + F.when(F.get(x, t["j"]) <= t["c"], t["a"]).otherwise(t["b"])) / total
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-2.0 * z))
        d = df.withColumn("probability", array_to_vector(F.array(F.lit(1.0) - p, p)))
        return d.withColumn("prediction", (z > 0).cast("double"))


@dataclass
class AdaBoost:
    """``rounds`` stumps at learning rate ``rate``; ends early when a stump errs on
    nothing or on half the weight."""

    rounds: int = 50
    rate: float = 1.0
    max_bins: int = 64
    features_col: str = "features"
    label_col: str = "label"

    def fit(self, df: DataFrame) -> AdaBoostModel:
        cuts = cut_points(df, self.features_col, self.max_bins)
        if not cuts:
            raise ValueError("empty training data")
        d = len(cuts)
        x = vector_to_array(F.col(self.features_col))
        rows = cut_lineage(df.select(x.alias("x"), F.col(self.label_col).cast("int").alias("y")).mapInArrow(_binned(cuts), "b binary, y int"))
        size = np.array([len(c) + 1 for c in cuts])
        at = np.cumsum(size) - size
        model: list[tuple] = []  # feature, bin, class at or below, class above, alpha
        for _ in range(self.rounds):
            sums = rows.mapInArrow(_weigh(model, at, int(size.sum()), d), "cell int, w double").groupBy("cell").agg(F.sum("w").alias("w")).collect()
            w = np.zeros(2 * int(size.sum()))  # one row per (feature, bin, class)
            for r in sums:
                w[r["cell"]] = r["w"]
            stump = _best_stump(w.reshape(-1, 2), at, size)
            if stump is None:
                break
            j, b, low, high, err = stump
            if err >= 0.5 and model:
                break
            alpha = self.rate * float(np.log(max(1 - err, 1e-10) / max(err, 1e-10)))
            model.append((j, b, low, high, alpha))
            if err <= 1e-10 or err >= 0.5:
                break
        vote = lambda k: np.array([m[4] * (1.0 if m[k] else -1.0) for m in model])
        return AdaBoostModel(np.array([m[0] for m in model], float), np.array([cuts[m[0]][m[1]] for m in model]), vote(2), vote(3), self.features_col)

    def copy(self, extra=None):
        return AdaBoost(self.rounds, self.rate, self.max_bins, self.features_col, self.label_col)


def _binned(cuts: list[np.ndarray]):
    """Each row's bins, one byte a feature."""

    def run(batches):
        for batch in batches:
            col = batch.column("x")
            x = np.asarray(col.flatten(), float).reshape(-1, len(cuts))
            b = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in b], pa.binary()), batch.column("y")], names=["b", "y"])

    return run


def _weigh(model: list[tuple], at: np.ndarray, cells: int, d: int):
    """Weight of each (feature, bin, class) over a task's rows. A row weighs
    exp(sum of alpha over the stumps that miss it)."""

    def run(batches):
        w = np.zeros(2 * cells)
        for batch in batches:
            b = np.frombuffer(b"".join(batch.column("b").to_pylist()), np.uint8).reshape(-1, d)
            y = batch.column("y").to_numpy(zero_copy_only=False)
            log = np.zeros(len(y))
            for j, k, low, high, alpha in model:
                log += alpha * (np.where(b[:, j] <= k, low, high) != y)
            weight = np.exp(log)
            for j in range(d):
                w += np.bincount(2 * (at[j] + b[:, j].astype(np.int64)) + y, weight, 2 * cells)
        k = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays([pa.array(k.astype(np.int32)), pa.array(w[k])], names=["cell", "w"])

    return run


def _best_stump(w: np.ndarray, at: np.ndarray, size: np.ndarray):
    """(feature, bin, class at or below, class above, weighted error) of the cut with
    the smallest Gini impurity; the first of equals."""
    best = None
    for j in range(len(size)):
        own = w[at[j] : at[j] + size[j]]
        total = own.sum(axis=0)
        left = np.cumsum(own, axis=0)[:-1]
        right = total - left
        a, b = left.sum(axis=1), right.sum(axis=1)
        ok = (a > 0) & (b > 0)
        if not ok.any():
            continue
        with np.errstate(divide="ignore", invalid="ignore"):
            gini = np.where(ok, (a - (left**2).sum(axis=1) / a) + (b - (right**2).sum(axis=1) / b), np.inf)
        k = int(gini.argmin())
        if best is None or gini[k] < best[0] * (1 - 1e-12):
            low, high = int(left[k, 1] > left[k, 0]), int(right[k, 1] > right[k, 0])
            err = (left[k, 1 - low] + right[k, 1 - high]) / total.sum()
            best = (gini[k], j, k, low, high, float(err))
    return None if best is None else best[1:]
