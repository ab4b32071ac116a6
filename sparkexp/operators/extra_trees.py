"""Extremely randomised trees; ``pyspark.ml`` has none.

All trees grow together, level by level. For every open node of every tree a few
features are drawn, and for each one cut, uniform over the node's box. One aggregate
over the rows gives the classes left and right of every such cut; the best cut of
each node is picked in the same job, so that what reaches the driver is one row per
open node: the model. A node whose cuts all leave too little on one side draws again,
three times, before it becomes a leaf.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkexp.operators.bundle import Bundle
from sparkexp.session import cut_lineage

DRAWS = 3
_COUNTS = ["l0", "l1", "r0", "r1"]


def _walk(x: np.ndarray, root: int, feature, cut, left, right, depth: int) -> np.ndarray:
    """Node that each row of x reaches."""
    at = np.full(len(x), root)
    flat, start = x.reshape(-1), np.arange(len(x)) * x.shape[1]
    for _ in range(depth):
        j = feature[at]
        inner = j >= 0
        if not inner.any():
            break
        below = flat[start + np.maximum(j, 0)] <= cut[at]
        at = np.where(inner, np.where(below, left[at], right[at]), at)
    return at


@dataclass
class ExtraTreesModel(Bundle):
    """Nodes of all trees in one numbering: feature (-1: leaf), cut, children and the
    probability of class 1; ``roots`` has each tree's first."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    p1: np.ndarray
    roots: np.ndarray
    depth: int
    features_col: str = "features"

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` plus ``probability``, the mean of the trees', and ``prediction``."""
        ints = [np.asarray(a, np.int64) for a in (self.feature, self.left, self.right, self.roots)]
        sent = df.sparkSession.sparkContext.broadcast((*ints, self.cut, self.p1, self.depth))

        @F.pandas_udf(T.DoubleType())
        def score(rows: pd.Series) -> pd.Series:
            feature, left, right, roots, cut, p1, depth = sent.value
            x = np.array(rows.tolist(), float).reshape(len(rows), -1)
            total = np.zeros(len(x))
            for root in roots:
                total += p1[_walk(x, root, feature, cut, left, right, depth)]
            return pd.Series(total / len(roots))

        d = df.withColumn("_p1", score(vector_to_array(F.col(self.features_col))))
        d = d.withColumn("probability", array_to_vector(F.array(F.lit(1.0) - F.col("_p1"), F.col("_p1"))))
        return d.withColumn("prediction", (F.col("_p1") > 0.5).cast("double")).drop("_p1")


@dataclass
class ExtraTrees:
    """``balanced`` weighs the classes alike."""

    trees: int = 100
    max_depth: int = 10
    min_rows: int = 3
    balanced: bool = False
    seed: int = 42
    features_col: str = "features"
    label_col: str = "label"

    def fit(self, df: DataFrame) -> ExtraTreesModel:
        x = vector_to_array(F.col(self.features_col))
        rows = cut_lineage(df.select(x.alias("x"), F.col(self.label_col).cast("int").alias("y")))
        box = rows.select(F.posexplode("x").alias("j", "v")).groupBy("j").agg(F.min("v").alias("lo"), F.max("v").alias("hi")).orderBy("j").collect()  # one row per feature
        if not box:
            raise ValueError("empty training data")
        lo, hi = np.array([b["lo"] for b in box]), np.array([b["hi"] for b in box])
        d, tries = len(box), max(1, int(np.sqrt(len(box))))
        n = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}  # two rows
        n0, n1 = n.get(0, 0), n.get(1, 0)
        weight = ((n0 + n1) / (2 * max(n0, 1)), (n0 + n1) / (2 * max(n1, 1))) if self.balanced else (1.0, 1.0)
        p = lambda a, b: b * weight[1] / max(a * weight[0] + b * weight[1], 1e-300)

        feature, cut, left, right, p1 = ([v] * self.trees for v in (-1, 0.0, -1, -1, p(n0, n1)))
        boxes = {t: (lo, hi) for t in range(self.trees)}
        rng = np.random.default_rng(self.seed)
        # Open nodes: (node, draws left).
        open_ = [(t, DRAWS) for t in range(self.trees)] if n0 and n1 and n0 + n1 >= 2 * self.min_rows else []
        level = {t: 0 for t in range(self.trees)}
        tree_of = list(range(self.trees))
        while open_:
            at = np.array([k for k, _ in open_])
            drawn = np.stack([rng.permutation(d)[:tries] for _ in open_])
            a = np.stack([boxes[k][0][drawn[i]] for i, k in enumerate(at)])
            b = np.stack([boxes[k][1][drawn[i]] for i, k in enumerate(at)])
            cuts = a + rng.random(a.shape) * (b - a)
            arrays = (np.array(feature), np.array(cut), np.array(left), np.array(right))
            found = self._best(rows, arrays, at, np.array(tree_of)[at], drawn, cuts, max(level.values()) + 1, weight)
            after = []
            for i, (k, draws) in enumerate(open_):
                best = found.get(i)
                if best is None:
                    if draws > 1:
                        after.append((k, draws - 1))
                    continue
                f, (l0, l1, r0, r1) = best
                j, c = int(drawn[i, f]), float(cuts[i, f])
                feature[k], cut[k] = j, c
                for side, (c0, c1) in ((0, (l0, l1)), (1, (r0, r1))):
                    child = len(feature)
                    feature.append(-1)
                    cut.append(0.0)
                    left.append(-1)
                    right.append(-1)
                    p1.append(p(c0, c1))
                    (left if side == 0 else right)[k] = child
                    level[child] = level[k] + 1
                    tree_of.append(tree_of[k])
                    if c0 and c1 and c0 + c1 >= 2 * self.min_rows and level[child] < self.max_depth:
                        edge_lo, edge_hi = boxes[k][0].copy(), boxes[k][1].copy()
                        (edge_hi if side == 0 else edge_lo)[j] = c
                        boxes[child] = (edge_lo, edge_hi)
                        after.append((child, DRAWS))
            open_ = after
        whole = lambda v: np.array(v, float)
        return ExtraTreesModel(whole(feature), whole(cut), whole(left), whole(right), whole(p1), np.arange(self.trees, dtype=float), int(max(level.values())), self.features_col)

    def _best(self, rows: DataFrame, arrays, at, tree_of, drawn, cuts, depth: int, weight) -> dict[int, tuple[int, tuple]]:
        """Place in ``drawn`` and the four class counts of each open node's best cut."""
        # Each tree that has open nodes, with its open nodes' slots.
        open_slots = {int(t): np.flatnonzero(tree_of == t) for t in np.unique(tree_of)}
        place = np.full(len(arrays[0]), -1)  # of an open node among its tree's
        for own in open_slots.values():
            place[at[own]] = np.arange(len(own))
        sent = rows.sparkSession.sparkContext.broadcast((arrays, place, open_slots, drawn, cuts))

        def count(batches):
            (feature, cut, left, right), place, open_slots, drawn, cuts = sent.value
            tries = drawn.shape[1]
            sums = np.zeros((len(drawn), tries, 4), np.int64)
            for batch in batches:
                col = batch.column("x")
                x = np.asarray(col.flatten(), float).reshape(len(col), -1)
                flat, start = x.reshape(-1), np.arange(len(x)) * x.shape[1]
                y = batch.column("y").to_numpy(zero_copy_only=False)
                for t, own in open_slots.items():
                    k = place[_walk(x, t, feature, cut, left, right, depth)]
                    live = np.flatnonzero(k >= 0)
                    k, at_row, label = k[live], start[live], y[live]
                    for f in range(tries):
                        side = flat[at_row + drawn[own, f][k]] > cuts[own, f][k]
                        sums[own, f] += np.bincount(k * 4 + side * 2 + label, minlength=4 * len(own)).reshape(-1, 4)
            sums = sums.reshape(-1, 4)
            k = np.flatnonzero(sums.sum(axis=1))
            cols = [pa.array((k // tries).astype(np.int32)), pa.array((k % tries).astype(np.int32)), *[pa.array(sums[k, i]) for i in range(4)]]
            yield pa.RecordBatch.from_arrays(cols, names=["slot", "f", *_COUNTS])

        c = rows.mapInArrow(count, "slot int, f int, l0 long, l1 long, r0 long, r1 long").groupBy("slot", "f").agg(*[F.sum(k).alias(k) for k in _COUNTS])
        gini = lambda a, b: (a * weight[0] + b * weight[1]) - (F.pow(a * weight[0], 2) + F.pow(b * weight[1], 2)) / (a * weight[0] + b * weight[1])
        ok = (F.col("l0") + F.col("l1") >= self.min_rows) & (F.col("r0") + F.col("r1") >= self.min_rows)
        c = c.where(ok).withColumn("bad", gini(F.col("l0"), F.col("l1")) + gini(F.col("r0"), F.col("r1")))
        best = c.groupBy("slot").agg(F.min(F.struct("bad", "f", *_COUNTS)).alias("m")).select("slot", "m.*").toArrow().to_pylist()  # one row per open node
        sent.unpersist()
        return {r["slot"]: (r["f"], tuple(r[k] for k in _COUNTS)) for r in best}

    def copy(self, extra=None):
        return ExtraTrees(self.trees, self.max_depth, self.min_rows, self.balanced, self.seed, self.features_col, self.label_col)
