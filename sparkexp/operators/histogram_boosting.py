"""Second-order boosting of histogram trees, grown leaf by leaf; ``pyspark.ml`` has
only first-order boosting, level by level.

Rows are binned once and kept some thousands to a record, a byte a feature (features
with few bins share one, so that one count serves them all). A job sums gradient, hessian and rows of each
(node, feature, bin) for the left children of all nodes whose split is known; right
children are what is left of their parents. Leaves join the tree best gain first until
``max_leaves``; as a node's histogram does not depend on that order, one job works on
all nodes of a generation, also those that may not be taken, and a tree costs about as
many jobs as it has levels. Gradients are whole multiples of 2^-20, so their sums, and
with them the trees, do not depend on how rows are partitioned. Rows and their scores are cached,
and each tree is walked for its scores once, by the next tree's first job. A table of at
most ``own_rows`` rows goes to one task, which grows the same trees. What reaches
the driver is one row per (node, bin), bounded by the tree and not by the data.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkexp.operators.boosting import cut_points
from sparkexp.operators.bundle import Bundle
from sparkexp.operators.extra_trees import _walk
from sparkexp.session import cut_lineage

GRAIN = float(1 << 20)
#: Smaller tables get fewer tasks, of so many rows.
TASK_ROWS = 50_000
DEEPEST = 64
#: Features share a byte while their bins together make so many values at most.
PACKED = 64
_SUMS = ["g", "h", "n"]
#: Of a block of rows: codes of bins, labels, hashes of the content and scores; number of rows, and of labels 0 and 1.
_BLOCK = "b binary, y binary, u binary, s binary, n long, zeros long, ones long"


def _logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


@dataclass
class HistogramBoostingModel(Bundle):
    """Nodes of all trees in one numbering: feature (-1: leaf), cut, children and the
    leaf's part of the log odds; ``roots`` has each tree's first, ``base`` the log odds
    before any tree."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    base: float
    depth: int
    features_col: str = "features"

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` plus ``probability`` and ``prediction``."""
        ints = [np.asarray(a, np.int64) for a in (self.feature, self.left, self.right, self.roots)]
        sent = df.sparkSession.sparkContext.broadcast((*ints, self.cut, self.value, self.base, self.depth))

        @F.pandas_udf(T.DoubleType())
        def score(rows: pd.Series) -> pd.Series:
            feature, left, right, roots, cut, value, base, depth = sent.value
            x = np.array(rows.tolist(), float).reshape(len(rows), -1)
            z = np.full(len(x), base)
            for root in roots:
                z += value[_walk(x, root, feature, cut, left, right, depth)]
            return pd.Series(_logistic(z))

        d = df.withColumn("_p1", score(vector_to_array(F.col(self.features_col))))
        d = d.withColumn("probability", array_to_vector(F.array(F.lit(1.0) - F.col("_p1"), F.col("_p1"))))
        return d.withColumn("prediction", (F.col("_p1") > 0.5).cast("double")).drop("_p1")


class _Tree:
    """A tree while it grows: each node's sums, histogram (none where it cannot be
    split), best split and, once counted, children."""

    def __init__(self):
        self.total, self.hist, self.split, self.level = [], [], [], []
        self.feature, self.bin, self.left, self.right = [], [], [], []

    def add(self, total: np.ndarray, level: int) -> int:
        self.total.append(total)
        self.hist.append(None)
        self.split.append(None)
        self.level.append(level)
        for a, v in ((self.feature, -1), (self.bin, 0), (self.left, -1), (self.right, -1)):
            a.append(v)
        return len(self.total) - 1

    def arrays(self):
        return tuple(np.array(a, np.int64) for a in (self.feature, self.bin, self.left, self.right))


@dataclass
class HistogramBoosting:
    """``rounds`` trees at learning rate ``rate``. A tree has ``max_leaves`` leaves and
    ``max_depth`` levels at most (0: no bound of its own; without either, 64 levels).
    ``l2`` is added to hessians; both sides of a split need ``min_hessian`` and
    ``min_rows``. A tree sees ``rows_share`` of the rows, drawn by a hash of their
    content (equal rows are drawn together), and ``features_share`` of the features.
    After every ``refresh`` trees the rows are written with their scores; in between
    they are cached. One task grows all trees of at most ``own_rows`` rows, for which a
    job a level would cost more than its rows.

    Fits on an empty table raise. With one class only, no tree is grown.
    """

    rounds: int = 100
    rate: float = 0.1
    max_leaves: int = 31
    max_depth: int = 0
    l2: float = 0.0
    min_hessian: float = 1e-3
    min_rows: int = 20
    rows_share: float = 1.0
    features_share: float = 1.0
    max_bins: int = 64
    refresh: int = 10
    seed: int = 42
    features_col: str = "features"
    label_col: str = "label"
    own_rows: int = 0

    def fit(self, df: DataFrame) -> HistogramBoostingModel:
        if not 2 <= self.max_bins <= 256:
            raise ValueError("max_bins must be 2 to 256")
        cuts = cut_points(df, self.features_col, self.max_bins)
        if not cuts:
            raise ValueError("empty training data")
        size = np.array([len(c) + 1 for c in cuts])
        packing = _pack(size)
        x = vector_to_array(F.col(self.features_col))
        y = F.col(self.label_col).cast("int")
        rows = cut_lineage(df.select(x.alias("x"), y.alias("y"), F.xxhash64(x, y).alias("u")).mapInArrow(_binned(cuts, packing), _BLOCK))
        got = rows.agg(*[F.sum(c).alias(c) for c in ("n", "zeros", "ones")]).first()
        if got["n"] != got["zeros"] + got["ones"]:
            raise ValueError("labels must be 0 and 1")
        n = {y: got[c] for y, c in enumerate(("zeros", "ones")) if got[c]}
        share = np.clip(n.get(1, 0) / sum(n.values()), 1e-12, 1 - 1e-12)
        base = float(np.log(share / (1 - share)))
        if sum(n.values()) <= self.own_rows:
            return self._model(self._grown_in_one_task(rows, base, packing, size) if len(n) == 2 else [], cuts, base)
        few = -(-sum(n.values()) // TASK_ROWS)
        if few < rows.rdd.getNumPartitions():
            rows = cut_lineage(rows.coalesce(few))
        rng = np.random.default_rng(self.seed)
        model: list[tuple] = []
        rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
        held = [rows]
        try:
            for t in range(self.rounds if len(n) == 2 else 0):
                drawn = np.sort(rng.permutation(len(cuts))[: max(1, round(self.features_share * len(cuts)))])
                tree = self._grow(drawn, size, lambda tree, slots, at, cells: self._histograms(rows, base, tree.arrays(), max(tree.level), slots, drawn, at, cells, packing, size, t))  # noqa: B023 - used in this round only
                for old in held[:-1]:  # the tree's first job has read it for the last time
                    old.unpersist()
                held = [rows]
                if len(tree[0]) == 1 and self.rows_share == 1 and self.features_share == 1:
                    break  # no split gains, and none will
                model.append(tree)
                if t + 1 < self.rounds:
                    rows = rows.mapInArrow(_advance(tree, packing, size), _BLOCK)
                    if len(model) % self.refresh == 0:
                        rows = cut_lineage(rows)
                    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
                    held.append(rows)
        finally:
            for old in held:
                old.unpersist()
        return self._model(model, cuts, base)

    def _grown_in_one_task(self, rows: DataFrame, base: float, packing: tuple, size: np.ndarray) -> list[tuple]:
        """All trees, grown by one task that holds the rows."""
        fields = ["feature", "bin", "left", "right", "value"]

        def run(batches):
            for t, tree in enumerate(self._trees(_read(batches, len(packing[2])), base, packing, size)):
                cols = [np.full(len(tree[0]), t), np.arange(len(tree[0])), *tree[:5], np.full(len(tree[0]), tree[5])]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["tree", "node", *fields, "levels"])

        schema = "tree long, node long, feature long, bin long, left long, right long, value double, levels long"
        got = rows.coalesce(1).mapInArrow(run, schema).toArrow().sort_by([("tree", "ascending"), ("node", "ascending")])  # one row per node
        cols = [got[f].to_numpy() for f in [*fields, "levels"]]
        edges = np.flatnonzero(np.diff(got["tree"].to_numpy())) + 1
        parts = [np.split(c, edges) for c in cols] if len(got) else []
        return [(*p[:5], int(p[5][0])) for p in zip(*parts, strict=True)]

    def _trees(self, blocks, base: float, packing: tuple, size: np.ndarray):
        """The trees over rows that are all here, one after the other."""
        b, y, u, s = (np.concatenate(c) for c in zip(*blocks, strict=True))
        rng = np.random.default_rng(self.seed)
        for t in range(self.rounds):
            drawn = np.sort(rng.permutation(len(size))[: max(1, round(self.features_share * len(size)))])
            own = _drawn(u, self.seed, t, self.rows_share) if self.rows_share < 1 else np.arange(len(u))
            codes = b[own]
            g, h = _gradients(base + s[own], y[own])
            nodes = np.zeros(len(own), np.int64)

            def count(tree, slots, at, cells):
                nonlocal nodes  # noqa: B023 - of this round
                nodes = _step_codes(codes, *_steps(tree.arrays(), packing, size), nodes)  # noqa: B023 - of this round
                slot = np.full(len(tree.total), -1)
                slot[slots] = np.arange(len(slots))
                sums = np.zeros((3, len(slots) * int(packing[2].sum())))
                _count_codes(sums, slot[nodes], codes, g, h, packing)  # noqa: B023 - of this round
                return list(_of_features(sums, len(slots), drawn, at, cells, packing, size).transpose(1, 2, 0).astype(np.int64))  # noqa: B023 - of this round

            tree = self._grow(drawn, size, count)
            if len(tree[0]) == 1 and self.rows_share == 1 and self.features_share == 1:
                return  # no split gains, and none will
            yield tree
            s = s + tree[4][_walk_codes(b, *_steps(tree, packing, size), tree[5])]

    def _model(self, trees: list[tuple], cuts: list[np.ndarray], base: float) -> HistogramBoostingModel:
        parts: list[list[np.ndarray]] = [[], [], [], [], []]
        roots, at, depth = [], 0, 0
        for feature, bins, left, right, value, levels in trees:
            roots.append(at)
            cut = [cuts[j][k] if j >= 0 else 0.0 for j, k in zip(feature, bins, strict=True)]
            inner = feature >= 0
            for p, a in zip(parts, (feature, cut, np.where(inner, left + at, -1), np.where(inner, right + at, -1), value), strict=True):
                p.append(np.asarray(a, float))
            at, depth = at + len(feature), max(depth, levels)
        return HistogramBoostingModel(*[np.concatenate(p) if p else np.zeros(0) for p in parts], np.array(roots, float), base, int(depth), self.features_col)

    def _grow(self, drawn: np.ndarray, size: np.ndarray, histograms) -> tuple:
        """Feature, bin, left, right and value of a tree's nodes, and its depth;
        ``histograms`` counts the rows of some of its nodes."""
        at = np.zeros(len(size), np.int64)
        at[drawn] = np.cumsum(size[drawn]) - size[drawn]
        cells = int(size[drawn].sum())
        deepest = self.max_depth or DEEPEST
        most = self.max_leaves or 1 << min(deepest, 20)
        tree = _Tree()
        count = lambda slots: histograms(tree, slots, at, cells)
        own = slice(at[drawn[0]], at[drawn[0]] + size[drawn[0]])

        def counted(k: int, hist: np.ndarray) -> None:
            tree.hist[k] = hist
            tree.split[k] = self._best(hist, drawn, at, size)

        tree.add(np.zeros(3, np.int64), 0)
        counted(0, count([0])[0])
        tree.total[0] = tree.hist[0][own].sum(axis=0)
        taken: set[int] = set()
        heap = [(-tree.split[0][0], 0)] if tree.split[0] else []
        while heap and len(taken) + 1 < most:
            k = heap[0][1]
            if tree.feature[k] < 0:
                # The leaves in question first, then children of splits not taken yet.
                leaves = {i for _, i in heap}
                known = [i for i, s in enumerate(tree.split) if s and tree.feature[i] < 0]
                known = sorted(known, key=lambda i: (i not in leaves, -tree.split[i][0], i))[:most]
                for i in known:
                    _, j, tree.bin[i] = tree.split[i]
                    tree.feature[i], level = j, tree.level[i] + 1
                    low = tree.hist[i][at[j] : at[j] + tree.bin[i] + 1].sum(axis=0)
                    tree.left[i], tree.right[i] = tree.add(low, level), tree.add(tree.total[i] - low, level)
                # Nodes at the last level are leaves whatever their histograms.
                open_ = [i for i in known if tree.level[i] + 1 < deepest]
                for i, hist in zip(open_, count([tree.left[i] for i in open_]) if open_ else [], strict=True):
                    counted(tree.left[i], hist)
                    counted(tree.right[i], tree.hist[i] - hist)
                continue
            heapq.heappop(heap)
            taken.add(k)
            for child in (tree.left[k], tree.right[k]):
                if tree.split[child]:
                    heapq.heappush(heap, (-tree.split[child][0], child))
        # Nodes below splits that were not taken go.
        keep = [0] + [c for k in sorted(taken) for c in (tree.left[k], tree.right[k])]
        place = {k: i for i, k in enumerate(keep)}
        total = np.array([tree.total[k] for k in keep]) / GRAIN
        value = -self.rate * total[:, 0] / np.maximum(total[:, 1] + self.l2, 1e-12)
        inner = [k in taken for k in keep]
        pick = lambda a, none: np.array([a[k] if i else none for k, i in zip(keep, inner, strict=True)], np.int64)
        left, right = (np.array([place[a[k]] if i else -1 for k, i in zip(keep, inner, strict=True)], np.int64) for a in (tree.left, tree.right))
        return pick(tree.feature, -1), pick(tree.bin, 0), left, right, value, max(tree.level[k] for k in keep)

    def _best(self, hist: np.ndarray, drawn: np.ndarray, at: np.ndarray, size: np.ndarray):
        """(gain, feature, bin) of the split that gains most, the first of equals, or None."""
        best = None
        for j in drawn:
            own = hist[at[j] : at[j] + size[j]]
            total = own.sum(axis=0)
            left = np.cumsum(own, axis=0)[:-1]
            right = total - left
            gl, hl, gr, hr = left[:, 0] / GRAIN, left[:, 1] / GRAIN, right[:, 0] / GRAIN, right[:, 1] / GRAIN
            ok = (left[:, 2] >= self.min_rows) & (right[:, 2] >= self.min_rows) & (hl >= self.min_hessian) & (hr >= self.min_hessian)
            if not ok.any():
                continue
            g, h = total[0] / GRAIN, total[1] / GRAIN
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(ok, gl**2 / (hl + self.l2) + gr**2 / (hr + self.l2) - g**2 / (h + self.l2), -np.inf)
            k = int(gain.argmax())
            if gain[k] > 1e-9 and (best is None or gain[k] > best[0] * (1 + 1e-12)):
                best = (float(gain[k]), int(j), k)
        return best

    def _histograms(self, rows, base, arrays, depth, slots, drawn, at, cells, packing, size, t) -> list[np.ndarray]:
        """Sums of gradient, hessian and rows per cell, for each node of ``slots``."""
        values = packing[2]
        slot = np.full(len(arrays[0]), -1)
        slot[slots] = np.arange(len(slots))
        sent = rows.sparkSession.sparkContext.broadcast((_steps(arrays, packing, size), slot))
        nodes = len(slots)
        seed, share = self.seed, self.rows_share
        wide = int(values.sum())

        def count(batches):
            steps, slot = sent.value
            sums = np.zeros((3, nodes * wide))
            for b, y, u, s in _read(batches, len(values)):
                if share < 1:
                    own = _drawn(u, seed, t, share)
                    b, y, s = b[own], y[own], s[own]
                k = slot[_walk_codes(b, *steps, depth)]
                live = np.flatnonzero(k >= 0)
                if len(live) < len(k):
                    b, y, s, k = b[live], y[live], s[live], k[live]
                _count_codes(sums, k, b, *_gradients(base + s, y), packing)
            out = _of_features(sums, nodes, drawn, at, cells, packing, size).reshape(3, -1)
            c = np.flatnonzero(out[2])
            yield pa.RecordBatch.from_arrays([pa.array(c), *[pa.array(out[i, c].astype(np.int64)) for i in range(3)]], names=["cell", *_SUMS])

        got = rows.select("b", "y", "u", "s").mapInArrow(count, "cell long, g long, h long, n long").groupBy("cell").agg(*[F.sum(c).alias(c) for c in _SUMS]).toArrow()
        sent.unpersist()
        out = np.zeros((nodes * cells, 3), np.int64)
        out[got["cell"].to_numpy()] = np.stack([got[c].to_numpy() for c in _SUMS], axis=1)
        return list(out.reshape(nodes, cells, 3))

    def copy(self, extra=None):
        return HistogramBoosting(**vars(self))


def _pack(size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features with ``size`` bins dealt to codes of at most ``PACKED`` values (one of
    its own to a feature with more): each feature's code and stride in it, and the
    codes' numbers of values."""
    code, stride, values = [], [], []
    for n in size.tolist():
        c = next((i for i, v in enumerate(values) if v * n <= PACKED), len(values))
        if c == len(values):
            values.append(1)
        code.append(c)
        stride.append(values[c])
        values[c] *= n
    return np.array(code), np.array(stride), np.array(values)


def _gradients(z: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    p = _logistic(z)
    return np.rint((p - y) * GRAIN), np.rint((p * (1 - p)) * GRAIN)


def _count_codes(sums: np.ndarray, k: np.ndarray, b: np.ndarray, g: np.ndarray, h: np.ndarray, packing: tuple) -> None:
    """Adds gradient, hessian and rows of each (slot ``k``, value of a code); rows
    without a slot (-1) are left out."""
    values = packing[2]
    live = np.flatnonzero(k >= 0)
    if len(live) < len(k):
        k, b, g, h = k[live], b[live], g[live], h[live]
    k = k * int(values.sum())
    for c, first in enumerate(np.cumsum(values) - values):
        cell = k + first + b[:, c]
        for i, w in enumerate((g, h, None)):
            sums[i] += np.bincount(cell, w, sums.shape[1])


def _of_features(sums: np.ndarray, nodes: int, drawn: np.ndarray, at: np.ndarray, cells: int, packing: tuple, size: np.ndarray) -> np.ndarray:
    """Sums of codes' values as sums of the drawn features' bins."""
    code, stride, values = packing
    begin = np.cumsum(values) - values
    out = np.zeros((3, nodes, cells))
    sums = sums.reshape(3, nodes, -1)
    for j in drawn:  # the sums of a code's values that hold the feature's bin
        own = sums[:, :, begin[code[j]] : begin[code[j]] + values[code[j]]]
        own = own.reshape(3, nodes, -1, size[j], stride[j]).sum(axis=(2, 4))
        out[:, :, at[j] : at[j] + size[j]] = own
    return out


def _binned(cuts: list[np.ndarray], packing: tuple):
    """Blocks of rows, with scores of 0."""
    code, stride, values = packing

    def run(batches):
        for batch in batches:
            col = batch.column("x")
            x = np.asarray(col.flatten(), float).reshape(-1, len(cuts))
            if not len(x):
                continue
            b = np.zeros((len(x), len(values)), np.int64)
            for j, c in enumerate(cuts):
                b[:, code[j]] += np.searchsorted(c, x[:, j], side="left") * stride[j]
            y, u = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("y", "u"))
            yield _block(b.astype(np.uint8), (y == 1).astype(np.uint8), u, np.zeros(len(x)), len(x), int((y == 0).sum()), int((y == 1).sum()))

    return run


def _block(*values) -> pa.RecordBatch:
    names = [f.split()[0] for f in _BLOCK.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([v], pa.int64()) if isinstance(v, int) else pa.array([v.tobytes()], pa.binary()) for v in values], names=names)


def _read(batches, d: int):
    """Codes, labels, hashes and scores of each block."""
    for batch in batches:
        for cells in zip(*[batch.column(c) for c in "byus"], strict=True):
            b, y, u, s = (np.frombuffer(c.as_buffer(), t) for c, t in zip(cells, (np.uint8, np.uint8, np.int64, float), strict=True))
            yield b.reshape(-1, d), y.astype(np.int64), u, s


def _drawn(u: np.ndarray, seed: int, t: int, share: float) -> np.ndarray:
    """Places of the rows that tree ``t`` sees: Spark's ``xxhash64(u, seed, t)``, which
    drew them while rows were not in blocks, modulo 2^30 is below ``share`` of it."""
    p1, p2, p3, p4, p5 = (np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
    turn = lambda v, k: (v << np.uint64(k)) | (v >> np.uint64(64 - k))

    def mixed(h):
        h = (h ^ (h >> np.uint64(33))) * p2
        h = (h ^ (h >> np.uint64(29))) * p3
        return h ^ (h >> np.uint64(32))

    def of_long(v, h):
        h = (h + p5 + np.uint64(8)) ^ (turn(v * p2, 31) * p1)
        return mixed(turn(h, 27) * p1 + p4)

    def of_int(v, h):
        h = (h + p5 + np.uint64(4)) ^ ((v & np.uint64(0xFFFFFFFF)) * p1)
        return mixed(turn(h, 23) * p2 + p3)

    h = of_long(u.view(np.uint64), np.full(len(u), 42, np.uint64))
    for v in (seed, t):
        h = (of_int if -(1 << 31) <= v < 1 << 31 else of_long)(np.full(len(u), v, np.int64).view(np.uint64), h)
    return np.flatnonzero((h & np.uint64((1 << 30) - 1)) < np.uint64(int(share * (1 << 30))))


def _steps(arrays: tuple, packing: tuple, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per node the code that it looks at, and the next node for each of its values;
    a leaf's is itself."""
    (feature, bins, left, right), (code, stride, values) = arrays[:4], packing
    j = np.maximum(feature, 0)
    bin_ = np.arange(int(values.max())) // stride[j][:, None] % size[j][:, None]
    after = np.where(bin_ <= bins[:, None], left[:, None], right[:, None])
    return code[j], np.where(feature[:, None] >= 0, after, np.arange(len(feature))[:, None])


def _step_codes(b: np.ndarray, code: np.ndarray, after: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Nodes one level below ``at``, or ``at`` where that is a leaf."""
    return after[at, b.reshape(-1)[np.arange(len(b)) * b.shape[1] + code[at]]]


def _walk_codes(b: np.ndarray, code: np.ndarray, after: np.ndarray, depth: int) -> np.ndarray:
    """Node that each row of codes reaches from node 0."""
    at = np.zeros(len(b), np.int64)
    flat, start, width, after = b.reshape(-1), np.arange(len(b)) * b.shape[1], after.shape[1], after.reshape(-1)
    for _ in range(depth):
        at = after[at * width + flat[start + code[at]]]
    return at


def _advance(tree: tuple, packing: tuple, size: np.ndarray):
    """Scores with those of ``tree`` added."""
    steps, value, depth = _steps(tree, packing, size), tree[4], tree[5]

    def run(batches):
        for batch in batches:
            for i, (b, _, _, s) in enumerate(_read([batch], len(packing[2]))):
                score = pa.array([(s + value[_walk_codes(b, *steps, depth)]).tobytes()], pa.binary())
                one = batch.slice(i, 1)
                yield pa.RecordBatch.from_arrays([score if c == "s" else one.column(c) for c in one.schema.names], names=one.schema.names)

    return run
