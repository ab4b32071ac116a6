"""k nearest neighbours as a classifier, exact and distributed.

Equal training vectors become one row with a count and a number of positives, so a
vector that a third of all rows share costs one row. A bounded sample of vectors
serves as pivots; every vector belongs to the cell of its nearest pivot. A query
first meets its own cell, which bounds the distance of its k-th neighbour, and then
only those cells that the triangle inequality cannot rule out:

* d(query, pivot) - radius of the cell <= bound, and
* (d(query, pivot)^2 - d(query, own pivot)^2) / (2 d(pivot, own pivot)) <= bound.

Cells meet queries in blocks of bounded size, whatever a cell holds. A block's vectors
are dealt to boxes of some dozens by a tree of cuts; a query looks into its own box,
and then into those that are as near as the k rows found there. A block hands on one
row for a query, with at most k distances and what ties with the last. Nothing is
approximated; pivots and cuts only decide how much is skipped.

Neighbours vote with weight 1 / distance; those at distance 0, if any, vote alone.
Neighbours that tie for the last places share them.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkexp.operators.bundle import Bundle
from sparkexp.operators.extra_trees import _walk
from sparkexp.session import cut_lineage

#: Pivots at most; the table of pivots is what travels to every task.
MAX_PIVOTS = 1024
#: Vectors of a cell and queries that meet in one task.
BLOCK = 50_000
#: Vectors of a block's box, about, pairs that are looked at in one go, and vectors up to
#: which a block has no boxes.
BOX, PAIRS, PLAIN = 64, 1 << 19, 2000

_HIT = pa.schema([("q", pa.list_(pa.float64())), ("reach", pa.float64()), ("d", pa.list_(pa.float64())), ("n", pa.list_(pa.int64())), ("pos", pa.list_(pa.float64()))])
_HIT_DDL = "q array<double>, reach double, d array<double>, n array<long>, pos array<double>"


def _matrix(col, dims: int) -> np.ndarray:
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return np.asarray(col.flatten(), np.float64).reshape(-1, dims)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of all rows, by differences: equal rows are at 0."""
    out = np.zeros((len(a), len(b)))
    for j in range(a.shape[1]):
        out += (a[:, j, None] - b[None, :, j]) ** 2
    return np.sqrt(out)


def _between(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distance of each vector to the one beside it, as in ``_distances``."""
    out = np.zeros(len(a))
    for j in range(a.shape[1]):
        out += (a[:, j] - b[:, j]) ** 2
    return np.sqrt(out)


def _own(pivots: np.ndarray):
    """Cell and distance to its pivot. Of pivots that are as near but for rounding, any is right."""
    square = (pivots**2).sum(axis=1)

    def run(batches):
        for batch in batches:
            x = _matrix(batch.column("x"), pivots.shape[1])
            cell, dist = np.zeros(len(x), np.int32), np.zeros(len(x))
            for a in range(0, len(x), 1000):
                q = x[a : a + 1000]
                cell[a : a + 1000] = own = (square - 2 * (q @ pivots.T)).argmin(axis=1)
                dist[a : a + 1000] = _between(q, pivots[own])
            cols = [*batch.columns, pa.array(cell), pa.array(dist)]
            yield pa.RecordBatch.from_arrays(cols, names=[*batch.schema.names, "cell", "dist"])

    return run


def _others(pivots: np.ndarray, radius: np.ndarray, held: np.ndarray):
    """Cells, other than its own, that may hold a query's neighbours."""
    between = _distances(pivots, pivots)

    def run(batches):
        for batch in batches:
            q = _matrix(batch.column("q"), pivots.shape[1])
            own = batch.column("cell").to_numpy(zero_copy_only=False)
            bound = batch.column("bound").to_numpy(zero_copy_only=False).astype(float)
            row, cell = [], []
            for a in range(0, len(q), 1000):
                d, o, t = _distances(q[a : a + 1000], pivots), own[a : a + 1000], bound[a : a + 1000, None]
                mine = d[np.arange(len(o)), o][:, None]
                apart = between[o]
                with np.errstate(divide="ignore", invalid="ignore"):
                    plane = np.where(apart > 0, (d * d - mine * mine) / (2 * apart), 0)
                # Rounding must not rule a cell out.
                slack = 1e-9 * (1 + d)
                need = held[None, :] & (d - radius[None, :] <= t + slack) & (plane <= t + slack)
                need[np.arange(len(o)), o] = False
                r, c = np.nonzero(need)
                row.append(r + a)
                cell.append(c)
            r = np.concatenate(row) if row else np.zeros(0, np.int64)
            c = np.concatenate(cell) if cell else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("q").take(pa.array(r)), pa.array(c, pa.int32()), batch.column("bound").take(pa.array(r))], names=["q", "cell", "bound"])

    return run


def _cuts(x: np.ndarray, cells: int) -> np.ndarray:
    """Nodes of a tree with at most ``cells`` leaves over the vectors x, a row each:
    feature (-1: leaf), cut and children. The fullest node is cut next, halfway through
    its widest feature."""
    nodes, heap = [[-1.0, 0.0, -1.0, -1.0]], [(-len(x), 0, np.arange(len(x)))]
    leaves = 1
    while heap and leaves < cells:
        size, k, rows = heapq.heappop(heap)
        own = x[rows]
        j = int((own.max(axis=0) - own.min(axis=0)).argmax())
        v = np.sort(own[:, j])
        edges = np.flatnonzero(v[1:] > v[:-1])
        if not len(edges):
            continue  # all alike
        e = edges[np.abs(edges + 1 - len(v) / 2).argmin()]
        cut = float(v[e])
        below = own[:, j] <= cut
        nodes[k] = [float(j), cut, float(len(nodes)), float(len(nodes) + 1)]
        for part in (rows[below], rows[~below]):
            nodes.append([-1.0, 0.0, -1.0, -1.0])
            if len(part) > 1:
                heapq.heappush(heap, (-len(part), len(nodes) - 1, part))
        leaves += 1
    return np.array(nodes)


def _parts(nodes: np.ndarray) -> tuple:
    """Feature, cut and children of the nodes, and the depth of the tree."""
    feature, left, right = (nodes[:, c].astype(np.int64) for c in (0, 2, 3))
    level = np.zeros(len(nodes), np.int64)
    for k in np.flatnonzero(feature >= 0):  # a parent comes before its children
        level[left[k]] = level[right[k]] = level[k] + 1
    return feature, nodes[:, 1], left, right, int(level.max())


class _Boxes:
    """A block's vectors in boxes: their order, and where each leaf's begin and end."""

    def __init__(self, x: np.ndarray, n: np.ndarray):
        nodes = _cuts(x, -(-len(x) // BOX))
        self.feature, self.cut, self.left, self.right, self.depth = _parts(nodes)
        leaf = self.leaf(x)
        self.order = np.argsort(leaf, kind="stable")
        self.begin, self.end = (np.searchsorted(leaf[self.order], np.arange(len(nodes)), s) for s in ("left", "right"))
        self.low, self.high = np.full((len(nodes), x.shape[1]), np.inf), np.full((len(nodes), x.shape[1]), -np.inf)
        self.held = np.zeros(len(nodes), np.int64)
        self.parent = np.full(len(nodes), -1)
        for k in range(len(nodes))[::-1]:  # children come after their parent
            if self.feature[k] < 0:
                own = self.order[self.begin[k] : self.end[k]]
                self.low[k], self.high[k], self.held[k] = x[own].min(axis=0), x[own].max(axis=0), n[own].sum()
            else:
                two = [self.left[k], self.right[k]]
                self.low[k], self.high[k], self.held[k] = self.low[two].min(axis=0), self.high[two].max(axis=0), self.held[two].sum()
                self.parent[two] = k

    def leaf(self, q: np.ndarray) -> np.ndarray:
        return _walk(q, 0, self.feature, self.cut, self.left, self.right, self.depth)

    def near(self, q: np.ndarray, bound: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, leaf) of all leaves that may hold one of a query's k nearest rows within its bound."""
        at, bound, enough = self.leaf(q), bound.copy(), np.full(len(q), np.inf)
        # The far corner of the smallest box around a query's own leaf that holds k rows.
        while len(wait := np.flatnonzero(np.isinf(enough) & (at >= 0))):
            up = at[wait]
            far = np.sqrt((np.maximum(np.abs(q[wait] - self.low[up]), np.abs(q[wait] - self.high[up])) ** 2).sum(axis=1))
            enough[wait] = np.where(self.held[up] >= k, far, np.inf)
            at[wait] = self.parent[up]
        bound = np.minimum(bound, enough)
        row, node, found = np.arange(len(q)), np.zeros(len(q), np.int64), []
        while len(row):
            apart = np.sqrt((np.maximum(np.maximum(self.low[node] - q[row], q[row] - self.high[node]), 0) ** 2).sum(axis=1))
            need = apart <= bound[row] + 1e-9 * (1 + apart)  # rounding must not rule a box out
            row, node = row[need], node[need]
            leaf = self.feature[node] < 0
            found.append((row[leaf], node[leaf]))
            row, node = row[~leaf], node[~leaf]
            row, node = np.concatenate([row, row]), np.concatenate([self.left[node], self.right[node]])
        row, node = (np.concatenate(c) for c in zip(*found, strict=True))
        order = np.argsort(row, kind="stable")
        return row[order], node[order]

    def pairs(self, row: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, vector) of leaves' vectors."""
        size = self.end[node] - self.begin[node]
        place = np.arange(size.sum()) + np.repeat(self.begin[node] - (np.cumsum(size) - size), size)
        return np.repeat(row, size), self.order[place]


def _nearest(k: int, r: np.ndarray, c: np.ndarray, d: np.ndarray, n: np.ndarray, count: int):
    """Of pairs (query r, vector c) at distance d those that make a query's k nearest rows, ties
    included, nearest first; and the distance of its k-th row."""
    order = np.lexsort((d, r))
    r, c, d = r[order], c[order], d[order]
    rows = np.cumsum(n[c])
    first = np.searchsorted(r, np.arange(count))
    before = rows - n[c] - np.concatenate([[0], rows])[first][r]
    full = np.full(count, np.inf)
    makes = np.flatnonzero((before < k) & (before + n[c] >= k))
    full[r[makes]] = d[makes]
    keep = d <= full[r]
    return r[keep], c[keep], d[keep], full


def _meet(k: int, dims: int):
    """Nearest distances of a block's queries, with rows and positives, and the distance
    within which the block has k rows."""

    def run(queries: pa.Table, block: pa.Table) -> pa.Table:
        q, x = _matrix(queries.column("q"), dims), _matrix(block.column("x"), dims)
        if not len(x) or not len(q):
            return _HIT.empty_table()
        bound = queries.column("bound").to_numpy().astype(float)
        n, pos = block.column("n").to_numpy(), block.column("pos").to_numpy()
        who, reach, size, dist, rows, ones = [], [], [], [], [], []

        def hand_on(own, r, c, d):
            r, c, d, full = _nearest(k, r, c, d, n, len(own))
            got = np.bincount(r, minlength=len(own))
            some = np.flatnonzero(got)
            for out, v in ((who, own[some]), (reach, full[some]), (size, got[some]), (dist, d), (rows, n[c]), (ones, pos[c])):
                out.append(v)

        plain = len(x) <= PLAIN
        for a in range(0, len(q) if plain else 0, 256):
            d = _distances(q[a : a + 256], x)
            # Everything up to the k-th vector, its ties and the bound included.
            last = np.partition(d, k - 1, axis=1)[:, k - 1] if len(x) > k else np.full(len(d), np.inf)
            r, c = np.nonzero(d <= np.minimum(last, bound[a : a + 256])[:, None])
            hand_on(np.arange(a, a + len(d)), r, c, d[r, c])
        boxes = None if plain else _Boxes(x, n)
        # Queries of a leaf beside each other, so that those of one go look into the same boxes.
        turn = None if plain else np.argsort(boxes.leaf(q), kind="stable")
        for a in range(0, 0 if plain else len(q), 1000):
            own = turn[a : a + 1000]
            p, limit = q[own], bound[own]
            # First the own leaf alone, whose k-th row bounds the rest.
            r, c = boxes.pairs(np.arange(len(own)), boxes.leaf(p))
            limit = np.minimum(limit, _nearest(k, r, c, _between(p[r], x[c]), n, len(own))[3])
            row, node = boxes.near(p, limit, k)
            pairs = np.cumsum(boxes.end[node] - boxes.begin[node])
            start = 0
            while start < len(row):
                # Whole queries, of so many pairs as fit, at least one.
                stop = int(np.searchsorted(pairs, (pairs[start - 1] if start else 0) + PAIRS, "right"))
                stop = len(row) if stop >= len(row) else int(np.searchsorted(row, row[stop]))
                stop = stop if stop > start else int(np.searchsorted(row, row[start], "right"))
                r, c = boxes.pairs(row[start:stop], node[start:stop])
                d = _between(p[r], x[c])
                inside = d <= limit[r]
                hand_on(own, r[inside], c[inside], d[inside])
                start = stop
        if not who:
            return _HIT.empty_table()
        who, reach, size, dist, rows, ones = (np.concatenate(z) for z in (who, reach, size, dist, rows, ones))
        offsets = pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32))
        taken = queries.column("q").combine_chunks().take(pa.array(who.astype(np.int64)))
        lists = [pa.ListArray.from_arrays(offsets, pa.array(v)) for v in (dist, rows.astype(np.int64), ones.astype(float))]
        return pa.Table.from_arrays([taken, pa.array(reach), *lists], schema=_HIT)

    return run


def _vote(k: int):
    """Probability of class 1 from the (distances, rows, positives) that a query's blocks handed on."""

    def run(batches):
        for batch in batches:
            hits = batch.column("hits")
            blocks = hits.value_lengths().to_numpy(zero_copy_only=False)
            flat = hits.flatten()
            each = flat.field("d").value_lengths().to_numpy(zero_copy_only=False)
            ends = np.concatenate([[0], np.cumsum(each)])[np.cumsum(blocks)]
            d, n, pos = (flat.field(f).flatten().to_numpy(zero_copy_only=False) for f in ("d", "n", "pos"))
            out, a = np.zeros(len(blocks)), 0
            for i, e in enumerate(ends):
                u, at = np.unique(d[a:e], return_inverse=True)
                rows, p = np.bincount(at, n[a:e]), np.bincount(at, pos[a:e])
                taken = np.clip(k - (np.cumsum(rows) - rows), 0, rows)
                w = taken * (u == 0) if u[0] == 0 else taken / u
                out[i] = (w * p / rows).sum() / w.sum()
                a = e
            yield pa.RecordBatch.from_arrays([batch.column("q"), pa.array(out)], names=["q", "p1"])

    return run


@dataclass
class NearestNeighborsModel(Bundle):
    """``cells`` has one row per distinct training vector: x, n, pos, cell, dist."""

    cells: DataFrame
    pivots: np.ndarray
    k: int = 25
    features_col: str = "features"

    def probabilities(self, queries: DataFrame) -> DataFrame:
        """q, p1 for each distinct vector in column q."""
        dims = self.pivots.shape[1]
        stats = self.cells.groupBy("cell").agg(F.max("dist").alias("r"), F.count("*").alias("m")).collect()  # one row per pivot
        radius, held = np.zeros(len(self.pivots)), np.zeros(len(self.pivots), bool)
        for s in stats:
            radius[s["cell"]], held[s["cell"]] = s["r"], True
        sizes = self.cells.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))

        def meet(asked: DataFrame) -> DataFrame:
            asks = asked.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"))
            plan = asks.join(sizes, "cell")
            part = lambda c, n: F.pmod(F.xxhash64(c), F.col(n)).cast("int")
            x = self.cells.select("cell", "x", "n", "pos").join(plan, "cell").withColumn("block", part("x", "blocks"))
            x = x.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select("cell", "block", "part", "x", "n", "pos")
            q = asked.join(plan, "cell").withColumn("part", part("q", "parts"))
            q = q.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("cell", "block", "part", "q", "bound")
            keys = ["cell", "block", "part"]
            return q.groupBy(*keys).cogroup(x.groupBy(*keys)).applyInArrow(_meet(self.k, dims), _HIT_DDL)

        own = queries.withColumnRenamed("q", "x").mapInArrow(_own(self.pivots), "x array<double>, cell int, dist double")
        own = cut_lineage(own.select(F.col("x").alias("q"), "cell", F.lit(float("inf")).alias("bound")))
        first = cut_lineage(meet(own))
        # Distance at which a block of the own cell has k rows; without that, no bound.
        bound = first.groupBy("q").agg(F.min("reach").alias("b")).withColumnRenamed("q", "bq")
        asked = own.drop("bound").join(bound, F.col("q") == F.col("bq"), "left").select("q", "cell", F.coalesce("b", F.lit(float("inf"))).alias("bound"))
        more = cut_lineage(asked.mapInArrow(_others(self.pivots, radius, held), "q array<double>, cell int, bound double"))
        hits = first.union(meet(more)).groupBy("q").agg(F.collect_list(F.struct("d", "n", "pos")).alias("hits"))
        return hits.mapInArrow(_vote(self.k), "q array<double>, p1 double")

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` plus ``probability`` and ``prediction``."""
        x = df.withColumn("_q", vector_to_array(F.col(self.features_col)))
        p = self.probabilities(x.select(F.col("_q").alias("q")).distinct()).withColumnRenamed("q", "_p")
        x = x.join(p, F.col("_q") == F.col("_p"), "left")
        x = x.withColumn("probability", array_to_vector(F.array(F.lit(1.0) - F.col("p1"), F.col("p1"))))
        return x.withColumn("prediction", (F.col("p1") >= 0.5).cast("double")).drop("_q", "_p", "p1")


@dataclass
class NearestNeighbors:
    """Estimator. Fewer than ``k`` training rows: all of them vote."""

    k: int = 25
    features_col: str = "features"
    label_col: str = "label"
    cell_rows: int = 1000
    seed: int = 42

    def fit(self, df: DataFrame) -> NearestNeighborsModel:
        x = df.select(vector_to_array(F.col(self.features_col)).alias("x"), F.col(self.label_col).cast("double").alias("y"))
        x = cut_lineage(x.groupBy("x").agg(F.count("*").alias("n"), F.sum("y").alias("pos")))
        vectors = x.count()
        if not vectors:
            raise ValueError("empty training data")
        # Pivots: the vectors with the smallest hashes, a sample of bounded size.
        some = x.select("x").orderBy(F.xxhash64("x", F.lit(self.seed)), "x").limit(min(MAX_PIVOTS, math.ceil(vectors / self.cell_rows))).collect()
        pivots = np.array([r["x"] for r in some], float)
        cells = cut_lineage(x.mapInArrow(_own(pivots), "x array<double>, n long, pos double, cell int, dist double"))
        return NearestNeighborsModel(cells, pivots, self.k, self.features_col)

    def copy(self, extra=None):
        return NearestNeighbors(self.k, self.features_col, self.label_col, self.cell_rows, self.seed)
