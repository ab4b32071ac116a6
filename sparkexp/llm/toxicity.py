"""Toxicity by a factorization machine over hashed terms.

A text's terms are its lower-cased words (runs of letters) and the first four
letters of each, hashed to ``DIMS`` places; presence counts, not frequency. The
score is the logistic of

    b + sum_i w_i + sum_{i<j} <v_i, v_j>

over the terms present. The pairwise part learns what no sum of weights can say,
such as an insult that counts only next to the mention of a group. Terms enter if
their presence is associated with the label; linear weights then follow
FTRL-proximal and factors AdaGrad with a group penalty, which drive the rest to
exact zero, so that a long clean text does not add up to a high score.

The machine is fitted on a bounded sample of labelled rows (``max_rows``), picked
by a hash; every document is scored. The model that travels to the tasks has at
most ``DIMS`` rows of ``FACTORS`` + 1 numbers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkexp.llm.text import or_empty
from sparkexp.session import cut_lineage

DIMS = 1 << 20
FACTORS = 4
STEM = 4


def terms(text: Column) -> Column:
    """Distinct places of a text's words and stems; empty for NULL and empty text."""
    words = F.array_distinct(F.regexp_extract_all(F.lower(or_empty(text)), F.lit(r"\p{L}+"), F.lit(0)))
    place = lambda *c: F.pmod(F.xxhash64(*c), F.lit(DIMS)).cast("int")
    own = F.transform(words, lambda w: place(w))
    stem = F.transform(words, lambda w: place(F.lit("stem"), F.substring(w, 1, STEM)))
    return F.array_distinct(F.concat(own, stem))


def prior(pos: float, neg: float) -> float:
    """Log-odds of the label alone; one in ten before any row is seen."""
    return float(np.log((pos + 0.5) / (neg + 4.5)))


def _sums(which: np.ndarray, x: np.ndarray, n: int) -> np.ndarray:
    """Column sums of x by group."""
    return np.stack([np.bincount(which, x[:, f], n) for f in range(x.shape[1])], axis=1)


class FactorizationMachine:
    """Bias, linear weights and factors. ``fit`` is reproducible: same rows in the
    same order, same model."""

    def __init__(self, dims: int = DIMS, factors: int = FACTORS, seed: int = 7):
        self.b = 0.0
        self.w = np.zeros(dims)
        self.v = np.zeros((dims, factors))
        self.seed = seed

    def raw(self, which: np.ndarray, term: np.ndarray, n: int) -> np.ndarray:
        """Log-odds of n texts; term[i] is a place of text which[i]."""
        v = self.v[term]
        s = _sums(which, v, n)
        pairs = (s * s).sum(axis=1) - np.bincount(which, (v * v).sum(axis=1), n)
        return self.b + np.bincount(which, self.w[term], n) + 0.5 * pairs

    def fit(
        self, sizes: np.ndarray, term: np.ndarray, y: np.ndarray, steps: int = 3000, batch: int = 128, alpha: float = 0.5, l1: float = 0.5, l2: float = 0.1,
        rate: float = 0.1, group: float = 0.001, least: int = 3,
    ) -> FactorizationMachine:
        """Minibatches over texts in the order given. Only terms of ``least`` texts
        or more have factors."""
        r = np.random.default_rng(self.seed)
        dims = len(self.w)
        df = np.bincount(term, minlength=dims)
        open_ = df >= least
        self.v[open_] = r.normal(0, 0.05, (int(open_.sum()), self.v.shape[1]))
        z, n2, nv, nb = np.zeros(dims), np.zeros(dims), np.full(self.v.shape, 1e-2), 1.0
        off = np.concatenate([[0], np.cumsum(sizes)])
        if len(y):
            self.b = prior(y.sum(), len(y) - y.sum())
        for _ in range(-(-steps * batch // max(len(y), 1))):
            for a in range(0, len(y), batch):
                e = min(a + batch, len(y))
                t = term[off[a] : off[e]]
                which = np.repeat(np.arange(e - a), sizes[a:e])
                own, at = np.unique(t, return_inverse=True)
                v = self.v[own]
                s = _sums(which, v[at], e - a)
                pairs = (s * s).sum(axis=1) - np.bincount(which, (v * v).sum(axis=1)[at], e - a)
                x = self.b + np.bincount(which, self.w[own][at], e - a) + 0.5 * pairs
                g = 1 / (1 + np.exp(-np.clip(x, -30, 30))) - y[a:e]
                # Factors.
                gt = np.bincount(at, g[which], len(own))
                gv = _sums(at, (g[:, None] * s)[which], len(own)) - v * gt[:, None]
                nv[own] += gv * gv
                v = v - rate / np.sqrt(nv[own]) * gv
                norm = np.sqrt((v * v).sum(axis=1))
                v *= np.maximum(0, 1 - group / np.maximum(norm, 1e-12))[:, None]
                self.v[own] = np.where(open_[own][:, None], v, 0)
                # Linear weights.
                sigma = (np.sqrt(n2[own] + gt * gt) - np.sqrt(n2[own])) / alpha
                z[own] += gt - sigma * self.w[own]
                n2[own] += gt * gt
                zo = z[own]
                self.w[own] = np.where(np.abs(zo) <= l1, 0, -(zo - np.sign(zo) * l1) / ((1 + np.sqrt(n2[own])) / alpha + l2))
                gb = g.sum()
                nb += gb * gb
                self.b -= alpha / np.sqrt(nb) * gb
        return self


def _places(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Sizes and values of a list column."""
    return np.asarray(col.value_lengths().to_numpy(zero_copy_only=False), np.int64), np.asarray(col.flatten().to_numpy(zero_copy_only=False), np.int64)


def association(term: np.ndarray, y: np.ndarray, sizes: np.ndarray, dims: int) -> np.ndarray:
    """Log-likelihood ratio of each place's presence and the label."""
    n, pos = float(len(y)), float(y.sum())
    of = np.repeat(y, sizes)
    c, c1 = np.bincount(term, minlength=dims).astype(float), np.bincount(term, weights=of, minlength=dims)

    def part(seen, expected):
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1e-9) / np.maximum(expected, 1e-9)), 0)

    neg = n - pos
    return 2 * (part(c1, c * pos / n) + part(c - c1, c * neg / n) + part(pos - c1, (n - c) * pos / n) + part(neg - c + c1, (n - c) * neg / n))


def fit_rows(sizes: np.ndarray, term: np.ndarray, y: np.ndarray, least_association: float = 20.0, **settings):
    """(bias, places, weights, factors) fitted on texts given by their terms. Only
    places that tell the labels apart by ``least_association`` enter."""
    if not len(y) or y.min() == y.max():
        return prior(y.sum(), len(y) - y.sum()), np.zeros(0, np.int64), np.zeros(0), np.zeros((0, FACTORS))
    known = association(term, y, sizes, DIMS) >= least_association
    used = np.flatnonzero(known)
    slot = np.cumsum(known) - 1
    which = np.repeat(np.arange(len(y)), sizes)[known[term]]
    m = FactorizationMachine(len(used)).fit(np.bincount(which, minlength=len(y)), slot[term[known[term]]], y, **settings)
    some = (m.w != 0) | (m.v != 0).any(axis=1)
    return m.b, used[some], m.w[some], m.v[some]


def _fit(batches):
    """The model's rows from the sample, which one task holds."""
    size, term, y = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
    for b in batches:
        s, t = _places(b.column("t"))
        size.append(s)
        term.append(t)
        y.append(b.column("y").to_numpy(zero_copy_only=False).astype(float))
    bias, used, w, v = fit_rows(np.concatenate(size), np.concatenate(term), np.concatenate(y))
    yield pa.RecordBatch.from_arrays(
        [pa.array([-1, *used], pa.int64()), pa.array([bias, *w], pa.float64()), pa.array([np.zeros(FACTORS), *v], pa.list_(pa.float64()))], names=["place", "w", "v"]
    )


def _share(n: int, max_rows: int, by: Column) -> Column:
    return F.pmod(by, F.lit(1 << 20)) < int(min(1.0, max_rows / max(n, 1)) * (1 << 20))


def fit_model(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_rows: int = 30_000) -> DataFrame:
    """place, w, v of a factorization machine (place -1: the bias).

    Fitted on a sample of about ``max_rows`` labelled documents, picked by a hash of
    id and text, which one task holds. An id's label is the largest it has; NULL
    labels and ids count for nothing. With one label alone the bias is all there is;
    without rows the model has that of ``prior`` or no row at all, which scores the
    same.
    """
    i, t = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    y = labels.where(F.col(f"`{label_col}`").isNotNull() & i.isNotNull()).groupBy(i.alias("y_id")).agg(F.max((F.col(f"`{label_col}`") > 0).cast("int")).alias("y"))
    y = y.where(_share(y.count(), max_rows, F.xxhash64("y_id")))
    # At most about max_rows ids: small enough to be sent to every task.
    rows = docs.select(i.alias("id"), t.alias("text")).join(F.broadcast(y), F.col("id") == F.col("y_id"))
    order = F.xxhash64(F.col("id"), or_empty(F.col("text")))
    part = rows.where(_share(rows.count(), max_rows, order)).select(order.alias("o"), "y", terms(F.col("text")).alias("t"))
    return cut_lineage(part.repartition(1).sortWithinPartitions("o", "y").mapInArrow(_fit, "place long, w double, v array<double>"))


def score(docs: DataFrame, model: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns in ``keep`` (default: all) and ``toxicity``, from 0 to 1. NULL and
    empty texts get the score of a text without terms; equal texts score alike."""
    rows = model.orderBy("place").collect()  # at most DIMS + 1 rows
    parts = (rows[0]["w"] if rows else prior(0, 0), np.array([r["place"] for r in rows[1:]], np.int64), np.array([r["w"] for r in rows[1:]]),
             np.array([r["v"] for r in rows[1:]]).reshape(-1, FACTORS))
    sent = docs.sparkSession.sparkContext.broadcast(parts)
    keep = docs.columns if keep is None else keep
    cols = [f"`{c}`" for c in keep]
    d = docs.select(F.struct(*cols).alias("row"), terms(F.col(f"`{text_col}`")).alias("t"))

    def run(batches):
        m = FactorizationMachine(0)
        m.b, used, m.w, m.v = sent.value
        slot = np.full(DIMS, -1)
        slot[used] = np.arange(len(used))
        for b in batches:
            s, t = _places(b.column("t"))
            k = slot[t]
            x = m.raw(np.repeat(np.arange(len(s)), s)[k >= 0], k[k >= 0], len(s))
            p = 1 / (1 + np.exp(-np.clip(x, -30, 30)))
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(p)], names=["row", "toxicity"])

    kinds = ", ".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in docs.select(*cols).schema.fields)
    out = d.mapInArrow(run, f"row struct<{kinds}>, toxicity double")
    return out.select(*[F.col(f"row.{c}") for c in cols], "toxicity")
