"""Gaussian discriminant analysis (linear and quadratic) from moment
aggregation — ``pyspark.ml`` has neither.

Fit: one aggregate computes, per class, the row count, the sum of the
feature vector and the sum of the upper triangle of its outer product (NumPy
adds them up in each task, so the shuffle carries two rows per partition). The d x d algebra (pooled or per-class covariance,
inverse, log-determinant) runs on the driver on that tiny result. Scoring is
higher-order array functions over ``vector_to_array(features)`` and
constant-folded literal arrays: a dot product for LDA, a quadratic form for
QDA (so the generated code does not grow with d), then the logistic of the log-odds; the output is a
``probability`` vector like the built-in classifiers produce.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkexp.operators.bundle import Bundle


def _class_sums(d: int):
    """Of one task's rows, one row per class: their number, the sum of the vectors and
    the sum of the upper triangles of their outer products (one matrix product a batch)."""
    iu = np.triu_indices(d)

    def sums(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        found: dict = {}
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, d)
            for k in pc.unique(batch.column(0)).to_pylist():
                own = pc.is_null(batch.column(0)) if k is None else pc.fill_null(pc.equal(batch.column(0), k), False)
                part = x[own.to_numpy(zero_copy_only=False)]
                n, s, q = found.get(k, (0, 0.0, 0.0))
                found[k] = (n + len(part), s + part.sum(axis=0), q + part.T @ part)
        for k, (n, s, q) in found.items():
            yield pa.RecordBatch.from_pydict(
                {"_k": pa.array([k], pa.int32()), "n": pa.array([n], pa.int64()), "s": pa.array([s.tolist()], pa.list_(pa.float64())), "q": pa.array([q[iu].tolist()], pa.list_(pa.float64()))}
            )

    return sums


def _moments(df: DataFrame, features_col: str, label_col: str, d: int) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    x = vector_to_array(F.col(features_col))
    base = df.select(F.col(label_col).cast("int").alias("_k"), x.alias("_x"))
    rows = (
        base.mapInArrow(_class_sums(d), "_k int, n long, s array<double>, q array<double>")
        .groupBy("_k")
        .agg(
            F.sum("n").alias("n"),
            Summarizer.sum(array_to_vector("s")).alias("s"),
            Summarizer.sum(array_to_vector("q")).alias("q"),
        )
        .collect()
    )  # one row per class
    iu = np.triu_indices(d)
    out = {}
    for r in rows:
        s = r["s"].toArray().astype(float)
        q = np.zeros((d, d))
        q[iu] = r["q"].toArray()
        q = q + np.triu(q, 1).T
        out[int(r["_k"])] = (float(r["n"]), s, q)
    return out


def _lit_array(v: np.ndarray) -> Column:
    # all-literal arrays are constant-folded into one array literal
    return F.array(*[F.lit(float(x)) for x in v])


def _dot(a: Column, b: Column) -> Column:
    """Dot product of two equal-length double arrays as higher-order
    functions: generated-code size does not depend on their length."""
    return F.aggregate(F.zip_with(a, b, lambda u, v: u * v), F.lit(0.0), lambda acc, t: acc + t)


@dataclass
class GaussianDiscriminantModel(Bundle):
    kind: str
    means: dict[int, np.ndarray]
    precisions: dict[int, np.ndarray]
    log_dets: dict[int, float]
    log_priors: dict[int, float]
    features_col: str = "features"

    def log_odds(self) -> Column:
        arr = vector_to_array(F.col(self.features_col))
        if self.kind == "linear":
            p, m0, m1 = self.precisions[0], self.means[0], self.means[1]
            w = p @ (m1 - m0)
            b = -0.5 * float((m1 + m0) @ w) + self.log_priors[1] - self.log_priors[0]
            return _dot(arr, _lit_array(w)) + F.lit(b)
        terms = []
        for k in (0, 1):
            p, m = self.precisions[k], self.means[k]
            centred = F.zip_with(arr, _lit_array(m), lambda u, v: u - v)
            rows = F.array(*[_lit_array(r) for r in p])
            pc = F.transform(rows, lambda r: _dot(r, centred))  # P (x - m)
            quad = _dot(centred, pc)
            terms.append(F.lit(-0.5 * self.log_dets[k] + self.log_priors[k]) - F.lit(0.5) * quad)
        return terms[1] - terms[0]

    def transform(self, df: DataFrame) -> DataFrame:
        z = F.greatest(F.least(self.log_odds(), F.lit(700.0)), F.lit(-700.0))
        p1 = F.lit(1.0) / (F.lit(1.0) + F.exp(-z))
        return df.withColumn("probability", array_to_vector(F.array(F.lit(1.0) - p1, p1))).withColumn(
            "prediction", (p1 >= 0.5).cast("double")
        )


@dataclass
class GaussianDiscriminant:
    """Estimator: ``kind='linear'`` (pooled covariance) or ``'quadratic'``
    (per-class covariance shrunk towards the identity by ``reg_param``)."""

    kind: str = "linear"
    reg_param: float = 0.0
    features_col: str = "features"
    label_col: str = "label"
    ridge: float = 1e-9

    def fit(self, df: DataFrame) -> GaussianDiscriminantModel:
        first = df.select(F.size(vector_to_array(F.col(self.features_col))).alias("d")).first()
        if first is None:
            raise ValueError("empty training data")
        d = int(first["d"])
        mom = _moments(df, self.features_col, self.label_col, d)
        if set(mom) != {0, 1}:
            raise ValueError("both classes 0 and 1 are required")
        n_tot = sum(v[0] for v in mom.values())
        means, covs, log_priors = {}, {}, {}
        for k, (n, s, q) in mom.items():
            mu = s / n
            means[k] = mu
            # unbiased per-class scatter
            covs[k] = (q - n * np.outer(mu, mu)) / max(n - 1.0, 1.0)
            log_priors[k] = float(np.log(n / n_tot))
        eye = np.eye(d)
        precisions, log_dets = {}, {}
        if self.kind == "linear":
            scatter = sum((mom[k][0] - 1.0) * covs[k] for k in (0, 1))
            pooled = scatter / max(n_tot - 2.0, 1.0) + self.ridge * eye
            prec = np.linalg.pinv(pooled)
            for k in (0, 1):
                precisions[k] = prec
                log_dets[k] = float(np.linalg.slogdet(pooled)[1])
        else:
            for k in (0, 1):
                c = (1.0 - self.reg_param) * covs[k] + self.reg_param * eye + self.ridge * eye
                precisions[k] = np.linalg.pinv(c)
                log_dets[k] = float(np.linalg.slogdet(c)[1])
        return GaussianDiscriminantModel(self.kind, means, precisions, log_dets, log_priors, self.features_col)

    def copy(self, extra=None):  # parity with pyspark.ml estimators
        return GaussianDiscriminant(self.kind, self.reg_param, self.features_col, self.label_col, self.ridge)
