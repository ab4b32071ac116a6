"""Seeded sampling, stratified splits and stratified folds.

Exact per-stratum counts come from ranking each stratum by a seeded hash of
the row id with the distributed ``global_rank`` (range partitioned on
(stratum, hash, id)), so a stratum holding most of the rows is still spread
over many tasks; ``randomSplit``/``sampleBy`` would only give expected counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkexp.functions.hashing import seeded_uniform
from sparkexp.operators.ordering import global_rank


def sample_n(df: DataFrame, n: int, seed: int = 42, id_col: str = "id") -> DataFrame:
    """Exactly min(n, count) rows without replacement, chosen by seeded hash.
    (The limit is the operator: Spark plans a per-partition top-n.)"""
    order = [seeded_uniform(seed, F.col(id_col)).asc(), F.col(id_col).asc()]
    return df.orderBy(*order).limit(int(n))


def inflate_batch(
    df: DataFrame, n: int, seed: int, id_col: str, column: str, factor: float = 1.10
) -> DataFrame:
    """A drifted batch: ``sample_n`` rows with one numeric column scaled."""
    s = sample_n(df, n, seed, id_col)
    return s.withColumn(column, F.col(column).cast("double") * F.lit(float(factor)))


def _strata_key(strata_cols: Sequence[str]) -> list[str]:
    return list(strata_cols)


def stratified_split(
    df: DataFrame,
    strata_cols: Sequence[str],
    id_col: str,
    test_size: float = 0.20,
    valid_size: float = 0.20,
    seed: int = 42,
    names: tuple[str, str, str] = ("train", "valid", "test"),
    split_col: str = "split",
) -> DataFrame:
    """Two-stage stratified split with exact per-stratum counts.

    Per stratum of size c, in seeded-hash order: the first round(c*test) rows
    are test, the next round((c - n_test) * valid/(1-test)) valid, the rest
    train. Requires 0 < valid, 0 < test and valid + test < 1.
    """
    if valid_size <= 0 or test_size <= 0 or (valid_size + test_size) >= 1:
        raise ValueError("Require 0 < valid_size, test_size and valid_size + test_size < 1.")
    keys = _strata_key(strata_cols)
    h = seeded_uniform(seed, F.col(id_col))
    base = df.withColumn("_h", h)
    j = global_rank(base, [F.col("_h").asc(), F.col(id_col).asc()], keys, "_r", total_col="_c")
    n_test = F.round(F.col("_c") * F.lit(float(test_size)))
    frac = valid_size / (1.0 - test_size)
    n_valid = F.round((F.col("_c") - n_test) * F.lit(float(frac)))
    split = (
        F.when(F.col("_r") <= n_test, F.lit(names[2]))
        .when(F.col("_r") <= n_test + n_valid, F.lit(names[1]))
        .otherwise(F.lit(names[0]))
    )
    return j.withColumn(split_col, split).drop("_h", "_r", "_c")


def stratified_folds(
    df: DataFrame, strata_cols: Sequence[str], id_col: str, k: int = 3, seed: int = 42, fold_col: str = "fold"
) -> DataFrame:
    """Shuffled stratified k-fold assignment: fold = (rank - 1) mod k per stratum."""
    keys = _strata_key(strata_cols)
    base = df.withColumn("_h", seeded_uniform(seed, F.col(id_col)))
    ranked = global_rank(base, [F.col("_h").asc(), F.col(id_col).asc()], keys, "_r")
    return ranked.withColumn(fold_col, ((F.col("_r") - 1) % k).cast("int")).drop("_h", "_r")
