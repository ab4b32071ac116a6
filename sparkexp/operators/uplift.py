"""Uplift evaluation and off-policy value.

Rows are ordered by (score desc, id asc) with the distributed ranking of
``ordering.global_rank``; every metric is then a closed-form sum over the
ranked rows, so one aggregate answers AUUC, Qini, top-decile uplift, the
policy comparisons and the whole fraction grid, per experiment group.

With G_i the cumulative incremental gain after i rows and inc_j the
increment of the row at rank j:
  sum_i G_i = sum_j inc_j * (n - j + 1)
  AUUC      = (sum_i G_i - (G_1 + G_n) / 2) / n / n      (trapezoid, x = i/n)
  Qini      = AUUC - G_n * (1 - 1/n^2) / 2 / n
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkexp.operators.joins import join_per_group
from sparkexp.operators.ordering import global_rank

CLIP = 1e-6
DEFAULT_FRACTIONS = (0.10, 0.20, 0.30, 0.40, 0.50)


def _order(score_col: str, id_col: str) -> list[Column]:
    return [F.col(score_col).desc_nulls_last(), F.col(id_col).asc()]


def _join_small(big: DataFrame, small: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    # ``small`` has one row per group (ungrouped: one row); broadcast after a
    # size check instead of shuffling ``big`` on a low-cardinality key
    return join_per_group(big, small, group_cols)


def ranked_increments(
    df: DataFrame,
    outcome_col: str,
    treatment_col: str,
    score_col: str,
    id_col: str,
    group_cols: Sequence[str] = (),
    num_partitions: int | None = None,
) -> DataFrame:
    """Rows with ``rank`` (1 = highest score), group size ``n``, clipped
    treatment share ``p_t`` and the IPW increment ``inc``."""
    base, totals = _units_and_totals(df, outcome_col, treatment_col, score_col, id_col, group_cols)
    ranked = global_rank(base, _order("_score", "_id"), group_cols, "rank", num_partitions=num_partitions)
    return _with_increments(ranked, totals, group_cols)


def _units_and_totals(
    df: DataFrame, outcome_col: str, treatment_col: str, score_col: str, id_col: str, group_cols: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    base = df.select(
        *group_cols,
        F.col(id_col).alias("_id"),
        F.col(score_col).cast("double").alias("_score"),
        F.col(treatment_col).cast("int").alias("_w"),
        F.col(outcome_col).cast("int").alias("_y"),
    )
    totals = base.groupBy(*group_cols).agg(
        F.count(F.lit(1)).alias("n"),
        F.greatest(F.least(F.avg("_w"), F.lit(1 - CLIP)), F.lit(CLIP)).alias("p_t"),
    )
    return base, totals


def _with_increments(units: DataFrame, totals: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    r = _join_small(units, totals, group_cols)
    inc = F.col("_w") * F.col("_y") / F.col("p_t") - (F.lit(1) - F.col("_w")) * F.col("_y") / (F.lit(1.0) - F.col("p_t"))
    return r.withColumn("inc", inc)


def _top_k(frac: float) -> Column:
    return F.greatest(F.lit(1), F.floor(F.lit(float(frac)) * F.col("n")).cast("long"))


def uplift_metrics(
    df: DataFrame,
    outcome_col: str,
    treatment_col: str,
    score_col: str,
    id_col: str,
    group_cols: Sequence[str] = (),
    top_fraction: float = 0.10,
    ranked: DataFrame | None = None,
) -> DataFrame:
    """AUUC, Qini and uplift in the top decile, per group, in one pass. ``ranked``: the
    rows' ``ranked_increments``, where several metrics share them."""
    r = ranked_increments(df, outcome_col, treatment_col, score_col, id_col, group_cols) if ranked is None else ranked
    k = _top_k(top_fraction)
    agg = r.groupBy(*group_cols).agg(
        F.first("n").alias("n"),
        F.sum(F.col("inc") * (F.col("n") - F.col("rank") + 1)).alias("_sum_g"),
        F.sum("inc").alias("_g_n"),
        F.sum(F.when(F.col("rank") == 1, F.col("inc"))).alias("_g_1"),
        F.sum(F.when(F.col("rank") <= k, F.col("inc")).otherwise(0.0)).alias("_top_sum"),
        F.first(k).alias("_k"),
    )
    n = F.col("n").cast("double")
    auuc = F.when(F.col("n") > 1, (F.col("_sum_g") - (F.col("_g_1") + F.col("_g_n")) / 2) / n / n).otherwise(F.lit(0.0))
    qini = auuc - F.when(F.col("n") > 1, F.col("_g_n") * (F.lit(1.0) - F.lit(1.0) / (n * n)) / 2 / n).otherwise(0.0)
    return agg.select(
        *group_cols,
        "n",
        auuc.alias("auuc"),
        qini.alias("qini"),
        (F.col("_top_sum") / F.col("_k")).alias("uplift_at_top_decile"),
    )


def auuc(df: DataFrame, outcome_col: str, treatment_col: str, score_col: str, id_col: str, group_cols: Sequence[str] = ()) -> DataFrame:
    return uplift_metrics(df, outcome_col, treatment_col, score_col, id_col, group_cols).select(*group_cols, "auuc")


def qini(df: DataFrame, outcome_col: str, treatment_col: str, score_col: str, id_col: str, group_cols: Sequence[str] = ()) -> DataFrame:
    return uplift_metrics(df, outcome_col, treatment_col, score_col, id_col, group_cols).select(*group_cols, "qini")


def uplift_at_top_decile(
    df: DataFrame, outcome_col: str, treatment_col: str, score_col: str, id_col: str, group_cols: Sequence[str] = ()
) -> DataFrame:
    return uplift_metrics(df, outcome_col, treatment_col, score_col, id_col, group_cols).select(
        *group_cols, "uplift_at_top_decile"
    )


def uplift_curve(
    df: DataFrame,
    outcome_col: str,
    treatment_col: str,
    score_col: str,
    id_col: str,
    group_cols: Sequence[str] = (),
    points: int | None = None,
) -> DataFrame:
    """Cumulative uplift curve: (population_share, cumulative_gain).

    ``points=None`` gives one row per input row (distributed running sum);
    ``points=m`` gives the curve at ranks ceil(j*n/m), j=1..m, as one aggregate.
    """
    if points is None:
        # The increments need the totals alone, so one sort ranks and sums them.
        base, totals = _units_and_totals(df, outcome_col, treatment_col, score_col, id_col, group_cols)
        cum = global_rank(_with_increments(base, totals, group_cols), _order("_score", "_id"), group_cols, "rank", sum_cols=["inc"])
        return cum.select(
            *group_cols,
            "rank",
            (F.col("rank") / F.col("n")).alias("population_share"),
            F.col("inc_cum").alias("cumulative_gain"),
        )
    r = ranked_increments(df, outcome_col, treatment_col, score_col, id_col, group_cols)
    # bucket = smallest j with rank <= ceil(j*n/m): sums per bucket then a window over m rows
    r = r.withColumn("point", F.ceil(F.col("rank") * F.lit(points) / F.col("n")).cast("int"))
    b = r.groupBy(*group_cols, "point").agg(F.sum("inc").alias("_s"), F.max("rank").alias("rank"), F.first("n").alias("n"))
    w = Window.partitionBy(*group_cols).orderBy("point").rowsBetween(Window.unboundedPreceding, 0)
    return b.select(
        *group_cols,
        "point",
        "rank",
        (F.col("rank") / F.col("n")).alias("population_share"),
        F.sum("_s").over(w).alias("cumulative_gain"),
    )


# ---------------------------------------------------------------- policies

def policy_value_ips(
    df: DataFrame, outcome_col: str, treatment_col: str, policy_col: str, group_cols: Sequence[str] = ()
) -> DataFrame:
    """Mean of pi*w*y/p + (1-pi)*(1-w)*y/(1-p), p = clipped mean of w."""
    w = F.col(treatment_col).cast("double")
    y = F.col(outcome_col).cast("double")
    pi = F.col(policy_col).cast("double")
    agg = df.groupBy(*group_cols).agg(
        F.greatest(F.least(F.avg(w), F.lit(1 - CLIP)), F.lit(CLIP)).alias("_p"),
        F.avg(pi * w * y).alias("_a"),
        F.avg((F.lit(1.0) - pi) * (F.lit(1.0) - w) * y).alias("_b"),
    )
    return agg.select(*group_cols, (F.col("_a") / F.col("_p") + F.col("_b") / (F.lit(1.0) - F.col("_p"))).alias("policy_value"))


def compare_policies(
    df: DataFrame,
    outcome_col: str,
    treatment_col: str,
    score_col: str,
    id_col: str,
    group_cols: Sequence[str] = (),
    conversion_value: float = 120.0,
    top_fraction: float = 0.30,
    ranked: DataFrame | None = None,
) -> DataFrame:
    """No-treatment vs blanket vs top-k targeting, IPW-estimated, one pass (``ranked`` as
    in ``uplift_metrics``).

    (V_targeted - V_none) * n = sum of inc over the top k rows and
    (V_blanket - V_none) * n = sum of inc over all rows.
    """
    r = ranked_increments(df, outcome_col, treatment_col, score_col, id_col, group_cols) if ranked is None else ranked
    k = _top_k(top_fraction)
    agg = r.groupBy(*group_cols).agg(
        F.sum("inc").alias("_blanket"),
        F.sum(F.when(F.col("rank") <= k, F.col("inc")).otherwise(0.0)).alias("_targeted"),
    )
    v = F.lit(float(conversion_value))
    return agg.select(
        *group_cols,
        F.col("_blanket").alias("expected_incremental_conversions_blanket"),
        F.col("_targeted").alias("expected_incremental_conversions_targeted"),
        (F.col("_blanket") * v).alias("expected_incremental_value_blanket"),
        (F.col("_targeted") * v).alias("expected_incremental_value_targeted"),
        F.lit(float(top_fraction)).alias("target_fraction"),
    )


def optimize_policy_fraction(
    df: DataFrame,
    outcome_col: str,
    treatment_col: str,
    score_col: str,
    id_col: str,
    group_cols: Sequence[str] = (),
    conversion_value: float = 120.0,
    fractions: Sequence[float] = DEFAULT_FRACTIONS,
) -> DataFrame:
    """Targeted value for every fraction of the grid, from one pass; sorted by value desc.

    ``is_best`` marks the best fraction per group (ties: smaller fraction first,
    matching a stable sort of the grid).
    """
    r = ranked_increments(df, outcome_col, treatment_col, score_col, id_col, group_cols)
    sums = [
        F.sum(F.when(F.col("rank") <= _top_k(f), F.col("inc")).otherwise(0.0)).alias(f"_f{i}")
        for i, f in enumerate(fractions)
    ]
    agg = r.groupBy(*group_cols).agg(*sums)
    pairs = F.array(
        *[F.struct(F.lit(float(f)).alias("target_fraction"), F.col(f"_f{i}").alias("_c")) for i, f in enumerate(fractions)]
    )
    long = agg.select(*group_cols, F.inline(pairs))
    out = long.select(
        *group_cols,
        "target_fraction",
        (F.col("_c") * F.lit(float(conversion_value))).alias("expected_incremental_value_targeted"),
        F.col("_c").alias("expected_incremental_conversions_targeted"),
    )
    w = Window.partitionBy(*group_cols).orderBy(F.col("expected_incremental_value_targeted").desc(), "target_fraction")
    out = out.withColumn("is_best", F.row_number().over(w) == 1)
    return out.orderBy(*group_cols, F.col("expected_incremental_value_targeted").desc(), "target_fraction")


def arm_brier(
    df: DataFrame,
    outcome_col: str,
    treatment_col: str,
    prob_treated_col: str,
    prob_control_col: str,
    group_cols: Sequence[str] = (),
) -> DataFrame:
    """Mean of the per-arm Brier scores (treated rows scored by the treatment
    model, control rows by the control model), probabilities clipped to
    [1e-6, 1-1e-6]; NULL when an arm is empty."""
    w = F.col(treatment_col).cast("int")
    y = F.col(outcome_col).cast("double")

    def clipped(c: str) -> Column:
        return F.greatest(F.least(F.col(c).cast("double"), F.lit(1 - CLIP)), F.lit(CLIP))

    agg = df.groupBy(*group_cols).agg(
        F.avg(F.when(w == 1, F.pow(clipped(prob_treated_col) - y, 2))).alias("brier_treated"),
        F.avg(F.when(w == 0, F.pow(clipped(prob_control_col) - y, 2))).alias("brier_control"),
    )
    return agg.select(
        *group_cols,
        "brier_treated",
        "brier_control",
        ((F.col("brier_treated") + F.col("brier_control")) / 2).alias("calibration_metric"),
    )


# ---------------------------------------------------------------- bootstrap

def bootstrap_auuc(
    df: DataFrame,
    outcome_col: str,
    treatment_col: str,
    score_col: str,
    id_col: str,
    n_boot: int = 250,
    seed: int = 42,
    group_cols: Sequence[str] = (),
    ranked: DataFrame | None = None,
) -> DataFrame:
    """Bootstrap mean and population std of AUUC (``ranked`` as in ``uplift_metrics``).

    Resampling with replacement is replaced by independent Poisson(1) weights
    per (row, replicate), drawn from a seeded 32-bit integer hash that a SQL
    engine can repeat. A row of weight w occupies w consecutive positions of the
    replicate's order; all sums are exact (see ``bootstrap_replicates``).
    The deviation from multinomial resampling is O(1/sqrt(n)) of the std.
    """
    per = bootstrap_replicates(df, outcome_col, treatment_col, score_col, id_col, n_boot, seed, group_cols, ranked=ranked)
    return per.groupBy(*group_cols).agg(
        F.avg("auuc").alias("cv_metric_mean"),
        F.stddev_pop("auuc").alias("cv_metric_std"),
        F.count(F.lit(1)).alias("n_replicates"),
    )


def _bootstrap_chunk_fn(group_cols: Sequence[str], n_boot: int, seed: int):
    """Per score-ordered chunk of rows: per replicate, total weight, treated
    weight, weighted u / v sums, sums of u / v times the chunk-local copy
    positions, and the first weighted row's u / v."""
    import numpy as np
    import pandas as pd

    from sparkexp.functions.hashing import poisson1_counts_np, rep_salt_np, row_base_np

    salts = rep_salt_np(n_boot)

    def sums(base: np.ndarray, salts: np.ndarray, tuv: np.ndarray) -> list[np.ndarray]:
        drawn = poisson1_counts_np(base, salts)  # replicates x rows
        first = (drawn > 0).argmax(axis=1)
        has = drawn[np.arange(len(drawn)), first] > 0
        W = drawn.astype(np.float64)  # all sums are whole numbers below 2^53
        q = np.cumsum(W, axis=1) - W  # weight of earlier rows in the chunk
        pos = W * (q + (W + 1) / 2.0)  # sum of the copies' positions
        at_copy = pos @ tuv[:, 1:]
        once = W @ tuv
        u1, v1 = (np.where(has, tuv[first, i], np.nan) for i in (1, 2))
        return [W.sum(axis=1), once[:, 0], once[:, 1], once[:, 2], at_copy[:, 0], at_copy[:, 1], u1, v1]

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        base = row_base_np(seed, pdf["_id"].to_numpy(dtype=np.int64))
        t = pdf["_t"].to_numpy(dtype=np.float64)
        y = pdf["_y"].to_numpy(dtype=np.float64)
        tuv = np.stack([t, t * y, (1.0 - t) * y], axis=1)
        parts = [sums(base, salts[i : i + 8], tuv) for i in range(0, n_boot, 8)]  # a few replicates fit the processor's cache
        W, WT, *rest = (np.concatenate(c) for c in zip(*parts, strict=True))
        out = pd.DataFrame(
            {
                "rep": np.arange(n_boot, dtype=np.int32),
                "_first_score": np.full(n_boot, pdf["_score"].iloc[0], dtype=np.float64),
                "_first_id": np.full(n_boot, int(pdf["_id"].iloc[0]), dtype=np.int64),
                "W": W.astype(np.int64),
                "WT": WT.astype(np.int64),
                **dict(zip(["Su", "Sv", "Tu", "Tv", "u1", "v1"], rest, strict=True)),
            }
        )
        for g in reversed(group_cols):
            out.insert(0, g, pdf[g].iloc[0])
        return out

    def fn(batches):
        for pdf in batches:
            if len(pdf) == 0:
                continue
            if group_cols:
                for _, part in pdf.groupby(list(group_cols), sort=False, dropna=False):
                    yield fold(part)
            else:
                yield fold(pdf)

    return fn


def bootstrap_replicates(
    df: DataFrame,
    outcome_col: str,
    treatment_col: str,
    score_col: str,
    id_col: str,
    n_boot: int = 250,
    seed: int = 42,
    group_cols: Sequence[str] = (),
    num_partitions: int | None = None,
    ranked: DataFrame | None = None,
) -> DataFrame:
    """AUUC of every bootstrap replicate (one row per group and replicate).

    Rows are range-partitioned on (group, score desc, id) and sorted inside
    each partition, so every Arrow batch is a contiguous slice of the
    replicate order. A NumPy fold per batch draws the batch's rows x
    replicates Poisson(1) weight matrix from a seeded 32-bit hash of the id
    and turns it into per-replicate sums with prefix sums; only (batch x
    replicate) partial sums are shuffled, never the n x n_boot expanded rows.
    A window over the batches of a replicate (in score order) adds the
    weight of all earlier batches, so the result is exact. ``ranked`` rows
    (``ranked_increments``) are in that order already and are not sorted again.
    """
    from pyspark.sql import types as T

    from sparkexp.operators.ordering import _num_partitions

    if ranked is None:
        base = df.select(
            *group_cols,
            F.col(id_col).cast("long").alias("_id"),
            F.col(score_col).cast("double").alias("_score"),
            F.col(treatment_col).cast("int").alias("_t"),
            F.col(outcome_col).cast("int").alias("_y"),
        )
        n = _num_partitions(df, num_partitions)
        keys = [*[F.col(g).asc_nulls_first() for g in group_cols], *_order("_score", "_id")]
        x = base.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    else:
        x = ranked.select(*group_cols, F.col("_id").cast("long").alias("_id"), "_score", F.col("_w").alias("_t"), "_y")
    gfields = [f for f in df.select(*group_cols).schema.fields]
    schema = T.StructType(
        gfields
        + [
            T.StructField("rep", T.IntegerType()),
            T.StructField("_first_score", T.DoubleType()),
            T.StructField("_first_id", T.LongType()),
            T.StructField("W", T.LongType()),
            T.StructField("WT", T.LongType()),
            T.StructField("Su", T.DoubleType()),
            T.StructField("Sv", T.DoubleType()),
            T.StructField("Tu", T.DoubleType()),
            T.StructField("Tv", T.DoubleType()),
            T.StructField("u1", T.DoubleType()),
            T.StructField("v1", T.DoubleType()),
        ]
    )
    chunks = x.mapInPandas(_bootstrap_chunk_fn(list(group_cols), n_boot, seed), schema)
    rkeys = [*group_cols, "rep"]
    corder = [F.col("_first_score").desc_nulls_last(), F.col("_first_id").asc()]
    wr = Window.partitionBy(*rkeys).orderBy(*corder).rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.withColumn("P", F.coalesce(F.sum("W").over(wr), F.lit(0)))
    # position of the chunk in score order, to find the first weighted row
    chunks = chunks.withColumn("_ck", F.row_number().over(Window.partitionBy(*rkeys).orderBy(*corder)))
    rep = chunks.groupBy(*rkeys).agg(
        F.sum("W").alias("n"),
        F.sum("WT").alias("nt"),
        F.sum("Su").alias("Su"),
        F.sum("Sv").alias("Sv"),
        F.sum(F.col("P") * F.col("Su") + F.col("Tu")).alias("PUu"),
        F.sum(F.col("P") * F.col("Sv") + F.col("Tv")).alias("PUv"),
        F.min_by(F.struct("u1", "v1"), F.when(F.col("u1").isNotNull() & ~F.isnan("u1"), F.col("_ck"))).alias("first"),
    )
    nn = F.col("n").cast("double")
    p = F.greatest(F.least(F.col("nt") / nn, F.lit(1 - CLIP)), F.lit(CLIP))
    a, c = F.lit(1.0) / p, F.lit(1.0) / (F.lit(1.0) - p)
    g_n = F.col("Su") * a - F.col("Sv") * c
    # sum_i G_i = sum over copies inc * (n + 1 - pos)
    sum_g = (nn + 1) * g_n - (F.col("PUu") * a - F.col("PUv") * c)
    g_1 = F.col("first.u1") * a - F.col("first.v1") * c
    auuc_col = F.when(F.col("n") > 1, (sum_g - (g_1 + g_n) / 2) / nn / nn).otherwise(F.lit(0.0))
    return rep.select(*rkeys, auuc_col.alias("auuc"))
