"""Classifier evaluation: confusion matrix, business cost, threshold sweep,
average precision, ROC AUC, Brier score, balanced accuracy and F1.

Score-ordered metrics (AP, AUC) aggregate to one row per distinct score first
(partial aggregation collapses hot scores before the shuffle), then take
running totals over the distinct scores with the distributed ranking of
``ordering.global_rank``. The threshold sweep buckets every row once against
the 181 thresholds and needs suffix sums over at most 182 rows.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkexp.operators.joins import join_keys, join_per_group
from sparkexp.operators.ordering import global_rank

FP_COST = 65.0
FN_COST = 320.0


def sweep_thresholds(start: float = 0.05, stop: float = 0.95, num: int = 181) -> list[float]:
    """The threshold grid, generated exactly as ``numpy.linspace`` does."""
    return [float(x) for x in np.linspace(start, stop, num)]


def confusion_matrix(
    df: DataFrame, label_col: str, prob_col: str, threshold: float = 0.5, group_cols: Sequence[str] = ()
) -> DataFrame:
    """tn, fp, fn, tp of ``prob >= threshold`` against labels {0, 1}."""
    y = F.col(label_col).cast("int")
    pred = (F.col(prob_col) >= F.lit(float(threshold))).cast("int")
    return df.groupBy(*group_cols).agg(
        F.count_if((y == 0) & (pred == 0)).alias("tn"),
        F.count_if((y == 0) & (pred == 1)).alias("fp"),
        F.count_if((y == 1) & (pred == 0)).alias("fn"),
        F.count_if((y == 1) & (pred == 1)).alias("tp"),
    )


def cost_per_1000(fp: Column, fn: Column, n: Column, fp_cost: float = FP_COST, fn_cost: float = FN_COST) -> Column:
    return (fp * F.lit(fp_cost) + fn * F.lit(fn_cost)) / F.greatest(n, F.lit(1)) * F.lit(1000.0)


def classification_report(
    df: DataFrame,
    label_col: str,
    prob_col: str,
    threshold: float = 0.5,
    group_cols: Sequence[str] = (),
    fp_cost: float = FP_COST,
    fn_cost: float = FN_COST,
) -> DataFrame:
    """Confusion counts plus business cost per 1000, precision, recall,
    balanced accuracy, F1 and accuracy at one threshold."""
    cm = confusion_matrix(df, label_col, prob_col, threshold, group_cols)
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    n = tn + fp + fn + tp
    tpr = tp / F.nullif(tp + fn, F.lit(0))
    tnr = tn / F.nullif(tn + fp, F.lit(0))
    return cm.select(
        *group_cols,
        "tn",
        "fp",
        "fn",
        "tp",
        cost_per_1000(fp, fn, n, fp_cost, fn_cost).alias("expected_cost_per_1000"),
        (tp / F.greatest(tp + fp, F.lit(1))).alias("precision"),
        (tp / F.greatest(tp + fn, F.lit(1))).alias("recall"),
        ((F.coalesce(tpr, tnr) + F.coalesce(tnr, tpr)) / 2).alias("balanced_accuracy"),
        F.coalesce(F.lit(2.0) * tp / F.nullif(F.lit(2) * tp + fp + fn, F.lit(0)), F.lit(0.0)).alias("f1"),
        ((tp + tn) / F.nullif(n, F.lit(0))).alias("accuracy"),
    )


def business_cost_per_1000(
    df: DataFrame, label_col: str, prob_col: str, threshold: float = 0.5, group_cols: Sequence[str] = (),
    fp_cost: float = FP_COST, fn_cost: float = FN_COST,
) -> DataFrame:
    r = classification_report(df, label_col, prob_col, threshold, group_cols, fp_cost, fn_cost)
    return r.select(*group_cols, "expected_cost_per_1000")


def _bucket_index(p: Column, thresholds: list[float]) -> Column:
    """Number of thresholds <= p, in O(1) per row for an even grid: an
    arithmetic guess, corrected by exact comparisons with the literal grid."""
    m = len(thresholds)
    start, step = thresholds[0], (thresholds[-1] - thresholds[0]) / (m - 1)
    arr = F.array(*[F.lit(t) for t in thresholds])
    # guess = count of thresholds <= p, clamped to [0, m]
    g = F.least(F.greatest(F.floor((p - F.lit(start)) / F.lit(step)) + 1, F.lit(0)), F.lit(m)).cast("int")

    def thr(i: Column) -> Column:  # 0-based element
        return F.element_at(arr, i + 1)

    up = F.when((g < m) & (p >= thr(g)), g + 1).otherwise(g)
    down = F.when((up > 0) & (p < thr(up - 1)), up - 1).otherwise(up)
    return down


def threshold_sweep(
    df: DataFrame,
    label_col: str,
    prob_col: str,
    group_cols: Sequence[str] = (),
    thresholds: Sequence[float] | None = None,
    fp_cost: float = FP_COST,
    fn_cost: float = FN_COST,
) -> DataFrame:
    """Cost, precision and recall at every threshold of the grid (``prob >=
    t`` predicts 1), plus ``is_best``: lowest cost, then highest recall, then
    the lowest threshold.

    Each row is bucketed once by how many thresholds it clears; counts per
    bucket (<= 182 rows per group) give every threshold by suffix sums.
    """
    ts = list(thresholds) if thresholds is not None else sweep_thresholds()
    spark = df.sparkSession
    d = df.where(F.col(prob_col).isNotNull()).select(
        *group_cols,
        F.col(label_col).cast("int").alias("_y"),
        _bucket_index(F.col(prob_col).cast("double"), ts).alias("_b"),
    )
    buckets = d.groupBy(*group_cols, "_b").agg(F.count(F.lit(1)).alias("_c"), F.sum("_y").alias("_p"))
    totals = buckets.groupBy(*group_cols).agg(F.sum("_c").alias("_n"), F.sum("_p").alias("_pos"))
    grid = spark.createDataFrame([(i, t) for i, t in enumerate(ts)], "t_index int, threshold double")
    # rows predicted 1 at threshold i are the buckets with _b >= i + 1
    keyed = buckets.crossJoin(F.broadcast(grid)).where(F.col("_b") >= F.col("t_index") + 1)
    pos = keyed.groupBy(*group_cols, "t_index").agg(F.sum("_c").alias("_pp"), F.sum("_p").alias("_tp"))
    base = totals.crossJoin(F.broadcast(grid))
    j = join_keys(base, pos, [*group_cols, "t_index"], "left")
    pp = F.coalesce(F.col("_pp"), F.lit(0))
    tp = F.coalesce(F.col("_tp"), F.lit(0))
    fp = pp - tp
    fn = F.col("_pos") - tp
    out = j.select(
        *group_cols,
        "threshold",
        cost_per_1000(fp, fn, F.col("_n"), fp_cost, fn_cost).alias("expected_cost_per_1000"),
        (tp / F.greatest(pp, F.lit(1))).alias("precision"),
        (tp / F.greatest(F.col("_pos"), F.lit(1))).alias("recall"),
    )
    w = Window.partitionBy(*group_cols).orderBy(
        F.col("expected_cost_per_1000").asc(), F.col("recall").desc(), F.col("threshold").asc()
    )
    return out.withColumn("is_best", F.row_number().over(w) == 1)


def best_threshold(sweep: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    return sweep.where("is_best").select(*group_cols, "threshold")


def _score_table(df: DataFrame, label_col: str, prob_col: str, group_cols: Sequence[str]) -> DataFrame:
    """One row per (group, distinct score): rows and positives."""
    return (
        df.where(F.col(prob_col).isNotNull() & F.col(label_col).isNotNull())
        .select(*group_cols, F.col(prob_col).cast("double").alias("_s"), F.col(label_col).cast("int").alias("_y"))
        .groupBy(*group_cols, "_s")
        .agg(F.count(F.lit(1)).alias("_c"), F.sum("_y").cast("long").alias("_p"))
        .withColumn("_neg", F.col("_c") - F.col("_p"))
    )


def average_precision(df: DataFrame, label_col: str, prob_col: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """AP = sum over distinct scores (desc) of (R_k - R_{k-1}) * P_k.
    NULL when there are no positives."""
    t = _score_table(df, label_col, prob_col, group_cols)
    cum = global_rank(t, [F.col("_s").desc()], group_cols, "_k", sum_cols=["_c", "_p"])
    return cum.groupBy(*group_cols).agg(
        (F.sum(F.col("_p") * (F.col("_p_cum") / F.col("_c_cum"))) / F.nullif(F.sum("_p"), F.lit(0))).alias(
            "average_precision"
        )
    )


def roc_auc(df: DataFrame, label_col: str, prob_col: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """Tie-aware ROC AUC: P(score_pos > score_neg) + P(=)/2. NULL when a class is absent."""
    t = _score_table(df, label_col, prob_col, group_cols)
    cum = global_rank(t, [F.col("_s").asc()], group_cols, "_k", sum_cols=["_neg"])
    # negatives strictly below this score = cumulative negatives - this score's negatives
    below = F.col("_neg_cum") - F.col("_neg")
    agg = cum.groupBy(*group_cols).agg(
        F.sum(F.col("_p") * (below + F.col("_neg") * 0.5)).alias("_num"),
        F.sum("_p").alias("_P"),
        F.sum("_neg").alias("_N"),
    )
    return agg.select(
        *group_cols,
        (F.col("_num") / F.nullif(F.col("_P") * F.col("_N"), F.lit(0))).alias("roc_auc"),
    )


def brier_score(df: DataFrame, label_col: str, prob_col: str, group_cols: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*group_cols).agg(
        F.avg(F.pow(F.col(prob_col).cast("double") - F.col(label_col).cast("double"), 2)).alias("brier_score")
    )


def evaluate_classifier(
    valid: DataFrame,
    test: DataFrame,
    label_col: str,
    prob_col: str,
    group_cols: Sequence[str] = (),
    fp_cost: float = FP_COST,
    fn_cost: float = FN_COST,
) -> DataFrame:
    """Threshold chosen on ``valid`` by the cost sweep, metrics on ``test``:
    cost per 1000, PR-AUC (AP), ROC AUC, Brier, balanced accuracy, F1."""
    thr = best_threshold(threshold_sweep(valid, label_col, prob_col, group_cols, None, fp_cost, fn_cost), group_cols)
    t = join_per_group(test, thr, group_cols)
    pred = (F.col(prob_col) >= F.col("threshold")).cast("int")
    y = F.col(label_col).cast("int")
    cm = t.groupBy(*group_cols).agg(
        F.first("threshold").alias("threshold"),
        F.count_if((y == 0) & (pred == 0)).alias("tn"),
        F.count_if((y == 0) & (pred == 1)).alias("fp"),
        F.count_if((y == 1) & (pred == 0)).alias("fn"),
        F.count_if((y == 1) & (pred == 1)).alias("tp"),
    )
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    tpr = tp / F.nullif(tp + fn, F.lit(0))
    tnr = tn / F.nullif(tn + fp, F.lit(0))
    cm = cm.select(
        *group_cols,
        "threshold",
        cost_per_1000(fp, fn, tn + fp + fn + tp, fp_cost, fn_cost).alias("expected_cost_per_1000"),
        ((F.coalesce(tpr, tnr) + F.coalesce(tnr, tpr)) / 2).alias("balanced_accuracy"),
        F.coalesce(F.lit(2.0) * tp / F.nullif(F.lit(2) * tp + fp + fn, F.lit(0)), F.lit(0.0)).alias("f1"),
    )
    ap = average_precision(test, label_col, prob_col, group_cols)
    auc = roc_auc(test, label_col, prob_col, group_cols)
    br = brier_score(test, label_col, prob_col, group_cols)
    out = cm
    for part in (ap, auc, br):
        out = join_keys(out, part, group_cols)
    return out
