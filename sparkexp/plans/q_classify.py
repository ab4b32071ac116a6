"""Registered classifier-metric queries (lineitem as a scored table:
y = returned, prob = quantity / 51; heavy score ties)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkexp.operators import classification as cl
from sparkexp.plans.registry import register
from sparkexp.plans.tables import SCORED_LINEITEM_SQL, scored_lineitem


def _report_sql(threshold: float, group: str | None) -> str:
    gsel = f"{group}, " if group else ""
    gby = f"GROUP BY {group}" if group else ""
    return f"""
WITH s AS ({SCORED_LINEITEM_SQL}),
c AS (SELECT {gsel}
             count_if(y = 0 AND prob < {threshold}) AS tn, count_if(y = 0 AND prob >= {threshold}) AS fp,
             count_if(y = 1 AND prob < {threshold}) AS fn, count_if(y = 1 AND prob >= {threshold}) AS tp
      FROM s {gby})
SELECT {gsel} tn, fp, fn, tp,
       (fp * 65.0 + fn * 320.0) / greatest(tn + fp + fn + tp, 1) * 1000.0 AS expected_cost_per_1000,
       tp / CAST(greatest(tp + fp, 1) AS DOUBLE) AS precision,
       tp / CAST(greatest(tp + fn, 1) AS DOUBLE) AS recall,
       (coalesce(tp / CAST(NULLIF(tp + fn, 0) AS DOUBLE), tn / CAST(NULLIF(tn + fp, 0) AS DOUBLE))
        + coalesce(tn / CAST(NULLIF(tn + fp, 0) AS DOUBLE), tp / CAST(NULLIF(tp + fn, 0) AS DOUBLE))) / 2 AS balanced_accuracy,
       coalesce(2.0 * tp / NULLIF(2 * tp + fp + fn, 0), 0.0) AS f1,
       (tp + tn) / CAST(NULLIF(tn + fp + fn + tp, 0) AS DOUBLE) AS accuracy
FROM c
"""


REPORT_DOUBLES = ["expected_cost_per_1000", "precision", "recall", "balanced_accuracy", "f1", "accuracy"]


@register("confusion_matrix", f"SELECT l_linestatus, tn, fp, fn, tp FROM ({_report_sql(0.5, 'l_linestatus')}) AS r")
def q_confusion(spark, sf_dir):
    return cl.confusion_matrix(scored_lineitem(spark, sf_dir), "y", "prob", 0.5, ["l_linestatus"])


@register(
    "business_cost_per_1000",
    f"SELECT expected_cost_per_1000 FROM ({_report_sql(0.3, None)}) AS r",
    ["expected_cost_per_1000"],
)
def q_cost(spark, sf_dir):
    return cl.business_cost_per_1000(scored_lineitem(spark, sf_dir), "y", "prob", 0.3)


@register("classification_report", _report_sql(0.5, "l_linestatus"), REPORT_DOUBLES)
def q_report(spark, sf_dir):
    return cl.classification_report(scored_lineitem(spark, sf_dir), "y", "prob", 0.5, ["l_linestatus"])


@register(
    "balanced_accuracy",
    f"SELECT balanced_accuracy, f1 FROM ({_report_sql(0.45, None)}) AS r",
    ["balanced_accuracy", "f1"],
)
def q_balacc(spark, sf_dir):
    return cl.classification_report(scored_lineitem(spark, sf_dir), "y", "prob", 0.45).select("balanced_accuracy", "f1")


def _sweep_sql(group: str | None) -> str:
    ts = cl.sweep_thresholds()
    values = ", ".join(f"({i}, {t!r})" for i, t in enumerate(ts))
    gsel = f"{group}, " if group else ""
    gby = f", {group}" if group else ""
    part = f"PARTITION BY {group}" if group else ""
    return f"""
WITH s AS (SELECT * FROM ({SCORED_LINEITEM_SQL}) AS x WHERE prob IS NOT NULL),
g AS (SELECT * FROM (VALUES {values}) AS t(t_index, threshold)),
c AS (SELECT {gsel} threshold,
             count(*) AS n, sum(y) AS pos,
             count_if(prob >= threshold) AS pp,
             count_if(prob >= threshold AND y = 1) AS tp
      FROM s CROSS JOIN g GROUP BY threshold{gby}),
m AS (SELECT {gsel} threshold,
             ((pp - tp) * 65.0 + (pos - tp) * 320.0) / greatest(n, 1) * 1000.0 AS expected_cost_per_1000,
             tp / CAST(greatest(pp, 1) AS DOUBLE) AS precision,
             tp / CAST(greatest(pos, 1) AS DOUBLE) AS recall
      FROM c)
SELECT *, row_number() OVER ({part} ORDER BY expected_cost_per_1000, recall DESC, threshold) = 1 AS is_best FROM m
"""


SWEEP_DOUBLES = ["threshold", "expected_cost_per_1000", "precision", "recall"]


@register("threshold_sweep", _sweep_sql(None), SWEEP_DOUBLES)
def q_sweep(spark, sf_dir):
    return cl.threshold_sweep(scored_lineitem(spark, sf_dir), "y", "prob")


@register("threshold_sweep_grouped", _sweep_sql("l_linestatus"), SWEEP_DOUBLES)
def q_sweep_grouped(spark, sf_dir):
    return cl.threshold_sweep(scored_lineitem(spark, sf_dir), "y", "prob", ["l_linestatus"])


def _ap_sql(group: str | None) -> str:
    gsel = f"{group}, " if group else ""
    gby = f"GROUP BY {group}" if group else ""
    part = f"PARTITION BY {group}" if group else ""
    return f"""
WITH s AS (SELECT {gsel} prob AS sc, count(*) AS c, sum(y) AS p
           FROM ({SCORED_LINEITEM_SQL}) AS x WHERE prob IS NOT NULL AND y IS NOT NULL GROUP BY {gsel} prob),
k AS (SELECT *, sum(c) OVER ({part} ORDER BY sc DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cc,
                sum(p) OVER ({part} ORDER BY sc DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pc FROM s)
SELECT {gsel} sum(p * (pc / CAST(cc AS DOUBLE))) / NULLIF(sum(p), 0) AS average_precision FROM k {gby}
"""


@register("average_precision", _ap_sql(None), ["average_precision"])
def q_ap(spark, sf_dir):
    return cl.average_precision(scored_lineitem(spark, sf_dir), "y", "prob")


@register("average_precision_grouped", _ap_sql("l_linestatus"), ["average_precision"])
def q_ap_grouped(spark, sf_dir):
    return cl.average_precision(scored_lineitem(spark, sf_dir), "y", "prob", ["l_linestatus"])


def _auc_sql(group: str | None) -> str:
    gsel = f"{group}, " if group else ""
    gby = f"GROUP BY {group}" if group else ""
    part = f"PARTITION BY {group}" if group else ""
    return f"""
WITH s AS (SELECT {gsel} prob AS sc, sum(y) AS p, count(*) - sum(y) AS ng
           FROM ({SCORED_LINEITEM_SQL}) AS x WHERE prob IS NOT NULL AND y IS NOT NULL GROUP BY {gsel} prob),
k AS (SELECT *, sum(ng) OVER ({part} ORDER BY sc ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - ng AS below FROM s)
SELECT {gsel} sum(p * (below + ng * 0.5)) / NULLIF(CAST(sum(p) AS DOUBLE) * sum(ng), 0) AS roc_auc FROM k {gby}
"""


@register("roc_auc", _auc_sql(None), ["roc_auc"])
def q_auc(spark, sf_dir):
    return cl.roc_auc(scored_lineitem(spark, sf_dir), "y", "prob")


@register("roc_auc_grouped", _auc_sql("l_linestatus"), ["roc_auc"])
def q_auc_grouped(spark, sf_dir):
    return cl.roc_auc(scored_lineitem(spark, sf_dir), "y", "prob", ["l_linestatus"])


@register(
    "brier_score",
    f"SELECT l_linestatus, avg(power(prob - y, 2)) AS brier_score FROM ({SCORED_LINEITEM_SQL}) AS s GROUP BY l_linestatus",
    ["brier_score"],
)
def q_brier(spark, sf_dir):
    return cl.brier_score(scored_lineitem(spark, sf_dir), "y", "prob", ["l_linestatus"])


def _eval_sql() -> str:
    """valid = lines shipped before 1998, test = the rest."""
    sweep = _sweep_sql(None).replace(
        f"FROM ({SCORED_LINEITEM_SQL}) AS x WHERE prob IS NOT NULL",
        f"FROM ({SCORED_LINEITEM_SQL}) AS x WHERE prob IS NOT NULL AND l_shipdate < TIMESTAMP '1998-01-01'",
    )
    test = f"(SELECT * FROM ({SCORED_LINEITEM_SQL}) AS x WHERE l_shipdate >= TIMESTAMP '1998-01-01')"
    ap = _ap_sql(None).replace(f"FROM ({SCORED_LINEITEM_SQL}) AS x", f"FROM {test} AS x")
    auc = _auc_sql(None).replace(f"FROM ({SCORED_LINEITEM_SQL}) AS x", f"FROM {test} AS x")
    return f"""
WITH thr AS (SELECT threshold FROM ({sweep}) AS sw WHERE is_best),
c AS (SELECT min(threshold) AS threshold,
             count_if(y = 0 AND prob < threshold) AS tn, count_if(y = 0 AND prob >= threshold) AS fp,
             count_if(y = 1 AND prob < threshold) AS fn, count_if(y = 1 AND prob >= threshold) AS tp
      FROM {test} AS t CROSS JOIN thr)
SELECT threshold,
       (fp * 65.0 + fn * 320.0) / greatest(tn + fp + fn + tp, 1) * 1000.0 AS expected_cost_per_1000,
       (coalesce(tp / CAST(NULLIF(tp + fn, 0) AS DOUBLE), tn / CAST(NULLIF(tn + fp, 0) AS DOUBLE))
        + coalesce(tn / CAST(NULLIF(tn + fp, 0) AS DOUBLE), tp / CAST(NULLIF(tp + fn, 0) AS DOUBLE))) / 2 AS balanced_accuracy,
       coalesce(2.0 * tp / NULLIF(2 * tp + fp + fn, 0), 0.0) AS f1,
       ({ap}) AS average_precision,
       ({auc}) AS roc_auc,
       (SELECT avg(power(prob - y, 2)) FROM {test} AS b) AS brier_score
FROM c
"""


@register(
    "evaluate_classifier",
    _eval_sql(),
    ["threshold", "expected_cost_per_1000", "balanced_accuracy", "f1", "average_precision", "roc_auc", "brier_score"],
)
def q_evaluate(spark, sf_dir):
    s = scored_lineitem(spark, sf_dir)
    cut = F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp")
    return cl.evaluate_classifier(s.where(cut), s.where(~cut), "y", "prob")
