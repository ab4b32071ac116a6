"""Registered uplift / policy queries on the experiment view (score = price band)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkexp.operators import uplift as up
from sparkexp.plans.registry import register
from sparkexp.plans.tables import EXPERIMENT_SQL, experiment

ARGS = ("converted", "treatment", "score", "unit_id")


def ranked_sql(group_cols: list[str]) -> str:
    g = ", ".join(group_cols)
    part = f"PARTITION BY {g}" if g else ""
    return f"""
SELECT *,
       CAST(treatment AS DOUBLE) * converted / p_t - (1 - treatment) * CAST(converted AS DOUBLE) / (1.0 - p_t) AS inc
FROM (
  SELECT e.*,
         row_number() OVER ({part} ORDER BY score DESC NULLS LAST, unit_id ASC) AS rnk,
         count(*) OVER ({part}) AS n,
         greatest(least(avg(CAST(treatment AS DOUBLE)) OVER ({part}), 1 - 1e-6), 1e-6) AS p_t
  FROM ({EXPERIMENT_SQL}) AS e) AS r
"""


def _gsel(group_cols: list[str]) -> tuple[str, str]:
    g = ", ".join(group_cols)
    return (f"{g}, " if g else ""), (f"GROUP BY {g}" if g else "")


def metrics_sql(group_cols: list[str]) -> str:
    gsel, gby = _gsel(group_cols)
    return f"""
WITH r AS ({ranked_sql(group_cols)}),
a AS (
  SELECT {gsel} min(n) AS n,
         sum(inc * (n - rnk + 1)) AS sum_g, sum(inc) AS g_n,
         sum(CASE WHEN rnk = 1 THEN inc END) AS g_1,
         sum(CASE WHEN rnk <= greatest(1, CAST(floor(0.1 * n) AS BIGINT)) THEN inc ELSE 0.0 END) AS top_sum,
         min(greatest(1, CAST(floor(0.1 * n) AS BIGINT))) AS k
  FROM r {gby})
SELECT {gsel} n,
       CASE WHEN n > 1 THEN (sum_g - (g_1 + g_n) / 2) / CAST(n AS DOUBLE) / n ELSE 0.0 END AS auuc,
       CASE WHEN n > 1 THEN (sum_g - (g_1 + g_n) / 2) / CAST(n AS DOUBLE) / n
                            - g_n * (1.0 - 1.0 / (CAST(n AS DOUBLE) * n)) / 2 / n ELSE 0.0 END AS qini,
       top_sum / k AS uplift_at_top_decile
FROM a
"""


UPLIFT_DOUBLES = ["auuc", "qini", "uplift_at_top_decile"]


@register("uplift_metrics", metrics_sql([]), UPLIFT_DOUBLES)
def q_uplift_metrics(spark, sf_dir):
    return up.uplift_metrics(experiment(spark, sf_dir), *ARGS)


@register("uplift_metrics_grouped", metrics_sql(["c_mktsegment"]), UPLIFT_DOUBLES)
def q_uplift_metrics_grouped(spark, sf_dir):
    return up.uplift_metrics(experiment(spark, sf_dir), *ARGS, group_cols=["c_mktsegment"])


@register("auuc", f"SELECT auuc FROM ({metrics_sql([])}) AS m", ["auuc"])
def q_auuc(spark, sf_dir):
    return up.auuc(experiment(spark, sf_dir), *ARGS)


@register("qini", f"SELECT qini FROM ({metrics_sql([])}) AS m", ["qini"])
def q_qini(spark, sf_dir):
    return up.qini(experiment(spark, sf_dir), *ARGS)


@register("uplift_at_top_decile", f"SELECT uplift_at_top_decile FROM ({metrics_sql([])}) AS m", ["uplift_at_top_decile"])
def q_top_decile(spark, sf_dir):
    return up.uplift_at_top_decile(experiment(spark, sf_dir), *ARGS)


_CURVE_SQL = f"""
SELECT rnk AS rank, rnk / CAST(n AS DOUBLE) AS population_share,
       sum(inc) OVER (ORDER BY rnk ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cumulative_gain
FROM ({ranked_sql([])}) AS r
"""


@register("uplift_curve", _CURVE_SQL, ["population_share", "cumulative_gain"])
def q_uplift_curve(spark, sf_dir):
    return up.uplift_curve(experiment(spark, sf_dir), *ARGS)


_CURVE_POINTS_SQL = f"""
WITH r AS (SELECT *, CAST(ceil(rnk * 20 / CAST(n AS DOUBLE)) AS INTEGER) AS point FROM ({ranked_sql([])}) AS x),
b AS (SELECT point, sum(inc) AS s, max(rnk) AS rnk, min(n) AS n FROM r GROUP BY point)
SELECT point, rnk AS rank, rnk / CAST(n AS DOUBLE) AS population_share,
       sum(s) OVER (ORDER BY point ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cumulative_gain
FROM b
"""


@register("uplift_curve_points", _CURVE_POINTS_SQL, ["population_share", "cumulative_gain"])
def q_uplift_curve_points(spark, sf_dir):
    return up.uplift_curve(experiment(spark, sf_dir), *ARGS, points=20)


def policies_sql(group_cols: list[str], frac: float) -> str:
    gsel, gby = _gsel(group_cols)
    return f"""
SELECT {gsel}
       sum(inc) AS expected_incremental_conversions_blanket,
       sum(CASE WHEN rnk <= greatest(1, CAST(floor({frac} * n) AS BIGINT)) THEN inc ELSE 0.0 END) AS expected_incremental_conversions_targeted,
       sum(inc) * 120.0 AS expected_incremental_value_blanket,
       sum(CASE WHEN rnk <= greatest(1, CAST(floor({frac} * n) AS BIGINT)) THEN inc ELSE 0.0 END) * 120.0 AS expected_incremental_value_targeted,
       {frac} AS target_fraction
FROM ({ranked_sql(group_cols)}) AS r {gby}
"""


POLICY_DOUBLES = [
    "expected_incremental_conversions_blanket",
    "expected_incremental_conversions_targeted",
    "expected_incremental_value_blanket",
    "expected_incremental_value_targeted",
    "target_fraction",
]


@register("compare_policies", policies_sql(["o_orderpriority"], 0.30), POLICY_DOUBLES)
def q_compare_policies(spark, sf_dir):
    return up.compare_policies(experiment(spark, sf_dir), *ARGS, group_cols=["o_orderpriority"])


_IPS_SQL = f"""
WITH e AS (SELECT *, CAST(score >= 5 AS INTEGER) AS policy FROM ({EXPERIMENT_SQL}) AS x),
a AS (SELECT c_mktsegment,
             greatest(least(avg(CAST(treatment AS DOUBLE)), 1 - 1e-6), 1e-6) AS p,
             avg(CAST(policy AS DOUBLE) * treatment * converted) AS a1,
             avg((1.0 - policy) * (1.0 - treatment) * converted) AS b1
      FROM e GROUP BY c_mktsegment)
SELECT c_mktsegment, a1 / p + b1 / (1.0 - p) AS policy_value FROM a
"""


@register("policy_value_ips", _IPS_SQL, ["policy_value"])
def q_policy_value(spark, sf_dir):
    e = experiment(spark, sf_dir).withColumn("policy", (F.col("score") >= 5).cast("int"))
    return up.policy_value_ips(e, "converted", "treatment", "policy", ["c_mktsegment"])


_OPT_SQL = f"""
WITH r AS ({ranked_sql(['o_orderpriority'])}),
g AS (SELECT * FROM (VALUES (0.1), (0.2), (0.3), (0.4), (0.5)) AS t(target_fraction)),
v AS (
  SELECT o_orderpriority, target_fraction,
         sum(CASE WHEN rnk <= greatest(1, CAST(floor(target_fraction * n) AS BIGINT)) THEN inc ELSE 0.0 END) AS c
  FROM r CROSS JOIN g GROUP BY o_orderpriority, target_fraction)
SELECT o_orderpriority, target_fraction, c * 120.0 AS expected_incremental_value_targeted,
       c AS expected_incremental_conversions_targeted,
       row_number() OVER (PARTITION BY o_orderpriority ORDER BY c * 120.0 DESC, target_fraction) = 1 AS is_best
FROM v
"""


@register(
    "optimize_policy_fraction",
    _OPT_SQL,
    ["target_fraction", "expected_incremental_value_targeted", "expected_incremental_conversions_targeted"],
)
def q_optimize_fraction(spark, sf_dir):
    return up.optimize_policy_fraction(experiment(spark, sf_dir), *ARGS, group_cols=["o_orderpriority"])


# arm Brier: model probabilities stand-ins derived from the data (price band share)
_BRIER_SQL = f"""
WITH e AS (SELECT *, least(score / 10.0, 1.0) AS p_t_model, least(score / 12.0, 1.0) AS p_c_model FROM ({EXPERIMENT_SQL}) AS x)
SELECT c_mktsegment,
       avg(CASE WHEN treatment = 1 THEN power(greatest(least(p_t_model, 1 - 1e-6), 1e-6) - converted, 2) END) AS brier_treated,
       avg(CASE WHEN treatment = 0 THEN power(greatest(least(p_c_model, 1 - 1e-6), 1e-6) - converted, 2) END) AS brier_control,
       (avg(CASE WHEN treatment = 1 THEN power(greatest(least(p_t_model, 1 - 1e-6), 1e-6) - converted, 2) END)
        + avg(CASE WHEN treatment = 0 THEN power(greatest(least(p_c_model, 1 - 1e-6), 1e-6) - converted, 2) END)) / 2 AS calibration_metric
FROM e GROUP BY c_mktsegment
"""


@register("arm_brier", _BRIER_SQL, ["brier_treated", "brier_control", "calibration_metric"])
def q_arm_brier(spark, sf_dir):
    e = experiment(spark, sf_dir)
    e = e.withColumn("p_t_model", F.least(F.col("score") / 10.0, F.lit(1.0))).withColumn(
        "p_c_model", F.least(F.col("score") / 12.0, F.lit(1.0))
    )
    return up.arm_brier(e, "converted", "treatment", "p_t_model", "p_c_model", ["c_mktsegment"])


def _bootstrap_sql(n_boot: int, seed: int) -> str:
    from sparkexp.functions.hashing import MASK32, REP_SALT, h32_sql_stages, poisson1_cdf

    def staged(base: str, src: str, out: str) -> str:
        sql = base
        for i, st in enumerate(h32_sql_stages(src, out)):
            sql = f"SELECT *, {st} FROM ({sql}) AS _h{out}{i}"
        return sql

    seed_h = staged(f"SELECT {seed & MASK32}::UBIGINT AS sd", "sd", "sh")
    rows = f"""SELECT unit_id, treatment, converted,
                      row_number() OVER (ORDER BY score DESC NULLS LAST, unit_id) AS rnk,
                      (unit_id & {MASK32})::UBIGINT AS lo, ((unit_id >> 32) & {MASK32})::UBIGINT AS hi
               FROM ({EXPERIMENT_SQL}) AS e"""
    b1 = staged(f"SELECT r.*, xor(r.lo, s.sh) AS k1 FROM ({rows}) AS r CROSS JOIN ({seed_h}) AS s", "k1", "b1")
    b2 = staged(f"SELECT *, xor(b1, hi) AS k2 FROM ({b1}) AS x", "k2", "base")
    salt = staged(f"SELECT rep, xor(rep::UBIGINT, {REP_SALT}::UBIGINT) AS r0 FROM range(0, {n_boot}) AS t(rep)", "r0", "salt")
    pair = staged(f"SELECT b.unit_id, b.treatment, b.converted, b.rnk, s.rep, xor(b.base, s.salt) AS k3 FROM ({b2}) AS b CROSS JOIN ({salt}) AS s", "k3", "hv")
    cdf = poisson1_cdf()
    w = "(" + " + ".join(f"(CASE WHEN hv / 4294967296.0 >= {c!r} THEN 1 ELSE 0 END)" for c in cdf) + ")"
    return f"""
WITH x AS (SELECT unit_id, treatment, converted, rnk, rep, {w} AS w FROM ({pair}) AS pr),
y AS (SELECT * FROM x WHERE w > 0),
p AS (SELECT *, sum(w) OVER (PARTITION BY rep ORDER BY rnk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM y),
s AS (SELECT rep, sum(w) AS n, sum(w * treatment) AS nt,
             sum(w * treatment * converted) AS su, sum(w * (1 - treatment) * converted) AS sv,
             sum(treatment * converted * (w * coalesce(before, 0) + w * (w + 1) / 2.0)) AS pu,
             sum((1 - treatment) * converted * (w * coalesce(before, 0) + w * (w + 1) / 2.0)) AS pv,
             arg_min(treatment * converted, rnk) AS u1, arg_min((1 - treatment) * converted, rnk) AS v1
      FROM p GROUP BY rep),
q AS (SELECT *, greatest(least(nt / CAST(n AS DOUBLE), 1 - 1e-6), 1e-6) AS pt FROM s),
a AS (SELECT rep, n,
             (su / pt - sv / (1 - pt)) AS gn,
             (n + 1) * (su / pt - sv / (1 - pt)) - (pu / pt - pv / (1 - pt)) AS sum_g,
             u1 / pt - v1 / (1 - pt) AS g1 FROM q)
SELECT avg(CASE WHEN n > 1 THEN (sum_g - (g1 + gn) / 2) / CAST(n AS DOUBLE) / n ELSE 0.0 END) AS cv_metric_mean,
       stddev_pop(CASE WHEN n > 1 THEN (sum_g - (g1 + gn) / 2) / CAST(n AS DOUBLE) / n ELSE 0.0 END) AS cv_metric_std,
       count(*) AS n_replicates
FROM a
"""


@register("bootstrap_metric", _bootstrap_sql(250, 42), ["cv_metric_mean", "cv_metric_std"])
def q_bootstrap(spark, sf_dir):
    return up.bootstrap_auuc(experiment(spark, sf_dir), *ARGS, n_boot=250, seed=42)
