"""Views over the driver's tables that the registered queries run on.

Each view is given twice: as a DataFrame (what the library consumes) and as
DuckDB SQL (what the oracle consumes). They must describe the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def use_utc(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.session.timeZone", "UTC")


# ------------------------------------------------------------ experiment view
# orders joined to customers: arm = o_orderkey % 2, outcome = status 'F',
# segments = priority and market segment, covariates = price and balance,
# score = a coarse price band (many ties, broken by unit_id).

def experiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    use_utc(spark)
    o = load(spark, sf_dir, "orders")
    c = load(spark, sf_dir, "customer")
    j = o.join(c, o["o_custkey"] == c["c_custkey"], "inner")
    return j.select(
        F.col("o_orderkey").alias("unit_id"),
        (F.col("o_orderkey") % 2).cast("int").alias("treatment"),
        (F.col("o_orderstatus") == "F").cast("int").alias("converted"),
        F.col("o_orderpriority"),
        F.col("c_mktsegment"),
        F.col("c_nationkey"),
        F.col("o_totalprice"),
        F.col("c_acctbal"),
        F.col("o_orderdate"),
        F.floor(F.col("o_totalprice") / 50000).cast("double").alias("score"),
        (F.col("o_orderkey") % 3 == 0).cast("int").alias("arm3"),
    )


EXPERIMENT_SQL = """
SELECT o_orderkey AS unit_id,
       CAST(o_orderkey % 2 AS INTEGER) AS treatment,
       CAST(o_orderstatus = 'F' AS INTEGER) AS converted,
       o_orderpriority, c_mktsegment, c_nationkey, o_totalprice, c_acctbal, o_orderdate,
       CAST(floor(o_totalprice / 50000) AS DOUBLE) AS score,
       CAST(o_orderkey % 3 = 0 AS INTEGER) AS arm3
FROM orders JOIN customer ON o_custkey = c_custkey
"""


# ------------------------------------------------------------ scored view
# lineitem as a scored classifier table: y = returned, prob = quantity / 51.

def scored_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    use_utc(spark)
    li = load(spark, sf_dir, "lineitem")
    return li.select(
        (F.col("l_returnflag") == "R").cast("int").alias("y"),
        (F.col("l_quantity") / 51.0).alias("prob"),
        F.col("l_linestatus"),
        F.col("l_shipdate"),
    )


SCORED_LINEITEM_SQL = """
SELECT CAST(l_returnflag = 'R' AS INTEGER) AS y,
       l_quantity / 51.0 AS prob,
       l_linestatus, l_shipdate
FROM lineitem
"""


# ------------------------------------------------------------ candidate view
# per-brand aggregates of lineitem x part stand in for model candidates:
# one leaderboard row per brand with metric-like columns, some NULL.

def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    use_utc(spark)
    li = load(spark, sf_dir, "lineitem")
    p = load(spark, sf_dir, "part")
    j = li.join(p, li["l_partkey"] == p["p_partkey"], "inner")
    g = j.groupBy("p_brand").agg(
        F.avg("l_discount").alias("cv_metric_mean"),
        F.stddev_pop("l_discount").alias("cv_metric_std"),
        (F.avg("l_extendedprice") / 1000.0).alias("holdout_primary_metric"),
        F.avg(F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0)).alias("holdout_secondary_metric"),
        F.avg("l_tax").alias("holdout_tertiary_metric"),
        F.when(F.min("p_partkey") % 7 == 0, F.lit(None)).otherwise(F.avg("l_discount") * 3.0).alias("calibration_metric"),
        (F.count(F.lit(1)) / 100.0).alias("train_time_sec"),
        F.avg("p_size").alias("infer_latency_ms"),
        F.max("p_size").cast("double").alias("p95_latency_ms"),
        (F.avg("p_retailprice") / 100.0).alias("model_size_mb"),
        (F.sum("l_quantity") / 1000.0).alias("retrain_time_sec"),
        (F.count(F.lit(1)) % 2 == 0).alias("_even"),
    )
    return g.select(
        F.lit("candidates").alias("project_name"),
        F.lit("binary_classification").alias("task_type"),
        F.lit("spark").alias("library_source"),
        F.col("p_brand").alias("model_name"),
        F.col("p_brand").alias("_candidate_id"),
        "cv_metric_mean", "cv_metric_std", "holdout_primary_metric", "holdout_secondary_metric",
        "holdout_tertiary_metric", "calibration_metric", "train_time_sec", "infer_latency_ms",
        "p95_latency_ms", "model_size_mb", "retrain_time_sec",
        F.concat(F.lit("brand "), F.col("p_brand")).alias("interpretability_note"),
        "_even",
    )


CANDIDATES_SQL = """
SELECT 'candidates' AS project_name, 'binary_classification' AS task_type, 'spark' AS library_source,
       p_brand AS model_name, p_brand AS _candidate_id,
       avg(l_discount) AS cv_metric_mean, stddev_pop(l_discount) AS cv_metric_std,
       avg(l_extendedprice) / 1000.0 AS holdout_primary_metric,
       avg(CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END) AS holdout_secondary_metric,
       avg(l_tax) AS holdout_tertiary_metric,
       CASE WHEN min(p_partkey) % 7 = 0 THEN NULL ELSE avg(l_discount) * 3.0 END AS calibration_metric,
       count(*) / 100.0 AS train_time_sec, avg(p_size) AS infer_latency_ms, CAST(max(p_size) AS DOUBLE) AS p95_latency_ms,
       avg(p_retailprice) / 100.0 AS model_size_mb, sum(l_quantity) / 1000.0 AS retrain_time_sec,
       'brand ' || p_brand AS interpretability_note,
       count(*) % 2 = 0 AS _even
FROM lineitem JOIN part ON l_partkey = p_partkey
GROUP BY p_brand
"""
