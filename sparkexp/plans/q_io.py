"""Registered source/sink queries: each writes data Spark derives from the
driver tables to a fresh folder under the shared checkpoint directory and
reads it back through the operator under test."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkexp.functions.hashing import seeded_uniform_sql
from sparkexp.operators.experiment import ab_test
from sparkexp.operators.sampling import stratified_split
from sparkexp.plans.q_experiment import _ab_sql
from sparkexp.plans.registry import register
from sparkexp.plans.tables import EXPERIMENT_SQL, experiment, load, use_utc
from sparkexp.sources import io

CUSTOMER_SCHEMA = "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
ORDERS_SCHEMA = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_custkey", T.LongType()),
        T.StructField("o_orderstatus", T.StringType()),
        T.StructField("o_totalprice", T.DoubleType()),
        T.StructField("o_orderpriority", T.StringType()),
    ]
)


@register("read_delimited", "SELECT * FROM customer", ["c_acctbal"])
def q_read_delimited(spark, sf_dir):
    path = io.scratch_path(spark, "csv")
    io.write_table(load(spark, sf_dir, "customer"), path, fmt="csv")
    return io.read_delimited(spark, path, CUSTOMER_SCHEMA)


_ORD_SQL = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders"


@register("read_json_records", _ORD_SQL, ["o_totalprice"])
def q_read_json(spark, sf_dir):
    path = io.scratch_path(spark, "json")
    src = load(spark, sf_dir, "orders").select(*ORDERS_SCHEMA.fieldNames(), "o_orderdate")
    io.write_table(src, path, fmt="json")  # extra field o_orderdate is ignored on read
    return io.read_json_records(spark, path, ORDERS_SCHEMA, layout="lines")


@register("read_json_records_wrapped", _ORD_SQL, ["o_totalprice"])
def q_read_json_wrapped(spark, sf_dir):
    """``{"records": [...]}`` documents of at most 100 orders each."""
    path = io.scratch_path(spark, "jsonw")
    src = load(spark, sf_dir, "orders")
    docs = src.groupBy(F.floor(F.col("o_orderkey") / 100).alias("_doc")).agg(
        F.collect_list(F.struct(*ORDERS_SCHEMA.fieldNames())).alias("records")
    ).select("records")
    io.write_table(docs, path, fmt="json")
    return io.read_json_records(spark, path, ORDERS_SCHEMA, layout="wrapped")


@register("write_table", EXPERIMENT_SQL, ["o_totalprice", "c_acctbal", "score"])
def q_write_table(spark, sf_dir):
    path = io.scratch_path(spark, "table")
    io.write_table(experiment(spark, sf_dir), path, fmt="parquet")
    use_utc(spark)
    return spark.read.parquet(path)


def _snap_sql() -> str:
    h = seeded_uniform_sql(42, "unit_id")
    split = f"""
SELECT *, CASE WHEN rk <= round(c * 0.2) THEN 'test'
               WHEN rk <= round(c * 0.2) + round((c - round(c * 0.2)) * 0.25) THEN 'valid' ELSE 'train' END AS split
FROM (SELECT *, row_number() OVER (PARTITION BY converted ORDER BY {h}, unit_id) AS rk,
             count(*) OVER (PARTITION BY converted) AS c FROM ({EXPERIMENT_SQL}) AS e) AS r"""
    recent_u = seeded_uniform_sql(42, "unit_id")
    return f"""
WITH s AS ({split})
SELECT unit_id, converted, o_totalprice, split FROM s WHERE split IN ('train', 'test')
UNION ALL
SELECT unit_id, converted, o_totalprice, 'recent' FROM (
  SELECT unit_id, converted, o_totalprice * 1.08 AS o_totalprice FROM s WHERE split = 'test'
  ORDER BY {recent_u}, unit_id LIMIT 250) AS r
"""


@register("write_split_snapshots", _snap_sql(), ["o_totalprice"])
def q_snapshots(spark, sf_dir):
    e = experiment(spark, sf_dir).select("unit_id", "converted", "o_totalprice")
    s = stratified_split(e, ["converted"], "unit_id", 0.2, 0.2, 42)
    base = io.scratch_path(spark, "snap")
    paths = io.write_split_snapshots(s, base, id_col="unit_id", inflate_col="o_totalprice", factor=1.08)
    splits = spark.read.parquet(paths["splits"]).select("unit_id", "converted", "o_totalprice", "split")
    recent = spark.read.parquet(paths["recent"]).select("unit_id", "converted", "o_totalprice", F.lit("recent").alias("split"))
    return splits.unionByName(recent)


def _log_sql() -> str:
    cols = ["n_control", "n_treatment", "control_rate", "treatment_rate", "absolute_lift", "relative_lift", "ci_low", "ci_high", "p_value"]
    u = " UNION ALL ".join(
        f"SELECT c_mktsegment, '{c}' AS metric, CAST({c} AS DOUBLE) AS num_value FROM a" for c in cols
    )
    return f"""
WITH a AS ({_ab_sql(['c_mktsegment'])})
SELECT 'ab-run' AS run_id, 'metric' AS kind, c_mktsegment || ':' || metric AS key, num_value
FROM ({u}) AS l WHERE num_value IS NOT NULL AND NOT isnan(num_value) AND isfinite(num_value)
"""


_RUN_COLS = ["n_control", "n_treatment", "control_rate", "treatment_rate", "absolute_lift", "relative_lift", "ci_low", "ci_high", "p_value"]


def _run_sql() -> str:
    metrics = " UNION ALL ".join(
        f"SELECT {prefix}'{c}' AS key, CAST({c} AS DOUBLE) AS num_value FROM {t}"
        for t, prefix in (("a", ""), ("s", "coalesce(c_mktsegment, '') || ':' || "))
        for c in _RUN_COLS
    )
    return f"""
WITH a AS ({_ab_sql([])}), s AS ({_ab_sql(['c_mktsegment'])})
SELECT 'run-1' AS run_id, 'param' AS kind, k AS key, v AS value, CAST(NULL AS DOUBLE) AS num_value FROM (VALUES ('table', 'orders'), ('seed', '42'), ('alpha', '0.05')) AS t(k, v)
UNION ALL SELECT 'run-1', 'metric', key, NULL, num_value FROM ({metrics}) AS l WHERE num_value IS NOT NULL AND NOT isnan(num_value) AND isfinite(num_value)
"""


@register("log_run", _run_sql(), ["num_value"])
def q_log_run(spark, sf_dir):
    """One run's parameters (as text) and all metrics, over all rows and per segment; what is
    no finite number is left out."""
    e = experiment(spark, sf_dir)
    row = ab_test(e, "treatment", "converted").first()
    metrics = {c: row[c] for c in _RUN_COLS} | {"missing": None, "odd": float("nan"), "huge": float("inf"), "text": "n/a"}
    for r in ab_test(e, "treatment", "converted", ["c_mktsegment"]).collect():  # one row per segment
        metrics |= {f"{r['c_mktsegment'] or ''}:{c}": r[c] for c in _RUN_COLS}
    path = io.scratch_path(spark, "runlog")
    io.log_run(spark, path, "run-1", {"table": "orders", "seed": 42, "alpha": 0.05}, metrics)
    log = spark.read.parquet(path)
    return log.select("run_id", "kind", "key", F.when(F.col("kind") == "param", F.col("value")).alias("value"), "num_value")


@register("log_metrics_table", _log_sql(), ["num_value"])
def q_log_metrics(spark, sf_dir):
    metrics = ab_test(experiment(spark, sf_dir), "treatment", "converted", ["c_mktsegment"])
    path = io.scratch_path(spark, "runlog")
    io.log_metrics_table(metrics, "ab-run", ["c_mktsegment"]).write.mode("append").parquet(path)
    return spark.read.parquet(path)
