"""Batch scoring: schema alignment, positive-class probability, the
inclusive threshold label, and bundle metadata columns; plus a throughput
measurement that replaces per-row latency loops."""

from __future__ import annotations

import time
from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkexp.operators.clean import align_columns, align_schema
from sparkexp.operators.models import FinalModel, TLearner
from sparkexp.session import cut_lineage


def score_batch(
    model: FinalModel,
    df: DataFrame,
    expected: Sequence[tuple[str, str]] | None = None,
    source: str = "spark",
    name: str | None = None,
    threshold: float | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Align the input to the training schema, score, and label with
    ``probability >= threshold``. Empty input gives empty output."""
    x = df.select(*keep, *align_columns(df, expected)) if expected else df
    thr = float(model.threshold if threshold is None else threshold)
    scored = model.score(x, "churn_probability")
    return scored.select(
        *[c for c in keep if c in scored.columns],
        "churn_probability",
        (F.col("churn_probability") >= F.lit(thr)).cast("int").alias("predicted_label"),
        F.lit(thr).alias("threshold"),
        F.lit(source).alias("model_source"),
        F.lit(name or model.family).alias("model_name"),
    )


def score_uplift_batch(model: TLearner, df: DataFrame, expected: Sequence[tuple[str, str]] | None = None) -> DataFrame:
    """Align, score both arms, and return ``predicted_uplift``."""
    x = align_schema(df, expected) if expected else df
    out = model.transform(x)
    return out.withColumnRenamed("uplift", "predicted_uplift")


def scoring_throughput(scored: DataFrame, model_path: str | None = None) -> dict[str, Any]:
    """Mean milliseconds per row of a full scoring pass (executed with the
    ``noop`` sink, so nothing is written) and the saved model size."""
    spark = scored.sparkSession
    n = scored.count()
    t0 = time.perf_counter()
    scored.write.format("noop").mode("overwrite").save()
    elapsed = time.perf_counter() - t0
    size_mb = None
    if model_path:
        size_mb = directory_size_mb(spark, model_path)
    return {"rows": n, "seconds": elapsed, "infer_latency_ms": 1000.0 * elapsed / max(n, 1), "model_size_mb": size_mb}


def latency_distribution(scored: DataFrame, rows_per_call: int = 50) -> DataFrame:
    """One row: calls, rows, and the mean, median and 95th percentile of the
    milliseconds a row takes, over calls of ``rows_per_call`` rows; and ``left_out``, the
    rows of calls that are not counted.

    Scored rows reach a timer in the same task, ``rows_per_call`` at a time; a call's
    time is what it takes until they are there, reading and scoring included. A
    task's first call, which also starts it, is left out if it has others. An empty
    table has no calls and NULL times."""
    spark = scored.sparkSession
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)

    def timed(batches):
        import pyarrow as pa

        calls, t = [], time.perf_counter()
        for batch in batches:
            calls.append((batch.num_rows, (time.perf_counter() - t) * 1000.0))
            t = time.perf_counter()
        first = [(n, None) for n, _ in calls[:1] if len(calls) > 1]
        calls = [c for c in calls[1:] or calls if c[0]]
        calls = first + [(n, m / n) for n, m in calls]
        yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in calls], pa.int64()), pa.array([m for _, m in calls], pa.float64())], names=["n", "ms"])

    spark.conf.set(key, str(rows_per_call))
    try:
        calls = cut_lineage(scored.mapInArrow(timed, "n long, ms double"))
    finally:
        spark.conf.set(key, before)
    return calls.agg(
        F.count("ms").alias("calls"), F.coalesce(F.sum(F.when(F.col("ms").isNotNull(), F.col("n"))), F.lit(0)).alias("rows"), F.avg("ms").alias("infer_latency_ms"),
        F.percentile("ms", F.lit(0.5)).alias("p50_latency_ms"), F.percentile("ms", F.lit(0.95)).alias("p95_latency_ms"),
        F.coalesce(F.sum(F.when(F.col("ms").isNull(), F.col("n"))), F.lit(0)).alias("left_out"),
    )


def directory_size_mb(spark: SparkSession, path: str) -> float:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return float(fs.getContentSummary(p).getLength()) / (1024.0 * 1024.0)
