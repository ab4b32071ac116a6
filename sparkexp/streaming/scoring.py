"""Structured Streaming: scoring a stream of records with the batch model
(stateless, so the stream output equals the batch output), and windowed
drift counts with a watermark for late data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sparkexp.operators.clean import align_columns
from sparkexp.operators.models import FinalModel


def read_record_stream(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "json", max_files_per_trigger: int | None = None
) -> DataFrame:
    """File-source stream of records with a fixed schema (unknown fields ignored)."""
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def score_stream(
    model: FinalModel,
    stream: DataFrame,
    keep: Sequence[str] = (),
    threshold: float | None = None,
    source: str = "spark",
    expected: Sequence[tuple[str, str]] | None = None,
) -> DataFrame:
    """The batch scoring transform applied to a streaming DataFrame, after the
    same schema alignment: with ``expected``, a missing column is NULL."""
    thr = float(model.threshold if threshold is None else threshold)
    x = stream.select(*keep, *align_columns(stream, expected)) if expected else stream
    scored = model.score(x, "churn_probability")
    return scored.select(
        *keep,
        "churn_probability",
        (F.col("churn_probability") >= F.lit(thr)).cast("int").alias("predicted_label"),
        F.lit(thr).alias("threshold"),
        F.lit(source).alias("model_source"),
        F.lit(model.family).alias("model_name"),
    )


def windowed_monitoring(
    scored: DataFrame, ts_col: str, window: str = "1 day", watermark: str | None = "1 hour", group_cols: Sequence[str] = ()
) -> DataFrame:
    """Tumbling-window monitoring counts: rows, mean probability, high-risk rate.

    A watermark bounds the state and drops rows that come later than it allows;
    None keeps every window open, for sources in no order of time."""
    return (
        (scored.withWatermark(ts_col, watermark) if watermark else scored)
        .groupBy(F.window(ts_col, window).alias("window"), *group_cols)
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.avg("churn_probability").alias("mean_probability"),
            F.avg(F.col("predicted_label").cast("double")).alias("high_risk_rate"),
        )
    )


def run_windowed(df: DataFrame, sink_path: str, checkpoint: str) -> StreamingQuery:
    """Run a windowed aggregate to the end of what is available. Every micro-batch
    writes the windows it changed to a folder of its own (a repeated batch
    overwrites it); ``latest_windows`` reads the last state of each. Windows that
    are still open at the end are there too, unlike in append mode."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink_path}/batch_id={batch_id}")

    q = df.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(write).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def latest_windows(spark: SparkSession, sink_path: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """The last written state of each window and group."""
    t = spark.read.parquet(sink_path)
    cols = [c for c in t.columns if c != "batch_id"]
    last = t.groupBy("window", *group_cols).agg(F.max_by(F.struct(*cols), F.col("batch_id")).alias("r"))
    return last.select("r.*")


def run_available_now(df: DataFrame, sink_path: str, checkpoint: str, fmt: str = "parquet", mode: str = "append") -> StreamingQuery:
    """Process everything available, then stop (no ports, no long-running server)."""
    q = (
        df.writeStream.format(fmt)
        .option("path", sink_path)
        .option("checkpointLocation", checkpoint)
        .outputMode(mode)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return q
