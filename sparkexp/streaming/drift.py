"""Drift of a stream: per time window, how each numeric feature's distribution over
the training table's deciles has moved (population stability index).

The training side is a static table with one row per feature: its edges and bin
counts. The stream is joined to it, rows are counted per window, feature and bin under
a watermark, and the index follows from a window's counts whenever it is read. The
state is one row of counts per open window and feature.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkexp.operators.drift import EPSILON, _bin_of, _numeric_long, drift_level, psi_edges
from sparkexp.session import cut_lineage
from sparkexp.streaming.scoring import latest_windows


def training_histogram(train: DataFrame, cols: Sequence[str], bins: int = 10) -> DataFrame:
    """feature, edges, counts (per bin): the fixed side of the comparison. Features
    with fewer than three distinct edges have none."""
    edges = cut_lineage(psi_edges(train, cols, bins).where(F.size("edges") >= 3))
    # One row per feature.
    rows = _numeric_long(train, cols, ()).join(F.broadcast(edges), "feature").select("feature", "edges", _bin_of(F.col("_v"), F.col("edges"), bins + 1).alias("bin"))
    per = [F.count_if(F.col("bin") == i) for i in range(bins)]
    out = rows.groupBy("feature", "edges").agg(F.array(*per).alias("counts"))
    return cut_lineage(out.withColumn("counts", F.slice("counts", 1, F.size("edges") - 1)))


def windowed_histogram(
    stream: DataFrame, reference: DataFrame, ts_col: str, cols: Sequence[str], window: str = "1 day", watermark: str | None = "1 hour", bins: int = 10
) -> DataFrame:
    """window, feature, counts of the stream over the training bins; values outside
    the training range count in none. Rows later than ``watermark`` allows are
    dropped; None keeps every window open."""
    d = stream.withWatermark(ts_col, watermark) if watermark else stream
    long = _numeric_long(d.where(F.col(ts_col).isNotNull()), cols, (ts_col,))
    # The reference has one row per feature.
    j = long.join(F.broadcast(reference.select("feature", "edges")), "feature")
    j = j.select(ts_col, "feature", _bin_of(F.col("_v"), F.col("edges"), bins + 1).alias("bin"))
    per = [F.count_if(F.col("bin") == i) for i in range(bins)]
    return j.groupBy(F.window(ts_col, window).alias("window"), "feature").agg(F.count(F.lit(1)).alias("rows"), F.array(*per).alias("counts"))


def window_drift(counted: DataFrame, reference: DataFrame, epsilon: float = EPSILON) -> DataFrame:
    """window_start, feature, rows, psi and drift_level from counts per window (a row
    for each window and feature)."""
    j = counted.join(F.broadcast(reference.select("feature", F.col("counts").alias("e"))), "feature")
    a = F.slice("counts", 1, F.size("e"))
    total = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda s, x: s + x)
    j = j.select(F.col("window.start").alias("window_start"), "feature", "rows", "e", a.alias("a"), F.size("e").alias("nb"))
    j = j.withColumns({"te": total(F.col("e")), "ta": total(F.col("a"))})

    def term(e, a):
        pe = (e + F.lit(epsilon)) / (F.col("te") + F.lit(epsilon) * F.col("nb"))
        pa = (a + F.lit(epsilon)) / (F.col("ta") + F.lit(epsilon) * F.col("nb"))
        return (pa - pe) * F.log(pa / pe)

    psi = F.aggregate(F.zip_with("e", "a", term), F.lit(0.0), lambda s, x: s + x)
    return j.select("window_start", "feature", "rows", psi.alias("psi")).withColumn("drift_level", drift_level(F.col("psi")))


def latest_drift(spark: SparkSession, sink_path: str, reference: DataFrame, epsilon: float = EPSILON) -> DataFrame:
    """Drift of the last written state of each window (see ``run_windowed``)."""
    return window_drift(latest_windows(spark, sink_path, ["feature"]), reference, epsilon)
