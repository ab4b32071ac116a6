"""Global order statistics without a single-task window.

``Window.orderBy(...)`` with no partition key moves every row into one task.
Here the rows are range-partitioned on the full sort key (group keys, order
keys, and a unique tie key, so even one value holding a third of the rows is
split across tasks), sorted inside each partition, and tagged with
``monotonically_increasing_id`` (partition index << 33 | position). A tiny
table of per-partition counts and sums (at most one row per partition and
group) gives each partition its offset; joined back, it yields exact global
ranks and running totals.

The ranged frame is written once to the shared checkpoint folder before its two
consumers read it: two independent range exchanges would sample different
bounds. Nothing stays cached, and lost executors cost no recomputation. Running
sums are carried along inside the sorted partitions while it is written, so they
need no second shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkexp.operators.joins import join_keys, join_per_group
from sparkexp.session import cut_lineage

_POS_MASK = (1 << 33) - 1
#: Offsets of up to so many (partition, group) pairs are sent to every task.
MOST_SENT = 100_000


def _num_partitions(df: DataFrame, num_partitions: int | None) -> int:
    if num_partitions:
        return int(num_partitions)
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def _ranged(
    df: DataFrame,
    order: Sequence[Column],
    group_cols: Sequence[str],
    num_partitions: int | None,
    sum_cols: Sequence[str] = (),
) -> DataFrame:
    keys = [F.col(g).asc_nulls_first() for g in group_cols] + list(order)
    n = _num_partitions(df, num_partitions)
    ranged = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    mid = F.monotonically_increasing_id()
    out = ranged.withColumn("_mid", mid).select(
        "*",
        F.shiftright(F.col("_mid"), 33).alias("_pid"),
        F.col("_mid").bitwiseAND(F.lit(_POS_MASK)).alias("_pos"),
    ).drop("_mid")
    if sum_cols:
        schema = T.StructType(list(out.schema.fields))
        for c in sum_cols:
            schema = schema.add(f"_run_{c}", _sum_type(out.schema[c].dataType))
        out = out.mapInArrow(_running(list(sum_cols), [schema[f"_run_{c}"].dataType for c in sum_cols]), schema)
    return cut_lineage(out)


def _sum_type(t: T.DataType) -> T.DataType:
    return T.LongType() if isinstance(t, T.IntegralType) else T.DoubleType()


def _running(cols: list[str], types: list[T.DataType]):
    """Running sums over one sorted partition, batch by batch; NULL adds nothing."""

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        total = [0 if isinstance(t, T.LongType) else 0.0 for t in types]
        for batch in batches:
            arrays, names = list(batch.columns), list(batch.schema.names)
            for i, (c, t) in enumerate(zip(cols, types, strict=True)):
                kind = pa.int64() if isinstance(t, T.LongType) else pa.float64()
                own = pc.fill_null(batch.column(c).cast(kind), 0)
                cum = pc.add(pc.cumulative_sum(own), pa.scalar(total[i], kind))
                if len(cum):
                    total[i] = cum[-1].as_py()
                arrays.append(cum)
                names.append(f"_run_{c}")
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return run


def global_rank(
    df: DataFrame,
    order: Sequence[Column],
    group_cols: Sequence[str] = (),
    rank_col: str = "rank",
    sum_cols: Sequence[str] = (),
    num_partitions: int | None = None,
    total_col: str | None = None,
) -> DataFrame:
    """Add a 1-based ``rank_col`` (row number in ``order`` within each group).

    ``order`` must be a total order (end it with a unique key). When
    ``sum_cols`` is given, ``<col>_cum`` running sums (inclusive) are added as
    well, and with ``total_col`` the group's number of rows. Writes the sorted rows
    and the groups' offsets to the checkpoint folder when called, so that reading the
    result again costs one pass and no shuffle.
    """
    ranged = _ranged(df, order, group_cols, num_partitions, sum_cols)
    aggs = [F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_cnt")]
    aggs += [F.sum(F.col(c)).alias(f"_s_{c}") for c in sum_cols]
    # what the partition's earlier groups have added to the running sum
    aggs += [F.min_by(F.col(f"_run_{c}") - F.coalesce(F.col(c), F.lit(0)), F.col("_pos")).alias(f"_b_{c}") for c in sum_cols]
    stats = ranged.groupBy("_pid", *group_cols).agg(*aggs)
    w = Window.partitionBy(*group_cols).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    stats = stats.select(
        "_pid",
        *group_cols,
        "_first",
        F.coalesce(F.sum("_cnt").over(w), F.lit(0)).alias("_off"),
        *[F.sum("_cnt").over(Window.partitionBy(*group_cols)).alias(c) for c in [total_col] if c],
        *[(F.coalesce(F.sum(f"_s_{c}").over(w), F.lit(0)) - F.col(f"_b_{c}")).alias(f"_o_{c}") for c in sum_cols],
    )
    # At most one row per (partition, group): bounded by the partition count
    # when ungrouped, so broadcasting it is safe; grouped, its size is measured first
    # (Spark, which does not know it, would shuffle all rows) and Spark chooses if large.
    if group_cols:
        stats = cut_lineage(stats)
        j = join_per_group(ranged, F.broadcast(stats) if stats.count() <= MOST_SENT else stats, ["_pid", *group_cols])
    else:
        j = ranged.join(F.broadcast(stats), "_pid", "inner")
    out = j.withColumn(rank_col, F.col("_off") + F.col("_pos") - F.col("_first") + F.lit(1))
    for c in sum_cols:
        out = out.withColumn(f"{c}_cum", F.col(f"_o_{c}") + F.col(f"_run_{c}"))
    drop = ["_pid", "_pos", "_first", "_off", *[f"_{x}_{c}" for c in sum_cols for x in ("o", "run")]]
    return out.drop(*drop)


def exact_quantiles(
    df: DataFrame,
    value_cols: Sequence[str],
    probs: Sequence[float],
    group_cols: Sequence[str] = (),
    num_partitions: int | None = None,
) -> DataFrame:
    """Exact quantiles with linear interpolation (NumPy's default method).

    Long output: (group..., feature, q_index, prob, value). Values are
    unpivoted and collapsed to (value, count) per (group, feature) — repeats
    are merged map-side before any shuffle — then the distinct values are
    ranked by the distributed sort with running counts. Each distinct value
    covers the row positions (cum - count, cum]; the at most 2 x len(probs)
    target positions per feature (a bounded array joined to every distinct
    value) pick the two values around each quantile. Nothing is buffered per
    group.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("_v")) for c in value_cols])
    long = df.select(*group_cols, F.inline(pairs)).where(F.col("_v").isNotNull() & ~F.isnan(F.col("_v")))
    keys = [*group_cols, "feature"]
    # reduced data, read by the range sampler, the ranking and the counts
    dist = cut_lineage(long.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_c")))
    return quantiles_from_counts(dist, keys, probs, group_cols, num_partitions)


def quantiles_from_counts(
    dist: DataFrame,
    keys: Sequence[str],
    probs: Sequence[float],
    group_cols: Sequence[str] = (),
    num_partitions: int | None = None,
) -> DataFrame:
    """``exact_quantiles`` over an already collapsed (keys..., _v, _c) table
    of distinct non-NaN values and their row counts."""
    keys = list(keys)
    cum = global_rank(dist, [F.col("_v").asc()], keys, "_r", sum_cols=["_c"], num_partitions=num_partitions)
    counts = dist.groupBy(*keys).agg(F.sum("_c").alias("_n"))
    qs = dist.sparkSession.createDataFrame([(i, float(p)) for i, p in enumerate(probs)], "q_index int, prob double")
    targets = counts.crossJoin(F.broadcast(qs)).select(
        *keys,
        "_n",
        "q_index",
        "prob",
        # NumPy's virtual index for method 'linear': (n - 1) * q
        ((F.col("_n") - 1).cast("double") * F.col("prob")).alias("_h"),
    ).select(
        "*",
        (F.floor("_h") + 1).cast("long").alias("_lo"),
        F.least(F.floor("_h") + 2, F.col("_n")).cast("long").alias("_hi"),
    )
    # one row per (group, feature) holding its <= len(probs) targets
    tarr = targets.groupBy(*keys).agg(F.collect_list(F.struct("q_index", "_lo", "_hi")).alias("_t"))
    j = join_per_group(cum, tarr, keys)
    start = F.col("_c_cum") - F.col("_c")

    def covers(t, pos: str):
        return (t[pos] > start) & (t[pos] <= F.col("_c_cum"))

    # one pass over the ranked distinct values: every target position that a
    # value covers, as the low and/or high neighbour of its quantile
    vals = (
        j.select(*keys, "_v", "_c", "_c_cum", F.explode(F.filter("_t", lambda t: covers(t, "_lo") | covers(t, "_hi"))).alias("_x"))
        .select(
            *keys,
            F.col("_x.q_index").alias("q_index"),
            F.when(covers(F.col("_x"), "_lo"), F.col("_v")).alias("_l"),
            F.when(covers(F.col("_x"), "_hi"), F.col("_v")).alias("_u"),
        )
        .groupBy(*keys, "q_index")
        .agg(F.max("_l").alias("_vlo"), F.max("_u").alias("_vhi"))
    )
    res = join_keys(targets, vals, [*keys, "q_index"], "left")
    frac = F.col("_h") - F.floor("_h")
    # NumPy's lerp: a + (b-a)*t, or b - (b-a)*(1-t) when t >= 0.5
    diff = F.col("_vhi") - F.col("_vlo")
    value = F.when(frac >= 0.5, F.col("_vhi") - diff * (F.lit(1.0) - frac)).otherwise(F.col("_vlo") + diff * frac)
    return res.select(*keys, "q_index", "prob", value.alias("value"))
