"""Drift monitoring: population stability index, categorical shift, the
drift table over all columns (one job per side, not one per column),
distribution comparison, monitoring report and retraining triggers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkexp.session import cut_lineage
from sparkexp.operators.joins import join_keys, join_per_group
from sparkexp.operators.ordering import quantiles_from_counts

EPSILON = 1e-6
HIGH, MEDIUM = 0.20, 0.10
SEVERITY = {"high": 3, "medium": 2, "low": 1, "unknown": 0}


def _keys(group_cols: Sequence[str]) -> list[str]:
    return [*group_cols, "feature"]


def _double(df: DataFrame, c: str) -> Column:
    """Text that is no number is NULL; other types are cast as they are."""
    return F.col(c).try_cast("double") if dict(df.dtypes)[c] == "string" else F.col(c).cast("double")


def _numeric_long(df: DataFrame, cols: Sequence[str], group_cols: Sequence[str]) -> DataFrame:
    pairs = F.array(
        *[F.struct(F.lit(c).alias("feature"), _double(df, c).alias("_v")) for c in cols]
    )
    return df.select(*group_cols, F.inline(pairs)).where(F.col("_v").isNotNull() & ~F.isnan("_v"))


def _value_counts(df: DataFrame, cols: Sequence[str], group_cols: Sequence[str]) -> DataFrame:
    """(group..., feature, _v, _c): distinct usable values and their row
    counts; repeats are merged map-side before the shuffle."""
    long = _numeric_long(df, cols, group_cols)
    return long.groupBy(*_keys(group_cols), "_v").agg(F.count(F.lit(1)).alias("_c"))


def psi_edges(
    expected: DataFrame,
    cols: Sequence[str],
    bins: int = 10,
    group_cols: Sequence[str] = (),
    value_counts: DataFrame | None = None,
) -> DataFrame:
    """Unique decile edges of the expected side (NumPy 'linear' quantiles).
    ``value_counts`` (from ``_value_counts``) saves a pass when the caller
    already has it."""
    probs = [i / bins for i in range(bins + 1)]
    dist = value_counts if value_counts is not None else cut_lineage(
        _value_counts(expected, cols, group_cols)
    )
    q = quantiles_from_counts(dist, _keys(group_cols), probs, group_cols)
    return q.groupBy(*_keys(group_cols)).agg(F.array_sort(F.array_distinct(F.collect_list("value"))).alias("edges"))


def _bin_of(v: Column, edges: Column, max_edges: int) -> Column:
    """np.histogram bin of ``v``: [e_i, e_i+1), last bin closed; NULL if outside.

    Counts the edges <= v with one comparison per edge slot (codegen'd; no
    per-row lambda)."""
    nb = F.size(edges) - 1
    le = None
    for i in range(1, max_edges + 1):
        t = F.when(F.try_element_at(edges, F.lit(i)) <= v, F.lit(1)).otherwise(F.lit(0))
        le = t if le is None else le + t
    inside = (v >= F.element_at(edges, 1)) & (v <= F.element_at(edges, -1))
    return F.when(inside, F.least(le - 1, nb - 1))


def population_stability_index(
    expected: DataFrame,
    actual: DataFrame,
    cols: Sequence[str],
    bins: int = 10,
    group_cols: Sequence[str] = (),
    epsilon: float = EPSILON,
) -> DataFrame:
    """PSI per numeric column: sum (a - e) * ln(a / e) over the expected
    decile bins, shares (count + eps) / (in-range total + eps * bins).

    NULL when either side is empty or there are fewer than 3 unique edges.
    Values of the actual side outside the expected range are ignored.
    """
    keys = _keys(group_cols)
    # The expected side is read once: its (value, count) table feeds both the
    # exact deciles and the expected bin counts.
    e_dist = cut_lineage(_value_counts(expected, cols, group_cols))
    # one row per (group, feature) with at most bins+1 edges (bounded by the
    # feature count when ungrouped); materialised once, then broadcast
    edges = cut_lineage(psi_edges(expected, cols, bins, group_cols, e_dist).where(F.size("edges") >= 3))
    a_long = _numeric_long(actual, cols, group_cols).withColumn("_c", F.lit(1))

    def counts(vals: DataFrame, name: str) -> DataFrame:
        # left join: values of features without usable edges still count as
        # non-empty input (bin NULL), so one aggregate gives bins and totals
        j = join_per_group(vals, edges, keys, how="left")
        b = j.select(*keys, _bin_of(F.col("_v"), F.col("edges"), bins + 1).alias("bin"), "_c")
        return cut_lineage(b.groupBy(*keys, "bin").agg(F.sum("_c").alias(name)))

    all_bins = edges.select(*keys, F.explode(F.sequence(F.lit(0), F.size("edges") - 2)).alias("bin"))
    e_all, a_all = counts(e_dist, "_e"), counts(a_long, "_a")
    e_cnt, a_cnt = e_all.where(F.col("bin").isNotNull()), a_all.where(F.col("bin").isNotNull())
    m = join_keys(join_keys(all_bins, e_cnt, [*keys, "bin"], "left"), a_cnt, [*keys, "bin"], "left")
    m = m.select(*keys, "bin", F.coalesce("_e", F.lit(0)).alias("_e"), F.coalesce("_a", F.lit(0)).alias("_a"))
    w = Window.partitionBy(*keys)
    nb = F.count(F.lit(1)).over(w)
    te, ta = F.sum("_e").over(w), F.sum("_a").over(w)
    m = m.select(
        *keys,
        ((F.col("_e") + epsilon) / (te + epsilon * nb)).alias("_pe"),
        ((F.col("_a") + epsilon) / (ta + epsilon * nb)).alias("_pa"),
        te.alias("_te"),
        ta.alias("_ta"),
    )
    psi = m.groupBy(*keys).agg(
        F.sum((F.col("_pa") - F.col("_pe")) * F.log(F.col("_pa") / F.col("_pe"))).alias("_psi"),
        F.max("_te").alias("_te"),
        F.max("_ta").alias("_ta"),
    )
    # Every requested column gets a row; NULL where PSI is undefined.
    spark = expected.sparkSession
    feats = spark.createDataFrame([(c,) for c in cols], "feature string")
    if group_cols:
        feats = expected.select(*group_cols).distinct().crossJoin(F.broadcast(feats))
    e_n = e_all.groupBy(*keys).agg(F.sum("_e").alias("_ne"))
    a_n = a_all.groupBy(*keys).agg(F.sum("_a").alias("_na"))
    out = feats
    for part in (psi, e_n, a_n):
        out = join_keys(out, part, keys, "left")
    ok = (F.coalesce("_ne", F.lit(0)) > 0) & (F.coalesce("_na", F.lit(0)) > 0)
    return out.select(*keys, F.when(ok, F.col("_psi")).alias("psi"))


def categorical_shift(
    expected: DataFrame, actual: DataFrame, cols: Sequence[str], group_cols: Sequence[str] = (), null_token: str = "nan"
) -> DataFrame:
    """Half the L1 distance between category shares (NULL is its own category)."""
    keys = _keys(group_cols)

    def levels(df: DataFrame, side: str) -> DataFrame:
        pairs = F.array(
            *[F.struct(F.lit(c).alias("feature"), F.coalesce(F.col(c).cast("string"), F.lit(null_token)).alias("value")) for c in cols]
        )
        ones = [(F.lit(1) if s == side else F.lit(0)).cast("long").alias(s) for s in ("_e", "_a")]
        return df.select(*group_cols, F.inline(pairs), *ones)

    # Both sides in one aggregate; totals are a second one over its few rows, so
    # a column with as many levels as rows is still spread over all tasks.
    both = levels(expected, "_e").unionByName(levels(actual, "_a"))
    cnt = both.groupBy(*keys, "value").agg(F.sum("_e").alias("_e"), F.sum("_a").alias("_a"))
    tot = cnt.groupBy(*keys).agg(F.sum("_e").alias("_te"), F.sum("_a").alias("_ta"))
    share = lambda n, t: F.coalesce(F.col(n) / F.nullif(F.col(t), F.lit(0)), F.lit(0.0))
    diff = F.abs(share("_e", "_te") - share("_a", "_ta"))
    return join_keys(cnt, tot, keys).groupBy(*keys).agg((F.sum(diff) * 0.5).alias("shift"))


def drift_level(score: Column) -> Column:
    return (
        F.when(score.isNull(), F.lit("unknown"))
        .when(score > HIGH, F.lit("high"))
        .when(score > MEDIUM, F.lit("medium"))
        .otherwise(F.lit("low"))
    )


def severity_rank(level: Column) -> Column:
    expr = None
    for k, v in SEVERITY.items():
        expr = F.when(level == k, F.lit(v)) if expr is None else expr.when(level == k, F.lit(v))
    return expr.otherwise(F.lit(0))


def _is_numeric(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, T.NumericType)


def drift_table(
    expected: DataFrame,
    actual: DataFrame,
    cols: Sequence[str] | None = None,
    group_cols: Sequence[str] = (),
    bins: int = 10,
) -> DataFrame:
    """Drift score and level for every common column (type from the expected
    side: numeric -> PSI, else categorical shift), sorted by severity then
    score, both descending."""
    common = [c for c in (cols or expected.columns) if c in actual.columns and c not in group_cols]
    num = [c for c in common if _is_numeric(expected, c)]
    cat = [c for c in common if c not in num]
    keys = _keys(group_cols)
    parts = []
    if num:
        p = population_stability_index(expected, actual, num, bins, group_cols)
        parts.append(p.select(*keys, F.lit("numeric").alias("feature_type"), F.col("psi").alias("drift_score")))
    if cat:
        s = categorical_shift(expected, actual, cat, group_cols)
        parts.append(s.select(*keys, F.lit("categorical").alias("feature_type"), F.col("shift").alias("drift_score")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    out = out.withColumnRenamed("feature", "feature_name").withColumn("drift_level", drift_level(F.col("drift_score")))
    return out.orderBy(
        *group_cols, severity_rank(F.col("drift_level")).desc(), F.col("drift_score").desc_nulls_last(), "feature_name"
    )


def density_comparison(
    expected: DataFrame,
    actual: DataFrame,
    cols: Sequence[str] | None = None,
    bins: int = 20,
) -> DataFrame:
    """Train-vs-recent histograms on shared edges for ``cols`` (default: all
    numeric columns), the data behind a density plot: per bin, the share of each
    side."""
    num = [c for c in (cols or expected.columns) if _is_numeric(expected, c) and c in actual.columns]
    e = _numeric_long(expected, num, ()).withColumn("side", F.lit("train"))
    a = _numeric_long(actual, num, ()).withColumn("side", F.lit("recent"))
    both = e.unionByName(a)
    rng = both.groupBy("feature").agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    j = both.join(F.broadcast(rng), "feature")
    width = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    b = F.when(F.col("_hi") == F.col("_lo"), F.lit(0)).otherwise(
        F.least(F.floor((F.col("_v") - F.col("_lo")) / width), F.lit(bins - 1))
    ).cast("int")
    cnt = j.select("feature", "side", b.alias("bin"), "_lo", "_hi").groupBy("feature", "bin", "_lo", "_hi").agg(
        F.count_if(F.col("side") == "train").alias("_t"), F.count_if(F.col("side") == "recent").alias("_r")
    )
    w = Window.partitionBy("feature")
    return cnt.select(
        "feature",
        "bin",
        (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("bin") / F.lit(float(bins))).alias("bin_low"),
        (F.col("_t") / F.sum("_t").over(w)).alias("train_share"),
        (F.col("_r") / F.sum("_r").over(w)).alias("recent_share"),
    )


def monitoring_report(
    train: DataFrame,
    recent_scored: DataFrame,
    drift: DataFrame,
    prob_col: str = "churn_probability",
    label_col: str = "predicted_label",
    ratio_trigger: float = 0.25,
    risk_trigger: float = 0.45,
) -> DataFrame:
    """One-row report: sizes, mean probability, high-risk rate, drift counts,
    high-drift ratio (denominator at least 1) and the retrain flags."""
    n_train = train.agg(F.count(F.lit(1)).alias("train_samples"))
    sc = recent_scored.agg(
        F.count(F.lit(1)).alias("recent_samples"),
        F.avg(F.col(prob_col).cast("double")).alias("mean_probability"),
        F.avg((F.col(label_col) == 1).cast("double")).alias("high_risk_rate"),
    )
    dr = drift.agg(
        F.count_if(F.col("drift_level") == "high").alias("high_drift_features"),
        F.count_if(F.col("drift_level") == "medium").alias("medium_drift_features"),
        F.count(F.lit(1)).alias("_nf"),
    )
    r = n_train.crossJoin(sc).crossJoin(dr)
    ratio = F.col("high_drift_features") / F.greatest(F.col("_nf"), F.lit(1))
    r = r.withColumn("high_drift_ratio", ratio)
    drift_flag = F.col("high_drift_ratio") >= F.lit(ratio_trigger)
    risk_flag = F.coalesce(F.col("high_risk_rate") >= F.lit(risk_trigger), F.lit(False))
    return r.select(
        "train_samples",
        "recent_samples",
        "mean_probability",
        "high_risk_rate",
        "high_drift_features",
        "medium_drift_features",
        "high_drift_ratio",
        drift_flag.alias("drift_trigger"),
        risk_flag.alias("risk_trigger"),
        (drift_flag | risk_flag).alias("retrain_recommended"),
    )


def retrain_triggers(
    current: DataFrame,
    baseline: DataFrame,
    key_cols: Sequence[str] = (),
    drift_share: float = 0.25,
    cost_increase: float = 0.20,
    max_days: int = 30,
    auuc_drop: float = 0.10,
    calibration_increase: float = 0.20,
    mix_shift: float = 0.10,
) -> DataFrame:
    """Compare a current metrics row with its baseline and raise the written
    retraining policy flags. Expected columns (missing ones give NULL flags):
    high_drift_share, cost_per_1000, days_since_retrain, auuc, calibration,
    segment_mix_shift. A NULL key is a key; one without a baseline keeps its row, with
    NULL for the flags that compare."""

    def col(df: DataFrame, c: str) -> Column:
        return F.col(c) if c in df.columns else F.lit(None).cast("double")

    cur = current.select(*key_cols, *[col(current, c).alias(f"cur_{c}") for c in (
        "high_drift_share", "cost_per_1000", "days_since_retrain", "auuc", "calibration", "segment_mix_shift")])
    base = baseline.select(*key_cols, *[col(baseline, c).alias(f"base_{c}") for c in ("cost_per_1000", "auuc", "calibration")])
    j = join_keys(cur, base, key_cols, "left")
    flags = {
        "drift_flag": F.col("cur_high_drift_share") > drift_share,
        "cost_flag": F.col("cur_cost_per_1000") >= F.col("base_cost_per_1000") * (1 + cost_increase),
        "age_flag": F.col("cur_days_since_retrain") >= max_days,
        "auuc_flag": F.col("cur_auuc") <= F.col("base_auuc") * (1 - auuc_drop),
        "calibration_flag": F.col("cur_calibration") >= F.col("base_calibration") * (1 + calibration_increase),
        "mix_flag": F.col("cur_segment_mix_shift") > mix_shift,
    }
    out = j.select(*key_cols, *[v.alias(k) for k, v in flags.items()])
    anyf = None
    for k in flags:
        c = F.coalesce(F.col(k), F.lit(False))
        anyf = c if anyf is None else (anyf | c)
    return out.withColumn("retrain", anyf)
