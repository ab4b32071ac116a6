"""Profiling and data quality: data dictionary, null profile, duplicates,
label balance, leakage flags, split summary, correlation matrix.

Per-column loops become one job: columns are unpivoted to (column, value)
pairs and aggregated together; correlations are all pairs in one aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Leakage name tokens of the experiment loader and of the churn notebook.
LEAKAGE_TOKENS = ("purchase", "added_to_cart", "scrolled", "time_on_page", "datetime")
CHURN_LEAKAGE_TOKENS = ("churn", "cancel", "target", "label")


def _long(df: DataFrame, cols: Sequence[str], order_col: str | None) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols])
    extra = [F.col(order_col).alias("_o")] if order_col else []
    return df.select(*extra, F.inline(pairs))


def _value_stats(df: DataFrame, cols: Sequence[str], approx: bool) -> DataFrame:
    long = _long(df, cols, None)
    if approx:
        return long.groupBy("column").agg(
            F.count_if(F.col("value").isNull()).alias("n_missing"),
            F.approx_count_distinct("value").alias("n_unique"),
            F.count(F.lit(1)).alias("_n"),
        )
    per_value = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("_c"))
    return per_value.groupBy("column").agg(
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("_c"))), F.lit(0)).alias("n_missing"),
        F.count_if(F.col("value").isNotNull()).alias("n_unique"),
        F.sum("_c").alias("_n"),
    )


def data_dictionary(
    df: DataFrame, order_col: str | None = None, approx: bool = False, n_samples: int = 3
) -> DataFrame:
    """Per column: dtype, n_missing, missing_pct (x100), n_unique (non-null),
    the first ``n_samples`` non-null values (by ``order_col``, else by value)
    joined with ', '; sorted by column name. ``approx=True`` uses HyperLogLog."""
    cols = df.columns
    spark = df.sparkSession
    types = spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in df.schema.fields], "column string, dtype string")
    stats = _value_stats(df, cols, approx)
    long = _long(df, cols, order_col).where(F.col("value").isNotNull())
    okey = [F.col("_o").asc()] if order_col else []
    w = Window.partitionBy("column").orderBy(*okey, F.col("value").asc())
    top = long.withColumn("_k", F.row_number().over(w)).where(F.col("_k") <= n_samples)
    samples = top.groupBy("column").agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("_k", "value"))), lambda s: s["value"]), ", "
        ).alias("sample_values")
    )
    out = types.join(stats, "column", "left").join(samples, "column", "left")
    return out.select(
        "column",
        "dtype",
        F.coalesce("n_missing", F.lit(0)).alias("n_missing"),
        (F.coalesce("n_missing", F.lit(0)) / F.nullif(F.col("_n"), F.lit(0)) * 100.0).alias("missing_pct"),
        F.coalesce("n_unique", F.lit(0)).alias("n_unique"),
        F.coalesce("sample_values", F.lit("")).alias("sample_values"),
    ).orderBy("column")


def profile_nulls(df: DataFrame, approx: bool = False) -> DataFrame:
    """dtype, null count and fraction, distinct count per column; sorted by
    nulls desc, then distinct desc."""
    spark = df.sparkSession
    types = spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in df.schema.fields], "column string, dtype string")
    s = types.join(_value_stats(df, df.columns, approx), "column", "left")
    return s.select(
        F.col("column").alias("feature"),
        "dtype",
        F.col("n_missing").alias("null_count"),
        (F.col("n_missing") / F.nullif(F.col("_n"), F.lit(0))).alias("null_pct"),
        "n_unique",
    ).orderBy(F.col("null_count").desc(), F.col("n_unique").desc(), "feature")


def duplicate_report(df: DataFrame, id_col: str | None = None) -> DataFrame:
    """Rows that repeat an earlier full row, and ids that repeat an earlier id."""
    rows = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_c")).agg(
        F.coalesce(F.sum(F.col("_c") - 1), F.lit(0)).alias("duplicate_rows"), F.sum("_c").alias("n_rows")
    )
    if id_col is None:
        return rows.withColumn("duplicate_ids", F.lit(None).cast("long"))
    ids = df.groupBy(id_col).agg(F.count(F.lit(1)).alias("_c")).agg(
        F.coalesce(F.sum(F.col("_c") - 1), F.lit(0)).alias("duplicate_ids")
    )
    return rows.crossJoin(ids)


def label_balance(df: DataFrame, label_col: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """Normalised value counts of a label (NULL excluded, as value_counts does)."""
    c = df.where(F.col(label_col).isNotNull()).groupBy(*group_cols, label_col).agg(F.count(F.lit(1)).alias("count"))
    w = Window.partitionBy(*group_cols)
    return c.withColumn("share", F.col("count") / F.sum("count").over(w))


def leakage_report(
    df: DataFrame, target_col: str | None = None, tokens: Sequence[str] = LEAKAGE_TOKENS
) -> DataFrame:
    """Flag columns whose lower-cased name contains a leakage token; numeric
    columns also carry their Pearson correlation with the target."""
    spark = df.sparkSession
    rows = []
    for c in df.columns:
        risk = any(t in c.lower() for t in tokens)
        rows.append((c, risk, "name_suggests_outcome" if risk else "name_is_neutral"))
    flags = spark.createDataFrame(rows, "column string, is_potential_leakage boolean, reason string")
    if target_col is not None:
        flags = flags.where(F.col("column") != target_col)
    if target_col is None:
        return flags.withColumn("target_corr", F.lit(None).cast("double"))
    num = [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name != target_col
    ]
    if not num:
        return flags.withColumn("target_corr", F.lit(None).cast("double"))
    y = F.col(target_col).cast("double")
    corr = df.agg(*[F.corr(F.col(c).cast("double"), y).alias(c) for c in num])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("target_corr")) for c in num])
    corr_long = corr.select(F.inline(pairs))
    return flags.join(corr_long, "column", "left")


def split_summary(
    df: DataFrame, split_col: str, treatment_col: str | None = None, outcome_col: str | None = None
) -> DataFrame:
    aggs: list[Column] = [F.count(F.lit(1)).alias("rows")]
    if treatment_col:
        aggs.append(F.avg(F.col(treatment_col).cast("double")).alias("treatment_rate"))
    if outcome_col:
        aggs.append(F.avg(F.col(outcome_col).cast("double")).alias("outcome_rate"))
    return df.groupBy(split_col).agg(*aggs)


def correlation_matrix(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Pairwise Pearson correlation (pairwise-complete rows), long form,
    all pairs in one aggregate."""
    num = list(cols) if cols else [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    exprs, names = [], []
    for i, a in enumerate(num):
        for b in num[i:]:
            names.append((a, b))
            exprs.append(F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"_c{len(exprs)}"))
    agg = df.agg(*exprs)
    pairs = []
    for k, (a, b) in enumerate(names):
        pairs.append(F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.col(f"_c{k}").alias("corr")))
        if a != b:
            pairs.append(F.struct(F.lit(b).alias("col_a"), F.lit(a).alias("col_b"), F.col(f"_c{k}").alias("corr")))
    return agg.select(F.inline(F.array(*pairs)))
