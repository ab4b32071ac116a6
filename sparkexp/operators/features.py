"""Feature preparation, fitted on train and applied anywhere.

Statistics are plain aggregates (exact median via the distributed
quantile, mode via a grouped count, population mean / sd); the fitted
transform is a pipeline of built-in stages — an ``SQLTransformer`` that
imputes and scales, ``StringIndexer`` + ``OneHotEncoder`` for categories and a
``VectorAssembler`` — so it stays JVM-side and saves/loads natively.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkexp.operators.ordering import exact_quantiles


def _q(name: str) -> str:
    return f"`{name}`"


def _lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return repr(float(v))


def split_roles(df: DataFrame, feature_cols: Sequence[str]) -> tuple[list[str], list[str]]:
    """(numeric, categorical) by column type, as the single-table version does."""
    num = [c for c in feature_cols if isinstance(df.schema[c].dataType, T.NumericType)]
    cat = [c for c in feature_cols if c not in num]
    return num, cat


def fit_medians(train: DataFrame, cols: Sequence[str], exact: bool = True) -> DataFrame:
    """(feature, median) per column; exact (NumPy-style) or approximate."""
    if not cols:
        return train.sparkSession.createDataFrame([], "feature string, median double")
    if exact:
        q = exact_quantiles(_around_medians(train, cols), cols, [0.5])
        return q.select("feature", F.col("value").alias("median"))
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("_v")) for c in cols])
    long = train.select(F.inline(pairs))
    return long.groupBy("feature").agg(F.percentile_approx("_v", 0.5, 10000).alias("median"))


def _around_medians(train: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``cols`` with values far below or above the median replaced by -/+ infinity, which
    leaves the median as it is and few distinct values to shuffle and rank. The bounds
    are approximate quantiles; a column whose median the counted rows do not put between
    them is left as it is."""
    v = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in cols}
    near = train.agg(*[F.percentile_approx(v[c], [0.495, 0.505], 2000).alias(c) for c in cols]).first()  # one row
    bounds = {c: near[c] for c in cols if near[c]}
    counts = [F.count(v[c]).alias(f"n_{c}") for c in bounds]
    counts += [F.count_if(v[c] < F.lit(lo)).alias(f"below_{c}") for c, (lo, _) in bounds.items()]
    counts += [F.count_if(v[c] > F.lit(hi)).alias(f"above_{c}") for c, (_, hi) in bounds.items()]
    n = train.agg(*counts).first() if counts else {}  # one row
    out = []
    for c in cols:
        # The median lies between the values at two places, and both must keep theirs.
        if c in bounds and n[f"below_{c}"] <= (k := (n[f"n_{c}"] - 1) // 2) and n[f"above_{c}"] <= max(n[f"n_{c}"] - k - 2, 0):
            lo, hi = bounds[c]
            out.append(F.when(v[c] < F.lit(lo), F.lit(float("-inf"))).when(v[c] > F.lit(hi), F.lit(float("inf"))).otherwise(v[c]).alias(c))
        else:
            out.append(F.col(c))
    return train.select(*out)


def fit_modes(train: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(feature, mode): most frequent non-null value, smallest on ties."""
    if not cols:
        return train.sparkSession.createDataFrame([], "feature string, mode string")
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("_v")) for c in cols])
    cnt = train.select(F.inline(pairs)).where(F.col("_v").isNotNull()).groupBy("feature", "_v").count()
    w = Window.partitionBy("feature").orderBy(F.col("count").desc(), F.col("_v").asc())
    return cnt.withColumn("_k", F.row_number().over(w)).where("_k = 1").select("feature", F.col("_v").alias("mode"))


def impute_median(train: DataFrame, df: DataFrame, cols: Sequence[str], exact: bool = True) -> DataFrame:
    med = dict(fit_medians(train, cols, exact).collect())  # one row per column
    return df.select(*[F.coalesce(F.col(c).cast("double"), F.lit(med.get(c))).alias(c) if c in cols else F.col(c) for c in df.columns])


def impute_mode(train: DataFrame, df: DataFrame, cols: Sequence[str]) -> DataFrame:
    mode = dict(fit_modes(train, cols).collect())  # one row per column
    return df.select(*[F.coalesce(F.col(c).cast("string"), F.lit(mode.get(c))).alias(c) if c in cols else F.col(c) for c in df.columns])


def fit_scaler(train: DataFrame, cols: Sequence[str], medians: dict[str, float] | None = None) -> dict[str, tuple[float, float]]:
    """Population mean and sd of each (median-imputed) column; sd 0 -> 1."""
    if not cols:
        return {}
    medians = medians or {}
    exprs = []
    for c in cols:
        v = F.coalesce(F.col(c).cast("double"), F.lit(medians.get(c)))
        exprs += [F.avg(v).alias(f"m_{c}"), F.stddev_pop(v).alias(f"s_{c}")]
    row = train.agg(*exprs).collect()[0]  # one row
    out = {}
    for c in cols:
        m, s = row[f"m_{c}"], row[f"s_{c}"]
        out[c] = (m if m is not None else 0.0, s if s not in (None, 0.0) else 1.0)
    return out


def standardize(train: DataFrame, df: DataFrame, cols: Sequence[str]) -> DataFrame:
    st = fit_scaler(train, cols)
    return df.select(
        *[((F.col(c).cast("double") - F.lit(st[c][0])) / F.lit(st[c][1])).alias(c) if c in cols else F.col(c) for c in df.columns]
    )


def one_hot_levels(train: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(feature, level, index): the alphabetical level order the encoder uses."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("level")) for c in cols])
    lv = train.select(F.inline(pairs)).where(F.col("level").isNotNull()).distinct()
    w = Window.partitionBy("feature").orderBy("level")
    return lv.withColumn("index", (F.row_number().over(w) - 1).cast("int"))


def build_preprocessor(
    train: DataFrame,
    numeric_cols: Sequence[str],
    categorical_cols: Sequence[str],
    output_col: str = "features",
    exact_median: bool = True,
) -> PipelineModel:
    """Fit the numeric branch (median impute, population standardise) and
    the categorical branch (mode impute, one-hot with all levels kept and
    unknown levels as all zeros), concatenated into one vector column."""
    # The columns that are fitted, for the five passes over them.
    train = train.select(*dict.fromkeys([*numeric_cols, *categorical_cols])).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _fit_preprocessor(train, numeric_cols, categorical_cols, output_col, exact_median)
    finally:
        train.unpersist()


def _fit_preprocessor(
    train: DataFrame, numeric_cols: Sequence[str], categorical_cols: Sequence[str], output_col: str, exact_median: bool
) -> PipelineModel:
    med = dict(fit_medians(train, numeric_cols, exact_median).collect()) if numeric_cols else {}
    modes = dict(fit_modes(train, categorical_cols).collect()) if categorical_cols else {}
    scale = fit_scaler(train, numeric_cols, med)
    sel = ["*"]
    for c in numeric_cols:
        m, s = scale[c]
        sel.append(f"(coalesce(CAST({_q(c)} AS DOUBLE), {_lit(med.get(c))}) - {_lit(m)}) / {_lit(s)} AS {_q(c + '__num')}")
    for c in categorical_cols:
        sel.append(f"coalesce(CAST({_q(c)} AS STRING), {_lit(modes.get(c))}) AS {_q(c + '__cat')}")
    sqlt = SQLTransformer(statement=f"SELECT {', '.join(sel)} FROM __THIS__")
    stages = [sqlt]
    vec_inputs = [c + "__num" for c in numeric_cols]
    if categorical_cols:
        idx = StringIndexer(
            inputCols=[c + "__cat" for c in categorical_cols],
            outputCols=[c + "__idx" for c in categorical_cols],
            handleInvalid="keep",
            stringOrderType="alphabetAsc",
        )
        prepared = sqlt.transform(train)
        idx_model = idx.fit(prepared)
        ohe = OneHotEncoder(
            inputCols=[c + "__idx" for c in categorical_cols],
            outputCols=[c + "__ohe" for c in categorical_cols],
            # the indexer's metadata has k labels + '__unknown'; dropping the
            # last slot leaves k columns and all zeros for unseen levels
            dropLast=True,
        )
        ohe_model = ohe.fit(idx_model.transform(prepared))
        stages += [idx_model, ohe_model]
        vec_inputs += [c + "__ohe" for c in categorical_cols]
    stages.append(VectorAssembler(inputCols=vec_inputs, outputCol=output_col, handleInvalid="keep"))
    return PipelineModel(stages=stages)
