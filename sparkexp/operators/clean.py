"""Table-level cleaning: the churn cleaner, feature selection, schema
alignment for scoring, and the experiment feature engineering.

All narrow transformations (no shuffle) except ``drop_duplicate_rows``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkexp.functions import scalars as S

# Columns of the churn and experiment tables with special roles.
CHURN_TARGET = "Churn"
CHURN_ID = "customerID"
EXPERIMENT_NON_FEATURES = ("user_id", "treatment", "converted", "revenue")


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """Full-row distinct, id column included (run before the id is dropped)."""
    return df.dropDuplicates()


def clean_churn_frame(
    df: DataFrame,
    target: str = CHURN_TARGET,
    numeric_text_cols: Sequence[str] = ("TotalCharges",),
    category_cols: Sequence[str] = ("SeniorCitizen",),
) -> DataFrame:
    """Trim names, coerce numeric text (bad -> NULL), flags to text, encode
    the yes/no target and drop rows whose target is not yes/no, then drop
    duplicate rows."""
    out = S.trim_column_names(df)
    for c in numeric_text_cols:
        if c in out.columns:
            out = out.withColumn(c, S.to_number_or_null(c))
    for c in category_cols:
        if c in out.columns:
            out = out.withColumn(c, S.as_category(c))
    if target in out.columns:
        out = out.withColumn(target, S.encode_label(target)).where(F.col(target).isNotNull())
    return drop_duplicate_rows(out)


def select_features(df: DataFrame, drop: Sequence[str] = (CHURN_TARGET, CHURN_ID)) -> DataFrame:
    """Everything except the target / id / bookkeeping columns."""
    keep = [c for c in df.columns if c not in set(drop)]
    return df.select(*keep)


def align_schema(
    df: DataFrame,
    expected: T.StructType | Sequence[tuple[str, str]],
    numeric_text_cols: Sequence[str] = ("TotalCharges",),
    category_cols: Sequence[str] = ("SeniorCitizen",),
) -> DataFrame:
    """Scoring-time schema: missing expected columns added as NULL, extras
    dropped, expected order restored, then the cleaning coercions re-applied.
    A missing categorical column stays NULL (it is not turned into text)."""
    return df.select(*align_columns(df, expected, numeric_text_cols, category_cols))


def align_columns(
    df: DataFrame,
    expected: T.StructType | Sequence[tuple[str, str]],
    numeric_text_cols: Sequence[str] = ("TotalCharges",),
    category_cols: Sequence[str] = ("SeniorCitizen",),
) -> list:
    fields = [(f.name, f.dataType.simpleString()) for f in expected.fields] if isinstance(expected, T.StructType) else list(expected)
    present = set(df.columns)
    cols = []
    for name, dtype in fields:
        if name in present:
            c = F.col(name)
            if name in numeric_text_cols:
                c = S.to_number_or_null(c)
            elif name in category_cols:
                c = F.col(name).cast("string")
            else:
                c = c.cast(dtype)
        else:
            c = F.lit(None).cast(dtype)
        cols.append(c.alias(name))
    return cols


def engineer_experiment_features(df: DataFrame) -> DataFrame:
    """Derived experiment features: age band code, weekend, iOS, cyclical
    hour, returning x iOS; only for the source columns that exist."""
    out = df
    cols = set(df.columns)
    if "age_group" in cols:
        out = out.withColumn("age_group", F.regexp_replace(F.col("age_group").cast("string"), "–", "-"))
        out = out.withColumn("age_group_code", S.ordinal_map("age_group"))
    if "visit_weekday" in cols:
        out = out.withColumn("is_weekend", S.is_weekend("visit_weekday"))
    if "device_type" in cols:
        out = out.withColumn("is_ios", S.is_ios("device_type"))
    if "visit_hour" in cols:
        s, c = S.cyclical_encode("visit_hour")
        out = out.withColumn("visit_hour_sin", s).withColumn("visit_hour_cos", c)
    if "previous_app_user" in cols and "is_ios" in out.columns:
        out = out.withColumn("returning_ios", S.interaction("previous_app_user", "is_ios"))
    return out


def load_experiment_frame(raw: DataFrame, tokens: Sequence[str] = S.UPLIFT_TREATMENT_TOKENS) -> DataFrame:
    """Raw experiment rows (group text, converted, visit date/time text ...)
    to the curated table: treatment, user_type, weekday, hour, derived flags."""
    weekday, hour = S.parse_visit_time("visit_date", "visit_time")
    norm = F.lower(F.trim(F.col("group").cast("string")))
    out = raw.select(
        F.col("user_id"),
        F.coalesce(norm.isin(list(tokens)), F.lit(False)).cast("int").alias("treatment"),
        F.col("converted").cast("int").alias("converted"),
        *[F.col(c) for c in ("age_group", "gender", "device_type", "previous_app_user", "previous_product_buyer") if c in raw.columns],
        weekday.alias("visit_weekday"),
        hour.alias("visit_hour"),
        S.user_type("previous_app_user").alias("user_type"),
    )
    return engineer_experiment_features(out)
