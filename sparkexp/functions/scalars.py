"""Row-level column functions (cleaning, encodings, derived flags).

All of them are built-in Spark expressions, so they stay inside whole-stage
codegen; none needs a Python UDF.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Treatment tokens accepted by the A/B encoder, and the extra
# token the uplift loader also accepts.
TREATMENT_TOKENS = ("1", "b", "treatment", "test", "variant", "yes", "true")
UPLIFT_TREATMENT_TOKENS = ("1", "b", "treatment", "test", "variant", "yes", "true", "blue")

# Age bands and their ordinal codes (unknown -> 0).
AGE_BAND_CODES = {"18-24": 1, "25-34": 2, "35-44": 3, "45-54": 4, "55+": 5}

WEEKEND_DAYS = ("Saturday", "Sunday")


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def trim_column_names(df: DataFrame) -> DataFrame:
    """Strip surrounding whitespace from every column name."""
    return df.toDF(*[c.strip() for c in df.columns])


def to_number_or_null(col: Column | str) -> Column:
    """Text to double; unparsable text (including blanks) becomes NULL."""
    return _c(col).cast("string").try_cast("double")


def as_category(col: Column | str, null_token: str | None = "nan") -> Column:
    """Integer flag to a text category; NULL becomes ``null_token`` (pandas' ``str(nan)``)."""
    out = _c(col).cast("string")
    return F.coalesce(out, F.lit(null_token)) if null_token is not None else out


def encode_label(col: Column | str, positive: str = "yes", negative: str = "no") -> Column:
    """trim+lower; positive -> 1, negative -> 0, anything else -> NULL."""
    norm = F.lower(F.trim(_c(col).cast("string")))
    return F.when(norm == positive, F.lit(1)).when(norm == negative, F.lit(0)).cast("int")


def encode_treatment(df: DataFrame, col: str, tokens: Sequence[str] = TREATMENT_TOKENS) -> Column:
    """Binary arm flag (0 control / 1 treatment), decided by the column type.

    bool -> int; numeric -> ``value == 1``; text -> trimmed, lower-cased value in
    ``tokens``. NULL stays NULL (callers drop those rows first).
    """
    dtype = df.schema[col].dataType
    c = F.col(col)
    if isinstance(dtype, T.BooleanType):
        return c.cast("int")
    if isinstance(dtype, T.NumericType):
        return F.when(c.isNull(), F.lit(None)).otherwise((c == 1).cast("int")).cast("int")
    norm = F.lower(F.trim(c.cast("string")))
    return F.when(c.isNull(), F.lit(None)).otherwise(norm.isin(list(tokens)).cast("int")).cast("int")


def parse_visit_time(date_col: Column | str, time_col: Column | str) -> tuple[Column, Column]:
    """(weekday name or 'Unknown', hour of an ``HH:mm`` text or 12)."""
    ts = F.try_to_timestamp(_c(date_col).cast("string"))
    weekday = F.coalesce(F.date_format(ts, "EEEE"), F.lit("Unknown"))
    tm = F.try_to_timestamp(_c(time_col).cast("string"), F.lit("H:mm"))
    hour = F.coalesce(F.hour(tm), F.lit(12)).cast("int")
    return weekday, hour


def user_type(flag: Column | str) -> Column:
    return F.when(_c(flag).cast("int") == 1, F.lit("returning")).otherwise(F.lit("new"))


def is_weekend(weekday: Column | str) -> Column:
    return _c(weekday).isin(list(WEEKEND_DAYS)).cast("int")


def is_ios(device: Column | str) -> Column:
    return F.coalesce((_c(device).cast("string") == "iOS").cast("int"), F.lit(0))


def interaction(a: Column | str, b: Column | str) -> Column:
    return (_c(a).cast("int") * _c(b).cast("int")).cast("int")


def ordinal_map(col: Column | str, mapping: dict[str, int] | None = None, default: int = 0) -> Column:
    """En dash to hyphen, then map band -> code; unknown -> ``default``."""
    mapping = AGE_BAND_CODES if mapping is None else mapping
    norm = F.regexp_replace(_c(col).cast("string"), "–", "-")
    expr = None
    for k, v in mapping.items():
        expr = (F.when(norm == k, F.lit(v)) if expr is None else expr.when(norm == k, F.lit(v)))
    return (expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)).cast("int")


def cyclical_encode(col: Column | str, period: float = 24.0) -> tuple[Column, Column]:
    angle = _c(col).cast("double") * F.lit(2 * math.pi / period)
    return F.sin(angle), F.cos(angle)


def clip(col: Column | str, lo: float = 1e-6, hi: float = 1 - 1e-6) -> Column:
    return F.greatest(F.least(_c(col).cast("double"), F.lit(hi)), F.lit(lo))


def sigmoid(col: Column | str, clip_at: float | None = None) -> Column:
    """1/(1+e^-z); the churn variant clips z to +-clip_at first."""
    z = _c(col).cast("double")
    if clip_at is not None:
        z = F.greatest(F.least(z, F.lit(float(clip_at))), F.lit(-float(clip_at)))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def prediction_to_score(col: Column | str) -> Column:
    """Last-resort score: a hard prediction clipped to [0, 1]."""
    return F.greatest(F.least(_c(col).cast("double"), F.lit(1.0)), F.lit(0.0))


def threshold_label(col: Column | str, threshold: float | Column) -> Column:
    """``score >= threshold`` as 0/1 (inclusive)."""
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return (_c(col) >= t).cast("int")


def positive_class_score(probability_col: str = "probability") -> Column:
    """Second element of an ML probability vector (P(y=1))."""
    from pyspark.ml.functions import vector_to_array

    return vector_to_array(F.col(probability_col)).getItem(1)


def null_as_token(col: Column | str, token: str = "nan") -> Column:
    """pandas-style stringification: NULL becomes the text ``nan``."""
    return F.coalesce(_c(col).cast("string"), F.lit(token))
