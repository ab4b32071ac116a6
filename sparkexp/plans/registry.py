"""Registry of named queries: a Spark builder and, where SQL can express the
operator, an independent DuckDB query over the same driver tables.

Doubles are rounded to ``ROUND_DIGITS`` on both sides so that summation-order
noise does not decide the comparison.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROUND_DIGITS = 6


@dataclass
class QuerySpec:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None
    doubles: Sequence[str] = field(default_factory=tuple)


REGISTRY: dict[str, QuerySpec] = {}


def round_doubles(df: DataFrame, digits: int = ROUND_DIGITS) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.round(F.col(f.name).cast("double"), digits).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def round_sql(sql: str, doubles: Sequence[str], digits: int = ROUND_DIGITS) -> str:
    if not doubles:
        return sql
    rep = ", ".join(f"round(CAST({c} AS DOUBLE), {digits}) AS {c}" for c in doubles)
    return f"SELECT * REPLACE ({rep}) FROM ({sql}) AS _q"


def register(name: str, sql: str | None = None, doubles: Sequence[str] = ()):
    def deco(fn: Callable[[SparkSession, str], DataFrame]):
        def build(spark: SparkSession, sf_dir: str) -> DataFrame:
            return round_doubles(fn(spark, sf_dir))

        REGISTRY[name] = QuerySpec(name, build, sql, tuple(doubles))
        return fn

    return deco


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load_all()
    return {k: v.build for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load_all()
    return {k: round_sql(v.sql, v.doubles) for k, v in REGISTRY.items() if v.sql is not None}


def _load_all() -> None:
    # Importing the query modules fills REGISTRY.
    from sparkexp.plans import q_experiment, q_uplift  # noqa: F401
    from sparkexp.plans import q_classify, q_drift, q_profile, q_rank  # noqa: F401
    from sparkexp.plans import q_clean, q_io, q_models  # noqa: F401
