"""Null-safe keyed joins.

Group keys may be NULL, and a NULL group is a group like any other. An ordinary
equi-join on named columns loses it, so every join of a per-group table goes
through ``join_keys``. No hint is given: Spark broadcasts a side whose size it
knows to be under ``spark.sql.autoBroadcastJoinThreshold`` (with AQE, the size it
has measured) and shuffles otherwise, where AQE splits a hot key.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` with NULL equal to NULL (``how``: ``inner`` or ``left``).
    Output: ``left``'s columns, then ``right``'s other columns. Without keys,
    ``right`` is one ungrouped aggregate row."""
    if how not in ("inner", "left"):
        raise ValueError(f"unsupported join type {how!r}")
    keys = list(keys)
    if not keys:
        return left.crossJoin(F.broadcast(right))
    r = right.withColumnsRenamed({k: f"_key_{k}" for k in keys})
    cond = reduce(lambda a, b: a & b, [left[k].eqNullSafe(r[f"_key_{k}"]) for k in keys])
    return left.join(r, cond, how).drop(*[f"_key_{k}" for k in keys])


def join_per_group(big: DataFrame, small: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """``join_keys`` of a table that has one row per key back onto its rows."""
    return join_keys(big, small, keys, how)
