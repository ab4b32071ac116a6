"""Column helpers shared by the SQL-only operators.

White space is always the six ASCII characters ``[\\x20\\x09-\\x0D]``; other
Unicode space is part of a word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE_CHARS = " \t\n\x0b\f\r"
SPACE_RE = r"[\x20\x09-\x0D]"
WORD_RE = r"[^\x20\x09-\x0D]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def strip_space(c: Column) -> Column:
    """Both ends stripped of the six space characters."""
    return F.btrim(c, F.lit(SPACE_CHARS))


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased, nothing else. ``lower`` does just that to pure ASCII and
    is several times as fast as ``translate``."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, _UPPER, _UPPER.lower()))


def with_words(df: DataFrame, text_col: str, out: str) -> DataFrame:
    """``df`` plus ``out``, the array of words of ``text_col``; empty for NULL,
    empty and all-space text. Text whose words have one blank or newline between
    them is split without a regular expression. Every step is a column of its
    own, which keeps Spark from evaluating it more than once."""
    d = df.withColumn("_t", strip_space(or_empty(F.col(text_col))))
    d = d.withColumn("_flat", F.replace("_t", F.lit("\n"), F.lit(" ")))
    odd = F.contains(F.col("_flat"), F.lit("  "))
    for ch in "\t\x0b\f\r":
        odd = odd | F.contains(F.col("_t"), F.lit(ch))
    split = F.when(odd, F.split("_t", SPACE_RE + "+")).otherwise(F.split("_flat", " "))
    d = d.withColumn(out, F.when(F.col("_t") == "", F.array().cast("array<string>")).otherwise(split))
    return d.drop("_t", "_flat")


def lines(text: Column) -> Column:
    """Text split at ``\\n``; NULL and empty text are one empty line."""
    return F.split(or_empty(text), "\n", -1)


def hash128(*cols: Column) -> list[Column]:
    """Two differently seeded 64-bit hashes, used together as one 128-bit key."""
    return [F.xxhash64(*cols), F.xxhash64(F.lit(0x9E3779B9), *cols)]


def own_names(df: DataFrame, wanted: dict[str, str]) -> DataFrame:
    """Keep ``wanted`` = {working name: input column}. Everything else is left
    behind, so extra columns of any name cannot clash with working names."""
    return df.select(*[F.col(f"`{src}`").alias(name) for name, src in wanted.items()])
