"""Mixing sources to target weights.

Sizes are summed per source (map-side combined, so a hot source is only a sum),
targets come from water-filling on the one-row-per-source table, and each
document is emitted ``floor(rate)`` times plus one seeded Bernoulli copy.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkexp.llm.text import WORD_RE, or_empty

#: 48 bits of the digest as a number in [0, 1).
_SCALE = float(1 << 48)


def n_words(text: Column) -> Column:
    return F.regexp_count(or_empty(text), F.lit(WORD_RE)).cast("long")


def seeded_uniform(seed: int, *cols: Column) -> Column:
    """Uniform in [0, 1) from a digest of the values: the same in every run."""
    key = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(c.cast("string"), F.lit("~")) for c in cols])
    return F.conv(F.substring(F.md5(key), 1, 12), 16, 10).cast("double") / F.lit(_SCALE)


def source_targets(
    sizes: DataFrame,
    weights: tuple[float, ...] = (5.0, 2.0, 1.0),
    share: float = 1.5,
    max_rate: float = 2.0,
) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``.

    Sources by code point (NULL last) weigh ``weights``, repeating; together
    they get ``share`` times all sizes. A target stops at ``max_rate`` times its
    source and the excess goes to the others by weight until none is above:
    with sources ordered by cap / weight the capped ones are a prefix, so the
    fixed point needs only running sums. The table has one row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    k = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), k + 1)
    s = sizes.withColumn("w", w).withColumn("cap", F.col("source_size") * F.lit(float(max_rate)))
    order = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    s = s.withColumn("total", F.sum("source_size").over(everything) * F.lit(float(share)))
    s = s.withColumn("left", F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
    s = s.withColumn("w_left", F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
    s = s.withColumn("level", F.col("left") / F.col("w_left"))
    s = s.withColumn("open", F.col("cap") > F.col("level") * F.col("w"))
    # The level of the first source that is not capped holds for all after it.
    s = s.withColumn("final", F.min(F.when(F.col("open"), F.struct(F.col("cap") / F.col("w"), F.col("level")))).over(everything)["level"])
    capped = F.col("final").isNull() | (F.col("cap") <= F.col("final") * F.col("w"))
    return s.select(
        "source", "source_size", F.when(capped, F.col("cap")).otherwise(F.col("final") * F.col("w")).alias("target")
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[float, ...] = (5.0, 2.0, 1.0),
    share: float = 1.5,
    max_rate: float = 2.0,
    seed: int = 17,
) -> DataFrame:
    """``doc_id, size, source, source_size, target, rate, copies`` of every row.

    NULL and empty texts have size 0 and may get copies that add no words.
    NULL is a source of its own. A source without words has rate 0. Rows that
    share an id share the draw. An empty table gives an empty table.
    """
    d = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{source_col}`").alias("source"),
        n_words(F.col(f"`{text_col}`")).alias("size"),
    )
    return copies_of(d, weights, share, max_rate, seed)


def copies_of(sized: DataFrame, weights=(5.0, 2.0, 1.0), share=1.5, max_rate=2.0, seed=17) -> DataFrame:
    """Targets, rates and copies for rows that hold ``doc_id, source, size``."""
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    t = source_targets(sizes, weights, share, max_rate).withColumnRenamed("source", "t_source")
    j = sized.join(t, F.col("source").eqNullSafe(F.col("t_source")), "left").drop("t_source")
    j = j.withColumn(
        "rate", F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(max_rate)))).otherwise(0.0)
    )
    extra = seeded_uniform(seed, F.col("doc_id")) < F.col("rate") - F.floor("rate")
    return j.withColumn("copies", F.floor("rate") + extra.cast("long"))


def repeat_rows(docs: DataFrame, **kw) -> DataFrame:
    """The mixed corpus: every row of ``docs`` (all columns) as often as ``mix``
    takes it. ``id_col``, ``text_col`` and ``source_col`` name the inputs."""
    idc, txt, src = kw.pop("id_col", "doc_id"), kw.pop("text_col", "text"), kw.pop("source_col", "source")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    d = docs.select(row, F.col(f"`{idc}`").alias("doc_id"), F.col(f"`{src}`").alias("source"), n_words(F.col(f"`{txt}`")).alias("size"))
    out = copies_of(d, **kw).where(F.col("copies") > 0)
    out = out.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy_no"))
    return out.select("row.*")
