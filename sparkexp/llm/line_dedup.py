"""Line dedup: drop lines whose key occurs in many documents.

Lines are exploded once per distinct key and document and the keys written to the
checkpoint folder, 32 bytes a line; the 128-bit key hash is counted with map-side combining, frequent keys are joined back (an ordinary
equi-join, so AQE splits a key that a third of the documents hold) and each
document is rebuilt from its own line array, in position order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkexp.llm.text import ascii_lower, hash128, lines, or_empty, strip_space
from sparkexp.session import cut_lineage


def line_key(line: Column) -> Column:
    return ascii_lower(strip_space(line))


def _key_hash(line: Column) -> Column:
    k = line_key(line)
    a, b = hash128(k)
    return F.when(F.char_length(k) >= 1, F.struct(a.alias("a"), b.alias("b")))


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 10, keep: list[str] | None = None
) -> DataFrame:
    """``doc_id, text, n_lines, n_dropped`` of every row, ``text`` without the
    lines whose key (stripped, ASCII-lower-cased, not empty) occurs in at least
    ``min_docs`` rows.

    Each row is one document, also when rows repeat or ids tie. NULL and empty
    text is one empty line and stays ``""``. NULL ids are kept as they are. An
    empty table gives an empty table. Other columns are ignored, but those in
    ``keep`` come back as the struct ``row``.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in keep or []] or [F.lit(0).alias("_")]).alias("row")
    d = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"), row)
    d = d.withColumn("lines", lines(F.col("text"))).withColumn("th", F.xxhash64(or_empty(F.col("text"))))
    keys = F.array_distinct(F.filter(F.transform("lines", _key_hash), lambda k: k.isNotNull()))
    # Written once: counting the keys and finding their documents both read it.
    seen = cut_lineage(d.select("doc_id", "th", F.explode(keys).alias("k")))
    common = seen.groupBy("k").agg(F.count("*").alias("n")).where(F.col("n") >= min_docs).select("k")
    # Identical rows (same id and text) meet in one group and get the same set.
    drops = (
        seen.join(common, "k")
        .groupBy(F.col("doc_id").alias("drop_id"), F.col("th").alias("drop_th"))
        .agg(F.collect_set("k").alias("drops"))
    )
    j = d.join(drops, F.col("doc_id").eqNullSafe(F.col("drop_id")) & (F.col("th") == F.col("drop_th")), "left")
    kept = F.when(F.col("drops").isNull(), F.col("lines")).otherwise(
        F.filter("lines", lambda x: ~F.coalesce(F.array_contains(F.col("drops"), _key_hash(x)), F.lit(False)))
    )
    j = j.select("doc_id", "row", F.size("lines").cast("long").alias("n_lines"), kept.alias("kept"))
    return j.select(
        "doc_id",
        *["row"] * bool(keep),
        F.array_join("kept", "\n").alias("text"),
        "n_lines",
        (F.col("n_lines") - F.size("kept")).alias("n_dropped"),
    )
