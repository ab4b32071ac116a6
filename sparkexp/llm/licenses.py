"""Licence scan by canonical digest.

Text is normalised (case, punctuation, copyright lines, equivalent spellings),
digested with SHA-256 and hash-joined to the digests of known licence texts.
Whole documents are looked up, and so is every line of a document, because a
licence notice usually is one whole line of a larger text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkexp.llm.text import or_empty, own_names

# Spellings that licence matching treats as equal.
SPELLINGS = {
    "licence": "license", "licences": "licenses", "licenced": "licensed", "sublicence": "sublicense",
    "acknowledgement": "acknowledgment", "analogue": "analog", "analyse": "analyze", "artefact": "artifact",
    "authorisation": "authorization", "authorised": "authorized", "calibre": "caliber", "cancelled": "canceled",
    "capitalisations": "capitalizations", "catalogue": "catalog", "categorise": "categorize", "centre": "center",
    "emphasised": "emphasized", "favour": "favor", "favourite": "favorite", "fulfil": "fulfill",
    "fulfilment": "fulfillment", "initialise": "initialize", "judgement": "judgment", "labelling": "labeling",
    "labour": "labor", "maximise": "maximize", "modelled": "modeled", "modelling": "modeling",
    "offence": "offense", "optimise": "optimize", "organisation": "organization", "organise": "organize",
    "practise": "practice", "programme": "program", "realise": "realize", "recognise": "recognize",
    "signalling": "signaling", "utilisation": "utilization", "whilst": "while", "wilful": "willful",
}

# Canonical notices and the SPDX identifiers they stand for.
KNOWN_NOTICES = [
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
]

COPYRIGHT_LINE_RE = r"(^|\n)[\x20\x09]*(copyright|\(c\)|©|all rights reserved)[^\n]*"
COPYRIGHT_MARKS = ["copyright", "(c)", "©", "all rights reserved"]
#: Everything but letters, digits and line ends.
PUNCT_RE = r"[^\p{L}\p{N}\n]+"


def _stems() -> str:
    """Matches every text that holds a spelling to replace, and few others."""
    by_first: dict[str, set[str]] = {}
    for w in SPELLINGS:
        by_first.setdefault(w[0], set()).add(w[1:5])
    return "[ \\n](?:" + "|".join(f"{a}(?:{'|'.join(sorted(r))})" for a, r in sorted(by_first.items())) + ")"


def with_canonical_lines(df: DataFrame, text_col: str) -> DataFrame:
    """``df`` with ``text_col`` replaced by the array of its canonical lines:
    words in canonical spelling with one space between them. Copyright lines and
    lines without words are left out.

    While spellings are replaced every word has its own space on both sides, so
    a literal replacement touches whole words only, also when they repeat. The
    costlier steps run only on texts that hold something to replace, and every
    step is a column of its own, so that Spark evaluates it once.
    """
    d = df.withColumn(text_col, F.lower(or_empty(F.col(text_col))))
    marked = F.lit(False)
    for m in COPYRIGHT_MARKS:
        marked = marked | F.contains(F.col(text_col), F.lit(m))
    d = d.withColumn(text_col, F.when(marked, F.regexp_replace(text_col, COPYRIGHT_LINE_RE, "\n")).otherwise(F.col(text_col)))
    d = d.withColumn(text_col, F.regexp_replace(F.concat(F.lit("\n"), text_col, F.lit("\n")), PUNCT_RE, "  "))
    spelt = F.replace(text_col, F.lit("\n"), F.lit(" \n "))
    for a, b in SPELLINGS.items():
        spelt = F.replace(spelt, F.lit(f" {a} "), F.lit(f" {b} "))
    d = d.withColumn(text_col, F.when(F.rlike(text_col, F.lit(_stems())), spelt).otherwise(F.col(text_col)))
    d = d.withColumn(text_col, F.replace(text_col, F.lit("  "), F.lit(" ")))
    return d.withColumn(text_col, F.filter(F.transform(F.split(text_col, "\n", -1), lambda x: F.btrim(x)), lambda x: x != ""))


def with_units(df: DataFrame, text_col: str) -> DataFrame:
    """One row per text and per distinct line of it: other columns, ``whole``
    (true on the row of the text itself) and ``digest``, the SHA-256 of the
    canonical text ("" where nothing is left; never NULL, so that a join adds no
    null filter that would normalise each text a second time)."""
    c = with_canonical_lines(df, text_col)
    units = F.concat(
        F.array(F.struct(F.lit(True).alias("whole"), F.array_join(text_col, " ").alias("c"))),
        F.transform(F.array_distinct(text_col), lambda x: F.struct(F.lit(False).alias("whole"), x.alias("c"))),
    )
    c = c.select(*[x for x in df.columns if x != text_col], F.explode(units).alias("u"))
    return c.select("*", F.col("u.whole").alias("whole"), F.when(F.col("u.c") != "", F.sha2("u.c", 256)).otherwise("").alias("digest")).drop("u")


def known_notices(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(KNOWN_NOTICES, "license_id string, text string")


def known_digests(reference: DataFrame, id_col: str = "license_id", text_col: str = "text") -> DataFrame:
    """``digest, license_id`` of the reference texts; texts that agree after
    normalising keep the smallest id. Rows without text or id are left out."""
    r = own_names(reference, {"license_id": id_col, "text": text_col})
    r = with_units(r, "text").where("whole and digest <> '' and license_id is not null")
    return r.groupBy("digest").agg(F.min("license_id").alias("license_id"))


def scan(docs: DataFrame, reference: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, digest, license_id, notice_ids`` of every row.

    ``license_id`` is the licence whose whole text the document is,
    ``notice_ids`` the sorted distinct licences that single lines of it are.
    NULL, empty and punctuation-only texts have digest NULL and match nothing.
    Equal rows stay as many as they were. The known table is joined by digest:
    broadcast by Spark while it is small, shuffled otherwise; lines without a
    match go no further, and no text is shuffled.
    """
    known = known_digests(reference).select(F.col("digest").alias("known"), "license_id")
    d = own_names(docs, {"doc_id": id_col, "text": text_col})
    d = d.select("doc_id", "text", F.xxhash64(or_empty(F.col("text"))).alias("th"))
    u = with_units(d, "text")
    u = u.join(known, F.col("digest") == F.col("known"), "left").where(F.col("whole") | F.col("known").isNotNull())
    g = u.groupBy("doc_id", "th").agg(
        F.count_if("whole").alias("rows"),
        F.max(F.when(F.col("whole"), F.col("digest"))).alias("digest"),
        F.max(F.when(F.col("whole"), F.col("license_id"))).alias("license_id"),
        F.sort_array(F.collect_set(F.when(~F.col("whole"), F.col("license_id")))).alias("notice_ids"),
    )
    return g.select(
        "doc_id", F.nullif("digest", F.lit("")).alias("digest"), "license_id", "notice_ids",
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))).alias("row_no"),
    ).drop("row_no")
