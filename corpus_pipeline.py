"""Cleaning and mixing a training corpus, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet in the shared checkpoint folder and read again as the next stage's
docs. All but the last return the columns they were given; ``n_chars``, where
there, follows the text.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkexp.llm.anchors import NO_ID
from sparkexp.llm.decontaminate import find_leaks
from sparkexp.llm.line_dedup import dedup_lines
from sparkexp.llm.mixing import repeat_rows
from sparkexp.llm.quality import judge
from sparkexp.llm.setjoin import jaccard_components
from sparkexp.llm.text import or_empty, strip_space
from sparkexp.session import ensure_checkpoint_dir


def _keyed(docs: DataFrame, **keys) -> DataFrame:
    """Every row as the struct ``row`` beside working columns, so that columns of
    the same names cannot clash."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    return docs.select(row, *[v.alias(k) for k, v in keys.items()])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the robust distance reject go."""
    return judge(docs).where("kept").select("row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that ten documents or more have go; a document that had lines and
    lost them all goes with them."""
    d = dedup_lines(docs, min_docs=10, keep=docs.columns)
    d = d.where((F.col("n_dropped") < F.col("n_lines")) | (F.col("n_dropped") == 0))
    new = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    return d.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five-word shingles, Jaccard 0.8) the
    document with the smallest id stays (NULL is the largest), of its equal rows
    one. Texts without words are no duplicates of each other and all stay."""
    j = jaccard_components(docs, n=5, percent=80)
    # Of a group's rows that share the smallest id but not the text: the smallest hash.
    first = j.where("n_shingles > 0").groupBy("comp").agg(F.min(F.struct("did", "rid")).alias("f"))
    first = first.select(F.col("f.did").alias("f_did"), F.col("f.rid").alias("f_rid"))
    i, t = F.col("doc_id").cast("long"), or_empty(F.col("text"))
    d = _keyed(docs, k_did=F.coalesce(i, F.lit(NO_ID)), k_rid=F.xxhash64(i, t), blank=strip_space(t) == "")
    kept = d.where("not blank").join(first, (F.col("k_did") == F.col("f_did")) & (F.col("k_rid") == F.col("f_rid")), "left_semi")
    return kept.dropDuplicates(["k_did", "k_rid"]).union(d.where("blank")).select("row.*")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of a benchmark item go."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    bad = find_leaks(docs, items).select(F.col("doc_id").alias("b_id"), F.col("th").alias("b_th")).distinct()
    d = _keyed(docs, d_id=F.col("doc_id"), d_th=F.xxhash64(or_empty(F.col("text"))))
    return d.join(bad, F.col("d_id").eqNullSafe(F.col("b_id")) & (F.col("d_th") == F.col("b_th")), "left_anti").select("row.*")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's target weight asks for."""
    return repeat_rows(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("mixing sources to target weights", mixing),
]

#: Smith-Waterman alignment and the robust estimates are not expressible in SQL;
#: tests/llm/test_pipeline.py runs the stages against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
