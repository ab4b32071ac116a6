"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkexp.session import cut_lineage


def _state(e: DataFrame) -> tuple:
    r = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).collect()[0]
    return r["n"], r["h"]


def components(edges: DataFrame) -> DataFrame:
    """node, label: the smallest node reachable from each node of ``edges``
    (columns u, v of any orderable type). Alternates large-star and small-star
    steps: each hangs neighbours on a node's smallest neighbour, by a minimum per
    node and a join, so that no neighbour list is ever collected. Edges shrink to
    stars around the smallest nodes; about log(nodes) rounds.
    """
    e = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    e = cut_lineage(e)
    state = _state(e)
    while state[0]:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # Nodes whose smallest neighbour is themselves keep their place.
        large = large.distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array("u", "v")).alias("u"), "m").where("u <> m")
        e = cut_lineage(small.select(F.greatest("u", "m").alias("u"), F.least("u", "m").alias("v")).distinct())
        new = _state(e)
        if new == state:
            break
        state = new
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("label"))
    return roots.union(e.select(F.col("u").alias("node"), F.col("v").alias("label"))).distinct()
