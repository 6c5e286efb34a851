"""Connected components of a link table, by alternating star contraction.

Every step is an aggregate with a partial sum and a join on the node; no neighbour list is ever
gathered. Each round is written to the shared folder, so lineage stays short and a lost executor costs one
round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from precedent.llm.common import Tables

MAX_ROUNDS = 60


def connected_components(links: DataFrame) -> DataFrame:
    """(node, label) of every node of ``links`` (a, b: long); label is the component's least node."""
    tables = Tables(links.sparkSession, "components")
    edges = tables.store(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "edges",
    )
    before, name = None, "edges"
    for turn in range(MAX_ROUNDS):
        # Large star: everything above a node hangs on its least neighbour.
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        # Small star: a node and all below it hang on the least of these.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = tables.store(small.union(least.select("u", F.col("m").alias("v"))).distinct(), f"edges{turn}")
        tables.drop(name)
        name = f"edges{turn}"
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            roots = edges.select(F.col("v").alias("node")).distinct()
            return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).union(
                roots.select("node", F.col("node").alias("label"))
            )
        before = now
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
