"""Connected components by alternating stars, on Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.frames import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star operation: neighbours of a node move to its smallest neighbour."""
    if large:
        around = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        around = edges.select("u", "v")
    least = around.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("least"))
    least = least.withColumn("least", F.least("node", "least"))
    joined = around.join(least, F.col("u") == F.col("node"))
    if large:
        moved = joined.where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))
    else:
        moved = joined.where("v != least").select(F.col("v").alias("u"), F.col("least").alias("v"))
        moved = moved.union(least.where("node != least").select(F.col("node").alias("u"), F.col("least").alias("v")))
    return moved.where("u != v").distinct()


def components(links: DataFrame) -> DataFrame:
    """node and component (its smallest reachable node) for every node of ``links`` (u, v).

    Rounds of large star and small star (Kiveris et al., 2014) until nothing moves; their number
    grows with the logarithm of the longest path. Edges pass through tables in the shared
    folder. Null ends and loops are ignored.
    """
    ends = links.where("u IS NOT NULL AND v IS NOT NULL AND u != v")
    edges = stored(
        ends.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges"
    )
    state = None
    while True:
        edges = stored(_star(_star(edges, True), False), "edges")
        after = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if after == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        state = after
