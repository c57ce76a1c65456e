"""Connected components of a graph given as pairs of longs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hypnolith.llm.tables import stored


def _stars(edges: DataFrame, both: bool) -> DataFrame:
    """Hang the neighbours of every node on the least of them.

    With ``both``, neighbours above the node move (large stars); without, those
    below it and the node itself (small stars). Only the least neighbour is
    aggregated, so a node with very many neighbours is never gathered.
    """
    if both:
        ends = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = ends.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        moved = ends.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        joined = edges.join(least, "a")
        moved = joined.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))
        )
    return moved.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def components(pairs: DataFrame) -> DataFrame:
    """node, component (its least node) of every node in ``pairs`` (two long columns).

    Large and small stars alternate until nothing moves, which takes about
    log(nodes) rounds; each round is written, so no plan carries more than one.
    """
    a, b = pairs.columns
    edges = pairs.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter("a <> b").distinct()
    edges = stored(edges, "edges")
    mark = None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(now) == mark or not now[0]:
            break
        mark = tuple(now)
        edges = stored(_stars(_stars(edges, True), False), "edges")
    leaves = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return leaves.unionByName(leaves.select(F.col("component").alias("node"), "component").distinct())
