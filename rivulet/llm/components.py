"""Connected components of an edge table by alternating stars.

Large star: every node sends its larger neighbours to its smallest one.
Small star: every node sends its smaller neighbours, and itself, to the
smallest of them. Alternating the two leaves one star around the smallest
node of each component after a number of rounds that grows with the
logarithm of the path length. Each round is cut off by a reliable checkpoint,
so a lost executor costs one round.

A large component's smallest node is a hub: most edges may be at it. Minima are
combined in each task before they are shuffled, and joined back by a key of
their own (a struct of the node), so that both sides of the join are read from
an exchange: the shape in which Spark splits a hot key's partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.session import materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """``edges`` are (u, v), u < v. A star is hung on the smallest node m of
    each neighbourhood."""
    both = edges if not large else edges.unionByName(
        edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    if large:
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        out = (both.filter("v > u").withColumn("node", F.struct("u"))
               .join(low.select(F.struct("u").alias("node"), "m"), "node")
               .select(F.col("m").alias("u"), "v"))
    else:
        low = both.groupBy("v").agg(F.min("u").alias("m"))
        hung = (both.withColumn("node", F.struct("v"))
                .join(low.select(F.struct("v").alias("node"), "m"), "node"))
        out = hung.select(F.col("m").alias("u"), F.col("u").alias("v")).unionByName(
            low.select(F.col("m").alias("u"), "v"))
    return out.filter("u < v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v), u < v: root is the
    smallest node of its component."""
    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
                           ).first())

    edges = materialize(edges)
    seen = state(edges)
    while seen[0]:
        edges = materialize(_star(_star(edges, large=True), large=False))
        now = state(edges)
        if now == seen:
            break
        seen = now
    return (edges.select(F.col("v").alias("node"), F.col("u").alias("root"))
            .unionByName(edges.select(F.col("u").alias("node"), F.col("u").alias("root")))
            .distinct())
