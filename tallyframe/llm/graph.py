"""Connected components of a graph given as edges, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import drop_work, materialize, work_dir
from .common import splittable

#: Edges in a written file, at least.
EDGES = 1 << 20


def components(edges: DataFrame) -> DataFrame:
    """Edges (a, b) of two long columns to (node, root): the least node of each component.

    Large star: every neighbour that is greater than a node is tied to the node's least neighbour.
    Small star: a node's smaller neighbours and the node are tied to the least of them. The rounds end
    when the edges are stars, every greater node with one edge and no node both greater and smaller; their number grows
    with the logarithm of the nodes, and edges that are stars to begin with take none. A
    node's least neighbour is found by a combining aggregate and joined back in a join that can be split, so
    a node with many edges is never a group in one task. Each round is a written table; the one before is dropped.
    """
    spark = edges.sparkSession
    now, path = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), None
    while True:
        here = work_dir(spark, "stars")
        now = materialize(now, "stars", here)
        if path:
            drop_work(spark, path)
        path = here
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        ends = both.groupBy("a").agg(F.count_if(F.col("b") < F.col("a")).alias("up"), F.count_if(F.col("b") > F.col("a")).alias("down"))
        count, others = ends.agg(F.sum("up"), F.count_if((F.col("up") > 1) | (F.col("up") == 1) & (F.col("down") > 0))).first()
        if not others:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                now.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(splittable(least, "a"), "a").where("b > a OR b = m").select(F.greatest("a", "b").alias("a"), F.col("m").alias("b"))
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(splittable(lowest, "a"), "a").select(
            F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b")).distinct()
        now = small.coalesce(max(2 * spark.sparkContext.defaultParallelism, count // EDGES))
