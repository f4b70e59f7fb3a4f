"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.session import materialise


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of the component of every node, for edges (a, b) of longs.

    Alternates two steps until nothing changes: every node links its larger neighbours to
    the smallest node it knows, then its smaller ones.  Minima are taken before the shuffle,
    and no step holds a node's neighbours in one place.
    """
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter(F.col("u") != F.col("v"))
    current = materialise(down.distinct())
    before = None
    while True:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter(F.col("u") != F.col("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        # The node's other smaller neighbours, and the node itself, to the smallest.
        small = large.join(least, "u").filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        current = materialise(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        state = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    roots = current.select(F.col("v").alias("node")).distinct().withColumn("root", F.col("node"))
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
