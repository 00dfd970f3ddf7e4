"""Connected components of a link table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailflow.llm.common import materialise


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node that has a link; root is the component's smallest node.

    ``edges`` has two columns of one orderable type; direction, order, repeated
    links and self links do not matter, links with a null end are ignored. Every
    round hangs nodes on smaller ones until each tree is a star: the number of
    rounds grows with the logarithm of the size. A hub is a skewed key of plain joins,
    which adaptive execution splits; minima have partial aggregates. No node
    list, label table or link ever reaches the driver, only two counts a round.
    """
    a, b = edges.columns
    linked = edges.filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    pairs = linked.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    pairs = materialise(pairs, "links")
    while True:
        pairs = materialise(_small_star(_large_star(pairs)), "stars")
        state = pairs.groupBy("u").agg(F.count(F.lit(1)).alias("n")).agg(
            F.count(F.lit(1)).alias("nodes"), F.sum("n").alias("links")
        ).first()
        if state["nodes"] != (state["links"] or 0):
            continue
        inner = pairs.select(F.col("v").alias("w")).distinct()
        if pairs.join(inner, pairs["u"] == inner["w"], "left_semi").isEmpty():
            break
    roots = pairs.select(F.col("v").alias("u"), "v").distinct()
    return pairs.unionByName(roots).select(F.col("u").alias("node"), F.col("v").alias("root"))


def _large_star(pairs: DataFrame) -> DataFrame:
    both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    moved = both.filter(F.col("v") > F.col("u")).join(least, "u")
    return moved.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(pairs: DataFrame) -> DataFrame:
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    moved = pairs.join(least, "u")
    down = moved.filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return down.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
