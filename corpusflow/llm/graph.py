"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from corpusflow.llm.tables import stored


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for each node of ``links(a, b)``, where ``root`` is the smallest node it reaches.

    Alternates two steps until every node hangs on its root: each node's larger neighbours, then its
    smaller ones, move to the smallest neighbour. Rounds grow with the logarithm of the longest path;
    each is a minimum by key and a join, and is stored, so a lost executor repeats one round at most.
    """
    edges = stored(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct(), "edges"
    )
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.join(lowest, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = stored(small.unionByName(least.withColumnRenamed("m", "v")).distinct(), "edges")
        hanging = after.join(after.select(F.col("u").alias("v")), "v", "left_semi")
        settled = hanging.isEmpty()
        edges = after
        if settled:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
