"""Connected components, and scans in rank order, of graphs given by their edges."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from corpusflow.functions.skew import attach
from corpusflow.session import cut_lineage

# Edges that one task takes into memory at a time, or scans one after the other.
EDGE_BUDGET = 1_000_000
# Rounds by which a component with more edges is made smaller before it is split anew.
PEEL_ROUNDS = 4


def contract(edges: DataFrame, budget: int = EDGE_BUDGET) -> DataFrame:
    """Fewer edges ``(u, v)``, u > v, with the same components: those of a portion become one star each.

    Portions are ranges of the smaller end, so chains of neighbouring ranks shrink to their borders.
    """

    def stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        above: dict = {}

        def top(x):
            while (up := above.setdefault(x, x)) != x:
                above[x] = x = above[up]
            return x

        def out() -> pa.RecordBatch:
            pairs = [(x, top(x)) for x in list(above)]
            pairs = [p for p in pairs if p[0] != p[1]]
            above.clear()
            return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], kind) for k in (0, 1)], ["u", "v"])

        seen, kind = 0, None
        for batch in batches:
            kind = batch.schema.field(0).type
            for a, b in zip(*(c.to_pylist() for c in batch.columns)):
                x, y = top(a), top(b)
                if x != y:
                    above[max(x, y)] = min(x, y)
            seen += batch.num_rows
            if seen >= budget:
                yield out()
                seen = 0
        if above:
            yield out()

    kind = edges.schema["u"].dataType.simpleString()
    return edges.select("u", "v").repartitionByRange("v").mapInArrow(stars, f"u {kind}, v {kind}")


def components(edges: DataFrame, a: str = "a", b: str = "b", budget: int = EDGE_BUDGET) -> DataFrame:
    """``node, root`` of every node of the edges ``(a, b)``; ``root`` is the smallest node of its component.

    After one contraction within ranges, larger neighbours and then smaller ones move to the smallest
    neighbour, until all nodes hang on roots. Rounds grow with the logarithm of the longest path that is left.
    Nodes with many neighbours are joined in pieces. Each round is checkpointed.
    """
    ordered = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u > v")
    stars = cut_lineage(contract(ordered, budget).distinct())
    while True:
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"), F.count(F.lit(1)).alias("n"))
        larger = attach(both, lowest, ["u"], ["v"], "n").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        larger = larger.distinct()
        least = larger.groupBy("u").agg(F.min("v").alias("m"))
        smaller = larger.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars = cut_lineage(smaller.unionByName(least.withColumnRenamed("m", "v")).distinct())
        if stars.join(stars.select(F.col("u").alias("v")).distinct(), "v", "left_semi").isEmpty():
            roots = stars.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            return stars.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def scanned(edges: DataFrame) -> DataFrame:
    """``rank`` of what a scan in rank order removes within each ``root`` of ``edges(root, earlier, later)``.

    A vertex goes if an earlier neighbour has stayed. Edges come sorted by their later end, by which time
    everything earlier is decided, so a task holds the removed vertices of one component only.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        component, gone = None, set()
        for batch in batches:
            new = []
            for root, earlier, later in zip(*(c.to_pylist() for c in batch.columns)):
                if root != component:
                    component, gone = root, set()
                if later not in gone and earlier not in gone:
                    gone.add(later)
                    new.append(later)
            yield pa.RecordBatch.from_arrays([pa.array(new, batch.schema.field(2).type)], ["rank"])

    ordered = edges.select("root", "earlier", "later").repartition("root").sortWithinPartitions("root", "later", "earlier")
    return ordered.mapInArrow(scan, f"rank {edges.schema['later'].dataType.simpleString()}")


def peel(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One round of the scan by joins: what is removed for sure, and the edges that are still open."""
    followers = edges.select(F.col("later").alias("earlier")).distinct()
    gone = cut_lineage(edges.join(followers, "earlier", "left_anti").select(F.col("later").alias("rank")).distinct())
    left = edges.join(gone.withColumnRenamed("rank", "earlier"), "earlier", "left_anti")
    return gone, cut_lineage(left.join(gone.withColumnRenamed("rank", "later"), "later", "left_anti"))


def first_kept(edges: DataFrame, budget: int = EDGE_BUDGET) -> DataFrame:
    """``rank`` of the vertices removed when scanning in order and dropping whatever is near a kept vertex.

    ``edges`` has ``earlier`` and ``later`` ranks. Components with at most ``budget`` edges are scanned in one
    task each, all at once, however long their chains. Larger ones lose what a few rounds of joins can decide
    (vertices without an open earlier neighbour stay and remove their later ones), which splits them, and go
    on as components of their own. Edges that fit into one task altogether are not split first.
    """
    edges = cut_lineage(edges.select("earlier", "later").distinct())
    removed = edges.select(F.col("later").alias("rank")).limit(0)
    while (n := edges.count()) > budget:
        found = components(edges, "earlier", "later", budget).select(F.col("node").alias("earlier"), "root")
        placed = cut_lineage(edges.join(found, "earlier"))
        large = placed.groupBy("root").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > budget).select("root")
        removed = removed.unionByName(cut_lineage(scanned(placed.join(large, "root", "left_anti"))))
        edges = placed.join(large, "root", "left_semi").select("earlier", "later")
        if large.isEmpty():
            return removed
        for _ in range(PEEL_ROUNDS):
            gone, edges = peel(edges)
            removed = removed.unionByName(gone)
    return removed.unionByName(cut_lineage(scanned(edges.withColumn("root", F.lit(0))))) if n else removed
