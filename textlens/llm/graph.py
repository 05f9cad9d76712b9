"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlens.llm.common import written


def _signature(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of ``edges`` (a, b): root is the smallest node that it reaches.

    Loops and repeated edges are allowed. Each round ties every node's neighbours to the smallest node
    near it, in two steps: to nodes above it, then to nodes below it. The neighbourhoods are never
    gathered: a round is a minimum for each node joined back to the edges. Rounds are written to the
    shared folder, so lineage stays short; the loop ends when a round changes nothing.
    """
    edges = written(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = _signature(edges)
    while before[0]:
        # large star: neighbours above a node go to the smallest node around it
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        up = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        up = up.where("a != b").distinct()
        # small star: a node and its neighbours below it go to the smallest of them
        least = up.groupBy("a").agg(F.min("b").alias("m"))
        down = up.join(least, "a").select(F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        edges = written(down.select("e.*").where("a != b").distinct(), "edges")
        after = _signature(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
