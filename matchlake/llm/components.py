"""Connected components of an edge table, by alternating star contraction.

Each round points every node at the smallest node around it, first for larger
neighbours (large star), then for smaller ones (small star); stars meet until
every component is one star around its smallest node.  Neighbourhoods are only
ever reduced to their minimum, with partial aggregation before the shuffle, so
a node of very many neighbours needs no task that holds them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def components(edges: DataFrame, name: str = "edges") -> DataFrame:
    """(node, root) for each node of ``edges`` (a long, b long); ``root`` is
    the smallest node of its component.  Loops are ignored."""
    edges = cut(edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    before = None
    while True:
        # a > b in every row
        state = edges.agg(F.count("*"), F.sum(F.col("b").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == before:
            break
        before = state
        # the minima are written: a join of two tables can be split where one
        # node has very many rows, a join with a running aggregate cannot
        around = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = cut(around.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), name)
        # large star: every larger neighbour b of a points at m
        large = cut(around.where("b > a").join(least, "a").select(
            F.col("b").alias("a"), F.col("m").alias("b")).distinct(), name)
        # small star: a and its smaller neighbours point at the least of them
        least = cut(large.groupBy("a").agg(F.min("b").alias("m")), name)
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(
            least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
        edges = cut(small, name)
    return edges.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root").unionAll(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
