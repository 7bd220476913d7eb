"""Connected components of a graph given by edges, as rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagefold.session import stage_table


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of the edges ``a, b`` (longs): the smallest node of its component.

    Every round links the larger neighbours of a node to its smallest neighbour, then the smaller
    ones likewise, until nothing changes. A node's neighbours are never gathered: their minimum
    is combined before the shuffle and joined back, so a node with very many is only a skewed join
    key. Rounds grow with the logarithm of a component's size; each is stored, which cuts lineage.
    """
    edges = stage_table(edges.where(F.col("a") != F.col("b")).distinct(), "edges")
    seen = None
    while True:
        both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy(F.col("a").alias("u")).agg(F.least(F.min("b"), F.col("u")).alias("m"))
        far = both.join(low, F.col("a") == F.col("u")).where(F.col("b") > F.col("a"))
        larger = far.select(F.col("b").alias("a"), F.col("m").alias("b")).where(F.col("a") != F.col("b")).distinct()
        # Here every edge leads from a node to a smaller one.
        down = larger.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        near = larger.join(down, F.col("a") == F.col("u"))
        smaller = near.select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(
            down.select(F.col("u").alias("a"), F.col("m").alias("b"))
        )
        edges = stage_table(smaller.where(F.col("a") != F.col("b")).distinct(), "edges")
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
    leaves = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return leaves.unionAll(leaves.select(F.col("root").alias("node"), "root").distinct())
