"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from folioflow.session import cut_lineage


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """Hang every node's larger (or not larger) neighbours under the least node around it.

    The least neighbour is a partial aggregate joined back, so that a node with very many
    neighbours is a skewed join, which adaptive execution splits, and not one group.
    """
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if larger:
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("least"))
        moved = both.filter("b > a")
        out = moved.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        down = both.filter("b < a")
        least = down.groupBy("a").agg(F.min("b").alias("least"))
        out = down.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        out = out.unionByName(least.select("a", F.col("least").alias("b")))
    return out.filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of an edge: the root is the least node that can be reached.

    ``edges`` has columns ``a`` and ``b`` of one type. Alternates the large and the small star,
    which ends after a number of rounds logarithmic in the longest path. Every round is written
    to the shared folder; only its row count and checksum come to the driver.
    """
    edges = cut_lineage(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    )
    seen = None
    while True:
        # The checksum is of the edge set: order and partitioning do not matter.
        mark = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")),
        ).first()
        if mark == seen or not mark[0]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = mark
        edges = cut_lineage(_star(_star(edges, True), False))
