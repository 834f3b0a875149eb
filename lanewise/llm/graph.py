"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanewise.session import materialize

MAX_ROUNDS = 100


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("least"))
    return (
        both.join(least, "a")
        .filter(F.col("b") > F.col("a"))
        .select(F.col("b").alias("a"), F.col("least").alias("b"))
    )


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    least = links.groupBy("a").agg(F.min("b").alias("least"))
    moved = links.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionByName(least.select("a", F.col("least").alias("b")))


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); root is the smallest node.

    Large-star and small-star steps in turn: the links shrink to one star per component
    in a number of rounds that grows with the logarithm of its size. No step gathers a
    node's neighbours; minima are combined map-side and joined back, and AQE splits the
    neighbours of a crowded node. Links with a NULL end or both ends alike say nothing.
    """
    high, low = F.greatest("a", "b"), F.least("a", "b")

    def ordered(table: DataFrame) -> DataFrame:
        return table.filter(F.col("a") != F.col("b")).distinct()

    current = materialize(
        ordered(links.dropna().select(high.alias("a"), low.alias("b"))), "component-links"
    )
    check = [F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))]
    before = None
    for _ in range(MAX_ROUNDS):
        seen = tuple(current.agg(*check).first())
        if seen == before or not seen[0]:
            break
        before = seen
        large = ordered(_large_star(current))
        current = materialize(ordered(_small_star(large)), "component-links")
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
