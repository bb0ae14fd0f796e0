"""Connected components of links, as joins and aggregations only."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cutgrid.functions.sizing import stage


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of the node and its neighbours instead."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("least"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are linked to the smallest of these; `a` is the larger end."""
    least = links.groupBy("a").agg(F.min("b").alias("least"))
    moved = links.join(least, "a").filter("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.union(least.select("a", F.col("least").alias("b"))).distinct()


def _state(links: DataFrame) -> tuple[int, int | None]:
    row = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
    return row[0], row[1]


def components(links: DataFrame) -> DataFrame:
    """a, b: each linked node that is not the smallest of its component, and that smallest node.

    `links` has columns a and b; order, repeats and self links do not matter. Neighbour sets are never gathered: each
    round takes minima by aggregation, and the number of rounds grows with the logarithm of a component's size.
    """
    links = stage(
        links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    before = _state(links)
    while before[0]:
        links = stage(_small_star(_large_star(links)))
        now = _state(links)
        if now == before:
            break
        before = now
    return links
