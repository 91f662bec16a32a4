"""Connected components of a table of links, in rounds of joins and sums; nothing is gathered in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrivalmart.llm.texts import table_of


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of links (a, b), root being the smallest node reachable.

    Links are rewritten to the smallest neighbour, first from the larger side, then from the smaller (large star and
    small star), until they no longer change: then every link leads from a node to its root. The rounds grow
    with the logarithm of a component's size. Each round is written to the shared folder, which cuts the lineage.
    """
    links = table_of(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "links")
    before = None
    while True:
        links = _small_star(_large_star(links))
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        before = now


def _star(ways: DataFrame, name: str) -> DataFrame:
    """Ways (u, v) with the smallest v of each u. A table of its own, so that a hot u is split in the join."""
    least = table_of(ways.groupBy("u").agg(F.min("v").alias("m")), f"{name}-least")
    return ways.join(least, "u")


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour or the node itself."""
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    found = _star(both, "large").where("v > u").select(F.col("v").alias("a"), F.least("m", "u").alias("b"))
    return table_of(found.distinct(), "large-star")


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    ways = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    starred = _star(ways, "small")
    found = starred.where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    own = starred.select(F.col("u").alias("a"), F.col("m").alias("b"))
    return table_of(found.unionByName(own).distinct(), "small-star")
