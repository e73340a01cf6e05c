"""Connected components of links, by stars that shrink."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacancyflow.llm.shared import staged


def large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of the node and its neighbours."""
    both = links.union(links.select("b", "a"))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    return both.join(least, "a").filter("b > a").select("b", "m").toDF("a", "b").distinct()


def small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    told = down.join(least, "a").filter("b <> m").select("b", "m").toDF("a", "b")
    return told.union(least.select("a", "m")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in `links(a, b)` of longs; a component is named by its smallest node.

    Each round is two aggregates that reduce a node's links before the shuffle, and two joins that adaptive
    execution can split; rounds grow with the logarithm of the longest chain. A round's links are stored.
    """
    links = links.filter("a <> b").select("a", "b").toDF("a", "b")
    links, before = staged(links.distinct()), None
    while True:
        found = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if found == before:
            break
        before = found
        links = staged(small_star(large_star(links)))
    roots = links.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return links.select("a", "b").toDF("node", "component").union(roots)
