"""Connected components of a table of links, by large and small stars over joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripkpi.llm.common import written


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select("u", "v").union(links.select(F.col("v"), F.col("u"))).toDF("u", "v")


def _large_star(links: DataFrame) -> DataFrame:
    """Larger neighbours of each node are linked with its least neighbour instead."""
    both = _both_ways(links)
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(
        F.col("u").alias("n"), F.expr("least(u, m)").alias("m")
    )
    # Written, so that the join shuffles both of its sides and Spark can split a node with many links.
    least = written(least, "least")
    return (
        both.join(least, both.u == least.n)
        .where("v > u")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Smaller neighbours of each node, and itself, are linked with its least neighbour instead."""
    least = links.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "n")
    least = written(least, "least")
    moved = (
        links.join(least, links.u == least.n)
        .where("v <> m")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
    )
    return moved.union(least.select(F.col("n").alias("u"), F.col("m").alias("v"))).distinct()


def _mark(links: DataFrame):
    """Two numbers that tell whether a round has changed anything."""
    return links.agg(F.count("*"), F.sum(F.expr("xxhash64(u, v) % 1000003"))).first()


def components(links: DataFrame) -> DataFrame:
    """node and component, the least node that it reaches, of every node of ``links`` (u, v).

    Both ends of a link and its direction are free, repeated links and loops harmless. Links shrink to
    stars in a number of rounds that grows with the logarithm of the longest chain. Each round is a
    written table; nothing but two numbers of it comes to the driver.
    """
    links = links.select(F.expr("greatest(u, v)").alias("u"), F.expr("least(u, v)").alias("v"))
    links = written(links.where("u <> v").distinct(), "links")
    mark = _mark(links)
    while True:
        links = written(_small_star(_large_star(links)), "links")
        before, mark = mark, _mark(links)
        if tuple(before) == tuple(mark):
            break
    stars = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return stars.union(roots)
