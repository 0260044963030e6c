"""Connected components of links, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pollwright.llm.common import cut

#: A node with very many links is spread over so many tasks.
SALTS = 8


def with_smallest(pairs: DataFrame) -> DataFrame:
    """``a, b, m``: with the smallest ``b`` of each ``a``."""
    low = pairs.groupBy("a").agg(F.min("b").alias("m"))
    copies = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt")
    salt = F.pmod(F.xxhash64("b"), F.lit(SALTS)).cast("int").alias("_salt")
    return pairs.select("*", salt).join(low.select("*", copies), ["a", "_salt"]).drop("_salt")


def large_star(links: DataFrame) -> DataFrame:
    """Hang the larger neighbours of each node on the smallest of it and its neighbours."""
    ways = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    found = with_smallest(ways).filter("b > a")
    return found.select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct()


def small_star(links: DataFrame) -> DataFrame:
    """Hang each node and its smaller neighbours on the smallest of them."""
    found = with_smallest(links)
    lower = found.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return found.select("a", F.col("m").alias("b")).unionByName(lower).distinct()


def settled(links: DataFrame) -> bool:
    """Whether every node hangs on one other, which hangs on none."""
    tops = links.select(F.col("b").alias("a")).distinct()
    return (
        links.groupBy("a").count().filter("count > 1").isEmpty()
        and links.join(tops, "a", "left_semi").isEmpty()
    )


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for each node of the links ``a, b``; its smallest node names a component.

    Links that hold a null or lead to their own start count for nothing.
    """
    found = cut(
        links.filter("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    while not settled(found):
        found = cut(small_star(large_star(found)))
    tops = found.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return found.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(tops)
