"""Connected components by alternating large-star and small-star steps.

Each step is a partial aggregate (smallest neighbour per node) and a join on the
node, so a node with very many neighbours is combined before the shuffle and its
join partition can be split by AQE. Links are written to the shared folder after
every round; nothing but three numbers a round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import keep


def _pointers(links: DataFrame) -> DataFrame:
    """For every node ``a`` its smallest neighbour or itself."""
    return links.groupBy("a").agg(F.min("b").alias("_m")).select(F.col("a").alias("_a"), F.least("a", "_m").alias("_m"))


def _digest(links: DataFrame) -> tuple:
    pair = F.xxhash64("a", "b")
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.shiftright(pair, 20)), F.bit_xor(pair)).first())


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """Rows (node, root) for every node of the BIGINT pairs (a, b); root is the smallest reachable node.

    Direction, repeats and loops do not matter; rows with a null end are ignored.
    No links give an empty result; nodes without links are not returned.
    """
    links = keep(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where(F.col("a") != F.col("b")).distinct(), label)
    seen = None
    while True:
        both = links.union(links.select("b", "a"))
        large = (
            both.join(_pointers(both), F.col("a") == F.col("_a")).where(F.col("b") > F.col("a"))
            .select(F.col("b").alias("a"), F.col("_m").alias("b")).distinct()
        )
        low = large.groupBy("a").agg(F.min("b").alias("_m")).withColumnRenamed("a", "_a")
        small = (
            large.join(low, F.col("a") == F.col("_a")).where(F.col("b") != F.col("_m"))
            .select(F.col("b").alias("a"), F.col("_m").alias("b"))
            .union(low.select("_a", "_m")).distinct()
        )
        links = keep(small, label)
        digest = _digest(links)
        if digest == seen:
            break
        seen = digest
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        links.select("b", "b").distinct())
