"""Connected components of a distributed list of links.

Alternates large-star and small-star steps: each step is a map-side combined
minimum by node, written as a table, and one join, so no node's links meet in
one task and nothing is collected. The list of links becomes a forest of
stars in about log(n) rounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import written


def _is_star_forest(links: DataFrame) -> bool:
    """Every node hangs from one root, and no root hangs from another."""
    twice = links.groupBy("u").count().filter("count > 1")
    if not twice.isEmpty():
        return False
    return links.select(F.col("v").alias("u")).join(links, "u", "left_semi").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """links: (a, b) longs in any order, repeats allowed -> (node, root), one
    row for each node that has a link but is not the smallest of its
    component; root is that smallest node."""
    links = written(links.filter("a <> b")
                    .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    while not _is_star_forest(links):
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = written(both.join(low, "u").filter("v > u")
                        .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = written(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        roots = low.select("u", F.col("m").alias("v"))
        links = written(small.unionByName(roots).distinct())
    return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
