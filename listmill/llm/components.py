"""Connected components of a link table, by alternating stars.

Every round shuffles the links by node twice and settles four narrow tables in the shared folder. A node with very many
links is no task of its own: minima combine before the shuffle, and the joins are between settled tables, whose skewed
partitions Spark splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listmill.session import settle


def _mark(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
    return row[0], row[1]


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node and root (the smallest node reachable) of every node that stands in ``links``; null ends are no links."""
    links = links.filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    links = settle(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    mark = _mark(links)
    while mark[0]:
        # each node hands the smallest node it sees to its larger neighbours
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = settle(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = settle(large.filter("u <> v").distinct())
        # each node hands the smallest node it sees to its smaller neighbours and takes it itself
        low = settle(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        after = settle(small.union(low.select("u", F.col("m").alias("v"))).distinct())
        again = _mark(after)
        links = after
        if again == mark:
            break
        mark = again
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
