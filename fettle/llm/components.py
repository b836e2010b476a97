"""Connected components of a link table, by alternating star contraction.

Every step is a grouping and an equi-join on the links, so neither links nor components pass
through the driver; it only compares two checksums. A node with many links is one row per link
on the large side of a sort-merge join, which adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fettle.shared import remove_folder, write_table


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """(node, component): the smallest node each linked node can reach, itself included.

    Nodes of any orderable type. Links are undirected; repeated links, links of a node to
    itself and links with a null end change nothing, and nodes in no other link get no row.
    """
    spark = links.sparkSession
    a, b = F.col(left), F.col(right)
    stars, path = write_table(
        links.where(a.isNotNull() & b.isNotNull() & (a != b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    )
    seen = _checksum(stars)
    while seen[0]:
        stars, next_path = write_table(_small_star(_large_star(stars)))
        remove_folder(spark, path)
        path, before, seen = next_path, seen, _checksum(stars)
        if seen == before:
            break
    roots = stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


def _large_star(links: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the node's smallest neighbour."""
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    return (
        both.join(least, "u").where("v > u")
        .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def _checksum(links: DataFrame) -> tuple:
    hashed = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(links.agg(F.count(F.lit(1)), F.sum(hashed)).first())
