"""Connected components by alternating large-star and small-star steps.

Both steps move every link to the smallest neighbour of one of its ends. The
smallest neighbour is an aggregate with a map-side part, and hubs meet their
links by ``join_by_size``, so a component of any size stays spread out. Every
step is a written table. The number of rounds grows with the logarithm of the
longest chain of links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_by_size, stage


def _toward_smallest(links: DataFrame, name: str) -> DataFrame:
    """(u, v) to (u, v, least), where ``least`` is the smallest of u and its v."""
    total = links.count()
    groups = stage(
        links.groupBy("u").agg(
            F.least(F.min("v"), F.min("u")).alias("least"), F.count(F.lit(1)).alias("n")
        ),
        name,
    )
    return join_by_size(links, groups, "u", "n", total)


def _signature(links: DataFrame):
    return links.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    ).first()


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for every node that has a link; ``root`` is the smallest node.

    ``links`` has long columns u and v; direction, repeats and loops do not
    matter, and rows with a null end are no links.
    """
    ordered = links.where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    )
    links = stage(ordered.distinct(), "links")
    before = _signature(links)
    while True:
        both = stage(links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v"))), "both")
        large = _toward_smallest(both, "large").where("v > u").select(
            F.col("v").alias("u"), F.col("least").alias("v")
        ).distinct()
        large = stage(large, "large_star")
        near = _toward_smallest(large, "small")
        small = near.select(F.col("v").alias("u"), F.col("least").alias("v")).unionByName(
            near.select("u", F.col("least").alias("v"))
        ).where("u <> v").distinct()
        links = stage(small, "small_star")
        after = _signature(links)
        if after == before:
            break
        before = after
    nodes = links.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return nodes.unionByName(roots)
