"""Connected components of links that are spread over the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from odsflow.llm.common import written


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour instead."""
    both = links.unionByName(links.select(F.col("root").alias("node"), F.col("node").alias("root")))
    least = both.groupBy("node").agg(F.least(F.min("root"), F.col("node")).alias("least"))
    return (
        both.join(least, "node").where(F.col("root") > F.col("node"))
        .select(F.col("root").alias("node"), F.col("least").alias("root")).where("node <> root").distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are all linked to the smallest of them."""
    least = links.groupBy("node").agg(F.min("root").alias("least"))
    moved = links.join(least, "node").select(F.col("root").alias("node"), F.col("least").alias("root"))
    return moved.unionByName(least.select("node", F.col("least").alias("root"))).where("node <> root").distinct()


def _signature(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("node", "root").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every linked node but the roots; a root is the smallest node of its component.

    `links` has the long columns `node` and `root`, in any order and with repeats. Large and small
    stars take turns (the number of turns grows with the logarithm of the longest chain); each turn
    is written to the shared folder, and the driver sees two numbers of it. Links of a node with
    itself say nothing and are left out; an empty input gives an empty result.
    """
    links = links.select(F.greatest("node", "root").alias("node"), F.least("node", "root").alias("root"))
    links = written(links.where("node <> root").distinct(), "links")
    before = _signature(links)
    while before[0]:
        links = written(_small_star(_large_star(links)), "links")
        after = _signature(links)
        if after == before:
            break
        before = after
    return links
