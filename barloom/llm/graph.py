"""Connected components of an edge list, as joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.session import stage


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``node, root`` for every node of ``edges(a, b)``; the root is the smallest node of the component.

    Alternates two steps until nothing changes: every node hands its smallest neighbour to its larger
    neighbours, then to its smaller ones. Each step is a grouped minimum (combined before the shuffle)
    and a join on the node, whose hot keys adaptive execution can split; no neighbour list is gathered.
    Every round is written to the shared folder, so the lineage stays short. Loops and repeated edges
    are dropped, a null end drops the edge, an empty edge list has no components.
    """
    a, b = F.col("a"), F.col("b")
    links = stage(edges.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    mark = _signature(links)
    for _ in range(rounds):
        if not mark[0]:
            break
        links = stage(_inward(_outward(links)), "edges")
        last, mark = mark, _signature(links)
        if mark == last:
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _signature(links: DataFrame) -> tuple:
    """Row count and a sum of hashes, small enough to compare on the driver."""
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def _outward(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _inward(links: DataFrame) -> DataFrame:
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").where(F.col("v") > F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
