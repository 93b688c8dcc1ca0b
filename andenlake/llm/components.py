"""Connected components by alternating large and small stars, all in joins and groupings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from andenlake.llm.shared import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large star: every larger neighbour is linked to the smallest neighbour. Small star: a
    node and its smaller neighbours are linked to the smallest of them. Neighbours are joined
    with the minimum of their node, never gathered into a list."""
    if large:
        near = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        near = edges
    low = near.groupBy("u").agg(F.min("v").alias("v")).select(
        "u", F.least("u", "v").alias("m"))
    linked = near.join(low, "u")
    if large:
        out = linked.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"),
                                                            F.col("m").alias("v"))
    else:
        out = linked.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            low.select("u", F.col("m").alias("v")))
    return out.filter("u > v").distinct()


def components(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """node, root: the smallest node each linked node is connected to.

    Nulls and loops are ignored; nodes without links do not occur. Rounds go on
    until nothing changes, logarithmic in the longest chain in practice. Every
    round is written to the shared folder, which cuts the lineage."""
    edges = stored(pairs.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                   .filter("u > v").distinct(), "edges")
    before = _digest(edges)
    while before[0]:
        edges = stored(_star(_star(edges, large=True), large=False), "edges")
        now = _digest(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
