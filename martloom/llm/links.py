"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.session import materialize


def components(links: DataFrame) -> DataFrame:
    """node, root (smallest node that can be reached) for every node in `links` (a, b).

    Large and small stars in turn: each round hangs every node's larger neighbours, then
    its smaller ones, under the smallest neighbour, until nothing moves. The number of
    rounds grows with the logarithm of the longest chain. Every round is written to the
    shared folder, so a lost executor costs one round at most. A node with very many
    links is an ordinary skewed key: minima are combined before the shuffle and the
    join is split.
    """
    edges = materialize(
        links.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "links",
    )
    state = _state(edges)
    while True:
        edges = materialize(_small_star(_large_star(edges)), "links")
        before, state = state, _state(edges)
        if state == before:
            break
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long")), F.bit_xor(F.xxhash64("u", "v"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (
        both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    # here every edge has u > v
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).where("u != v").distinct().select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    )
