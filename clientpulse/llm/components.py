"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientpulse.llm.stored import drop, stored


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for each node of an edge (a, b) between different nodes; the component is its smallest node.

    A round points every larger neighbour at the smallest neighbour, then every smaller one. It is made of joins and
    minima that combine before the shuffle, so a node with very many edges is no special case. Each round is a table
    in the shared folder, and the one before it is removed. Rounds end when one changes nothing.
    """
    now = stored(edges.where(F.col("a") != F.col("b"))
                 .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "components")
    state = _state(now)
    while state[0]:
        after = stored(_small_star(_large_star(now)), "components")
        new_state = _state(after)
        drop(now)
        now = after
        if new_state == state:
            break
        state = new_state
    linked = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return linked.unionAll(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.join(least, "u").where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")),
                           F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())
