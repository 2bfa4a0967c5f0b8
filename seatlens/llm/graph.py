"""Connected components of an edge table, by star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seatlens.session import stage


def _fingerprint(edges: DataFrame) -> tuple:
    """Count and order-free checksum of an edge table; equal tables have equal ones."""
    spread = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count("*"), F.bit_xor(spread), F.sum(F.shiftright(spread, 24))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest node around it."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    smallest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are tied to the smallest of them."""
    smallest = edges.groupBy("u").agg(F.min("v").alias("m"))
    tied = edges.join(smallest, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.union(smallest.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node of each node's component.

    ``edges`` has two columns of one orderable type, ``u`` and ``v``; direction
    and repetition don't matter, loops and nulls are ignored. Nodes without an
    edge don't appear. Each round is written to the shared folder, so lost
    executors cost one round; rounds grow with the logarithm of a component's
    diameter. A node with any number of neighbours is aggregated before it is
    shuffled, and the joins are ordinary equi-joins that Spark may split.
    """
    edge = F.when(F.col("u") > F.col("v"), F.struct("u", "v")).otherwise(
        F.struct(F.col("v").alias("u"), F.col("u").alias("v"))
    )
    now = stage(edges.where("u != v").select(edge.alias("e")).select("e.u", "e.v").distinct(), "edges")
    before = _fingerprint(now)
    while before[0]:
        now = stage(_small_star(_large_star(now)), "edges")
        after = _fingerprint(now)
        if after == before:
            break
        before = after
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("label"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).union(roots).distinct()
