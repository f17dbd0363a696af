"""Connected components of an edge table, by alternating large and small stars.

Each step hangs nodes on smaller neighbours: first every larger neighbour of a node on the node's
smallest, then every smaller one. The edges become stars in a number of steps that grows with the
logarithm of the longest path. A node's smallest neighbour is an aggregate, joined back, so a hub
of any degree is summed before the shuffle and split in the join; each step's edges are written to
the shared folder, so lost executors cost one step. They have a file for ``FILE_EDGES`` edges, but one
for each core at least: the steps are many, and on a local disk every file costs its writer processes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import settle

FILE_EDGES = 1 << 14


def _star(edges: DataFrame, both_ways: bool) -> DataFrame:
    """Hang the neighbours of each node on the smallest of them and the node."""
    pairs = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if both_ways:
        pairs = pairs.union(edges.select("b", "a"))
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    hung = pairs.join(least, "u")
    hung = hung.where("v > u") if both_ways else hung
    hung = hung.select(F.col("v").alias("a"), F.col("m").alias("b"))
    if not both_ways:
        hung = hung.union(least.select("u", "m"))
    # The larger end comes first.
    return hung.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def files_of(edges: int, cores: int) -> int:
    return max(cores, -(-edges // FILE_EDGES))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that has an edge in ``edges`` (a, b); the root is the smallest node."""
    cores = edges.sparkSession.sparkContext.defaultParallelism
    now = settle(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges", files_of(edges.count(), cores))
    before = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
        now = settle(_star(_star(now, both_ways=True), both_ways=False), "edges", files_of(state[0], cores))
    # All edges lead from a node to its root now.
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select("b", "b").distinct())
