"""Connected components of a graph given as an edge table, by contraction in random order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wireloom.llm.text import kept
from wireloom.plans.staging import Staging


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of all nodes of `edges` (a bigint, b bigint); the component is its smallest node.

    In each round every node is merged into that neighbour, or itself, which comes first: by number in even rounds,
    which ends stars around their smallest node at once, and in an order drawn for the round in odd ones, in which the
    expected number of nodes falls by a constant factor whatever the graph. A node of many edges is summed before
    the shuffle, and joins leave skewed keys to the engine to split. Only counts reach the driver; the rounds' tables
    go at the end. Loops and repeated edges do no harm; without edges there are no rows.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct()
    with Staging(edges.sparkSession) as table:
        edges, rounds = table(edges, "edges"), []
        while edges.count():
            number = len(rounds)
            merged = table(_nearest(edges, number), f"merged-{number}")
            rounds.append(merged)
            ends = edges.join(merged.select(F.col("node").alias("a"), F.col("into").alias("x")), "a")
            ends = ends.join(merged.select(F.col("node").alias("b"), F.col("into").alias("y")), "b").filter("x != y")
            edges = ends.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct()
            edges = table(edges, f"edges-{number}")
        if not rounds:
            return kept(edges.select(F.col("a").alias("node"), F.col("b").alias("component")))
        found = rounds[0]
        for merged in rounds[1:]:
            step = merged.select(F.col("node").alias("into"), F.col("into").alias("next"))
            found = found.join(step, "into", "left").select("node", F.coalesce("next", "into").alias("into"))
        found = table(found, "found")
        smallest = found.groupBy("into").agg(F.min("node").alias("component"))
        return kept(found.join(smallest, "into").select("node", "component"))


def _nearest(edges: DataFrame, number: int) -> DataFrame:
    """(node, into): the first of each node and its neighbours in the round's order."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    place = (lambda name: F.xxhash64(name, F.lit(number))) if number % 2 else F.col
    rank = lambda name: F.struct(place(name).alias("place"), F.col(name).alias("node"))
    first = both.groupBy("a").agg(F.min(rank("b")).alias("near"))
    return first.select(F.col("a").alias("node"), F.least("near", rank("a"))["node"].alias("into"))
