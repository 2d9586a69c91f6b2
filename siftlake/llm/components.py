"""Connected components of a graph given as edges, by joins and grouped minima only."""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from siftlake.workspace import Scratch


def _directed(edges: DataFrame) -> DataFrame:
    """Each edge from its larger to its smaller end, once."""
    return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()


def _larger_to_least(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node is tied to the least of the node and its neighbours. An edge may appear again."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))


def _all_to_least(edges: DataFrame) -> DataFrame:
    """A node and all its smaller neighbours are tied to the least of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    tied = edges.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return _directed(tied.unionByName(least.select("a", F.col("least").alias("b"))))


def _state(edges: DataFrame) -> Row:
    return edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()


def least_reached(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``node, component`` for every node of ``edges`` (``a, b``, of one type that has an order) that reaches a lesser one:
    the least it reaches.

    Alternating the two star steps ends after a number of rounds that grows with the logarithm of the graph: when neither
    changes anything. Each step is written, so that a lost executor costs that step at most. A node with very many edges is
    only ever a key of a grouped minimum or of a join that Spark can split.
    """
    current = scratch.settle(_directed(edges), "edges")
    state, unchanged = _state(current), 0
    for step in itertools.cycle((_larger_to_least, _all_to_least)):
        if unchanged == 2 or not state[0]:
            return current.select(F.col("a").alias("node"), F.col("b").alias("component"))
        before, seen = current, state
        current = scratch.settle(step(before), "edges")
        state = _state(current)
        unchanged = unchanged + 1 if state == seen else 0
        scratch.drop(before)


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``node, component`` for every node of ``edges``: the least node it reaches. No edges: no rows."""
    reached = least_reached(edges, scratch)
    roots = reached.select(F.col("component").alias("node"), "component").distinct()
    return reached.unionByName(roots)


def roots(parents: DataFrame, scratch: Scratch) -> DataFrame:
    """``node, component`` for every node of a forest that has a parent: the root above it. ``parents`` has each such node
    ``b`` once, with its parent ``a``.

    Each round replaces a node's ancestor by that one's, which doubles the steps up, and is written; the number of rounds
    grows with the logarithm of the forest's height.
    """
    current = scratch.settle(parents.select(F.col("b").alias("node"), F.col("a").alias("component")), "roots")
    while True:
        above = current.select(F.col("node").alias("component"), F.col("component").alias("above"))
        up = current.select("node", "component").join(above, "component", "left")
        up = up.select("node", F.coalesce("above", "component").alias("component"), F.col("above").isNotNull().alias("moved"))
        before, current = current, scratch.settle(up, "roots")
        scratch.drop(before)
        if not current.agg(F.bool_or("moved")).first()[0]:
            return current.select("node", "component")
