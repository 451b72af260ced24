"""Connected components of an edge table, by joins and minima only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import staged

#: Moves up to which their table is broadcast; beyond, adaptive execution splits the tasks of hot nodes.
MOST_BROADCAST = 500_000


def _ordered(edges: DataFrame) -> DataFrame:
    """Distinct edges (low, high) without loops."""
    return edges.filter("a <> b").select(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of edges (a, b); root is the smallest node that links reach.

    In every round each node with smaller neighbours moves to the smallest of
    them, and once more to where that one moves; edges move with their nodes,
    and those that close up or coincide go. The smallest node of a component
    never moves, at least every other node does, and few edges outlive the
    first rounds. A node with many links is one partial minimum for each task.
    """
    left = staged(_ordered(edges), "links")
    size = left.count()
    labels = staged(left.select(F.explode(F.array("low", "high")).alias("node")).distinct().withColumn("root", F.col("node")), "labels", 2 * size)
    nodes = labels.count()
    while size:
        up = staged(left.groupBy("high").agg(F.min("low").alias("low")), "moves", min(size, nodes))
        moving = up.count()
        first, then = up.alias("x"), (F.broadcast(up) if moving <= MOST_BROADCAST else up).alias("y")
        moves = first.join(then, F.col("x.low") == F.col("y.high"), "left").select(F.col("x.high").alias("at"), F.coalesce("y.low", "x.low").alias("to"))
        moves = staged(moves, "moves", moving)
        if moving <= MOST_BROADCAST:
            moves = F.broadcast(moves)
        highs = left.join(moves, left["high"] == moves["at"]).select("low", F.col("to").alias("b"))
        moved = highs.join(moves, highs["low"] == moves["at"], "left").select(F.coalesce("to", "low").alias("a"), "b")
        left = staged(_ordered(moved), "links", size)
        size = left.count()
        labels = staged(labels.join(moves, labels["root"] == moves["at"], "left").select("node", F.coalesce("to", "root").alias("root")), "labels", nodes)
    return labels
