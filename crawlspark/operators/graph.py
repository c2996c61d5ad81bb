"""Connected components of a graph given as edges of named nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlspark.checkpoints import checkpointed


def connected(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); a component bears the name of one of its nodes.

    Each round every node moves to the neighbour, or stays, whose hash of the round is least, and edges follow their
    ends; what falls together is one edge. A round removes a constant share of the nodes, whatever the graph's diameter.
    The moves of all rounds are then followed once, from the last to the first, so no step looks at the whole path.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    live = checkpointed(both.filter("a <> b").distinct())
    rounds: list[DataFrame] = []
    while not live.isEmpty():
        def order(node, turn=len(rounds)):
            return F.struct(F.xxhash64(node, F.lit(turn)).alias("h"), node.alias("n"))

        moves = live.groupBy("a").agg(F.least(F.min(order(F.col("b"))), F.first(order(F.col("a"))))["n"].alias("to"))
        moves = checkpointed(moves.withColumnRenamed("a", "node"))
        rounds.append(moves)
        start = moves.select(F.col("node").alias("a"), F.col("to").alias("x"))
        end = moves.select(F.col("node").alias("b"), F.col("to").alias("y"))
        live = checkpointed(live.join(start, "a").join(end, "b").filter("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct())
    if not rounds:
        return edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    named = rounds[-1].select("node", F.col("to").alias("component"))
    for moves in reversed(rounds[:-1]):
        later = named.select(F.col("node").alias("to"), "component")
        named = checkpointed(moves.join(later, "to", "left").select("node", F.coalesce("component", "to").alias("component")))
    return named
