"""Connected components of a graph given as edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlspark.llm.shared import released, staged


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node in ``edges`` (a, b: longs); a component is named by its smallest node.

    Contraction: in each round a node joins the neighbour, or itself, whose hash is smallest, edges move to the nodes
    joined, and edges within a node go. Hashes change by round, so a path shrinks by a constant share whatever its ids.
    Nodes without edges, loops and repeated edges don't matter; a null end voids its edge.
    """
    pairs = edges.select("a", "b").filter("a <> b")
    left = staged(pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    moves: list[DataFrame] = []
    while not left.isEmpty():
        def rank(c, turn=len(moves)):
            return F.struct(F.xxhash64(F.lit(turn), c).alias("h"), c.alias("n"))
        least = left.groupBy("a").agg(F.min(rank(F.col("b"))).alias("best"))
        move = staged(least.select(F.col("a").alias("node"), F.least("best", rank(F.col("a")))["n"].alias("to")), "moves")
        moves.append(move)
        first = left.join(move, left["a"] == move["node"]).select(F.col("to").alias("a"), "b")
        other = move.select(F.col("node").alias("_n"), F.col("to").alias("_t"))
        left = released(staged(first.join(other, first["b"] == other["_n"]).select("a", F.col("_t").alias("b")).filter("a <> b").distinct(), "edges"), left)
    if not moves:
        return staged(left.select(F.col("a").alias("node"), F.col("b").alias("component")), "components")
    found = moves[0]
    for k, move in enumerate(moves[1:]):
        step = move.select(F.col("node").alias(f"_n{k}"), F.col("to").alias(f"_t{k}"))
        found = found.join(step, found["to"] == step[f"_n{k}"], "left").select("node", F.coalesce(f"_t{k}", "to").alias("to"))
    found = released(staged(found, "joined"), left, *moves)
    names = found.groupBy("to").agg(F.min("node").alias("component")).withColumnRenamed("to", "_to")
    return released(staged(found.join(names, found["to"] == names["_to"]).select("node", "component"), "components"), found)
