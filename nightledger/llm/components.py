"""Connected components of a link table, by contraction on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nightledger.llm.frames import cut_lineage


def components(links: DataFrame) -> DataFrame:
    """id and component (the smallest id reachable) of every end of ``links``, a frame with columns a and b.

    In each round every node moves to the smallest node among itself and its neighbours, and on to where that
    one moved, until nothing moves: a chain of n nodes takes about log n such steps. Links between nodes that
    moved to different places go on to the next round. Links and labels stay distributed.
    """
    edges = cut_lineage(links.where("a != b").select("a", "b").distinct())
    moves = []
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        step = both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("to"))
        step = step.select("id", F.least("id", "to").alias("to"))
        moving = True
        while moving:
            onward = step.select(F.col("id").alias("to"), F.col("to").alias("end"))
            step = cut_lineage(step.join(onward, "to").select("id", "to", "end"))
            moving = not step.where("to != end").isEmpty()
            step = step.select("id", F.col("end").alias("to"))
        moves.append(step)
        left = step.select(F.col("id").alias("a"), F.col("to").alias("x"))
        right = step.select(F.col("id").alias("b"), F.col("to").alias("y"))
        moved = edges.join(left, "a").select("b", "x").join(right, "b").where("x != y")
        edges = cut_lineage(moved.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
    if not moves:
        return edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    labels = moves[0].withColumnRenamed("to", "component")
    for step in moves[1:]:
        onward = step.select(F.col("id").alias("component"), "to")
        labels = labels.join(onward, "component", "left")
        labels = labels.select("id", F.coalesce("to", "component").alias("component"))
    return labels
