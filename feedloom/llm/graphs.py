"""Connected components of an edge table, in rounds of joins over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.session import staged


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """``node, component`` for every node of ``edges`` (``a``, ``b``): the smallest node reachable.

    Each round links every node to the smallest node near it and replaces an edge by one between the
    representatives found (edges within a component vanish), so the edges shrink; representatives are
    then followed to their own. A node with very many edges is a group key only of a minimum, which
    is combined before the shuffle.
    """
    links = staged(edges.select("a", "b").where("a <> b").distinct(), f"{label}-edges")
    levels: list[DataFrame] = []
    while not links.isEmpty():
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = both.groupBy("a").agg(F.min("b").alias("b"))
        # A node points to its smallest neighbour, or stays where it is the smallest itself.
        point = staged(near.select(F.col("a").alias("node"), F.least("a", "b").alias("to")), f"{label}-points")
        while True:
            # Pointer jumping: chains of falling numbers, halved each time.
            step = point.select(F.col("node").alias("to"), F.col("to").alias("next"))
            jumped = point.join(step, "to").select("node", F.col("next").alias("new"), "to")
            moved = staged(jumped, f"{label}-jumps")
            point = moved.select("node", F.col("new").alias("to"))
            if moved.where("new <> to").isEmpty():
                break
        levels.append(point)
        ends = point.select(F.col("node").alias("a"), F.col("to").alias("x"))
        half = links.join(ends, "a").select("x", "b")
        whole = half.join(point.select(F.col("node").alias("b"), F.col("to").alias("y")), "b")
        raised = whole.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        links = staged(raised, f"{label}-edges")
    if not levels:
        return edges.select(F.col("a").alias("node"), F.col("a").alias("component"))
    found = levels[0].withColumnRenamed("to", "component")
    for level in levels[1:]:
        up = level.select(F.col("node").alias("component"), F.col("to").alias("up"))
        found = found.join(up, "component", "left").select("node", F.coalesce("up", "component").alias("component"))
    return found
