"""Connected components by contraction, with joins only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tintloom.llm.common import discard, stored


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of `edges` (a, b); the component is its smallest node.

    In each round every node moves to its smallest neighbour or stays; edges between the new places go on to
    the next round. A node that has a smaller neighbour never stays, so each round at least halves the nodes
    of a component with edges left; stars and paths of stars are done in one or two.
    """
    current = stored(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    places: DataFrame | None = None
    while not current.isEmpty():
        both = current.select(F.col("a").alias("node"), F.col("b").alias("near")).union(current.select("b", "a"))
        step = stored(both.groupBy("node").agg(F.min("near").alias("near")).select("node", F.least("node", "near").alias("place")), "places")
        moved = (
            current.join(step.select(F.col("node").alias("a"), F.col("place").alias("pa")), "a")
            .join(step.select(F.col("node").alias("b"), F.col("place").alias("pb")), "b")
            .where("pa <> pb")
            .select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b"))
            .distinct()
        )
        former, current = current, stored(moved, "edges")
        discard(former)
        if places is None:
            places = step
        else:
            next_ = step.select(F.col("node").alias("place"), F.col("place").alias("next"))
            former, places = places, stored(places.join(next_, "place", "left").select("node", F.coalesce("next", "place").alias("place")), "places")
            discard(former, step)
    if places is None:
        return current.select(F.col("a").alias("node"), F.col("a").alias("component"))
    discard(current)
    return places.select("node", F.col("place").alias("component"))
