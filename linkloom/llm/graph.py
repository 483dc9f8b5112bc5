"""Connected components on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, dropped


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of edges (a, b): root is one node of its component.

    Each round every node joins its smallest neighbour and the edges between what was joined
    stay, so the graph at least halves. Nothing but a count reaches the driver. Edges
    in either direction, repeated edges and loops are fine; no edges give no rows."""
    left = checkpointed(edges.select("a", "b").where("a <> b").distinct())  # deleted as soon as its successor stands
    joined: list[DataFrame] = []
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        to = both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("root"))
        to = checkpointed(to)
        joined.append(to)
        ends = left.join(to.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a")
        ends = ends.join(to.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b")
        ends = ends.where("ra <> rb").select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"))
        left = checkpointed(ends.distinct(), frees=(left,))
    dropped(left)
    if not joined:
        return checkpointed(edges.select(F.col("a").alias("node"), F.col("b").alias("root")).where("1 = 0"))
    out = joined[0]
    for to in joined[1:]:
        step = to.select(F.col("node").alias("root"), F.col("root").alias("next"))
        out = out.join(step, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
    return checkpointed(out, frees=tuple(joined))
