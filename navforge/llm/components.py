"""Connected components by alternating large-star and small-star.

Edges are kept as (large, small) with large > small.  Large-star moves every
edge's smaller end to that end's own smallest neighbour; small-star links all
smaller neighbours of a node to the smallest of them.  Both are an aggregate
with map-side combining and a join of narrow rows; the aggregates are written
first, so that both sides of each join are plain shuffles that adaptive
execution can split where one node has very many edges.  The edges end as
stars around the smallest node of each component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from navforge.llm.common import Scratch


def connected_components(edges: DataFrame, scratch: Scratch, name: str = "cc") -> DataFrame:
    """(node, component) for every node of ``edges`` (long columns a, b).

    ``component`` is the smallest node that links reach.  Loops and repeated
    edges do no harm; nodes without edges are not returned.
    """
    e = scratch.write(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("large"),
                                      F.least("a", "b").alias("small")).distinct(),
        f"{name}-0")
    step = 0
    while True:
        step += 1
        names = [f"{name}-{step}-low", f"{name}-{step}-moved", f"{name}-{step}-low2"]
        low = scratch.write(e.groupBy(F.col("large").alias("node")).agg(
            F.min("small").alias("m"), F.max("small").alias("most")), names[0])
        moved = scratch.write(
            e.join(low, e["small"] == low["node"], "left")
            .select("large", F.coalesce("m", "small").alias("small"),
                    F.col("m").isNotNull().alias("moved")), names[1])
        if low.filter("m < most").isEmpty() and moved.filter("moved").isEmpty():
            break  # every edge leads to a node without smaller neighbours: stars
        low2 = scratch.write(moved.groupBy(F.col("large").alias("node"))
                             .agg(F.min("small").alias("m")), names[2])
        rest = (moved.join(low2, moved["large"] == low2["node"]).filter("small <> m")
                .select(F.col("small").alias("large"), F.col("m").alias("small")))
        e = scratch.write(rest.union(low2.select("node", "m")).distinct(), f"{name}-{step}")
        scratch.drop(f"{name}-{step - 1}", *names)
    stars = e.select(F.col("large").alias("node"), F.col("small").alias("component"))
    centres = stars.select(F.col("component").alias("node"), "component").distinct()
    return scratch.write(stars.union(centres), f"{name}-labels")
