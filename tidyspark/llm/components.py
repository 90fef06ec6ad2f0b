"""Connected components of an edge table by alternating star contraction.

Each round hangs every node's larger neighbours on its smallest neighbour and
then its smaller neighbours on the smallest of them; edges shrink to stars in a
logarithmic number of rounds. Every step is a partial aggregation and a join
on the node; a node of very high degree is one aggregate row joined to its
edges, which adaptive execution splits. Nothing but two numbers per round
reaches the driver; each round is written to the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidyspark.llm.common import write_stage


def _mark(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(r)


def _star(directed: DataFrame) -> DataFrame:
    """For rows (u, v): each u with the smallest of its v and itself."""
    return directed.groupBy("u").agg(F.min("v").alias("least")).select("u", F.least("u", "least").alias("least"))


def components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """Rows (node, root) for every node that has an edge to another node; root is the smallest node.

    Self-edges, repeated edges and null ends are ignored; no edges give no rows.
    """
    e = (edges.select(F.col(u).alias("u"), F.col(v).alias("v")).where("u <> v")
         .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    e = write_stage(e, "edges")
    mark = _mark(e)
    while mark[0]:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # larger neighbours onto the smallest neighbour
        large = (both.join(_star(both), "u").where(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.col("least").alias("v")).where("u <> v").distinct())
        # smaller neighbours (edges point from the larger to the smaller end) and the node onto the smallest of them
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
        down = write_stage(down, "edges-large")
        least = _star(down)
        small = (down.join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v"))
                 .union(least.select("u", F.col("least").alias("v"))).where("u <> v").distinct())
        e = write_stage(small, "edges-small")
        new = _mark(e)
        if new == mark:
            break
        mark = new
    return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
