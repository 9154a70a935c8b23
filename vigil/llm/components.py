"""Connected components of an edge list, distributed.

Alternating large-star and small-star steps: every step links the neighbours of
a node to the smallest of them, so the edge list never grows and ends as one
star per component after a number of rounds logarithmic in the size of the
largest component.  Every round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import materialize


def _star(edges: DataFrame) -> DataFrame:
    """Per edge (u, v): (v, m) and (u, m) with m the smallest of u and its neighbours in ``edges``."""
    least = edges.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
    return edges.join(least, "u")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (u, v), root the smallest node of its
    component.  Self-loops make a node known; edges may repeat, in either direction.
    """
    u, v, m = F.col("u"), F.col("v"), F.col("m")
    edges = materialize(edges.select("u", "v").distinct(), "edges")
    before = None
    while True:
        both = edges.union(edges.select(v.alias("u"), u.alias("v")))
        large = _star(both).where(v > u).select(v.alias("u"), m.alias("v"))
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where(u != v)
        stars = _star(down)
        small = stars.select(v.alias("u"), m.alias("v")).union(stars.select(u, m.alias("v")))
        edges = materialize(small.where(u != v).distinct(), "edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return edges.select(u.alias("node"), v.alias("root")).union(edges.select(v, v)).distinct()
