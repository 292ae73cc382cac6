"""Connected components of an edge table by alternating star steps (Kiveris et al., 2014).

Every step is a grouped minimum and a join on the vertex; the neighbours of a vertex are never gathered in one place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riskloom.llm.exprs import parts_for
from riskloom.session import stage

EDGES_PER_PART = 250_000


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of each vertex that is not the least of its component; ``root`` is the least one."""
    now = edges.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    parts = parts_for(now.count(), EDGES_PER_PART)
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # merged where the rows are: broadcasts of every step would add up in the driver
        large = both.filter(F.col("v") > F.col("u")).join(least.hint("merge"), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.coalesce(parts)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        # a vertex points to its least neighbour, and so do its other neighbours
        rest = large.join(least.hint("merge"), "u").filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = rest.unionByName(least.select("u", F.col("m").alias("v"))).coalesce(parts).distinct()
        now = stage(now.coalesce(parts), "stars")
        # done if no vertex is pointed to and points on
        if not now.join(now.select(F.col("v").alias("w")).hint("merge"), F.col("u") == F.col("w"), "left_semi").coalesce(parts).limit(1).count():
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
