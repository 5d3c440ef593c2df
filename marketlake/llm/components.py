"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import discard, materialise


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable from every linked node.

    Each round rewires every node's larger neighbours, then its smaller ones, to the smallest
    neighbour; rounds needed grow with the logarithm of the longest path.  Hubs are aggregated
    before the shuffle and joined by splittable joins; each round is a written table."""
    u, v = F.col(a).cast("long"), F.col(b).cast("long")
    edges = materialise(links.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).filter("u <> v").distinct(), "cc")
    mark = _mark(edges)
    while mark[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.min("u")).alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        new = materialise(small.select("e.u", "e.v").filter("u <> v").distinct(), "cc")
        discard(edges)
        before, edges, mark = mark, new, _mark(new)
        if mark == before:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))


def _mark(edges: DataFrame) -> tuple:
    """Two scalars that tell one edge set from another."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
