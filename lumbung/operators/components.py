"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumbung.session import stage


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """Each node that has an edge to another one, with the smallest node of its component: (node, root).

    Every round links each node's larger neighbours, then its smaller ones, to the smallest neighbour, so a chain
    shrinks geometrically; the edges of a round are a written table, never held by the driver. Nulls and self-loops
    are ignored; no edges give an empty table. A node with very many edges is only ever reduced by min(), which
    combines before the shuffle.
    """
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u IS NOT NULL AND v IS NOT NULL AND u <> v")
    e = stage(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    if e.isEmpty():
        return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    last = None
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        down = large.unionByName(low.where("m < u").select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = stage(small.unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), "edges")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == last:
            break
        last = now
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
