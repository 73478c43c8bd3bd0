"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewell.llm.common import saved


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """Hang each vertex's neighbours (the smaller ones and itself if `small`, else the larger ones)
    on the smallest vertex among its neighbours and itself."""
    if small:
        near = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    else:
        near = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = near.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    hung = near.join(least, "u")
    if small:
        out = hung.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.where("u <> m").select("u", F.col("m").alias("v")))
    else:
        out = hung.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): every vertex of the edges (u, v) with the smallest vertex it can reach. Each
    round is written to the shared folder; the number of rounds is logarithmic in practice."""
    edges = saved(edges.where("u <> v").select("u", "v").distinct(), "edges")
    before = None
    while True:
        edges = saved(_star(_star(edges, small=False), small=True), "stars")
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        before = now
