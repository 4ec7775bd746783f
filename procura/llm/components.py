"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from procura.llm.common import stored


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Links each node's neighbours (large: the greater ones of all, small: it
    and its smaller ones) to the least node of its neighbourhood."""
    near = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    least = near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    d = near.join(least, "a")
    if large:
        out = d.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = d.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b")))
    return out.filter("a <> b").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """node, component (the least node of its component) of all nodes that have
    an edge; ``edges``: a, b (long).  Loops and repeated edges do not matter."""
    e = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    e = stored(e, "edges")
    before = None
    while True:
        now = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            break
        before = now
        # a > b in all rows: the large star needs both ends, the small one b < a
        e = stored(_stars(_stars(e, large=True), large=False), "edges")
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
