"""Connected components by alternating large and small stars, all in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import drop, stage


def star(edges: DataFrame, large: bool) -> tuple[DataFrame, list[str]]:
    """One star step over (u, v) with u > v.  The minimum of each node is staged, so the join has plain scans below."""
    sym = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least, a = stage(sym.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "cc-least")
    joined = sym.join(least, "u")
    if large:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").union(least.select("u", F.col("m").alias("v")))
    out, b = stage(out.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc-edges")
    drop(edges.sparkSession, a)
    return out, [b]


def stars(edges: DataFrame) -> bool:
    """Whether every u has one edge and no v has any, so that each v is its nodes' root."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(edges.select("v", F.lit(0), F.lit(1)))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 OR up + down > 1").isEmpty()


def components(edges: DataFrame) -> tuple[DataFrame, str]:
    """(node, root) of each node but the roots of the undirected edges (u, v), root being the least node reachable; and its path.

    Steps repeat until the edges are stars, a logarithmic number of times; every step is written to the shared folder.  Edges that are
    stars already take none.  Repeated edges, loops and an empty table are fine; null nodes must not occur.
    """
    spark = edges.sparkSession
    now, at = stage(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc-edges")
    paths = [at]
    while not stars(now):
        for large in (True, False):
            now, more = star(now, large)
            drop(spark, *paths)
            paths = more
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")), paths[0]
