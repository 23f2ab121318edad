"""Connected components of a graph of long ids, by large-star / small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm.common import cut_lineage


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _star(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    return least, pairs.join(least, "u")


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of u is hung on the least of u and its neighbours."""
    _, met = _star(_both(edges))
    return met.where("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """u and its smaller neighbours are hung on the least of them (edges run from larger to smaller)."""
    least, met = _star(edges)
    return met.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _stars(edges: DataFrame) -> bool:
    """Whether every node hangs on one other only, and on one that hangs on none."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("hangs")), F.struct(F.col("v").alias("node"), F.lit(0).alias("hangs")))).alias("end"))
    seen = ends.groupBy("end.node").agg(F.sum("end.hangs").alias("hangs"), F.min("end.hangs").alias("least"))
    return seen.where("hangs > 1 or hangs = 1 and least = 0").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node on an edge (u, v); root is the least node reachable.

    Self-loops and repeated edges are ignored; an empty table gives an empty
    one.  Each round costs two aggregates and joins on node ids (a hub's
    neighbours are one row each, so a skewed join can split them) and its
    result is checkpointed; the number of rounds grows with the logarithm of
    the longest path, and stars need none.
    """
    now = cut_lineage(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct())
    while not _stars(now):
        now = cut_lineage(_small_star(_large_star(now)))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
