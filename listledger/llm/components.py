"""Connected components of a graph given as edges, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listledger.llm.common import write_through


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _star(edges: DataFrame, keep) -> DataFrame:
    """Hang neighbours of each node on the least node among it and them. The least one is a partial aggregate
    and the way back an equi-join, so a hub's neighbours never meet in one task."""
    least = edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return edges.where(keep).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")


def components(edges: DataFrame) -> DataFrame:
    """Rows (node, root) for the nodes of ``edges`` (u, v: any orderable type, no nulls), root being the least node of
    the component. Each round is written to the shared checkpoint folder; the rounds are logarithmic in
    the longest path. Repeated edges and loops do no harm; no edges give no rows."""
    edges = write_through(edges.where("u <> v").select("u", "v").distinct(), "edges")
    state = None
    while True:
        large = _star(_both_ways(edges), F.col("v") > F.col("u"))
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = write_through(small.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), "edges")
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == state:
            break
        state = now
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
