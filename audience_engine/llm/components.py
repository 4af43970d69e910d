"""Connected components of a link table, as Spark joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, drop_table


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Each node's neighbours (the larger ones, or the smaller ones and itself) are linked to its least neighbour."""
    near = _both_ways(edges) if large else edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = near.join(least, "u")
    if large:
        out = joined.where("v > u").select("v", "m")
    else:
        out = joined.select("v", "m").union(least.select(F.col("u").alias("v"), "m"))
    return out.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every id in ``links`` (columns a, b): the least id that can be reached.

    Large-star and small-star rounds in turn; their number grows with the logarithm of the
    component size.  Every round is written to the shared folder (the one before is then deleted), and a
    star's hub is a join key that AQE can split."""
    edges = cut_lineage(links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")

    def mark(e: DataFrame):
        return e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    seen = mark(edges)
    while seen[0]:
        before = edges
        edges = cut_lineage(_star(_star(edges, True), False), "stars")
        drop_table(before)
        now = mark(edges)
        if now == seen:
            break
        seen = now
    low = edges.groupBy("u").agg(F.min("v").alias("component"))
    hubs = edges.select(F.col("v").alias("id")).distinct().join(low.select(F.col("u").alias("id")), "id", "left_anti")
    return low.select(F.col("u").alias("id"), "component").union(hubs.select("id", F.col("id").alias("component")))


__all__ = ["components"]
