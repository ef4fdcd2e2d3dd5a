"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.llm.common import drop_table, materialize


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every end of a link (x, y); component is the smallest id reachable.

    Each step replaces links by links to the smallest known neighbour (a minimum per node, combined before the
    shuffle), so a hub with very many neighbours is one row after the first step, and long chains shrink by half.
    The loop ends when every node links to its component only. Nulls and self links do not count."""
    edges = (links.filter("x <> y").select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).distinct())
    edges = materialize(edges, "links")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lower, "u")
        nxt = (small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
               .unionByName(lower.select("u", F.col("m").alias("v"))).distinct())
        nxt = materialize(nxt, "links")
        # stars only: no node is both a centre and an end, and no node has two centres
        tangled = nxt.groupBy("u").count().filter("count > 1").select("u").unionByName(nxt.join(nxt.select(F.col("v").alias("c")).distinct(), F.col("u") == F.col("c"), "left_semi").select("u"))
        drop_table(edges)
        edges = nxt
        if tangled.isEmpty():
            break
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
