"""Connected components by alternating large and small stars.

Kiveris et al., "Connected Components in MapReduce and Beyond" (SoCC 2014).  Each round is two
joins over the edges; the edge count never grows, and hubs are split by skew-aware joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.session import stage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step.  ``edges`` (u, v) has u > v.

    Large star: every node links its larger neighbours to its least neighbour (or itself).
    Small star: every node links itself and its smaller neighbours to the least of them."""
    if large:
        near = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        linked = near.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        linked = (edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                  .unionByName(least.select("u", F.col("m").alias("v"))))
    return linked.filter("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the undirected edges (a, b); root is the least node that
    can be reached.  Loops and repeated edges are allowed, null ends are not links; no edges
    give no rows.  Every round is stored in the shared folder, which cuts the lineage."""
    links = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    links = stage(links, "components")
    print_of = lambda df: df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    before = print_of(links)
    while True:
        links = stage(_star(_star(links, large=True), large=False), "components")
        now = print_of(links)
        if now == before:
            break
        before = now
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        links.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
