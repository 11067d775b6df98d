"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quarry.llm.common import SENT_ROWS, bounded
from quarry.session import materialize


def _neighbours(e: DataFrame) -> DataFrame:
    return e.select("u", "v").unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _least(e: DataFrame, few: bool) -> DataFrame:
    """(u, m): the smallest v of each u, marked for broadcast if there are few."""
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    return F.broadcast(least) if few else least


def _large_star(e: DataFrame, few: bool) -> DataFrame:
    n = _neighbours(e)
    least = _least(n, few).select("u", F.least("u", "m").alias("m"))
    return n.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(e: DataFrame, few: bool) -> DataFrame:
    # the row of the smallest neighbour itself becomes the node's own edge to it
    return e.join(_least(e, few), "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))


def _is_star_forest(e: DataFrame) -> bool:
    """Whether every node has one neighbour or only neighbours that have no other."""
    ends = (e.select(F.col("u").alias("x"), F.col("v").alias("parent"), F.lit(0).alias("root"))
            .unionAll(e.select(F.col("v").alias("x"), F.lit(None).cast("long").alias("parent"), F.lit(1).alias("root"))))
    seen = ends.groupBy("x").agg(F.min("parent").alias("lo"), F.max("parent").alias("hi"), F.max("root").alias("root"))
    return not seen.where("lo <> hi or (lo is not null and root = 1)").limit(1).count()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node that has an edge; the component is its
    smallest node.  Each round is written as a table, so a lost executor costs
    one round at most; minima are combined map-side.  ``edges`` is read more
    than once: pass a written table.

    A round never has more edges than the one before, and an edge has two ends.
    So if edges are few, all minima can be broadcast and repeated edges may
    stay: a round then shuffles twice, which leaves the driver fewer tasks to
    follow."""
    few = bounded(edges, SENT_ROWS // 2)
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v")
    while True:
        e = _small_star(_large_star(e, few), few)
        e = materialize(e if few else e.distinct(), "components")
        if _is_star_forest(e):
            break
    nodes, roots = e.select(F.col("u").alias("node"), F.col("v").alias("component")), e.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return nodes.unionAll(roots).distinct() if few else nodes.unionAll(roots.distinct())


def merged(found: DataFrame, newer: DataFrame) -> DataFrame:
    """Components whose own components were joined further: ``newer`` is over
    the components of ``found`` and over nodes that it does not have."""
    on = newer.select(F.col("node").alias("_n"), F.col("component").alias("_c"))
    return materialize(
        found.join(on, F.col("component") == F.col("_n"), "left").select("node", F.coalesce("_c", "component").alias("component"))
        .unionAll(newer.join(found.select("node"), "node", "left_anti")), "components-merged")
