"""Connected components of an undirected graph, by alternating star steps.

Every round points nodes at smaller ones they can reach through a neighbour;
a few rounds make every component a star around its smallest node.  Each round
is written to the shared checkpoint folder, so plans and lineage stay short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelake.llm.scratch import drop, written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    out = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` point from larger u to smaller v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    out = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.union(least.select("u", F.col("m").alias("v"))).distinct()


def _is_done(edges: DataFrame) -> bool:
    """Is every component a star: no node points at two, none that is pointed
    at points on?"""
    ends = edges.select(F.col("u").alias("n"), F.lit(1).alias("out"), F.lit(0).alias("into")).union(
        edges.select("v", F.lit(0), F.lit(1)))
    seen = ends.groupBy("n").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return seen.filter((F.col("out") > 1) | ((F.col("out") == 1) & (F.col("into") == 1))).isEmpty()


def components(edges: DataFrame, a: str, b: str, name: str = "components") -> DataFrame:
    """(node, component): the smallest node reachable, for every node with an
    edge to another node that is not itself the smallest."""
    now = written(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u > v").distinct(), name)
    while not now.isEmpty() and not _is_done(now):
        last, now = now, written(_small_star(_large_star(now)), name)
        drop(last)
    return now.select(F.col("u").alias("node"), F.col("v").alias("component"))


def extended(comps: DataFrame, links: DataFrame, a: str, b: str, name: str) -> DataFrame:
    """``comps`` (node, component) with further links: only components that a
    link joins to another one are worked on."""
    of = comps.select(F.col("node").alias("_n"), F.col("component").alias("_c"))
    for end in (a, b):
        links = links.join(of, F.col(end) == F.col("_n"), "left").withColumn(end, F.coalesce("_c", end)).drop("_n", "_c")
    roots = components(links, a, b, name)
    if roots.isEmpty():
        return comps
    to = roots.select(F.col("node").alias("_n"), F.col("component").alias("_c"))
    moved = comps.join(to, F.col("component") == F.col("_n"), "left").select("node", F.coalesce("_c", "component").alias("component"))
    return written(moved.union(roots), name)
