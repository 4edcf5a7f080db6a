"""Connected components by alternating large-star and small-star rounds.

Each round is two equi-joins with a map-side combined minimum, so no
neighbourhood is ever gathered into one task and no link reaches the driver;
rounds grow with the logarithm of the longest path. Every round is cut with a
reliable checkpoint.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from searchscore.session import cut_lineage


def _with_minimum(sym: DataFrame) -> DataFrame:
    """Rows (u, v, m): every neighbour v of u beside m, the least of u and all its v."""
    low = sym.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return sym.join(low, "u")


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour v > u on the least neighbour of u."""
    out = _with_minimum(_both_ways(edges)).where("v > u")
    return out.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Hang u and every smaller neighbour of u on the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    hung = down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def component_roots(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns u, v); root is the least
    node of its component. Nodes without a link do not occur. Self links and
    repeated links are ignored; links with a null end are ignored."""
    cur = cut_lineage(edges.where("u <> v").select("u", "v").distinct())
    before, nxt = None, cur
    while (state := _state(nxt)) != before and state[0]:
        before, nxt = state, cut_lineage(small_star(large_star(nxt)))
    roots = nxt.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(nxt.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
