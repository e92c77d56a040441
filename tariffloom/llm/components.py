"""Connected components by alternating large and small stars.

Edges stay in tables of the shared folder; nothing of their size comes to
the driver. Each step points nodes at the smallest neighbour known, which
takes a number of steps that grows with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """Every greater neighbour of a node is linked with the node's smallest one."""
    both = edges.select("u", "v").union(edges.select(F.col("v"), F.col("u")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    out = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.where("u <> v")  # repeats go in the small star


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked with the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    linked = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return linked.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(id, component): each node of the edges (u, v) and the smallest node it reaches.

    Loops and repeated edges are fine; nulls are ignored. The smallest node of
    a component is listed as well.
    """
    edges = materialize(edges.where("u is not null and v is not null and u <> v").select("u", "v").distinct(), "edges")
    before = None
    while True:
        mark = edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))"), F.max("u")).first()
        if mark == before or mark[0] == 0:
            break
        before = mark
        edges = materialize(_small_star(_large_star(edges)), "edges")
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).union(roots)
