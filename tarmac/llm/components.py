"""Connected components by alternating large-star and small-star joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import Scratch

MAX_ROUNDS = 50


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """One star of edges (u, v) with v < u, which the result's are as well; every table is read in one go for both ends."""
    both = edges.select(F.inline(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v"))))) if larger else edges
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    linked = both.join(least, "u")
    if larger:
        return linked.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    return linked.select(F.inline(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v"))))
                         ).filter("u <> v").distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether every node of the edges (u, v), v < u, hangs on one root that hangs on none."""
    ends = edges.select(F.inline(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")),
                                         F.struct(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))))
    odd = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).filter("up > 1 OR up = 1 AND down = 1")
    return not odd.agg(F.count(F.lit(1))).first()[0]


def components(edges: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """(node, root) of every node with an edge (u, v); root is the component's smallest node.

    Each round is written to the shared folder, and only a row count comes to
    the driver.  Rounds grow with the logarithm of the longest path; edges that
    are stars already take none, and none is run to find that nothing changes.
    Hot nodes are partially aggregated and join by skew-split shuffle.  The
    rounds are tables ``cc`` of ``scratch``; only the last stays.
    """
    scratch = scratch or Scratch(edges.sparkSession, "components")
    edges = scratch.stored(edges.filter("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc")
    for _ in range(MAX_ROUNDS):
        if _settled(edges):
            break
        edges = scratch.stored(_star(_star(edges, True), False), "cc")
        scratch.drop("cc", but_last=True)
    else:
        raise RuntimeError(f"components not settled after {MAX_ROUNDS} rounds")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
