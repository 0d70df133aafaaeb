"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

MAX_ROUNDS = 64


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over undirected edges (a > b).

    Large star: every neighbour above u is tied to u's smallest neighbour (or
    u).  Small star: u and its smaller neighbours are tied to the smallest.
    The minimum is combined before the shuffle, and its join with the edges is
    an ordinary one, so a node with very many neighbours is split like any
    skewed join key.
    """
    if large:
        near = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    else:
        near = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    least = near.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    tied = near.join(least, "u")
    if large:
        out = tied.filter(F.col("v") > F.col("u")).select(F.col("v").alias("x"), F.col("m"))
    else:
        out = tied.select(F.col("v").alias("x"), F.col("m")).unionAll(least.select(F.col("u").alias("x"), "m"))
    return out.filter(F.col("x") != F.col("m")).select(F.greatest("x", "m").alias("a"), F.least("x", "m").alias("b")).distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether every node is a root or hangs on one root only, which a further
    round would leave as it is."""
    ends = edges.select(F.col("a").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionAll(
        edges.select(F.col("b").alias("id"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    nodes = ends.groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.agg(F.count_if((F.col("up") > 1) | ((F.col("up") == 1) & (F.col("down") == 1)))).first()[0] == 0


def components(links: DataFrame) -> DataFrame:
    """(id, root) of every node of links (a, b): root is the smallest id of
    the node's component.  Each round is written to the shared folder."""
    edges = stored(
        links.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    for _ in range(MAX_ROUNDS):
        edges = stored(_star(_star(edges, True), False), "edges")
        if _settled(edges):
            break
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    roots = edges.select(F.col("b").alias("id")).distinct()
    return edges.select(F.col("a").alias("id"), F.col("b").alias("root")).unionAll(roots.select("id", F.col("id").alias("root")))
