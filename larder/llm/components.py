"""Connected components of a distributed edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import settle


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (smallest node reachable) for every node that has an edge.

    ``edges`` has two columns ``x`` and ``y`` of one ordered type.  Rounds of
    "large star" and "small star" steps re-hang every node under the smallest
    neighbour it knows, until all stars are flat: about log2 of the longest
    path many rounds.  A hub's neighbours are never gathered: its smallest one
    is a plain aggregate, joined back to its edges.  Each round is written to
    the shared folder, so lineage stays short.
    """
    ordered = edges.where("x <> y").select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y"))
    stars = settle(ordered.distinct(), "links")
    before = None
    while True:
        state = stars.agg(F.count("*").alias("n"), F.expr("sum(cast(xxhash64(x, y) as decimal(38)))").alias("s")).first()
        if state == before:
            break
        before = state
        stars = settle(_small_star(_large_star(stars)), "links")
    return stars.select(F.col("x").alias("node"), F.col("y").alias("root")).unionByName(
        stars.select(F.col("y").alias("node"), F.col("y").alias("root")).distinct()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node hangs under the smallest of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("y").alias("x"), F.col("x").alias("y")))
    least = both.groupBy(F.col("x").alias("node")).agg(F.min("y").alias("m"))
    hung = both.join(least, F.col("x") == F.col("node")).where("y > x")
    return hung.select(F.col("y").alias("x"), F.least("x", "m").alias("y")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours hang under the smallest of these neighbours."""
    least = edges.groupBy(F.col("x").alias("node")).agg(F.min("y").alias("m"))
    hung = edges.join(least, F.col("x") == F.col("node"))
    down = hung.select(F.col("y").alias("x"), F.col("m").alias("y")).unionByName(hung.select("x", F.col("m").alias("y")))
    return down.where("x <> y").distinct()
