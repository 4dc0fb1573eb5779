"""Connected components of a graph given as edges, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_hot, materialize


def _stars(edges: DataFrame, larger: bool, n_rows: int) -> DataFrame:
    """Hang each vertex's neighbours (larger ones, or smaller ones and itself) on its least neighbour.

    A hub with over a thousandth of the at most ``n_rows`` edges is broadcast to them.
    """
    least = edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count(F.lit(1)).alias("n"))
    hung = join_hot(edges, least, ["u"], "n", n_rows)
    if larger:
        return hung.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.where("u != m").select("u", F.col("m").alias("v")))


def connected_components(edges: DataFrame) -> DataFrame:
    """(vertex, root) for every vertex of ``edges`` (a, b: long); root is the least vertex reachable.

    Rounds of large-star and small-star contraction, each a grouped minimum and an
    equi-join, run until the edges stop changing; each round is written to the shared
    folder so that lineage stays short. The number of rounds grows with the logarithm of
    the longest chain. Edges with a null end and self-edges are ignored; no edges give no
    rows.
    """
    now = materialize(edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    seen, n_rows = None, 2 * now.count()
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = materialize(_stars(both, True, n_rows).distinct(), "large")
        now = materialize(_stars(large, False, n_rows).where("u != v").distinct(), "edges")
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == seen:
            break
        seen, n_rows = tuple(state), 2 * state[0]
    roots = now.select(F.col("v").alias("vertex")).distinct().withColumn("root", F.col("vertex"))
    return now.select(F.col("u").alias("vertex"), F.col("v").alias("root")).unionByName(roots)
