"""Connected components of links, by DataFrame joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfloom.sources.scratch import materialize


def _least_neighbour(edges: DataFrame, larger_only: bool) -> DataFrame:
    """One step of the two-step method: link neighbours of a node to the least of them.

    With ``larger_only`` the larger neighbours of every node go to the least neighbour (or
    the node itself); else each node's smaller neighbours do. Hubs are aggregated with
    partial results; the join back to the edges is one that Spark can split where skewed.
    """
    if larger_only:
        both = edges.select(F.col("a").alias("n"), F.col("b").alias("m")).unionByName(
            edges.select(F.col("b").alias("n"), F.col("a").alias("m"))
        )
        least = both.groupBy(F.col("n").alias("node")).agg(F.min("m").alias("_m"))
        least = least.select("node", F.least("node", "_m").alias("least"))
        new = both.filter("m > n").join(least, F.col("n") == F.col("node")).select("least", F.col("m").alias("x"))
        kept = new
    else:
        # b is the larger end: its smaller neighbours and itself go to the least of them.
        least = edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("least"))
        new = edges.join(least, F.col("b") == F.col("node")).select("least", F.col("a").alias("x"))
        kept = new.unionByName(least.select("least", F.col("node").alias("x")))
    return kept.filter("least <> x").select(F.col("least").alias("a"), F.col("x").alias("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every end of a link; component is the least node reachable.

    ``links`` has two long columns, a and b. NULL ends and loops link nothing. Links may
    repeat and point either way. No links give no rows. Each round is written down, so a
    lost executor costs at most the round at work; rounds grow with the logarithm of the
    longest path.
    """
    edges = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    edges = materialize(edges.filter("a < b").distinct(), "edges")
    total = None
    while True:
        large = _least_neighbour(edges, larger_only=True)
        edges = materialize(_least_neighbour(large, larger_only=False), "edges")
        # A star forest is reached when a round changes nothing; these sums tell rounds apart.
        now = edges.agg(
            F.count("*"), F.sum(F.col("a").cast("decimal(38,0)")), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if now == total:
            break
        total = now
    return edges.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(
        edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    )
