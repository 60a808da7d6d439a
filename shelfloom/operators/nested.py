"""Containment inside pages as table operators on ``html_nodes``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BIN = 64


def descendants(containers: DataFrame, nodes: DataFrame) -> DataFrame:
    """(container, node) rows for the nodes inside each container.

    A container covers the node ids ``node_id + 1 .. end_id`` of its page. Both sides are
    cut into bins of node ids and joined on (page, bin), so a node meets the containers
    around it and not all those of its page, and a huge page is spread over many tasks.
    """
    first, last = F.col("node_id") + 1, F.col("end_id")
    spans = (
        containers.filter(last >= first)
        .select(
            F.col("page_id"),
            F.col("node_id").alias("container_id"),
            F.col("end_id").alias("container_end"),
            F.explode(
                F.sequence(F.floor(first / BIN).cast("int"), F.floor(last / BIN).cast("int"))
            ).alias("bin"),
        )
        .alias("c")
    )
    inside = nodes.withColumn("bin", F.floor(F.col("node_id") / BIN).cast("int")).alias("n")
    on = (
        (F.col("c.page_id") == F.col("n.page_id"))
        & (F.col("c.bin") == F.col("n.bin"))
        & (F.col("n.node_id") > F.col("c.container_id"))
        & (F.col("n.node_id") <= F.col("c.container_end"))
    )
    return spans.join(inside, on).select(
        "c.page_id", "c.container_id", *[f"n.{c}" for c in nodes.columns if c != "page_id"]
    )


def first_descendant(containers: DataFrame, nodes: DataFrame) -> DataFrame:
    """Per container, the first of ``nodes`` inside it; NULL where there is none."""
    rest = [c for c in nodes.columns if c not in ("page_id", "node_id")]
    first = (
        descendants(containers, nodes)
        .groupBy("page_id", "container_id")
        .agg(F.min_by(F.struct("node_id", *rest), "node_id").alias("first"))
    )
    keys = containers.select("page_id", F.col("node_id").alias("container_id"))
    return keys.join(first, ["page_id", "container_id"], "left").select(
        "page_id", "container_id", "first.*"
    )
