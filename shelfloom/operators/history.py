"""Logs to current state: latest status, captures, attempts and counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MAX_ATTEMPTS = 4


def attempt_number(attempts: DataFrame, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """Attempts (url, ts, seq, ok) numbered per URL; those beyond the allowed number go.

    The bound reaches the map side as a group limit, so a hot URL shuffles few rows.
    """
    order = Window.partitionBy("url").orderBy("ts", "seq")
    numbered = attempts.withColumn("attempt", F.row_number().over(order))
    return numbered.filter(F.col("attempt") <= max_attempts)


def attempt_outcome(attempts: DataFrame, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """Per URL: did an allowed attempt succeed, and which was the first that did."""
    return (
        attempt_number(attempts, max_attempts)
        .groupBy("url")
        .agg(
            F.bool_or("ok").alias("ok"),
            F.min(F.when(F.col("ok"), F.col("attempt"))).alias("ok_attempt"),
            F.count("*").alias("attempts"),
        )
    )


def latest_status(log: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last status per key of an append-only log."""
    newest = F.max_by("status", F.struct(*order))
    return log.groupBy(*keys).agg(newest.alias("status"))


def latest_capture(captures: DataFrame) -> DataFrame:
    """Last capture per file name, of (filename, page_id, seq)."""
    return captures.groupBy("filename").agg(F.max_by("page_id", "seq").alias("page_id"))


def slug_collisions(captures: DataFrame) -> DataFrame:
    """File names more than one capture was stored under."""
    counts = captures.groupBy("filename").agg(F.count("*").alias("captures"))
    return counts.filter(F.col("captures") > 1)


def stage_counts(table: DataFrame, stage: str, column: str = "status") -> DataFrame:
    """(stage, status, n) of a queue table."""
    return (
        table.groupBy(F.col(column).alias("status"))
        .agg(F.count("*").alias("n"))
        .select(F.lit(stage).alias("stage"), "status", "n")
    )
