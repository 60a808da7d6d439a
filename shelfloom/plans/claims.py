"""Claims on the rows of a queue, as an append-only table beside it.

A claim names its owner and how long it holds. Claims are committed by number: of two claimers
at a time one commits first, and the other chooses again from what is left, so no row is claimed
twice. A claimer that is lost holds its rows until the lease ends, and no clean-up is needed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfloom.functions import status as st
from shelfloom.sources.tables import append_changes, committed_versions, read_snapshot

CLAIMS = "id BIGINT, owner STRING, until TIMESTAMP"


def _table(queue: str) -> str:
    return f"claims_{queue}"


def live_claims(spark: SparkSession, root: str, queue: str) -> DataFrame:
    """(id, owner, until) of the claims that still hold."""
    return read_snapshot(spark, root, _table(queue), CLAIMS).filter(F.col("until") > F.current_timestamp())


def claim_rows(
    spark: SparkSession, root: str, queue: str, table: DataFrame, column: str, owner: str, lease: str = "1 hour",
    n: int | None = None, wanted: Sequence[str] = (st.PENDING,),
) -> DataFrame:
    """Claim waiting rows of ``table`` that nobody holds, all or the ``n`` with the lowest ids.

    Gives the claims this call made. ``n`` sorts on one task, so it is for the batches that a
    worker takes.
    """
    until = F.current_timestamp() + F.expr(f"INTERVAL {lease}")

    def build() -> DataFrame:
        waiting = table.filter(F.col(column).isin(*wanted))
        free = waiting.join(live_claims(spark, root, queue).select("id"), "id", "left_anti")
        chosen = free if n is None else free.orderBy("id").limit(n)
        return chosen.select("id", F.lit(owner).alias("owner"), until.alias("until"))

    return append_changes(build, spark, root, _table(queue))


def release(spark: SparkSession, root: str, queue: str, owner: str | None) -> None:
    """End the claims of an owner, once the rows have their outcome."""
    if owner is None or not committed_versions(spark, root, _table(queue)):
        return

    def build() -> DataFrame:
        own = live_claims(spark, root, queue).filter(F.col("owner") == owner)
        return own.withColumn("until", F.lit(None).cast("timestamp"))

    append_changes(build, spark, root, _table(queue))
