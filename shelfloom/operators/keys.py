"""Row keys: sequential ids, and joins on keys that may be NULL."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfloom.sources.scratch import materialize

_ROW_BITS = (1 << 33) - 1


def next_id(table: DataFrame, id_column: str = "id") -> Column:
    """Highest id in use, 0 for an empty table, as a scalar subquery."""
    return table.agg(F.coalesce(F.max(id_column), F.lit(0).cast("bigint"))).scalar()


def _free(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores at its end until no column has it."""
    taken, free = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        free.append(name)
    return free


def number_rows(
    df: DataFrame, order: Sequence[str], after: Column | int = 0, id_column: str = "id"
) -> DataFrame:
    """Consecutive ids in ``order``, starting after ``after``.

    Rows are range-partitioned and sorted in parallel, then written with their place in
    their partition, so that the ids stay the same whichever tasks run again. Only the row
    counts, one per partition, meet in one place. ``order`` must be unique for ids that
    repeat between runs.
    """
    part, row, n, before_it = _free(df, "_part", "_row", "_n", "_before")
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = materialize(
        placed.withColumns(
            {
                part: F.spark_partition_id(),
                row: F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS)),
            }
        ),
        "numbered",
    )
    # One row per partition of the sort: its size is bounded by the number of partitions.
    counts = placed.groupBy(part).agg(F.count("*").alias(n))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(part, F.coalesce(F.sum(n).over(before), F.lit(0)).alias(before_it))
    start = after if isinstance(after, Column) else F.lit(after)
    return placed.join(F.broadcast(offsets), part).select(
        (start + F.col(before_it) + F.col(row) + 1).cast("bigint").alias(id_column), *df.columns
    )


def spread(key: str, by: str) -> Column:
    """Second join key for the left side: NULL, but ``by`` where the key is NULL.

    NULL keys match nothing, yet all of them would hash to one partition. Joined null-safe
    to a NULL on the right, this column spreads them.
    """
    return F.when(F.col(key).isNull(), F.col(by).cast("bigint"))


def only_matching(wide: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows of a wide table whose ``key`` is in ``keys``, however many those are.

    No hint: Spark broadcasts the keys if their size allows it.
    """
    keys = keys.select(key).filter(F.col(key).isNotNull()).distinct()
    return wide.join(keys, key, "left_semi")


def left_join_on(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join on a key that may be NULL in many left rows; a right key that repeats repeats its left rows.

    NULL keys match nothing, yet a join would send all of them to one partition. They pass
    beside the join, with NULLs for the right columns, and are never shuffled.
    """
    added = [f for f in right.schema.fields if f.name != key]
    known = left.filter(F.col(key).isNotNull()).join(right.withColumnRenamed(key, "_key"), F.col(key) == F.col("_key"), "left")
    others = left.filter(F.col(key).isNull()).withColumns({f.name: F.lit(None).cast(f.dataType) for f in added})
    return known.drop("_key").unionByName(others)
