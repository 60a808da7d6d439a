"""How many rows each stage wrote, by the numbers its writes observed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfloom.functions import status as st
from shelfloom.sources.tables import log_entries

COUNTS = "stage STRING, table STRING, version INT, status STRING, n BIGINT"


def by_status(column: str) -> dict[str, Column]:
    """Aggregates for ``commit``: rows of each status, and those without one."""
    each = {status: F.count_if(F.col(column) == status) for status in st.STATUSES}
    return {**each, "": F.count_if(F.col(column).isNull())}


def observed_counts(spark: SparkSession, root: str, tables: Sequence[str], after: Mapping[str, int] | None = None) -> DataFrame:
    """(stage, table, version, status, n) of every commit that names its stage; no table is read.

    A row says how many of the rows that the commit wrote have this status in the column that the
    stage decides: the running counts of inserted, fetched, parsed and failed items. Error tables
    have no status; theirs is NULL. ``after`` leaves out the versions of a table up to its number, to
    tell one run from those before. The log files are read, whose number compaction with ``vacuum``
    bounds; versions removed by it are no longer told.
    """
    out = []
    for table in tables:
        for version, entry in log_entries(spark, root, table).items():
            if "stage" not in entry or version <= (after or {}).get(table, -1):
                continue
            counts = dict(entry["counts"])
            rows = counts.pop("rows")
            found = {(status or None): n for status, n in counts.items() if n} if counts else {None: rows}
            out += [(entry["stage"], table, version, status, n) for status, n in found.items()]
    return spark.createDataFrame(out, COUNTS)
