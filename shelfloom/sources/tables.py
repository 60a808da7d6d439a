"""Tables as committed versions: parquet folders beside a log of small files.

Parquet has no row updates. A commit writes its rows to a folder of its own and then takes the
next number by creating one log file that must not exist yet: the file system lets one writer
of several succeed, the others look again and take a later number. Readers see a folder only
through its log file, so a failed or torn write is never read.

A version is ``whole`` (the table as it is from there on), ``changes`` (rows that replace
those with the same key, or add to them) or ``rows`` (rows that only add). The current table is
the last whole version with the last change of each key laid over it; ``compact`` writes it as
a new whole version, and ``vacuum`` removes folders that no reader needs any more.

Each write counts its rows as it goes (``Observation``), and the log file keeps the numbers, so
that how much a version holds is known without reading it.
"""

from __future__ import annotations

import json
import os
import re
import threading
from collections.abc import Callable, Mapping, Sequence
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Versions of changes after which ``compact_if_long`` writes a whole one.
LONG = 16
#: Most rows a task is dealt of a table that lies in too few splits.
_ROWS_A_TASK = 20_000
#: Seconds to wait for observed numbers once the rows are written.
PATIENCE = 30


def _folder(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop.Path


def _create(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file unless it exists; whether this call created it.

    HDFS and stores with conditional writes decide this atomically. Hadoop's local file system
    looks first and writes then, so a local path is created by the operating system instead.
    """
    target, files, _ = _folder(spark, path)
    if files.getScheme() == "file":
        local = target.toUri().getPath()
        os.makedirs(os.path.dirname(local), exist_ok=True)
        # Written under another name and linked, so that nobody reads half of it.
        whole = f"{local}.{uuid4().hex}"
        with open(whole, "w", encoding="utf-8") as out:
            out.write(text)
        try:
            os.link(whole, local)
        except FileExistsError:
            return False
        finally:
            os.unlink(whole)
        return True
    from py4j.protocol import Py4JJavaError

    try:
        out = files.create(target, False)
        out.write(text.encode("utf-8"))
        out.close()
    except Py4JJavaError:
        if files.exists(target):
            return False
        raise
    return True


def _log(spark: SparkSession, root: str, name: str) -> dict[int, dict]:
    """What each committed version holds, by number; one small file a version since the last vacuum."""
    folder, files, path_of = _folder(spark, f"{root}/{name}/_log")
    if not files.exists(folder):
        return {}
    names = [entry.getPath().getName() for entry in files.listStatus(folder)]
    out = {}
    for number in sorted(int(m[1]) for n in names if (m := re.fullmatch(r"(\d+)\.json", n))):
        stream = files.open(path_of(f"{root}/{name}/_log/{number}.json"))
        try:
            out[number] = json.loads(bytes(stream.readAllBytes()).decode("utf-8"))
        finally:
            stream.close()
    return out


def committed_versions(spark: SparkSession, root: str, name: str) -> list[int]:
    return list(_log(spark, root, name))


Built = tuple[DataFrame, dict]


def commit(
    spark: SparkSession, root: str, name: str, build: Callable[[], Built | None], kind: str, key: Sequence[str] = (),
    counts: Mapping[str, Column] | None = None,
) -> tuple[int, DataFrame] | None:
    """Write what ``build`` gives as the next version; its number and the written rows.

    ``build`` gives rows and facts for the log file, or None if there is nothing to write, and
    reads what it needs itself. If another writer takes the number meanwhile, the rows may rest
    on what is no longer so: they are built and written again.

    ``counts`` are aggregates over the written rows. They and the number of rows are taken while
    writing, at the top of the plan, where each partition counts once even if its task runs again.
    """
    aggregates = [F.count(F.lit(1)).alias("rows"), *(column.alias(what) for what, column in (counts or {}).items())]
    while True:
        number = max(_log(spark, root, name), default=-1) + 1
        built = build()
        if built is None:
            return None
        rows, facts = built
        folder = f"v={number}-{uuid4().hex}"
        path = f"{root}/{name}/{folder}"
        seen = Observation()
        rows.withColumn("_version", F.lit(number).cast("bigint")).observe(seen, *aggregates).write.parquet(path)
        written = spark.read.schema(rows.schema).parquet(path)
        numbers = _observed(seen, lambda written=written: written.agg(*aggregates).first().asDict())
        entry = {
            "kind": kind, "folder": folder, "key": list(key), "schema": rows.schema.json(), "counts": numbers, **facts
        }
        if _create(spark, f"{root}/{name}/_log/{number}.json", json.dumps(entry)):
            return number, written


def _observed(seen: Observation, recount: Callable[[], dict]) -> dict:
    """The observed numbers. They come by an event, which a busy driver may drop: then the rows are counted."""
    found: list[dict] = []
    waiting = threading.Thread(target=lambda: found.append(seen.get), daemon=True)
    waiting.start()
    waiting.join(PATIENCE)
    return found[0] if found else recount()


def write_snapshot(df: DataFrame, root: str, name: str, facts: Mapping | None = None) -> DataFrame:
    """Write the next version of a whole table and return it."""
    return commit(df.sparkSession, root, name, lambda: (df, dict(facts or {})), "whole")[1]


def append_changes(
    build: Callable[[], DataFrame], spark: SparkSession, root: str, name: str, key: Sequence[str] = ("id",),
    facts: Mapping | None = None, counts: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Write rows that replace those with the same ``key``; ``build`` gives one row a key at most."""
    return commit(spark, root, name, lambda: (build(), dict(facts or {})), "changes", key, counts)[1]


def append_rows(df: DataFrame, root: str, name: str) -> tuple[int, DataFrame]:
    """Write rows that only add."""
    return commit(df.sparkSession, root, name, lambda: (df, {}), "rows")


def log_entries(spark: SparkSession, root: str, name: str) -> dict[int, dict]:
    return _log(spark, root, name)


def latest_rows(log: DataFrame, key: Sequence[str], order: str) -> DataFrame:
    """The last row of each key of an append-only log, without the column that orders it."""
    rest = [c for c in log.columns if c not in key and c != order]
    last = F.max_by(F.struct(*rest), order).alias("_last")
    return log.groupBy(*key).agg(last).select(*key, *[F.col("_last")[c].alias(c) for c in rest])


def read_snapshot(spark: SparkSession, root: str, name: str, schema: str) -> DataFrame:
    """The current table, or an empty one.

    Rows of the whole version pass beside the changed keys; only changes are grouped. The join
    takes keys alone and is left to Spark's size check, so few changes shuffle no table.
    """
    log = _log(spark, root, name)
    whole = max((n for n, e in log.items() if e["kind"] == "whole"), default=None)
    later = {n: e for n, e in log.items() if whole is None or n > whole}

    def read(*entries: dict, version: bool = False) -> DataFrame:
        ddl = f"{schema}, _version BIGINT" if version else schema
        return spark.read.schema(ddl).parquet(*[f"{root}/{name}/{e['folder']}" for e in entries])

    table = spark.createDataFrame([], schema) if whole is None else read(log[whole])
    added = [e for e in later.values() if e["kind"] == "rows"]
    if added:
        table = table.unionByName(read(*added))
    changes = [e for e in later.values() if e["kind"] == "changes"]
    if changes:
        key = changes[0]["key"]
        changed = read(*changes, version=True)
        last = changed.drop("_version") if len(changes) == 1 else latest_rows(changed, key, "_version")
        if whole is not None or added:
            last = table.join(changed.select(*key), key, "left_anti").select(*table.columns).unionByName(last)
        table = last.select(*table.columns)
    return table


def evolved_schema(spark: SparkSession, root: str, name: str, schema: str, added: Sequence[str] = ()) -> str:
    """``schema`` with the columns that a committed version has beyond it, and ``added`` ones as texts.

    Versions of before such a column was there read as NULL in it; a writer that does not fill it
    passes on what is there.
    """
    fields = {f.name.lower(): f for f in StructType.fromDDL(schema).fields}
    for entry in _log(spark, root, name).values():
        for field in StructType.fromJson(json.loads(entry["schema"])).fields:
            fields.setdefault(field.name.lower(), field)
    known = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields.values())
    return ", ".join([known, *(f"`{a}` STRING" for a in added if a.lower() not in fields)])


def read_versions(spark: SparkSession, root: str, name: str, schema: str | None, versions: Sequence[int]) -> DataFrame:
    """The rows that these versions wrote; without a schema, by that of the last of them."""
    log = _log(spark, root, name)
    if not versions:
        return spark.createDataFrame([], schema)
    schema = schema or StructType.fromJson(json.loads(log[versions[-1]]["schema"]))
    return spark.read.schema(schema).parquet(*[f"{root}/{name}/{log[n]['folder']}" for n in versions])


def compact(spark: SparkSession, root: str, name: str, schema: str) -> int:
    """Write the current table as a whole version; built again if a change comes meanwhile."""
    return commit(spark, root, name, lambda: (read_snapshot(spark, root, name, schema), {}), "whole")[0]


def compact_if_long(spark: SparkSession, root: str, name: str, schema: str, long: int = LONG) -> bool:
    log = _log(spark, root, name)
    whole = max((n for n, e in log.items() if e["kind"] == "whole"), default=-1)
    if sum(n > whole for n in log) < long:
        return False
    compact(spark, root, name, schema)
    return True


def vacuum(spark: SparkSession, root: str, name: str, keep: int = 1) -> list[int]:
    """Remove versions before the ``keep`` last whole ones, and return their numbers.

    Plans that were made before and still read them fail, so ``keep`` should span the longest job.
    Folders that no log file names are left alone: a writer may be at work on them.
    """
    log = _log(spark, root, name)
    wholes = [n for n, e in log.items() if e["kind"] == "whole"]
    if len(wholes) < keep or keep < 1:
        return []
    gone = [n for n in log if n < wholes[-keep]]
    for number in gone:
        for path in (f"{root}/{name}/_log/{number}.json", f"{root}/{name}/{log[number]['folder']}"):
            target, files, _ = _folder(spark, path)
            files.delete(target, True)
    return gone


def read_spread(spark: SparkSession, path: str, narrow: bool = False) -> DataFrame:
    """A stored table whose rows are spread over at least as many tasks as there are cores.

    Parsing runs some ten times slower than shuffling, so a table most of whose rows lie in a few
    splits is dealt out evenly first, whatever its keys: a split of a file has no rows if no row group
    begins in it. A table whose rows lie in enough splits is left as it is: at scale no html is
    shuffled. A ``narrow`` table, which html is rendered from, has very many rows in a split and is
    dealt out unless they are few. The rows of the splits are counted by their footers.
    """
    table = spark.read.parquet(path)
    cores = spark.sparkContext.defaultParallelism
    each = table.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"))
    rows, most = each.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    tasks = cores * max(1, -(-rows // (cores * _ROWS_A_TASK)))
    enough = most * (tasks if narrow else cores) <= 2 * rows
    return table if enough else table.repartition(tasks)


def capture_sink(pages: DataFrame, path: str, site: Column | None = None) -> DataFrame:
    """Store captured pages (page_id, url, html) as one table and return it.

    The length of the html is stored beside it: later stages ask only whether there is
    any, and so never read the wide column.
    """
    captures = _captures(pages, site)
    captures.write.mode("append").parquet(path)
    return pages.sparkSession.read.schema(captures.schema).parquet(path)


def _captures(pages: DataFrame, site: Column | None = None) -> DataFrame:
    return pages.select(
        "page_id", "url", (F.col("site") if site is None else site).alias("site"), F.length("html").alias("html_chars"), "html"
    )
