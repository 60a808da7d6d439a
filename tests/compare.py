"""Run registered queries beside their SQL and compare the rows."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.sql(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return db


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    if isinstance(value, list | tuple):
        return tuple(_plain(v) for v in value)
    return value


_KINDS = {
    "BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double",
    "BOOLEAN": "boolean", "HUGEINT": "hugeint", "TIMESTAMP": "timestamp",
}


def difference(query, sql: str, spark, sf_dir: str, db) -> str | None:
    """What differs between a query and its SQL; None when nothing does."""
    got = query(spark, sf_dir)
    columns = sorted(got.columns)
    rows = Counter(tuple(_plain(v) for v in r) for r in got.select(*columns).collect())
    wanted = db.sql(sql)
    if sorted(wanted.columns) != columns:
        return f"columns {columns} != {sorted(wanted.columns)}"
    places = [wanted.columns.index(c) for c in columns]
    types = [_KINDS.get(str(wanted.types[p]), str(wanted.types[p])) for p in places]
    own = [got.schema[c].dataType.simpleString() for c in columns]
    expected = Counter(tuple(_plain(r[p]) for p in places) for r in wanted.fetchall())
    if rows != expected:
        extra, lost = rows - expected, expected - rows
        return (
            f"{rows.total()} rows, SQL {expected.total()}; only Spark {list(extra)[:2]}; "
            f"only SQL {list(lost)[:2]}; columns {columns}"
        )
    if own != types:
        return f"types {dict(zip(columns, zip(own, types, strict=True), strict=True))}"
    return None if rows else "no rows"


def main() -> None:
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__ as entry
    from tests.conftest import make_session

    sf_dir = sys.argv[1]
    chosen = sys.argv[2:]
    spark, db, sql = make_session(), connect(sf_dir), entry.oracle_sql()
    for name, query in entry.queries().items():
        if chosen and name not in chosen:
            continue
        start = time.time()
        try:
            if name in sql:
                problem = difference(query, sql[name], spark, sf_dir, db)
            else:
                problem = f"rows only: {query(spark, sf_dir).count()}"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{name:28s} {time.time() - start:6.2f}s {problem or 'ok'}", flush=True)


if __name__ == "__main__":
    main()
