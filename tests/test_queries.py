"""Every registered query gives the rows of its SQL, on the smallest tables."""

from __future__ import annotations

import shutil

import duckdb
import pytest

import __spark_entry__ as entry
from shelfloom.plans.queries import QUERIES, html
from tests.compare import connect, difference
from tests.conftest import TESTDATA

SF_DIR = f"{TESTDATA}/sf0.001"
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, db, name):
    assert difference(entry.queries()[name], SQL[name], spark, SF_DIR, db) is None


def test_filename_once_equals_sql_where_urls_repeat(spark, tmp_path):
    shutil.copytree(SF_DIR, tmp_path, dirs_exist_ok=True, ignore=shutil.ignore_patterns("pages.parquet"))
    given = f"FROM '{SF_DIR}/pages.parquet'"
    more = f"SELECT * REPLACE (page_id + 1000 AS page_id) {given} WHERE page_id % 5 < 2"
    duckdb.sql(f"COPY (SELECT * {given} UNION ALL {more}) TO '{tmp_path}/pages.parquet'")
    name = "filename_once"
    assert difference(entry.queries()[name], SQL[name], spark, str(tmp_path), connect(str(tmp_path))) is None


def test_nodes_are_stored_with_the_columns_a_query_reads(spark):
    nodes, _ = html._stored_nodes(spark, SF_DIR, "text")
    assert nodes.columns == ["page_id", "node_id", "end_id", "tag", "text"]


def test_entry(spark):
    assert entry.entry(spark).count() > 0
