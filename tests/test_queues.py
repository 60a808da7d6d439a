"""Frontier, products, ids and logs, against plain Python on small inputs."""

from __future__ import annotations

import datetime
import random

import pytest
from pyspark.sql import functions as F

from shelfloom import schemas
from shelfloom.functions import status as st
from shelfloom.operators import frontier as fr
from shelfloom.operators import history as hi
from shelfloom.operators import products as pr
from shelfloom.operators.keys import left_join_on, number_rows, only_matching
from shelfloom.operators.nested import BIN, descendants, first_descendant
from shelfloom.rules import SITES
from shelfloom.sources import scratch

AT = datetime.datetime(2024, 1, 1)
NOW = F.lit


def frontier(spark, *rows):
    return spark.createDataFrame([(i, u, AT, f, s) for i, u, f, s in rows], schemas.FRONTIER)


def seeds(spark, *urls):
    rows = [(0, n, u) for n, u in enumerate(urls)]
    return spark.createDataFrame(rows, "request_no BIGINT, page_no INT, url STRING")


def every_state(spark):
    states = [None, "pending", "in_progress", "fetched", "failed"]
    rows = [(n + 1, f"u{n}", None, s) for n, s in enumerate(states)]
    return frontier(spark, *rows, (6, None, None, "failed"), (7, None, "x.html", "pending"))


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_seeding(spark):
    later = F.lit("2025-01-01").cast("timestamp")
    table = every_state(spark)
    given = seeds(spark, "new2", "u0", "u2", "u3", "u4", "new1", "new2", None)
    after = fr.seed_frontier(table, given, later)
    state = {r.url: (r.id, r.status, r.discovered_at) for r in after.collect() if r.url}
    assert {u: state[u][1] for u in state} == {
        "u0": "pending", "u1": "pending", "u2": "pending", "u3": "fetched", "u4": "pending",
        "new1": "pending", "new2": "pending",
    }
    assert (state["new2"][0], state["new1"][0]) == (8, 9)
    assert state["u0"][2] == AT and state["new1"][2] == datetime.datetime(2025, 1, 1)
    assert after.count() == 9


def test_seeding_twice_is_seeding_once(spark):
    given = seeds(spark, "a", "b")
    once = scratch.materialize(fr.seed_frontier(every_state(spark), given, F.lit(AT)), "t")
    twice = fr.seed_frontier(once, given, F.lit(AT))
    assert rows_of(once, "id", "url", "status") == rows_of(twice, "id", "url", "status")


def test_expand_pages(spark):
    rows = [("dynamic", "s", "d_Desde_49_x", 2, "offset"), ("dynamic", "s", None, 3, "offset"),
            ("algorithmic", "s", None, 2, "suffix"), ("static", "s", None, 0, "suffix"),
            ("static", "s", None, -1, "suffix")]
    requests = spark.createDataFrame(
        rows, "pagination_mode STRING, seed_url STRING, discovered STRING, pages_to_crawl INT, url_style STRING"
    ).withColumn("items_per_page", F.lit(49))
    based = fr.with_base(requests)
    urls = sorted(r.url for r in fr.expand_pages(based).collect())
    assert urls == ["d", "d_Desde_49_NoIndex_True", "s&page=1", "s&page=2"]
    assert fr.base_errors(based).count() == 1


def test_unknown_site_raises(spark):
    requests = spark.createDataFrame([("amazon", 1), ("bazaar", 2)], "site STRING, pages_to_crawl INT")
    with pytest.raises(ValueError, match="bazaar"):
        fr.require_known_sites(requests)
    known = fr.crawl_requests(requests).collect()
    assert [(r.site, r.seed_url) for r in known] == [("amazon", SITES["amazon"].seed_urls[0])]


def test_outcomes(spark):
    table = frontier(
        spark, (1, "a", None, "pending"), (2, "b", None, "pending"), (3, "c", "old.html", "pending"),
        (4, "a2", None, "failed"), (5, None, None, "pending"),
    )
    pages = spark.createDataFrame(
        [(1, "a", "<p>"), (2, "a", ""), (3, "b", ""), (4, "c", "x"), (5, "a2", "x"), (6, None, "x")],
        schemas.PAGES,
    )
    after = fr.fetch_outcome(table, pages, of=st.PENDING)
    assert rows_of(after, "id", "status", "filename") == [
        (1, "fetched", "page_1.html"), (2, "failed", None), (3, "fetched", "old.html"),
        (4, "failed", None), (5, "failed", None),
    ]


def test_claims(spark):
    table = every_state(spark)
    assert [r.id for r in fr.claim_batch(table, n=1).collect()] == [2]
    assert rows_of(fr.claim(table, st.IN_PROGRESS, n=1).filter("status = 'in_progress'"), "id") == [(2,), (3,)]
    assert rows_of(fr.claim(table, st.IN_PROGRESS).filter("status = 'in_progress'"), "id") == [(2,), (3,), (7,)]
    assert fr.claim_batch(fr.claim(table, st.IN_PROGRESS)).count() == 0


def listing(spark, rows):
    return spark.createDataFrame(rows, "source_page_id BIGINT, pos INT, link STRING, slug STRING")


def test_dedup_takes_the_first_and_keeps_linkless_rows(spark):
    rng = random.Random(1)
    rows = [(p, n, rng.choice([None, "hot", "hot", f"l{rng.randrange(40)}"]), f"s{p}-{n}")
            for p in range(60) for n in range(1, 6)]
    wanted, seen = [], set()
    for row in sorted(rows):
        if row[2] is None or row[2] not in seen:
            wanted.append(row)
            seen.add(row[2])
    rng.shuffle(rows)
    got = rows_of(pr.dedup_products(listing(spark, rows)), "source_page_id", "pos", "link", "slug")
    assert got == sorted(wanted, key=repr)


def test_inserting_twice_adds_nothing(spark):
    empty = spark.createDataFrame([], schemas.PRODUCTS)
    found = pr.dedup_products(listing(spark, [(1, 1, "a", "x"), (1, 2, None, "y"), (2, 1, "a", "z"), (2, 2, None, None)]))
    first = scratch.materialize(pr.insert_products(empty, found), "t")
    assert rows_of(first, "id", "product_url", "slug", "fetch_status") == [
        (1, "a", "x", "pending"), (2, None, "y", "pending"), (3, None, None, "pending"),
    ]
    assert pr.insert_products(first, found).count() == 0


def products(spark, *rows):
    names = [f.split()[0] for f in schemas.PRODUCTS.split(", ")]
    empty = spark.createDataFrame([], schemas.PRODUCTS).schema
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], empty)


def test_parsed_values_overwrite_with_null(spark):
    table = products(
        spark,
        {"id": 1, "product_url": "a", "price": 9.0, "slug": "old", "fetch_status": "fetched"},
        {"id": 2, "product_url": "b", "price": 9.0, "slug": "old", "fetch_status": "fetched"},
        {"id": 3, "product_url": "c", "price": 9.0, "slug": "old", "fetch_status": "fetched"},
        {"id": 4, "product_url": "a4", "price": 9.0, "fetch_status": "failed"},
        {"id": 5, "product_url": "a5", "price": 9.0, "fetch_status": "fetched", "parse_status": "parsed_succeeded"},
        {"id": 6, "price": 9.0, "fetch_status": "failed_unfetchable"},
    )
    parsed = spark.createDataFrame(
        [("a", None, None, "ARS", None, None, "4.0", None, None), ("b", "s", None, None, 1.0, None, None, None, "price_unreadable"),
         ("a4", "s", None, None, 1.0, None, None, None, None), ("a5", "s", None, None, 1.0, None, None, None, None)],
        "product_url STRING, slug STRING, name STRING, currency STRING, price DOUBLE, product_code STRING, "
        "reviews STRING, image STRING, reason STRING",
    )
    after = pr.apply_parsed(table, pr.parsed_values(parsed), "product_url", F.lit(AT))
    assert rows_of(after, "id", "product_url", "slug", "price", "reviews_num", "parse_status", "parsed_at") == [
        (1, "a", None, None, 4, "parsed_succeeded", AT), (2, "b", "old", 9.0, None, "parsing_failed", None),
        (3, "c", "old", 9.0, None, "parsing_failed", None), (4, "a4", None, 9.0, None, None, None),
        (5, "a5", None, 9.0, None, "parsed_succeeded", None), (6, None, None, 9.0, None, None, None),
    ]


def test_product_fetch(spark):
    table = products(
        spark,
        {"id": 1, "product_url": "a", "slug": "s", "fetch_status": "pending"},
        {"id": 2, "product_url": "b", "slug": "s", "fetch_status": "pending"},
        {"id": 3, "slug": "s", "fetch_status": "pending"},
        {"id": 4, "product_url": "a4", "fetch_status": "failed", "filename": "f.html"},
        {"id": 5, "product_url": "c", "fetch_status": "pending"},
    )
    pages = spark.createDataFrame([(1, "a", "x"), (2, "a4", "x"), (3, "c", "x")], schemas.PAGES)
    assert rows_of(pr.product_fetch_outcome(table, pages), "id", "fetch_status", "filename") == [
        (1, "fetched", "s.html"), (2, "failed", None), (3, "failed_unfetchable", None),
        (4, "failed", "f.html"), (5, "fetched", "None.html"),
    ]


def test_numbering_is_consecutive_in_order(spark):
    rows = spark.range(5000).select(
        (F.col("id") * 7919 % 5000).alias("k"), F.when(F.col("id") % 3 == 0, F.lit("hot")).alias("v")
    )
    got = number_rows(rows, ["v", "k"], after=10).orderBy("v", "k").collect()
    assert [r.id for r in got] == list(range(11, 5011))


def test_attempts_of_a_hot_url(spark):
    log = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("u"), (F.col("id") % 100).cast("string"))).alias("url"),
        (F.col("id") * 31 % 3000).cast("timestamp").alias("ts"), F.col("id").alias("seq"),
        (F.col("id") % 7 == 0).alias("ok"),
    )
    by_url = {}
    for r in sorted(log.collect(), key=lambda r: (r.ts, r.seq)):
        by_url.setdefault(r.url, []).append(r.ok)
    wanted = sorted(
        (u, any(a[:4]), a[:4].index(True) + 1 if any(a[:4]) else None, len(a[:4])) for u, a in by_url.items()
    )
    assert sorted(map(tuple, hi.attempt_outcome(log).collect())) == wanted
    plan = hi.attempt_number(log)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_containment_over_bins(spark):
    rng = random.Random(2)
    nodes, spans = [], []
    for page in range(3):
        size = 700 if page == 0 else 40
        for n in range(size):
            end = min(size - 1, n + rng.choice([0, 0, 1, 5, BIN, 3 * BIN]))
            nodes.append((page, n, end))
            if n % 9 == 0:
                spans.append((page, n, end))
    ddl = "page_id BIGINT, node_id INT, end_id INT"
    containers, all_nodes = spark.createDataFrame(spans, ddl), spark.createDataFrame(nodes, ddl)
    wanted = sorted((p, c, n) for p, c, e in spans for q, n, _ in nodes if p == q and c < n <= e)
    got = descendants(containers, all_nodes).select("page_id", "container_id", "node_id").collect()
    assert sorted(map(tuple, got)) == wanted
    picked = all_nodes.filter("node_id % 4 = 1")
    first = {(p, c): None for p, c, _ in spans}
    for p, c, n in reversed(wanted):
        if n % 4 == 1:
            first[p, c] = n
    got = first_descendant(containers, picked).collect()
    assert {(r.page_id, r.container_id): r.node_id for r in got} == first


def test_keys_narrow_whatever_their_number(spark):
    wide = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "url STRING, html INT")
    keys = spark.createDataFrame([("a",), ("a",), (None,), ("z",)], "url STRING")
    assert rows_of(only_matching(wide, keys, "url"), "html") == [(1,)]
    assert only_matching(wide, wide, "url").count() == 2


def test_null_keys_pass_beside_the_join(spark):
    left = spark.createDataFrame([("a", 1), (None, 2), (None, 3), ("b", 4)], "url STRING, id BIGINT")
    right = spark.createDataFrame([("a", "x")], "url STRING, name STRING")
    joined = left_join_on(left, right, "url")
    assert rows_of(joined.orderBy("id"), "id", "name") == [(1, "x"), (2, None), (3, None), (4, None)]
    assert "isnotnull(url" in joined._jdf.queryExecution().executedPlan().toString()


def test_filename_once_with_a_url_captured_twice(spark):
    frontier = every_state(spark).limit(3)
    names = frontier.select("url", F.lit("n2").alias("new_filename"))
    names = names.unionByName(names.withColumn("new_filename", F.lit("n1")))
    assert fr.filename_once(frontier, names).count() == frontier.count()


def test_status_filter_reaches_the_scan(spark):
    path = scratch.scratch_path(spark, "t")
    every_state(spark).write.parquet(path)
    plan = fr.claim_batch(spark.read.parquet(path), n=5).select("id", "url")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(status,pending)" in text and "TakeOrderedAndProject" in text
    assert "discovered_at" not in text


def test_capture_lengths_keep_html_out_of_the_outcome(spark):
    from shelfloom.sources.tables import capture_sink

    path = scratch.scratch_path(spark, "t")
    pages = spark.createDataFrame([(1, "u1", "<p>")], schemas.PAGES)
    stored = capture_sink(pages, path, site=F.lit("s"))
    plan = fr.fetch_outcome(every_state(spark), stored)._jdf.queryExecution().executedPlan().toString()
    schema = [line for line in plan.splitlines() if "FileScan parquet" in line][0].split("ReadSchema")[1]
    assert "html_chars" in schema and "html:" not in schema
