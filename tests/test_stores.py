"""Files, snapshots, exports, streams and whole runs."""

from __future__ import annotations

import json

import duckdb
from pyspark.sql import functions as F

from shelfloom import schemas
from shelfloom.operators import frontier as fr
from shelfloom.plans.render import product_pages
from shelfloom.plans.stages import discovered_bases, run_stages
from shelfloom.rules import SITES
from shelfloom.sources import export, files, requests, scratch, tables
from shelfloom.streaming import incremental as inc
from tests.conftest import TESTDATA

ITEM = """<li class="ui-search-layout__item"><h3 class="poly-component__title-wrapper">
<a class="poly-component__title" href="{0}">{1}</a></h3></li>"""
NEXT = '<li class="andes-pagination__button--next"><a href="{0}">Siguiente</a></li>'
DETAIL = """<h1 class="ui-pdp-title">{0}</h1><span class="andes-money-amount__fraction">{1}</span>"""


def captures(spark, *rows):
    pages = spark.createDataFrame([(i, u, h) for i, u, h in rows], schemas.PAGES)
    return pages.select(
        "page_id", "url", F.lit("mercadolibre").alias("site"), F.length("html").alias("html_chars"), "html"
    )


def test_listing_files(spark, tmp_path):
    for name in ("page_10.html", "page_2.html", "page_x.html", "page_1.html.tmp", "xpage_1.html"):
        (tmp_path / name).write_bytes(f"<p>\r\n{name}\r</p>".encode())
    (tmp_path / "output").mkdir()
    (tmp_path / "output" / "page_7.html").write_text("no")
    (tmp_path / "page_3.html").mkdir()
    found = files.scan_listing_files(spark, str(tmp_path))
    assert [r.page_id for r in files.numeric_file_order(found).collect()] == [2, 10]
    assert {r.html for r in found.collect()} == {"<p>\npage_10.html\n</p>", "<p>\npage_2.html\n</p>"}


def test_files_written_and_read_back(spark, tmp_path):
    rows = spark.createDataFrame([("a.html", "é\n<p>"), ("None.html", "x")], "filename STRING, html STRING")
    assert files.html_file_sink(rows, f"file://{tmp_path}/out").count() == 2
    back = files.scan_product_files(spark, f"{tmp_path}/out").collect()
    assert {(r.filename, r.html) for r in back} == {("a.html", "é\n<p>"), ("None.html", "x")}


def test_files_dealt_into_folders_are_listed_by_tasks(spark, tmp_path):
    rows = [(f"page_{n}.html", f"<p>{n}\r\n") for n in range(40)] + [("other.html", "é"), ("empty.html", "")]
    captures = spark.createDataFrame(rows, "filename STRING, html STRING").repartition(5)
    assert files.html_file_sink(captures, f"file://{tmp_path}", 16).count() == 42
    (tmp_path / "dealt-00003" / "page_7.html.tmp").write_text("half")
    (tmp_path / "dealt-00003" / ".page_8.html").write_text("hidden")
    found = files.scan_product_files(spark, f"file://{tmp_path}", 16)
    assert sorted(map(tuple, found.collect())) == sorted((n, h.replace("\r\n", "\n")) for n, h in rows)
    listed = files.scan_listing_files(spark, f"file://{tmp_path}", 16)
    assert [r.page_id for r in files.numeric_file_order(listed).collect()] == list(range(40))
    assert "Scan text" not in found._jdf.queryExecution().executedPlan().toString()


def test_rows_of_one_row_group_are_dealt_out(spark, tmp_path):
    path, name = f"{tmp_path}/t.parquet", "spark.sql.files.maxPartitionBytes"
    duckdb.sql(f"COPY (SELECT i, md5(i::VARCHAR) || md5((i + 1)::VARCHAR) AS t FROM range(60000) r(i)) TO '{path}'")
    spark.conf.set(name, "100k")
    try:
        # More splits than cores, and all rows in one of them.
        spread = tables.read_spread(spark, path)
        rows = [r["count"] for r in spread.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset(name)
    assert sum(rows) == 60000 and max(rows) <= 60000 / spark.sparkContext.defaultParallelism + 100


def test_run_config(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"site": "amazon", "pages_to_crawl": 4}, indent=2))
    (tmp_path / "b.json").write_text(json.dumps([{"site": "x", "database_path": "d", "pages_to_crawl": 0}]))
    rows = sorted(map(tuple, requests.read_requests(spark, str(tmp_path)).collect()))
    assert rows == [("amazon", "mini.sqlite", 4), ("x", "d", 0)]


def test_snapshots(spark, tmp_path):
    root = str(tmp_path)
    assert tables.read_snapshot(spark, root, "t", "a INT").count() == 0
    tables.write_snapshot(spark.range(3).selectExpr("CAST(id AS INT) a"), root, "t")
    grown = tables.read_snapshot(spark, root, "t", "a INT").union(spark.sql("SELECT 9 a"))
    tables.write_snapshot(grown, root, "t")
    (tmp_path / "t" / "v=2").mkdir()
    assert tables.committed_versions(spark, root, "t") == [0, 1]
    assert sorted(r.a for r in tables.read_snapshot(spark, root, "t", "a INT").collect()) == [0, 1, 2, 9]


def test_export_keeps_null_and_empty_apart(spark, tmp_path):
    row = {f: None for f in export.FIELDS} | {"id": 1, "name": 'a "b", c', "slug": ""}
    schema = (
        "id BIGINT, source_url STRING, product_url STRING, product_code STRING, name STRING, slug STRING, "
        "price DOUBLE, currency STRING, reviews STRING, image STRING, parsed_at TIMESTAMP"
    )
    df = spark.createDataFrame([tuple(row[f] for f in export.FIELDS)], schema)
    for name, write, read in (
        ("csv", export.export_csv, lambda p: spark.read.csv(p, header=True, escape='"', nullValue="NULL")),
        ("json", export.export_json, spark.read.json),
    ):
        write(df, f"{tmp_path}/{name}")
        back = read(f"{tmp_path}/{name}").first()
        assert (back["name"], back["slug"], back["source_url"]) == ('a "b", c', "", None)


def test_whole_run(spark, tmp_path):
    root, rule = str(tmp_path), SITES["mercadolibre"]
    listing = ITEM.format("p1", "Uno") + ITEM.format("p2", "Dos") + ITEM.format("https://click1.x", "Ad")
    listings = captures(
        spark,
        (7, "seed", NEXT.format("list_Desde_49_NoIndex_True") + listing),
        (8, "list", listing + ITEM.format("p3", "Tres")),
    )
    details = captures(spark, (1, "p1", DETAIL.format("Uno!", "1.000")), (2, "p2", DETAIL.format("Dos", "x")))
    request = spark.createDataFrame([(1, "seed", 2)], "request_no BIGINT, seed_url STRING, pages_to_crawl INT")
    request = request.withColumns(
        {
            "pagination_mode": F.lit(rule.pagination_mode), "url_style": F.lit(rule.url_style),
            "items_per_page": F.lit(rule.items_per_page),
        }
    )
    request = fr.with_base(discovered_bases(request, listings))
    at = F.lit("2024-01-01 00:00:00")
    for _ in range(2):  # A second run changes nothing but the requeued failure.
        counts = run_stages(spark, root, at, request, listings, details)
        assert {(r.stage, r.status): r.n for r in counts.collect()} == {
            ("listing", "fetched"): 1, ("listing", "failed"): 1,
            ("product_fetch", "fetched"): 2, ("product_fetch", "failed"): 1,
            ("product_fetch", "failed_unfetchable"): 1,
            ("product_parse", "parsed_succeeded"): 1, ("product_parse", "parsing_failed"): 1,
            ("product_parse", None): 2,
        }
    rows = tables.read_snapshot(spark, root, "products", schemas.PRODUCTS).orderBy("id").collect()
    assert [(r.id, r.product_url, r.slug, r.price) for r in rows] == [
        (1, "p1", "uno", 1000.0), (2, "p2", "dos", None), (3, None, "ad", None), (4, "p3", "tres", None),
    ]
    only = run_stages(spark, root, at, stages=())
    assert only.count() == 8


def test_listing_stream_equals_batch_and_repeats_nothing(spark, tmp_path):
    root, landing = str(tmp_path / "root"), str(tmp_path / "landing")
    first = captures(spark, (1, "a", ITEM.format("p1", "Uno") + ITEM.format("https://click1.x", "Ad")))
    second = captures(spark, (2, "b", ITEM.format("p1", "Otro") + ITEM.format("p2", "Dos")), (3, "c", "<p>"))

    def run():
        inc.listing_stream(spark, landing, root).awaitTermination()
        rows = inc.read_batches(spark, root, "products", schemas.PRODUCTS)
        return sorted((r.id, r.product_url, r.slug) for r in rows.collect())

    tables.capture_sink(first, landing)
    assert run() == [(1, "p1", "uno"), (2, None, "ad")]
    assert run() == [(1, "p1", "uno"), (2, None, "ad")]
    tables.capture_sink(second, landing)
    assert run() == [(1, "p1", "uno"), (2, None, "ad"), (3, "p2", "dos")]
    errors = inc.read_batches(spark, root, "errors", schemas.ERRORS).collect()
    assert [(r.key, r.reason) for r in errors] == [("3", "no_container")]
    assert inc.read_batches(spark, root, "listing_products", inc.LISTING).count() == 5


def test_an_empty_capture_never_replaces_a_full_one(spark, tmp_path):
    root, landing = str(tmp_path / "root"), str(tmp_path / "landing")
    for step in ((1, "p1", DETAIL.format("Uno!", "1.000")), (2, "p1", "")):
        tables.capture_sink(captures(spark, step), landing)
        inc.product_stream(spark, landing, root).awaitTermination()
        last = inc.latest_parses(inc.read_batches(spark, root, "product_parses", inc.PARSES)).collect()
        assert [(r.product_url, r.page_id, r.name, r.price) for r in last] == [("p1", 1, "Uno!", 1000.0)]
    first = captures(spark, (1, "seed", NEXT.format("list_Desde_49_NoIndex_True")), (2, "seed", ""))
    request = spark.createDataFrame([("seed",)], "seed_url STRING")
    assert discovered_bases(request, first).first().discovered == discovered_bases(request, first.filter("page_id = 1")).first().discovered
    assert discovered_bases(request, first).first().discovered is not None


def test_a_batch_that_runs_again_replaces_its_rows(spark, tmp_path):
    root = str(tmp_path)
    schema = "k BIGINT, v BIGINT"
    landing = f"{root}/landing"
    spark.range(10).selectExpr("id % 3 k", "id v").write.parquet(landing)
    inc.stream_dedup(spark, landing, schema, "k", root, F.col("v")).awaitTermination()
    once = sorted(map(tuple, inc.read_batches(spark, root, "unique", schema).collect()))
    # Forget the progress: batch 0 comes again over its own rows.
    inc._run(
        spark, landing, schema, f"{root}/_fresh",
        lambda batch, number: inc._write(
            batch.groupBy("k").agg(F.min("v").alias("v"))
            .join(inc.read_batches(spark, root, "unique", schema, before=number).select("k"), "k", "left_anti"),
            root, "unique", number,
        ) and None,
        None,
    ).awaitTermination()
    assert once == [(0, 0), (1, 1), (2, 2)]
    assert sorted(map(tuple, inc.read_batches(spark, root, "unique", schema).collect())) == once


def test_bounded_dedup_stream(spark, tmp_path):
    landing = str(tmp_path / "in")
    rows = [("a", "2024-01-01 00:00:00"), ("a", "2024-01-01 00:01:00"), ("b", "2024-01-01 00:02:00")]
    spark.createDataFrame(rows, "url STRING, ts STRING").selectExpr("url", "CAST(ts AS TIMESTAMP) ts").write.parquet(landing)
    stream = spark.readStream.schema("url STRING, ts TIMESTAMP").parquet(landing)
    unique = inc.bounded_stream_dedup(stream, "url", "ts", "1 hour")
    unique.writeStream.format("memory").queryName("unique_urls").trigger(availableNow=True).option(
        "checkpointLocation", str(tmp_path / "cp")
    ).start().awaitTermination()
    assert sorted(r.url for r in spark.table("unique_urls").collect()) == ["a", "b"]


def test_scratch_uses_the_shared_folder(spark):
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    path = scratch.scratch_path(spark, "x")
    assert not base or path.startswith(base)


def test_streams_read_nothing_of_what_earlier_batches_wrote(spark, tmp_path, monkeypatch):
    read = inc.read_batches

    def small(session, root, table, *rest, **named):
        assert table == "product_ids", "only the last ids, one row a batch"
        return read(session, root, table, *rest, **named)

    root, landing = str(tmp_path / "root"), str(tmp_path / "landing")
    rows = [(i, f"u{i}", ITEM.format(f"p{i % 7}", f"N{i}") + ITEM.format("https://click1.x", "Ad")) for i in range(1, 13)]
    for row in rows:
        tables.capture_sink(captures(spark, row).coalesce(1), landing)
    with monkeypatch.context() as patch:
        patch.setattr(inc, "read_batches", small)
        inc.listing_stream(spark, landing, root, files_per_batch=3).awaitTermination()
        tables.capture_sink(captures(spark, (13, "u13", ITEM.format("p6", "Late") + ITEM.format("p99", "New"))), landing)
        inc.listing_stream(spark, landing, root, files_per_batch=3).awaitTermination()
    found = read(spark, root, "products", schemas.PRODUCTS).orderBy("id").collect()
    assert [r.id for r in found] == list(range(1, 21)) and found[-1].product_url == "p99"
    assert sorted(r.product_url for r in found if r.product_url) == sorted([*(f"p{i}" for i in range(7)), "p99"])
    assert {r.product_url: r.source_page_id for r in found if r.product_url and r.product_url != "p99"} == {f"p{i % 7}": i for i in range(1, 8)}
    assert sum(r.product_url is None for r in found) == 12


def test_stream_dedup_over_many_batches_equals_one_batch(spark, tmp_path):
    landing, schema = f"{tmp_path}/landing", "k STRING, v BIGINT"
    seen: dict = {}
    for step in range(6):
        values = [(None if i % 5 == 0 else f"k{(i * 7 + step * 3) % 20}", 100 - i + step) for i in range(8)]
        for k, v in values:
            if (k, step) not in seen:
                seen[k, step] = v
            seen[k, step] = min(v, seen[k, step])
        spark.createDataFrame(values, schema).coalesce(1).write.mode("append").parquet(landing)
        inc.stream_dedup(spark, landing, schema, "k", str(tmp_path / "root"), F.col("v")).awaitTermination()
    first = {}
    for k, step in sorted(seen, key=lambda x: x[1]):
        first.setdefault(k, seen[k, step])
    got = [tuple(r) for r in inc.read_batches(spark, str(tmp_path / "root"), "unique", schema).collect()]
    assert len(got) == len(first) and dict(got) == first


def test_the_state_of_products_is_looked_up_once_a_batch(spark, tmp_path, monkeypatch):
    plans, number = [], inc.number_products

    def watched(new, *rest):
        plans.append(new._jdf.queryExecution().executedPlan().toString())
        return number(new, *rest)

    monkeypatch.setattr(inc, "number_products", watched)
    tables.capture_sink(captures(spark, (1, "u1", ITEM.format("/a", "A")), (2, "u2", ITEM.format("/b", "B"))), f"{tmp_path}/landing")
    inc.listing_stream(spark, f"{tmp_path}/landing", str(tmp_path)).awaitTermination()
    assert inc.read_batches(spark, str(tmp_path), "products", schemas.PRODUCTS).count() == 2
    # The sort that gives the ids reads its rows twice: they are written before.
    assert plans and all("FileScan parquet" in p and "ExistingRDD" not in p for p in plans)


def test_product_pages_bring_columns_of_the_part_without_a_join(spark):
    part = spark.read.parquet(f"{TESTDATA}/sf0.001/part.parquet")
    pages = product_pages(part, F.col("p_name").alias("name"))
    assert "Exchange" not in pages._jdf.queryExecution().executedPlan().toString()
    assert pages.columns == [*product_pages(part).columns, "name"]
    assert pages.select("page_id", "name").exceptAll(part.select("p_partkey", "p_name")).count() == 0
