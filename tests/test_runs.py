"""Committed tables, claims, capture stores, and runs over them."""

from __future__ import annotations

import re
import threading
from dataclasses import replace

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from shelfloom import schemas
from shelfloom.operators import frontier as fr
from shelfloom.operators.history import stage_counts
from shelfloom.plans import claims
from shelfloom.plans.counts import observed_counts
from shelfloom.plans.stages import COUNTED, discovered_bases, run_stages
from shelfloom.operators.extract import extract_product, own_fields
from shelfloom.rules import SITES, PageRule, Selector
from shelfloom.sources import tables
from shelfloom.sources.captures import CaptureStore, rules_mark, unparsed
from tests.test_stores import DETAIL, ITEM, NEXT, captures

AT = "2024-01-01 00:00:00"
T = "id BIGINT, status STRING"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def table(spark, *values):
    return spark.createDataFrame(list(values), T)


# --- committed versions ---


def test_changes_lie_over_the_whole_table(spark, tmp_path):
    root = str(tmp_path)
    tables.write_snapshot(table(spark, (1, "a"), (2, "a"), (3, None)), root, "t")
    tables.append_changes(lambda: table(spark, (2, "b"), (4, "b")), spark, root, "t")
    tables.append_changes(lambda: table(spark, (4, "c"), (1, None)), spark, root, "t")
    now = [(1, None), (2, "b"), (3, None), (4, "c")]
    key = lambda r: r[0]
    assert sorted(map(tuple, tables.read_snapshot(spark, root, "t", T).collect()), key=key) == now
    assert not tables.compact_if_long(spark, root, "t", T, long=3) and tables.compact_if_long(spark, root, "t", T, long=2)
    assert tables.committed_versions(spark, root, "t") == [0, 1, 2, 3]
    assert tables.vacuum(spark, root, "t") == [0, 1, 2] and len(list((tmp_path / "t").glob("v=*"))) == 1
    assert sorted(map(tuple, tables.read_snapshot(spark, root, "t", T).collect()), key=key) == now
    tables.append_changes(lambda: table(spark), spark, root, "t")
    assert tables.read_snapshot(spark, root, "t", T).count() == 4


def test_a_table_may_start_with_changes_or_rows(spark, tmp_path):
    root = str(tmp_path)
    for step in ((1, "a"), (1, "b")):
        tables.append_changes(lambda step=step: table(spark, step), spark, root, "c")
        tables.append_rows(table(spark, step), root, "r")
    assert rows(tables.read_snapshot(spark, root, "c", T)) == [(1, "b")]
    assert rows(tables.read_snapshot(spark, root, "r", T)) == [(1, "a"), (1, "b")]
    assert rows(tables.read_versions(spark, root, "r", T, [1])) == [(1, "b")]
    assert tables.read_versions(spark, root, "r", T, []).count() == 0


def test_of_many_writers_each_takes_its_own_number(spark, tmp_path):
    root = str(tmp_path)
    tables.write_snapshot(table(spark, (0, "0")), root, "t")

    def one_more():
        last = tables.read_snapshot(spark, root, "t", T).agg(F.max("id")).first()[0]
        return table(spark, (last + 1, "x"))

    errors = []

    def work():
        try:
            for _ in range(2):
                tables.append_changes(one_more, spark, root, "t")
        except Exception as error:  # noqa: BLE001
            errors.append(error)

    threads = [threading.Thread(target=work) for _ in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors and tables.committed_versions(spark, root, "t") == list(range(9))
    # Each built on what the one before committed: no number came twice, none was lost.
    assert [r[0] for r in rows(tables.read_snapshot(spark, root, "t", T))] == list(range(9))


def test_a_write_that_fails_is_never_seen(spark, tmp_path):
    root = str(tmp_path)
    tables.write_snapshot(table(spark, (1, "a")), root, "t")
    with pytest.raises(Exception, match="DIVIDE|zero"):
        tables.append_changes(lambda: spark.sql("SELECT CAST(raise_error('DIVIDE') AS BIGINT) id, 'x' status"), spark, root, "t")
    assert rows(tables.read_snapshot(spark, root, "t", T)) == [(1, "a")] and tables.committed_versions(spark, root, "t") == [0]


# --- claims ---


def test_no_row_has_two_claimers(spark, tmp_path):
    root = str(tmp_path)
    queue = table(spark, *((i, "pending" if i % 4 else "fetched") for i in range(40)))
    taken: dict[str, list[int]] = {}

    def work(owner):
        taken[owner] = [r.id for _ in range(2) for r in claims.claim_rows(spark, root, "q", queue, "status", owner, n=4).collect()]

    threads = [threading.Thread(target=work, args=(f"w{i}",)) for i in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    every = [i for ids in taken.values() for i in ids]
    assert len(every) == len(set(every)) == 30 and all(i % 4 for i in every)
    assert claims.claim_rows(spark, root, "q", queue, "status", "late").count() == 0
    claims.release(spark, root, "q", "w1")
    assert sorted(r.id for r in claims.claim_rows(spark, root, "q", queue, "status", "late").collect()) == sorted(taken["w1"])


def test_a_lost_claimer_loses_its_rows_when_the_lease_ends(spark, tmp_path):
    root, queue = str(tmp_path), table(spark, (1, "pending"), (2, "pending"))
    assert claims.claim_rows(spark, root, "q", queue, "status", "lost", lease="0 seconds").count() == 2
    assert claims.claim_rows(spark, root, "q", queue, "status", "next").count() == 2


# --- runs ---


def request(spark, *values):
    rule = SITES["mercadolibre"]
    asked = spark.createDataFrame(list(values), "request_no BIGINT, seed_url STRING, pages_to_crawl INT")
    return asked.withColumns({c: F.lit(getattr(rule, c)) for c in ("pagination_mode", "url_style", "items_per_page")})


SEED = "https://listado.mercadolibre.com.ar/boya-natacion-aguas-abiertas"


def _without_page_columns(plan):
    """Names of the columns that go through the plan's exchanges."""
    return {c.split("#")[0] for block in re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*?)\]", plan) for c in block.split(", ")}


def test_runs_parse_new_landings_only_and_shuffle_no_html(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    listings, details = CaptureStore(spark, root, "listing_captures"), CaptureStore(spark, root, "product_captures")
    listing = ITEM.format("p1", "Uno") + ITEM.format("p2", "Dos")
    listings.land(captures(spark, (7, SEED, NEXT.format(f"{SEED}_Desde_49_NoIndex_True") + listing)))
    details.land(captures(spark, (1, "p1", DETAIL.format("Uno!", "1.000"))))
    plans: list[str] = []
    write = DataFrameWriter.parquet

    def recorded(self, *args, **kwargs):
        mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        plans.append(self._df._jdf.queryExecution().explainString(mode))
        return write(self, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", recorded)
    monkeypatch.setattr(type(spark.range(0).write), "parquet", recorded)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        def run():
            plans.clear()
            asked = fr.with_base(discovered_bases(request(spark, (1, SEED, 2)), listings, root=root))
            counts = run_stages(spark, root, F.lit(AT), asked, listings, details)
            return {(r.stage, r.status): r.n for r in counts.collect()}, [p for p in plans if "MapInArrow" in p]

        counts, parsing = run()
        assert counts["product_fetch", "fetched"] == 1 and counts["product_fetch", "failed"] == 1
        assert counts["product_parse", "parsed_succeeded"] == 1
        # Next links, listing rows and product rows: one narrow pass each.
        assert len(parsing) == 3 and not any(") Exchange" in p for p in parsing)
        assert plans and not any("html" in _without_page_columns(p) for p in plans)
        again, parsing = run()
        assert again == counts and parsing == []
        # A late capture, an empty one, and one that repeats a URL come in landings of their own.
        details.land(captures(spark, (2, "p2", DETAIL.format("Dos!", "2.000")), (3, "p1", "")))
        listings.land(captures(spark, (8, SEED, listing + ITEM.format("p9", "Nueve"))))
        mark = rules_mark(SITES)
        assert unparsed(details, root, "product_parses", mark) == [1] and unparsed(listings, root, "listing_products", mark) == [1]
        counts, parsing = run()
        assert len(parsing) == 3 and counts["product_parse", "parsed_succeeded"] == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 << 20))
    found = tables.read_snapshot(spark, root, "products", schemas.PRODUCTS).orderBy("id").collect()
    assert [(r.product_url, r.name, r.price) for r in found] == [("p1", "Uno!", 1000.0), ("p2", "Dos!", 2000.0), ("p9", None, None)]
    # Results of other rules do not count as parsed.
    assert unparsed(details, root, "product_parses", mark + 1) == [0, 1]


def test_stages_write_only_the_rows_they_change(spark, tmp_path):
    root = str(tmp_path)
    frontier = [(i, f"u{i}", None, f"page_{i}.html", "fetched") for i in range(1, 50)] + [(50, "u50", None, None, "pending")]
    tables.write_snapshot(spark.createDataFrame(frontier, schemas.FRONTIER), root, "frontier")
    pages = captures(spark, (50, "u50", ITEM.format("p1", "Uno")))
    run_stages(spark, root, F.lit(AT), listing_pages=pages, stages=["listing_fetch"])
    written = tables.read_versions(spark, root, "frontier", schemas.FRONTIER, [1]).collect()
    assert [(r.id, r.status) for r in written] == [(50, "fetched")]
    assert tables.read_snapshot(spark, root, "frontier", schemas.FRONTIER).count() == 50


def test_a_run_takes_only_rows_that_no_other_run_holds(spark, tmp_path):
    root = str(tmp_path)
    frontier = [(i, f"u{i}", None, None, "pending") for i in range(1, 5)]
    tables.write_snapshot(spark.createDataFrame(frontier, schemas.FRONTIER), root, "frontier")
    table = tables.read_snapshot(spark, root, "frontier", schemas.FRONTIER)
    claims.claim_rows(spark, root, "frontier", table, "status", "other", n=2)
    pages = captures(spark, *((i, f"u{i}", "<p>") for i in range(1, 5)))
    run_stages(spark, root, F.lit(AT), listing_pages=pages, stages=["listing_fetch"], owner="me")
    now = {r.id: r.status for r in tables.read_snapshot(spark, root, "frontier", schemas.FRONTIER).collect()}
    assert now == {1: "pending", 2: "pending", 3: "fetched", 4: "fetched"}
    assert {r.owner for r in claims.live_claims(spark, root, "frontier").collect()} == {"other"}
    claims.release(spark, root, "frontier", "other")
    run_stages(spark, root, F.lit(AT), listing_pages=pages, stages=["listing_fetch"], owner="me")
    assert tables.read_snapshot(spark, root, "frontier", schemas.FRONTIER).filter("status = 'fetched'").count() == 4


def test_unknown_sites_and_requests_without_a_base_are_error_rows(spark, tmp_path):
    asked = spark.createDataFrame([("nosite", "d", 2), (None, "d", 1), ("amazon", "d", 1)], schemas.REQUESTS)
    requests = fr.with_base(fr.crawl_requests(asked, keep_unknown=True)).withColumn("request_no", F.monotonically_increasing_id())
    root = str(tmp_path)
    pages = spark.createDataFrame([(1, "u", "nosite", 3, "<p>"), (2, None, None, 3, "<p>")], schemas.CAPTURES)
    run_stages(spark, root, F.lit(AT), requests, pages, stages=["seed", "listing_fetch", "listing_parse"])
    seed = tables.read_snapshot(spark, root, "errors_seed", schemas.ERRORS).collect()
    assert sorted((r.key, r.reason) for r in seed) == [("", "unsupported_site"), ("nosite", "unsupported_site")]
    parse = tables.read_snapshot(spark, root, "errors_listing_parse", schemas.ERRORS).collect()
    assert sorted((r.key, r.reason) for r in parse) == [("1", "unsupported_site"), ("2", "unsupported_site")]
    assert tables.read_snapshot(spark, root, "frontier", schemas.FRONTIER).count() == 1
    assert fr.crawl_requests(asked).count() == 1


# --- run-time counts ---


def test_observed_counts_equal_a_recount_and_read_no_table(spark, tmp_path):
    root = str(tmp_path)
    asked = spark.createDataFrame([("amazon", "d", 2), ("nosite", "d", 1)], schemas.REQUESTS)
    requests = fr.with_base(fr.crawl_requests(asked, keep_unknown=True)).withColumn("request_no", F.monotonically_increasing_id())
    run_stages(spark, root, F.lit(AT), requests, captures(spark), captures(spark), stages=["seed", "listing_fetch"])
    seen = {(r.stage, r.status): r.n for r in observed_counts(spark, root, COUNTED).collect()}
    queued = tables.read_versions(spark, root, "frontier", schemas.FRONTIER, [0]).count()
    assert seen == {("seed", "pending"): queued, ("seed", None): 1, ("listing_fetch", "failed"): queued}
    # Each version's numbers equal a count of its rows, and one run is told from the next.
    tables.append_changes(lambda: tables.read_snapshot(spark, root, "frontier", schemas.FRONTIER).limit(0), spark, root, "frontier")
    last = {"frontier": 1, "errors_seed": 0}
    assert observed_counts(spark, root, COUNTED, after=last).count() == 0
    for version, stage in ((0, "seed"), (1, "listing_fetch")):
        own = tables.read_versions(spark, root, "frontier", schemas.FRONTIER, [version])
        counted = {(r.stage, r.status): r.n for r in stage_counts(own, stage).collect()}
        assert counted == {k: n for k, n in seen.items() if k[0] == stage and k[1]}
    entries = tables.log_entries(spark, root, "frontier")
    assert [e["counts"]["rows"] for e in entries.values()] == [queued, queued, 0]
    # The numbers lie in the log files alone.
    for folder in (tmp_path / "frontier").glob("v=*"):
        for part in folder.glob("part-*"):
            part.unlink()
    assert {(r.stage, r.status): r.n for r in observed_counts(spark, root, COUNTED).collect()} == seen


def test_counts_of_products_without_a_status(spark, tmp_path):
    root = str(tmp_path)
    frontier = [(1, "u1", None, "page_1.html", "fetched")]
    tables.write_snapshot(spark.createDataFrame(frontier, schemas.FRONTIER), root, "frontier")
    listings, details = captures(spark, (1, "u1", ITEM.format("p1", "Uno") + ITEM.format("p2", "Dos"))), captures(
        spark, (1, "p1", DETAIL.format("Uno!", "1.000"))
    )
    run_stages(spark, root, F.lit(AT), None, listings, details, stages=["listing_parse", "product_fetch", "product_parse"])
    seen = sorted((r.stage, r.status, r.n) for r in observed_counts(spark, root, ["products"]).collect())
    assert seen == [
        ("listing_parse", "pending", 2), ("product_fetch", "failed", 1), ("product_fetch", "fetched", 1),
        ("product_parse", "parsed_succeeded", 1),
    ]


# --- fields of a rule's own ---

SOLD = '<p class="seller">{0}</p><p class="warranty">{1}</p>'


def _with_slots(*slots):
    rule = SITES["mercadolibre"]
    added = tuple(Selector(s, "p", s) for s in slots)
    return {**SITES, rule.site: replace(rule, product=replace(rule.product, slots=rule.product.slots + added))}


def test_slots_of_a_rule_become_product_columns(spark, tmp_path):
    root, rules = str(tmp_path), _with_slots("seller", "warranty")
    frontier = [(1, "u1", None, "page_1.html", "fetched")]
    tables.write_snapshot(spark.createDataFrame(frontier, schemas.FRONTIER), root, "frontier")
    listings = captures(spark, (1, "u1", "".join(ITEM.format(f"p{i}", "x") for i in (1, 2, 3))))
    last = ["product_fetch", "product_parse"]
    details = CaptureStore(spark, root, "details")
    # One product is stored before any rule has fields.
    details.land(captures(spark, (1, "p1", DETAIL.format("Uno", "1.000") + SOLD.format("Ana", "1 year"))))
    run_stages(spark, root, F.lit(AT), None, listings, details, stages=["listing_parse", *last])
    assert tables.evolved_schema(spark, root, "products", schemas.PRODUCTS).count("`") == 2 * len(schemas.PRODUCTS.split(", "))
    details.land(captures(spark, (2, "p2", DETAIL.format("Dos", "2.000") + SOLD.format("Bea", "2 years"))))
    run_stages(spark, root, F.lit(AT), None, None, details, stages=last, rules=rules)
    # Rules without the fields leave the columns and what is in them alone, and so does a whole version.
    details.land(captures(spark, (3, "p3", DETAIL.format("Tres", "3.000") + SOLD.format("Cyn", "3 years"))))
    run_stages(spark, root, F.lit(AT), None, None, details, stages=last)
    schema = tables.evolved_schema(spark, root, "products", schemas.PRODUCTS)
    want = [("p1", "Uno", None, None), ("p2", "Dos", "Bea", "2 years"), ("p3", "Tres", None, None)]
    for _ in range(2):
        now = tables.read_snapshot(spark, root, "products", schema)
        assert rows(now.select("product_url", "name", "seller", "warranty")) == want
        tables.compact(spark, root, "products", schema)
        tables.vacuum(spark, root, "products")
        assert tables.evolved_schema(spark, root, "products", schemas.PRODUCTS) == schema


def test_slots_that_hide_a_column_are_refused(spark):
    for slot in ("slug", "Parse_Status", "pos", "a b", "_found", "reason"):
        with pytest.raises(ValueError):
            own_fields([_with_slots(slot)["mercadolibre"].product])
    with pytest.raises(ValueError):
        own_fields([PageRule(None, (Selector("seller", "p"), Selector("Seller", "b")))])
    assert own_fields(r.product for r in SITES.values() if r.product) == []
    pages = captures(spark, (1, "p1", DETAIL.format("Uno", "1.000") + SOLD.format("Ana", "")))
    found = extract_product(pages, _with_slots("seller")).first()
    assert (found.name, found.seller, found.reason) == ("Uno", "Ana", None)
    assert "seller" not in extract_product(pages).columns
