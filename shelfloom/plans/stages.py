"""The five stages as one run over tables under a root folder."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfloom import schemas
from shelfloom.functions import status as st
from shelfloom.operators import frontier as fr
from shelfloom.operators import products as pr
from shelfloom.operators.extract import (
    error_rows,
    extract_listing,
    extract_product,
    good_rows,
    next_page_links,
    own_fields,
)
from shelfloom.operators.history import stage_counts
from shelfloom.plans.claims import claim_rows, release
from shelfloom.plans.counts import by_status
from shelfloom.rules import SITES, SiteRule
from shelfloom.sources.captures import CaptureStore, parse_new, rules_mark
from shelfloom.sources.scratch import materialize
from shelfloom.sources.tables import append_changes, compact_if_long, evolved_schema, read_snapshot, write_snapshot
from shelfloom.streaming.incremental import latest_parses

STAGES = ("seed", "listing_fetch", "listing_parse", "product_fetch", "product_parse")
#: Tables whose commits name their stage: ``observed_counts`` tells what a run did, without a scan.
COUNTED = ("frontier", "products", "errors_seed", "errors_listing_parse", "errors_product_parse")

Captures = DataFrame | CaptureStore


def _links(pages: DataFrame, rules: Mapping[str, SiteRule]) -> DataFrame:
    return next_page_links(fr.with_html(pages), rules)


def discovered_bases(
    requests: DataFrame, first_pages: Captures, rules: Mapping[str, SiteRule] = SITES, root: str | None = None
) -> DataFrame:
    """Requests with ``discovered``: where the captured first page's "next" leads.

    Links are read off the captures before the join, so html is never shuffled; with a store
    and a ``root`` only off new landings. Empty captures are not read.
    """
    if isinstance(first_pages, CaptureStore) and root is not None:
        links = parse_new(first_pages, root, "next_links", rules_mark(rules), lambda pages: _links(pages, rules))
    else:
        links = _links(first_pages.read() if isinstance(first_pages, CaptureStore) else first_pages, rules)
    found = (
        links.filter(F.col("url").isNotNull() & F.col("next_url").isNotNull())
        .groupBy(F.col("url").alias("seed_url"))
        .agg(F.max_by("next_url", "page_id").alias("discovered"))
    )
    return requests.join(found, "seed_url", "left")


def run_stages(
    spark: SparkSession,
    root: str,
    stamp: Column,
    requests: DataFrame | None = None,
    listing_pages: Captures | None = None,
    product_pages: Captures | None = None,
    stages: Sequence[str] = STAGES,
    rules: Mapping[str, SiteRule] = SITES,
    owner: str | None = None,
    lease: str = "1 hour",
) -> DataFrame:
    """Run the chosen stages in order and return (stage, status, n) of both queues.

    ``requests`` are prepared by ``crawl_requests`` and ``with_base`` and carry
    ``request_no``; those of unknown sites and without a base become error rows. Captures are
    tables with the columns of ``schemas.CAPTURES``, parsed whole in every run, or stores, of
    which a run parses the new landings only. Every stage writes the rows it changes; a table
    is written whole once its log of changes is long. Slots that the rules of product pages add of
    their own become columns of the product table, which stay when later rules lack them. Each write counts its rows by the status the
    stage gave them; ``observed_counts(spark, root, COUNTED)`` tells these numbers.

    With an ``owner`` the fetching stages take only rows they have claimed, for ``lease`` from
    now, so that several runs may share the tables. Without one a run is taken to be alone, and
    rows found in a working state are reset.
    """
    unknown = set(stages) - set(STAGES)
    if unknown:
        raise ValueError(f"unknown stages: {sorted(unknown)}")
    mark = rules_mark(rules)
    fields = own_fields(r.product for r in rules.values() if r.product is not None)
    product_schema = evolved_schema(spark, root, "products", schemas.PRODUCTS, fields)

    def frontier() -> DataFrame:
        return read_snapshot(spark, root, "frontier", schemas.FRONTIER)

    def products() -> DataFrame:
        return read_snapshot(spark, root, "products", product_schema)

    def errors(rows: DataFrame, stage: str) -> None:
        write_snapshot(rows, root, f"errors_{stage}", {"stage": stage})

    def change(build: Callable[[], DataFrame], table: str, stage: str, column: str) -> None:
        append_changes(build, spark, root, table, facts={"stage": stage}, counts=by_status(column))

    def results(pages: Captures, table: str, parse: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """Parsed rows of captures that are not empty; an empty one never replaces a full one."""
        if isinstance(pages, CaptureStore):
            return parse_new(pages, root, table, mark, lambda landed: parse(fr.with_html(landed)))
        return write_snapshot(parse(fr.with_html(pages)), root, table)

    def index(pages: Captures) -> DataFrame:
        return fr.capture_index(pages.read() if isinstance(pages, CaptureStore) else pages)

    def own(table: DataFrame, queue: str, column: str, working: str, *wanted: str) -> DataFrame:
        """The waiting rows that this run may take."""
        if owner is None:
            return fr.reset_stuck(table, column, working, st.PENDING)
        claimed = claim_rows(spark, root, queue, table, column, owner, lease, wanted=wanted)
        return table.join(claimed.select("id"), "id", "left_semi")

    if "seed" in stages:
        # Requests may rest on parsed captures; they are read several times from here on.
        requests = materialize(requests, "requests")
        errors(fr.base_errors(requests), "seed")
        seeds = fr.expand_pages(requests)
        change(lambda: fr.seed_changes(frontier(), seeds, stamp), "frontier", "seed", "status")

    if "listing_fetch" in stages:
        captured = index(listing_pages)

        def fetched() -> DataFrame:
            waiting = own(frontier(), "frontier", "status", st.IN_PROGRESS, st.PENDING).filter(F.col("status") == st.PENDING)
            return fr.fetch_outcome_of(waiting, captured, of=st.PENDING)

        change(fetched, "frontier", "listing_fetch", "status")
        release(spark, root, "frontier", owner)

    if "listing_parse" in stages:
        # html is reduced to product rows first; only those meet the frontier.
        rows = results(listing_pages, "listing_products", lambda pages: extract_listing(pages, rules))
        errors(error_rows(rows, "listing_parse"), "listing_parse")
        # Every capture that is not empty has a row, so the rows say which captures there are.
        last = rows.filter(F.col("url").isNotNull()).groupBy("url").agg(F.max("page_id").alias("page_id"))
        done = frontier().filter(F.col("status") == st.FETCHED)
        ids = last.join(done.select(F.col("id").alias("source_page_id"), "url"), "url")
        found = (
            good_rows(rows)
            .join(ids.select("page_id", "source_page_id"), "page_id")
            .select("source_page_id", "pos", "link", "slug")
        )
        unique = materialize(pr.dedup_products(found), "found_products")
        change(lambda: pr.insert_products(products(), unique), "products", "listing_parse", "fetch_status")

    if "product_fetch" in stages:
        captured = index(product_pages)

        def outcome() -> DataFrame:
            table = own(products(), "products", "fetch_status", st.FETCHING, st.PENDING, st.FAILED)
            return pr.product_fetch_changes(table, captured, retry=True)

        change(outcome, "products", "product_fetch", "fetch_status")
        release(spark, root, "products", owner)

    if "product_parse" in stages:
        rows = results(product_pages, "product_parses", lambda pages: pr.parsed_values(extract_product(pages, rules)))
        parsed = latest_parses(rows.withColumnRenamed("url", "product_url"))

        def waiting() -> DataFrame:
            table = fr.reset_stuck(products(), "parse_status", st.PARSING, None)
            return table.filter(st.fetched_unparsed(F.col("fetch_status"), F.col("parse_status")))

        lost = pr.lost_pages(waiting(), parsed)
        errors(error_rows(rows, "product_parse").unionByName(lost), "product_parse")
        change(lambda: pr.apply_parsed(waiting(), parsed, "product_url", stamp, fields=fields), "products", "product_parse", "parse_status")

    compact_if_long(spark, root, "frontier", schemas.FRONTIER)
    compact_if_long(spark, root, "products", product_schema)
    return (
        stage_counts(frontier(), "listing")
        .unionByName(stage_counts(products(), "product_fetch", "fetch_status"))
        .unionByName(stage_counts(products(), "product_parse", "parse_status"))
    )
