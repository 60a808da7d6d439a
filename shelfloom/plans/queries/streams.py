"""Streaming queries: captures land in two steps, and each step's stream runs to its end."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfloom import schemas
from shelfloom.functions.names import stamp_text
from shelfloom.operators import products as pr
from shelfloom.plans.queries.extraction import ITEMS_B
from shelfloom.plans.queries.queues import products
from shelfloom.plans.queries.registry import ORACLES, load, load_part, query
from shelfloom.plans.render import listing_pages_b, product_pages
from shelfloom.sources.scratch import scratch_path
from shelfloom.sources.tables import capture_sink
from shelfloom.streaming import incremental as inc


def _in_two_steps(part):
    """The parts in the order they arrive: the short brand names, then the others."""
    short = F.length("p_brand") <= 7
    return part.filter(short), part.filter(~short)


@query("incremental_listing_parse", f"""
WITH {ITEMS_B}, found AS (
  SELECT page_id, pos, link, slug, length(p_brand) > 7 AS late FROM items
  QUALIFY link IS NULL OR row_number() OVER (PARTITION BY link ORDER BY late, page_id, pos) = 1)
SELECT row_number() OVER (ORDER BY late, page_id, pos) AS id, link AS product_url, slug,
       page_id AS source_page_id, pos FROM found""")
def incremental_listing_parse(spark, sf_dir):
    root = scratch_path(spark, "stream")
    for step in _in_two_steps(load_part(spark, sf_dir)):
        capture_sink(listing_pages_b(step), f"{root}/landing")
        inc.listing_stream(spark, f"{root}/landing", root).awaitTermination()
    rows = inc.read_batches(spark, root, "products", schemas.PRODUCTS)
    return rows.select("id", "product_url", "slug", "source_page_id", "pos")


@query("incremental_product_parse", ORACLES["apply_parsed"])
def incremental_product_parse(spark, sf_dir):
    root = scratch_path(spark, "stream")
    for step in _in_two_steps(load_part(spark, sf_dir)):
        capture_sink(product_pages(step), f"{root}/landing")
        inc.product_stream(spark, f"{root}/landing", root).awaitTermination()
    parses = inc.read_batches(spark, root, "product_parses", inc.PARSES)
    table = pr.apply_parsed(
        products(spark, sf_dir), inc.latest_parses(parses), "product_url",
        F.lit("2024-03-01 12:00:00"),
    )
    return table.select(
        "id", "product_url", "slug", "price", "currency", "product_code", "reviews", "reviews_num",
        stamp_text(F.col("parsed_at")).alias("stamp"), "parse_status",
    )


@query("stream_dedup", """
SELECT user_id, event_id, event_type FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_type = 'purchase', event_id) = 1""")
def stream_dedup(spark, sf_dir):
    root, schema = scratch_path(spark, "stream"), "user_id BIGINT, event_id BIGINT, event_type STRING"
    events = load(spark, sf_dir, "events").select("user_id", "event_id", "event_type")
    late = F.col("event_type") == "purchase"
    for step in (events.filter(~late), events.filter(late)):
        step.write.mode("append").parquet(f"{root}/landing")
        inc.stream_dedup(
            spark, f"{root}/landing", schema, "user_id", root, F.col("event_id")
        ).awaitTermination()
    return inc.read_batches(spark, root, "unique", schema)
