"""Queries that write tables or exports and read them back, and the whole run."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfloom import schemas
from shelfloom.functions.names import stamp_text
from shelfloom.operators import frontier as fr
from shelfloom.operators import products as pr
from shelfloom.plans.counts import observed_counts
from shelfloom.plans.queries.extraction import ITEMS_B, listing_b
from shelfloom.plans.queries.queues import FRONTIER, PRODUCTS, frontier, products
from shelfloom.plans.queries.registry import load, load_part, query
from shelfloom.plans.render import listing_item_url, product_pages
from shelfloom.plans.stages import discovered_bases, run_stages
from shelfloom.rules import SITES
from shelfloom.sources import tables as tb
from shelfloom.sources.captures import CaptureStore
from shelfloom.sources.export import export_csv, export_json, export_records
from shelfloom.sources.requests import read_requests
from shelfloom.sources.scratch import scratch_path


@query("crawl_requests", """
SELECT CASE page_id % 2 WHEN 0 THEN 'amazon' ELSE 'mercadolibre' END AS site,
       CASE WHEN page_id % 5 = 0 THEN 'mini.sqlite' ELSE 'shop_' || page_id END AS database_path,
       CAST(page_id % 4 AS INTEGER) AS pages_to_crawl,
       CASE page_id % 2 WHEN 0 THEN 'https://www.amazon.com/s?k=laptop'
            ELSE 'https://listado.mercadolibre.com.ar/boya-natacion-aguas-abiertas' END AS seed_url
FROM pages WHERE page_id % 3 <> 2""")
def crawl_requests(spark, sf_dir):
    page, path = F.col("page_id"), scratch_path(spark, "requests")
    known = F.when(page % 2 == 0, F.lit("amazon")).otherwise(F.lit("mercadolibre"))
    name = F.concat(F.lit("shop_"), page.cast("string"))
    load(spark, sf_dir, "pages").select(
        F.when(page % 3 == 2, F.lit("bazaar")).otherwise(known).alias("site"),
        F.when(page % 5 != 0, name).alias("database_path"),
        (page % 4).alias("pages_to_crawl"),
    ).write.json(path)
    requests = fr.crawl_requests(read_requests(spark, path, multi_line=False))
    return requests.select("site", "database_path", "pages_to_crawl", "seed_url")


@query("capture_sink", """
SELECT page_id, url, 'shop' AS site, CAST(length(html) AS INTEGER) AS html_chars, md5(html) AS html_hash
FROM pages""")
def capture_sink(spark, sf_dir):
    path = scratch_path(spark, "captures")
    stored = tb.capture_sink(load(spark, sf_dir, "pages"), path, site=F.lit("shop"))
    return stored.select("page_id", "url", "site", "html_chars", F.md5("html").alias("html_hash"))


@query("frontier_sink", f"""
WITH {FRONTIER} SELECT id, url, '2024-01-01, 00:00 hs.' AS discovered, filename,
       CASE status WHEN 'in_progress' THEN 'pending' ELSE status END AS status FROM frontier""")
def frontier_sink(spark, sf_dir):
    root = scratch_path(spark, "store")
    first = tb.write_snapshot(frontier(spark, sf_dir), root, "frontier")
    tb.write_snapshot(fr.reset_stuck(first, "status", "in_progress", "pending"), root, "frontier")
    stored = tb.read_snapshot(spark, root, "frontier", schemas.FRONTIER)
    stamp = stamp_text(F.col("discovered_at")).alias("discovered")
    return stored.select("id", "url", stamp, "filename", "status")


@query("products_sink", f"""
WITH {PRODUCTS} SELECT id, product_url, slug, price, fetch_status, parse_status FROM products""")
def products_sink(spark, sf_dir):
    root = scratch_path(spark, "store")
    tb.write_snapshot(products(spark, sf_dir), root, "products")
    stored = tb.read_snapshot(spark, root, "products", schemas.PRODUCTS)
    return stored.select("id", "product_url", "slug", "price", "fetch_status", "parse_status")


_EXPORT = f"""
WITH {PRODUCTS} SELECT id, g.url AS source_url, product_url, product_code, slug, price
FROM products LEFT JOIN pages g ON g.page_id = p_partkey"""


def _with_source(spark, sf_dir):
    pages = load(spark, sf_dir, "pages").select(F.col("page_id").alias("id"), "url")
    return pr.product_with_source(products(spark, sf_dir), pages)


def _exported(rows):
    return rows.select("id", "source_url", "product_url", "product_code", "slug", "price")


@query("export_json", _EXPORT)
def to_json(spark, sf_dir):
    rows, path = _with_source(spark, sf_dir), scratch_path(spark, "export")
    export_json(rows, path)
    return _exported(spark.read.schema(export_records(rows).schema).json(path))


@query("export_csv", _EXPORT)
def to_csv(spark, sf_dir):
    rows, path = _with_source(spark, sf_dir), scratch_path(spark, "export")
    export_csv(rows, path)
    schema = export_records(rows).schema
    return _exported(spark.read.schema(schema).csv(path, header=True, escape='"'))


# The whole run. Each part's listing is a seed that was captured; its "next" control names
# the address to paginate from, and listings without one cannot be paginated.
_RUN = f"""
WITH {ITEMS_B}, found AS (
  SELECT page_id, pos, link, slug FROM items i JOIN part p ON p.p_partkey = i.page_id
  WHERE p.p_size % 5 <> 0 AND p.p_partkey % 3 >= 1
  QUALIFY link IS NULL OR row_number() OVER (PARTITION BY link ORDER BY page_id, pos) = 1),
captures AS (
  SELECT p_partkey, 'https://articulo.example.com/' || replace(p_name, ' ', '-') || '?s=' || p_size
         || '&i=' || (p_partkey % 8) AS url,
         CASE WHEN p_partkey % 13 <> 0 THEN 'cafe_' || replace(p_name, ' ', '_') || '_brand_'
              || replace(p_brand, 'Brand#', '') END AS new_slug,
         CASE WHEN p_partkey % 5 <> 0 THEN round(p_retailprice * 100) END AS new_price,
         p_partkey % 5 = 0 OR p_partkey % 17 <> 0 AS readable
  FROM part QUALIFY row_number() OVER (PARTITION BY url ORDER BY p_partkey DESC) = 1)
SELECT row_number() OVER (ORDER BY page_id, pos) AS id, link AS product_url,
       CASE WHEN c.readable THEN new_slug ELSE slug END AS slug,
       CASE WHEN c.readable THEN new_price END AS price,
       CASE WHEN link IS NULL THEN 'failed_unfetchable' WHEN c.url IS NULL THEN 'failed'
            ELSE 'fetched' END AS fetch_status,
       CASE WHEN c.url IS NOT NULL THEN CASE WHEN c.readable THEN 'parsed_succeeded'
            ELSE 'parsing_failed' END END AS parse_status
FROM found f LEFT JOIN captures c ON c.url = f.link"""


def _whole_run(spark, sf_dir):
    root, part = scratch_path(spark, "run"), load_part(spark, sf_dir)
    listings, details = CaptureStore(spark, root, "listing_captures"), CaptureStore(spark, root, "product_captures")
    listings.land(listing_b(spark, sf_dir))
    item = (F.col("p_partkey") % 8).cast("int")
    # Product captures are addressed by the links of the listings; several may share one.
    pages = product_pages(part, listing_item_url(item).alias("link"))
    details.land(pages.drop("url").withColumnRenamed("link", "url"))
    rule = SITES["mercadolibre"]
    requests = listings.read().select(
        F.col("page_id").alias("request_no"), F.col("url").alias("seed_url"),
        (F.col("page_id") % 3).cast("int").alias("pages_to_crawl"),
        F.lit(rule.pagination_mode).alias("pagination_mode"),
        F.lit(rule.url_style).alias("url_style"),
        F.lit(rule.items_per_page).alias("items_per_page"),
    )
    requests = fr.with_base(discovered_bases(requests, listings, root=root))
    run_stages(spark, root, F.lit("2024-03-01 12:00:00"), requests, listings, details)
    return root


@query("run_stages", _RUN)
def whole_run(spark, sf_dir):
    root = _whole_run(spark, sf_dir)
    table = tb.read_snapshot(spark, root, "products", schemas.PRODUCTS)
    return table.select("id", "product_url", "slug", "price", "fetch_status", "parse_status")


@query("observed_counts", f"""
WITH run AS ({_RUN})
SELECT 'listing_parse' AS stage, 'pending' AS status, count(*) AS n FROM run HAVING count(*) > 0
UNION ALL SELECT 'product_fetch', fetch_status, count(*) FROM run GROUP BY fetch_status
UNION ALL SELECT 'product_parse', parse_status, count(*) FROM run WHERE parse_status IS NOT NULL GROUP BY parse_status""")
def run_counts(spark, sf_dir):
    return observed_counts(spark, _whole_run(spark, sf_dir), ["products"]).select("stage", "status", "n")
