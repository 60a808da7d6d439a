"""Extraction queries: rendered shop pages back to the values they were rendered from."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfloom.functions.urls import site_of
from shelfloom.operators import extract as ex
from shelfloom.operators.html import page_items
from shelfloom.operators.products import dedup_products, new_product_urls
from shelfloom.plans.queries.html import NAVIGATION
from shelfloom.plans.queries.registry import load, load_part, query
from shelfloom.plans.render import listing_pages_a, listing_pages_b, product_pages
from shelfloom.rules import SITES
from shelfloom.sources.scratch import materialize

# What listing_pages_b writes, item by item, straight from the parts.
ITEMS_B = """turns AS (
  SELECT *, p_partkey + i AS turn, CAST(round(p_retailprice * 100) AS BIGINT) + i AS amount
  FROM part, generate_series(1, p_size % 8) t(i)),
raw AS (
  SELECT *, CASE WHEN turn % 11 <> 0 THEN 'Café ' || p_name || ' & ' || p_brand || 'Nº ' || i END AS name,
         CASE WHEN turn % 11 <> 0 THEN 'cafe_' || replace(p_name, ' ', '_') || '_brand_'
              || replace(p_brand, 'Brand#', '') || 'no_' || i END AS slug,
         CASE WHEN turn % 9 = 0 THEN '12,5' WHEN turn % 9 = 1 THEN NULL WHEN turn % 9 = 2 THEN ''
              ELSE replace(format('{:,}', amount), ',', '.') END AS price_text,
         CASE WHEN turn % 9 > 2 THEN amount END AS price,
         CASE WHEN turn % 6 > 2 THEN 'https://articulo.example.com/' || replace(p_name, ' ', '-')
              || '?s=' || p_size || '&i=' || i END AS link,
         CASE WHEN turn % 7 = 3 THEN 'https://img.example.com/plain-' || p_partkey || '.jpg'
              WHEN turn % 7 IN (2, 4, 5, 6) THEN 'https://img.example.com/D_MLA'
                   || (p_partkey * 10 + i // 2) || '-O.jpg' END AS candidate
  FROM turns),
items AS (
  SELECT p_partkey AS page_id, CAST(i AS INTEGER) AS pos, name, slug, price_text, price, link, image,
         nullif(regexp_extract(image, 'MLA[0-9]+'), '') AS product_code, p_brand,
         CASE WHEN price_text IS NOT NULL AND price IS NULL THEN 'price_unreadable' END AS reason
  FROM (SELECT *, CASE WHEN row_number() OVER (PARTITION BY p_partkey, candidate ORDER BY i) = 1
                       THEN candidate END AS image FROM raw))"""


def listing_b(spark, sf_dir):
    return listing_pages_b(load_part(spark, sf_dir))


def items_b(spark, sf_dir):
    return ex.good_rows(ex.extract_listing(listing_b(spark, sf_dir)))


@query("extract_listing_b", f"""
WITH {ITEMS_B}
SELECT page_id, pos, name, slug, product_code, 'ARS' AS currency, price, link, image FROM items""")
def extract_listing_b(spark, sf_dir):
    return items_b(spark, sf_dir).select(
        "page_id", "pos", "name", "slug", "product_code", "currency", "price", "link", "image"
    )


@query("extract_listing_a", """
SELECT p_partkey AS page_id, CAST(i AS INTEGER) AS pos,
       CASE WHEN (p_partkey + i) % 10 <> 0 THEN p_name || p_brand END AS name,
       CASE (p_partkey + i) % 4 WHEN 2 THEN '$' WHEN 3 THEN NULL
            ELSE CASE WHEN (p_partkey + i) % 3 <> 0 THEN '$' END END AS currency,
       CASE (p_partkey + i) % 4 WHEN 2 THEN format('{:,.2f}', p_retailprice) WHEN 3 THEN NULL
            ELSE format('{:,}', CAST(round(p_retailprice * 100) AS BIGINT)) END AS price
FROM part, generate_series(1, p_size % 5) t(i)""")
def extract_listing_a(spark, sf_dir):
    pages = listing_pages_a(load_part(spark, sf_dir))
    return ex.good_rows(ex.extract_listing(pages)).select(
        "page_id", "pos", "name", "currency", F.col("price_text").alias("price")
    )


# What product_pages writes, straight from the parts.
PAGE_ITEMS = """page_items AS (
  SELECT p_partkey AS page_id, 'https://articulo.example.com/p/' || p_partkey AS url,
         CASE WHEN p_partkey % 13 <> 0 THEN 'Café ' || p_name || ' ' || p_brand END AS name,
         CASE WHEN p_partkey % 13 <> 0 THEN 'cafe_' || replace(p_name, ' ', '_') || '_brand_'
              || replace(p_brand, 'Brand#', '') END AS slug,
         CASE WHEN p_partkey % 5 <> 0 AND p_partkey % 17 <> 0
              THEN CAST(round(p_retailprice * 100) AS BIGINT) END AS price,
         'ARS' AS currency, 'MLA' || p_partkey AS product_code,
         CASE WHEN p_partkey % 3 = 0 THEN 'https://other.example.com/' || p_partkey END AS product_url,
         CASE p_partkey % 4 WHEN 1 THEN '4.7 de 5' WHEN 2 THEN CAST(p_partkey AS VARCHAR)
              WHEN 3 THEN '4.0' END AS reviews,
         'https://img.example.com/D_MLA' || p_partkey || '-O.jpg' AS image,
         CASE WHEN p_partkey % 5 <> 0 AND p_partkey % 17 = 0 THEN 'price_unreadable' END AS reason
  FROM part)"""


def page_products(spark, sf_dir):
    return ex.extract_product(product_pages(load_part(spark, sf_dir)))


@query("extract_product", f"""
WITH {PAGE_ITEMS}
SELECT page_id, name, slug, price, currency, product_code, product_url, reviews, image, reason
FROM page_items""")
def extract_product(spark, sf_dir):
    return page_products(spark, sf_dir).select(
        "page_id", "name", "slug", "price", "currency", "product_code",
        F.col("link").alias("product_url"), "reviews", "image", "reason",
    )


@query("product_record", f"""
WITH {PAGE_ITEMS}
SELECT page_id, name, currency, price, image AS first_image, 1 AS n_images FROM page_items""")
def product_record(spark, sf_dir):
    record = F.struct("name", "currency", "price", F.array("image").alias("images"))
    rows = page_products(spark, sf_dir).select("page_id", record.alias("record"))
    return rows.select(
        "page_id", "record.name", "record.currency", "record.price",
        F.get("record.images", F.lit(0)).alias("first_image"),
        F.size("record.images").alias("n_images"),
    )


@query("review_text", f"WITH {PAGE_ITEMS} SELECT page_id, reviews FROM page_items")
def review_text(spark, sf_dir):
    return page_products(spark, sf_dir).select("page_id", "reviews")


@query("first_image_in_page", f"WITH {ITEMS_B} SELECT page_id, pos, image, product_code FROM items")
def first_image_in_page(spark, sf_dir):
    return items_b(spark, sf_dir).select("page_id", "pos", "image", "product_code")


@query("position_in_page", f"""
WITH {ITEMS_B} SELECT page_id, pos, coalesce(name, '') AS name FROM items""")
def position_in_page(spark, sf_dir):
    pages = listing_b(spark, sf_dir)
    parsed = page_items(pages, {"mercadolibre": SITES["mercadolibre"].listing})
    rows = parsed.select("page_id", F.posexplode("items").alias("at", "item"))
    return rows.select(
        "page_id", (F.col("at") + 1).alias("pos"), F.coalesce("item.name", F.lit("")).alias("name")
    )


@query("products_per_page", """
SELECT p_partkey AS page_id, p_size % 8 AS n_products FROM part""")
def products_per_page(spark, sf_dir):
    return ex.products_per_page(listing_b(spark, sf_dir))


@query("rules_for_page", """
SELECT page_id, url, 'navigation' AS site, 'static' AS pagination_mode, 'suffix' AS url_style FROM pages
WHERE regexp_matches(url, '^https?://([^/:?#]*[.])?example[.](com|org|net)([/:?#]|$)')
UNION ALL SELECT p_partkey, 'https://www.amazon.com/s?k=' || p_partkey, 'amazon', 'algorithmic', 'suffix'
FROM part""")
def rules_for_page(spark, sf_dir):
    rules = {**SITES, NAVIGATION.site: NAVIGATION}
    shop = listing_pages_a(load(spark, sf_dir, "part")).select("page_id", "url")
    pages = load(spark, sf_dir, "pages").select("page_id", "url").unionByName(shop)
    placed = pages.withColumn("site", site_of(F.col("url"), rules.values()))
    return ex.rules_for_page(placed, rules).select(
        "page_id", "url", "site", "pagination_mode", "url_style"
    )


@query("quarantine", f"""
WITH {ITEMS_B}, {PAGE_ITEMS}
SELECT 'listing_parse' AS stage, page_id || '#' || pos AS key, reason FROM items WHERE reason IS NOT NULL
UNION ALL SELECT 'listing_parse', CAST(p_partkey AS VARCHAR), 'no_container' FROM part WHERE p_size % 8 = 0
UNION ALL SELECT 'product_parse', page_id || '#1', reason FROM page_items WHERE reason IS NOT NULL""")
def quarantine(spark, sf_dir):
    listing = ex.error_rows(ex.extract_listing(listing_b(spark, sf_dir)), "listing_parse")
    return listing.unionByName(ex.error_rows(page_products(spark, sf_dir), "product_parse"))


def candidates_b(spark, sf_dir):
    """Listing rows as the product table takes them."""
    return items_b(spark, sf_dir).select(
        F.col("page_id").alias("source_page_id"), "pos", "link", "slug", "price"
    )


UNIQUE_B = f"""{ITEMS_B},
unique_items AS (
  SELECT page_id AS source_page_id, pos, link, slug, price FROM items
  QUALIFY link IS NULL OR row_number() OVER (PARTITION BY link ORDER BY page_id, pos) = 1)"""


@query("dedup_products", f"""
WITH {UNIQUE_B} SELECT source_page_id, pos, link, slug, price FROM unique_items""")
def unique_products(spark, sf_dir):
    return dedup_products(candidates_b(spark, sf_dir))


@query("new_product_urls", f"""
WITH {UNIQUE_B} SELECT source_page_id, pos, link, slug FROM unique_items u
WHERE NOT EXISTS (SELECT 1 FROM items k WHERE k.p_brand < 'Brand#2' AND
  (k.link = u.link OR (k.link IS NULL AND u.link IS NULL AND k.page_id = u.source_page_id
                       AND k.pos = u.pos)))""")
def unstored_products(spark, sf_dir):
    # Listings of the brands sorted before Brand#2 were stored by an earlier run.
    rows = materialize(candidates_b(spark, sf_dir), "candidates")
    early = load(spark, sf_dir, "part").filter(F.col("p_brand") < "Brand#2")
    stored = rows.join(early.select(F.col("p_partkey").alias("source_page_id")), "source_page_id")
    stored = stored.withColumnRenamed("link", "product_url")
    return new_product_urls(dedup_products(rows), stored).select(
        "source_page_id", "pos", "link", "slug"
    )
