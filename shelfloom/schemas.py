"""Table schemas, as the DDL strings Spark reads."""

REQUESTS = "site STRING, database_path STRING, pages_to_crawl INT"

SITE_RULES = (
    "site STRING, domains ARRAY<STRING>, seed_urls ARRAY<STRING>, pagination_mode STRING, "
    "url_style STRING, items_per_page INT, constant_currency STRING, price_rule STRING, "
    "price_fallback STRING"
)

PAGES = "page_id BIGINT, url STRING, html STRING"

# A capture is a page plus the facts later stages need, so that they never read html.
CAPTURES = "page_id BIGINT, url STRING, site STRING, html_chars INT, html STRING"

FRONTIER = "id BIGINT, url STRING, discovered_at TIMESTAMP, filename STRING, status STRING"

PRODUCTS = (
    "id BIGINT, product_url STRING, product_code STRING, slug STRING, name STRING, price DOUBLE, "
    "currency STRING, description STRING, fetch_status STRING, parse_status STRING, "
    "condition STRING, seller STRING, reviews STRING, reviews_num BIGINT, image STRING, "
    "parsed_at TIMESTAMP, filename STRING, source_page_id BIGINT, pos INT"
)

ERRORS = "stage STRING, key STRING, reason STRING"

NODES = (
    "page_id BIGINT, node_id INT, end_id INT, parent_id INT, depth INT, tag STRING, "
    "classes ARRAY<STRING>, attrs MAP<STRING,STRING>, text STRING"
)
