"""Scalar queries: pagination, prices, images, names and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfloom.functions import media, names, prices, urls
from shelfloom.functions import status as st
from shelfloom.functions.text import slugify
from shelfloom.operators import frontier as fr
from shelfloom.plans.queries.registry import load, query
from shelfloom.rules import SITES
from shelfloom.sources.tables import read_spread


def key():
    return F.col("p_partkey")


# Requests made from the captured pages: every page is a seed, 0 to 3 pages each.
_REQUESTS = """requests AS (
  SELECT page_id, url AS seed_url, page_id % 4 AS n,
         CASE page_id % 3 WHEN 0 THEN 'amazon' WHEN 1 THEN 'mercadolibre' ELSE 'bazaar' END AS site
  FROM pages)"""


def page_requests(spark, sf_dir):
    page = F.col("page_id")
    site = F.when(page % 3 == 0, F.lit("amazon")).when(page % 3 == 1, F.lit("mercadolibre"))
    return load(spark, sf_dir, "pages").select(
        "page_id",
        F.col("url").alias("seed_url"),
        site.otherwise(F.lit("bazaar")).alias("site"),
        (page % 4).cast("int").alias("pages_to_crawl"),
    )


@query("first_seed", """
SELECT page_id, CASE WHEN page_id % 7 = 0 THEN NULL ELSE url END AS seed_url FROM pages""")
def first_seed(spark, sf_dir):
    none = F.array().cast("array<string>")
    seeds = F.when(F.col("page_id") % 7 == 0, none).otherwise(F.array("url", F.lit("other")))
    return load(spark, sf_dir, "pages").select("page_id", urls.first_seed(seeds).alias("seed_url"))


@query("unsupported_site", f"""
WITH {_REQUESTS} SELECT page_id, site FROM requests WHERE site NOT IN ('amazon', 'mercadolibre')""")
def unsupported_site(spark, sf_dir):
    return fr.unsupported_sites(page_requests(spark, sf_dir)).select("page_id", "site")


@query("paginate_suffix", """
SELECT page_id, url || '&page=' || CAST(page_id % 4 AS VARCHAR) AS paged FROM pages""")
def paginate_suffix(spark, sf_dir):
    paged = urls.paginate_suffix(F.col("url"), F.col("page_id") % 4)
    return load(spark, sf_dir, "pages").select("page_id", paged.alias("paged"))


@query("paginate_offset", """
SELECT page_id, CASE WHEN page_id % 4 = 0 THEN url
       ELSE url || '_Desde_' || CAST(page_id % 4 * 49 AS VARCHAR) || '_NoIndex_True' END AS paged
FROM pages""")
def paginate_offset(spark, sf_dir):
    page = F.col("page_id") % 4 + 1
    found = F.concat("url", F.lit("_Desde_7_NoIndex_True"))
    paged = urls.paginate_offset(found, page, F.lit(SITES["mercadolibre"].items_per_page))
    return load(spark, sf_dir, "pages").select("page_id", paged.alias("paged"))


@query("canonical_url", """
SELECT page_id, CASE WHEN page_id % 3 = 0 THEN NULL ELSE url END AS clean FROM pages""")
def canonical_url(spark, sf_dir):
    found = F.when(F.col("page_id") % 3 == 1, F.concat("url", F.lit("_Desde_49_Desde_98"))).when(
        F.col("page_id") % 3 == 2, F.col("url")
    )
    return load(spark, sf_dir, "pages").select("page_id", urls.canonical_url(found).alias("clean"))


@query("pagination_base", f"""
WITH {_REQUESTS}
SELECT page_id, CASE site WHEN 'amazon' THEN seed_url
       WHEN 'mercadolibre' THEN CASE WHEN n > 1 THEN seed_url || '_Desde_49' END END AS base
FROM requests WHERE site <> 'bazaar'""")
def pagination_base(spark, sf_dir):
    return _with_base(spark, sf_dir).select("page_id", "base")


def _with_base(spark, sf_dir):
    found = F.when(F.col("pages_to_crawl") > 1, F.concat("seed_url", F.lit("_Desde_49")))
    requests = page_requests(spark, sf_dir).withColumn("discovered", found)
    known = fr.crawl_requests(requests.withColumnRenamed("seed_url", "own_seed"))
    return fr.with_base(known.withColumn("seed_url", F.col("own_seed")))


@query("expand_pages", f"""
WITH {_REQUESTS}, paged AS (
  SELECT page_id, site, seed_url, unnest(generate_series(1, n)) AS page_no, n FROM requests
  WHERE site = 'amazon' OR (site = 'mercadolibre' AND n > 1))
SELECT page_id, CAST(page_no AS INTEGER) AS page_no,
       CASE WHEN site = 'amazon' THEN seed_url || '&page=' || CAST(page_no AS VARCHAR)
            WHEN page_no = 1 THEN seed_url
            ELSE seed_url || '_Desde_' || CAST((page_no - 1) * 49 AS VARCHAR) || '_NoIndex_True'
       END AS url
FROM paged""")
def expand_pages(spark, sf_dir):
    return fr.expand_pages(_with_base(spark, sf_dir)).select("page_id", "page_no", "url")


_SLUG = (
    "trim(regexp_replace(lower(regexp_replace(strip_accents({0}), '[^\\x00-\\x7F]', '', 'g')), "
    "'[^a-z0-9]+', '_', 'g'), '_')"
)


@query("slugify", f"""
SELECT 'title' AS kind, page_id AS id,
       md5({_SLUG.format("replace(regexp_extract(html, '<h1>([^<]*)</h1>', 1), '&amp;', '&')")})
       AS slug_hash FROM pages
UNION ALL SELECT 'part', p_partkey, md5({_SLUG.format("p_name || ' ' || p_type")}) FROM part
UNION ALL SELECT 'text', doc_id, md5({_SLUG.format("text")}) FROM documents""")
def slugs(spark, sf_dir):
    title = F.regexp_extract("html", "<h1>([^<]*)</h1>", 1)
    sources = (
        ("title", "pages", "page_id", F.replace(title, F.lit("&amp;"), F.lit("&"))),
        ("part", "part", "p_partkey", F.concat_ws(" ", "p_name", "p_type")),
        ("text", "documents", "doc_id", F.col("text")),
    )
    each = [
        read_spread(spark, f"{sf_dir}/{table}.parquet").select(
            F.lit(kind).alias("kind"),
            F.col(id_).alias("id"),
            F.md5(slugify(text)).alias("slug_hash"),
        )
        for kind, table, id_, text in sources
    ]
    return each[0].unionByName(each[1]).unionByName(each[2])


# Prices of parts written the ways the shops write them.
_CENTS = "CAST(round(p_retailprice * 100) AS BIGINT)"


def _cents():
    return F.round(F.col("p_retailprice") * 100).cast("bigint")


def _dotted():
    return F.replace(F.format_number(_cents(), 0), F.lit(","), F.lit("."))


@query("price_thousands", f"""
SELECT p_partkey, CASE WHEN p_partkey % 5 IN (0, 1) OR p_partkey % 5 = 4 THEN NULL
                       ELSE {_CENTS} END AS price,
       p_partkey % 5 IN (0, 4) AS unreadable
FROM part""")
def price_thousands(spark, sf_dir):
    turn = key() % 5
    text = (
        F.when(turn == 0, F.concat(_dotted(), F.lit(",5")))
        .when(turn == 2, _dotted())
        .when(turn == 3, _cents().cast("string"))
        .when(turn == 4, F.lit("consultar"))
    )
    price = prices.price_thousands(text)
    unreadable = prices.price_unreadable(text, price)
    return load(spark, sf_dir, "part").select(
        "p_partkey", price.alias("price"), unreadable.alias("unreadable")
    )


@query("price_trailing_dot", f"""
SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN CAST({_CENTS} AS VARCHAR)
       WHEN 1 THEN CAST({_CENTS} AS VARCHAR) || '.' END AS price FROM part""")
def price_trailing_dot(spark, sf_dir):
    number = _cents().cast("string")
    text = F.when(key() % 3 == 0, F.concat(number, F.lit("."))).when(
        key() % 3 == 1, F.concat(number, F.lit(".."))
    )
    return load(spark, sf_dir, "part").select(
        "p_partkey", prices.price_trailing_dot(text).alias("price")
    )


def _amount_texts(mark):
    amount = F.concat(_cents().cast("string"), F.lit(".5"))
    return F.array(
        F.lit("free"),
        F.when(key() % 3 == 0, F.concat(F.lit(f"was {mark} "), amount, F.lit(" each"))),
        F.when(key() % 3 == 1, F.concat(F.lit(mark), amount)),
        F.lit("soon"),
    )


def _amount_sql(mark):
    return f"""
SELECT p_partkey, CASE WHEN p_partkey % 3 < 2 THEN '{mark}' END AS currency,
       CASE WHEN p_partkey % 3 < 2 THEN CAST({_CENTS} AS VARCHAR) || '.5' END AS price FROM part"""


@query("price_usd", _amount_sql("$"))
def price_usd(spark, sf_dir):
    found = prices.price_usd(_amount_texts("$"))
    return load(spark, sf_dir, "part").select("p_partkey", found.alias("f")).select("p_partkey", "f.*")


@query("price_ars", _amount_sql("ARS"))
def price_ars(spark, sf_dir):
    found = prices.price_ars(_amount_texts("ARS"))
    return load(spark, sf_dir, "part").select("p_partkey", found.alias("f")).select("p_partkey", "f.*")


@query("price_fallback", f"""
SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN 'USD' WHEN p_partkey % 3 < 2 THEN '$' END AS currency,
       CASE WHEN p_size % 2 = 0 THEN '7' WHEN p_partkey % 3 < 2
            THEN CAST({_CENTS} AS VARCHAR) || '.5' END AS price FROM part""")
def price_fallback(spark, sf_dir):
    own = F.when(F.col("p_size") % 2 == 0, F.lit("7"))
    found = prices.price_fallback(F.lit("USD"), own, prices.price_usd(_amount_texts("$")))
    return load(spark, sf_dir, "part").select("p_partkey", found.alias("f")).select("p_partkey", "f.*")


@query("constant_currency", """
SELECT p_partkey, 'ARS' AS currency FROM part""")
def constant_currency(spark, sf_dir):
    currency = F.lit(SITES["mercadolibre"].constant_currency)
    return load(spark, sf_dir, "part").select("p_partkey", currency.alias("currency"))


@query("column_affinity", """
SELECT p_partkey,
       CASE p_partkey % 4 WHEN 0 THEN p_partkey WHEN 1 THEN p_size END AS whole,
       CASE p_partkey % 4 WHEN 0 THEN CAST(p_partkey AS DOUBLE) WHEN 1 THEN CAST(p_size AS DOUBLE)
            WHEN 2 THEN p_size + 0.5 END AS number
FROM part""")
def column_affinity(spark, sf_dir):
    size = F.col("p_size").cast("string")
    text = (
        F.when(key() % 4 == 0, F.concat(F.lit(" "), key().cast("string")))
        .when(key() % 4 == 1, F.concat(size, F.lit(".0")))
        .when(key() % 4 == 2, F.concat(size, F.lit(".5")))
        .otherwise(F.concat(size, F.lit(" de 5")))
    )
    return load(spark, sf_dir, "part").select(
        "p_partkey",
        names.integer_affinity(text).alias("whole"),
        names.real_affinity(text).alias("number"),
    )


def _sources():
    lazy = F.when(key() % 5 == 0, F.concat(F.lit("https://img.example.com/MLA"), key().cast("string")))
    lazy = lazy.when(key() % 5 == 1, F.lit(""))
    plain = (
        F.when(key() % 3 == 0, F.concat(F.lit("https://img.example.com/D_MLA"), key().cast("string"), F.lit("-O.jpg")))
        .when(key() % 3 == 1, F.lit("data:image/gif;base64,R0"))
        .otherwise(F.lit(""))
    )
    return lazy, plain


_IMAGE = """CASE WHEN p_partkey % 5 = 0 THEN 'https://img.example.com/MLA' || p_partkey
  WHEN p_partkey % 3 = 0 THEN 'https://img.example.com/D_MLA' || p_partkey || '-O.jpg' END"""


@query("image_candidate", f"SELECT p_partkey, {_IMAGE} AS image FROM part")
def image_candidate(spark, sf_dir):
    image = media.image_candidate(*_sources())
    return load(spark, sf_dir, "part").select("p_partkey", image.alias("image"))


@query("is_inline_image", "SELECT p_partkey, p_partkey % 3 = 1 AS inline_image FROM part")
def is_inline_image(spark, sf_dir):
    inline = media.is_inline_image(_sources()[1])
    return load(spark, sf_dir, "part").select("p_partkey", inline.alias("inline_image"))


@query("product_code", """
SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 OR p_partkey % 3 = 0 THEN 'MLA' || p_partkey END AS code
FROM part""")
def product_code(spark, sf_dir):
    code = media.product_code(media.image_candidate(*_sources()))
    return load(spark, sf_dir, "part").select("p_partkey", code.alias("code"))


@query("images_array", f"""
SELECT p_partkey, 1 AS n_images, {_IMAGE} AS image FROM part""")
def images_array(spark, sf_dir):
    images = media.images_array(media.image_candidate(*_sources()))
    return load(spark, sf_dir, "part").select(
        "p_partkey", F.size(images).alias("n_images"), media.first_image(images).alias("image")
    )


@query("has_regex", """
SELECT p_partkey, p_partkey % 3 < 2 AS has_amount,
       p_partkey % 5 = 0 OR p_partkey % 3 = 0 AS has_code FROM part""")
def has_regex(spark, sf_dir):
    text = F.array_join(_amount_texts("$"), " ")
    code = F.coalesce(media.has_code(media.image_candidate(*_sources())), F.lit(False))
    return load(spark, sf_dir, "part").select(
        "p_partkey", prices.has_amount(text).alias("has_amount"), code.alias("has_code")
    )


def _hrefs():
    return (
        F.when(key() % 4 == 0, F.concat(F.lit("https://click1.example.com/"), key().cast("string")))
        .when(key() % 4 == 1, F.lit(""))
        .when(key() % 4 == 2, F.concat(F.lit("https://shop.example.com/"), key().cast("string")))
    )


@query("product_link", """
SELECT p_partkey, CASE WHEN p_partkey % 4 = 2 THEN 'https://shop.example.com/' || p_partkey END AS link
FROM part""")
def product_link(spark, sf_dir):
    return load(spark, sf_dir, "part").select("p_partkey", urls.product_link(_hrefs()).alias("link"))


@query("is_sponsored", """
SELECT p_partkey, CASE WHEN p_partkey % 4 < 3 THEN p_partkey % 4 = 0 END AS sponsored FROM part""")
def is_sponsored(spark, sf_dir):
    return load(spark, sf_dir, "part").select(
        "p_partkey", urls.is_sponsored(_hrefs()).alias("sponsored")
    )


@query("listing_filename", "SELECT page_id, 'page_' || page_id || '.html' AS filename FROM pages")
def listing_filename(spark, sf_dir):
    name = names.listing_filename(F.col("page_id"))
    return load(spark, sf_dir, "pages").select("page_id", name.alias("filename"))


@query("product_filename", """
SELECT p_partkey, CASE WHEN p_partkey % 9 = 0 THEN 'None.html'
       ELSE replace(p_name, ' ', '_') || '.html' END AS filename FROM part""")
def product_filename(spark, sf_dir):
    slug = F.when(key() % 9 != 0, slugify(F.col("p_name")))
    return load(spark, sf_dir, "part").select(
        "p_partkey", names.product_filename(slug).alias("filename")
    )


def _file_names():
    """Names a folder may hold: pages, leftovers and others."""
    page, kind = F.col("page_id"), F.col("page_id") % 4
    return (
        F.when(kind < 2, names.listing_filename(page))
        .when(kind == 2, F.concat(names.listing_filename(page), F.lit(".tmp")))
        .otherwise(F.concat(F.lit("x"), names.listing_filename(page)))
    )


@query("page_file_name", "SELECT page_id, page_id % 4 < 2 AS is_page FROM pages")
def page_file_name(spark, sf_dir):
    return load(spark, sf_dir, "pages").select(
        "page_id", names.is_page_file(_file_names()).alias("is_page")
    )


@query("page_id_from_filename", """
SELECT page_id, CASE WHEN page_id % 4 < 2 THEN page_id END AS file_page_id FROM pages""")
def page_id_from_filename(spark, sf_dir):
    number = names.page_id_from_filename(_file_names())
    return load(spark, sf_dir, "pages").select("page_id", number.alias("file_page_id"))


@query("stamp_text", """
SELECT o_orderkey, strftime(o_orderdate + INTERVAL (o_orderkey % 1440) MINUTE, '%Y-%m-%d, %H:%M hs.')
       AS stamp FROM orders""")
def stamp_text(spark, sf_dir):
    at = F.col("o_orderdate") + F.make_dt_interval(mins=(F.col("o_orderkey") % 1440).cast("int"))
    return load(spark, sf_dir, "orders").select("o_orderkey", names.stamp_text(at).alias("stamp"))


# Queue rows with every pair of states, made from the parts.
_STATES = """states AS (
  SELECT p_partkey AS id,
         CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE 'https://articulo.example.com/p/' || p_partkey END
           AS product_url,
         CASE p_size % 5 WHEN 0 THEN 'pending' WHEN 1 THEN 'fetching' WHEN 2 THEN 'fetched'
              WHEN 3 THEN 'failed' ELSE 'failed_unfetchable' END AS fetch_status,
         CASE p_partkey % 4 WHEN 1 THEN 'parsing' WHEN 2 THEN 'parsed_succeeded'
              WHEN 3 THEN 'parsing_failed' END AS parse_status
  FROM part)"""


def product_states(spark, sf_dir):
    size = F.col("p_size") % 5
    fetch = (
        F.when(size == 0, F.lit(st.PENDING)).when(size == 1, F.lit(st.FETCHING))
        .when(size == 2, F.lit(st.FETCHED)).when(size == 3, F.lit(st.FAILED))
        .otherwise(F.lit(st.UNFETCHABLE))
    )
    parse = (
        F.when(key() % 4 == 1, F.lit(st.PARSING)).when(key() % 4 == 2, F.lit(st.PARSED))
        .when(key() % 4 == 3, F.lit(st.PARSE_FAILED))
    )
    url = F.concat(F.lit("https://articulo.example.com/p/"), key().cast("string"))
    return load(spark, sf_dir, "part").select(
        key().alias("id"), F.when(key() % 7 != 0, url).alias("product_url"),
        fetch.alias("fetch_status"), parse.alias("parse_status"),
    )


@query("scan_products", f"""
WITH {_STATES} SELECT id, product_url FROM states WHERE fetch_status = 'pending'""")
def scan_products(spark, sf_dir):
    waiting = fr.claim_batch(product_states(spark, sf_dir), "fetch_status")
    return waiting.select("id", "product_url")


@query("fetched_unparsed", f"""
WITH {_STATES} SELECT id FROM states WHERE fetch_status = 'fetched' AND parse_status IS NULL""")
def fetched_unparsed(spark, sf_dir):
    states = product_states(spark, sf_dir)
    return states.filter(st.fetched_unparsed(F.col("fetch_status"), F.col("parse_status"))).select("id")


@query("unfetchable", f"""
WITH {_STATES} SELECT id, CASE WHEN fetch_status = 'pending' AND product_url IS NULL
       THEN 'failed_unfetchable' ELSE fetch_status END AS fetch_status FROM states""")
def unfetchable(spark, sf_dir):
    result = st.unfetchable(F.col("product_url"), F.col("fetch_status"))
    return product_states(spark, sf_dir).select("id", result.alias("fetch_status"))
