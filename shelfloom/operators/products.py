"""The product table: unique links, fetch outcomes and parsed attributes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfloom.functions import status as st
from shelfloom.functions.names import integer_affinity, product_filename
from shelfloom.operators.frontier import capture_index
from shelfloom.operators.keys import left_join_on, next_id, number_rows

MISSING = "missing_html"

# Columns of a product row that parsing a product page sets.
PARSED_COLUMNS = ("slug", "name", "currency", "price", "product_code", "reviews", "image")


def row_key(url: str) -> list[Column]:
    """A product is known by its link; one without a link by its place on its page."""
    nameless = F.col(url).isNull()
    return [
        F.col(url).alias("_url"),
        F.when(nameless, F.col("source_page_id")).alias("_page"),
        F.when(nameless, F.col("pos")).alias("_pos"),
    ]


def dedup_products(rows: DataFrame) -> DataFrame:
    """First row of each link in (source_page_id, pos) order; rows without a link all stay.

    One aggregation with partial results before the shuffle, so a link repeated in a third
    of all rows costs one row per task; rows without a link are spread by their place.
    """
    rest = [c for c in rows.columns if c not in ("source_page_id", "pos")]
    first = F.min(F.struct("source_page_id", "pos", *rest)).alias("first")
    return rows.groupBy(*row_key("link")).agg(first).select("first.*").select(*rows.columns)


def new_product_urls(candidates: DataFrame, products: DataFrame) -> DataFrame:
    """Deduplicated listing rows whose product is not stored yet."""
    left = candidates.select("*", *row_key("link"))
    right = products.select(*[c.alias(f"{n}2") for c, n in zip(
        row_key("product_url"), ("_url", "_page", "_pos"), strict=True
    )])
    on = [F.col(c).eqNullSafe(F.col(f"{c}2")) for c in ("_url", "_page", "_pos")]
    return left.join(right, on, "left_anti").drop("_url", "_page", "_pos")


def insert_products(products: DataFrame, candidates: DataFrame) -> DataFrame:
    """Product rows to add for deduplicated listing rows, with ids in page order."""
    return number_products(new_product_urls(candidates, products), next_id(products))


def number_products(new: DataFrame, after: Column | int, order: Sequence[str] = ("source_page_id", "pos")) -> DataFrame:
    """Product rows of new listing rows, with ids in ``order`` after the last one."""
    numbered = number_rows(new, order, after=after)
    text = F.lit(None).cast("string")
    return numbered.select(
        "id", F.col("link").alias("product_url"), text.alias("product_code"), "slug",
        text.alias("name"), F.lit(None).cast("double").alias("price"), text.alias("currency"),
        text.alias("description"), F.lit(st.PENDING).alias("fetch_status"),
        text.alias("parse_status"), text.alias("condition"), text.alias("seller"),
        text.alias("reviews"), F.lit(None).cast("bigint").alias("reviews_num"),
        text.alias("image"), F.lit(None).cast("timestamp").alias("parsed_at"),
        text.alias("filename"), "source_page_id", "pos",
    )


def product_fetch_outcome(products: DataFrame, pages: DataFrame, retry: bool = False) -> DataFrame:
    """All products; the pending ones become fetched, failed or unfetchable.

    With ``retry``, failed products whose capture has come since count as pending.
    """
    return _fetched(products, capture_index(pages), retry).drop("_changes")


def product_fetch_changes(products: DataFrame, index: DataFrame, retry: bool = False) -> DataFrame:
    """The products whose outcome is new, by the rows of ``capture_index``."""
    wanted = [st.PENDING, st.FAILED] if retry else [st.PENDING]
    waiting = products.filter(F.col("fetch_status").isin(*wanted))
    return _fetched(waiting, index, retry).filter("_changes").drop("_changes")


def _fetched(products: DataFrame, index: DataFrame, retry: bool) -> DataFrame:
    joined = left_join_on(products, index.withColumnRenamed("url", "product_url"), "product_url")
    captured = F.coalesce("captured", F.lit(False))
    pending = F.col("fetch_status") == st.PENDING
    if retry:
        pending = pending | ((F.col("fetch_status") == st.FAILED) & captured)
    outcome = F.when(F.col("product_url").isNull(), F.lit(st.UNFETCHABLE)).otherwise(
        st.fetch_result(captured)
    )
    name = F.when(captured, product_filename(F.col("slug")))
    pending = F.coalesce(pending, F.lit(False))
    return joined.withColumns(
        {
            "_changes": pending,
            "fetch_status": F.when(pending, outcome).otherwise(F.col("fetch_status")),
            "filename": F.when(pending, name).otherwise(F.col("filename")),
        }
    ).drop("captured")


def missing_html(products: DataFrame, files: DataFrame) -> DataFrame:
    """Fetched, unparsed products whose file is not there."""
    waiting = products.filter(st.fetched_unparsed(F.col("fetch_status"), F.col("parse_status")))
    return waiting.join(files.select("filename"), "filename", "left_anti")


def lost_pages(products: DataFrame, parsed: DataFrame) -> DataFrame:
    """Error rows of fetched, unparsed products that have no parsed page."""
    waiting = products.filter(st.fetched_unparsed(F.col("fetch_status"), F.col("parse_status")))
    lost = waiting.join(parsed.select("product_url"), "product_url", "left_anti")
    return lost.select(
        F.lit("product_parse").alias("stage"), F.col("id").cast("string").alias("key"),
        F.lit(MISSING).alias("reason"),
    )


def parsed_values(rows: DataFrame) -> DataFrame:
    """Rows of ``extract_product`` with the value columns as the product table holds them."""
    return rows.withColumns(
        {
            "price": F.col("price").cast("double"),
            "reviews_num": integer_affinity(F.col("reviews")),
        }
    )


def apply_parsed(
    products: DataFrame, parsed: DataFrame, key: str, at: Column, by: str = "id", fields: Sequence[str] = ()
) -> DataFrame:
    """Overwrite parsed columns of matched products, with NULL too; links stay as they are.

    ``parsed`` holds one row per ``key`` with the value columns, ``reviews_num`` and
    ``reason`` (NULL when the page was readable). Only products that are fetched and not
    yet parsed change. One without a parsed row has lost its page: it fails and keeps
    its values. ``fields`` are text columns of ``parsed`` that rules add of their own; those that
    ``products`` lacks are added to it.
    """
    values = [*PARSED_COLUMNS, "reviews_num", *fields]
    new = [f for f in fields if f not in products.columns]
    products = products.withColumns({f: F.lit(None).cast("string") for f in new})
    right = parsed.select(
        key, F.col("reason").alias("_reason"), F.lit(True).alias("_found"),
        *[F.col(c).alias(f"_{c}") for c in values],
    )
    joined = left_join_on(products, right, key)
    waiting = st.fetched_unparsed(F.col("fetch_status"), F.col("parse_status"))
    found, readable = F.col("_found").isNotNull(), F.col("_reason").isNull()
    done = waiting & found & readable
    changed = {c: F.when(done, F.col(f"_{c}")).otherwise(F.col(c)) for c in values}
    changed["parsed_at"] = F.when(done, at.cast("timestamp")).otherwise(F.col("parsed_at"))
    changed["parse_status"] = F.when(waiting, st.parse_result(found, readable)).otherwise(
        F.col("parse_status")
    )
    return joined.withColumns(changed).select(*products.columns)


def product_with_source(products: DataFrame, frontier: DataFrame) -> DataFrame:
    """Products with the listing URL they came from.

    One listing may hold very many products; the join's hot partitions are split by AQE.
    """
    sources = frontier.select(F.col("id").alias("source_page_id"), F.col("url").alias("source_url"))
    return left_join_on(products, sources, "source_page_id")
