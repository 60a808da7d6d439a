"""Rule-driven extraction: captured pages to product rows.

Each page crosses into Python once (``page_items``). Everything after that, prices,
slugs, codes, links and the per-page image rule, is column expressions on small rows
of the same task: no shuffle happens before or inside extraction.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfloom import schemas
from shelfloom.functions import media, prices
from shelfloom.functions.text import slug_of_name
from shelfloom.functions.urls import absolute_url, product_link
from shelfloom.operators.html import page_items, slot_names
from shelfloom.rules import SITES, PageRule, SiteRule, site_rules

NO_CONTAINER = "no_container"
BAD_PRICE = "price_unreadable"

#: Slots that extraction itself reads.
_READ = (
    "name", "price", "currency", "usd_text", "ars_text", "image_data_src", "image_src", "link", "reviews",
)
#: Product columns that no rule of the known sites fills: a slot may.
OPEN_COLUMNS = ("description", "condition", "seller")
_RULE_COLUMNS = ("site", "constant_currency", "price_rule", "price_fallback")


def rules_for_page(pages: DataFrame, rules: Mapping[str, SiteRule] = SITES) -> DataFrame:
    """Pages of known sites with the rule columns of their site."""
    table = site_rules(pages.sparkSession, rules.values())
    return pages.join(F.broadcast(table), "site")


def own_fields(page_rules: Iterable[PageRule]) -> list[str]:
    """Slots that the rules add of their own, in order of first use; each becomes a text column.

    A slot that would hide a column of extraction or of the product table is refused.
    """
    taken = {f.split()[0] for f in schemas.PRODUCTS.split(", ")} - set(OPEN_COLUMNS)
    taken |= {*_OUTPUT, *_PLACE, *_RULE_COLUMNS, "reason", "error", "item", "items"}
    fields = [s for s in slot_names(page_rules) if s not in _READ]
    for field in fields:
        if field.lower() in taken or not re.fullmatch(r"[A-Za-z]\w*", field, re.ASCII):
            raise ValueError(f"slot {field!r} cannot be a column")
    if len({f.lower() for f in fields}) < len(fields):
        raise ValueError(f"slots differ by case only: {sorted(fields)}")
    return fields


def _with_rule_values(rows: DataFrame, rules: Mapping[str, SiteRule]) -> DataFrame:
    table = site_rules(rows.sparkSession, rules.values()).select(*_RULE_COLUMNS)
    return rows.join(F.broadcast(table), "site", "left")


def _slot(item: str, name: str, slots: list[str]) -> Column:
    return F.col(f"{item}.{name}") if name in slots else F.lit(None).cast("string")


def _items_with_image(slots: list[str], once_per_page: bool) -> Column:
    """Each item with its image; on a listing an image counts at its first use only."""
    if "image_src" not in slots:
        image = F.transform("items", lambda x: F.lit(None).cast("string"))
    else:
        candidates = F.transform(
            "items", lambda x: media.image_candidate(x["image_data_src"], x["image_src"])
        )
        image = media.first_uses(candidates) if once_per_page else candidates
    return F.arrays_zip(F.col("items").alias("item"), image.alias("image"))


def _product_columns(slots: list[str]) -> dict[str, Column]:
    """Product columns of an exploded item, before the fallback of a missing price."""
    name, image = _slot("item", "name", slots), F.col("image")
    price = _slot("item", "price", slots)
    return {
        "name": name,
        "slug": slug_of_name(name),
        "product_code": media.product_code(image),
        "currency": F.coalesce("constant_currency", _slot("item", "currency", slots)),
        "price_text": F.when(
            F.col("price_rule") == "trailing_dot", prices.price_trailing_dot(price)
        ).otherwise(price),
        "link": product_link(_slot("item", "link", slots)),
        "reviews": _slot("item", "reviews", slots),
        "image": image,
    }


def _fallback(slots: list[str]) -> Column:
    """(currency, price) found in the item's other texts, by the site's fallback rule."""
    usd = prices.price_usd(F.array(_slot("item", "usd_text", slots)))
    ars = prices.price_ars(F.array(_slot("item", "ars_text", slots)))
    return F.when(F.col("price_fallback") == "usd", usd).when(
        F.col("price_fallback") == "ars", ars
    )


def _without_bad_pages(parsed: DataFrame, rules: Mapping[str, SiteRule]) -> DataFrame:
    """Empty the pages that hold an unreadable price, and say so."""
    checked = [s for s, r in rules.items() if r.price_rule == "thousands"]
    bad = F.col("site").isin(checked) & F.exists(
        "items", lambda x: prices.price_unreadable(x["price"], prices.price_thousands(x["price"]))
    )
    return parsed.withColumns(
        {
            "error": F.when(bad, F.lit(BAD_PRICE)).otherwise(F.col("error")),
            "items": F.when(~bad, F.col("items")),
        }
    )


def _extract(
    pages: DataFrame, rules: Mapping[str, SiteRule], page_rules: dict[str, PageRule],
    listing: bool, strict: bool = False,
) -> DataFrame:
    slots, fields = slot_names(page_rules.values()), own_fields(page_rules.values())
    parsed = page_items(pages, page_rules)
    if strict:
        parsed = _without_bad_pages(parsed, rules)
    exploded = parsed.select(
        "page_id",
        "url",
        "site",
        "error",
        F.coalesce(F.size("items"), F.lit(0)).alias("page_items"),
        F.posexplode_outer(_items_with_image(slots, once_per_page=listing)).alias("at", "zipped"),
    ).select(
        "page_id", "url", "site", "error", "page_items",
        (F.col("at") + 1).alias("pos"), "zipped.item", "zipped.image",
    )
    columns = _product_columns(slots) | {field: _slot("item", field, slots) for field in fields}
    rows = _with_rule_values(exploded, rules).withColumns(columns)
    with_fallback = F.col("price_fallback").isNotNull()
    found = prices.price_fallback(F.col("currency"), F.col("price_text"), _fallback(slots))
    rows = rows.withColumns(
        {
            "currency": F.when(with_fallback, found["currency"]).otherwise(F.col("currency")),
            "price_text": F.when(with_fallback, found["price"]).otherwise(F.col("price_text")),
        }
    )
    price = F.when(F.col("price_rule") == "thousands", prices.price_thousands(F.col("price_text")))
    unreadable = (F.col("price_rule") == "thousands") & prices.price_unreadable(
        F.col("price_text"), F.col("price")
    )
    reason = F.coalesce(
        F.col("error"),
        F.when(F.col("pos").isNull(), F.lit(NO_CONTAINER)),
        F.when(unreadable, F.lit(BAD_PRICE)),
    )
    return rows.withColumn("price", price).select(
        *_PLACE, *_OUTPUT, reason.alias("reason"), *fields
    )


_PLACE = ("page_id", "url", "site", "page_items", "pos")
_OUTPUT = (
    "name", "slug", "product_code", "currency", "price_text", "price", "link", "reviews", "image",
)


def extract_listing(
    pages: DataFrame, rules: Mapping[str, SiteRule] = SITES, strict_page: bool = False
) -> DataFrame:
    """Listing pages (page_id, url, site, html) to one row per container.

    ``pos`` counts the containers of a page from 1. A page without containers, or one that
    could not be read, gives a single row with a NULL ``pos``; ``reason`` says what is wrong
    with a row. Slots of a rule's own (``own_fields``) follow as text columns, NULL on pages of
    sites without them. Split the result with ``good_rows`` and ``error_rows``. With ``strict_page``
    a page with an unreadable price loses all its products, not only that price.
    """
    page_rules = {s: r.listing for s, r in rules.items()}
    return _extract(pages, rules, page_rules, listing=True, strict=strict_page)


def extract_product(pages: DataFrame, rules: Mapping[str, SiteRule] = SITES) -> DataFrame:
    """Product pages (page_id, url, site, html) to one row per page, with the same columns."""
    page_rules = {s: r.product for s, r in rules.items() if r.product is not None}
    return _extract(pages, rules, page_rules, listing=False)


def good_rows(rows: DataFrame) -> DataFrame:
    """Rows that hold a product. A bad price only empties the price."""
    return rows.filter(F.col("pos").isNotNull())


def error_rows(rows: DataFrame, stage: str) -> DataFrame:
    """(stage, key, reason) of everything that went wrong in an extraction."""
    key = F.concat_ws("#", F.col("page_id").cast("string"), F.col("pos").cast("string"))
    return rows.filter(F.col("reason").isNotNull()).select(
        F.lit(stage).alias("stage"), key.alias("key"), "reason"
    )


def products_per_page(pages: DataFrame, rules: Mapping[str, SiteRule] = SITES) -> DataFrame:
    """Number of containers on each listing page."""
    parsed = page_items(pages, {s: r.listing for s, r in rules.items()})
    return parsed.select("page_id", F.size("items").alias("n_products"))


def next_page_links(pages: DataFrame, rules: Mapping[str, SiteRule] = SITES) -> DataFrame:
    """(page_id, url, site, next_url): where the "next" control of a listing page leads."""
    page_rules = {s: r.next_page for s, r in rules.items() if r.next_page is not None}
    parsed = page_items(pages, page_rules)
    links = F.filter(F.transform("items", lambda x: x["href"]), lambda h: h.isNotNull())
    next_url = absolute_url(F.nullif(F.get(links, F.lit(0)), F.lit("")), F.col("url"))
    return parsed.select("page_id", "url", "site", next_url.alias("next_url"))
