"""Site rules: what differs from one shop to the next, kept as data.

A new site is a new ``SiteRule``; no code is added for it. The rules reach Spark in
two forms: ``site_rules`` is a small table to join on, and the selectors travel to
the parsing tasks inside their closure.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from shelfloom import schemas


@dataclass(frozen=True)
class Selector:
    """First element with this tag, class and attribute, read into ``slot``.

    ``read`` is ``"text"`` or the name of an attribute. ``pattern`` keeps only elements
    whose text matches it. A ``class_`` of several words must equal the whole class list.
    """

    slot: str
    tag: str
    class_: str | None = None
    attr: tuple[str, str] | None = None
    read: str = "text"
    pattern: str | None = None


@dataclass(frozen=True)
class PageRule:
    """Which elements hold one item each (None: the whole page), and what to read in them."""

    container: Selector | None
    slots: tuple[Selector, ...]


@dataclass(frozen=True)
class SiteRule:
    site: str
    listing: PageRule
    product: PageRule | None = None
    domains: tuple[str, ...] = ()
    seed_urls: tuple[str, ...] = ()
    pagination_mode: str = "static"
    url_style: str = "suffix"
    items_per_page: int | None = None
    constant_currency: str | None = None
    price_rule: str | None = None
    price_fallback: str | None = None
    next_page: PageRule | None = None


# Seeds, selectors and patterns of the two known shops.
_IMAGE = (
    Selector("image_data_src", "img", read="data-src"),
    Selector("image_src", "img", read="src"),
)
_FRACTION = Selector("price", "span", "andes-money-amount__fraction")
_LINK = Selector("link", "a", "poly-component__title", read="href")

AMAZON = SiteRule(
    site="amazon",
    domains=("amazon.com",),
    seed_urls=("https://www.amazon.com/s?k=laptop",),
    pagination_mode="algorithmic",
    url_style="suffix",
    price_rule="trailing_dot",
    price_fallback="usd",
    listing=PageRule(
        container=Selector("item", "div", attr=("data-component-type", "s-search-result")),
        slots=(
            Selector("name", "h2", "a-size-medium a-spacing-none a-color-base a-text-normal"),
            Selector("price", "span", "a-price-whole"),
            Selector("currency", "span", "a-price-symbol"),
            Selector("usd_text", "span", "a-color-base", pattern=r"\$\s*([\d.,]+)"),
            Selector("ars_text", "span", "a-color-base", pattern=r"ARS\s*([\d.,]+)"),
        ),
    ),
)

MERCADOLIBRE = SiteRule(
    site="mercadolibre",
    domains=("mercadolibre.com.ar",),
    seed_urls=("https://listado.mercadolibre.com.ar/boya-natacion-aguas-abiertas",),
    pagination_mode="dynamic",
    url_style="offset",
    items_per_page=49,
    constant_currency="ARS",
    price_rule="thousands",
    listing=PageRule(
        container=Selector("item", "li", "ui-search-layout__item"),
        slots=(Selector("name", "h3", "poly-component__title-wrapper"), _FRACTION, *_IMAGE, _LINK),
    ),
    product=PageRule(
        container=None,
        slots=(
            Selector("name", "h1", "ui-pdp-title"),
            _FRACTION,
            *_IMAGE,
            _LINK,
            Selector("reviews", "p", "andes-visually-hidden"),
        ),
    ),
    next_page=PageRule(
        container=Selector("item", "li", "andes-pagination__button--next"),
        slots=(Selector("href", "a", read="href"),),
    ),
)

SITES: dict[str, SiteRule] = {rule.site: rule for rule in (AMAZON, MERCADOLIBRE)}


def site_rules(spark: SparkSession, rules: Iterable[SiteRule] | None = None) -> DataFrame:
    """One row per site. Its size is the number of rule objects, so it is safe to broadcast."""
    rows = [
        (
            r.site,
            list(r.domains),
            list(r.seed_urls),
            r.pagination_mode,
            r.url_style,
            r.items_per_page,
            r.constant_currency,
            r.price_rule,
            r.price_fallback,
        )
        for r in (SITES.values() if rules is None else rules)
    ]
    return spark.createDataFrame(rows, schemas.SITE_RULES)
