"""URL columns: seeds, pagination, hosts and product links."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfloom.rules import SITES, SiteRule

OFFSET_MARK = "_Desde_"
SPONSORED_PREFIX = "https://click"


def first_seed(seed_urls: Column) -> Column:
    """First seed of a site; NULL when it has none."""
    return F.get(seed_urls, F.lit(0))


def canonical_url(url: Column) -> Column:
    """The URL without its offset part."""
    return F.substring_index(url, OFFSET_MARK, 1)


def paginate_suffix(seed: Column, page: Column) -> Column:
    return F.concat(seed, F.lit("&page="), page.cast("string"))


def paginate_offset(url: Column, page: Column, items_per_page: Column) -> Column:
    base = canonical_url(url)
    offset = ((page - 1) * items_per_page).cast("string")
    return F.when(page == 1, base).otherwise(
        F.concat(base, F.lit(OFFSET_MARK), offset, F.lit("_NoIndex_True"))
    )


def pagination_base(mode: Column, seed: Column, discovered: Column) -> Column:
    """URL to paginate from: the discovered one in dynamic mode, else the seed."""
    return F.when(mode == "dynamic", discovered).when(mode.isin("static", "algorithmic"), seed)


def paginated_url(style: Column, base: Column, page: Column, items_per_page: Column) -> Column:
    return F.when(style == "suffix", paginate_suffix(base, page)).when(
        style == "offset", paginate_offset(base, page, items_per_page)
    )


def is_sponsored(href: Column) -> Column:
    return href.startswith(SPONSORED_PREFIX)


def product_link(href: Column) -> Column:
    """Link of a product; sponsored and empty links count as missing."""
    return F.when(~is_sponsored(href), F.nullif(href, F.lit("")))


def absolute_url(href: Column, page_url: Column) -> Column:
    """A link that starts at the root of its page's site, with that site in front."""
    origin = F.regexp_extract(page_url, "^[A-Za-z]+://[^/?#]+", 0)
    rooted = href.startswith("/") & ~href.startswith("//")
    return F.when(rooted & page_url.isNotNull(), F.concat(origin, href)).otherwise(href)


def host(url: Column) -> Column:
    return F.lower(F.try_parse_url(url, F.lit("HOST")))


def site_of(url: Column, rules: Iterable[SiteRule] | None = None) -> Column:
    """Name of the site whose domain the URL's host belongs to; NULL when none does."""
    rules = list(SITES.values() if rules is None else rules)
    domains = {d: r.site for r in rules for d in r.domains}
    if not domains:
        return F.lit(None).cast("string")
    labels = F.split(host(url), r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    known = F.array(*[F.lit(d) for d in domains])
    lookup = F.create_map(*[F.lit(x) for pair in domains.items() for x in pair])
    hit = F.get(F.filter(suffixes, lambda s: F.array_contains(known, s)), F.lit(0))
    return F.when(host(url).isNotNull(), F.try_element_at(lookup, hit))
