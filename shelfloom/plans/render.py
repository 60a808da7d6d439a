"""Shop pages rendered by Spark from the ``part`` table.

The given tables hold no shop pages, so these are written from their rows: one listing
page and one product page per part, with missing, broken and repeated pieces, unclosed
tags and entities. Rendering is a projection; nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _cat(*pieces: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in pieces])


def _text(number: Column) -> Column:
    return number.cast("string")


def _cents() -> Column:
    return F.round(F.col("p_retailprice") * 100).cast("bigint")


def _dotted(number: Column) -> Column:
    return F.replace(F.format_number(number, 0), F.lit(","), F.lit("."))


def listing_item_url(i: Column, ampersand: str = "&") -> Column:
    """Address of a listing item; parts with the same name and size share theirs."""
    return _cat(
        "https://articulo.example.com/", F.replace(F.col("p_name"), F.lit(" "), F.lit("-")),
        "?s=", _text(F.col("p_size")), f"{ampersand}i=", _text(i),
    )


def _offset_item(i: Column) -> Column:
    key = F.col("p_partkey")
    turn = key + i
    href = (
        F.when(turn % 6 == 0, _cat(' href="https://click1.example.com/x/', _text(key), '"'))
        .when(turn % 6 == 1, F.lit(""))
        .when(turn % 6 == 2, F.lit(' href=""'))
        .otherwise(_cat(' href="', listing_item_url(i, "&amp;"), '"'))
    )
    anchor = _cat(
        '<a class="poly-component__title"', href, "> Caf&eacute; ", F.col("p_name"), " &amp; ",
        F.col("p_brand"), " </a>\n <em>N&ordm; ", _text(i), "</em>",
    )
    title = F.when(turn % 11 == 0, anchor).otherwise(
        _cat('<h3 class="x poly-component__title-wrapper">', anchor, "</h3>")
    )
    code = _text(key * 10 + F.floor(i / 2))
    address = _cat("https://img.example.com/D_MLA", code, "-O.jpg")
    inline = "data:image/gif;base64,R0lGOD"
    picture = (
        F.when(turn % 7 == 0, F.lit(""))
        .when(turn % 7 == 1, F.lit(f'<img data-src="" src="{inline}">'))
        .when(turn % 7 == 2, _cat('<img src="', address, '"/>'))
        .when(
            turn % 7 == 3,
            _cat('<img data-src="https://img.example.com/plain-', _text(key), '.jpg">'),
        )
        .otherwise(_cat('<img data-src="', address, f'" src="{inline}">'))
    )
    amount = (
        F.when(turn % 9 == 0, F.lit("12,5"))
        .when(turn % 9 == 2, F.lit(""))
        .otherwise(_dotted(_cents() + i))
    )
    price = F.when(turn % 9 == 1, F.lit("")).otherwise(
        _cat('<span class="andes-money-amount__fraction">', amount, "</span>")
    )
    return _cat(
        '<li class="ui-search-layout__item shops">', title, picture, price,
        "<p>Env&iacute;o <b>gratis</li>",
    )


def listing_pages_b(part: DataFrame) -> DataFrame:
    """Listings in the style of the offset-paginated shop: ``p_size % 8`` items each."""
    items = F.transform(
        F.filter(F.sequence(F.lit(0), F.col("p_size") % 8), lambda i: i > 0), _offset_item
    )
    url = _cat("https://listado.example.com/", _text(F.col("p_partkey")))
    following = F.when(F.col("p_size") % 5 == 0, F.lit("")).otherwise(
        _cat(
            '<ul><li class="andes-pagination__button andes-pagination__button--next">',
            '<a href="', url, '_Desde_49_NoIndex_True">Siguiente</a></li></ul>',
        )
    )
    html = _cat(
        '<!DOCTYPE html><html><head><script>var t="</li>";</script></head><body><ol>',
        F.array_join(items, "\n"), "</ol>", following, "</body></html>",
    )
    return part.select(
        F.col("p_partkey").alias("page_id"),
        url.alias("url"),
        F.lit("mercadolibre").alias("site"),
        html.alias("html"),
    )


def _suffix_item(i: Column) -> Column:
    turn = F.col("p_partkey") + i
    words = "a-size-medium a-spacing-none a-color-base a-text-normal"
    mixed = "a-spacing-none a-size-medium a-color-base a-text-normal"
    name = _cat(
        '<h2 class="', F.when(turn % 10 == 0, F.lit(mixed)).otherwise(F.lit(words)), '"> ',
        F.col("p_name"), " <i>", F.col("p_brand"), "</i></h2>",
    )
    symbol = F.when(turn % 3 == 0, F.lit("")).otherwise(
        F.lit('<span class="a-price-symbol">$</span>')
    )
    amount = F.format_number(F.col("p_retailprice").cast("decimal(18,2)"), 2)
    whole = F.format_number(_cents(), 0)
    price = (
        F.when(
            turn % 4 == 0,
            _cat('<span class="a-price-whole">', whole, "<span class=dot>.</span></span>"),
        )
        .when(turn % 4 == 1, _cat('<span class="a-price-whole">', whole, "</span>"))
        .when(
            turn % 4 == 2,
            _cat(
                '<span class="a-color-base">Ships free</span>',
                '<span class="x a-color-base">List: $&nbsp;', amount, " each</span>",
                '<span class="a-color-base">$ 1</span>',
            ),
        )
        .otherwise(F.lit('<span class="a-color-base">ask</span>'))
    )
    return _cat(
        '<div class="s" data-component-type="s-search-result">', name, symbol, price, "</div>"
    )


def listing_pages_a(part: DataFrame) -> DataFrame:
    """Listings in the style of the suffix-paginated shop: ``p_size % 5`` items each."""
    items = F.transform(
        F.filter(F.sequence(F.lit(0), F.col("p_size") % 5), lambda i: i > 0), _suffix_item
    )
    html = _cat("<html><body><div>", F.array_join(items, ""), "</div></body></html>")
    return part.select(
        F.col("p_partkey").alias("page_id"),
        _cat("https://www.amazon.com/s?k=", _text(F.col("p_partkey"))).alias("url"),
        F.lit("amazon").alias("site"),
        html.alias("html"),
    )


def product_url(key: Column, variant: Column | None = None) -> Column:
    """Address of a part's product page; only the plain one is ever captured."""
    url = _cat("https://articulo.example.com/p/", _text(key))
    return url if variant is None else _cat(url, "?v=", _text(variant))


def product_pages(part: DataFrame, *beside: Column) -> DataFrame:
    """One product page per part, and columns of the part beside it."""
    key = F.col("p_partkey")
    name = F.when(key % 13 == 0, F.lit("")).otherwise(
        _cat('<h1 class="ui-pdp-title">Caf&#233; ', F.col("p_name"), " ", F.col("p_brand"), "</h1>")
    )
    picture = _cat('<img data-src="https://img.example.com/D_MLA', _text(key), '-O.jpg">')
    amount = F.when(key % 17 == 0, F.lit("abc")).otherwise(_dotted(_cents()))
    price = F.when(key % 5 == 0, F.lit("")).otherwise(
        _cat('<span class="andes-money-amount__fraction">', amount, "</span>")
    )
    rating = (
        F.when(key % 4 == 1, F.lit("4.7 de 5"))
        .when(key % 4 == 2, _text(key))
        .otherwise(F.lit("4.0"))
    )
    reviews = F.when(key % 4 == 0, F.lit("")).otherwise(
        _cat('<p class="andes-visually-hidden"> ', rating, " </p>")
    )
    link = F.when(
        key % 3 == 0,
        _cat('<a class="poly-component__title" href="https://other.example.com/', _text(key), '">'),
    ).otherwise(F.lit(""))
    html = _cat("<html><body><div>", name, "<p>", picture, price, "<p>", reviews, link, "</html>")
    return part.select(
        key.alias("page_id"),
        product_url(key).alias("url"),
        F.lit("mercadolibre").alias("site"),
        html.alias("html"),
        *beside,
    )
