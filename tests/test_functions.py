"""Golden cases of the column functions."""

from __future__ import annotations

import datetime
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfloom.functions import media, names, prices, status, text, urls


def values(spark, column, inputs, schema):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i INT, v {schema}")
    return [r[0] for r in rows.orderBy("i").select(column(F.col("v"))).collect()]


def check(spark, column, cases, schema="STRING"):
    got = values(spark, column, [given for given, _ in cases], schema)
    assert got == [wanted for _, wanted in cases]


def python_slug(value: str) -> str:
    folded = unicodedata.normalize("NFKD", value).encode("ascii", "ignore").decode().lower()
    words = "".join(c if c.isascii() and c.isalnum() else " " for c in folded).split()
    return "_".join(words)


def test_slugify(spark):
    cases = [
        ("Café  Crème!", "cafe_creme"), ("Straße", "strae"), ("½ ﬁn", "12_fin"), ("日本", ""),
        ("", ""), (None, None), ("__a__", "a"), ("ÀÉ—ñ", "aen"), ("x²", "x2"),
        ("㎏ 5", "kg_5"), ("𝐀𝐁c", "abc"), ("a b", "a_b"), ("é", "e"),
    ]
    check(spark, text.slugify, cases)
    assert values(spark, text.slug_of_name, ["", None, "A b"], "STRING") == [None, None, "a_b"]


def test_slugify_every_folding_character(spark):
    single, _, longer = text.ascii_folds()
    texts = [f"a{c}b" for c in single] + [f"a{c}b" for c, _ in longer]
    assert values(spark, text.slugify, texts, "STRING") == [python_slug(t) for t in texts]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"], exclude_characters="\x00")), max_size=200))
def test_slugify_any_text(spark, texts):
    assert values(spark, text.slugify, texts, "STRING") == [python_slug(t) for t in texts]


def test_node_text(spark):
    cases = [
        ([" a ", " ", "b"], "ab"), ([], ""), ([" x ", "\x1cy\x85"], "xy"), (["a b"], "a b"),
    ]
    check(spark, text.node_text, cases, "ARRAY<STRING>")


def test_prices(spark):
    cases = [
        ("1.234", 1234), ("1.234.567", 1234567), ("1.234,5", None), ("", None), (None, None),
        ("abc", None), ("99999999999999999999", None), ("-5", -5),
    ]
    check(spark, prices.price_thousands, cases)
    check(spark, prices.price_trailing_dot, [("1,299.", "1,299"), ("1,299", "1,299"), ("..", "."), (None, None)])
    usd = [
        (["List: $ 1,299.00 x"], ("$", "1,299.00")), (["free", "ask"], (None, None)), ([], (None, None)),
        ([None, "$ 5", "$6"], ("$", "5")),
    ]
    check(spark, lambda c: prices.price_usd(c), [(t, w) for t, w in usd], "ARRAY<STRING>")
    ars = [(["ARS1.234"], ("ARS", "1.234")), (["ARS 7", "ARS 8"], ("ARS", "7")), (["$ 7"], (None, None))]
    check(spark, lambda c: prices.price_ars(c), ars, "ARRAY<STRING>")


def test_fallback_overwrites_currency(spark):
    found = prices.price_usd(F.array(F.lit("none here")))
    row = spark.range(1).select(
        prices.price_fallback(F.lit("$"), F.lit(None).cast("string"), found).alias("missing"),
        prices.price_fallback(F.lit("$"), F.lit("5"), found).alias("kept"),
    )
    assert [tuple(v) for v in row.first()] == [(None, None), ("$", "5")]


def test_urls(spark):
    page = F.lit(3)
    check(spark, lambda c: urls.paginate_suffix(c, page), [("u", "u&page=3"), (None, None)])
    offset = [("u", "u_Desde_98_NoIndex_True"), ("u_Desde_49_NoIndex_True", "u_Desde_98_NoIndex_True")]
    check(spark, lambda c: urls.paginate_offset(c, page, F.lit(49)), offset)
    first = [("u_Desde_49_NoIndex_True", "u"), ("u", "u")]
    check(spark, lambda c: urls.paginate_offset(c, F.lit(1), F.lit(49)), first)
    check(spark, urls.first_seed, [(["a", "b"], "a"), ([], None), (None, None)], "ARRAY<STRING>")
    links = [("https://click1.x/y", None), ("", None), (None, None), ("https://a.b/c", "https://a.b/c")]
    check(spark, urls.product_link, links)
    page = F.lit("https://a.b/c/d?e")
    links = [("/x", "https://a.b/x"), ("https://q/r", "https://q/r"), (None, None), ("//q/r", "//q/r")]
    check(spark, lambda c: urls.absolute_url(c, page), links)
    base = [("dynamic", "found"), ("static", "seed"), ("algorithmic", "seed"), ("other", None)]
    check(spark, lambda c: urls.pagination_base(c, F.lit("seed"), F.lit("found")), base)
    sites = [
        ("https://www.amazon.com/s?k=laptop", "amazon"),
        ("https://listado.mercadolibre.com.ar/x", "mercadolibre"),
        ("https://amazon.com.evil.example/", None), ("not a url", None), (None, None),
    ]
    check(spark, urls.site_of, sites)


def test_media(spark):
    def image(pair):
        return media.image_candidate(pair["d"], pair["s"])

    cases = [
        (("d", "s"), "d"), (("", "s"), "s"), ((None, "data:image/gif"), None), ((None, ""), None),
        ((None, None), None), (("data:image/x", "s"), "data:image/x"),
    ]
    check(spark, image, cases, "STRUCT<d: STRING, s: STRING>")
    codes = [("https://x/D_MLA123-O.jpg", "MLA123"), ("MLA1 MLA2", "MLA1"), ("MLA", None), (None, None)]
    check(spark, media.product_code, codes)
    uses = [(["a", "b", "a", None, "b"], ["a", "b", None, None, None]), ([], [])]
    check(spark, media.first_uses, uses, "ARRAY<STRING>")


def test_names(spark):
    check(spark, names.listing_filename, [(7, "page_7.html")], "BIGINT")
    check(spark, names.product_filename, [("a_b", "a_b.html"), (None, "None.html")])
    files = [("page_10.html", 10), ("page_x.html", None), ("page_1.html.tmp", None), ("xpage_1.html", None)]
    check(spark, names.page_id_from_filename, files)
    stamp = [(datetime.datetime(2026, 12, 1, 14, 5, 59), "2026-12-01, 14:05 hs.")]
    check(spark, names.stamp_text, stamp, "TIMESTAMP")
    whole = [("123", 123), ("4.0", 4), ("4.7 de 5", None), ("4.7", None), ("", None), ("1e2", 100), ("NaN", None)]
    check(spark, names.integer_affinity, whole)
    check(spark, names.real_affinity, [("4.7", 4.7), ("5", 5.0), ("Infinity", None), ("1d", None)])


@pytest.mark.parametrize(
    ("state", "queued"),
    [("pending", True), ("fetched", True), (None, False), ("in_progress", False), ("failed", False)],
)
def test_already_queued(spark, state, queued):
    assert values(spark, status.already_queued, [state], "STRING") == [queued]
