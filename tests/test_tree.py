"""Tree rules of the page parser, and extraction on awkward pages."""

from __future__ import annotations

import time

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfloom.operators.extract import error_rows, extract_listing, extract_product, good_rows
from shelfloom.operators.html import (
    _html_to_parse,
    elements_by_class,
    find_all,
    html_nodes,
    html_tokens,
    page_items,
)
from shelfloom.operators.tree import PageTree
from shelfloom.rules import SITES, PageRule, Selector
from tests.conftest import TESTDATA


class LibraryTree(PageTree):
    """The same tree with everything read by the library."""

    def _read(self, html):
        self.feed(html)


def state(tree):
    return [
        tree.ids, tree.ends, tree.parents, tree.depths, tree.tags, tree.attrs, tree.texts,
        tree.text_ids, tree.text_parents,
    ]


def shape(html):
    """Tags with the tag each one is in."""
    tree = PageTree(html)
    names = dict(zip(tree.ids, tree.tags, strict=True))
    return [(t, names.get(p)) for t, p in zip(tree.tags, tree.parents, strict=True)]


PIECES = st.lists(
    st.sampled_from(
        ["<p>", "</p>", "<b>", "</b>", "<br>", "<br/>", "</br>", "<li class='a b'>", "</li>", "x &amp; y",
         '<a href="u">', '<a href="u" >', "<a href=u>", '<A HREF="u&amp;v">', "</a>", "<script>1<2</script>",
         "<!-- c -->", "<!-->", "<!-- a -- b -->", "<!--", "-->", "<script>", "</script>", "</SCRIPT >",
         "<style>", "</style>", "<textarea>", "</textarea>", "<![CDATA[x]]>", "<svg>", "</svg>", "&#12", "&am",
         '<a title="x>y">', "<a title='&lt;'>", "<p\n>", "</p >", '"', "'", "=", "&eacute;", "&#233;", "&#x1F600;", "&nope;", "<", ">", "</", "<div", '<img src="s"/>', '<a href="u" />', "<b/>", "<script/>", '<script src="u">x&amp;y</script>', "<style>p{}</style>", "<script>if(a<b)</script>", "<script>'</p>'</script>",
         "<script><!-- </script> --></script>", "<script>a<</script>", "<!DOCTYPE html>", "<!doctype html>",
         "<!DOCTYPE html PUBLIC 'x'>", '<p class="x"/ >',
         "<img>", "<title>t</title>", "<?pi?>", "<!DOCTYPE html>", "é", " ", "\n", '<i data-x="1" y>', "&"]
    ),
    max_size=30,
)


@settings(max_examples=3000, deadline=None)
@given(PIECES)
def test_plain_tags_read_as_the_library_reads_them(pieces):
    html = "".join(pieces)
    assert state(PageTree(html)) == state(LibraryTree(html))


def test_given_pages_read_as_the_library_reads_them():
    pages = duckdb.sql(f"SELECT html FROM '{TESTDATA}/sf0.01/pages.parquet'").fetchall()
    assert all(state(PageTree(h)) == state(LibraryTree(h)) for (h,) in pages)


ESCAPED = st.lists(
    st.sampled_from(
        ['<a href="?a=1&amp;b=2">', '<a href="&amp;lt;&amp;">', '<b t="&amp;x;&lt;">', "</a>", '<script>t="</li>"</script>',
         "<script></SCRIPT></script>", "<style></script></style>", "<script></scripts></script>", "<script></script x></script>",
         "<script></", "<script>", "</script>", "<!--", "-->", "<p>", "x", "&amp;", '<img alt="&amp;amp;"/>', "<style>", "</style>"]
    ),
    max_size=12,
)


@settings(max_examples=2000, deadline=None)
@given(ESCAPED)
def test_escapes_in_values_and_tags_in_scripts_read_as_the_library_reads_them(pieces):
    html = "".join(pieces)
    assert state(PageTree(html)) == state(LibraryTree(html))


def test_escaped_addresses_and_scripts_with_tags_are_read_as_plain_pieces(monkeypatch):
    html = '<script>var t="</li>";</script><li class="x"><a href="/p?a=1&amp;b=2&amp;lt;">x</a></li>'
    wanted = state(LibraryTree(html))
    monkeypatch.setattr(PageTree, "feed", None)
    assert state(PageTree(html)) == wanted


def test_tree_rules():
    assert shape("<p>a<p>b") == [("p", None), ("p", "p")]
    assert shape("<div><p>a</div><i>") == [("div", None), ("p", "div"), ("i", None)]
    assert shape("</b><i></b><u>") == [("i", None), ("u", "i")]
    assert shape("<br>a</br><img><i>") == [("br", None), ("img", None), ("i", None)]
    assert shape("<div/><i>") == [("div", None), ("i", None)]
    assert shape("<LI CLASS=x>") == [("li", None)]


def test_text_of_nodes():
    tree = PageTree("<p> <b> a </b> <i>b</i><!-- no --> c <script>x</script><template>t</template></p>")
    assert tree.text(0) == "abc"
    assert PageTree("<p>a &amp; b&nbsp;</p>").text(0) == "a & b"
    assert PageTree("<p>x <!-- --> y</p>").text(0) == "xy"
    assert PageTree("<p>&#150;&#xe9;&bogus;</p>").text(0) == "–é&bogus"
    assert PageTree("<p>&#xD800;&#x110000;&#129;</p>").text(0) == "\ufffd\ufffd\x81"


def test_first_match_is_inside_its_container():
    rule = PageRule(Selector("item", "li"), (Selector("a", "a", read="href"),))
    html = '<a href="0"><li><p></li><li><a href="1"><a href="2"></li><a href="3">'
    assert list(PageTree(html).items(rule)) == [[None], ["1"]]


def test_unclosed_containers_nest():
    rule = PageRule(Selector("item", "li"), (Selector("a", "a", read="href"),))
    assert list(PageTree('<li><li><a href="1">').items(rule)) == [["1"], ["1"]]


def test_class_rules():
    words = Selector("n", "h2", "b a")
    html = '<h2 class="b  a">1</h2><h2 class="a b">2</h2><h2 class="b a c">3</h2>'
    tree = PageTree(html)
    assert [tree.text(i) for i in tree.matches(words)] == ["1"]
    assert len(tree.matches(Selector("n", "h2", "a"))) == 3


@pytest.mark.parametrize("piece", ["<li><p>", "<p>", "<b><i></b>", "&amp;", "</x>", "<script>>", "<a b='>'>", "< >", "<!-- > "])
def test_parsing_time_grows_with_the_page(piece):
    start = time.perf_counter()
    PageTree(piece * 40_000)
    assert time.perf_counter() - start < 10


LISTING_B = """<li class="ui-search-layout__item"><h3 class="poly-component__title-wrapper">
<a class="poly-component__title" href="{link}">{name}</a></h3>{image}
<span class="andes-money-amount__fraction">{price}</span></li>"""


def pages(spark, *rows):
    return spark.createDataFrame(list(rows), "page_id BIGINT, site STRING, html STRING")


def test_listing_edge_cases(spark):
    html = "".join(
        [
            LISTING_B.format(link="L1", name="A", image='<img data-src="MLA1">', price="1.234"),
            LISTING_B.format(link="https://click1.x", name="", image='<img src="MLA1">', price="1,5"),
            '<li class="ui-search-layout__item"></li>',
        ]
    )
    df = pages(
        spark, (1, "mercadolibre", html), (2, "mercadolibre", "<p>"), (3, "bazaar", html),
        (4, "mercadolibre", "<![nonsense x]>"), (5, "mercadolibre", None),
    )
    rows = extract_listing(df)
    got = good_rows(rows).orderBy("page_id", "pos").collect()
    assert [(r.pos, r.name, r.slug, r.price, r.link, r.image, r.product_code) for r in got] == [
        (1, "A", "a", 1234, "L1", "MLA1", "MLA1"),
        (2, "", None, None, None, None, None),
        (3, None, None, None, None, None, None),
    ]
    assert {(r.key, r.reason) for r in error_rows(rows, "s").collect()} == {
        ("1#2", "price_unreadable"), ("2", "no_container"), ("3", "unsupported_site"),
        ("4", "markup_rejected"), ("5", "no_container"),
    }
    strict = extract_listing(df, strict_page=True)
    assert good_rows(strict).count() == 0
    assert ("1", "price_unreadable") in {(r.key, r.reason) for r in error_rows(strict, "s").collect()}


def test_listing_with_amounts_in_other_texts(spark):
    item = '<div data-component-type="s-search-result"><span class="a-price-symbol">US$</span>{}</div>'
    bodies = [
        '<span class="a-price-whole">1,299<span>.</span></span>',
        '<span class="a-color-base">no</span><span class="a-color-base">x $ 12.50</span>',
        '<span class="a-color-base">ARS 5</span>',
    ]
    df = pages(spark, (1, "amazon", "".join(item.format(b) for b in bodies)))
    rows = good_rows(extract_listing(df)).orderBy("pos").collect()
    assert [(r.currency, r.price_text) for r in rows] == [("US$", "1,299"), ("$", "12.50"), (None, None)]


def test_product_page(spark):
    html = """<h1 class="ui-pdp-title">NAME</h1><img data-src="https://img.example/D_MLA123-O.jpg">
      <span class="andes-money-amount__fraction">12.345</span><p class="andes-visually-hidden">4.7 de 5</p>"""
    bad = '<span class="andes-money-amount__fraction">abc</span>'
    df = pages(spark, (1, "mercadolibre", html), (2, "mercadolibre", bad), (3, "amazon", html))
    rows = {r.page_id: r for r in extract_product(df).collect()}
    first = rows[1]
    assert (first.name, first.slug, first.price, first.currency) == ("NAME", "name", 12345, "ARS")
    assert (first.product_code, first.reviews, first.link) == ("MLA123", "4.7 de 5", None)
    assert rows[2].reason == "price_unreadable"
    assert rows[3].reason == "unsupported_site"


def test_extraction_does_not_shuffle(spark):
    df = pages(spark, (1, "mercadolibre", "<p>"))
    plan = extract_listing(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hash" not in plan and "Exchange Round" not in plan
    assert plan.count("MapInArrow") == 1


def test_one_huge_page_stays_whole(spark):
    item = LISTING_B.format(link="L", name="N", image='<img src="i">', price="1")
    df = pages(spark, (1, "mercadolibre", item * 5000))
    rows = good_rows(extract_listing(df)).collect()
    assert len(rows) == 5000
    assert sum(r.image is not None for r in rows) == 1
    assert html_nodes(df).count() == 5000 * 7


@settings(max_examples=10, deadline=None)
@given(
    st.lists(
        st.lists(
            st.sampled_from(
                ["<li class='ui-search-layout__item'>", '<li class="x ui&#45;search-layout__item">', "</li>",
                 '<li class="ui-search-layout&lowbar;_item">', '<li class="ui-search-layout&UnderBar;&lowbar;item">',
                 "<LI CLASS=ui-search-layout__item>", "<p>", "<![x y]>", '<li class="ui-search">', "&amp;", "text"]
            ),
            max_size=5,
        ),
        min_size=1,
        max_size=40,
    )
)
def test_pages_are_told_apart_without_parsing(spark, lists):
    htmls = ["".join(pieces) for pieces in lists]
    rule = SITES["mercadolibre"].listing
    df = pages(spark, *[(n, "mercadolibre", h) for n, h in enumerate(htmls)])
    got = {r.page_id: (r.error, len(r.items)) for r in page_items(df, {"mercadolibre": rule}).collect()}
    for number, html in enumerate(htmls):
        try:
            wanted = (None, len(list(PageTree(html).items(rule))))
        except AssertionError:
            wanted = ("markup_rejected", 0)
        assert got[number] == wanted, html


def test_pages_without_the_word_are_not_parsed(spark):
    df = pages(spark, (1, "mercadolibre", "<p>x</p>"), (2, "mercadolibre", '<li class="ui-search-layout__item">'))
    sent = df.select(_html_to_parse({"mercadolibre": SITES["mercadolibre"].listing}).alias("h")).collect()
    assert [r.h is None for r in sent] == [True, False]


def test_tokens_and_elements_agree_on_the_given_pages(spark):
    given = spark.read.parquet(f"{TESTDATA}/sf0.001/pages.parquet")
    tag = F.lower(F.regexp_extract("token", "^<([a-zA-Z][a-zA-Z0-9]*)", 1))
    from_tokens = html_tokens(given).select("page_id", "pos", tag.alias("tag")).filter("tag <> ''")
    elements = html_nodes(given).filter(F.col("tag").isNotNull()).select("page_id", "node_id", "tag")

    def sequences(df, order):
        return {(r.page_id, n): r.tag for n, r in enumerate(df.orderBy("page_id", order).collect())}

    assert sequences(from_tokens, "pos") == sequences(elements, "node_id")


def test_found_elements_are_those_of_the_node_table(spark):
    given = spark.read.parquet(f"{TESTDATA}/sf0.001/pages.parquet")
    found = find_all(given, [Selector("ad", "div", "ad"), Selector("entry", "li")])
    nodes = html_nodes(given)
    wanted = elements_by_class(nodes, "div", "ad").select("page_id", "node_id").union(
        nodes.filter("tag = 'li'").select("page_id", "node_id")
    )
    pairs = found.select("page_id", "node_id")
    assert sorted(map(tuple, pairs.collect())) == sorted(map(tuple, wanted.collect()))


def test_sites_are_data():
    assert set(SITES) == {"amazon", "mercadolibre"}
