"""Queries on the html of pages: tokens, elements, selection and containment."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfloom.functions.text import node_text
from shelfloom.operators import html as ht
from shelfloom.operators.extract import extract_listing, good_rows, next_page_links
from shelfloom.operators.html import TOKEN_PATTERN
from shelfloom.operators.nested import descendants, first_descendant
from shelfloom.plans.queries.registry import load_pages, load_part, query
from shelfloom.plans.render import listing_pages_a, listing_pages_b
from shelfloom.sources.scratch import materialize
from shelfloom.rules import SITES, PageRule, Selector, SiteRule

_TOKENS = f"""tokens AS (
  SELECT page_id, unnest(t) AS token, unnest(range(len(t))) AS pos
  FROM (SELECT page_id, regexp_extract_all(html, '{TOKEN_PATTERN}', 0) AS t FROM pages))"""


@query("html_tokens", f"""
WITH {_TOKENS} SELECT page_id, CAST(pos AS INTEGER) AS pos, token FROM tokens""")
def html_tokens(spark, sf_dir):
    return ht.html_tokens(load_pages(spark, sf_dir))


# The tree, walked token by token over all pages at once with the open elements in a list.
_TREE_SQL = f"""
WITH RECURSIVE {_TOKENS}, kinds AS (
  SELECT page_id, pos, token,
         CASE WHEN regexp_matches(token, '^<[a-zA-Z]') THEN 'open'
              WHEN regexp_matches(token, '^</[a-zA-Z]') THEN 'close'
              WHEN starts_with(token, '<') OR trim(token, ' ' || chr(9) || chr(10) || chr(13)) = ''
              THEN 'skip' ELSE 'text' END AS kind,
         lower(regexp_extract(token, '^</?([a-zA-Z][a-zA-Z0-9]*)', 1)) AS tag
  FROM tokens),
facts AS (
  SELECT *, kind = 'open' AND (tag IN ('br', 'meta', 'img', 'hr', 'input', 'link', 'wbr')
            OR starts_with(lower(token), '<script') OR starts_with(lower(token), '<style')) AS leaf,
         CASE WHEN kind IN ('open', 'text') THEN 1 ELSE 0 END AS adds
  FROM kinds),
walk AS (
  SELECT page_id, -1 AS pos, 0 AS made, CAST([] AS INTEGER[]) AS ids, CAST([] AS VARCHAR[]) AS tags
  FROM pages
  UNION ALL
  SELECT f.page_id, f.pos, w.made + f.adds,
         CASE WHEN f.kind = 'open' AND NOT f.leaf THEN list_append(w.ids, w.made)
              WHEN f.kind = 'close' AND list_contains(w.tags, f.tag)
              THEN w.ids[:len(w.tags) - list_position(list_reverse(w.tags), f.tag)] ELSE w.ids END,
         CASE WHEN f.kind = 'open' AND NOT f.leaf THEN list_append(w.tags, f.tag)
              WHEN f.kind = 'close' AND list_contains(w.tags, f.tag)
              THEN w.tags[:len(w.tags) - list_position(list_reverse(w.tags), f.tag)] ELSE w.tags END
  FROM walk w JOIN facts f ON f.page_id = w.page_id AND f.pos = w.pos + 1),
nodes AS (
  SELECT f.page_id, w.made AS node_id, w.ids[len(w.ids)] AS parent_id, len(w.ids) AS depth,
         CASE WHEN f.kind = 'open' THEN f.tag END AS tag,
         CASE WHEN f.kind = 'open' THEN nullif(regexp_extract(f.token, 'class="([^"]*)"', 1), '') END
           AS class_list,
         CASE WHEN f.kind = 'open' THEN nullif(regexp_extract(f.token, 'href="([^"]*)"', 1), '') END
           AS href,
         CASE WHEN f.kind = 'text' THEN
           regexp_replace(replace(replace(replace(f.token, '&copy;', '©'), '&middot;', '·'),
                                  '&quot;', '"'), '&amp;?', '&', 'g') END AS text
  FROM walk w JOIN facts f ON f.page_id = w.page_id AND f.pos = w.pos + 1 WHERE f.adds = 1),
ends AS (
  SELECT page_id, id AS node_id, max(made) - 1 AS end_id
  FROM (SELECT page_id, made, unnest(ids) AS id FROM walk) GROUP BY ALL)
SELECT n.page_id, n.node_id, coalesce(e.end_id, n.node_id) AS end_id, n.parent_id,
       CAST(n.depth AS INTEGER) AS depth, n.tag, n.class_list, n.href, n.text
FROM nodes n LEFT JOIN ends e ON e.page_id = n.page_id AND e.node_id = n.node_id"""


@query("html_elements", _TREE_SQL)
def html_elements(spark, sf_dir):
    return ht.html_nodes(load_pages(spark, sf_dir)).select(
        "page_id", "node_id", "end_id", "parent_id", "depth", "tag",
        F.nullif(F.array_join("classes", " "), F.lit("")).alias("class_list"),
        F.try_element_at("attrs", F.lit("href")).alias("href"), "text",
    )


_ITEM = SITES["mercadolibre"].listing.container


@query("find_all_by_class", """
SELECT p_partkey AS page_id, count(*) AS n FROM part, range(p_size % 8) t(i) GROUP BY ALL""")
def find_all_by_class(spark, sf_dir):
    nodes = ht.html_nodes(listing_pages_b(load_part(spark, sf_dir)))
    return ht.elements_by_class(nodes, _ITEM.tag, _ITEM.class_).groupBy("page_id").agg(
        F.count("*").alias("n")
    )


@query("find_all_by_attr", """
SELECT p_partkey AS page_id, count(*) AS n FROM part, range(p_size % 5) t(i) GROUP BY ALL""")
def find_all_by_attr(spark, sf_dir):
    name, value = SITES["amazon"].listing.container.attr
    nodes = ht.html_nodes(listing_pages_a(load_part(spark, sf_dir)))
    return ht.elements_by_attr(nodes, "div", name, value).groupBy("page_id").agg(
        F.count("*").alias("n")
    )


@query("class_match", """
SELECT p_partkey AS page_id, count(*) FILTER ((p_partkey + i) % 10 <> 0) AS whole_list,
       count(*) AS one_word
FROM part, generate_series(1, p_size % 5) t(i) GROUP BY ALL""")
def class_match(spark, sf_dir):
    listed = SITES["amazon"].listing.slots[0].class_
    nodes = ht.html_nodes(listing_pages_a(load_part(spark, sf_dir)))
    heads = nodes.filter(F.col("tag") == "h2")
    whole = ht.class_match(F.col("classes"), listed)
    word = ht.class_match(F.col("classes"), "a-color-base")
    return heads.groupBy("page_id").agg(
        F.count_if(whole).alias("whole_list"), F.count_if(word).alias("one_word")
    )


@query("node_text", """
SELECT page_id, trim(replace(regexp_replace(
         regexp_extract(html, '<h1>([^<]*)</h1>', 1), '&amp;?', '&', 'g'), '&quot;', '"'))
       AS text FROM pages""")
def text_of_titles(spark, sf_dir):
    found = ht.find_all(load_pages(spark, sf_dir), [Selector("title", "h1")])
    return found.select("page_id", node_text(F.col("text_nodes")).alias("text"))


# What the listing renderer writes, computed from the parts alone.
_ITEMS = "part, generate_series(1, p_size % 8) t(i)"
_TURN = "(p_partkey + i)"
_NAME = (
    f"CASE WHEN {_TURN} % 11 <> 0 THEN 'Café ' || p_name || ' & ' || p_brand || 'Nº ' || i END"
)


def _stored_nodes(spark, sf_dir, *columns):
    """(nodes, containers): pages are parsed once, then both sides read the node table, of which these columns are kept."""
    nodes = ht.html_nodes(listing_pages_b(load_part(spark, sf_dir)))
    nodes = materialize(nodes.select("page_id", "node_id", "end_id", "tag", "classes", *columns), "nodes")
    return nodes.drop("classes"), ht.elements_by_class(nodes, _ITEM.tag, _ITEM.class_)


@query("descendants", f"""
SELECT p_partkey AS page_id, CAST(i AS BIGINT) AS item,
       1 + 1 + CASE WHEN {_TURN} % 11 = 0 THEN 0 ELSE 1 END
         + CASE WHEN {_TURN} % 7 = 0 THEN 0 ELSE 1 END + CASE WHEN {_TURN} % 9 = 1 THEN 0 ELSE 1 END
         + 2 AS elements,
       2 + CASE WHEN {_TURN} % 9 IN (1, 2) THEN 0 ELSE 1 END + 2 AS texts
FROM {_ITEMS}""")
def descendant_counts(spark, sf_dir):
    nodes, items = _stored_nodes(spark, sf_dir, "text")
    number = F.regexp_extract("text", "^Nº ([0-9]+)$", 1).try_cast("bigint")
    return (
        descendants(items, nodes)
        .groupBy("page_id", "container_id")
        .agg(
            F.max(number).alias("item"),
            F.count("tag").cast("int").alias("elements"),
            F.count_if(F.col("tag").isNull()).cast("int").alias("texts"),
        )
        .drop("container_id")
    )


@query("first_descendant", f"""
SELECT p_partkey AS page_id,
       CASE WHEN {_TURN} % 7 = 2 THEN 'https://img.example.com/D_MLA' || (p_partkey * 10 + i // 2)
                 || '-O.jpg'
            WHEN {_TURN} % 7 IN (1, 4, 5, 6) THEN 'data:image/gif;base64,R0lGOD' END AS src
FROM {_ITEMS}""")
def first_images(spark, sf_dir):
    nodes, items = _stored_nodes(spark, sf_dir, "attrs")
    first = first_descendant(items, nodes.filter(F.col("tag") == "img"))
    return first.select("page_id", F.try_element_at("attrs", F.lit("src")).alias("src"))


@query("next_page_link", """
SELECT p_partkey AS page_id, CASE WHEN p_size % 5 <> 0 THEN
       'https://listado.example.com/' || p_partkey || '_Desde_49_NoIndex_True' END AS next_url
FROM part""")
def next_page_link(spark, sf_dir):
    pages = listing_pages_b(load_part(spark, sf_dir))
    return next_page_links(pages).select("page_id", "next_url")


# A shop that is nothing but a rule: the navigation entries of the given pages.
NAVIGATION = SiteRule(
    site="navigation",
    domains=("example.com", "example.org", "example.net"),
    seed_urls=("https://www.example.com/",),
    listing=PageRule(
        container=Selector("item", "li"),
        slots=(Selector("name", "a"), Selector("link", "a", read="href")),
    ),
)


@query("site_adapter", """
WITH entries AS (
  SELECT page_id, unnest(m) AS entry, unnest(range(len(m))) + 1 AS pos
  FROM (SELECT page_id, regexp_extract_all(html, '<li><a href="[^"]*">[^<]*</a></li>') AS m
        FROM pages))
SELECT page_id, CAST(pos AS INTEGER) AS pos,
       trim(replace(regexp_extract(entry, '>([^<>]*)</a>', 1), '&amp;', '&')) AS name,
       replace(regexp_extract(entry, 'href="([^"]*)"', 1), '&amp;', '&') AS link
FROM entries""")
def site_adapter(spark, sf_dir):
    pages = load_pages(spark, sf_dir).withColumn("site", F.lit(NAVIGATION.site))
    rows = good_rows(extract_listing(pages, {NAVIGATION.site: NAVIGATION}))
    return rows.select("page_id", "pos", "name", "link")
