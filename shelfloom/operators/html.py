"""HTML to tables: tokens inside the JVM, elements through one Arrow pass per page."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from functools import reduce
from html.entities import html5
from itertools import accumulate
from operator import or_

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfloom import schemas
from shelfloom.operators.tree import PageTree
from shelfloom.rules import PageRule, Selector

# Fixed value: scripts, styles and comments are one token each, then tags, then text.
TOKEN_PATTERN = (
    r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->|<[^>]+>|[^<]+"
)
REJECTED = "markup_rejected"
UNSUPPORTED = "unsupported_site"
_ROWS_PER_BATCH = 8192


def html_tokens(pages: DataFrame) -> DataFrame:
    """(page_id, pos, token) for every token of every page, without leaving the JVM."""
    tokens = F.regexp_extract_all("html", F.lit(TOKEN_PATTERN), F.lit(0))
    return pages.select("page_id", F.posexplode(tokens).alias("pos", "token"))


def _tree(html: str | None) -> PageTree | None:
    """Tree of one page; None where the parser refuses the markup."""
    try:
        return PageTree(html or "")
    except AssertionError:
        return None


def _trees(batch: pa.RecordBatch) -> Iterator[tuple[int, PageTree]]:
    """(page id, tree) for the readable pages of a batch."""
    for page, html in zip(batch.column("page_id"), batch.column("html"), strict=True):
        if (tree := _tree(html.as_py())) is not None:
            yield page.as_py(), tree


def _lists(rows: Sequence[Sequence[str]]) -> tuple[pa.Array, pa.Array]:
    """Offsets and flat values of a list column."""
    offsets = pa.array(accumulate(map(len, rows), initial=0), pa.int32())
    return offsets, pa.array([v for row in rows for v in row], pa.string())


def _node_batch(trees: Sequence[tuple[int, PageTree]]) -> pa.RecordBatch:
    """Elements, then texts, of some pages."""

    def column(elements, texts, kind: pa.DataType) -> pa.Array:
        values = [v for _, t in trees for v in elements(t)]
        return pa.array(values + [v for _, t in trees for v in texts(t)], kind)

    def nothing(tree: PageTree) -> list:
        return [None] * len(tree.texts)

    pages = [page for page, tree in trees for _ in tree.ids]
    pages += [page for page, tree in trees for _ in tree.texts]
    attrs = [a for _, tree in trees for a in tree.attrs]
    attrs += [{} for _, tree in trees for _ in tree.texts]
    offsets, names = _lists([tuple(a) for a in attrs])
    _, values = _lists([tuple(a.values()) for a in attrs])
    int32, text = pa.int32(), pa.string()
    columns = {
        "page_id": pa.array(pages, pa.int64()),
        "node_id": column(lambda t: t.ids, lambda t: t.text_ids, int32),
        "end_id": column(lambda t: t.ends, lambda t: t.text_ids, int32),
        "parent_id": column(lambda t: t.parents, lambda t: t.text_parents, int32),
        "depth": column(lambda t: t.depths, lambda t: t.text_depths, int32),
        "tag": column(lambda t: t.tags, nothing, text),
        "classes": pa.ListArray.from_arrays(*_lists([a.get("class", "").split() for a in attrs])),
        "attrs": pa.MapArray.from_arrays(offsets, names, values),
        "text": column(lambda t: [None] * len(t.ids), lambda t: t.texts, text),
    }
    return pa.RecordBatch.from_pydict(columns)


def html_nodes(pages: DataFrame) -> DataFrame:
    """One row per element and per text of each page (see ``schemas.NODES``).

    ``node_id`` counts both kinds together in document order, and an element holds exactly
    the nodes with ``node_id < x <= end_id`` of its page. A text row has a NULL ``tag``.
    """

    def parse(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            trees: list[tuple[int, PageTree]] = []
            nodes = 0
            for page, tree in _trees(batch):
                trees.append((page, tree))
                nodes += tree.count
                if nodes >= _ROWS_PER_BATCH:
                    yield _node_batch(trees)
                    trees, nodes = [], 0
            if trees:
                yield _node_batch(trees)

    return pages.select("page_id", "html").mapInArrow(parse, schemas.NODES)


_MATCH_TYPES = pa.schema(
    [
        ("page_id", pa.int64()),
        ("slot", pa.string()),
        ("node_id", pa.int32()),
        ("end_id", pa.int32()),
        ("attrs", pa.map_(pa.string(), pa.string())),
        ("text_nodes", pa.list_(pa.string())),
    ]
)
_MATCH_DDL = (
    "page_id BIGINT, slot STRING, node_id INT, end_id INT, attrs MAP<STRING,STRING>, "
    "text_nodes ARRAY<STRING>"
)


def _in_batches(rows: Iterator[tuple], types: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Arrow batches of a bounded number of rows."""
    buffer: list[tuple] = []

    def flush() -> pa.RecordBatch:
        columns = [pa.array(c, t) for c, t in zip(zip(*buffer), types.types, strict=True)]
        buffer.clear()
        return pa.RecordBatch.from_arrays(columns, schema=types)

    for row in rows:
        buffer.append(row)
        if len(buffer) >= _ROWS_PER_BATCH:
            yield flush()
    if buffer:
        yield flush()


def find_all(pages: DataFrame, selectors: Sequence[Selector]) -> DataFrame:
    """Every element one of the selectors picks, with its texts.

    The selectors run while the page is parsed, so only matches leave the parsing task.
    """

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for page, tree in _trees(batch):
                for s in selectors:
                    for i in tree.matches(s):
                        yield (
                            page,
                            s.slot,
                            tree.ids[i],
                            tree.ends[i],
                            list(tree.attrs[i].items()),
                            tree.text_nodes(i),
                        )

    return pages.select("page_id", "html").mapInArrow(
        lambda batches: _in_batches(rows(batches), _MATCH_TYPES), _MATCH_DDL
    )


def class_match(classes: Column, wanted: str) -> Column:
    """One word matches any class; several words match the whole class list in order."""
    whole = F.array_join(classes, " ") == wanted
    return whole if " " in wanted else F.array_contains(classes, wanted) | whole


def elements_by_class(nodes: DataFrame, tag: str, wanted: str) -> DataFrame:
    return nodes.filter((F.col("tag") == tag) & class_match(F.col("classes"), wanted))


def elements_by_attr(nodes: DataFrame, tag: str, name: str, value: str) -> DataFrame:
    hit = F.try_element_at(F.col("attrs"), F.lit(name)) == value
    return nodes.filter((F.col("tag") == tag) & hit)


def slot_names(rules: Iterable[PageRule]) -> list[str]:
    """Slots of all the rules, each once, in order of first use."""
    return list(dict.fromkeys(s.slot for rule in rules for s in rule.slots))


def needles(selector: Selector) -> list[str]:
    """Strings of which html has none only if the selector matches nothing in it.

    A match needs the selector's word in the html, or a character reference that can stand
    for a piece of the word. Markup the parser may refuse also counts, so that it is refused.
    """
    word = selector.attr[1] if selector.class_ is None else selector.class_.split()[0]
    references = sorted("&" + name.rstrip(";") for name, text in html5.items() if text in word)
    return [word, "&#", "<![", *dict.fromkeys(references)]


def could_hold(html: Column, selector: Selector) -> Column:
    """False only for html in which the selector matches nothing; looked up by plain search."""
    return reduce(or_, (F.contains(html, F.lit(n)) for n in needles(selector)))


def _html_to_parse(rules: dict[str, PageRule]) -> Column:
    """The html of pages that may hold items; NULL where parsing would find none.

    In a mixed crawl most pages are no listings: they are told apart inside the JVM and
    their html never crosses into Python.
    """
    html = F.col("html")
    searched = {s: r.container for s, r in rules.items() if r.container is not None}
    searched = {s: c for s, c in searched.items() if c.class_ or c.attr}
    if not searched:
        return html
    words = F.create_map(*[x for s, c in searched.items() for x in (F.lit(s), F.array(*map(F.lit, needles(c))))])
    own = F.try_element_at(words, F.col("site"))
    return F.when(own.isNull() | F.exists(own, lambda word: F.contains(html, word)), html)


def page_items(pages: DataFrame, rules: dict[str, PageRule]) -> DataFrame:
    """Per page, the items its site's rule finds: (page_id, url, site, error, items).

    ``items`` holds one struct per container with every slot's first match as text. This
    is the only step that reads html; it is narrow, and everything after it is small.
    """
    slots = slot_names(rules.values())
    item = pa.struct([(s, pa.string()) for s in slots])
    positions = {
        site: [slots.index(s.slot) for s in rule.slots] for site, rule in rules.items()
    }

    def parse(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values: list[list[str | None]] = [[] for _ in slots]
            offsets, errors, total = [0], [], 0
            for site, html in zip(batch.column("site"), batch.column("html"), strict=True):
                rule = rules.get(site.as_py())
                tree = None if rule is None else _tree(html.as_py())
                errors.append(UNSUPPORTED if rule is None else REJECTED if tree is None else None)
                if tree is not None:
                    places = positions[site.as_py()]
                    for found in tree.items(rule):
                        for column in values:
                            column.append(None)
                        for place, value in zip(places, found, strict=True):
                            values[place][-1] = value
                        total += 1
                offsets.append(total)
            structs = pa.StructArray.from_arrays(
                [pa.array(v, pa.string()) for v in values], fields=list(item)
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"),
                    batch.column("url"),
                    batch.column("site"),
                    pa.array(errors, pa.string()),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), structs),
                ],
                names=["page_id", "url", "site", "error", "items"],
            )

    fields = ", ".join(f"{s}: STRING" for s in slots)
    url = F.col("url") if "url" in pages.columns else F.lit(None).cast("string")
    html = _html_to_parse(rules).alias("html")
    return pages.select("page_id", url.alias("url"), "site", html).mapInArrow(
        parse,
        f"page_id BIGINT, url STRING, site STRING, error STRING, items ARRAY<STRUCT<{fields}>>",
    )
