"""One page's elements in document order: the per-page helper of the parsing tasks.

The page is read with the standard library's HTML parser. Tree rules: void tags hold
nothing; an end tag closes up to its nearest open match and is ignored without one;
nothing else closes an element; what is open at the end of the page ends there.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from html.entities import html5
from html.parser import HTMLParser

from shelfloom.rules import PageRule, Selector

# Tags without content, and tags whose text is not text of the page.
VOID_TAGS = frozenset(
    "area base basefont bgsound br col command embed frame hr image img input isindex keygen "
    "link menuitem meta nextid param source track wbr".split()
)
MUTED_TAGS = frozenset("rp rt script style template".split())
# What a reference to no character reads as; half of a surrogate pair is none either.
_REPLACEMENT = "\ufffd"

# Plain pieces, which are nearly all of a page: text, tags with lower-case names and quoted
# values without markup in them but escaped ampersands, references, short comments. They mean
# the same however they are read; everything else, and tags whose content is read in another
# way, is fed to the library.
_ATTRS = r'((?:[ \t\r\n\f]+[a-z][a-z0-9-]*="[^"<>&]*(?:&amp;[^"<>&]*)*")*)[ \t\r\n\f]*'
_PLAIN = re.compile(
    r"([^<&]+)"
    rf"|<([a-z][a-z0-9]*){_ATTRS}(/?)>"
    r"|</([a-z][a-z0-9]*)>"
    r"|&([a-zA-Z][a-zA-Z0-9]*);"
    r"|&#([0-9]+);"
    r"|(<!--[^->]*-->|<!(?:DOCTYPE|doctype) [a-z]+>)"
)
_PLAIN_MUTED = re.compile(rf"<(script|style){_ATTRS}>[^<]*(?:<(?!!|/(?i:\1))[^<]*)*</\1>")
_TEXT, _START, _END, _ENTITY, _CHAR = 1, 4, 5, 6, 7
_ATTR_PAIRS = re.compile(r'([a-z][a-z0-9-]*)="([^"]*)"').findall
_OTHER_CONTENT = frozenset(
    "iframe math noembed noframes noscript plaintext script style svg textarea title xmp".split()
)


def _plain_attrs(text: str) -> dict[str, str]:
    pairs = _ATTR_PAIRS(text)
    return {name: value.replace("&amp;", "&") for name, value in pairs} if "&" in text else dict(pairs)


def _columns(rows: list[tuple], width: int) -> list[tuple]:
    return list(zip(*rows, strict=True)) if rows else [()] * width


class PageTree(HTMLParser):
    """Elements and texts as columns, numbered together in document order.

    Elements: ``ids, ends, parents, depths, tags, attrs``; texts: ``text_ids, text_parents,
    text_depths, texts``.
    """

    def __init__(self, html: str):
        super().__init__(convert_charrefs=False)
        self.count = 0
        self.ends: list[int] = []
        self._elements: list[tuple[int, int | None, int, str, dict[str, str]]] = []
        self._texts: list[tuple[int, int | None, int, str]] = []
        self._open: list[tuple[int, int, str]] = []
        self._open_tags: dict[str, int] = defaultdict(int)
        self._muted = 0
        self._closed_void: dict[str, int] = defaultdict(int)
        self._pending: list[str] = []
        self._read(html)
        self.close()
        self._end_text()
        while self._open:
            self._pop()
        self.ids, self.parents, self.depths, self.tags, self.attrs = _columns(self._elements, 5)
        self.text_ids, self.text_parents, self.text_depths, self.texts = _columns(self._texts, 4)
        self._by_tag: dict[str, list[int]] | None = None

    def _read(self, html: str) -> None:
        # The most frequent pieces are dealt with here: calls are half of the time of a page.
        match, at, size = _PLAIN.match, 0, len(html)
        pending, stack, elements, ends = self._pending, self._open, self._elements, self.ends
        open_tags, closed_void = self._open_tags, self._closed_void
        while at < size:
            plain = match(html, at)
            if plain is None:
                at = self._feed_odd_piece(html, at)
                continue
            kind = plain.lastindex
            if kind == _TEXT:
                pending.append(plain[1])
            elif kind == _START:
                _, tag, attrs, slash, *_ = plain.groups()
                if tag in _OTHER_CONTENT:
                    at = self._read_other_content(html, at)
                    continue
                attrs = _plain_attrs(attrs) if attrs else {}
                if slash:
                    self._start_and_end(tag, attrs)
                elif tag in VOID_TAGS or tag in MUTED_TAGS:
                    self._start(tag, attrs)
                else:
                    if pending:
                        self._end_text()
                    number = self.count
                    elements.append((number, stack[-1][1] if stack else None, len(stack), tag, attrs))
                    stack.append((len(ends), number, tag))
                    open_tags[tag] += 1
                    ends.append(number)
                    self.count = number + 1
            elif kind == _END:
                tag = plain[5]
                if not stack or stack[-1][2] != tag or tag in MUTED_TAGS or closed_void[tag]:
                    self.handle_endtag(tag)
                else:
                    if pending:
                        self._end_text()
                    ends[stack.pop()[0]] = self.count - 1
                    open_tags[tag] -= 1
            elif kind == _ENTITY:
                self.handle_entityref(plain[6])
            elif kind == _CHAR:
                self.handle_charref(plain[7])
            else:
                self._end_text()
            at = plain.end()

    def _read_other_content(self, html: str, at: int) -> int:
        """A script or style without its own end tag or comments in it holds nothing of the page."""
        plain = _PLAIN_MUTED.match(html, at)
        if plain is None:
            return self._feed_odd_piece(html, at)
        self._open_tag(plain[1], _plain_attrs(plain[2]))
        self._close_tag(plain[1])
        return plain.end()

    def _feed_odd_piece(self, html: str, at: int) -> int:
        """Feed the library until it has taken in all it was given; returns the next place.

        What it holds back doubles the next portion, so that no page is fed over and over.
        """
        while True:
            least = at + 2 * len(self.rawdata)
            if self.cdata_elem is not None:
                closing = re.compile("</" + self.cdata_elem, re.IGNORECASE).search(html, at)
                least = max(least, closing.end() if closing else len(html))
            cut = html.find(">", least) + 1 or len(html)
            self.feed(html[at:cut])
            at = cut
            if at >= len(html) or not (self.rawdata or self.cdata_elem):
                return at

    def _end_text(self) -> None:
        pending = self._pending
        text = pending[0] if len(pending) == 1 else "".join(pending)
        pending.clear()
        if self._muted or not text or text.isspace():
            return
        parent = self._open[-1][1] if self._open else None
        self._texts.append((self.count, parent, len(self._open), text))
        self.count += 1

    def _pop(self) -> None:
        index, _, tag = self._open.pop()
        self.ends[index] = self.count - 1
        self._open_tags[tag] -= 1
        self._muted -= tag in MUTED_TAGS

    def _close_tag(self, tag: str) -> None:
        if self._pending:
            self._end_text()
        if not self._open_tags[tag]:
            return
        while self._open[-1][2] != tag:
            self._pop()
        self._pop()

    def _open_tag(self, tag: str, attrs: dict[str, str]) -> None:
        if self._pending:
            self._end_text()
        number, stack = self.count, self._open
        parent = stack[-1][1] if stack else None
        self._elements.append((number, parent, len(stack), tag, attrs))
        stack.append((len(self.ends), number, tag))
        self._open_tags[tag] += 1
        self._muted += tag in MUTED_TAGS
        self.ends.append(number)
        self.count = number + 1

    def updatepos(self, i, j):
        # Line numbers are not used; counting them costs a tenth of the parse.
        return j

    def handle_starttag(self, tag, attrs):
        self._start(tag, {name: value or "" for name, value in attrs})

    def _start(self, tag: str, attrs: dict[str, str]) -> None:
        self._open_tag(tag, attrs)
        if tag in VOID_TAGS:
            self._close_tag(tag)
            self._closed_void[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self._start_and_end(tag, {name: value or "" for name, value in attrs})

    def _start_and_end(self, tag: str, attrs: dict[str, str]) -> None:
        self._open_tag(tag, attrs)
        self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if self._closed_void[tag]:
            self._closed_void[tag] -= 1
        else:
            self._close_tag(tag)

    def handle_data(self, data):
        self._pending.append(data)

    def handle_entityref(self, name):
        known = html5.get(name + ";") or html5.get(name)
        self._pending.append(known or "&" + name)

    def handle_charref(self, name):
        try:
            code = int(name[1:], 16) if name[0] in "xX" else int(name)
            if code < 256:
                char = bytes([code]).decode("cp1252", "ignore") or chr(code)
            else:
                char = _REPLACEMENT if 0xD800 <= code <= 0xDFFF else chr(code)
        except (ValueError, OverflowError):
            char = _REPLACEMENT
        self._pending.append(char)

    def handle_comment(self, data):
        self._end_text()

    handle_decl = handle_pi = handle_comment

    def unknown_decl(self, data):
        self._end_text()
        if data.upper().startswith("CDATA["):
            self._pending.append(data[len("CDATA[") :])
            self._end_text()

    def text_nodes(self, index: int) -> list[str]:
        """Texts inside an element, in document order."""
        first = bisect_right(self.text_ids, self.ids[index])
        return self.texts[first : bisect_right(self.text_ids, self.ends[index])]

    def text(self, index: int) -> str:
        return "".join(map(str.strip, self.text_nodes(index)))

    def matches(self, selector: Selector) -> list[int]:
        """Elements a selector picks, in document order."""
        if self._by_tag is None:
            self._by_tag = defaultdict(list)
            for index, tag in enumerate(self.tags):
                self._by_tag[tag].append(index)
        found = []
        for index in self._by_tag.get(selector.tag, ()):
            attrs = self.attrs[index]
            if selector.class_ is not None:
                words = attrs.get("class", "").split()
                if selector.class_ not in words and selector.class_ != " ".join(words):
                    continue
            if selector.attr is not None and attrs.get(selector.attr[0]) != selector.attr[1]:
                continue
            if selector.pattern is not None and not re.search(selector.pattern, self.text(index)):
                continue
            found.append(index)
        return found

    def read(self, index: int, selector: Selector) -> str | None:
        return self.text(index) if selector.read == "text" else self.attrs[index].get(selector.read)

    def items(self, rule: PageRule) -> Iterator[list[str | None]]:
        """Per container, the first match of every slot inside it; None without a match."""
        slots = [(s, found := self.matches(s), [self.ids[i] for i in found]) for s in rule.slots]
        if rule.container is None:
            spans = [(-1, self.count)]
        else:
            spans = [(self.ids[i], self.ends[i]) for i in self.matches(rule.container)]
        for start, end in spans:
            values: list[str | None] = []
            for selector, found, ids in slots:
                at = bisect_right(ids, start)
                inside = at < len(ids) and ids[at] <= end
                values.append(self.read(found[at], selector) if inside else None)
            yield values
