"""Text columns: node text and slugs."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space at the ends of a text node.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The same set as a class for regular expressions.
WHITESPACE_CLASS = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


def strip(text: Column) -> Column:
    return F.trim(text, F.lit(WHITESPACE))


def node_text(text_nodes: Column) -> Column:
    """Strip every text node, drop the empty ones, join the rest with nothing between."""
    return F.array_join(F.transform(text_nodes, strip), "")


@lru_cache(maxsize=1)
def ascii_folds() -> tuple[str, str, tuple[tuple[str, str], ...]]:
    """What compatibility decomposition leaves in ASCII, per non-ASCII character.

    Returns the characters that fold to one ASCII character, those characters' folds in
    the same order, and the (character, fold) pairs whose fold is longer.
    """
    single, folded, longer = [], [], []
    for code in range(0x80, 0x110000):
        char = chr(code)
        if not unicodedata.decomposition(char):
            continue
        ascii_part = "".join(c for c in unicodedata.normalize("NFKD", char) if c < "\x80")
        if len(ascii_part) == 1:
            single.append(char)
            folded.append(ascii_part)
        elif ascii_part:
            longer.append((char, ascii_part))
    return "".join(single), "".join(folded), tuple(longer)


def _ranges(codes: Iterable[int]) -> str:
    """Sorted code points as the inside of a character class."""
    runs: list[list[int]] = []
    for code in codes:
        if runs and runs[-1][1] == code - 1:
            runs[-1][1] = code
        else:
            runs.append([code, code])
    return "".join(f"\\x{{{first:x}}}-\\x{{{last:x}}}" for first, last in runs)


@lru_cache(maxsize=1)
def _longer_pattern() -> str:
    """A character with a longer fold; the common letters are ruled out by a first test."""
    longer = {ord(c) for c, _ in ascii_folds()[2]}
    common = _ranges(c for c in range(0x180) if c not in longer)
    return f"(?![{common}])[{_ranges(sorted(longer))}]"


def fold_to_ascii(text: Column) -> Column:
    """Compatibility-decompose and keep the ASCII part, without leaving the JVM.

    Plain ASCII text is returned as it is. The few hundred characters with longer folds
    (fractions, ligatures, units) are replaced only in texts that hold one.
    """
    single, folded, longer = ascii_folds()
    expanded = F.aggregate(
        F.split(F.lit("\n".join(c + s for c, s in longer)), "\n"),
        text,
        lambda acc, pair: F.replace(acc, F.substring(pair, 1, 1), pair.substr(F.lit(2), F.length(pair))),
    )
    with_longer = F.when(text.rlike(_longer_pattern()), expanded).otherwise(text)
    plain = F.regexp_replace(F.translate(with_longer, single, folded), r"[^\x00-\x7F]", "")
    return F.when(text.rlike(r"[^\x00-\x7F]"), plain).otherwise(text)


def slugify(text: Column) -> Column:
    """ASCII-folded, lower-case words joined by ``_``; text without any word gives ``''``."""
    words = F.regexp_replace(F.lower(fold_to_ascii(text)), "[^a-z0-9]+", "_")
    return F.trim(words, F.lit("_"))


def slug_of_name(name: Column) -> Column:
    """Slug of a product name; a missing or empty name has none."""
    return F.when(name != "", slugify(name))
