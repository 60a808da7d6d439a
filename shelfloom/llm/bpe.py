"""Byte-level BPE: texts to the ids of an existing vocabulary, and back.

A text is split into words by the vocabulary's pattern, and merges never cross a word. Each
task keeps the ids of the distinct words it has met. The new words of a slice of texts are
laid end to end, with links to the neighbour on each side, and an index maps every pair that
has a rank to all places where it stands. Active ranks are applied in ascending order, each
at all its places in one go; a merge makes at most two new pairs, whose places are added to
their lists. Places that a merge has consumed are passed over when their list comes up.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfloom.llm.common import add_columns, free_name, texts_of

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
#: The published pattern of the vocabulary: contractions, letters, digits, other signs, blanks.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters read in one go, words resolved in one go, and bounds of a task's table of words.
WINDOW, RUN, CACHE_WORDS, CACHE_CHARS = 1 << 20, 400_000, 500_000, 16 << 20
#: Places from which a merge is done on whole arrays, not one place after the other.
MANY = 48


def byte_letters() -> list[str]:
    """The character that stands for each byte in the vocabulary's spelling.

    Visible Latin-1 characters stand for themselves; the other bytes, in order, for those from 256 on.
    """
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in visible]
    return [chr(b) if b in visible else chr(256 + hidden.index(b)) for b in range(256)]


def latin_pattern() -> str:
    """``PATTERN`` for texts of characters up to U+00FF, with its three classes spelled out: many times faster to match."""
    latin = [chr(i) for i in range(256)]

    def characters(kind: Callable[[str], object]) -> str:
        return "".join(map(re.escape, filter(kind, latin)))

    letters = characters(lambda c: unicodedata.category(c)[0] == "L")
    digits = characters(lambda c: unicodedata.category(c)[0] == "N")
    blanks = characters(regex.compile(r"\s").match)
    other = f"[^{blanks}{letters}{digits}]"
    return rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{letters}]+| ?[{digits}]+| ?{other}+|[{blanks}]+(?![^{blanks}])|[{blanks}]+"


@dataclass
class Vocabulary:
    """Bytes of each id, the ids of single bytes, merges by rank, and special strings."""

    spelled: list[bytes | None]
    of_byte: np.ndarray
    left: np.ndarray
    right: np.ndarray
    made: np.ndarray
    special: dict[str, int]

    @classmethod
    def read(cls, path: str = VOCABULARY) -> Vocabulary:
        """From a tokenizer's JSON file.

        Only merges whose parts come from merges of lower rank can be applied rank by rank;
        a file with others, or with settings that change the splitting, is refused.
        """
        file = json.loads(Path(path).read_text(encoding="utf-8"))
        model, split = file["model"], file["pre_tokenizer"]
        odd = [k for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges") if model.get(k)]
        odd += [k for k in ("single_word", "lstrip", "rstrip", "normalized") for t in file["added_tokens"] if t[k]]
        if odd or file["normalizer"] or split["type"] != "ByteLevel" or split["add_prefix_space"] or not split["use_regex"]:
            raise ValueError(f"not a plain byte-level vocabulary: {path} {odd}")
        letters = byte_letters()
        byte_of = {c: b for b, c in enumerate(letters)}
        ids, special = model["vocab"], {t["content"]: t["id"] for t in file["added_tokens"]}
        spelled: list[bytes | None] = [None] * (1 + max([*ids.values(), *special.values()]))
        for token, i in ids.items():
            spelled[i] = bytes(byte_of[c] for c in token)
        for token, i in special.items():
            spelled[i] = token.encode()
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left, right, made = (np.array([ids[t] for t in column], np.int32) for column in zip(*((a, b, a + b) for a, b in pairs), strict=True))
        born = np.full(len(spelled), -1)
        born[made] = np.arange(len(made))
        if (born[left] >= np.arange(len(made))).any() or (born[right] >= np.arange(len(made))).any() or len(set(made.tolist())) != len(made):
            raise ValueError(f"merges of {path} are not in order")
        return cls(spelled, np.array([ids[c] for c in letters], np.int32), left, right, made, special)


class Encoder:
    """The ids of texts, with a bounded table of the words met so far."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        v = self.vocabulary = vocabulary
        self.size = len(v.spelled)
        key = v.left.astype(np.int64) * self.size + v.right
        self.rank_of = dict(zip(key.tolist(), range(len(key)), strict=True))
        self.order = np.argsort(key)
        self.sorted_keys = key[self.order]
        self.pattern, self.latin = regex.compile(PATTERN), re.compile(latin_pattern())
        # Special strings are found first, wherever they stand, the longest at each place.
        names = sorted(v.special, key=len, reverse=True)
        self.specials = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        self.known_characters: set[str] = set()
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.held = 0
        self.start, self.length, self.flat = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int32)
        for name, i in self.vocabulary.special.items():
            self._add([name], np.array([i], np.int32), np.ones(1, np.int64))

    def _add(self, words: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        self.place.update(zip(words, range(len(self.place), len(self.place) + len(words)), strict=True))
        self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(sizes) - sizes])
        self.length = np.concatenate([self.length, sizes])
        self.flat = np.concatenate([self.flat, ids])
        self.held += sum(map(len, words))

    # --- splitting ---

    def _plain_words(self, text: str) -> list[str]:
        """Words of a text without special strings.

        The class of a character assigned after Python's own Unicode tables depends on the
        version of the splitting library, so texts with such characters go through the
        vocabulary library's splitter.
        """
        characters = set(text)
        if max(characters) <= "\xff":
            return self.latin.findall(text)
        new = characters - self.known_characters
        if any(unicodedata.category(c) == "Cn" for c in new):
            from tokenizers.pre_tokenizers import ByteLevel

            return [text[a:b] for _, (a, b) in ByteLevel(add_prefix_space=False).pre_tokenize_str(text)]
        if len(self.known_characters) < 50_000:
            self.known_characters |= new
        return self.pattern.findall(text)

    def words(self, text: str) -> Iterator[list[str]]:
        """The words of a text in runs; a long text is read a window at a time.

        What a window's end may have cut, its last two words, is read again with the next window.
        """
        for i, part in enumerate(self.specials.split(text) if self.specials else [text]):
            if i % 2:
                yield [part]
                continue
            at, window = 0, WINDOW
            while at < len(part):
                found = self._plain_words(part[at : at + window])
                if at + window < len(part):
                    if len(found) <= 2:
                        window *= 2
                        continue
                    del found[-2:]
                yield found
                at, window = at + sum(map(len, found)), WINDOW

    # --- merging ---

    def _merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words end to end, ids a word)."""
        v, size, rank_of = self.vocabulary, self.size, self.rank_of
        spelled = [w.encode("utf-8", "surrogatepass") for w in words]
        sizes = np.fromiter(map(len, spelled), np.int64, len(spelled))
        first = v.of_byte[np.frombuffer(b"".join(spelled), np.uint8)]
        n, starts = len(first), np.cumsum(sizes) - sizes
        after = np.arange(1, n + 1, dtype=np.int32)
        after[starts[1:] - 1] = -1
        after[-1] = -1
        before = np.arange(-1, n - 1, dtype=np.int32)
        before[starts] = -1
        # The index: places of each pair that has a rank, by rank.
        key = first[:-1].astype(np.int64) * size + first[1:]
        found = np.minimum(np.searchsorted(self.sorted_keys, key), len(self.sorted_keys) - 1)
        at = np.flatnonzero((self.sorted_keys[found] == key) & (after[:-1] >= 0)).astype(np.int32)
        ranks = self.order[found[at]]
        by_rank = np.argsort(ranks, kind="stable")
        ranks, at = ranks[by_rank], at[by_rank]
        cuts = np.flatnonzero(np.diff(ranks)) + 1
        index: dict[int, array] = {}
        for rank, places in zip(ranks[np.r_[0, cuts]].tolist() if len(ranks) else [], np.split(at, cuts), strict=False):
            index[rank] = array("i", places.tobytes())
        active = list(index)
        heapq.heapify(active)
        symbol, after, before = array("i", first.tobytes()), array("i", after.tobytes()), array("i", before.tobytes())
        links = [np.frombuffer(x, np.int32) for x in (symbol, after, before)]
        while active:
            rank = heapq.heappop(active)
            a, b, c = int(v.left[rank]), int(v.right[rank]), int(v.made[rank])
            places = index.pop(rank)
            if len(places) >= MANY and a != b:
                for new, there in self._merge_many(*links, np.frombuffer(places, np.int32), a, b, c):
                    if new not in index:
                        index[new] = array("i")
                        heapq.heappush(active, new)
                    index[new].frombytes(there.tobytes())
                continue
            # In a run of one symbol pairs overlap, and the leftmost goes first.
            for p in sorted(places) if a == b else places:
                q = after[p]
                if symbol[p] != a or q < 0 or symbol[q] != b:
                    continue
                symbol[p], symbol[q] = c, -1
                right, left = after[q], before[p]
                after[p] = right
                if right >= 0:
                    before[right] = p
                    new = rank_of.get(c * size + symbol[right])
                    if new is not None:
                        if new in index:
                            index[new].append(p)
                        else:
                            index[new] = array("i", (p,))
                            heapq.heappush(active, new)
                if left >= 0:
                    new = rank_of.get(symbol[left] * size + c)
                    if new is not None:
                        if new in index:
                            index[new].append(left)
                        else:
                            index[new] = array("i", (left,))
                            heapq.heappush(active, new)
        symbol = links[0]
        stays = symbol >= 0
        return symbol[stays], np.add.reduceat(stays, starts, dtype=np.int64)

    def _merge_many(
        self, symbol: np.ndarray, after: np.ndarray, before: np.ndarray, places: np.ndarray, a: int, b: int, c: int
    ) -> Iterator[tuple[int, np.ndarray]]:
        """Merge two different symbols at all places; (rank, places) of the new pairs."""
        p = places[symbol[places] == a]
        p = p[after[p] >= 0]
        p = np.unique(p[symbol[after[p]] == b])
        q = after[p]
        symbol[p], symbol[q] = c, -1
        right = after[q]
        after[p] = right
        inner = right >= 0
        before[right[inner]] = p[inner]
        left = before[p]
        left = left[left >= 0]
        there = np.concatenate([p[inner], left])
        key = symbol[there].astype(np.int64) * self.size + symbol[after[there]]
        found = np.minimum(np.searchsorted(self.sorted_keys, key), len(self.sorted_keys) - 1)
        known = self.sorted_keys[found] == key
        ranks, there = self.order[found[known]], there[known]
        if len(ranks):
            by_rank = np.argsort(ranks, kind="stable")
            ranks, there = ranks[by_rank], there[by_rank]
            cuts = np.flatnonzero(np.diff(ranks)) + 1
            yield from zip(ranks[np.r_[0, cuts]].tolist(), np.split(there, cuts), strict=True)

    def _resolve(self, runs: list[list[str]]) -> list[np.ndarray]:
        """Ids of each run of words."""
        if len(self.place) > CACHE_WORDS or self.held > CACHE_CHARS:
            self._forget()
        new = list(dict.fromkeys(w for run in runs for w in run if w not in self.place))
        if new:
            self._add(new, *self._merge(new))
        out = []
        for run in runs:
            at = np.fromiter(map(self.place.__getitem__, run), np.int64, len(run))
            sizes = self.length[at]
            shift = np.repeat(self.start[at] - (np.cumsum(sizes) - sizes), sizes)
            out.append(self.flat[shift + np.arange(len(shift))])
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        parts: list[list[np.ndarray]] = [[] for _ in texts]
        owners: list[int] = []
        runs: list[list[str]] = []
        held = 0

        def resolve() -> None:
            for owner, ids in zip(owners, self._resolve(runs), strict=True):
                parts[owner].append(ids)

        for i, text in enumerate(texts):
            for run in self.words(text):
                owners.append(i), runs.append(run)
                held += len(run)
                if held >= RUN:
                    resolve()
                    owners, runs, held = [], [], 0
        resolve()
        return [np.concatenate(p) if p else np.empty(0, np.int32) for p in parts]


def _packed(vocabulary: Vocabulary, text: str) -> Callable[[], Callable]:
    def make() -> Callable:
        encoder = Encoder(vocabulary)

        def cells(batch: pa.RecordBatch) -> list:
            texts = ["" if t is None else t.decode("utf-8", "replace") for t in texts_of(batch, text)]
            ids = encoder.encode(texts)
            return [list(map(len, ids)), [i.astype("<u4").tobytes() for i in ids]]

        return cells

    return make


def encoded(docs: DataFrame, vocabulary: Vocabulary | None = None, text: str = "text", ids: str = "ids", number: str = "n_tokens") -> DataFrame:
    """The rows of ``docs`` with the ids of the text (4 bytes each, lowest first) and their number.

    Special strings of the vocabulary that stand in a text are their single ids. NULL and
    empty texts have no ids. Every row is encoded on its own, repeated ones too, and stays in
    place; all columns are kept, and an added name that is taken gets underscores at its end.
    Memory follows the slice of texts in hand; a word without a break costs some 50 times its
    bytes while it is merged.
    """
    ids, number = free_name(docs, ids), free_name(docs, number)
    return add_columns(docs, _packed(vocabulary or Vocabulary.read(), text), f"`{number}` bigint, `{ids}` binary")


def bytes_of_ids(vocabulary: Vocabulary, ids: bytes) -> bytes:
    """The bytes that packed ids spell; ids that the vocabulary does not have spell nothing."""
    spelled = vocabulary.spelled
    top = len(spelled)
    return b"".join(spelled[i] or b"" for i in np.frombuffer(ids, "<u4").tolist() if i < top)


def decoded(rows: DataFrame, vocabulary: Vocabulary | None = None, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """The rows with the text that the packed ids spell; NULL spells the empty text.

    Bytes that are no UTF-8, as ids cut inside a character give, become U+FFFD.
    """
    vocabulary = vocabulary or Vocabulary.read()

    def make() -> Callable:
        return lambda batch: [[bytes_of_ids(vocabulary, i or b"").decode("utf-8", "replace") for i in texts_of(batch, ids)]]

    return add_columns(rows, make, f"`{free_name(rows, text)}` string")
