"""Spelling variants: words one edit apart, found by pivotal grams.

Bigrams are ordered by how many words have them, rare ones first. One edit destroys at most
one of two bigrams of a word that do not overlap. So of two words one edit apart, the one
whose prefix (its three rarest bigrams) ends earlier in that order has, among two disjoint
bigrams of its prefix, its pivots, one that stands unharmed in the prefix of the other. Pivots
are indexed, prefixes look them up, and positions limit the hits: an edit after the first pivot
leaves all up to the pivot's end in place, any other all from the second pivot on, and in both
cases one half of the remainder. A key is what is left in place with the length of the word that
has the pivot, so words that only share a bigram do not meet. Candidates are verified.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfloom.llm.common import add_columns, mix, texts_of
from shelfloom.sources.scratch import materialize

#: Words are runs of these; their bigrams are at most 90 * 90, whatever the corpus.
RUN = re.compile("[a-zÀ-ÿ]+")
LEAST_LENGTH, LEAST_COUNT, TIMES = 7, 2, 10
#: One run in so many loses a letter, chosen by its hash; None leaves all as they are.
DAMAGE = 31
_SMALL = bytes((b | 32 if 65 <= b <= 90 else b) for b in range(256))
#: Letters of ``RUN``; odd factors of the hashes.
LETTERS = 26 + 64
_STEP, _SPREAD = np.uint64(0xD6E8FEB86659FD93), np.uint64(0x9E3779B97F4A7C15)
#: Distinct words a task counts before it hands them on.
_HELD = 300_000


def damaged(doc_id: str, run: str, one_in: int | None = DAMAGE) -> str:
    """The run, without one of its letters if the hash of document and run says so."""
    h = zlib.crc32(f"{doc_id}:{run}".encode())
    if one_in is None or h % one_in:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def _counted(least_length: int, one_in: int | None) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])
            counts.clear()
            return made

        for batch in batches:
            for doc_id, text in zip(batch["id"].to_pylist(), texts_of(batch, "text"), strict=True):
                if not text:
                    continue
                runs = Counter(RUN.findall(text.translate(_SMALL).decode("utf-8", "replace")))
                for word, n in runs.items():
                    if len(word) >= least_length:
                        word = damaged(doc_id, word, one_in)
                        if len(word) >= least_length:
                            counts[word] += n
                if len(counts) >= _HELD:
                    yield out()
        if counts:
            yield out()

    return run


def word_counts(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, one_in: int | None = DAMAGE) -> DataFrame:
    """(word, n) of all words of the whole texts with enough letters and occurrences.

    Only A-Z are lower-cased. A NULL doc_id counts as the empty text in the hash that damages runs.
    """
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.col("text").cast("binary").alias("text"))
    counts = rows.mapInArrow(_counted(least_length, one_in), "word string, n bigint")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()
    for batch in batches:
        for word in batch["word"].to_pylist():
            counts.update({x + y for x, y in zip(word, word[1:], strict=False)})
    yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["gram", "n"])


def gram_order(words: DataFrame) -> np.ndarray:
    """Place of each bigram, (first letter, second letter), when ordered by the number of words that have it, then by itself.

    At most 8100 rows reach the driver: the letters of ``RUN`` bound them.
    """
    found = words.select("word").mapInArrow(_gram_counts, "gram string, n bigint").groupBy("gram").agg(F.sum("n").alias("n")).collect()
    order = np.zeros((LETTERS, LETTERS), np.int64)
    for place, row in enumerate(sorted(found, key=lambda r: (r["n"], r["gram"]))):
        order[tuple(_codes([row["gram"]])[0])] = place
    return order


def _codes(words: list[str]) -> np.ndarray:
    """Letters of words of one length as numbers below ``LETTERS``, a row a word."""
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1).astype(np.int64)
    return np.where(points < 0xC0, points - ord("a"), points - 0xC0 + 26)


def pivots(places: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the two disjoint allowed grams of least total place, a row a word; -1 if there are none.

    By dynamic programming from left to right: the cheapest first gram that ends before each
    position, and the cheapest pair up to it.
    """
    rows, n = places.shape
    far = np.iinfo(np.int64).max // 4
    cost = np.where(allowed, places, far)
    single, single_at = np.full(rows, far), np.full(rows, -1)
    pair, first, second = np.full(rows, far), np.full(rows, -1), np.full(rows, -1)
    for i in range(2, n):
        better = cost[:, i - 2] < single
        single, single_at = np.where(better, cost[:, i - 2], single), np.where(better, i - 2, single_at)
        total = single + cost[:, i]
        better = total < pair
        pair, first, second = np.where(better, total, pair), np.where(better, single_at, first), np.where(better, i, second)
    return first, second


def _running(codes: np.ndarray) -> np.ndarray:
    """Hashes of the first 0, 1, 2 ... letters, a row a word."""
    out = np.zeros((codes.shape[0], codes.shape[1] + 1), np.uint64)
    for i in range(codes.shape[1]):
        out[:, i + 1] = out[:, i] * _STEP + codes[:, i].astype(np.uint64) + np.uint64(1)
    return out


class _Keys:
    """Keys of words of one length.

    A key is the length of the word with the pivot, how many letters are equal at the start and
    how many at the end, and their hashes. An edit after the first pivot leaves all up to its
    end; it also leaves one half of what follows. Any other edit comes before the second pivot
    and leaves all from there on, and one half of what precedes. A prefix holds every place of
    its grams, so a gram that a word has twice is found at both.
    """

    def __init__(self, words: list[str], order: np.ndarray) -> None:
        codes = _codes(words)
        self.n = codes.shape[1]
        self.places = order[codes[:, :-1], codes[:, 1:]]
        last = np.sort(self.places, axis=1)[:, 2]
        self.prefix = self.places <= last[:, None]
        self.left, self.right = _running(codes), _running(codes[:, ::-1])
        # 32 bits for letters and 32 for bigrams: one edit changes two of those and four of these.
        bit = np.uint64(1)
        self.seen = np.bitwise_or.reduce(bit << (codes % 32).astype(np.uint64), axis=1)
        grams = (codes[:, :-1] * 7 + codes[:, 1:] * 13) % 32 + 32
        self.seen |= np.bitwise_or.reduce(bit << grams.astype(np.uint64), axis=1)

    def _key(self, rows: np.ndarray, length: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        head = (np.full(len(rows), length, np.uint64) * _SPREAD + start.astype(np.uint64)) * _SPREAD + end.astype(np.uint64)
        return mix((head * _SPREAD + self.left[rows, start]) * _SPREAD + self.right[rows, end])

    def own(self) -> tuple[np.ndarray, np.ndarray]:
        """(row, key) of the pivots."""
        first, second = pivots(self.places, self.prefix)
        rows = np.arange(len(first))
        none, found = np.zeros(len(rows), np.int64), []
        rest = self.n - first - 2
        found += [self._key(rows, self.n, first + 2 + rest // 2, none), self._key(rows, self.n, first + 2, rest - rest // 2)]
        found += [self._key(rows, self.n, none, self.n - second + second - second // 2), self._key(rows, self.n, second // 2, self.n - second)]
        return np.tile(rows, 4), np.concatenate(found)

    def sought(self) -> tuple[np.ndarray, np.ndarray]:
        """(row, key) that the prefix looks up, for words as long, a letter shorter and a letter longer."""
        rows, i = np.nonzero(self.prefix)
        kept, none = self.n - i, np.zeros(len(rows), np.int64)
        out_rows, out_keys = [], []
        for length in (self.n - 1, self.n, self.n + 1):
            rest, before = length - i - 2, length - kept
            for start, end in ((i + 2 + rest // 2, none), (i + 2, rest - rest // 2), (none, kept + before - before // 2), (before // 2, kept)):
                ok = (start >= 0) & (start <= self.n) & (end >= 0) & (end <= self.n)
                out_rows.append(rows[ok])
                out_keys.append(self._key(rows[ok], length, start[ok], end[ok]))
        return np.concatenate(out_rows), np.concatenate(out_keys)


def _keyed(order: np.ndarray, side: str) -> Callable:
    """Per task: (key, id, seen) of one side of the join."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, ids = batch["word"].to_pylist(), batch["id"].to_numpy(zero_copy_only=False)
            sizes = np.fromiter(map(len, words), np.int64, len(words))
            for n in np.unique(sizes[sizes >= 4]).tolist():
                every = np.flatnonzero(sizes == n)
                # Long words go in small groups: a group's memory follows its letters.
                part = max(1, 50_000 // n)
                for at in range(0, len(every), part):
                    own = every[at : at + part]
                    table = _Keys([words[i] for i in own], order)
                    rows, found = getattr(table, side)()
                    columns = [pa.array(found.view(np.int64)), pa.array(ids[own][rows]), pa.array(table.seen[rows].view(np.int64))]
                    yield pa.RecordBatch.from_arrays(columns, ["key", "id", "seen"])

    return run


def one_edit(a: str, b: str) -> bool:
    """Whether one inserted, deleted or replaced letter makes ``a`` of ``b``."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    same = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[same + (len(a) == len(b)) :] == b[same + 1 :] and len(a) + len(b) > 2 * same


def _verified() -> Callable:
    return lambda batch: [[one_edit(a, b) for a, b in zip(batch["a"].to_pylist(), batch["b"].to_pylist(), strict=True)]]


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, other, other_n): every ordered pair of words of ``words`` (word, n) that are one edit apart.

    Exact for words of four letters and more: three bigrams always hold two disjoint ones. Shorter
    words are not paired. Words are written with a number; only keys, numbers and bits that tell
    letters and bigrams go through the join of keys, so a very long word is not carried by each key.
    """
    order = gram_order(words)
    named = materialize(words.select("word", "n").withColumn("id", F.monotonically_increasing_id()), "spelling_ids")
    left, right = (
        named.select("word", "id").mapInArrow(_keyed(order, side), "key bigint, id bigint, seen bigint").toDF("key", f"id_{s}", f"seen_{s}")
        for side, s in (("own", "a"), ("sought", "b"))
    )
    changed = F.col("seen_a").bitwiseXOR(F.col("seen_b"))
    may = (F.bit_count(changed.bitwiseAND(F.lit((1 << 32) - 1))) <= 2) & (F.bit_count(F.shiftrightunsigned(changed, 32)) <= 4)
    met = left.join(right, "key").filter((F.col("id_a") != F.col("id_b")) & may)
    met = met.select(F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b")).distinct()
    one, two = (named.select("id", "word", "n").toDF(f"id_{s}", s, f"n_{s}") for s in "ab")
    pairs = met.join(one, "id_a").join(two, "id_b").select("a", "n_a", "b", "n_b")
    one_apart = add_columns(pairs, _verified, "near boolean").filter("near")
    both = F.explode(F.array(*(
        F.struct(F.col(s).alias("word"), F.col(f"n_{s}").alias("n"), F.col(o).alias("other"), F.col(f"n_{o}").alias("other_n"))
        for s, o in ("ab", "ba")
    )))
    return one_apart.select(both.alias("z")).select("z.*")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form: forms followed to the last.

    Each step multiplies the count by ``TIMES`` or more, so chains are short; doubling the
    steps in every round, some five rounds are enough for any count.
    """
    reached = materialize(forms.select("word", F.col("form").alias("root")), "spelling_roots")
    while True:
        onward = reached.select(F.col("word").alias("_word"), F.col("root").alias("_root"))
        joined = reached.join(onward, F.col("root") == F.col("_word"), "left")
        moved = materialize(joined.select("word", F.coalesce("_root", "root").alias("root"), F.col("_root").isNotNull().alias("more")), "spelling_roots")
        if moved.filter("more").isEmpty():
            return reached
        reached = moved.drop("more")


def variants(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, one_in: int | None = DAMAGE, times: int = TIMES) -> DataFrame:
    """(word, form, root, n, n_near, form_n): every word of the texts with its most frequent near word.

    ``form`` is the near word of largest count, the first in code-point order among equals, if it
    is ``times`` as frequent, else NULL; ``root`` is the last form, or the word itself. NULL and
    empty texts have no words; rows that repeat a doc_id all count; other columns are not read.
    """
    words = materialize(word_counts(docs, least_length, least_count, one_in), "spelling_words")
    best = F.min(F.struct((-F.col("other_n")).alias("n"), F.col("other").alias("word"))).alias("best")
    near = near_words(words).groupBy("word", "n").agg(F.count("*").alias("n_near"), best)
    fits = -F.col("best.n") >= times * F.col("n")
    near = materialize(near.select(
        "word", "n_near", F.when(fits, F.col("best.word")).alias("form"), F.when(fits, -F.col("best.n")).alias("form_n"),
    ), "spelling_near")
    roots = _roots(near.filter(F.col("form").isNotNull()))
    return words.join(near, "word", "left").join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n",
        F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), "form_n",
    )
