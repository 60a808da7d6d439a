"""Phrase collocations from sorted streams of counts.

Counting goes order by order. A word that stands less than ``least`` times is in no candidate,
and neither is a phrase whose first or last part is rarer, so two-word phrases are counted
between frequent words only, and longer ones between frequent phrases. A bit array of fixed
size tells the tasks which parts may be frequent; a wrong yes costs a counted row and is
filtered by the exact counts afterwards.

All counts together are one stream of (lang, words, n). Sorted by words from the left, a
phrase comes right after its own first parts, so that one pass beside the stream reads the
counts of all first parts off the rows before, and each row sees the phrase that it extends
to the right. The same stream sorted by words from the right (the reversed phrase) gives the
counts of the rests and the extensions to the left. No table of counts is looked up. The
sorted stream is cut into ranges of even size, wherever a cut falls; a range starts with a
copy of the first parts of its first row, so no word or language has to fit into one task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfloom.llm.common import mix, slices
from shelfloom.sources.scratch import materialize

LEAST, TOP = 10, 2000
#: An extension with at least this share of a phrase's count drops the phrase.
SHARE = (50, 100)
#: log2 of the bits that stand for frequent words or phrases: 4 MB, whatever the corpus.
BITS = 25
#: Distinct words, and phrases, that a task holds before it hands its counts on; words counted in one go.
_WORDS, _PHRASES, _RUN = 150_000, 400_000, 1 << 18
_MANY = np.uint64(0x9E3779B97F4A7C15)
#: A-Z become small letters, the marks that end a piece become line ends, tabs become blanks.
_ENDS = b".,;:!?\n\x0b\x0c\r"
_PIECES = bytes(
    b | 32 if 65 <= b <= 90 else 10 if b in _ENDS else 32 if b == 9 else b for b in range(256)
)
#: Bytes of a text that are split in one go.
_WINDOW = 1 << 20
_NO_LANG = "und"


def windows(text: bytes) -> Iterator[list[bytes]]:
    """Words of a text in runs, empty ones between blanks; a line end stands between pieces and after the last.

    A long text is cut at blanks; runs then follow on each other within a piece.
    """
    text = text.translate(_PIECES)
    at = 0
    while at < len(text):
        end = min(at + _WINDOW, len(text))
        if end < len(text):
            # Cut after a blank, so that no word is cut.
            cut = max(text.rfind(b" ", at, end), text.rfind(b"\n", at, end))
            while cut < 0 and end < len(text):
                end = min(end + _WINDOW, len(text))
                cut = max(text.rfind(b" ", at, end), text.rfind(b"\n", at, end))
            end = cut + 1 if cut >= 0 else end
        yield text[at:end].replace(b"\n", b" \n ").split(b" ")
        at = end
    yield [b"\n"]


class _Numbers(dict):
    """Numbers of the words of one language, given at the first sight of a word."""

    def __init__(self, lang: str, words: list[tuple[str, bytes]]) -> None:
        # No word is empty: blanks that follow on each other are passed over.
        super().__init__({b"\n": 0, b"": -1})
        self.lang, self.words = lang, words

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self.words)
        self.words.append((self.lang, word))
        return number


class _Words:
    """Numbers of the words met, per language, with their hashes; 0 stands for the end of a piece."""

    def __init__(self) -> None:
        self.words: list[tuple[str, bytes]] = [("", b"\n")]
        self.place: dict[str, _Numbers] = {}
        self._hashes = np.empty(0, np.uint64)

    def numbers(self, lang: str, words: list[bytes]) -> np.ndarray:
        place = self.place.get(lang)
        if place is None:
            place = self.place[lang] = _Numbers(lang, self.words)
        out = np.fromiter(map(place.__getitem__, words), np.int64, len(words))
        return out[out >= 0]

    def hashes(self) -> np.ndarray:
        new = self.words[len(self._hashes) :]
        if new:
            seeds = {lang: xxhash.xxh3_64_intdigest(lang.encode()) for lang in {lang for lang, _ in new}}
            own = np.array([xxhash.xxh3_64_intdigest(w, seed=seeds[lang]) for lang, w in new], np.uint64)
            self._hashes = np.concatenate([self._hashes, own])
        return self._hashes

    def phrases(self, numbers: np.ndarray) -> tuple[pa.Array, pa.Array]:
        """(languages, phrases) of rows of numbers; words are joined by a blank."""
        used, at = np.unique(numbers, return_inverse=True)
        at = at.reshape(numbers.shape)
        text = pa.array([self.words[i][1].decode("utf-8", "replace") for i in used.tolist()], pa.string())
        lang = pa.array([self.words[i][0] for i in used.tolist()], pa.string())
        parts = [text.take(pa.array(column)) for column in at.T]
        return lang.take(pa.array(at[:, 0])), pc.binary_join_element_wise(*parts, " ") if len(parts) > 1 else parts[0]


def _word_hashes(lang: str, words: list[bytes]) -> np.ndarray:
    seed = xxhash.xxh3_64_intdigest(lang.encode())
    return np.array([xxhash.xxh3_64_intdigest(w, seed=seed) for w in words], np.uint64)


def _phrase_hash(hashes: np.ndarray) -> np.ndarray:
    """Hash of phrases from the hashes of their words, (phrases, words)."""
    total = hashes[:, 0].copy()
    for j in range(1, hashes.shape[1]):
        total = total * _MANY + hashes[:, j]
    return mix(total)


def _maybe(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes >> np.uint64(64 - BITS)
    return (bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def _phrases(order: int, bits: np.ndarray | None) -> Callable:
    """Per task: (lang, phrase, n), counts of the phrases of ``order`` words whose parts may be frequent.

    A phrase is a number of ``63 // order`` bits a word; a task may hand on a phrase more than once.
    """
    width = 63 // order

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Words()
        line: list[np.ndarray] = []
        counted: list[tuple[np.ndarray, np.ndarray]] = []
        held = 0

        def count() -> None:
            """The phrases of the words in hand."""
            words = np.concatenate(line)
            n = len(words) - order + 1
            if n <= 0:
                return
            grams = [words[j : j + n] for j in range(order)]
            fits = np.ones(n, bool)
            for g in grams:
                fits &= g > 0
            if bits is not None and order == 2:
                may = _maybe(bits, _phrase_hash(known.hashes()[:, None]))
                for g in grams:
                    fits &= may[g]
            grams = [g[fits] for g in grams]
            if bits is not None and order > 2:
                every = known.hashes()
                hashes = np.stack([every[g] for g in grams], axis=1)
                fits = _maybe(bits, _phrase_hash(hashes[:, :-1])) & _maybe(bits, _phrase_hash(hashes[:, 1:]))
                grams = [g[fits] for g in grams]
            key = np.zeros(len(grams[0]), np.int64)
            for g in grams:
                key = (key << width) | g
            counted.append(np.unique(key, return_counts=True))

        def compact() -> int:
            """One count a phrase; their number."""
            if not counted:
                return 0
            key, where = np.unique(np.concatenate([k for k, _ in counted]), return_inverse=True)
            times = np.zeros(len(key), np.int64)
            np.add.at(times, where, np.concatenate([n for _, n in counted]))
            counted[:] = [(key, times)]
            return len(key)

        def out() -> pa.RecordBatch:
            compact()
            key, times = counted.pop() if counted else (np.empty(0, np.int64), np.empty(0, np.int64))
            numbers = np.stack([(key >> (width * (order - 1 - j))) & ((1 << width) - 1) for j in range(order)], axis=1)
            return pa.RecordBatch.from_arrays([*known.phrases(numbers), pa.array(times)], ["lang", "phrase", "n"])

        for batch in (part for whole in batches for part in slices(whole)):
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist(), strict=True):
                for words in windows(text or b""):
                    line.append(known.numbers(lang, words))
                    held += len(words)
                    if held < _RUN:
                        continue
                    count()
                    # The last words go on into the next run of the same text.
                    tail = np.concatenate(line)[-(order - 1) :] if order > 1 else np.empty(0, np.int64)
                    held = 0
                    if sum(len(k) for k, _ in counted) > _PHRASES:
                        full = compact() > _PHRASES // 2
                    else:
                        full = False
                    if full or len(known.words) > _WORDS:
                        yield out()
                        # Numbers start anew, those of the words carried over as well.
                        carried = [known.words[i][1] for i in tail.tolist()]
                        known = _Words()
                        tail = known.numbers(lang, carried)
                    line[:] = [tail]
        if line:
            count()
        yield out()

    return run


def phrase_counts(docs: DataFrame, order: int, parts: DataFrame | None = None, least: int = LEAST) -> DataFrame:
    """(lang, phrase, n) of the phrases of ``order`` words; ``parts``, those a word shorter, narrows them.

    With ``parts`` only phrases of at least ``least`` occurrences are given, without it all words.
    """
    bits = None if parts is None else _bits(parts)
    counts = docs.mapInArrow(_phrases(order, bits), "lang string, phrase string, n bigint")
    counts = counts.groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
    return counts if parts is None else counts.filter(F.col("n") >= least)


def _bits(parts: DataFrame) -> np.ndarray:
    """Bit array of the phrases of a table; at most 2 ** BITS / 64 rows reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(1 << (BITS - 6), np.uint64)
        for batch in batches:
            for lang, phrase in zip(batch["lang"].to_pylist(), batch["phrase"].to_pylist(), strict=True):
                h = _phrase_hash(_word_hashes(lang, phrase.encode().split(b" "))[None, :])[0] >> np.uint64(64 - BITS)
                cells[h >> np.uint64(6)] |= np.uint64(1) << (h & np.uint64(63))
        used = np.flatnonzero(cells)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(cells[used].view(np.int64))], ["cell", "bits"])

    rows = parts.select("lang", "phrase").mapInArrow(run, "cell int, bits bigint").groupBy("cell").agg(F.bit_or("bits").alias("bits")).collect()
    out = np.zeros(1 << (BITS - 6), np.uint64)
    out[[r["cell"] for r in rows]] = np.array([r["bits"] for r in rows], np.int64).view(np.uint64)
    return out


# --- the sorted streams ------------------------------------------------------------------


def beside(stream: DataFrame, key: Column, names: list[str], value: str = "n") -> DataFrame:
    """The rows with the ``value`` of the rows whose key is the first 1, 2 ... elements of theirs.

    ``names`` are the new columns, one a length. The rows are range-partitioned and sorted by
    (lang, key), so these rows come just before. A part of the sort may begin after them:
    it gets copies of at most ``len(names)`` rows. Every first part must be in the stream.
    """
    placed = materialize(
        stream.withColumn("_key", key).repartitionByRange("lang", "_key").withColumn("_part", F.spark_partition_id()), "phrase_stream"
    )
    # One row a part of the sort, and as many copies as a key has first parts.
    starts = placed.groupBy("_part").agg(F.min(F.struct("lang", "_key")).alias("first"))
    sizes = F.filter(F.sequence(F.lit(1), F.lit(len(names))), lambda m: m < F.size("first._key"))
    wanted = starts.select(F.col("_part").alias("_into"), F.col("first.lang").alias("lang"), "first._key", F.explode(sizes).alias("m"))
    wanted = wanted.select("_into", "lang", F.slice("_key", F.lit(1), F.col("m")).alias("_key"))
    copies = placed.join(F.broadcast(wanted), ["lang", "_key"]).filter(F.col("_part") < F.col("_into"))
    copies = copies.withColumn("_part", F.col("_into")).drop("_into").withColumn("_copy", F.lit(True))
    rows = placed.withColumn("_copy", F.lit(False)).unionByName(copies)
    before = Window.partitionBy("_part").orderBy("lang", "_key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = {
        name: F.last(F.when(F.size("_key") == m, F.col(value)), ignorenulls=True).over(before)
        for m, name in enumerate(names, start=1)
    }
    return rows.withColumns(seen).filter(~F.col("_copy")).drop("_key", "_part", "_copy")


def _exact(column: str) -> Column:
    return F.col(column).cast("decimal(19,0)")


def _cut(left: str, right: str, k: int) -> Column:
    """(score, k, l, r) of a cut; exact for counts up to 5e15."""
    return F.expr(
        f"struct((1000000BD * (cast(n as decimal(19,0)) * cast(n as decimal(19,0)))) div (cast({left} as decimal(19,0)) * cast({right} as decimal(19,0))) as score,"
        f" {k} as k, {left} as l, {right} as r)"
    )


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, share: tuple[int, int] = SHARE) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of 2 and 3 words of each language.

    A phrase stands at least ``least`` times; its score is the lowest over its cuts of
    1000000 * a * a / (l * r), rounded down, ties to the first cut. A phrase inside a longer
    one with at least ``share`` of its count goes, whether that stays or not. Rows with a NULL
    lang count as ``und``, NULL and empty texts have no words, rows that repeat a doc_id all
    count. Other columns are not read.
    """
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(_NO_LANG)).alias("lang"), F.col("text").cast("binary").alias("text"))
    words = materialize(phrase_counts(rows, 1), "words")
    totals = words.groupBy("lang").agg(F.sum("n").alias("total"))
    frequent = words.filter(F.col("n") >= least)
    pairs = materialize(phrase_counts(rows, 2, frequent, least), "phrases_2")
    triples = materialize(phrase_counts(rows, 3, pairs, least), "phrases_3")
    stream = frequent.unionByName(pairs).unionByName(triples).select("lang", F.split("phrase", " ").alias("words"), "n")
    stream = beside(stream, F.col("words"), ["first_1", "first_2"])
    stream = materialize(beside(stream, F.reverse("words"), ["last_1", "last_2"]), "phrases")
    longer = stream.filter(F.size("words") == 3)

    def held(part: Column, count: str) -> DataFrame:
        """Parts of longer phrases that these hold a share of: at most two a part."""
        return longer.filter(share[1] * _exact("n") >= share[0] * _exact(count)).select("lang", part.alias("words"))

    dropped = held(F.slice("words", 1, 2), "first_2").unionByName(held(F.slice("words", 2, 2), "last_2"))
    best = F.when(F.size("words") == 2, _cut("first_1", "last_1", 1)).otherwise(
        F.least(_cut("first_1", "last_2", 1), _cut("first_2", "last_1", 2))
    )
    kept = stream.filter(F.size("words") >= 2).join(dropped, ["lang", "words"], "left_anti")
    scored = kept.select("lang", F.array_join("words", " ").alias("phrase"), F.col("n").alias("a"), best.alias("best"))
    scored = scored.select("lang", "phrase", "a", "best.l", "best.r", "best.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order).cast("bigint")).filter(F.col("rank") <= top)
    # One row a language: small, and left to Spark's own size check.
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", F.col("total").alias("n"), "score")
