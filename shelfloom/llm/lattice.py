"""LM scoring by a subword lattice, beside a plain word model.

The lattice of a word has every way to spell it, after a word-start mark, with the pieces of
an existing vocabulary; bytes are pieces as well, so every word has one. A forward recursion
in log space adds the weights of all ways. Pieces never cross a blank, so a document's
probability is the product over its words and one end, and each distinct word of a batch is
computed once.

Piece weights start from the vocabulary's own scores: its order of merit, taken as ranks of
a Zipf law. One round of expectation over all training words, weighted by their counts, adapts
them: each task sums the expected uses of its words in the written table of counts, and one
sum a piece goes to the driver. The ``FREQUENT`` most frequent words are a bounded table that
is the map-side part of the count join: counts of all other words are joined by a shuffle.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfloom.llm.common import add_columns, long_of, texts_of, word_hashes
from shelfloom.sources.scratch import materialize

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
#: Most words in the bounded table of frequent ones.
FREQUENT = 1 << 17
#: Part of the weights that stays with the vocabulary's own scores.
PRIOR = 0.1
MARK = "▁".encode()
#: No word has a blank: this stands for the end of a document.
END = b" "
END_HASH = int(long_of(word_hashes([END]))[0])
_P = np.uint64(0x9E3779B97F4A7C15)
_TOP = np.uint64(44)
#: Bytes of words whose pieces are sought in one go: some 100 bytes of memory each, and it stays in the cache.
_CELLS = 1 << 17
#: Words above so many bytes are computed one at a time, in runs of so many starts.
_LONG = 4096
_CACHE = 300_000
#: Bytes of texts looked at in one go: words of equal length share the steps of the recursion.
_SLICE = 6 << 20
#: Words and bytes whose expected uses are taken in one go.
_WORDS, _BYTES = 50_000, 2_000_000


def read_vocabulary(path: str) -> tuple[list[bytes], np.ndarray]:
    """Pieces as bytes, without control pieces and those with an inner mark, and natural-log weights."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_proto=Path(path).read_bytes())
    scores: dict[bytes, float] = {}
    for i in range(model.get_piece_size()):
        if model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            continue
        if model.is_byte(i):
            piece = bytes([int(model.id_to_piece(i)[3:5], 16)])
            scores.setdefault(piece, -math.inf)
            continue
        piece = model.id_to_piece(i).encode()
        if MARK not in piece[1:]:
            scores[piece] = model.get_score(i)
    for byte in range(256):
        scores.setdefault(bytes([byte]), -math.inf)
    pieces = sorted(scores, key=lambda p: (-scores[p], p))
    weight = 1.0 / (np.arange(len(pieces)) + 3.0)
    return pieces, np.log(weight / weight.sum())


class Arc(NamedTuple):
    """Pieces of one size: their words' columns, numbers and weights; those of start s lie from bounds[s] to bounds[s + 1]."""

    row: np.ndarray
    piece: np.ndarray
    weight: np.ndarray
    bounds: list[int]


@dataclass
class Lattice:
    """Pieces by the hash of their bytes, and their natural-log weights."""

    hashes: np.ndarray
    weights: np.ndarray
    longest: int

    @classmethod
    def of(cls, pieces: list[bytes], weights: np.ndarray) -> Lattice:
        longest = max(map(len, pieces))
        powers = np.cumprod(np.full(longest, _P, np.uint64))
        hashed = np.array(
            [(np.frombuffer(p, np.uint8).astype(np.uint64) + np.uint64(1)) @ powers[: len(p)] for p in pieces], np.uint64
        )
        order = np.argsort(hashed)
        return cls(hashed[order], np.asarray(weights, np.float64)[order], longest)

    def _find(self, hashed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of ``hashed`` that hold the hash of a piece, in order, and which piece."""
        if not hasattr(self, "_first"):
            top = (self.hashes >> _TOP).astype(np.int64)
            self._first = np.searchsorted(top, np.arange(1 << 20)).astype(np.int32)
            self._maybe = np.bincount(top, minlength=1 << 20) > 0
            self._most = int(np.bincount(top).max())
        top = (hashed >> _TOP).ravel().view(np.int64)
        at = np.flatnonzero(self._maybe[top])
        wanted, piece = hashed.ravel()[at], self._first[top[at]]
        ok = self.hashes[piece] == wanted
        for _ in range(1, self._most):
            # Pieces with the same leading bits lie side by side.
            piece = np.where(ok, piece, np.minimum(piece + 1, len(self.hashes) - 1))
            ok |= self.hashes[piece] == wanted
        return at[ok], piece[ok]

    def arcs(self, text: np.ndarray) -> list[Arc]:
        """Pieces in (length, words) bytes: at m those of m + 1 bytes, ordered by their start."""
        length, n = text.shape
        value = text.astype(np.uint64) + np.uint64(1)
        hashed, power, out = np.zeros((length, n), np.uint64), _P, []
        for m in range(min(self.longest, length)):
            hashed = hashed[: length - m] + value[m:] * power
            power = np.uint64(int(power) * int(_P) % (1 << 64))
            place, piece = self._find(hashed)
            bounds = np.searchsorted(place, np.arange(length - m + 1) * n).tolist()
            out.append(Arc(place % n, piece, self.weights[piece], bounds))
        return out

    @staticmethod
    def forward(arcs: list[Arc], length: int, n: int) -> np.ndarray:
        """Natural log of the summed weights of all ways to each place, (length + 1, words)."""
        alpha = np.full((length + 1, n), -np.inf)
        alpha[0] = 0.0
        for end in range(1, length + 1):
            for m, arc in enumerate(arcs[:end]):
                start = end - m - 1
                i, j = arc.bounds[start], arc.bounds[start + 1]
                if i < j:
                    row = arc.row[i:j]
                    alpha[end, row] = np.logaddexp(alpha[end, row], alpha[start, row] + arc.weight[i:j])
        return alpha

    @staticmethod
    def backward(arcs: list[Arc], size: np.ndarray, length: int) -> np.ndarray:
        """The same from each place to the end of its word, which is at ``size``."""
        n = len(size)
        beta = np.full((length + 1, n), -np.inf)
        beta[size, np.arange(n)] = 0.0
        for start in range(length - 1, -1, -1):
            for m, arc in enumerate(arcs[: length - start]):
                i, j = arc.bounds[start], arc.bounds[start + 1]
                if i < j:
                    row = arc.row[i:j]
                    beta[start, row] = np.logaddexp(beta[start, row], beta[start + m + 1, row] + arc.weight[i:j])
        return beta

    @staticmethod
    def _groups(words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(places in ``words``, their sizes, bytes in columns) for words of similar size, in bounded parts.

        Shorter words are filled up with blanks, which lie behind their ends.
        """
        size = np.fromiter(map(len, words), np.int64, len(words))
        room = np.where(size <= 64, -(-size // 4) * 4, -(-size // 64) * 64)
        order = np.argsort(room, kind="stable")
        for group in np.split(order, np.flatnonzero(np.diff(room[order])) + 1):
            if len(group) == 0:
                continue
            length = int(room[group[0]])
            part = max(1, _CELLS // length)
            for i in range(0, len(group), part):
                own = group[i : i + part]
                text = np.frombuffer(b"".join(words[j].ljust(length) for j in own), np.uint8)
                yield own, size[own], np.ascontiguousarray(text.reshape(len(own), length).T)

    def _long(self, word: bytes) -> float:
        """Log marginal of one word of any size: pieces of a run of starts at a time, sums of the last places only."""
        ring = self.longest + 1
        sums = [-math.inf] * ring
        sums[0] = 0.0
        for begin in range(0, len(word), _LONG):
            window = np.frombuffer(word[begin : begin + _LONG + self.longest - 1], np.uint8)
            arcs = self.arcs(window[:, None])
            own = [a.bounds[min(_LONG, len(a.bounds) - 1)] for a in arcs]
            bounds = [np.diff(a.bounds[: _LONG + 1]) for a in arcs]
            start = np.concatenate([np.repeat(np.arange(len(b)), b) for b in bounds])
            bytes_ = np.repeat(np.arange(1, len(arcs) + 1), own)
            weight = np.concatenate([a.weight[:k] for a, k in zip(arcs, own, strict=True)])
            order = np.argsort(start, kind="stable")
            last, here = -1, 0.0
            for s, m, w in zip(start[order].tolist(), bytes_[order].tolist(), weight[order].tolist(), strict=True):
                if s != last:
                    # Every byte is a piece: each start comes once, and its slot is free again.
                    slot, last = (begin + s) % ring, s
                    here, sums[slot] = sums[slot], -math.inf
                slot = (begin + s + m) % ring
                old, new = sums[slot], here + w
                if old < new:
                    old, new = new, old
                sums[slot] = old + math.log1p(math.exp(new - old))
        return sums[len(word) % ring]

    def log_marginals(self, words: list[bytes]) -> np.ndarray:
        """Natural log of the summed weights of all ways to spell each word after its mark."""
        out = np.empty(len(words))
        marked = [MARK + w for w in words]
        long = [i for i, w in enumerate(marked) if len(w) > _LONG]
        for i in long:
            out[i], marked[i] = self._long(marked[i]), MARK
        done = out[long]
        for own, size, text in self._groups(marked):
            alpha = self.forward(self.arcs(text), *text.shape)
            out[own] = alpha[size, np.arange(len(own))]
        out[long] = done
        return out

    def expected(self, words: list[bytes], counts: np.ndarray) -> np.ndarray:
        """Expected number of uses of each piece when the words are spelled at random by weight.

        Words above ``_LONG`` bytes are spelled in parts of that size here: no piece crosses a cut.
        """
        total = np.zeros(len(self.hashes))
        marked = [MARK + w for w in words]
        times = np.repeat(counts, [-(-len(w) // _LONG) for w in marked])
        parts = [w[i : i + _LONG] for w in marked for i in range(0, len(w), _LONG)]
        for own, size, text in self._groups(parts):
            arcs = self.arcs(text)
            length, n = text.shape
            alpha, beta = self.forward(arcs, length, n), self.backward(arcs, size, length)
            whole = alpha[size, np.arange(n)]
            for m, arc in enumerate(arcs):
                start = np.repeat(np.arange(length - m), np.diff(arc.bounds))
                log_use = alpha[start, arc.row] + arc.weight + beta[start + m + 1, arc.row] - whole[arc.row]
                total += np.bincount(arc.piece, np.exp(log_use) * times[own][arc.row], len(total))
        return total

    def adapted(self, uses: np.ndarray) -> Lattice:
        """The lattice after one round in which the pieces had these expected uses."""
        if uses.sum() == 0:
            return self
        own = np.exp(self.weights)
        return Lattice(self.hashes, np.log((1 - PRIOR) * uses / uses.sum() + PRIOR * own / own.sum()), self.longest)


def lower_words(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().split()


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def out(counts: Counter) -> pa.RecordBatch:
        words = list(counts)
        columns = [pa.array(long_of(word_hashes(words))), pa.array(words, pa.binary()), pa.array(list(counts.values()), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["hash", "word", "n"])

    counts: Counter = Counter()
    for batch in batches:
        for text in texts_of(batch, "text"):
            counts.update(lower_words(text))
            counts[END] += 1
            if len(counts) > 400_000:
                yield out(counts)
                counts = Counter()
    if counts:
        yield out(counts)


def _uses(lattice: Lattice):
    """Per task: (piece, uses), the expected uses of each piece in all its words but the end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(lattice.hashes))
        words: list[bytes] = []
        counts: list[int] = []
        held = 0
        for batch in batches:
            for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if word == END:
                    continue
                words.append(word), counts.append(n)
                held += len(word)
                if len(words) >= _WORDS or held >= _BYTES:
                    total += lattice.expected(words, np.array(counts, np.float64))
                    words, counts, held = [], [], 0
        if words:
            total += lattice.expected(words, np.array(counts, np.float64))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], ["piece", "uses"])

    return run


def expected_uses(counts: DataFrame, lattice: Lattice) -> np.ndarray:
    """Expected uses of each piece over the whole table of words; at most a row a piece reaches the driver."""
    each = counts.select("word", "n").mapInArrow(_uses(lattice), "piece int, uses double")
    total = np.zeros(len(lattice.hashes))
    for row in each.groupBy("piece").agg(F.sum("uses").alias("uses")).collect():
        total[row["piece"]] = row["uses"]
    return total


@dataclass
class Trained:
    """What scoring needs: the table of all counts, its totals, the frequent words, the lattice."""

    counts: DataFrame
    tokens: int
    distinct: int
    frequent: dict[str, np.ndarray]
    lattice: Lattice
    log_end: float
    log_word: float


def train(texts: DataFrame, vocabulary: str = VOCABULARY, frequent: int = FREQUENT) -> Trained:
    """Counts of all lower-cased words of all rows, with one end a row; NULL counts as empty."""
    counts = texts.select(F.col("text").cast("binary").alias("text")).mapInArrow(_counted, "hash bigint, word binary, n bigint")
    counts = materialize(counts.groupBy("hash", "word").agg(F.sum("n").alias("n")), "word_counts")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    # The least count whose words, and those above, are few enough: from counts of counts in some 500 steps.
    steps = F.floor(F.log2("n") * 8).cast("int")
    least, seen = None, 0
    for row in sorted(counts.groupBy(steps.alias("step")).agg(F.count("*").alias("words")).collect(), reverse=True):
        seen += row["words"]
        if seen > frequent:
            break
        least = row["step"]
    # Of the frequent words only 16 bytes each reach the driver, however long they are.
    rows = sorted(counts.filter(steps >= least).select("hash", "n").collect()) if least is not None else []
    ends = counts.filter(F.col("word") == F.lit(END)).agg(F.sum("n")).first()[0] or 0
    lattice = Lattice.of(*read_vocabulary(vocabulary))
    lattice = lattice.adapted(expected_uses(counts, lattice))
    part = (ends + 1) / (total[0] + 2)
    table = {"hash": np.array([h for h, _ in rows], np.int64), "n": np.array([n for _, n in rows], np.int64)}
    return Trained(counts.select("hash", "n"), total[0], total[1], table, lattice, math.log10(part), math.log10(1 - part))


def _first_look(frequent: dict[str, np.ndarray], lattice: Lattice, log_end: float, log_word: float):
    """Per text: tokens, sums over frequent ones, the lattice's score, and the other words with their numbers."""

    def make():
        table = dict(zip(frequent["hash"].tolist(), frequent["n"].tolist(), strict=True))
        # Of each word: what it adds to the score, its hash and, if it is frequent, what it adds to the base.
        looked: dict[bytes, tuple[float, int, float | None]] = {}

        def cells(batch: pa.RecordBatch) -> list:
            out: list[list] = [[], [], [], [], [], []]
            texts = [Counter(lower_words(t)) for t in texts_of(batch, "_text")]
            if len(looked) > _CACHE:
                # The frequent words stay: there are at most as many as their table has.
                for word in [w for w, (_, _, base) in looked.items() if base is None]:
                    del looked[word]
            new = list(set().union(*texts) - looked.keys())
            hashes = long_of(word_hashes(new)).tolist()
            marginals = (lattice.log_marginals(new) / math.log(10) + log_word).tolist()
            bases = [None if (c := table.get(h)) is None else math.log10(c + 1) for h in hashes]
            looked.update(zip(new, zip(marginals, hashes, bases, strict=True), strict=True))
            for words in texts:
                base, score, rare, times = 0.0, log_end, [], []
                for word, n in words.items():
                    part, h, own = looked[word]
                    score += n * part
                    if own is None:
                        rare.append(h), times.append(n)
                    else:
                        base += n * own
                number = words.total()
                known = number - sum(times)
                end = table.get(END_HASH)
                if end is None:
                    rare.append(END_HASH), times.append(1)
                else:
                    known += 1
                    base += math.log10(end + 1)
                for column, value in zip(out, (number + 1, known, base, score, rare, times), strict=True):
                    column.append(value)
            return out

        return cells

    return make


def scores(docs: DataFrame, model: Trained, held_out: Column | None = None) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    base_score: sum over the tokens (words and one end) of log10((c + 1) / (N + V + 1)) with
    the token's training count c, all tokens N and distinct ones V. score: log10 of the
    probability of the text, summed over all segmentations of its words. NULL and empty texts
    have the end as their only token. Untrained (an empty training set), every count is 0
    and the vocabulary's own scores stand. Rows that repeat a doc_id are scored on their own.
    Each row of ``docs`` gives one row. Other columns are not read.
    """
    base = docs.select(
        "doc_id", (F.lit(False) if held_out is None else held_out).alias("held_out"),
        F.col("text").cast("binary").alias("_text"),
    )
    looked = add_columns(
        base, _first_look(model.frequent, model.lattice, model.log_end, model.log_word),
        "n_tokens bigint, known bigint, base double, score double, rare array<bigint>, times array<int>",
        keep=["doc_id", "held_out"], limit=_SLICE,
    )
    # The rows are written with their numbers, so these stay whichever tasks run again.
    looked = materialize(looked.withColumn("key", F.monotonically_increasing_id()), "first_look")
    rare = looked.select("key", F.explode(F.arrays_zip("rare", "times")).alias("x")).select(
        "key", F.col("x.rare").alias("hash"), F.col("x.times").alias("times")
    )
    found = rare.join(model.counts, "hash").groupBy("key").agg(
        F.sum("times").alias("more_known"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("more_base")
    )
    below = math.log10(model.tokens + model.distinct + 1)
    known = F.col("known") + F.coalesce("more_known", F.lit(0).cast("bigint"))
    total = F.col("base") + F.coalesce("more_base", F.lit(0.0)) - F.col("n_tokens") * below
    return looked.join(found, "key", "left").select(
        "doc_id", "held_out", "n_tokens", known.alias("n_known"), F.lit(model.tokens).cast("bigint").alias("train_tokens"),
        total.alias("base_score"), "score",
    )
