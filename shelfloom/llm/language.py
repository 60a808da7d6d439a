"""Language ID: a bidirectional GRU over bytes, trained here by backpropagation through time.

The network reads the bytes of a blank-delimited word, with a blank on each side, labels
every position with a distribution over the languages, and the distributions of all
positions of a text are averaged. The state starts anew at each word (a run of more than
``PIECE`` bytes is read in pieces), so a word's positions have the same labels wherever it
stands: each distinct word of a batch is read once and counted as often as it occurs. The
whole text is read that way, at a cost that falls with repetition.

Training takes a bounded sample of labelled rows of each language: all rows of a language with
up to ``TRAIN_ROWS``, else about so many, those with hashes below a threshold. Their words are counted by language on the executors, and of these
counts the ``TRAIN_WORDS`` most frequent per language go to the driver.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfloom.llm.common import add_columns, free_name, letters, texts_of

#: Rows (about) and words per language that training sees at most; bytes of a word read in one go.
TRAIN_ROWS, TRAIN_WORDS, PIECE = 4000, 3000, 30
HIDDEN, EMBED, EPOCHS, BATCH, RATE = 16, 12, 6, 256, 0.01
UNKNOWN = "und"
#: Distinct words that a task keeps the labels of.
_CACHE = 200_000


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-x))


def _padded(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, mask), each (longest, words); a blank stands before and after each word."""
    size = np.fromiter(map(len, words), np.int64, len(words)) + 2
    out = np.full((len(words), int(size.max())), 32, np.uint8)
    for i, word in enumerate(words):
        out[i, 1 : 1 + len(word)] = np.frombuffer(word, np.uint8)
    mask = np.arange(out.shape[1])[None, :] < size[:, None]
    return np.ascontiguousarray(out.T), np.ascontiguousarray(mask.T).astype(np.float32)


@dataclass
class ByteTagger:
    """Weights by name. Each direction has its own gates: update, reset, candidate."""

    languages: list[str]
    weights: dict[str, np.ndarray]

    @classmethod
    def fresh(cls, languages: list[str], seed: int = 3) -> ByteTagger:
        random = np.random.default_rng(seed)
        weights = {"embed": random.normal(0, 0.3, (256, EMBED))}
        for way in ("f", "b"):
            weights[f"in_{way}"] = random.normal(0, EMBED**-0.5, (EMBED, 3 * HIDDEN))
            weights[f"state_{way}"] = random.normal(0, HIDDEN**-0.5, (HIDDEN, 3 * HIDDEN))
            weights[f"bias_{way}"] = np.zeros(3 * HIDDEN)
        weights["out"] = random.normal(0, 0.1, (2 * HIDDEN, len(languages)))
        weights["out_bias"] = np.zeros(len(languages))
        return cls(languages, {k: v.astype(np.float32) for k, v in weights.items()})

    def _run(self, way: str, text: np.ndarray, mask: np.ndarray, trace: list | None) -> np.ndarray:
        """States after each position in reading direction; padding leaves the state as it is."""
        w = self.weights
        table = w["embed"] @ w[f"in_{way}"] + w[f"bias_{way}"]
        state = np.zeros((text.shape[1], HIDDEN), np.float32)
        states = np.empty((*text.shape, HIDDEN), np.float32)
        gates, candidate = w[f"state_{way}"][:, : 2 * HIDDEN], w[f"state_{way}"][:, 2 * HIDDEN :]
        for t in range(len(text)) if way == "f" else range(len(text) - 1, -1, -1):
            given = table[text[t]]
            both = _sigmoid(given[:, : 2 * HIDDEN] + state @ gates)
            update, reset = both[:, :HIDDEN], both[:, HIDDEN:]
            new = np.tanh(given[:, 2 * HIDDEN :] + (reset * state) @ candidate)
            step = update * mask[t][:, None]
            if trace is not None:
                trace.append((t, state, update, reset, new))
            state = state + step * (new - state)
            states[t] = state
        return states

    def positions(self, text: np.ndarray, mask: np.ndarray, traces: dict | None = None) -> np.ndarray:
        """Distribution over the languages at every position: (longest, words, languages)."""
        both = [self._run(way, text, mask, None if traces is None else traces.setdefault(way, [])) for way in ("f", "b")]
        states = np.concatenate(both, axis=2)
        if traces is not None:
            traces["states"] = states
        scores = states @ self.weights["out"] + self.weights["out_bias"]
        scores = np.exp(scores - scores.max(axis=2, keepdims=True))
        return scores / scores.sum(axis=2, keepdims=True)

    def gradients(self, text: np.ndarray, mask: np.ndarray, label: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross-entropy of all positions, by backpropagation through time."""
        w, traces = self.weights, {}
        off = self.positions(text, mask, traces)
        off[:, np.arange(text.shape[1]), label] -= 1.0
        off *= (mask / mask.sum())[:, :, None]
        grads = {k: np.zeros_like(v) for k, v in w.items()}
        states = traces["states"]
        grads["out"] = np.einsum("tbh,tbl->hl", states, off, optimize=True)
        grads["out_bias"] = off.sum(axis=(0, 1))
        into = off @ w["out"].T
        for way, part in (("f", slice(0, HIDDEN)), ("b", slice(HIDDEN, 2 * HIDDEN))):
            gates, candidate = w[f"state_{way}"][:, : 2 * HIDDEN], w[f"state_{way}"][:, 2 * HIDDEN :]
            table = np.zeros((256, 3 * HIDDEN), np.float32)
            back = np.zeros((text.shape[1], HIDDEN), np.float32)
            for t, state, update, reset, new in reversed(traces[way]):
                back = back + into[t][:, part]
                step = update * mask[t][:, None]
                d_new = back * step * (1 - new * new)
                d_update = back * (new - state) * mask[t][:, None] * update * (1 - update)
                through = d_new @ candidate.T
                d_reset = through * state * reset * (1 - reset)
                d_gates = np.concatenate([d_update, d_reset], axis=1)
                grads[f"state_{way}"][:, : 2 * HIDDEN] += state.T @ d_gates
                grads[f"state_{way}"][:, 2 * HIDDEN :] += (reset * state).T @ d_new
                np.add.at(table, text[t], np.concatenate([d_gates, d_new], axis=1))
                back = back * (1 - step) + through * reset + d_gates @ gates.T
            grads[f"in_{way}"] = w["embed"].T @ table
            grads["embed"] += table @ w[f"in_{way}"].T
            grads[f"bias_{way}"] = table.sum(axis=0)
        return grads

    def train(self, words: list[bytes], label: np.ndarray, seed: int = 3) -> None:
        """Adam over shuffled batches; words of like length share a batch."""
        random = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        size = np.fromiter(map(len, words), np.int64, len(words))
        step = 0
        total = EPOCHS * -(-len(words) // BATCH)
        for _ in range(EPOCHS):
            order = np.lexsort((random.random(len(words)), size))
            batches = [order[i : i + BATCH] for i in range(0, len(order), BATCH)]
            random.shuffle(batches)
            for batch in batches:
                step += 1
                text, mask = _padded([words[i] for i in batch])
                rate = RATE * (1 - step / (total + 1))
                for name, grad in self.gradients(text, mask, label[batch]).items():
                    first[name] += 0.1 * (grad - first[name])
                    second[name] += 0.001 * (grad * grad - second[name])
                    grown = second[name] / (1 - 0.999**step)
                    self.weights[name] -= rate * first[name] / (1 - 0.9**step) / (np.sqrt(grown) + 1e-8)

    def word_sums(self, words: list[bytes]) -> np.ndarray:
        """Sum of the distributions of each word's positions; the last column counts the positions."""
        out = np.empty((len(words), len(self.languages) + 1))
        size = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(size, kind="stable")
        for start in range(0, len(order), 4096):
            batch = order[start : start + 4096]
            text, mask = _padded([words[i] for i in batch])
            out[batch, :-1] = (self.positions(text, mask) * mask[:, :, None]).sum(axis=0)
            out[batch, -1] = mask.sum(axis=0)
        return out


def pieces(text: bytes) -> Iterator[bytes]:
    """Words between ASCII blanks; long ones in pieces."""
    for word in text.split():
        if len(word) <= PIECE:
            yield word
        else:
            yield from (word[i : i + PIECE] for i in range(0, len(word), PIECE))


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()

    def counted() -> pa.RecordBatch:
        rows = list(counts.items())
        counts.clear()
        columns = [pa.array([k[0] for k, _ in rows], pa.string()), pa.array([k[1] for k, _ in rows], pa.binary()), pa.array([n for _, n in rows], pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["lang", "word", "n"])

    for batch in batches:
        for lang, text in zip(batch["lang"].to_pylist(), texts_of(batch, "text"), strict=True):
            counts.update((lang, word) for word in pieces(text or b""))
            if len(counts) > _CACHE // 4:
                yield counted()
    if counts:
        yield counted()


def train_tagger(labelled: DataFrame, rows: int = TRAIN_ROWS, words: int = TRAIN_WORDS, seed: int = 3) -> ByteTagger | None:
    """A tagger for the languages of the labelled rows, or None if no row has a language and a word.

    ``labelled`` has doc_id, lang and text; rows with a NULL lang or text are not used. The
    sample is taken within each language, all of up to ``rows`` rows or about ``rows`` of more
    by their hashes, so no language is missed however rare; it is the same in every run.
    """
    used = labelled.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    # One row a language: few enough to be broadcast beside the texts.
    sizes = used.groupBy(F.col("lang").alias("_lang")).agg(F.count("*").alias("_rows"))
    place = F.pmod(F.xxhash64(F.lit(seed), "doc_id", "lang", "text"), F.lit(1 << 40)) / F.lit(1 << 40)
    chosen = used.join(F.broadcast(sizes), F.col("lang") == F.col("_lang")).filter(place * F.col("_rows") < rows)
    counts = chosen.select("lang", F.col("text").cast("binary").alias("text")).mapInArrow(_word_counts, "lang string, word binary, n bigint")
    by_count = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    found = (
        counts.groupBy("lang", "word").agg(F.sum("n").alias("n"))
        .withColumn("rank", F.row_number().over(by_count)).filter(F.col("rank") <= words)
        .orderBy("lang", "rank").collect()
    )
    if not found:
        return None
    languages = sorted({r["lang"] for r in found})
    tagger = ByteTagger.fresh(languages, seed)
    # A word that several languages share is seen with each, by the roots of its counts.
    text, label = [], []
    for r in found:
        times = min(8, max(1, round(r["n"] ** 0.5 / 2)))
        text += [bytes(r["word"])] * times
        label += [languages.index(r["lang"])] * times
    tagger.train(text, np.array(label), seed)
    return tagger


def _labeller(tagger: ByteTagger, lettered: str) -> Callable[[], Callable]:
    def make() -> Callable:
        place: dict[bytes, int] = {}
        sums_of = np.empty((0, len(tagger.languages) + 1))

        def cells(batch: pa.RecordBatch) -> list:
            nonlocal sums_of
            counts = [Counter(pieces(text)) if ok and text else None for text, ok in zip(texts_of(batch, "text"), batch[lettered].to_pylist(), strict=True)]
            if len(place) > _CACHE:
                place.clear()
                sums_of = sums_of[:0]
            new = [w for w in dict.fromkeys(w for c in counts if c for w in c) if w not in place]
            if new:
                place.update(zip(new, range(len(place), len(place) + len(new)), strict=True))
                sums_of = np.concatenate([sums_of, tagger.word_sums(new)])
            names, scores = [], []
            for own in counts:
                if not own:
                    names.append(UNKNOWN), scores.append(0.0)
                    continue
                at = np.fromiter(map(place.__getitem__, own), np.int64, len(own))
                sums = np.fromiter(own.values(), np.float64, len(own)) @ sums_of[at]
                best = int(sums[:-1].argmax())
                names.append(tagger.languages[best])
                scores.append(float(min(1.0, sums[best] / sums[-1])))
            return [names, scores]

        return cells

    return make


def tag_languages(docs: DataFrame, tagger: ByteTagger | None, lang: str = "lang_pred", score: str = "lang_score") -> DataFrame:
    """The rows of ``docs`` with a predicted language and the averaged probability of it.

    Only the text is read. A text that is NULL, empty or without a letter of any script gets
    ``und`` and 0.0, and so do all texts if there is no tagger. Equal texts get equal results.
    Rows stay in place, repeated ones too; all columns are kept, and an added name that is
    taken gets underscores at its end.
    """
    lang, score = free_name(docs, lang), free_name(docs, score)
    if tagger is None:
        return docs.withColumns({lang: F.lit(UNKNOWN), score: F.lit(0.0)})
    lettered = free_name(docs, "_letters")
    helped = docs.withColumn(lettered, letters(F.col("text")))
    return add_columns(helped, _labeller(tagger, lettered), f"`{lang}` string, `{score}` double", keep=docs.columns)


def fold(id_column: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a NULL id counts as the empty text."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit(""))) % folds
