"""Substring dedup: seed with winnowed anchors, extend both ways, keep repeats over the threshold.

1. Each window of ``window`` words has an anchor: its run of ``k`` words with the least hash.
   Neighbouring windows mostly share theirs; windows with one anchor form a block, which
   reaches from the first word of its first window to the last word of its last, that is, as
   far to both sides as the anchor decides. One Python pass gives anchor, hash of the block
   and place, some two rows for every window length of text. The pass runs twice: first
   anchors are counted, then blocks join the anchors that occur more than once.
2. Blocks with equal anchor and equal words are extended over their whole reach at once: the
   first of them in document order stays, all others are repeats. Only counts and minima of
   equal blocks are needed, so a passage that a third of all documents share is one row.
3. An anchor with different blocks lies at the edge of a repeat. For the first block of each
   kind, every window is hashed on its own, and again the first of equal windows stays. A
   window that stands first anywhere stands in such a block, so nothing is missed.
4. Repeated windows of a document are merged into maximal spans, and the words of the spans
   are removed.

Two 64-bit hashes together, of anchor and block or of window and anchor, stand for the words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfloom.llm.common import RunHashes, gram_hashes, long_of, row_key, texts_of, word_hashes
from shelfloom.sources.scratch import materialize

WINDOW, K = 20, 6


def blocks_of(words: np.ndarray, window: int, k: int) -> tuple[np.ndarray, ...]:
    """(anchor hash, block hash, first window, number of windows) of each block of a text."""
    n = len(words) - window + 1
    if n <= 0:
        none = np.empty(0, np.int64)
        return none.view(np.uint64), none.view(np.uint64), none, none
    grams = gram_hashes(words, k)
    view = np.lib.stride_tricks.sliding_window_view(grams, window - k + 1)
    at = view.argmin(axis=1) + np.arange(n)
    first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    count = np.diff(np.append(first, n))
    run = RunHashes(words)
    return grams[at[first]], run(first, first + count - 1 + window), first, count


def _schema_batch(columns: list, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


#: Rows that leave a Python pass together.
_OUT = 1 << 17


def _passes(schema: pa.Schema, rows_of) -> object:
    """A pass over (key, text, more) that gives out the arrays of ``rows_of`` in bounded batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            keys = batch.column(0).to_pylist()
            more = [batch.column(i) for i in range(2, batch.num_columns)]
            for i, text in enumerate(texts_of(batch, "text")):
                made = rows_of(keys[i], text, *(m[i].as_py() for m in more))
                if made is not None and len(made[0]):
                    held.append(made)
                    size += len(made[0])
                if size >= _OUT:
                    yield _schema_batch([np.concatenate(c) for c in zip(*held, strict=True)], schema)
                    held, size = [], 0
        if held:
            yield _schema_batch([np.concatenate(c) for c in zip(*held, strict=True)], schema)

    return run


def _blocks(texts: DataFrame, window: int, k: int) -> DataFrame:
    schema = pa.schema([("anchor", pa.int64()), ("block", pa.int64()), ("key", pa.int64()), ("start", pa.int32()), ("n", pa.int16())])

    def rows(key: int, text: bytes | None) -> tuple | None:
        words = word_hashes((text or b"").split())
        if len(words) < window:
            return None
        anchor, block, first, count = blocks_of(words, window, k)
        return long_of(anchor), long_of(block), np.full(len(first), key), first.astype(np.int32), count.astype(np.int16)

    return texts.mapInArrow(_passes(schema, rows), "anchor bigint, block bigint, key bigint, start int, n smallint")


def _windows(texts: DataFrame, window: int, k: int) -> DataFrame:
    """Every window of the blocks listed in ``blocks`` (arrays of start and number)."""
    schema = pa.schema([("anchor", pa.int64()), ("hash", pa.int64()), ("key", pa.int64()), ("start", pa.int32())])

    def rows(key: int, text: bytes | None, blocks: list) -> tuple:
        words = word_hashes((text or b"").split())
        grams, run = gram_hashes(words, k), RunHashes(words)
        starts = np.concatenate([np.arange(b["start"], b["start"] + b["n"]) for b in blocks])
        # The anchor once more: equal windows have equal anchors.
        view = np.lib.stride_tricks.sliding_window_view(grams, window - k + 1)[starts]
        anchor = view.min(axis=1)
        return long_of(anchor), long_of(run(starts, starts + window)), np.full(len(starts), key), starts.astype(np.int32)

    return texts.mapInArrow(_passes(schema, rows), "anchor bigint, hash bigint, key bigint, start int")


def _later(rows: DataFrame, by: list[str]) -> tuple[DataFrame, DataFrame]:
    """(first places, rows that stand later) for rows that agree in ``by`` and occur more than once.

    Minima have partial results before the shuffle; the join is one that Spark can split.
    """
    firsts = rows.groupBy(*by).agg(F.min(F.struct("key", "start")).alias("first"), F.count("*").alias("copies"))
    return firsts, rows.join(firsts.filter("copies > 1"), by).filter(F.struct("key", "start") > F.col("first"))


def repeats(docs: DataFrame, window: int = WINDOW, k: int = K) -> DataFrame:
    """(key, start, end, first_key, first_start): runs of words that stand earlier as well.

    Each row covers windows of ``key`` whose words stand, as they are, at ``first_key`` and
    ``first_start``, in an earlier document (smaller doc_id) or earlier in the same one.
    Rows of one document may overlap.
    """
    texts = docs.select(row_key().alias("key"), F.col("text").cast("binary").alias("text"))
    found = _blocks(texts, window, k)
    repeated = found.groupBy("anchor").agg(F.count("*").alias("_n")).filter("_n > 1").select("anchor")
    seeds = materialize(found.join(repeated, "anchor", "left_semi"), "seeds")
    firsts, later = _later(seeds, ["anchor", "block"])
    whole = later.select(
        "key", "start", (F.col("start") + F.col("n") + window - 1).alias("end"),
        F.col("first.key").alias("first_key"), F.col("first.start").alias("first_start"),
    )
    # Anchors whose blocks differ, and the first block of each kind.
    firsts = materialize(
        seeds.groupBy("anchor", "block").agg(F.min(F.struct("key", "start", "n")).alias("first")), "first_blocks"
    )
    edges = firsts.groupBy("anchor").agg(F.count("*").alias("_n")).filter("_n > 1").select("anchor")
    listed = (
        firsts.join(edges, "anchor", "left_semi")
        .groupBy(F.col("first.key").alias("key"))
        .agg(F.collect_list(F.struct("first.start", "first.n")).alias("blocks"))
    )
    at_edges = materialize(_windows(texts.join(listed, "key"), window, k), "windows")
    _, later = _later(at_edges, ["anchor", "hash"])
    single = later.select(
        "key", "start", (F.col("start") + window).alias("end"),
        F.col("first.key").alias("first_key"), F.col("first.start").alias("first_start"),
    )
    return whole.unionByName(single)


def without_repeats(docs: DataFrame, window: int = WINDOW, k: int = K) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_text.

    A word goes if any window over it has its exact words at an earlier place; places are
    those of the input. kept_text is the other words, joined by one blank. NULL and empty
    texts have no words and an empty kept_text. Texts shorter than a window lose nothing.
    Rows that repeat a doc_id are one place: neither is earlier than the other, and with
    different texts each loses the spans of both. A row without doc_id stands after all
    others; such rows are told apart and ordered by their texts. Each row of ``docs`` gives
    one row. Other columns are not read.
    """
    key = row_key().alias("key")
    texts = docs.select(key, "doc_id", F.col("text").cast("binary").alias("text"))
    # The runs of a document are bounded by its words.
    runs = repeats(docs, window, k).groupBy("key").agg(F.collect_list(F.struct("start", "end")).alias("runs"))
    marked = texts.join(runs, "key", "left").select("doc_id", "text", "runs")
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, removed, kept = [], [], []
            for text, gone in zip(texts_of(batch, "text"), batch["runs"], strict=True):
                words = (text or b"").split()
                total.append(len(words))
                if gone.is_valid:
                    # Where runs begin and end; a word is in a span while more have begun than ended.
                    runs = gone.values.flatten()
                    steps = np.bincount(runs[0], minlength=len(words) + 1) - np.bincount(runs[1], minlength=len(words) + 1)
                    words = [w for w, inside in zip(words, np.cumsum(steps[: len(words)]).tolist(), strict=True) if not inside]
                removed.append(total[-1] - len(words))
                kept.append(b" ".join(words).decode("utf-8", "surrogatepass"))
            yield _schema_batch([batch["doc_id"].to_pylist(), total, removed, kept], schema)

    return marked.mapInArrow(run, "doc_id bigint, n_words bigint, n_removed bigint, kept_text string")
