"""Quality classifier by importance resampling.

Two generative models over hashed word unigrams and bigrams, one of good texts and one of
all texts, give each document a log ratio of probabilities per feature. A weight grows with
that ratio; adding Gumbel noise and taking the greatest is sampling by weight without
replacement. The noise comes from a hash of the id, so reruns agree.

The model of all texts counts every feature of every document. That of good texts counts
those of a bounded sample of labelled rows: the ``TARGET_ROWS`` with the least hashes. Both
are sums over ``BUCKETS`` buckets, whatever the input.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfloom.llm.common import add_columns, gram_hashes, texts_of, word_hashes
from shelfloom.sources.scratch import materialize

TARGET_ROWS, BUCKETS = 20_000, 1 << 14
#: Features that a text's mean log ratio is taken to stand for, whatever its length.
STRENGTH = 50.0
_BINS = 4096


def features(text: bytes | None) -> np.ndarray:
    """Buckets of the words and word pairs of the lower-cased text."""
    words = word_hashes((text or b"").lower().split())
    both = np.concatenate([gram_hashes(words, 1), gram_hashes(words, 2)])
    return (both >> np.uint64(50)).astype(np.int64)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros((2, BUCKETS), np.int64)
    for batch in batches:
        for good, text in zip(batch["good"].to_pylist(), texts_of(batch, "text"), strict=True):
            own = np.bincount(features(text), minlength=BUCKETS)
            counts[0] += own
            if good:
                counts[1] += own
    used = np.flatnonzero(counts[0])
    columns = [pa.array(used), pa.array(counts[0, used]), pa.array(counts[1, used])]
    yield pa.RecordBatch.from_arrays(columns, ["bucket", "raw", "target"])


def log_ratios(docs: DataFrame, good: DataFrame, rows: int = TARGET_ROWS) -> np.ndarray:
    """Log of target over raw probability for every bucket. ``good`` has the doc_ids of good texts."""
    least = good.select("doc_id").filter("doc_id IS NOT NULL").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    # ``rows`` ids at most: few enough to be broadcast beside the texts.
    marked = docs.select("doc_id", F.col("text").cast("binary").alias("text")).join(
        F.broadcast(least.withColumn("_good", F.lit(True))), "doc_id", "left"
    )
    sums = marked.select(F.coalesce("_good", F.lit(False)).alias("good"), "text").mapInArrow(_sums, "bucket bigint, raw bigint, target bigint")
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for row in sums.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect():
        raw[row["bucket"]], target[row["bucket"]] = row["raw"], row["target"]
    # Without good texts the models are the same.
    target = target if target.sum() else raw
    return np.log((target + 1) / (target.sum() + BUCKETS)) - np.log((raw + 1) / (raw.sum() + BUCKETS))


def _scorer(ratios: np.ndarray):
    def make():
        def cells(batch: pa.RecordBatch) -> list:
            out = []
            for text in texts_of(batch, "_text"):
                own = features(text)
                out.append(float(ratios[own].mean()) if len(own) else None)
            return [out]

        return cells

    return make


def _unit(hashed: Column) -> Column:
    """52 bits of a hash as a number between 0 and 1, neither included."""
    return (hashed.bitwiseAND(F.lit((1 << 52) - 1)) + 0.5) / float(1 << 52)


def _kth_greatest(rows: DataFrame, k: int) -> tuple[float, int] | None:
    """The k-th greatest key, and how many keys are above it; from sums per bin of ever narrower ranges."""
    low, high, above = rows.agg(F.min("key"), F.max("key")).first(), None, 0
    if low[0] is None or k <= 0:
        return None
    low, high = low
    while low < high:
        step = (high - low) / _BINS
        number = F.least(F.floor((F.col("key") - low) / step), F.lit(_BINS - 1))
        bins = rows.filter(F.col("key").between(low, high)).groupBy(number.alias("bin")).agg(
            F.count("*").alias("n"), F.min("key").alias("low"), F.max("key").alias("high")
        ) if step > 0 else None
        if bins is None:
            break
        for row in sorted(bins.collect(), reverse=True):
            if above + row["n"] >= k:
                if (low, high) == (row["low"], row["high"]):
                    return high, above
                low, high = row["low"], row["high"]
                break
            above += row["n"]
        else:
            return low, above
    return high, above


def resample(docs: DataFrame, good: DataFrame, share: float = 0.8, seed: int = 11) -> DataFrame:
    """Per row: doc_id, log_ratio, score, gumbel_key, selected.

    log_ratio: mean log ratio of the text's features; score: the weight as a probability of
    being like good texts rather than like all, 0 to 1. selected: among the ``share`` of all
    rows with the greatest keys; keys that tie at the cut are taken by a hash of doc_id and
    text, and rows that agree in both share one verdict. The noise comes from the doc_id,
    for a NULL one from the text. Texts that are NULL, empty or without words
    have a NULL ratio, score 0.0 and are never selected. Repeated rows share their key. An
    empty table gives none; without good texts all ratios are 0. Other columns are not read.
    """
    ratios = log_ratios(docs, good)
    noise = F.when(F.col("doc_id").isNull(), F.xxhash64(F.lit(seed), "text")).otherwise(F.xxhash64(F.lit(seed), "doc_id"))
    base = docs.select(
        "doc_id", F.col("text").cast("binary").alias("_text"), _unit(noise).alias("noise"),
        _unit(F.xxhash64(F.lit(seed + 1), "doc_id", "text")).alias("tie"),
    )
    scored = add_columns(base, _scorer(ratios), "log_ratio double", keep=["doc_id", "noise", "tie"])
    key = F.col("log_ratio") * STRENGTH - F.log(-F.log("noise"))
    scored = materialize(scored.withColumn("key", key), "resampled")
    found = scored.filter("key IS NOT NULL")
    wanted = int(share * scored.count())
    cut = _kth_greatest(found, wanted)
    if cut is None:
        chosen = F.lit(False)
    else:
        # Keys above the cut are all taken; of those at the cut as many as are still wanted.
        at_cut = found.filter(F.col("key") == F.lit(cut[0])).select(F.col("tie").alias("key"))
        last = _kth_greatest(at_cut, wanted - cut[1])
        tied = (F.col("key") == F.lit(cut[0])) & (F.lit(True) if last is None else F.col("tie") >= F.lit(last[0]))
        chosen = F.coalesce((F.col("key") > F.lit(cut[0])) | tied, F.lit(False))
    score = F.coalesce(1.0 / (1.0 + F.exp(-STRENGTH * F.col("log_ratio"))), F.lit(0.0))
    return scored.select("doc_id", "log_ratio", score.alias("score"), F.col("key").alias("gumbel_key"), chosen.alias("selected"))
