"""Near-duplicates by b-bit MinHash.

1. One Python pass gives each text the size and a 128-bit hash of its shingle set, the keys
   of its LSH bands and a packed signature: the low bits of every minimum, one bit plane
   after the other. Texts with equal sets form a class; only its first document goes on.
2. Band buckets give candidates. First every class is paired with the least and the greatest
   class of all its buckets. A candidate's similarity is estimated from bit counts of the xor
   of the packed signatures, corrected for chance collisions. Where the estimate is near the
   threshold or above, the full sets are compared.
3. Confirmed links give components. In a bucket whose members are all in one component,
   nothing is left to find. In the others, each member outside the bucket's main component
   is first paired with one member of that, and last with all members in other components.
   So no link that shares a bucket is lost, and groups of copies never become all pairs.
   The last step asks more, of these members alone: sets of at most ``WHOLE`` shingles are
   compared as they are, by 32 bits of each hash; of larger ones a finer sketch is asked: the
   low bits of the least hash in each of many bins, and which bins are used. A bucket is dealt
   in blocks, each of some of its members with all others.

The chance that a pair of similarity ``s`` shares no bucket is ``(1 - s**rows) ** bands``:
with 40 bands of 5 rows 1.3e-7 at 0.8. The estimate has a standard deviation of about 0.029
there; the margin of 0.15 is five of these. The finer one has at most 0.0105; its margin of
0.053 is five of these, too.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfloom.llm.common import NO_ID, add_columns, free_name, gram_hashes, long_of, mix, row_key, texts_of, word_hashes
from shelfloom.llm.components import components
from shelfloom.sources.scratch import materialize

BANDS, ROWS, BITS = 40, 5, 4
MARGIN = 0.15
#: Of the finer sketch: bins (2 to the power of) and low bits a bin.
FINE_LOG, FINE_BITS, FINE_MARGIN = 11, 2, 0.053
#: Sets up to this size are carried whole into the last step.
WHOLE = 512
#: Members of a bucket in one block of the last step.
BLOCK = 500
_CHUNK = 2048


def shingle_set(text: bytes | None, words: int) -> np.ndarray:
    """Sorted hashes of the distinct runs of ``words`` words, A-Z lower-cased.

    A text of fewer words has one shingle, the whole of it; one without words has none.
    """
    hashed = word_hashes((text or b"").lower().split())
    if len(hashed) == 0:
        return hashed
    return np.unique(gram_hashes(hashed, min(words, len(hashed))))


def _packed(low: np.ndarray) -> np.ndarray:
    """Bit planes of the low bits, each padded to whole 64-bit words."""
    planes = []
    for bit in range(BITS):
        plane = ((low >> np.uint64(bit)) & np.uint64(1)).astype(np.uint8)
        padded = np.zeros(-(-len(plane) // 64) * 64, np.uint8)
        padded[: len(plane)] = plane
        planes.append(np.packbits(padded, bitorder="little").view(np.uint64))
    return np.concatenate(planes)


def _signer(bands: int, rows: int, seed: int) -> Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]:
    random = np.random.default_rng(seed)
    factor = random.integers(1, 1 << 63, bands * rows, np.uint64) * np.uint64(2) + np.uint64(1)
    shift = random.integers(0, 1 << 63, bands * rows, np.uint64)
    place = mix(np.arange(1, bands + 1, dtype=np.uint64))

    def sign(shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        least = np.full(bands * rows, np.iinfo(np.uint64).max, np.uint64)
        for start in range(0, len(shingles), _CHUNK):
            hashed = shingles[start : start + _CHUNK, None] * factor
            hashed += shift
            np.minimum(least, hashed.min(axis=0), out=least)
        # The minima are small numbers; mixing gives them even low bits.
        least = mix(least)
        keys = place.copy()
        for row in range(rows):
            keys = mix(keys + least[row::rows] * np.uint64(2 * row + 1))
        return keys, _packed(least)

    return sign


def signatures(docs: DataFrame, words: int, bands: int, rows: int, seed: int) -> DataFrame:
    """(key, doc_id, n_shingles, set_a, set_b, keys, packed); keys and packed are NULL without shingles."""

    def make():
        sign = _signer(bands, rows, seed)

        def cells(batch: pa.RecordBatch) -> list:
            sizes, firsts, seconds, keys, packed = [], [], [], [], []
            for text in texts_of(batch, "text"):
                found = shingle_set(text, words)
                sizes.append(len(found))
                if len(found) == 0:
                    firsts.append(None), seconds.append(None), keys.append(None), packed.append(None)
                    continue
                firsts.append(int(long_of(mix(found).sum(keepdims=True, dtype=np.uint64))[0]))
                seconds.append(int(long_of(np.bitwise_xor.reduce(mix(found * np.uint64(0x9E6C63D0876A9A35)), keepdims=True))[0]))
                own_keys, own_bits = sign(found)
                keys.append(long_of(own_keys))
                packed.append(long_of(own_bits))
            return [sizes, firsts, seconds, keys, packed]

        return cells

    base = docs.select(row_key().alias("key"), F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return add_columns(
        base, make, "n_shingles bigint, set_a bigint, set_b bigint, keys array<bigint>, packed array<bigint>",
        keep=["key", "doc_id"],
    )


def estimated(packed_a: Column, packed_b: Column, minima: int) -> Column:
    """Similarity from two packed signatures: equal minima by bit count, less those equal by chance."""
    each = -(-minima // 64)
    different = F.lit(0)
    for word in range(each):
        unlike = F.lit(0).cast("bigint")
        for bit in range(BITS):
            i = F.lit(bit * each + word)
            unlike = unlike.bitwiseOR(F.get(packed_a, i).bitwiseXOR(F.get(packed_b, i)))
        different = different + F.bit_count(unlike)
    equal = 1.0 - different / F.lit(float(minima))
    chance = 0.5**BITS
    return (equal - chance) / (1.0 - chance)


def fine_sketch(shingles: np.ndarray) -> np.ndarray:
    """Bit planes over bins: which are used, and the low bits of the least hash in each."""
    hashed = np.sort(mix(shingles))
    bins = (hashed >> np.uint64(64 - FINE_LOG)).astype(np.int64)
    least = np.flatnonzero(np.diff(bins, prepend=-1))
    planes = np.zeros((1 + FINE_BITS, 1 << FINE_LOG), np.uint8)
    planes[0, bins[least]] = 1
    for bit in range(FINE_BITS):
        planes[1 + bit, bins[least]] = (hashed[least] >> np.uint64(bit)) & np.uint64(1)
    return np.packbits(planes, bitorder="little").view(np.uint64)


def fine_estimated(fine_a: Column, fine_b: Column) -> Column:
    """Similarity from two fine sketches: bins with equal minima among bins used, less those equal by chance."""
    words = (1 << FINE_LOG) // 64
    place = F.sequence(F.lit(0), F.lit(words - 1))

    def total(bits) -> Column:
        return F.aggregate(place, F.lit(0), lambda n, i: n + F.bit_count(bits(i)).cast("int"))

    def equal_bits(i: Column) -> Column:
        unlike = F.lit(0).cast("bigint")
        for plane in range(1, 1 + FINE_BITS):
            at = i + plane * words
            unlike = unlike.bitwiseOR(F.get(fine_a, at).bitwiseXOR(F.get(fine_b, at)))
        return F.get(fine_a, i).bitwiseAND(F.get(fine_b, i)).bitwiseAND(F.bitwise_not(unlike))

    used = total(lambda i: F.get(fine_a, i).bitwiseOR(F.get(fine_b, i)))
    both = total(lambda i: F.get(fine_a, i).bitwiseAND(F.get(fine_b, i)))
    chance = 0.5**FINE_BITS
    return (total(equal_bits) - chance * both) / (1.0 - chance) / used


def _fine_sketches(texts: DataFrame, words: int, per_hundred: int) -> DataFrame:
    """(node, whole, fine) for each row of (key, text) with a word.

    ``whole`` is NULL above ``WHOLE`` shingles. ``fine`` is NULL for sets so small that no
    set above ``WHOLE`` can be similar to them: two sets worth a look share one of the two.
    """

    def make():
        def cells(batch: pa.RecordBatch) -> list:
            whole, fine = [], []
            for text in texts_of(batch, "text"):
                found = shingle_set(text, words)
                short = np.unique((mix(found) >> np.uint64(32)).astype(np.uint32)).view(np.int32)
                whole.append(short if len(found) <= WHOLE else None)
                fine.append(long_of(fine_sketch(found)) if 100 * len(found) >= per_hundred * WHOLE else None)
            return [whole, fine]

        return cells

    return add_columns(texts, make, "whole array<int>, fine array<bigint>", keep=["key"]).withColumnRenamed("key", "node")


def _close(per_hundred: int) -> Column:
    """Whether the sets may be similar enough, by what ``_fine_sketches`` gave.

    One more than the shared 32-bit hashes: two shingles of one set may have equal ones.
    """
    shared = F.size(F.array_intersect("whole_a", "whole_b")) + 1
    by_sets = 100 * shared >= per_hundred * (F.col("n_a") + F.col("n_b") - shared)
    by_sketch = fine_estimated(F.col("fine_a"), F.col("fine_b")) >= per_hundred / 100 - FINE_MARGIN
    return F.when(F.col("whole_a").isNotNull() & F.col("whole_b").isNotNull(), by_sets).otherwise(by_sketch)


def _confirm(pairs: DataFrame, texts: DataFrame, words: int, per_hundred: int) -> DataFrame:
    """The pairs (a, b) of keys whose full sets are similar enough.

    Each side's text comes by a join of its own; Spark splits the parts of a class that is in
    many pairs. The sorted pairs of a partition let the set of ``a`` be kept for the next pair
    with the same key and text: a key has several texts where rows repeat a doc_id.
    """
    a = texts.select(F.col("key").alias("a"), F.col("text").alias("text_a"))
    b = texts.select(F.col("key").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(b, "b").join(a, "a").select("a", "b", "text_a", "text_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, own = (None, None), None
        for batch in batches:
            keep_a, keep_b = [], []
            rows = zip(batch["a"].to_pylist(), batch["b"].to_pylist(), texts_of(batch, "text_a"), texts_of(batch, "text_b"), strict=True)
            for key_a, key_b, text_a, text_b in rows:
                if (key_a, text_a) != last:
                    last, own = (key_a, text_a), shingle_set(text_a, words)
                other = shingle_set(text_b, words)
                shared = len(np.intersect1d(own, other, assume_unique=True))
                if shared and 100 * shared >= per_hundred * (len(own) + len(other) - shared):
                    keep_a.append(key_a), keep_b.append(key_b)
            yield pa.RecordBatch.from_arrays([pa.array(keep_a, pa.int64()), pa.array(keep_b, pa.int64())], ["a", "b"])

    return both.mapInArrow(run, "a bigint, b bigint")


def _worth_a_look(pairs: DataFrame, minima: int, per_hundred: int, last: Column | None = None) -> DataFrame:
    """Pairs whose sizes allow the similarity and whose estimate does not rule it out; ``last`` is asked after both."""
    sizes = 100 * F.least("n_a", "n_b") >= per_hundred * F.greatest("n_a", "n_b")
    near = estimated(F.col("packed_a"), F.col("packed_b"), minima) >= per_hundred / 100 - MARGIN
    return pairs.filter(sizes & near if last is None else sizes & near & last).select("a", "b")


def _first_shared(bucket: str, keys_a: str, keys_b: str) -> Column:
    """Whether ``bucket`` is the first key that two signatures share, band by band."""
    return F.get(F.array_intersect(keys_a, keys_b), F.lit(0)) == F.col(bucket)


def near_duplicates(
    docs: DataFrame,
    words: int = 5,
    per_hundred: int = 80,
    bands: int = BANDS,
    rows: int = ROWS,
    seed: int = 5,
) -> DataFrame:
    """Per document: key, doc_id, n_shingles, component_id, kept.

    Documents whose sets of ``words``-word shingles have ``100 * shared >= per_hundred *
    together`` are linked; a component is what links reach. component_id is its smallest
    doc_id and kept says whether the row has that id. NULL and empty texts, and texts of
    blanks, have no shingles and are linked with nothing. Rows that repeat a doc_id share a
    key; with the same text they are one node and get the same verdict, with different texts
    their links are joined. A NULL doc_id stands after all others and is told apart by its
    text; in a group of such rows alone component_id is NULL and the row with the least key
    is kept. Each row of ``docs`` gives one row; an empty table gives none. Other columns are
    not read.
    """
    minima = bands * rows
    signed = materialize(signatures(docs, words, bands, rows, seed), "minhash")
    full = signed.filter("n_shingles > 0")
    # One node per distinct set: the copies of a text are never compared.
    same = ["set_a", "set_b", "n_shingles"]
    classes = full.groupBy(*same).agg(F.min("key").alias("node"))
    first = materialize(
        full.groupBy(*same).agg(F.min(F.struct("key", "packed", "keys")).alias("m")).select(
            F.col("m.key").alias("node"), "n_shingles", F.col("m.packed").alias("packed"), F.col("m.keys").alias("keys")
        ),
        "classes",
    )
    # Signatures stay behind: only (node, bucket) is dealt by bucket, and joined back for pairs.
    members = first.select("node", F.explode("keys").alias("bucket"))
    # Buckets of one class have no pair; they are most, and leave here.
    buckets = (
        members.groupBy("bucket")
        .agg(F.min("node").alias("low"), F.max("node").alias("high"))
        .filter("low < high")
    )
    shared = materialize(members.join(materialize(buckets, "buckets"), "bucket"), "members")
    # Only texts that share a bucket are ever compared: all texts are shuffled once.
    wanted = shared.select(F.col("node").alias("key")).distinct()
    texts = docs.select(row_key().alias("key"), F.col("text").cast("binary").alias("text"))
    texts = materialize(texts.join(wanted, "key", "left_semi").dropDuplicates(["key", "text"]), "texts")
    sign = first.select("node", "n_shingles", "packed")
    a = sign.select(F.col("node").alias("a"), F.col("n_shingles").alias("n_a"), F.col("packed").alias("packed_a"))
    b = sign.select(F.col("node").alias("b"), F.col("n_shingles").alias("n_b"), F.col("packed").alias("packed_b"))

    def ordered(pairs: DataFrame, x: str, y: str) -> DataFrame:
        return pairs.filter(F.col(x) != F.col(y)).select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).distinct()

    def labelled(nodes: DataFrame, labels: DataFrame) -> DataFrame:
        joined = nodes.join(labels.withColumnRenamed("node", "_n"), F.col("node") == F.col("_n"), "left")
        return joined.withColumn("label", F.coalesce("component", "node")).drop("_n", "component")

    def still_open(labels: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Members of buckets in several components, and those of them outside the main one."""
        named = materialize(labelled(shared.drop("low", "high"), labels), "named")
        mixed = (
            named.groupBy("bucket", "label")
            .agg(F.count("*").alias("n"))
            .groupBy("bucket")
            .agg(F.count("*").alias("labels"), F.sum("n").alias("size"), F.max_by("label", F.struct("n", "label")).alias("main"))
            .filter("labels > 1")
        )
        every = materialize(named.join(mixed.select("bucket", "main", "size"), "bucket"), "open")
        return every, every.filter("label <> main")

    # Each class with the least and the greatest of its buckets.
    ends = shared.groupBy("node").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    pairs = ordered(ends.select("node", F.explode(F.array("low", "high")).alias("other")), "node", "other")
    tried = materialize(_worth_a_look(pairs.join(a, "a").join(b, "b"), minima, per_hundred), "pairs")
    links = materialize(_confirm(tried, texts, words, per_hundred), "links")

    # Each member outside its bucket's main component with one inside.
    every, outside = still_open(materialize(components(links), "labels"))
    inside = every.filter("label = main").groupBy("bucket").agg(F.min_by("node", F.xxhash64(F.lit(seed), "node")).alias("other"))
    pairs = ordered(outside.select("bucket", "node").join(inside, "bucket"), "node", "other")
    worth = _worth_a_look(pairs.join(a, "a").join(b, "b"), minima, per_hundred).join(tried, ["a", "b"], "left_anti")
    worth = materialize(worth, "pairs")
    tried = tried.unionByName(worth)
    links = links.unionByName(materialize(_confirm(worth, texts, words, per_hundred), "links"))

    # What is still apart: pairs across components, once, unless a sketch rules them out.
    every, _ = still_open(materialize(components(links), "labels"))
    opened = every.select(F.col("node").alias("key")).distinct()
    fine = materialize(_fine_sketches(texts.join(opened, "key", "left_semi"), words, per_hundred), "fine")
    every = every.join(fine.join(first, "node"), "node")
    # Each block of a bucket meets all its members; work and not bytes is dealt, so the number of parts is set.
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    x = every.filter("label <> main").withColumn("block", F.pmod(F.xxhash64("node"), blocks).cast("int")).select(
        "bucket", "block", F.col("node").alias("a"), F.col("n_shingles").alias("n_a"), F.col("packed").alias("packed_a"), F.col("whole").alias("whole_a"), F.col("fine").alias("fine_a"), F.col("label").alias("label_x"), F.col("keys").alias("keys_a")
    )
    y = every.withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1))).select(
        "bucket", "block", F.col("node").alias("b"), F.col("n_shingles").alias("n_b"), F.col("packed").alias("packed_b"), F.col("whole").alias("whole_b"), F.col("fine").alias("fine_b"), F.col("label").alias("label_y"), "main", F.col("keys").alias("keys_b")
    )
    apart = (F.col("label_x") != F.col("label_y")) & ((F.col("label_y") == F.col("main")) | (F.col("a") < F.col("b")))
    # A pair that shares several buckets leaves the first of them that its keys show, and no other.
    close = _first_shared("bucket", "keys_a", "keys_b") & _close(per_hundred)
    x, y = x.repartition(parts, "bucket", "block"), y.repartition(parts, "bucket", "block")
    crossing = _worth_a_look(x.join(y, ["bucket", "block"]).filter(apart), minima, per_hundred, close)
    worth = materialize(ordered(crossing, "a", "b").join(tried, ["a", "b"], "left_anti"), "pairs")
    links = links.unionByName(materialize(_confirm(worth, texts, words, per_hundred), "links"))
    labels = materialize(components(links), "labels")

    nodes = labelled(classes, labels)
    placed = signed.alias("s").join(
        nodes.alias("c"),
        (F.col("s.set_a") == F.col("c.set_a")) & (F.col("s.set_b") == F.col("c.set_b")) & (F.col("s.n_shingles") == F.col("c.n_shingles")),
        "left",
    )
    out = placed.select(F.col("s.key").alias("key"), "doc_id", F.col("s.n_shingles").alias("n_shingles"), F.coalesce("label", F.col("s.key")).alias("_label"))
    # A label is the least key; only rows without doc_id have keys that are no ids.
    own = F.when(F.col("_label") == F.col("key"), F.col("doc_id")).otherwise(F.col("_label"))
    no_id = F.col("_label") >= F.lit(NO_ID)
    return out.select(
        "key", "doc_id", "n_shingles", F.when(no_id, F.lit(None)).otherwise(own).cast("bigint").alias("component_id"),
        (F.col("_label") == F.col("key")).alias("kept"),
    )


def deduplicated(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs``, one document of each group, with all their columns.

    Of rows that repeat a doc_id and its text one stays.
    """
    key = free_name(docs, "_row_key")
    kept = near_duplicates(docs, **settings).filter("kept").select(F.col("key").alias(key))
    kept = materialize(kept.distinct(), "kept")
    rows = docs.withColumn(key, row_key()).join(kept, key, "left_semi").select(*docs.columns, key)
    return rows.dropDuplicates([key, "text"]).drop(key)
