"""Benchmark decontamination by winnowing: joined fingerprints, extended and compared.

A span of ``window`` words is found wherever it stands: of every ``window - k + 1``
consecutive runs of ``k`` words the one with the least hash is a fingerprint, on both sides,
so two equal spans share one at the same place. Fingerprints are joined, and each hit is
extended to both sides as far as one window reaches, comparing words. That is enough: each
equal window has a fingerprint of its own.

Items shorter than a window are one window of all their words. They are looked for at every
place: by their first ``k`` words, or if they have fewer, by all of them.

Only DataFrame functions run here. Fingerprints of documents that no item can have are
dropped before the join by a bit array of fixed size; it decides nothing, since every hit
is compared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfloom.llm.common import PLAIN_WORDS, ascii_lower, free_name, regex_words
from shelfloom.sources.scratch import materialize

WINDOW, K = 10, 5
#: Bits of the array that tells which hashes occur in the items: 128 KB, whatever the items.
FILTER_BITS = 1 << 20


def _words(text: Column) -> Column:
    return regex_words(ascii_lower(text), PLAIN_WORDS)


def _at(array: str, i: Column | int) -> Column:
    return F.get(F.col(array), i if isinstance(i, Column) else F.lit(i))


def _grams(k: int) -> Column:
    """Hash of each run of k words, from the column of word hashes; an empty array if there is none."""
    n = F.size("_hashes") - k
    hashed = F.transform(
        F.sequence(F.lit(0), n), lambda i: F.xxhash64(F.lit(k), *[_at("_hashes", i + j) for j in range(k)])
    )
    return F.when(n >= 0, hashed).otherwise(F.array().cast("array<bigint>"))


def _places(grams: str) -> Column:
    """0 .. number of grams - 1."""
    n = F.size(grams)
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def _least(grams: str, p: Column, width: int) -> Column:
    """Whether the gram at ``p`` is the least, or as little as the least, of some full window."""
    first, last = F.greatest(p - (width - 1), F.lit(0)), F.least(p, F.size(grams) - width)
    return (last >= first) & F.exists(
        F.sequence(first, F.greatest(first, last)),
        lambda i: _at(grams, p) == F.array_min(F.slice(F.col(grams), i + 1, width)),
    )


def _around(p: Column, k: int, reach: int) -> list[Column]:
    """The words at ``p``, those before it from near to far, and those after it."""
    left = F.reverse(F.slice(F.col("_words"), F.greatest(p - reach, F.lit(0)) + 1, F.least(p, F.lit(reach))))
    return [
        F.slice(F.col("_words"), p + 1, k).alias("gram"),
        left.alias("left"),
        F.slice(F.col("_words"), p + k + 1, reach).alias("right"),
    ]


def _with_hashes(df: DataFrame, text: str) -> DataFrame:
    df = df.withColumn("_words", _words(F.col(text)))
    return df.withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))


def item_seeds(items: DataFrame, window: int = WINDOW, k: int = K) -> DataFrame:
    """(item_id, k, hash, gram, left, right, short, need): the fingerprints of all items."""
    reach = window - k
    base = _with_hashes(items.select("item_id", "text"), "text").withColumn("_n", F.size("_words"))
    rows = []
    short = F.col("_n") < window
    for size in range(1, k + 1):
        own = base.withColumn("_grams", _grams(size))
        if size < k:
            places = F.when(F.col("_n") == size, F.array(F.lit(0)))
        else:
            chosen = F.filter(_places("_grams"), lambda p: _least("_grams", p, reach + 1))
            places = F.when(F.col("_n") >= window, chosen).when(F.col("_n") >= k, F.array(F.lit(0)))
        # An outer explode: a plain one puts a test of the array, all of it, below the projections.
        own = own.withColumn("_p", F.explode_outer(places)).filter(F.col("_p").isNotNull())
        rows.append(
            own.select(
                "item_id", F.lit(size).alias("k"), _at("_grams", F.col("_p")).alias("hash"),
                *_around(F.col("_p"), size, reach), short.alias("short"),
                F.least(F.col("_n"), F.lit(window)).alias("need"),
            )
        )
    seeds = rows[0]
    for more in rows[1:]:
        seeds = seeds.unionByName(more)
    return seeds.distinct()


def _bit_array(hashes: DataFrame, bits: int) -> Column:
    """Array of longs with a bit set for each hash, as a constant. Its size is ``bits``, whatever the input."""
    spot = F.pmod(F.col("hash"), F.lit(bits))
    words = (
        hashes.select(F.shiftright(spot, 6).alias("w"), F.pmod(spot, F.lit(64)).cast("int").alias("b"))
        .groupBy("w")
        .agg(F.bit_or(F.expr("shiftleft(1L, b)")).alias("v"))
        .collect()
    )
    values = ["0"] * (bits // 64)
    for row in words:
        values[row["w"]] = str(row["v"])
    return F.split(F.lit(",".join(values)), ",").cast("array<bigint>")


def _in_bits(array: Column, bits: int, hashed: Column) -> Column:
    spot = F.pmod(hashed, F.lit(bits))
    word = F.get(array, F.shiftright(spot, 6).cast("int"))
    return F.getbit(word, F.pmod(spot, F.lit(64)).cast("int")) == 1


def document_seeds(
    docs: DataFrame, seeds: DataFrame, window: int = WINDOW, k: int = K, bits: int = FILTER_BITS
) -> DataFrame:
    """(key, doc_id, n_words, seeds): one narrow pass over the texts.

    ``seeds`` of the result holds the places worth a look, with the words around them.
    """
    reach = window - k
    lengths = sorted(r["k"] for r in seeds.filter("short").select("k").distinct().collect())
    long_bits = _bit_array(seeds.filter("NOT short"), bits)
    base = _with_hashes(docs.select(_row().alias("key"), "doc_id", "text"), "text").drop("text")
    found = []
    for size in sorted({k, *lengths}):
        name = f"_grams{size}"
        base = base.withColumn(name, _grams(size))
        short_bits = _bit_array(seeds.filter(F.col("short") & (F.col("k") == size)), bits) if size in lengths else None

        def wanted(p: Column) -> Column:
            here = _at(name, p)  # noqa: B023  called at once
            tests = [_in_bits(short_bits, bits, here)] if short_bits is not None else []  # noqa: B023
            if size == k:  # noqa: B023
                tests.append(_in_bits(long_bits, bits, here) & _least(name, p, reach + 1))  # noqa: B023
            return tests[0] if len(tests) == 1 else tests[0] | tests[1]

        def seed(p: Column) -> Column:
            return F.struct(F.lit(size).alias("k"), _at(name, p).alias("hash"), p.alias("p"), *_around(p, size, reach))  # noqa: B023

        found.append(F.transform(F.filter(_places(name), wanted), seed))
    return base.select(
        "key", "doc_id", F.size("_words").cast("bigint").alias("n_words"), F.flatten(F.array(*found)).alias("seeds")
    )


def _common(a: str, b: str, reach: int) -> Column:
    """How many words two arrays have in common at their start."""
    total = F.lit(0)
    for j in range(1, reach + 1):
        same = (F.size(a) >= j) & (F.size(b) >= j) & (F.slice(a, 1, j) == F.slice(b, 1, j))
        total = total + F.when(same, 1).otherwise(0)
    return total


def _row() -> Column:
    """What tells rows apart: the id and a hash of the text."""
    return F.struct(F.col("doc_id").alias("id"), F.xxhash64("text").alias("content"))


def find_items(docs: DataFrame, items: DataFrame, window: int = WINDOW, k: int = K) -> tuple[DataFrame, DataFrame]:
    """(documents with key, doc_id and n_words; hits with key, item_id, start and length).

    A hit is a run of words that holds an occurrence of a window of the item. NULL and empty
    texts have no words, and so neither windows nor hits. The key is (doc_id, hash of the
    text): rows that repeat both share their hits, and rows that repeat a doc_id, NULL or
    not, with another text have their own. Items that repeat count by their item_id. Other columns are not read.
    """
    reach = window - k
    seeds = materialize(item_seeds(items, window, k), "item_seeds")
    looked = materialize(document_seeds(docs, seeds, window, k), "doc_seeds")
    places = looked.select("key", F.explode("seeds").alias("s")).select(
        "key", F.col("s.k").alias("_k"), F.col("s.hash").alias("_hash"), F.col("s.p").alias("p"),
        F.col("s.gram").alias("_gram"), F.col("s.left").alias("_left"), F.col("s.right").alias("_right"),
    )
    joined = places.join(seeds, (F.col("_hash") == F.col("hash")) & (F.col("_k") == F.col("k")) & (F.col("_gram") == F.col("gram")))
    to_left = F.when(F.col("short"), 0).otherwise(_common("_left", "left", reach))
    hits = joined.withColumns({"_l": to_left, "_r": _common("_right", "right", reach)}).filter(
        F.col("_l") + F.col("k") + F.col("_r") >= F.col("need")
    )
    hits = hits.select(
        "key", "item_id", (F.col("p") - F.col("_l")).alias("start"),
        F.when(F.col("short"), F.col("need")).otherwise(F.col("_l") + F.col("k") + F.col("_r")).alias("length"),
    )
    return looked.select("key", "doc_id", "n_words"), hits


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, k: int = K) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    See ``find_items`` for NULLs, empty texts and repeated rows. Each row of ``docs`` gives
    one row; a document without hits has zeros and the hash of the empty string.
    """
    counted, hits = find_items(docs, items, window, k)
    hits = materialize(hits.distinct(), "hits")
    place = F.explode(F.sequence(F.col("start"), F.col("start") + F.col("length") - 1))
    words = hits.select("key", place.alias("place")).distinct().groupBy("key").agg(F.count("*").alias("n_hit"))
    names = (
        hits.select("key", F.col("item_id").cast("string").alias("item"))
        .distinct()
        .groupBy("key")
        .agg(F.count("*").alias("n_items"), F.sha2(F.array_join(F.sort_array(F.collect_list("item")), ","), 256).alias("h"))
    )
    both = words.join(names, "key")
    return counted.join(both, "key", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"),
        F.coalesce("n_items", F.lit(0).cast("bigint")).alias("n_items"),
        F.coalesce("h", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def clean_documents(docs: DataFrame, items: DataFrame, window: int = WINDOW, k: int = K) -> DataFrame:
    """The rows of ``docs`` in which no window of an item occurs, with all their columns."""
    _, hits = find_items(docs, items, window, k)
    key = free_name(docs, "_hit_key")
    hit = materialize(hits.select(F.col("key").alias(key)).distinct(), "hit_keys")
    return docs.withColumn(key, _row()).join(hit, key, "left_anti").select(*docs.columns)
