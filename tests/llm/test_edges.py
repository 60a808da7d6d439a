"""Names that the operators use themselves, ties, and rows that share an id or have none."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from shelfloom.llm import decontam, language, mixing, near_dup, resampling, sharding

HELPERS = (
    "_a", "_unit_a", "_unit_b", "_number", "_first", "_part", "_row", "_n", "_before", "_kept", "_row_key", "_hit_key",
    "_mix_cut", "_mix_times", "_mix_source", "_mix_pass", "_text", "_letters",
)


@pytest.fixture(scope="module")
def named(spark):
    """Rows with a column for each helper name, whose values tell whether they are kept."""
    rows = [(i, f"document number {i} has words of its own {i * 7}", "en", "ab"[i % 2]) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    return df.withColumns({name: F.concat(F.lit(f"{name}-"), F.col("doc_id").cast("string")) for name in HELPERS})


def test_helper_names_may_be_taken(spark, named):
    items = spark.createDataFrame([(1, "number 3 has words of its own 21")], "item_id bigint, text string")
    results = {
        "deduplicated": (near_dup.deduplicated(named), 20),
        "clean": (decontam.clean_documents(named, items), 19),
        "mixed": (mixing.mixed_documents(named, share=1.0, weights=(1,)), None),
        "sharded": (sharding.kd_shards(named, shards=3), 20),
        "tagged": (language.tag_languages(named, language.train_tagger(named)), 20),
    }
    for what, (found, n) in results.items():
        rows = found.collect()
        assert n is None or len(rows) == n, what
        assert rows and found.columns[: len(named.columns)] == named.columns, what
        assert all(r[name] == f"{name}-{r.doc_id}" for r in rows for name in HELPERS), what


def test_texts_under_one_id_have_their_own_hits(spark):
    item = "one two three four five six seven eight nine ten"
    docs = spark.createDataFrame([(1, "clean little text"), (1, f"x {item} y"), (None, item), (None, "also clean")], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    found = sorted((r.n_words, r.n_hit) for r in decontam.contamination(docs, items).collect())
    assert found == [(2, 0), (3, 0), (10, 10), (12, 10)]
    assert sorted(r.text for r in decontam.clean_documents(docs, items).collect()) == ["also clean", "clean little text"]


def test_a_mix_of_rows_without_ids_keeps_its_budget(spark):
    rows = [(None, " ".join(f"w{i}x{j}" for j in range(20)), "s") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    taken = mixing.mix_sources(docs, share=0.75)[0].agg(F.sum("taken")).first()[0]
    whole = mixing.mixed_documents(docs, share=0.75).count() * 20
    assert taken == 13_500 and 13_500 <= whole < 13_520


def test_ties_at_the_cut_are_exact(spark):
    rows = [(i, f"some words number{i}") for i in range(40)] + [(None, "equal text here") for _ in range(30)]
    rows += [(7, f"one id many texts {i}") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    picked = resampling.resample(docs, docs.filter("doc_id = -1").select("doc_id"), share=0.5).toPandas()
    alike = picked[picked.doc_id.isna()]
    assert alike.selected.nunique() == 1
    # The thirty equal rows share one verdict; all others are told apart.
    assert picked.selected.sum() == 50 or (alike.selected.all() and 50 < picked.selected.sum() < 80)
    distinct = spark.createDataFrame([(7, f"word{i} word{i}") for i in range(100)], "doc_id bigint, text string")
    got = resampling.resample(distinct, distinct.filter("doc_id = -1").select("doc_id"), share=0.5).toPandas()
    assert got.gumbel_key.nunique() == 1 and got.selected.sum() == 50


def test_members_of_one_bucket_meet_whatever_their_sizes(spark):
    """Sets around ``WHOLE`` shingles: each pair worth a look has whole sets or sketches on both sides."""
    found = []
    for n in (30, 420, 500, 512, 513, 600, 3000):
        words = [f"w{i}" for i in range(n + 1)]
        near = [*words[: int(n * 0.93)], *(f"x{i}" for i in range(n // 20))]
        found += [(n, " ".join(words)), (n + 1_000_000, " ".join(near))]
    texts = spark.createDataFrame([(k, t.encode()) for k, t in found], "key bigint, text binary")
    sketched = near_dup._fine_sketches(texts, 2, 80).withColumn("pair", F.col("node") % 1_000_000)
    sizes = {k: len(near_dup.shingle_set(t.encode(), 2)) for k, t in found}
    n_of = F.udf(lambda k: sizes[k], "bigint")
    a = sketched.filter("node < 1000000").select("pair", F.col("whole").alias("whole_a"), F.col("fine").alias("fine_a"), n_of("node").alias("n_a"))
    b = sketched.filter("node > 1000000").select("pair", F.col("whole").alias("whole_b"), F.col("fine").alias("fine_b"), n_of("node").alias("n_b"))
    assert {r.pair: r.close for r in a.join(b, "pair").select("pair", near_dup._close(80).alias("close")).collect()} == {
        n: True for n in (30, 420, 500, 512, 513, 600, 3000)
    }
    assert not any(r[0] for r in a.join(b, "pair").select(near_dup._close(97).alias("close")).collect())
