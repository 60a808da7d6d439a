"""The five stages on a small fixture, each against a plain version."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline


def test_run_equals_plain_stages(spark, tmp_path):
    def text(c):
        return " ".join(f"{c}{i}" for i in range(60))

    bench = "the secret benchmark question that nobody should ever train on at all"
    texts = {1: text("a"), 2: text("a") + " more", 3: text("b"), 4: None, 5: "12 34 !!", 6: f"{text('c')} {bench}", 7: text("d"), 8: text("жук")}
    rows = [(i, t, "en", "s", len(t or "")) for i, t in texts.items()]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, bench)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    letters = [i for i, t in texts.items() if t and any(c.isalpha() for c in t)]
    single = [i for i in letters if i != 2]
    clean = [i for i in single if i != 6]
    # One source: the mix asks for 1.5 times its words, one whole pass and half of the next, whose cut is in a document.
    expected = {"language": letters, "near_duplicates": single, "benchmark": clean}
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:3]:
        kept = stage(spark, kept, str(tmp_path))
        assert sorted(r.doc_id for r in kept.collect()) == expected[name] and kept.columns == docs.columns
    out = corpus_pipeline.run(spark, str(tmp_path)).toPandas()
    times = Counter(out.doc_id)
    assert sorted(times) == clean and set(times.values()) == {1, 2} and sum(times.values()) == 6
    assert all(texts[r.doc_id] == r.text for r in out.itertuples())
    assert all(sorted(g.slot) == list(range(len(g))) for _, g in out.groupby("shard"))
