"""The operators against plain versions and SQL, and on awkward rows."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfloom.llm import (
    decontam,
    language,
    lattice,
    licenses,
    mixing,
    near_dup,
    quality_rules,
    resampling,
    sharding,
    substring,
)
from shelfloom.llm import queries as registered
from shelfloom.llm.components import components
from shelfloom.llm.registry import ORACLES, QUERIES
from tests.compare import connect, difference
from tests.conftest import TESTDATA

SF_DIR = f"{TESTDATA}/sf0.001"
BLANK = r"[^\x20\x09-\x0D]+"
assert registered


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet").toPandas()


@pytest.fixture(scope="module")
def awkward(spark):
    """NULLs in every column, empty and long texts, ties, repeated rows, clashing names."""
    long = " ".join(f"word{i % 977} x{i}" for i in range(6000))
    rows = [
        (1, "the quick brown fox jumps over the lazy dog and runs far away from here today ok yes", "en", "a", 1),
        (1, "the quick brown fox jumps over the lazy dog and runs far away from here today ok yes", "en", "a", 1),
        (2, "the quick brown fox jumps over the lazy dog and runs far away from here today ok yes", None, None, None),
        (3, None, "en", "a", None), (4, "", "de", None, 0), (5, "  \n\t ", None, "b", 4), (6, "12 34 !!", "en", "b", 8),
        (None, "der die das und ein nicht mit", "de", "b", 9), (None, None, None, None, None), (7, long, "en", "c", 9), (8, long, "en", "a", 9),
    ]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    return df.withColumns({c: F.lit(1) for c in ("key", "_key", "lang_pred", "words", "n", "node", "label", "item_id")})


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    assert difference(QUERIES[name], ORACLES[name], spark, SF_DIR, connect(SF_DIR)) is None


def test_licenses_by_brute_force(spark, docs):
    got = QUERIES["op2_license_scan"](spark, SF_DIR).toPandas().set_index("doc_id")
    for doc_id, text in zip(docs.doc_id, docs.text, strict=True):
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text)
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
        hits = [
            (i, label)
            for phrase, label in licenses.PHRASES.items()
            for i in range(len(words))
            if words[i : i + len(phrase.split())] == phrase.split()
        ]
        row = got.loc[doc_id]
        assert (row.n_words, row.n_base) == (len(words), len(hits))
        assert row.base_labels == ",".join(sorted({label for _, label in hits}))
        if hits:
            assert (row.first_word, row.last_word) == (min(hits)[0], max(hits)[0])


def test_rules_by_brute_force(spark, docs):
    got = QUERIES["op7_adaptive_rules"](spark, SF_DIR).toPandas().set_index("doc_id")
    for doc_id, text in zip(docs.doc_id, docs.text, strict=True):
        words = re.findall(BLANK, text)
        lines = [line for line in text.split("\n") if re.search(BLANK, line)]
        grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        times = Counter(grams)
        covered = {j for i, g in enumerate(grams) if times[g] > 1 for j in (i, i + 1, i + 2)}
        row = got.loc[doc_id]
        expected = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == expected
        assert row.base_failed == (len(words) < 50 or 100 * len(covered) > 50 * len(words))
        assert not (row.base_failed and row.kept)


def test_fences_follow_upper_quantiles_and_hot_junk_does_not_raise_its_own(spark):
    def fences(groups):
        # (lang, source, (rows, symbols of 1000 characters, repeats of 200 words) ...), words of 5 characters.
        rows = [(g[0], g[1], 200, 1000, n, 20, 0, r) for g in groups for times, n, r in g[2:] for _ in range(times)]
        names = "n_words bigint, word_chars bigint, n_symbols bigint, n_lines bigint, n_dup_lines bigint, n_repeat_words bigint"
        found = quality_rules.fences(spark.createDataFrame(rows, f"lang string, source string, {names}"))
        return {(r.lang, r.source, r.ratio): r.fence for r in found.collect()}

    clean = [("en", "a", (900, 0, 0), (100, 1, 10)), ("en", "b", (850, 0, 0), (150, 2, 16))]
    # More than a quarter of a large source is junk: 0.2 symbols.
    hot = fences([*clean, ("en", "junk", (180, 0, 0), (120, 200, 0))])
    assert hot["en", "junk", "symbols"] < 0.2
    # Quartiles are 0, and upper quantiles move the fences of repeats.
    wide = fences([("en", "a", (800, 0, 0), (200, 0, 9)), ("en", "b", (750, 0, 0), (250, 0, 40))])
    assert 0.15 <= wide["en", "a", "repeats"] < wide["en", "b", "repeats"] < 1
    # Nothing jumps at a row count.
    few = [fences([*clean, ("de", "c", (n - 40, 0, 20), (40, 0, 60))])["de", "c", "repeats"] for n in (199, 201)]
    assert abs(few[0] - few[1]) < 0.01
    # All rows are junk: shares stay within reach.
    assert fences([("en", "a", (10, 900, 100), (10, 950, 160))])["en", "a", "symbols"] < 0.96


def test_word_scores_by_brute_force(spark, docs):
    got = QUERIES["op9_lattice_score"](spark, SF_DIR).toPandas().set_index("doc_id")
    tokens = {d: [*re.findall(BLANK.encode(), t.encode().lower()), None] for d, t in zip(docs.doc_id, docs.text, strict=True)}
    counts = Counter(x for d, own in tokens.items() if zlib.crc32(str(d).encode()) % 7 != 2 for x in own)
    total, distinct = sum(counts.values()), len(counts)
    for doc_id, own in tokens.items():
        row = got.loc[doc_id]
        base = sum(math.log10((counts[x] + 1) / (total + distinct + 1)) for x in own)
        assert (row.n_tokens, row.n_known, row.train_tokens) == (len(own), sum(counts[x] > 0 for x in own), total)
        assert abs(row.base_score - base) < 1e-6 and row.score < 0


def test_lattice_sums_all_segmentations():
    pieces, weights = lattice.read_vocabulary(lattice.VOCABULARY)
    weight = dict(zip(pieces, weights, strict=True))
    words = [b"the", b"transportation", "éq".encode(), b"a" * 40]

    def plain(text):
        ways = [0.0] + [-math.inf] * len(text)
        for end in range(1, len(text) + 1):
            for start in range(end):
                if text[start:end] in weight:
                    ways[end] = np.logaddexp(ways[end], ways[start] + weight[text[start:end]])
        return ways[-1]

    table = lattice.Lattice.of(pieces, weights)
    assert np.allclose(table.log_marginals(words), [plain(lattice.MARK + w) for w in words])
    uses = table.expected(words, np.ones(len(words)))
    assert uses.min() >= 0 and 4 <= uses.sum() <= sum(map(len, words)) + 12


def test_piece_weights_learn_from_every_word(spark):
    texts = ["the the the the cat", "the transportation of a zebra", None, "", "x" * 300 + " éq the"]
    counts = Counter(w for t in texts for w in lattice.lower_words(t and t.encode()))
    plain = lattice.Lattice.of(*lattice.read_vocabulary(lattice.VOCABULARY))
    uses, own = plain.expected(list(counts), np.array(list(counts.values()), float)), np.exp(plain.weights)
    weights = np.log((1 - lattice.PRIOR) * uses / uses.sum() + lattice.PRIOR * own / own.sum())
    frame = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    for frequent in (0, 1, 2, 1000):
        model = lattice.train(frame, frequent=frequent)
        assert len(model.frequent["hash"]) <= frequent and np.allclose(model.lattice.weights, weights, rtol=1e-9)


def test_long_words_are_computed_in_bounded_runs(monkeypatch):
    table = lattice.Lattice.of(*lattice.read_vocabulary(lattice.VOCABULARY))
    words = ["transportation of zebras ".replace(" ", "").encode() * 9, "漢字".encode() * 50, b"x" * 301, b"cat"]
    whole, uses = table.log_marginals(words), table.expected(words, np.ones(4))
    monkeypatch.setattr(lattice, "_LONG", 32)
    assert np.allclose(table.log_marginals(words), whole, rtol=1e-12)
    # The uses of a word in parts leave out only pieces that cross a cut.
    assert abs(table.expected(words, np.ones(4)).sum() / uses.sum() - 1) < 0.1


def test_document_scores_sum_the_words(spark):
    texts = ["the the the the cat", "the transportation of a zebra " * 3, None, "", "x" * 6000 + " éq the"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    model = lattice.train(frame.filter("doc_id < 2"))
    # 5 and 15 words and two ends.
    assert (model.tokens, 10**model.log_end) == (22, pytest.approx(3 / 24))
    got = {r["doc_id"]: r["score"] for r in lattice.scores(frame, model).collect()}
    for doc_id, text in enumerate(texts):
        words = lattice.lower_words(text and text.encode())
        each = model.lattice.log_marginals(words) / math.log(10) + model.log_word
        assert got[doc_id] == pytest.approx(each.sum() + model.log_end)


def test_tagger_gradients_and_held_out_accuracy(spark, docs):
    tagger = language.ByteTagger.fresh(["a", "b"])
    tagger.weights = {k: v.astype(np.float64) for k, v in tagger.weights.items()}
    text, mask = language._padded([b"abc", b"defgh"])
    label = np.array([0, 1])

    def loss():
        p = tagger.positions(text, mask)
        return -(np.log(p[:, np.arange(2), label]) * mask).sum() / mask.sum()

    for name, grad in tagger.gradients(text, mask, label).items():
        at = np.unravel_index(np.abs(grad).argmax(), grad.shape)
        old = tagger.weights[name][at]
        tagger.weights[name][at] = old + 1e-3
        more = loss()
        tagger.weights[name][at] = old - 1e-3
        assert abs((more - loss()) / 2e-3 - grad[at]) < 1e-4
        tagger.weights[name][at] = old
    got = QUERIES["op6_language_id"](spark, SF_DIR).toPandas().merge(docs, on="doc_id")
    held = got[got.held_out]
    assert len(held) > 30 and (held.lang_pred == held.lang).mean() >= 0.95


def test_a_rare_language_is_learned(spark):
    words = {"aa": "lorem ipsum dolor", "bb": "foo bar baz", "cc": "жук дом лес"}
    rows = [(i, lang, f"{text} {i % 7}") for lang, n, (lo, text) in (("aa", 2000, (0, words["aa"])), ("bb", 1500, (5000, words["bb"])), ("cc", 3, (9000, words["cc"]))) for i in range(lo, lo + n)]
    tagger = language.train_tagger(spark.createDataFrame(rows, "doc_id bigint, lang string, text string"), rows=50)
    assert tagger.languages == ["aa", "bb", "cc"]


def test_shards_are_even_and_gapless(spark):
    got = QUERIES["op1_kd_shards"](spark, SF_DIR).toPandas()
    assert len(got) == 200 and set(got["shard"]) == set(range(16))
    assert all(sorted(g.slot) == list(range(len(g))) for _, g in got.groupby("shard"))
    assert got.groupby("text_crc32").shard.nunique().max() == 1


def test_resampling_prefers_good_texts(spark):
    got = QUERIES["op5_importance_resampling"](spark, SF_DIR).toPandas()
    assert len(got) == 200 and abs(got.selected.sum() - 160) <= 12
    assert got[got.selected].gumbel_key.min() >= got[~got.selected].gumbel_key.max()


def test_components(spark):
    links = spark.createDataFrame([(1, 2), (3, 2), (5, 4), (6, 6), (9, 8), (8, 7), (7, 3), (None, 1)], "a bigint, b bigint")
    assert dict(components(links).collect()) == {1: 1, 2: 1, 3: 1, 7: 1, 8: 1, 9: 1, 4: 4, 5: 4}


def test_awkward_rows(spark, awkward):
    n = awkward.count()
    items = spark.createDataFrame([(1, "quick brown fox jumps over the lazy dog and runs"), (2, "nicht mit"), (3, None)], "item_id bigint, text string")
    dup = {(r.doc_id, r.kept) for r in near_dup.near_duplicates(awkward).collect()}
    assert {(1, True), (2, False), (7, True), (8, False), (3, True)} <= dup
    assert near_dup.deduplicated(awkward).count() == n - 3
    assert near_dup.deduplicated(awkward).columns == awkward.columns
    hit = {(r.doc_id, r.n_hit) for r in decontam.contamination(awkward, items).collect()}
    assert {(1, 10), (2, 10), (None, 2), (None, 0), (3, 0), (7, 0)} <= hit
    assert decontam.clean_documents(awkward, items).count() == n - 4
    cut = {(r.doc_id, r.n_removed) for r in substring.without_repeats(awkward).collect()}
    assert {(7, 0), (8, 12000), (3, 0), (1, 0)} <= cut
    taken, cuts = mixing.mix_sources(awkward)
    assert taken.count() == n and cuts.count() == 4
    assert mixing.mixed_documents(awkward).columns == awkward.columns
    sharded = sharding.kd_shards(awkward, shards=3)
    assert sharded.count() == n and set(awkward.columns) <= set(sharded.columns)
    tagged = language.tag_languages(awkward, language.train_tagger(awkward))
    und = {r.doc_id for r in tagged.filter("lang_pred_ = 'und'").collect()}
    assert tagged.count() == n and {3, 4, 5, 6} <= und
    judged = quality_rules.judged(awkward)
    assert judged.count() == n and judged.filter("doc_id = 3 AND kept").count() == 0
    assert licenses.labelled(awkward).count() == n
    assert lattice.scores(awkward, lattice.train(awkward)).filter("doc_id = 3 AND n_tokens = 1").count() == 1
    picked = resampling.resample(awkward, awkward.select("doc_id"))
    assert picked.count() == n and picked.filter("doc_id = 3 AND selected").count() == 0


def test_two_texts_under_one_id_keep_the_links_of_both(spark):
    one, two = (" ".join(f"{c}{i}" for i in range(200)) for c in "ab")
    rows = [(1, one), (1, two), (2, one + " more"), (3, two + " more"), (4, "something else altogether here now")]
    found = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((r.doc_id, r.component_id) for r in found) == [(1, 1), (1, 1), (2, 1), (3, 1), (4, 4)]
    pairs = spark.createDataFrame([(1, 2), (1, 3)], "a bigint, b bigint").coalesce(1)
    texts = spark.createDataFrame([(k, t.encode()) for k, t in rows], "key bigint, text binary").coalesce(1)
    assert {tuple(r) for r in near_dup._confirm(pairs, texts, 5, 80).collect()} == {(1, 2), (1, 3)}


def test_empty_tables(spark, awkward):
    none = awkward.filter("doc_id = -1")
    items = spark.createDataFrame([], "item_id bigint, text string")
    assert near_dup.near_duplicates(none).count() == 0
    assert decontam.contamination(awkward, items).filter("contaminated").count() == 0
    assert substring.without_repeats(none).count() == 0
    assert mixing.mix_sources(none)[0].count() == 0
    assert sharding.kd_shards(none, shards=4).count() == 0
    assert language.tag_languages(none, language.train_tagger(none)).count() == 0
    assert quality_rules.judged(none).count() == 0
    assert licenses.labelled(none).count() == 0
    assert lattice.scores(none, lattice.train(none)).count() == 0
    assert resampling.resample(none, none).count() == 0


def test_a_large_group_of_copies_is_one_shard(spark):
    rows = [(i, "the same text again", "en", "a") if i % 3 == 0 else (i, f"text number {i + 100_000}", "en", "a") for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    got = sharding.kd_shards(docs, shards=8).toPandas()
    own = got[got.text == "the same text again"]
    assert own["shard"].nunique() == 1 and len(own) == 500
    others = got[got.text != "the same text again"].groupby("shard")["size"].sum()
    assert len(others) == 7 and others.max() <= 1.1 * others.min() and own["shard"].iloc[0] not in others.index


def test_fine_estimate_is_near_the_true_similarity(spark):
    random = np.random.default_rng(1)
    rows = []
    for n in (20, 150, 3000):
        every = random.permutation(np.unique(random.integers(0, 1 << 63, n, np.uint64)))
        both, own = int(len(every) * 0.8), len(every) // 10
        a, b = every[: both + own], np.concatenate([every[:both], every[both + own :]])
        sketches = [near_dup.long_of(near_dup.fine_sketch(np.sort(x))).tolist() for x in (a, b, a)]
        rows.append((both / len(every), *sketches))
    frame = spark.createDataFrame(rows, "s double, a array<bigint>, b array<bigint>, same array<bigint>")
    found = frame.select("s", near_dup.fine_estimated(F.col("a"), F.col("b")), near_dup.fine_estimated(F.col("a"), F.col("same"))).collect()
    assert all(abs(s - e) < near_dup.FINE_MARGIN and abs(one - 1) < 1e-9 for s, e, one in found)
