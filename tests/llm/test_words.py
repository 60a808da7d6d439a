"""Spelling variants, BPE and collocations against plain versions, and on awkward rows."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfloom.llm import bpe, collocations, common, spelling
from shelfloom.llm import queries as registered
from shelfloom.llm.registry import QUERIES
from tests.conftest import TESTDATA

SF_DIR = f"{TESTDATA}/sf0.001"
assert registered
SCHEMA = "doc_id bigint, text string, lang string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet").toPandas()


def frame(spark, rows):
    """Rows with columns that have the names the operators add or use."""
    names = ("ids", "n_tokens", "decoded", "word", "n", "key", "_key", "_part", "_copy", "words", "phrase", "rank", "id")
    return spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in names})


# --- spelling ---


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    i = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a != b and (a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :] and len(b) == len(a) + 1)


def plain_variants(rows, one_in=31, times=10):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if one_in and h % one_in == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    # Words one edit apart share themselves or themselves less one letter.
    shared = defaultdict(set)
    for w in counts:
        for v in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            shared[v].add(w)
    near = defaultdict(set)
    for group in shared.values():
        for a, b in itertools.permutations(group, 2):
            if b not in near[a] and one_edit(a, b):
                near[a].add(b)
    form = {}
    for w, others in near.items():
        if others:
            best = min(others, key=lambda o: (-counts[o], o))
            if counts[best] >= times * counts[w]:
                form[w] = best
    out = set()
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n, len(near[w]), counts[form[w]] if w in form else None))
    return out


def test_variants_by_brute_force(spark, docs):
    got = QUERIES["op11_spelling_variants"](spark, SF_DIR).collect()
    expected = plain_variants(zip(docs.doc_id, docs.text, strict=True))
    assert {tuple(r) for r in got} == expected and len(got) == len(expected)
    assert sum(n_near > 0 for *_, n_near, _ in expected) > 100


def test_planted_variants_chains_and_ties(spark):
    rng = random.Random(4)
    alphabet = "abcdéß"
    words = ["".join(rng.choices(alphabet, k=rng.randint(7, 9))) for _ in range(60)]
    lines = []
    for i, w in enumerate(words):
        near = [w[:3] + w[4:], w[:2] + "z" + w[2:], "q" + w[1:], w[:-1] + "x", w + w[-1], w[1:]]
        lines += [f"{w} " * (400 if i % 2 else 10)] + [f"{v} " * rng.choice([2, 3, 40, 1]) for v in near]
    lines += ["aaaaaaaa " * 5000, "aaaaaaaaa " * 40, "aaaaaaaaaa " * 3, "chainedx " * 3000, "chainedy " * 300, "chaynedy " * 30, "chaynody " * 3]
    rows = [(i, line, "en") for i, line in enumerate(lines)]
    got = {tuple(r) for r in spelling.variants(frame(spark, rows), one_in=None).collect()}
    assert got == plain_variants([(i, line) for i, line, _ in rows], one_in=None)
    assert ("chaynody", "chaynedy", "chainedx", 3, 1, 30) in got


def test_pivots_are_the_cheapest_disjoint_pair():
    rng = np.random.default_rng(2)
    for n in range(3, 12):
        places, allowed = rng.integers(0, 30, (200, n)), rng.random((200, n)) < 0.6
        first, second = spelling.pivots(places, allowed)
        for row, ok, i, j in zip(places, allowed, first, second, strict=True):
            pairs = [row[x] + row[y] for x, y in itertools.combinations(np.flatnonzero(ok), 2) if y - x >= 2]
            assert (row[i] + row[j] == min(pairs) and j - i >= 2 and ok[i] and ok[j]) if pairs else (i, j) == (-1, -1)


def test_spelling_of_awkward_rows(spark):
    long = "abcdefgh" * 40_000
    rows = [(None, "Variant variant VARIANT", None), (1, None, "en"), (2, "", None), (None, None, None), (3, "variant variänt", "de"), (3, "variant variänt", "de"), (4, f"{long} {long} {long}x {long}x", "x")]
    got = {(r.word[:9], r.n, r.n_near) for r in spelling.variants(frame(spark, rows), one_in=None).collect()}
    assert got == {("variant", 5, 1), ("variänt", 2, 1), ("abcdefgha", 2, 1)}
    assert spelling.variants(frame(spark, rows).filter("doc_id = 9")).count() == 0


# --- BPE ---


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.VOCABULARY)


def odd_texts():
    rng = random.Random(1)
    letters = "abcxyz  \n\t'123!?éñ日本語́​\U0001f600  　\x1c\x85'sdllre"
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 60))) for _ in range(3000)]
    anywhere = [chr(rng.choice([rng.randint(1, 0xD7FF), rng.randint(0xE000, 0x10FFFF), rng.randint(1, 300)])) for _ in range(20_000)]
    texts += ["".join(anywhere[i : i + 40]) for i in range(0, len(anywhere), 40)]
    return [*texts, "x<|endoftext|> y", "<|endoftext|><|endoftext|>", "<|endoftext", "a" * 100_000, " " * 5000 + "a", "Ᲊx ՘a", "ab" * 60_000]


@pytest.mark.parametrize("window", [bpe.WINDOW, 16])
def test_ids_equal_the_library(library, monkeypatch, window):
    monkeypatch.setattr(bpe, "WINDOW", window)
    texts = odd_texts()
    got = bpe.Encoder(bpe.Vocabulary.read()).encode(texts)
    assert [g.tolist() for g in got] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_a_full_table_of_words_is_forgotten(library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 50)
    encoder, texts = bpe.Encoder(bpe.Vocabulary.read()), odd_texts()[:400]
    for i in range(0, 400, 7):
        got = encoder.encode(texts[i : i + 7])
        assert [g.tolist() for g in got] == [e.ids for e in library.encode_batch(texts[i : i + 7], add_special_tokens=False)]


def test_any_ids_decode_as_in_the_library(library):
    rng, vocabulary = random.Random(3), bpe.Vocabulary.read()
    for _ in range(2000):
        ids = rng.choices(range(50_300), k=rng.randint(0, 20))
        packed = np.array(ids, "<u4").tobytes()
        assert bpe.bytes_of_ids(vocabulary, packed).decode("utf-8", "replace") == library.decode(ids, skip_special_tokens=False)


def test_round_trip_query(spark, docs, library):
    got = {r.doc_id: r for r in QUERIES["op12_bpe_round_trip"](spark, SF_DIR).collect()}
    assert len(got) == len(docs)
    for doc_id, text in zip(docs.doc_id, docs.text, strict=True):
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False).encode()
        expected = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded).hexdigest())
        assert (got[doc_id].n_tokens, got[doc_id].ids_sha256, got[doc_id].decoded_sha256) == expected


def test_bpe_of_awkward_rows(spark, library):
    texts = [None, "", " ", "same", "same", "x" * 200_000, "é́<|endoftext|>"]
    rows = frame(spark, [(None, t, None) for t in texts])
    found = bpe.encoded(rows)
    assert found.columns == [*rows.columns, "n_tokens_", "ids_"]
    back = bpe.decoded(found, ids="ids_").collect()
    assert sorted(r.decoded_ for r in back) == sorted(t or "" for t in texts)
    assert all(r.n_tokens_ == len(library.encode(r.text or "", add_special_tokens=False).ids) and r.ids == "x" for r in back)
    assert bpe.decoded(bpe.encoded(rows.filter("doc_id = 1")), ids="ids_").count() == 0


# --- collocations ---


def plain_collocations(rows, least=10, top=2000):
    counts = defaultdict(Counter)
    for text, lang in rows:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            words = re.findall("[^\x20\x09]+", piece)
            for m in (1, 2, 3):
                counts[lang or "und"].update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    out = set()
    for lang, f in counts.items():
        total = sum(n for g, n in f.items() if len(g) == 1)
        chosen = {g: n for g, n in f.items() if len(g) >= 2 and n >= least}
        gone = {g[i : i + 2] for g, n in chosen.items() if len(g) == 3 for i in (0, 1) if 100 * n >= 50 * f[g[i : i + 2]]}
        scored = []
        for g, a in chosen.items():
            if g not in gone:
                score, k = min((1_000_000 * a * a // (f[g[:k]] * f[g[k:]]), k) for k in range(1, len(g)))
                scored.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], start=1):
            out.add((lang, rank, phrase.decode(), -a, left, right, total, -score))
    return out


def collocated(df, **options):
    return {tuple(r) for r in collocations.collocations(df, **options).collect()}


@pytest.mark.parametrize("small", [False, True])
def test_collocations_by_brute_force(spark, docs, monkeypatch, small):
    if small:
        # Every bound is met often: windows cut texts, tasks hand their counts on, all bits are set by collisions.
        for name, value in {"_WINDOW": 64, "_RUN": 50, "_PHRASES": 40, "_WORDS": 60}.items():
            monkeypatch.setattr(collocations, name, value)
    rows = list(zip(docs.text, docs.lang, strict=True))[: 60 if small else None]
    df = spark.createDataFrame([(i, t, lang) for i, (t, lang) in enumerate(rows)], SCHEMA).repartition(5)
    if small:
        counts = [list(collocations._phrases(3, None)(iter([pa.RecordBatch.from_pydict({"lang": [lang or "und" for _, lang in rows], "text": [t and t.encode() for t, _ in rows]})])))]
        assert len(counts[0]) > 5
        sums = Counter()
        for batch in counts[0]:
            for lang, words, n in zip(*batch.to_pydict().values(), strict=True):
                sums[lang, tuple(words.split(" "))] += n
        expected = Counter()
        for text, lang in rows:
            for piece in re.split("[.,;:!?\x0a-\x0d]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
                words = re.findall("[^\x20\x09]+", piece)
                expected.update((lang or "und", tuple(words[i : i + 3])) for i in range(len(words) - 2))
        assert sums == expected
    else:
        assert collocated(df) == plain_collocations(rows)
        assert collocated(df, least=2, top=50) == plain_collocations(rows, least=2, top=50)


def test_cuts_of_the_sorted_stream_may_fall_anywhere(spark, docs):
    rows = list(zip(docs.text, ["en"] * len(docs), strict=True))
    df = spark.createDataFrame([(i, t, lang) for i, (t, lang) in enumerate(rows)], SCHEMA)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    try:
        assert collocated(df, least=5) == plain_collocations(rows, least=5)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_scores_are_exact_beyond_64_bits(spark):
    n, left, right = 3_000_000_019, 4_000_000_007, 5_000_000_029
    row = spark.range(1).selectExpr(f"{n}L AS n", f"{left}L AS x", f"{right}L AS y").select(collocations._cut("x", "y", 1).alias("c")).first().c
    assert (row.score, row.k, row.l, row.r) == (1_000_000 * n * n // (left * right), 1, left, right)


def test_collocations_of_awkward_rows(spark):
    rows = [
        (None, "New York city " * 12, None), (1, None, "en"), (2, "", None), (None, None, None), (3, "a\x00b c\x01 " * 30, "en"), (3, "a\x00b c\x01 " * 30, "en"),
        (4, "x" * 3_000_000, "en"), (5, "to be, or\tnot. To be! " * 20, "und"), (6, "é É " * 15, "fr"), (7, "the the the " * 15, "fr"),
    ]
    got = collocated(frame(spark, rows))
    assert got == plain_collocations([(t, lang) for _, t, lang in rows])
    assert collocations.collocations(frame(spark, rows).filter("doc_id = 9")).count() == 0


# --- slices ---


def test_slices_are_bounded_by_bytes_and_keep_all_rows():
    texts = ["a" * (i * 37 % 5000) if i % 11 else None for i in range(2000)]
    batch = pa.RecordBatch.from_pydict({"n": pa.array(range(2000)), "text": pa.array(texts)}).slice(5, 1990)
    parts = list(common.slices(batch, 20_000))
    assert pa.Table.from_batches(parts).to_pydict() == pa.Table.from_batches([batch]).to_pydict()
    assert max(sum(len(t or "") for t in p["text"].to_pylist()) for p in parts) <= 25_000 and len(parts) > 100
