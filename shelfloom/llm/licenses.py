"""License scans by diagonal voting.

Templates are short phrases, looked for word by word, and notices, of which parts may be
missing or changed. Every run of ``k`` words of a text that a template has votes for the
diagonal text place - template place. A text that follows a template votes for one diagonal;
a word more or less shifts to a neighbouring one. Votes are joined to template places and
aggregated by diagonal, diagonals at most ``APART`` apart are merged, and a merged span is
verified by how much of the template it covers and how dense it is.

Runs that no template has are dropped where the text is read. The templates are a parameter
of fixed size, so the table of their runs is broadcast.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfloom.llm.common import add_columns, gram_hashes, long_of, plain_words, texts_of, word_hashes
from shelfloom.sources.scratch import materialize

#: Phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Opening words of well-known public license notices and their labels.
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
    "documentation files the software to deal in the software without restriction": "mit",
    "licensed under the apache license version 2 0 the license you may not use this file except in compliance with "
    "the license you may obtain a copy of the license at": "apache",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
    "license as published by the free software foundation": "gpl",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the "
    "following conditions are met": "bsd",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
    "granted": "isc",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl",
}
PHRASE_K, NOTICE_K, APART = 2, 4, 3
LEAST_COVER, LEAST_DENSITY = 0.5, 0.5


def _template_grams(phrases: Mapping[str, str], notices: Mapping[str, str]) -> list[tuple]:
    """(k, hash, template, label, place, number of runs, words, whether a phrase) for every run."""
    rows = []
    for k, texts, phrase in ((PHRASE_K, phrases, True), (NOTICE_K, notices, False)):
        for number, (text, label) in enumerate(texts.items()):
            words = plain_words(text.encode())
            own = min(k, len(words))
            grams = long_of(gram_hashes(word_hashes(words), own))
            rows += [(own, int(g), number + (0 if phrase else 1000), label, i, len(grams), len(words), phrase) for i, g in enumerate(grams)]
    return rows


def _finder(wanted: dict[int, np.ndarray]):
    def make():
        def cells(batch: pa.RecordBatch) -> list:
            sizes, votes = [], []
            for text in texts_of(batch, "_text"):
                words = plain_words(text or b"")
                sizes.append(len(words))
                hashed, own = word_hashes(words), []
                for k, known in wanted.items():
                    grams = long_of(gram_hashes(hashed, k))
                    at = np.flatnonzero(known[np.minimum(np.searchsorted(known, grams), len(known) - 1)] == grams)
                    own += [{"k": k, "hash": h, "at": i} for h, i in zip(grams[at].tolist(), at.tolist(), strict=True)]
                votes.append(own)
            return [sizes, votes]

        return cells

    return make


def scan_licenses(
    docs: DataFrame, phrases: Mapping[str, str] = PHRASES, notices: Mapping[str, str] = NOTICES
) -> tuple[DataFrame, DataFrame]:
    """(rows with key, doc_id and n_words; spans with key, label, start, end, cover and whether of a phrase).

    Places are words from 0, of the words of the text with A-Z lower-cased; end is behind the
    last. A phrase's span has all its words one after the other; spans of one phrase may
    overlap. A notice's span covers at least half of its runs, at half the density of the
    notice or more; cover is the part covered. NULL and empty texts have no words. Every row
    has its own key, so repeated rows have their own spans. Other columns are not read.
    """
    grams = _template_grams(phrases, notices)
    wanted = {k: np.unique(np.array([g[1] for g in grams if g[0] == k], np.int64)) for k in sorted({g[0] for g in grams})}
    base = docs.select("doc_id", F.col("text").cast("binary").alias("_text"))
    read = add_columns(
        base, _finder(wanted), "n_words bigint, votes array<struct<k:int,hash:bigint,at:int>>", keep=["doc_id"]
    )
    # The rows are written with their numbers, so these stay whichever tasks run again.
    read = materialize(read.withColumn("key", F.monotonically_increasing_id()), "votes")
    spark = docs.sparkSession
    table = spark.createDataFrame(
        grams, "k int, hash bigint, template int, label string, place int, runs int, words int, phrase boolean"
    )
    votes = read.select("key", F.explode("votes").alias("v")).select("key", F.col("v.k").alias("k"), F.col("v.hash").alias("hash"), F.col("v.at").alias("at"))
    diagonals = (
        votes.join(F.broadcast(table), ["k", "hash"])
        .groupBy("key", "template", "label", "phrase", "runs", "words", "k", (F.col("at") - F.col("place")).alias("diagonal"))
        .agg(F.count("*").alias("n"), F.min("at").alias("low"), F.max("at").alias("high"), F.collect_set("place").alias("places"))
    )
    whole = diagonals.filter("phrase AND n = runs").select(
        "key", "label", F.col("diagonal").alias("start"), (F.col("diagonal") + F.col("words")).alias("end"), F.lit(1.0).alias("cover"), F.lit(True).alias("phrase")
    )
    # Neighbouring diagonals of a notice in a text; their number is bounded by the text.
    line = Window.partitionBy("key", "template").orderBy("diagonal")
    new = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(line) > APART, F.lit(True)).cast("int")
    merged = (
        diagonals.filter("NOT phrase")
        .withColumn("_new", new)
        .withColumn("_group", F.sum("_new").over(line))
        .groupBy("key", "template", "label", "runs", "k", "_group")
        .agg(
            F.min("low").alias("start"), (F.max("high") + F.first("k")).alias("end"),
            F.size(F.array_distinct(F.flatten(F.collect_list("places")))).alias("covered"),
        )
    )
    cover = F.col("covered") / F.col("runs")
    dense = (F.col("covered") + F.col("k") - 1) / (F.col("end") - F.col("start")) >= LEAST_DENSITY
    parts = merged.filter((cover >= LEAST_COVER) & dense).select("key", "label", "start", "end", cover.alias("cover"), F.lit(False).alias("phrase"))
    return read.select("key", "doc_id", "n_words"), whole.unionByName(parts)


def labelled(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    See ``scan_licenses``. n_base counts the places of phrases, first_word and last_word are
    the smallest and largest of them (NULL without any). Labels are distinct, sorted and joined by
    commas, empty strings without any. score is the best cover of a span, 0.0 without any.
    """
    rows, spans = scan_licenses(docs)
    at = F.when(F.col("phrase"), F.col("start")).cast("bigint")

    def joined(only: bool) -> object:
        return F.array_join(F.sort_array(F.collect_set(F.when(F.col("phrase"), F.col("label")) if only else F.col("label"))), ",")

    found = spans.groupBy("key").agg(
        F.count(at).alias("n_base"), F.min(at).alias("first_word"), F.max(at).alias("last_word"),
        joined(True).alias("base_labels"), joined(False).alias("labels"), F.max("cover").alias("score"),
    )
    return rows.join(found, "key", "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0).cast("bigint")).alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
