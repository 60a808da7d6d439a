"""From raw documents to shards: language, near-duplicates, benchmark passages, mix, shards.

Every stage reads all that the stage before it kept and returns the columns of documents;
the last adds size, shard and slot. Stages are joined by Parquet tables in the shared folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfloom.llm.common import free_name
from shelfloom.llm.common import load as load_table
from shelfloom.llm.decontam import clean_documents
from shelfloom.llm.language import UNKNOWN, tag_languages, train_tagger
from shelfloom.llm.mixing import mixed_documents
from shelfloom.llm.near_dup import deduplicated
from shelfloom.llm.sharding import kd_shards
from shelfloom.sources.scratch import materialize

SHARDS = 16


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language: those without a text or without a letter go.

    The tagger learns from a bounded sample of the rows that have a lang. Where there is
    none, it can tell nothing, and every document with a letter stays. Neither the predicted
    language nor its score decides about a row.
    """
    tagger = train_tagger(docs)
    lang = free_name(docs, "lang_pred")
    if tagger is None:
        return docs.filter(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    return tag_languages(docs, tagger, lang).filter(F.col(lang) != UNKNOWN).select(*docs.columns)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest doc_id."""
    return deduplicated(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    return clean_documents(docs, load_table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixed_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with size, shard and slot."""
    return kd_shards(docs, shards=SHARDS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", identify_language),
    ("near_duplicates", remove_near_duplicates),
    ("benchmark", remove_benchmark),
    ("mix", mix),
    ("shard", shard),
]

#: The language model is no SQL; tests/llm/test_pipeline.py runs all stages against plain versions on a small fixture.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load_table(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
