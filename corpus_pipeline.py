"""From raw documents to token ids in five stages, each written and read again.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a
DataFrame, which the next one gets as its docs. All but the last keep the columns of
documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketide.llm import bpe, exact, jaccard, langid, mixing
from marketide.llm.queries import RANKS, held_out
from marketide.llm.packed import scratch
from marketide.llm.tables import free_names, read

#: Below this score a text's n-grams are unlike those of every language learned.
LEAST_SCORE = 0.2
#: Passes over a source at most.
REPEATS = 2.0


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that is known; a missing lang is filled in."""
    lang, score = free_names(docs, "found_lang", "found_score")
    found = langid.annotate(docs, langid.profiles(docs.where(~held_out(4, 2))), (lang, score))
    stay = found.where((F.col(lang) != langid.UNKNOWN) & (F.col(score) >= LEAST_SCORE))
    return stay.withColumn("lang", F.coalesce(F.col("lang").cast("string"), F.col(lang))).select(docs.columns)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of equal texts: the one with the smallest doc_id."""
    return exact.drop_exact(docs)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near duplicates (five words, similarity 0.8)."""
    return jaccard.one_of_each(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once, and those of sources below their weight once more, as far as the budget goes."""
    return mixing.mixed_documents(docs, repeats=REPEATS)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded bytes, one row per draw of a document."""
    return bpe.round_trip(docs, public_tokenizers.path(RANKS))


STAGES = [
    ("language_id", known_language),
    ("exact_dedup", exact_dedup),
    ("ngram_jaccard", ngram_jaccard),
    ("source_mix", source_mix),
    ("byte_bpe", byte_bpe),
]

#: Profiles, components and encoding are beyond SQL; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
