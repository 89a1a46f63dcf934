"""From documents to training sequences: language, exact copies, near copies, mixing, packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from veritab.llm import exact_dedup, language, mixing, ngram_join, packing
from veritab.llm.common import stored

#: Near copies share 80 of 100 shingles of five words at least.
SHINGLE_WORDS, PERCENT = 5, 80


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or that are like none of the declared languages, are rejected."""
    return language.keep_known_languages(docs, language.fit_text_model(docs), in_files=True)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z in lower case) the one with the largest doc_id stays."""
    return exact_dedup.drop_exact_duplicates(docs, in_files=True)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the least doc_id stays."""
    return ngram_join.drop_near_duplicates(docs, words=SHINGLE_WORDS, percent=PERCENT, in_files=True)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 tokens, with their ids."""
    return packing.pack(docs, public_tokenizers.path(packing.VOCABULARY))


STAGES = [("language_id", language_id), ("exact_dedup", exact_copies), ("near_dedup", near_copies), ("mixing", mix), ("packing", pack)]

#: A trained model and a tokenizer decide here, which SQL cannot express; tests hold it against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another over ``documents``, each written and read again."""
    out = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        out = stored(stage(spark, out, sf_dir), f"stage-{name}")
    return out
