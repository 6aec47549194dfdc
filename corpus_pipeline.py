"""From documents to token ids: language, near duplicates, mix, encoding."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayflow.llm import bpe, jaccard_join, langid, mixing
from stayflow.llm.store import new_folder

#: A text of at least LONG characters is dropped if its cosine to the nearest language is under
#: LEAST_COSINE. A shorter one has too few n-grams to tell, so it stays.
LONG, LEAST_COSINE = 200, 0.1


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop texts without a letter (NULL and empty ones too) and texts like no language.

    If no row has both a text and a language there is nothing to compare with, and only the
    first rule holds. Repeated rows are judged each; an empty table stays empty.
    """
    profiles = langid.learn(docs)
    found = "found"
    while found in docs.columns:
        found += "_"
    seen = docs.withColumn(found, langid.detected(profiles, F.col("text")))
    if profiles.languages:
        stays = (F.col(found)["lang_pred"] != langid.UNKNOWN) & (
            (F.length("text") < LONG) | (F.col(found)["score"] >= LEAST_COSINE)
        )
    else:
        stays = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    return seen.where(stays).drop(found)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the least id.

    NULL ids come last; NULL and blank texts stay; of equal rows one stays; an empty table stays empty.
    """
    return jaccard_join.one_of_each(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it.

    NULL sources are a source; texts without words are taken like others, at most three times;
    repeated rows are taken each; an empty table stays empty.
    """
    return mixing.mixed_rows(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each row of the mix, decoded again to prove them; NULL and empty texts have none."""
    vocabulary = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.token_rows(docs, vocabulary, public_tokenizers.PATTERN)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("source_mix", source_mix),
    ("encode", encode),
]

#: SQL expresses neither the profiles nor the byte pairs; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written to the shared folder and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        folder = new_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return STAGES[-1][1](spark, docs, sf_dir)
