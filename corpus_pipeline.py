"""A corpus pipeline: from raw documents to token ids.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written to
the shared folder and read again as the next stage's documents.
"""

from __future__ import annotations


import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from pricewright.llm.bpe import bpe_round_trip
from pricewright.llm.common import discard, documents, stored
from pricewright.llm.language_id import in_test_fold, with_language
from pricewright.llm.line_dedup import remove_shared_blocks
from pricewright.llm.mixing import mixed_documents
from pricewright.llm.ngram_join import first_of_each

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
#: Below this share of its main language a document is rejected.
LEAST_LANGUAGE_SCORE = 0.4


def _counted(docs: DataFrame, names: list[str]) -> DataFrame:
    """The columns of documents, with n_chars of the present text."""
    if "n_chars" in names:
        docs = docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return docs.select(*names)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a recognised language; a missing lang is filled in."""
    train = docs.where(~in_test_fold()).select("text", "lang")
    out = with_language(docs, train)
    out = out.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_LANGUAGE_SCORE))
    return out.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*docs.columns)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the blocks an earlier one holds; those left empty go."""
    out = remove_shared_blocks(docs)
    return _counted(out.where((F.col("n_removed") == 0) | (F.trim("text") != "")), docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return first_of_each(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to their target weights; a document may be there in part or twice."""
    return mixed_documents(docs)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, digests of ids and decoded text, token_ids."""
    return bpe_round_trip(docs, VOCABULARY, keep_ids=True)


STAGES = [
    ("language identification", language_stage),
    ("line deduplication", line_stage),
    ("near duplicates", near_duplicate_stage),
    ("source mixing", mixing_stage),
    ("encoding", encoding_stage),
]

#: Learned models and permutations have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        before, docs = docs, stored(stage(spark, docs, sf_dir), f"stage-{k}")
        if k:
            discard(before)
    return docs
