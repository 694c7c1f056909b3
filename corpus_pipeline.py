"""Corpus pipeline: quality classifier, language ID, SimHash near-dedup, best-fit packing.

Every stage takes (spark, docs, sf_dir) and works on all rows that the stage before kept. The first three
return rows of ``docs`` with its columns; the last returns the packed pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm import langid, packing, quality, simhash_dedup
from touchline.llm.common import id_bucket, materialise, table

#: A text whose out-of-place score with its nearest language is below this is in no learned language.
LEAST_LANGUAGE_SCORE = 0.2


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score at least 0.7; learned as in ``op1_ftrl_quality``, from the same rows."""
    labels = table(spark, sf_dir, "labels").filter(id_bucket(F.col("doc_id"), 4) != 2)
    weights = quality.train(quality.labelled_documents(docs.select("doc_id", "text"), labels))
    return quality.keep_good(docs, weights)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is in a language learned from the training rows of ``docs``; those without a
    letter, or far from every language, go."""
    found = langid.profiles(docs.filter(id_bucket(F.col("doc_id"), 3) != 1).select("text", "lang"))
    return langid.keep_languages(docs, found, least_score=LEAST_LANGUAGE_SCORE)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id."""
    return simhash_dedup.deduplicate(docs, distance=4, shingle=4)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, placed in sequences of at most 2048 tokens."""
    return packing.pack(docs.select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality classifier", quality_stage), ("language id", language_stage), ("simhash near-dedup", dedup_stage),
          ("best-fit packing", packing_stage)]

#: Neither the classifier nor the fingerprints can be expressed in SQL; tests hold the stages against
#: brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
