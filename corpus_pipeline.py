"""The corpus pipeline: documents to token ids in five stages.

Each stage is a function of (spark, docs, sf_dir) and works on all rows that
its predecessor kept; ``run`` writes each stage's result to the shared folder
and reads it again as the next one's input, so that a lost executor costs a
re-read and not the stages before. All stages but the last return the columns
of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardrisk.llm import bpe, lsh_forest, mixture, quality_crf, secret_scan
from cardrisk.llm.common import table
from cardrisk.llm.queries import MIX_WEIGHTS, mix_domain, vocabulary_path
from cardrisk.sources.storage import materialize

SHINGLE_WORDS = 5
SIMILAR_PERCENT = 80
MIX_SHARE = 0.9      # of all tokens, taken at most once each


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the line labels reject go."""
    chain = quality_crf.train_chain(spark, docs, table(spark, sf_dir, "labels"))
    return quality_crf.keep_documents(spark, docs, chain)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return lsh_forest.keep_one_of_each(spark, docs, SHINGLE_WORDS, SIMILAR_PERCENT)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Found secrets are replaced by a mark; no document goes."""
    return secret_scan.redact_secrets(spark, docs, vocabulary_path(), public_tokenizers.PATTERN)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are cut to their share of the token budget, none repeated."""
    mixed = mixture.mix(spark, docs, mix_domain(), F.col("all_tokens") * MIX_SHARE, MIX_WEIGHTS, max_epochs=1)
    return mixed.select(*docs.columns)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the check that they decode to its text."""
    return bpe.tokenize_documents(spark, docs, vocabulary_path(), public_tokenizers.PATTERN)


STAGES = [
    ("quality rules", quality),
    ("near-duplicates", near_duplicates),
    ("secret scan", secrets),
    ("source mixing", mixing),
    ("token ids", encoding),
]

# A trained chain, MinHash candidates and byte-pair merges have no SQL form;
# tests hold every stage against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(spark, docs, "stage-" + name.replace(" ", "-"))
    return docs
