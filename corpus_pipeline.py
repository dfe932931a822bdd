"""A corpus pipeline over ``documents``: language ID, quality rules, SimHash
near-duplicates, mixing to target weights, byte-level BPE.

Each stage is a function (spark, docs, sf_dir) -> DataFrame. A stage's result is
written as Parquet under ``spark.checkpoint.dir`` and read again as the next one's
documents; so a lost executor costs the running stage's tasks only.
All stages but the last return the columns of their input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fareline.llm import bpe, langid, mixing, quality, simhash
from fareline.llm.common import read, written


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a letter go on, nearly all: the posterior over the learned languages is close to 1 for any text
    of a few words, so texts in no learned language and letter noise pass too."""
    return langid.keep_known(docs)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: 3-word shingles, 2 bits."""
    return simhash.keep_first(docs, simhash.SHINGLE, simhash.MAX_DISTANCE)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them."""
    return mixing.mix(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of every document that came this far, with the digests of ids and decoded text."""
    return bpe.bpe_report(docs)


STAGES = [
    ("language_id", language_id),
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("mix_sources", mix_sources),
    ("tokenize", tokenize),
]

# The learned, hashed and tokenizing stages have no SQL form; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
