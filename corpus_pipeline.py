"""From raw documents to packed training sequences.

Each stage takes ``(spark, docs, sf_dir)`` and returns the rows it keeps, all but the
last with the columns of ``documents``. Null and empty texts are rejected by the first
stage; an empty table passes through all stages; equal rows are near-duplicates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import language, minhash, packing, pii, quality_rules
from ledgerloom.llm.common import configure, table, written

# Every language is welcome; a lower score than this means that none was told.
LEAST_LANGUAGE_SCORE = 0.2

# Sampling, training and iterating stages: no SQL twin; tested against brute force.
ORACLE_SQL = None


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass all quality rules."""
    rules = quality_rules.cascade(quality_rules.profile(docs))
    return quality_rules.keep(docs, rules)


def keep_told(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; all that have a letter if no labelled row is there to learn from."""
    configure(spark)
    return language.keep(docs, language.fit(docs), LEAST_LANGUAGE_SCORE)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, on shingles of five words."""
    configure(spark)
    return minhash.keep_one(docs, words=5)


def mask_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents with personal data masked, and their new length."""
    configure(spark)
    masked = pii.mask(docs, pii.fit())
    return masked.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents with their texts and places in the sequences."""
    configure(spark)
    return packing.pack(docs, with_text=True)


STAGES = [
    ("quality rules", keep_good),
    ("language identification", keep_told),
    ("near-duplicates", keep_one_of_each),
    ("personal data", mask_personal),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is a written table for the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
