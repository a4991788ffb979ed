"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir), works on all documents that the one before it
kept, and is written as Parquet to the shared folder and read again. All stages but
the last return the columns of ``documents``; the last returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.llm import mixing, pu_quality, quality_rules, shared, simhash_dedup, slack_packing


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the positive-unlabelled classifier predicts to be of quality."""
    return pu_quality.keep_quality(docs, shared.table(spark, sf_dir, "labels"))


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rule nor a risk-controlled cutoff rejects."""
    return quality_rules.keep_good(docs, shared.table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates, the one with the smallest id."""
    return simhash_dedup.keep_first(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose sources, languages and topics have the target weights."""
    return mixing.keep_mixed(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 tokens."""
    return slack_packing.digest(slack_packing.pack_documents(docs))


STAGES = [
    ("quality classifier", quality_classifier),
    ("quality rules", rules),
    ("simhash near-dedup", near_duplicates),
    ("mixing", mix),
    ("packing", packing),
]

#: Classifier, cutoffs, hashes and tokenizer are not SQL; tests hold the pipeline
#: against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = shared.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = shared.written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
