"""From raw documents to packed sequences: five stages, each over all the one before kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read again as the next one's documents. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contactloom.llm.catalog import table
from contactloom.llm.decontaminate import without_passages
from contactloom.llm.near import keep_one
from contactloom.llm.packing import pack
from contactloom.llm.passages import remove_repeats
from contactloom.llm.quality import keep_good
from contactloom.llm.store import written

SEQUENCE_TOKENS, END_ID = 4096, 2


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the certified cutoffs."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a similarity of 0.8 of five-word shingles."""
    return keep_one(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated passages; one that is nothing else goes."""
    left = remove_repeats(docs).where("n_removed = 0 OR n_removed < n_words")
    changed = F.col("n_removed") > 0
    return left.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(
        F.col("n_chars"))).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of a benchmark item."""
    return without_passages(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in sequences of 4096 tokens."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"), END_ID, SEQUENCE_TOKENS)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

# Signatures, automata and tokenizers have no SQL counterpart; the tests hold every stage
# against a plain Python version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
