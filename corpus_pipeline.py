"""Corpus pipeline: each stage takes what the one before kept, as documents, and returns a DataFrame.

Toxic documents go, then exact copies, then near copies (five-word shingles, 0.8 or more in common;
one document of each group stays), then passages of 50 words or more that a document with a smaller
id also has; what is left is packed into batches by its number of tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.llm import exact, packing, simhash, substrings, token_counts, toxicity
from wattline.llm.common import stored, sweep, table
from wattline.llm.queries import tokenizer_file


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    sweep(spark)
    return exact.drop_exact_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    sweep(spark)
    return simhash.drop_near_copies(docs)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    sweep(spark)
    return substrings.drop_repeats(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    sweep(spark)
    counted = token_counts.token_counts(docs, tokenizer_file("byte_bpe_50k.json"))
    return packing.pack(counted, F.col("n_tokens"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("substring_dedup", drop_repeats),
    ("packing", pack),
]
#: Learned scores, fingerprints and spliced texts have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
