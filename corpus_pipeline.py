"""Pipeline over `documents`: quality rules, near-dedup, decontamination, secret masking, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the one before
kept; `run` writes each stage's result below the shared checkpoint folder and
reads it back for the next one.  Packing returns pieces of token sequences, the
others documents with their columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.llm import decontaminate, packing, quality, secrets, simhash
from tillwise.llm.common import table, written


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.keep_good(docs)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: 4-word shingles, 4 bits."""
    return simhash.keep_one(docs, shingle=4, max_bits=4)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked and `n_chars` counted anew."""
    return secrets.mask_secrets(docs).withColumn("n_chars", F.length("text").cast("long"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in token sequences."""
    return packing.pack_documents(docs)


STAGES = [("quality_rules", good), ("simhash_near_dedup", distinct), ("benchmark_decontamination", clean), ("secret_scans", masked), ("packing", packed)]

#: Fingerprints, BM25 search and differencing have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
