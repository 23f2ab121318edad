"""Queries of the numbered operators over the given tables, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.llm import attribution, centroids, chat, collocations, decontaminate, packing, partenum, passages, quality, secrets, sharding, simhash, urls
from tillwise.llm.common import table
from tillwise.llm.oracles import ORACLES


def simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(table(spark, sf_dir, "documents"))


def sharding_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attribution.count_tokens(table(spark, sf_dir, "documents"))


def kk_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack_documents(table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", *[secrets.count_of(F.col("base"), k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
                        F.sha2("base_spans", 256).alias("base_sha256"), "spans")


def chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and -7, whose texts hold control strings; digests are read back from the output."""
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id bigint, turn bigint, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    out = chat.format_conversations(turns).select("conv_id", "valid", "formatted", chat.read_turns(F.col("formatted")).alias("turns"), chat.read_loss(F.col("segments")).alias("loss"))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"),
                      F.sha2("loss", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"), "valid")


def url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages").select("page_id", "url"), table(spark, sf_dir, "labels"))


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assess(table(spark, sf_dir, "documents"))


def collocation_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"))


def ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partenum.similar_sets(table(spark, sf_dir, "documents"))


def centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings")).drop("scans")


QUERIES = {
    "op1_simhash_near_dedup": simhash_near_dedup,
    "op2_substring_dedup": substring_dedup,
    "op3_sharding": sharding_vector,
    "op4_benchmark_decontamination": benchmark_decontamination,
    "op5_token_counts": token_counts,
    "op6_secret_scans": secret_scans,
    "op7_chat_formatting": chat_formatting,
    "op8_url_filters": url_filters,
    "op9_quality_rules": quality_rules,
    "op10_packing": kk_packing,
    "op11_collocation_mining": collocation_mining,
    "op12_ngram_jaccard_join": ngram_jaccard_join,
    "op13_centroid_clustering": centroid_clustering,
}

__all__ = ["ORACLES", "QUERIES"]
