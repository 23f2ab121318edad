"""Parquet table scans (S4).  Column pruning and filter pushdown are left to
Catalyst: callers select what they need and the scan reads only that."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Full-table read; projection/filters applied later reach the scan."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def table_bytes(spark: SparkSession, sf_dir: str, name: str) -> int:
    """Bytes of a table's files, asked of the path's own file system."""
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return path.getFileSystem(sc._jsc.hadoopConfiguration()).getContentSummary(path).getLength()
