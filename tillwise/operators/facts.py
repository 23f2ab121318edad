"""Fact building: header x lines join, dedups, baskets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .cleaning import require_columns


def dedup_keep_first(df: DataFrame, keys, seq_col: str = "seq") -> DataFrame:
    """One row per key, the first in ingest order; a frame without one of the
    key columns is left as it is (a part of the key would merge other rows).

    Expressed as ``min_by(struct(row), seq)`` per key, combined before the shuffle,
    so a hot key collapses there (a row_number window would pull the whole hot key
    into one task).  Spark plans it as a sort aggregate, as it carries whole rows."""
    keys = list(keys)
    if not set(keys) <= set(df.columns):
        return df
    others = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(F.min_by(F.struct(*others), F.col(seq_col)).alias("__row"))
        .select(*keys, "__row.*")
        .select(*df.columns)
    )


def dedup_keep_last(df: DataFrame, keys, seq_col: str = "seq") -> DataFrame:
    """One row per key, the last in ingest order (upsert semantics)."""
    keys = list(keys)
    require_columns(df, keys, "dedup_keep_last")
    others = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(F.max_by(F.struct(*others), F.col(seq_col)).alias("__row"))
        .select(*keys, "__row.*")
        .select(*df.columns)
    )


def distinct_rows(df: DataFrame, seq_col: str = "seq", last_col: str | None = None) -> DataFrame:
    """Full-row distinct, ignoring the ingest ordinal: ``seq`` keeps the first
    position of the duplicates and, when ``last_col`` is given, that column
    keeps the last one (so "first seen" and "last wins" rules still hold)."""
    if seq_col not in df.columns:
        return df.distinct()
    cols = [c for c in df.columns if c not in (seq_col, last_col)]
    aggs = [F.min(seq_col).alias(seq_col)]
    if last_col:
        src = last_col if last_col in df.columns else seq_col
        aggs.append(F.max(src).alias(last_col))
    out = df.groupBy(*cols).agg(*aggs)
    return out.select(*df.columns, *([last_col] if last_col and last_col not in df.columns else []))


def join_header_lines(header: DataFrame, lines: DataFrame, key: str = "receipt_no", by=()) -> DataFrame:
    """Inner join of receipt header and line items on the receipt number (and on columns `by` that it
    determines, by which both sides may be dealt).

    Columns present on both sides keep the header's value; the line side's
    copy is dropped (``Date_product`` and friends never reach the fact)."""
    keys = [key, *by]
    dup = [c for c in lines.columns if c in header.columns and c not in keys]
    right = lines.drop(*dup)
    return header.join(right, keys, "inner")


def dedup_report(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows before / after a dedup and the count removed (one aggregate row;
    the second count is a scalar subquery)."""
    n_after = after.select(F.count(F.lit(1))).scalar()
    return (
        before.agg(F.count(F.lit(1)).alias("rows_before"))
        .select("rows_before", n_after.alias("rows_after"))
        .withColumn("rows_removed", F.col("rows_before") - F.col("rows_after"))
    )


def basket_lines(lines: DataFrame, current_dim: DataFrame, by=()) -> DataFrame:
    """A7 (long form): (receipt_no, sku, seq), and the columns `by` that a receipt determines — SKU is the product's parent SKU,
    falling back to the product id.  ``lines`` is the distinct fact projection
    *including* the latest month.  Mining consumes this long form; the
    comma-joined string exists only at the sink (``transaction_records``)."""
    skus = current_dim.select(F.col("product_id").alias("__pid"), F.col("parent_sku").alias("__psku"))
    j = lines.join(skus, F.col("product_id") == F.col("__pid"), "left")
    return j.select("receipt_no", F.coalesce(F.col("__psku"), F.col("product_id")).alias("sku"), "seq", *by)


def transaction_records(basket: DataFrame, by=()) -> DataFrame:
    """A7 sink form: one row per receipt, SKUs comma-joined in line order.  `by` names columns that a receipt
    determines: a basket dealt by them is not shuffled."""
    return basket.groupBy("receipt_no", *by).agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("seq", "sku"))), lambda x: x["sku"]), ","
        ).alias("sku")
    )
