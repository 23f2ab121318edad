"""Sinks: upsert, append, replace, per-category export, run publishing (K1-K7).

Tables are plain parquet folders.  An upsert never rewrites in place: it
computes the new table as ``target ⟖ updates`` (anti join + union) and writes
it to a fresh version folder, so a failed write leaves the old version intact
and a rerun with the same batch gives the same result.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping
from graphlib import TopologicalSorter

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Primary keys of the warehouse tables (K2).
TABLE_KEYS = {
    "fact_transaction_dimension": ("receipt_no", "date", "product_id"),
    "current_product_dimension": ("product_id",),
    "history_product_dimension": ("product_id", "record_version"),
    "transaction_records": ("receipt_no",),
    "time_dimension": ("time_id",),
}

#: Child table -> (its column, parent table, the parent's column): keys that must be found in the parent (K3).
FOREIGN_KEYS = {
    "fact_transaction_dimension": (("product_id", "current_product_dimension", "product_id"), ("time_id", "time_dimension", "time_id")),
    "history_product_dimension": (("product_id", "current_product_dimension", "product_id"),),
}


class ForeignKeyError(ValueError):
    """Rows of a table refer to keys that its parent does not have."""


def upsert_merge(target: DataFrame, updates: DataFrame, keys, order_col: str | None = None) -> DataFrame:
    """K1: insert; on key conflict overwrite every non-key column; when the table
    has only key columns a conflict does nothing; with no key it is a plain insert.

    Duplicate keys inside ``updates`` keep the last row by ``order_col``; without
    one, updates that differ under the same key fail the job, as no row is the
    last.  Null-safe key equality, like the warehouse's primary keys."""
    keys = list(keys or [])
    cols = target.columns
    updates = updates.select(*cols)
    if not keys:
        return target.unionByName(updates)
    if order_col and order_col in updates.columns:
        others = [c for c in cols if c not in keys]
        updates = updates.groupBy(*keys).agg(F.max_by(F.struct(*others), F.col(order_col)).alias("__r")) \
            .select(*keys, "__r.*").select(*cols)
    else:
        others = [c for c in cols if c not in keys]
        row = F.struct(*others) if others else F.lit(1)
        one = F.when(F.min(row).eqNullSafe(F.max(row)), F.min(row)).otherwise(
            F.raise_error(F.lit("upsert_merge: rows differ under one key and no order_col is given")))
        updates = updates.groupBy(*keys).agg(one.alias("__r"))
        updates = updates.select(*keys, *(["__r.*"] if others else [])).select(*cols)
    if set(keys) == set(cols):
        return target.unionByName(updates.join(target, keys, "left_anti").select(*cols)).dropDuplicates(keys)
    cond = None
    t, u = target.alias("__t"), updates.select(*keys).alias("__u")
    for k in keys:
        c = F.col(f"__t.{k}").eqNullSafe(F.col(f"__u.{k}"))
        cond = c if cond is None else cond & c
    kept = t.join(u, cond, "left_anti").select(*[F.col(f"__t.{c}") for c in cols])
    return kept.unionByName(updates)


def write_version(df: DataFrame, table_dir: str, partition_by=None, options: Mapping[str, str] | None = None) -> str:
    """Write a table version to ``table_dir/v=<id>`` and return its path.  The
    caller publishes it (K3) only when every table of the run succeeded."""
    path = f"{table_dir.rstrip('/')}/v={uuid.uuid4().hex}"
    w = df.write.mode("error").options(**(options or {}))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def publish_run(spark: SparkSession, manifest_path: str, versions: dict[str, str]) -> DataFrame:
    """K3: publish table versions together by writing one manifest after all of
    them were written (readers resolve tables through the manifest)."""
    rows = [(name, path) for name, path in sorted(versions.items())]
    df = spark.createDataFrame(rows, "table_name string, path string")
    # a folder for each run, never an overwrite: readers always find a whole manifest
    df.coalesce(1).write.json(f"{manifest_path.rstrip('/')}/published_at={time.time_ns():020d}")
    return df


def published_path(spark: SparkSession, manifest_path: str, table: str) -> str | None:
    """Path of a table in the newest manifest that names it (one value)."""
    try:
        m = spark.read.schema("table_name string, path string, published_at string").json(manifest_path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return m.filter(F.col("table_name") == table).select(F.max_by("path", "published_at")).first()[0]


def read_published(spark: SparkSession, manifest_path: str, table: str) -> DataFrame:
    """Resolve a table through a manifest written by :func:`publish_run` or :func:`publish_checked`."""
    from .keyed import read_at
    return read_at(spark, published_path(spark, manifest_path, table))


def publish_order(tables, foreign_keys=FOREIGN_KEYS) -> list[str]:
    """The tables with every parent before its children; a cycle is an error."""
    graph = {t: {parent for _, parent, _ in foreign_keys.get(t, ()) if parent in tables} for t in sorted(tables)}
    return list(TopologicalSorter(graph).static_order())


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Distinct non-null keys of the child that the parent does not have (a null refers to nothing)."""
    keys = child.select(F.col(column).alias("key")).filter("key is not null").distinct()
    return keys.join(parent.select(F.col(parent_column).alias("key")), "key", "left_anti")


def publish_checked(spark: SparkSession, manifest_path: str, versions: Mapping[str, str], changed: Mapping[str, DataFrame] | None = None,
                    foreign_keys=FOREIGN_KEYS) -> DataFrame:
    """K3: check staged tables in the order of their foreign keys, then publish them together.

    A child's keys must be in its parent: the staged one, else the one that is
    published.  `changed` has the rows of a child that are new in this run, where
    only these need to be checked (a parent whose keys never go away).  On a key
    that is not found nothing is published: the manifest stays as it was, and the
    staged folders are kept for a look.  Returns the manifest's rows in the order
    of the check."""
    from .keyed import read_at
    order = publish_order(versions, foreign_keys)
    for child in order:
        for column, parent, parent_column in foreign_keys.get(child, ()):
            path = versions.get(parent) or published_path(spark, manifest_path, parent)
            if path is None:
                raise ForeignKeyError(f"{child}.{column}: {parent} is neither staged nor published")
            rows = (changed or {}).get(child)
            rows = read_at(spark, versions[child]) if rows is None else rows
            if column not in rows.columns:
                continue
            lost = orphans(rows, column, read_at(spark, path), parent_column)
            found = lost.agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("first")).first()
            if found["n"]:
                raise ForeignKeyError(f"{child}.{column}: {found['n']} keys are not in {parent}, such as {found['first']!r}; staged: {versions[child]}")
    publish_run(spark, manifest_path, dict(versions))
    return spark.createDataFrame([(i, t, versions[t]) for i, t in enumerate(order)], "position int, table_name string, path string")


def append_table(df: DataFrame, path: str) -> None:
    """K4/K7: append rows (header/schema written once by the format)."""
    df.write.mode("append").parquet(path)


def replace_table(df: DataFrame, path: str) -> None:
    """K5: truncate-and-reload a result table."""
    df.write.mode("overwrite").parquet(path)


def export_by_category(df: DataFrame, path: str, category_col: str = "category") -> None:
    """CSV export, one folder per category."""
    df.write.mode("overwrite").partitionBy(category_col).option("header", True).csv(path)
