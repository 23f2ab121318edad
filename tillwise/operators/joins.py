"""Range-overlap join of per-file date ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def file_ranges(df: DataFrame, file_col: str = "file", date_col: str = "date") -> DataFrame:
    """Per-file min/max of the valid dates."""
    return df.filter(F.col(date_col).isNotNull()).groupBy(file_col).agg(
        F.min(date_col).alias("min_date"), F.max(date_col).alias("max_date"))


def file_overlap(df: DataFrame, file_col: str = "file", date_col: str = "date") -> DataFrame:
    """Pairs of files whose date ranges overlap (touching ends count), with
    the overlap period.  The range table has one row per file; the theta join
    runs over it month by month, never over the rows."""
    r = file_ranges(df, file_col, date_col)
    # each file is entered under every month it spans; an overlapping pair is kept in the first month both have
    month = F.explode(F.sequence(F.trunc("min_date", "MM"), F.trunc("max_date", "MM"), F.expr("interval 1 month")))
    m = r.withColumn("month", month)
    a, b = m.alias("a"), m.alias("b")
    j = a.join(b, (F.col("a.month") == F.col("b.month")) & (F.col(f"a.{file_col}") < F.col(f"b.{file_col}"))
               & (F.col("a.min_date") <= F.col("b.max_date")) & (F.col("b.min_date") <= F.col("a.max_date"))
               & (F.col("a.month") == F.trunc(F.greatest("a.min_date", "b.min_date"), "MM")))
    return j.select(F.col(f"a.{file_col}").alias("file_a"), F.col(f"b.{file_col}").alias("file_b"),
                    F.greatest("a.min_date", "b.min_date").alias("overlap_start"),
                    F.least("a.max_date", "b.max_date").alias("overlap_end"))
