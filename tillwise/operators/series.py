"""Period series.

Series are long tables ``(key..., period DATE, units DOUBLE)`` with one row
per period; gaps between a series' first and last period are filled with 0 by
exploding a date sequence per series (bounded by the time span, not by rows).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from .common import few_rows


def quarter_end(d: F.Column) -> F.Column:
    """last day of the quarter containing ``d`` (pandas 'QE' label)."""
    return F.last_day(F.add_months(F.trunc(d, "quarter"), 2))


def month_end(d: F.Column) -> F.Column:
    return F.last_day(d)


def next_period_end(d: F.Column, k: F.Column | int, months: int = 3) -> F.Column:
    """the k-th period end after period end ``d``."""
    kk = k if isinstance(k, F.Column) else F.lit(k)
    return F.last_day(F.add_months(d, kk * months))


def gap_fill(counts: DataFrame, keys, months: int = 3) -> DataFrame:
    """Zero rows for empty periods between each series' first and last period."""
    rng = counts.groupBy(*keys).agg(F.min("period").alias("__p0"), F.max("period").alias("__p1"))
    n = (F.months_between(F.col("__p1"), F.col("__p0")) / months).cast("int")
    grid = rng.select(*keys, F.explode(F.sequence(F.lit(0), n)).alias("__i"), "__p0") \
        .select(*keys, F.last_day(F.add_months(F.col("__p0"), F.col("__i") * months)).alias("period"))
    return grid.join(few_rows(counts), [*keys, "period"], "left").select(
        *keys, "period", F.coalesce(F.col("units"), F.lit(0.0)).alias("units"))


def receipt_dates(lines: DataFrame, keys) -> DataFrame:
    """A10: first date per (key, receipt) in ingest order."""
    return lines.groupBy(*keys, "receipt_no").agg(F.min_by("date", "seq").alias("date"))


def period_counts(receipts: DataFrame, keys, months: int = 3) -> DataFrame:
    per = quarter_end(F.col("date")) if months == 3 else month_end(F.col("date"))
    return receipts.filter(F.col("date").isNotNull()).groupBy(*keys, per.alias("period")).agg(
        F.count(F.lit(1)).cast("double").alias("units"))


def product_series(fact: DataFrame, product_ids: DataFrame | None = None, months: int = 3) -> DataFrame:
    """Receipts per period for each product (optionally only the listed
    ones, which are few: they are one value), zero-filled between first and last period."""
    lines = fact
    if product_ids is not None:
        lines = fact.filter(F.array_contains(product_ids.select(F.collect_set("product_id")).scalar(), F.col("product_id")))
    return gap_fill(period_counts(receipt_dates(lines, ["product_id"]), ["product_id"], months), ["product_id"], months)


def bundle_series(bundle_receipts: DataFrame, months: int = 3) -> DataFrame:
    """Receipts containing both products per period, per bundle."""
    return gap_fill(period_counts(bundle_receipts, ["bundle_id"], months), ["bundle_id"], months)


def monthly_series_interpolated(fact: DataFrame) -> DataFrame:
    """Receipts per month over the whole fact, absent months filled with 0,
    then zero months replaced by linear interpolation between neighbours
    (trailing zeros take the last value, leading zeros stay 0)."""
    counts = period_counts(receipt_dates(fact, []).select("receipt_no", "date"), [], months=1) \
        .withColumn("__k", F.lit(1))
    s = gap_fill(counts, ["__k"], months=1)
    w = Window.partitionBy("__k").orderBy("period")
    s = s.withColumn("__i", F.row_number().over(w)).withColumn(
        "__v", F.when(F.col("units") != 0, F.col("units")))
    prev_i = F.last(F.when(F.col("__v").isNotNull(), F.col("__i")), ignorenulls=True).over(
        w.rowsBetween(Window.unboundedPreceding, -1))
    prev_v = F.last("__v", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    next_i = F.first(F.when(F.col("__v").isNotNull(), F.col("__i")), ignorenulls=True).over(
        w.rowsBetween(1, Window.unboundedFollowing))
    next_v = F.first("__v", ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing))
    interp = prev_v + (next_v - prev_v) * (F.col("__i") - prev_i) / (next_i - prev_i)
    filled = (F.when(F.col("__v").isNotNull(), F.col("__v"))
              .when(prev_v.isNotNull() & next_v.isNotNull(), interp)
              .when(prev_v.isNotNull(), prev_v)
              .otherwise(F.lit(0.0)))
    return s.select(F.col("period").alias("month"), F.round(filled, 6).alias("receipts"))


def forecast_index(series: DataFrame, keys, horizon: int = C.HORIZON, months: int = 3) -> DataFrame:
    """T5: the ``horizon`` period ends after the latest actual period of each key
    (over all of its series)."""
    last = series.groupBy(*keys).agg(F.max("period").alias("__last"))
    return last.select(*keys, F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step"), "__last") \
        .select(*keys, "step", next_period_end(F.col("__last"), F.col("step"), months).alias("period"))


def trend_label(series: DataFrame, keys) -> DataFrame:
    """Last vs first value of each series: up / down beyond +-5 %, else flat;
    fewer than two points: no data."""
    agg = series.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.min_by("units", "period").alias("first_value"),
        F.max_by("units", "period").alias("last_value"),
    )
    lab = (F.when(F.col("n") < 2, "No data")
           .when(F.col("last_value") > F.col("first_value") * (1 + C.TREND_BAND), "Upward trend")
           .when(F.col("last_value") < F.col("first_value") * (1 - C.TREND_BAND), "Downward trend")
           .otherwise("Relatively flat trend"))
    return agg.select(*keys, "n", "first_value", "last_value", lab.alias("trend"))


def series_align(series: DataFrame, keys, names=("bundle", "antecedent", "consequent")) -> DataFrame:
    """Align several series of one key on period (pivot of the long table;
    a missing period is null)."""
    return series.groupBy(*keys, "period").pivot("series", list(names)).agg(F.first("units"))
