"""Sales summaries and KPI views.

All are single hash aggregations over the fact (partial aggregation before
the shuffle) joined to the catalogue-sized product dimension, which is
broadcast after a size check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


MONEY_OUT = "double"


def _money(c: F.Column) -> F.Column:
    """Exact decimal sum rendered as double (identical on every engine)."""
    return c.cast(MONEY_OUT)


def period_start(date: F.Column, unit: str) -> F.Column:
    """start of the calendar period containing ``date``."""
    return F.trunc(date, {"day": "DD", "month": "MM", "quarter": "QUARTER", "year": "YEAR"}[unit]) \
        if unit != "day" else date


def sales_by_period(fact: DataFrame, unit: str) -> DataFrame:
    """A1: revenue (sum of net totals) per day / month / quarter / year."""
    if unit == "year":
        key = F.year("date").alias("year")
    else:
        key = period_start(F.col("date"), unit).alias(unit if unit != "day" else "date")
    return fact.groupBy(key).agg(_money(F.sum("net_total")).alias("revenue"))


def monthly_count_revenue(fact: DataFrame) -> DataFrame:
    """A2: lines (not receipts) and revenue per month."""
    return fact.groupBy(period_start(F.col("date"), "month").alias("month")).agg(
        F.count(F.lit(1)).alias("n_lines"), _money(F.sum("net_total")).alias("revenue")
    )


def kpi_daily_summary(fact: DataFrame) -> DataFrame:
    """A3: per day: month/quarter/year keys, revenue, distinct receipts."""
    return fact.groupBy("date").agg(
        _money(F.sum("net_total")).alias("total_revenue"),
        F.count_distinct("receipt_no").alias("total_transactions"),
    ).select(
        "date",
        period_start(F.col("date"), "month").alias("month"),
        period_start(F.col("date"), "quarter").alias("quarter"),
        period_start(F.col("date"), "year").alias("year"),
        "total_revenue", "total_transactions",
    )


def fact_with_dim(fact: DataFrame, dim: DataFrame, how: str = "inner") -> DataFrame:
    """Fact joined to the current product dimension on product id."""
    d = dim.select(F.col("product_id").alias("__dim_pid"), F.col("category"), F.col("parent_sku"))
    return fact.join(d, fact.product_id == F.col("__dim_pid"), how).drop("__dim_pid")


def kpi_category_sales(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """A4: revenue per category (line totals, as the KPI view; net totals, as
    the chart) and each category's share of the net total."""
    agg = fact_with_dim(fact, dim).groupBy("category").agg(
        _money(F.sum("line_total")).alias("total_revenue"),
        _money(F.sum("net_total")).alias("net_revenue"),
    )
    total = agg.select(F.sum("net_revenue")).scalar()
    return agg.withColumn("revenue_share", F.round(F.col("net_revenue") / total, 6))


def kpi_product_sales(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """A5: quantity and revenue per product and category (inner join, J3)."""
    d = dim.select(F.col("product_id").alias("__dim_pid"), F.col("product_name").alias("dim_name"), "category")
    j = fact.join(d, fact.product_id == F.col("__dim_pid"), "inner")
    return j.groupBy(F.col("product_id"), F.col("dim_name").alias("product_name"), "category").agg(
        F.sum("qty").cast("bigint").alias("total_quantity_sold"),
        _money(F.sum("line_total")).alias("total_revenue"),
    )


def monthly_demand(fact: DataFrame, drop_last: bool = True) -> DataFrame:
    """A6 + T4: distinct receipts per month; the last month is dropped."""
    m = fact.groupBy(period_start(F.col("date"), "month").alias("month")).agg(
        F.count_distinct("receipt_no").alias("receipts")
    )
    if drop_last:
        last = m.select(F.max("month")).scalar()
        m = m.filter(F.col("month") < last)
    return m


def top_products(fact: DataFrame, dim: DataFrame, metric: str = "revenue", n: int = 10,
                 categories=("FOOD", "DRINK")) -> DataFrame:
    """Top-n products per category by revenue (net) or quantity.  Ties are
    broken by name so the ranking is total."""
    value = F.sum("net_total") if metric == "revenue" else F.sum("qty")
    j = fact_with_dim(fact, dim, "left").filter(F.col("category").isin(*categories))
    agg = j.groupBy("category", "product_name").agg(value.alias("__v"))
    w = Window.partitionBy("category").orderBy(F.col("__v").desc(), F.col("product_name"))
    out = agg.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)
    col = "revenue" if metric == "revenue" else "quantity"
    cast = "double" if metric == "revenue" else "bigint"
    return out.select("category", "rank", "product_name", F.col("__v").cast(cast).alias(col))
