"""The synthetic star schema read as point-of-sale reports.

Mapping (one receipt = one order, one sales line = one lineitem):

* receipt report  : ``orders``  -> receipt_no, date, datetime
* line report     : ``lineitem`` x ``part`` -> receipt_no, product_id (part key as
  text), product_name (raw part name), qty, price (list price), line_total,
  net_total, plus the ingest ordinal ``seq``.

``seq`` is the explicit row order the source system reads implicitly
("first seen", "last wins"): (order key, line number, part key, extended price).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.common import few_rows
from .tables import read_table

MONEY = "decimal(12,2)"
PRICE = "decimal(10,2)"


#: Digits of line number, part key and price in cents inside the ordinal; the order key has the other 15.
_SEQ_DIGITS = (2, 11, 10)


def ingest_ordinal(order: str, line: str, part: str, price: str) -> F.Column:
    """(order, line, part, price) as one fixed-width number in the same order, so that
    its minimum and maximum are hash aggregates."""
    out = F.col(order).cast("decimal(15,0)").cast("decimal(38,0)")
    values = (F.col(line), F.col(part), F.round(F.col(price).cast("decimal(12,2)") * 100))
    for digits, value in zip(_SEQ_DIGITS, values):
        out = (out * F.lit(10 ** digits).cast("decimal(12,0)")).cast("decimal(38,0)") + value.cast("decimal(12,0)")
        out = out.cast("decimal(38,0)")
    return out


def receipt_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Receipt-grain report: one row per receipt with its date and datetime."""
    o = read_table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("receipt_no"),
        F.col("o_orderdate").cast("date").alias("date"),
        F.date_format("o_orderdate", "HH:mm").alias("time"),
        F.col("o_orderdate").alias("datetime"),
    )


def product_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue that lines take their product from: part key, raw product id and name, list price."""
    return read_table(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_partkey").cast("string").alias("product_id"), F.col("p_name").alias("product_name"),
        F.col("p_retailprice").cast(PRICE).alias("price"))


def first_sales(spark: SparkSession, sf_dir: str, products: DataFrame) -> DataFrame:
    """``products`` that were sold, each with the first ingest ordinal of its lines.  The lines are counted down to one
    for each part key first, so two tables of the catalogue's size meet."""
    first = read_table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(
        F.min(ingest_ordinal("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")).alias("seq"))
    return products.join(few_rows(first), F.col("p_partkey") == F.col("l_partkey"), "inner").drop("l_partkey")


def line_report(spark: SparkSession, sf_dir: str, products: DataFrame | None = None) -> DataFrame:
    """Line-grain report: one row per sold line, raw product id and name (or those of ``products``)."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_discount"
    )
    p = product_report(spark, sf_dir) if products is None else products
    # part is the product catalogue: bounded by the number of distinct products,
    # so the planner's own size estimate decides broadcast vs. shuffle.
    j = li.join(p, li.l_partkey == p.p_partkey, "inner")
    line_total = F.col("l_extendedprice").cast(MONEY)
    return j.select(
        F.col("l_orderkey").alias("receipt_no"),
        "product_id",
        "product_name",
        F.col("l_quantity").cast("int").alias("qty"),
        "price",
        line_total.alias("line_total"),
        F.round(line_total * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)")), 2).cast(MONEY).alias("net_total"),
        ingest_ordinal("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice").alias("seq"),
    )
