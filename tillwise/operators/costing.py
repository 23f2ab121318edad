"""Costing match (J16, F8, F9): product names against costing sheets by score.

A sheet can reach the accepted score only by holding the whole normalised name,
or by a shared size together with a shared temperature.  Names and sheets meet
by an equi-join on the name's length and text among the sheet name's substrings.
By size and temperature alone all sheets of a class score the same, so only the
first in order can win: one sheet stands for each of the (at most six) classes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.products import cost_match_score, normalize_drink_name
from .common import fixed_broadcast


def _temperature(name: F.Column, product: bool) -> F.Column:
    hot = F.when(name.contains("HOT"), F.lit("HOT"))
    cold = F.when((name.contains("ICED") | name.contains("COLD")) if product else name.contains("ICED"), F.lit("ICED"))
    return F.array_compact(F.array(hot, cold))


def _sizes(name: F.Column) -> F.Column:
    return F.array_compact(F.array(*[F.when(name.contains(s), F.lit(s)) for s in C.COST_MATCH_SIZES]))


def fuzzy_cost_match(products: DataFrame, sheets: DataFrame, min_score: int = C.COST_MATCH_MIN_SCORE) -> DataFrame:
    """(product_name, sheet, total_cost, score): each name's best sheet, the first in sheet order among equals."""
    p = products.select("product_name").distinct().withColumn("pn", normalize_drink_name(F.col("product_name")))
    s = sheets.select("sheet", "sheet_order", F.col("total_cost").cast("double").alias("total_cost"), normalize_drink_name(F.col("sheet")).alias("sn"))
    n = F.length("pn")
    # substrings of a sheet name of every length that a product name has: bounded by the square of a sheet name's length
    lengths = p.filter(n >= C.COST_MATCH_MIN_NAME_LEN).select(n.alias("len")).distinct()
    parts = s.join(lengths, F.length("sn") >= F.col("len")).select("sheet", F.explode(F.sequence(F.lit(1), F.length("sn") - F.col("len") + 1)).alias("at"), "len", "sn") \
        .select("sheet", F.substring(F.col("sn"), F.col("at"), F.col("len")).alias("pn")).distinct()
    by_name = p.join(parts, "pn").select("product_name", "sheet")
    pt = p.select("product_name", F.explode(_sizes(F.col("pn"))).alias("size"), F.col("pn")).select("product_name", "size", F.explode(_temperature(F.col("pn"), True)).alias("temp"))
    st = s.select("sheet", "sheet_order", F.explode(_sizes(F.col("sn"))).alias("size"), F.col("sn")).withColumn("temp", F.explode(_temperature(F.col("sn"), False)))
    st = fixed_broadcast(st.groupBy("size", "temp").agg(F.min_by("sheet", "sheet_order").alias("sheet")))
    met = by_name.unionByName(pt.join(st, ["size", "temp"]).select("product_name", "sheet")).distinct()
    scored = met.join(p, "product_name").join(s, "sheet").withColumn("score", cost_match_score(F.col("pn"), F.col("sn"))).filter(F.col("score") >= min_score)
    return scored.groupBy("product_name").agg(F.max_by(F.struct("sheet", "total_cost", "score"), F.struct("score", -F.col("sheet_order"))).alias("b")).select("product_name", "b.*")
