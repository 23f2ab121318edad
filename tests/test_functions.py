"""Scalar rules on literal cases (FIXTURES.md §3)."""

from pyspark.sql import functions as F

from tillwise.functions.products import cost_match_score, normalize_drink_name, parent_sku, product_category
from tillwise.functions.text import bundle_part, cap, slugify, takeout_flag, time_id, to_snake_case


def _one(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_parent_sku(spark):
    names = ["ICED MATCHA LATTE 12 OZ.", "LATTE 120Z", "HOT 8OZ", "COMBO MEAL 2", "", None, "cold widget"]
    got = _one(spark, [(n,) for n in names], "n string", parent_sku(F.col("n")))
    assert got == ["MATCHA-LATTE", "LATTE", "HOT-8OZ", "COMBO-MEAL", "", "", "WIDGET"]


def test_category(spark):
    rows = [("PHONE CHARGING", "X"), ("TAKE AWAY BOX", "X"), ("STEAK", "X"), ("EXTRA EGG", "X"),
            ("EGGS BENEDICT", "X"), ("BOTTLED WATER", "X"), ("ICED TEA", "X"), ("CAKE", "DKS-1")]
    got = _one(spark, rows, "n string, i string", product_category(F.col("n"), F.col("i")))
    assert got == ["OTHERS", "OTHERS", "FOOD", "EXTRA", "FOOD", "EXTRA", "DRINK", "DRINK"]


def test_time_id(spark):
    got = _one(spark, [(t,) for t in ["13:24", "1324", "9:05", "13:24:00", "x", None]], "t string", time_id(F.col("t")))
    assert got == ["H13M24", "H13M24", "H09M05", None, None, None]


def test_takeout(spark):
    got = _one(spark, [(v,) for v in [" y ", "", None, "N"]], "v string", takeout_flag(F.col("v")))
    assert got == ["True", "False", "False", "N"]


def test_text_helpers(spark):
    got = _one(spark, [("A + B",), ("A + B + C",)], "s string", bundle_part(F.col("s"), 1))
    assert got == ["B", None]
    assert _one(spark, [("abcdef",)], "s string", cap(F.col("s"), 4)) == ["abc…"]
    assert _one(spark, [("Hot / Iced  #1",)], "s string", slugify(F.col("s"))) == ["Hot-Iced-1"]
    assert to_snake_case("Receipt No") == "receipt_no" and to_snake_case("LineTotal") == "line_total"


def test_cost_match_score(spark):
    rows = [("HOT CARAMEL LATTE 12OZ", "HOT CARAMEL LATTE 12 OZ"), ("ICED MOCHA", "ICED MOCHA 16OZ"), ("TEA", "TEA")]
    df = spark.createDataFrame(rows, "p string, s string")
    got = [r[0] for r in df.select(cost_match_score(normalize_drink_name(F.col("p")), normalize_drink_name(F.col("s")))).collect()]
    assert got == [4, 3, 0]
