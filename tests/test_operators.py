"""Cleaning, dimensions, upsert, mining, forecasting and quality on small literal fixtures."""

import datetime as dt
import math

from pyspark.sql import functions as F

from tillwise.operators import baskets as B
from tillwise.operators import cleaning as CL
from tillwise.operators import dimensions as DM
from tillwise.operators import quality as QL
from tillwise.operators.scenario import signed_units
from tillwise.operators.upsert import upsert_merge


def test_numeric_sanity_filter(spark):
    rows = [("-1",), ("0",), ("50000",), ("50000.01",), ("x",)]
    df = spark.createDataFrame([(p, "10:00") for (p,) in rows], "price string, time string")
    assert sorted(r.price for r in CL.numeric_sanity_filter(df).collect()) == ["0", "50000"]
    no_time = spark.createDataFrame([("-1",)], "price string")
    assert CL.numeric_sanity_filter(no_time).count() == 1


def test_drop_blank_and_union(spark):
    a = spark.createDataFrame([("2024-01-01", "10:00", 1), ("abc", "", 2), (None, "1", 3)], "date string, time string, x int")
    assert [r.x for r in CL.drop_blank_datetime(a).collect()] == [1]
    b = spark.createDataFrame([(5, "z")], "x int, y string")
    u = CL.union_align([a, b])
    assert u.columns == ["date", "time", "x", "y"] and u.count() == 4


def test_standardize_first_rule_wins(spark):
    df = spark.createDataFrame([("FDS-2018-0001-MOJOS-BLMW", "whatever"), ("X", " extra egg "), ("Q", "PLAIN")],
                               "product_id string, product_name string")
    got = [(r.product_id, r.product_name) for r in CL.standardize_products(df).orderBy("product_id").collect()]
    assert ("2024smlplates2", "MOJOJOJOS") in got and ("ING-EGG", "EGG") in got and ("Q", "PLAIN") in got


def test_canonical_first_seen(spark):
    df = spark.createDataFrame([("B", "Latte ", 2), ("A", "latte", 1), ("C", "Tea", 3)],
                               "product_id string, product_name string, seq int")
    got = {r.product_name: r.product_id for r in CL.canonical_product_id(df).collect()}
    assert got == {"Latte ": "A", "latte": "A", "Tea": "C"}


def _lines(spark, rows):
    return spark.createDataFrame(
        [(pid, name, price, dt.datetime(2024, 1, d), seq) for (pid, name, price, d, seq) in rows],
        "product_id string, product_name string, price double, datetime timestamp_ntz, seq int")


def test_history_full_vs_incremental(spark):
    full = DM.product_dim_history(_lines(spark, [("P", "LATTE", 1.0, 1, 1), ("P", "LATTE", 2.0, 2, 2), ("P", "LATTE", 1.0, 3, 3)]))
    assert full.count() == 2
    assert [r.is_current for r in full.orderBy("record_version").collect()] == [False, True]
    h = DM.product_dim_history(_lines(spark, [("P", "LATTE", 1.0, 1, 1)]))
    for i, price in enumerate((2.0, 1.0), start=2):
        _, rows = DM.scd_incremental(_lines(spark, [("P", "LATTE", price, i, i)]), h)
        h = upsert_merge(h, rows, ["product_id", "record_version"])
    got = h.orderBy("record_version").collect()
    assert [r.record_version for r in got] == [1, 2, 3]
    assert [r.is_current for r in got] == [False, False, True]


def test_incremental_same_price(spark):
    h = DM.product_dim_history(_lines(spark, [("P", "LATTE", 1.0, 5, 1)]))
    cur, rows = DM.scd_incremental(_lines(spark, [("P", "NEW NAME", 1.0, 3, 2)]), h)
    r = rows.collect()[0]
    assert r.product_name == "LATTE" and r.last_transaction_datetime == dt.datetime(2024, 1, 5)
    assert cur.collect()[0].product_name == "NEW NAME"


def test_upsert_idempotent(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    u = spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string")
    once = upsert_merge(t, u, ["k"])
    twice = upsert_merge(once, u, ["k"])
    assert sorted(once.collect()) == sorted(twice.collect()) == [(1, "a"), (2, "B"), (3, "c")]


def _dim(spark, rows):
    return spark.createDataFrame(rows, "product_id string, product_name string, parent_sku string, category string")


def test_sku_map_last_id_and_unknown(spark):
    dim = _dim(spark, [("1", "HOT X", "X", "DRINK"), ("2", "COLD X", "X", "DRINK"), ("3", "Y", "Y", "FOOD")])
    baskets = spark.createDataFrame([(10, "X"), (10, "Y"), (10, "ZZZ")], "receipt_no long, sku string")
    got = sorted((r.receipt_no, r.item) for r in B.basket_items(baskets, dim).collect())
    assert got == [(10, "2"), (10, "3")]


def test_rules_conviction_and_mirrors(spark):
    dim = _dim(spark, [("a", "A", "A", "FOOD"), ("b", "B", "B", "FOOD"), ("c", "C", "C", "FOOD")])
    rows = [(1, "A"), (1, "B"), (2, "A"), (2, "B"), (3, "A"), (3, "C"), (4, "C")]
    baskets = spark.createDataFrame(rows, "receipt_no long, sku string")
    ri = B.run_items(B.basket_items(baskets, dim), dim, runs=("FOOD",))
    rules = {(r.ant, r.con): r for r in B.pair_rules(ri, 0.1, 0.1, 0.0).collect()}
    assert math.isinf(rules[("b", "a")].conviction)   # every B basket has A
    assert rules[("a", "b")].support == rules[("b", "a")].support
    top = B.bundle_rules(baskets, dim, 0.1, 0.1, 0.0).collect()
    pairs = [frozenset((r.antecedents_names, r.consequents_names)) for r in top]
    assert len(pairs) == len(set(pairs)) and top[0].bundle_id == "BF01"


def test_signed_units(spark):
    df = spark.createDataFrame([(250.0, 100.0), (-250.0, 100.0), (5.0, 0.0)], "i double, p double")
    assert [r[0] for r in df.select(signed_units(F.col("i"), F.col("p"))).collect()] == [2, -3, 0]


def test_outlier_two_flags(spark):
    rows = [(i, 10.0, 10.0) for i in range(20)] + [(100, 1000.0, 10.0), (101, 1000.0, 1000.0)]
    df = spark.createDataFrame(rows, "id int, a double, b double")
    flagged = QL.outlier_flags(df, ("a", "b"))
    kept, removed = QL.outlier_rows_removed(flagged)
    assert [r.id for r in removed.collect()] == [101]
    assert 100 in [r.id for r in kept.collect()]
