"""Joins of small tables: as broadcasts keyed by text, each took a memory page (up to 64 MB) on the driver, however few its rows."""

import datetime as dt
import re

from pyspark.sql import functions as F

from tests.conftest import SF
from tillwise.operators import baskets as B
from tillwise.operators import cleaning as CL
from tillwise.operators import elasticity as EL
from tillwise.operators import pricing as PR
from tillwise.operators import scenario as SC
from tillwise.operators import series as S
from tillwise.plans.warehouse import Warehouse
from tillwise.sources.pos import line_report


def _broadcast_keys(df) -> set:
    """Columns that the plan, as it ran, joins by broadcast."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return set(re.findall(r"(\w+)#\d+", " ".join(re.findall(r"BroadcastHashJoin \[(.*?)\]", plan))))


def _stored(spark, tmp_path, name, rows, schema):
    """As a file, whose size the planner knows."""
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}")
    return spark.read.parquet(f"{tmp_path}/{name}")


def _tables(spark, tmp_path):
    dim = _stored(spark, tmp_path, "dim", [("1", "A", 10.0, "FOOD"), ("2", "B", 20.0, "FOOD"), ("3", "C", 30.0, "DRINK"), ("4", "D", None, "DRINK"), (None, "E", 1.0, "FOOD")],
                  "product_id string, product_name string, price double, category string")
    dim = dim.withColumns({"product_cost": F.col("price") / 2, "parent_sku": F.lit(None).cast("string")})
    rules = _stored(spark, tmp_path, "rules", [("BF01", "A", "B", "FOOD"), ("BF02", "B", "gone", "FOOD"), ("BM01", "C", "A", "MEAL")],
                    "bundle_id string, antecedents_names string, consequents_names string, category string")
    # receipts of A and B each quarter, every second one with C too; a null product and a null receipt
    rows = []
    for n in range(24):
        day = dt.date(2020 + n // 8, 1 + (n // 2 % 4) * 3, 5)
        rows += [(n, p, 10.0 * (1 + n % 5) + int(p), day, 10 * n + int(p)) for p in ("1", "2", "3")[:2 + n % 2]]
    rows += [(99, None, 1.0, dt.date(2020, 1, 1), 990), (None, "1", 5.0, dt.date(2020, 1, 1), 991), (None, "2", 6.0, None, 992)]
    return dim, rules, _stored(spark, tmp_path, "fact", rows, "receipt_no bigint, product_id string, line_total double, date date, seq bigint")


def test_small_tables_are_not_broadcast(spark, tmp_path):
    """Before, each of these broadcast tables of a few rows."""
    dim, rules, fact = _tables(spark, tmp_path)
    b = EL.resolve_bundles(EL.top_bundles(rules), dim)
    assert {(r.bundle_id, r.product_id_1, r.product_id_2) for r in b.collect()} == {("BF01", "1", "2"), ("BM01", "3", "1")}
    points = EL.price_quantity_points(fact, b)
    ped = EL.elasticity(rules, fact, dim)
    ped.write.parquet(f"{tmp_path}/ped")
    stored = spark.read.parquet(f"{tmp_path}/ped")
    sc = SC.scenario_price(rules, stored, dim, PR.price_recommendation(stored, dim))
    sc.write.parquet(f"{tmp_path}/sc")
    sc_stored = spark.read.parquet(f"{tmp_path}/sc")
    long = SC.bundle_series_long(fact, sc_stored)
    forecast = SC.bundle_forecast(fact, sc_stored)
    impact = SC.revenue_impact(forecast, sc_stored)
    for df in (b, points, ped, sc, long, forecast, impact):
        assert not _broadcast_keys(df)
    assert sum(r.num_transactions for r in points.collect() if r.bundle_id == "BF01") == 25  # the null receipt is one
    assert sum(r.num_transactions for r in points.collect() if r.bundle_id == "BM01") == 12
    assert {r.bundle_id for r in impact.collect()} == {"BF01", "BM01"}
    listed = S.product_series(fact, spark.createDataFrame([("3",), ("3",), (None,)], "product_id string")).collect()
    assert {r.product_id for r in listed} == {"3"} and sum(r.units for r in listed) == 12


def test_no_bundles_give_no_receipts(spark, tmp_path):
    """The bundles are one value; without any it is empty."""
    dim, rules, fact = _tables(spark, tmp_path)
    none = EL.resolve_bundles(EL.top_bundles(rules.filter("false")), dim)
    assert EL.bundle_receipts(fact, none).count() == 0 and EL.bundle_receipts(fact, none, strict=True).count() == 0
    assert S.product_series(fact, dim.filter("false").select("product_id")).count() == 0


def test_rules_look_skus_up_once(spark, tmp_path):
    """Item and category by one lookup, in either pass, and the frequent items; before, names, sizes and counts were broadcast too."""
    dim, _, fact = _tables(spark, tmp_path)
    baskets = fact.select("receipt_no", F.col("product_id").alias("sku"), "seq")
    rules = B.bundle_rules(baskets, dim, 0.0, 0.0, 0.0)
    assert {(r.category, r.antecedents_names, r.consequents_names) for r in rules.collect()} >= {("FOOD", "A", "B")}
    assert _broadcast_keys(rules) <= {"sku", "run", "item"}
    want = B.run_items(B.basket_items(baskets, dim), dim, runs=("FOOD", "DRINK", "MEAL", "ALL"))
    got = B.run_rows(baskets, dim, runs=("FOOD", "DRINK", "MEAL", "ALL"))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_products_are_cleaned_before_the_lines_take_them(spark):
    """Rules and canonical ids are looked up by the catalogue; before, by every line, with three broadcasts in each pass."""
    w = Warehouse(spark, SF)
    one = spark.range(1).selectExpr("CAST(id AS STRING) AS product_id", "'x' AS product_name")
    assert "Join" not in CL.standardize_products(one)._jdf.queryExecution().optimizedPlan().toString()
    assert not _broadcast_keys(w.canonical) and not _broadcast_keys(w.products)
    lines = CL.standardize_products(line_report(spark, SF))
    ids = CL.canonical_product_ids(lines)
    assert sorted(map(str, w.canonical.collect())) == sorted(map(str, ids.collect()))
    old = CL.normalize_names(CL.apply_canonical_ids(lines, ids))
    assert w.lines.columns == old.columns
    assert w.lines.exceptAll(old).count() == 0 and old.exceptAll(w.lines).count() == 0
