"""Literal cases: whole keys, strict upserts, manifests, summary prices, stream state, quartiles, costing, regression."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillwise.functions import text as T
from tillwise.operators import baskets as B
from tillwise.operators import costing, facts, quality, regression, scenario, upsert
from tillwise.operators.joins import file_overlap
from tillwise.sources.pos import ingest_ordinal
from tillwise.streaming.ingest import stream_scd


def test_dedup_needs_the_whole_key(spark):
    df = spark.createDataFrame([("d", 1, "a", 1), ("d", 1, "b", 2)], "date string, receipt_no int, x string, seq int")
    assert facts.dedup_keep_first(df, ["date", "receipt_no", "time"]).count() == 2
    assert [r.x for r in facts.dedup_keep_first(df, ["date", "receipt_no"]).collect()] == ["a"]
    with pytest.raises(ValueError):
        facts.dedup_keep_last(df, ["date", "time"])


def test_white_space_of_any_kind(spark):
    df = spark.createDataFrame([("\tLatte \n",), (" Y\t",)], "s string")
    assert [r[0] for r in df.select(T.name_key(F.col("s"))).collect()] == ["latte", "y"]
    assert df.select(T.takeout_flag(F.col("s"))).collect()[1][0] == "True"
    assert spark.createDataFrame([("9:05",), ("12:" + "0" * 3 + "7",)], "s string").select(T.time_id(F.col("s"))).collect()[0][0] == "H09M05"


def test_upsert_refuses_an_unordered_conflict(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    same = spark.createDataFrame([(1, "b"), (1, "b"), (2, "c")], "k int, v string")
    assert sorted(map(tuple, upsert.upsert_merge(target, same, ["k"]).collect())) == [(1, "b"), (2, "c")]
    with pytest.raises(Exception, match="rows differ"):
        upsert.upsert_merge(target, same.unionByName(spark.createDataFrame([(2, "d")], "k int, v string")), ["k"]).collect()


def test_manifest_keeps_older_runs(spark, tmp_path):
    root = f"file://{tmp_path}"
    for n in (3, 5):
        path = upsert.write_version(spark.range(n), f"{root}/t")
        upsert.publish_run(spark, f"{root}/manifest", {"t": path})
    assert upsert.read_published(spark, f"{root}/manifest", "t").count() == 5
    assert len(list((tmp_path / "manifest").iterdir())) == 2


def test_summary_at_its_own_price(spark):
    """The raw forecast takes the summary price's multiplier and is clipped after it; the longest series counts."""
    sc = spark.createDataFrame([("B", "FOOD", "a", "b", -2.0, 60.0, 40.0, 100.0, 95.0)],
                               "bundle_id string, category string, antecedents_names string, consequents_names string, epsilon double, price_a double, price_b double, current_price double, new_price double")
    f = spark.createDataFrame([("B", "FOOD", 2.0, 2.0, 2.216, 5.0, 3.0, 4.0, 2.0), ("B", "FOOD", 0.0, -1.0, 0.0, 1.0, 1.0, 1.0, 1.0)],
                              "bundle_id string, category string, bundle_units_forecast double, bundle_units_raw double, bundle_units_adjusted_forecast double, antecedent_units_forecast double, "
                              "antecedent_units_after_cannibalization double, consequent_units_forecast double, consequent_units_after_cannibalization double")
    long = spark.createDataFrame([("B", "bundle", 1)] + [("B", "antecedent", i) for i in range(3)], "key string, series string, period int")
    r = scenario.bundle_summary(f, sc, long).collect()[0]
    before = 5 * 60 + 4 * 40 + 1 * 60 + 1 * 40
    after = 3 * 60 + 2 * 40 + 60 + 40 + 2 * (0.9 ** -2.0) * 90
    assert (r.revenue_before, r.revenue_after) == (round(before, 2), round(after, 2)) and r.n_periods == 3
    assert r.bundle_units_equivalent == (np.floor((after - before) / 90) if after >= before else -np.ceil((before - after) / 90))


def test_stream_history_on_a_uri(spark, tmp_path):
    base = f"file://{tmp_path}"
    row = lambda price, day: [("P", "LATTE", price, dt.datetime(2024, 1, day), day)]
    schema = "product_id string, product_name string, price double, datetime timestamp_ntz, seq int"
    state = None
    for i, (price, day) in enumerate(((1.0, 1), (2.0, 2), (3.0, 3))):
        spark.createDataFrame(row(price, day), schema).write.parquet(f"{base}/in/p={i}")
        df = spark.read.schema(schema).parquet(f"{base}/in/p={i}")
        state = stream_scd(spark, f"{base}/in/*", df.schema, f"{base}/ck", f"{base}/state")
    assert state.latest("history").count() == 3


def test_exact_quartiles(spark):
    rng = np.random.default_rng(1)
    groups = {"a": rng.normal(0, 1, 501), "b": rng.integers(0, 4, 300).astype(float), "c": np.array([7.0]), None: rng.exponential(5, 88)}
    df = spark.createDataFrame([(g, float(x)) for g, v in groups.items() for x in v] + [("a", None), ("d", None)], "g string, x double")
    got = {r.g: (r.q1, r.q3) for r in quality._exact_quartiles(df, ["x"], ["g"], ()).collect()}
    assert set(got) == set(groups)
    for g, v in groups.items():
        assert np.allclose(got[g], np.quantile(v, [0.25, 0.75]))


def test_outliers_of_a_null_group_are_judged(spark):
    df = spark.createDataFrame([(None, float(x)) for x in range(20)] + [(None, 1000.0)], "category string, price double")
    flagged = quality.outlier_flags(df, ["price"], by=("category",))
    assert [r.price for r in flagged.filter("flag_price").collect()] == [1000.0]


def test_overlap_by_month_keeps_each_pair_once(spark):
    d = dt.date
    rows = [("a", d(2024, 1, 5)), ("a", d(2024, 6, 1)), ("b", d(2024, 2, 1)), ("b", d(2024, 5, 1)), ("c", d(2024, 6, 1)), ("c", d(2024, 7, 1)), ("e", d(2024, 8, 1)), ("n", None)]
    got = {tuple(r) for r in file_overlap(spark.createDataFrame(rows, "file string, date date")).collect()}
    assert got == {("a", "b", d(2024, 2, 1), d(2024, 5, 1)), ("a", "c", d(2024, 6, 1), d(2024, 6, 1))}


def test_cost_match(spark):
    products = spark.createDataFrame([("CAR LATTE HOT 12OZ",), ("MOCHA",), ("TEA ICED 16OZ",), ("SODA",), (None,)], "product_name string")
    sheets = spark.createDataFrame([("Caramel Latte Hot 12oz", 2, 30.0), ("caramel latte 12", 1, 20.0), ("Choco Mocha Iced 16", 3, 40.0), ("Iced 16", 4, 9.0)], "sheet string, sheet_order int, total_cost double")
    got = {r.product_name: (r.sheet, r.score) for r in costing.fuzzy_cost_match(products, sheets).collect()}
    assert got == {"CAR LATTE HOT 12OZ": ("Caramel Latte Hot 12oz", 4), "MOCHA": ("Choco Mocha Iced 16", 2), "TEA ICED 16OZ": ("Choco Mocha Iced 16", 2)}


def test_polynomial_matches_least_squares(spark):
    rng = np.random.default_rng(2)
    p = np.sort(rng.uniform(50, 500, 30))
    y = np.round(40 - 0.05 * p + 2e-4 * (p - 300) ** 2 + rng.normal(0, 2, 30))
    pts = spark.createDataFrame([("B", float(a), int(b)) for a, b in zip(p, y)] + [("C", 5.0, 1), ("C", 6.0, 1)], "bundle_id string, combined_price double, num_transactions int")
    grid = [r for r in regression.polynomial_demand(pts).orderBy("grid_index").collect() if r.bundle_id == "B"]
    fit = np.polynomial.Polynomial.fit(p, y, grid[0].degree)
    assert np.allclose([r.demand for r in grid], fit([r.price for r in grid]), atol=1e-3)
    m = {r.bundle_id: r for r in regression.regression_metrics(pts).collect()}
    assert abs(m["B"].mse - np.mean((y - fit(p)) ** 2)) < 1e-4 and m["C"].degree == 1 and m["C"].r2 is None


def test_itemset_limit_is_refused(spark):
    with pytest.raises(ValueError):
        B.frequent_itemsets(None, None, top_n=7)


def test_ordinal_keeps_the_order(spark):
    rows = [(10 ** 12, 1, 5, 1.5), (3, 7, 2 * 10 ** 10, 104949.5), (3, 7, 2 * 10 ** 10, 104949.49), (3, 2, 9, 1.0), (2, 7, 1, 0.0)]
    df = spark.createDataFrame(rows, "o long, l int, p long, x double").select("*", ingest_ordinal("o", "l", "p", "x").alias("seq"))
    assert [tuple(r)[:4] for r in df.orderBy("seq").collect()] == sorted(rows)


def test_one_extreme_value_leaves_no_deep_range(spark):
    """Ranges follow ranks: with one value of 1e12, no range holds more than its share of the others."""
    n = 6400
    values = [(float(i * i % 7919) + i / 10, "g") for i in range(n)] + [(1e12, "g"), (-1e12, "g")]
    df = spark.createDataFrame(values, "x double, g string")
    held = df.select("g", F.lit("x").alias("metric"), F.col("x").alias("v"), F.lit(1).alias("c"))
    depth = quality._ranges(held, ["g", "metric"], False).groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
    assert depth <= n * (1 / quality.RANGES + 2 / quality.ACCURACY) + 2
    want = [float(np.quantile([v for v, _ in values], q)) for q in (0.25, 0.75)]
    for by in ([], ["g"]):
        got = quality._exact_quartiles(df, ["x"], by, ()).first()
        assert [got.q1, got.q3] == pytest.approx(want)
