"""Keyed tables, checked publishing and the incremental warehouse."""

import datetime as dt
import random
import uuid

import pytest
from pyspark.sql import functions as F

from tillwise.operators import upsert as U
from tillwise.operators.keyed import KeyedTable, read_at
from tillwise.session import shared_path
from tillwise.streaming.warehouse import GRID, WarehouseState, stream_warehouse


def folder(spark):
    return shared_path(spark, f"test-{uuid.uuid4().hex}")


def rows(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=str)


# ---- keyed tables ---------------------------------------------------------------------------

def test_upsert_writes_only_the_buckets_it_touches(spark):
    t = KeyedTable(spark, folder(spark), "id bigint, v string", ["id"], buckets=16)
    t.merge(spark.range(2000).select("id", F.lit("a").alias("v")), 0)
    first = t.folders(0)
    assert len(first) == 16
    # one hundredth of the keys, all of one bucket
    few = spark.range(2000).select("id").where(t.bucket() == 5).limit(20)
    keys = {r[0] for r in few.collect()}
    t.merge(spark.createDataFrame([(k, "b") for k in keys], "id bigint, v string"), 1)
    second = t.folders(1)
    assert {b for b in first if first[b] != second[b]} == {5} and second.keys() == first.keys()
    assert rows(t.read()) == rows(spark.range(2000).select("id", F.when(F.col("id").isin(*keys), "b").otherwise("a").alias("v")))
    assert rows(t.read(0)) == rows(spark.range(2000).select("id", F.lit("a").alias("v")))
    assert t.read(1, {5}).count() < 2000 and read_at(spark, t.locator(0)).count() == 2000


def test_replay_nulls_and_empty(spark):
    t = KeyedTable(spark, folder(spark), "k string, v int", ["k"], buckets=4)
    assert t.versions() == [] and t.read().collect() == []
    make = lambda *r: spark.createDataFrame(list(r), "k string, v int")
    t.merge(make((None, 1), ("x", 1)), 0)
    t.merge(make(("x", 2), ("y", 2)), 1)
    t.merge(make(("x", 3)), 1)  # the batch comes again, with other rows: from version 0 on
    assert t.versions() == [0, 1] and rows(t.read()) == rows(make((None, 1), ("x", 3)))
    t.merge(make((None, 4)), 2)
    assert rows(t.read()) == rows(make((None, 4), ("x", 3)))
    t.merge(make(), 3)
    assert t.folders(3) == t.folders(2)
    with pytest.raises(Exception, match="rows differ under one key"):
        t.merge(make(("z", 1), ("z", 2)), 4)
    assert t.versions() == [0, 1, 2, 3]
    bare = KeyedTable(spark, folder(spark), "k string, v int", ["k"])
    bare.merge(make(), 0)
    assert read_at(spark, bare.locator(0)).columns == ["k", "v"]


# ---- checked publishing -----------------------------------------------------------------------

def test_publish_order():
    assert U.publish_order(["fact_transaction_dimension", "history_product_dimension", "current_product_dimension", "time_dimension"])[-2:] != [
        "current_product_dimension", "time_dimension"]
    order = U.publish_order(["a", "b", "c"], {"a": (("x", "b", "x"),), "b": (("x", "c", "x"),)})
    assert order == ["c", "b", "a"]
    with pytest.raises(Exception):
        U.publish_order(["a", "b"], {"a": (("x", "b", "x"),), "b": (("x", "a", "x"),)})


def test_unknown_keys_are_refused(spark):
    root = folder(spark)
    manifest = f"{root}/manifest"
    fact = lambda *ids: U.write_version(spark.createDataFrame([(i,) for i in ids], "product_id string"), f"{root}/fact")
    dim = lambda *ids: U.write_version(spark.createDataFrame([(i,) for i in ids], "product_id string"), f"{root}/dim")
    names = "fact_transaction_dimension", "current_product_dimension"
    keys = {names[0]: (("product_id", names[1], "product_id"),)}
    with pytest.raises(U.ForeignKeyError, match="neither staged nor published"):
        U.publish_checked(spark, manifest, {names[0]: fact("a")}, foreign_keys=keys)
    U.publish_checked(spark, manifest, {names[0]: fact("a", None), names[1]: dim("a", "b")}, foreign_keys=keys)
    staged = fact("a", "c", "d")
    with pytest.raises(U.ForeignKeyError, match="2 keys are not in current_product_dimension, such as 'c'"):
        U.publish_checked(spark, manifest, {names[0]: staged}, foreign_keys=keys)
    assert rows(U.read_published(spark, manifest, names[0])) == [("a",), (None,)]
    assert spark.read.parquet(staged).count() == 3  # the stage is kept
    U.publish_checked(spark, manifest, {names[0]: staged, names[1]: dim("a", "c", "d")}, foreign_keys=keys)
    assert rows(U.read_published(spark, manifest, names[0])) == [("a",), ("c",), ("d",)]
    U.publish_checked(spark, manifest, {names[0]: fact("b")}, {names[0]: spark.createDataFrame([("a",)], "product_id string")}, foreign_keys=keys)
    assert rows(U.read_published(spark, manifest, names[0])) == [("b",)]


# ---- the incremental warehouse ----------------------------------------------------------------

HEADERS = {"Sales Transaction List": ["Date", "Time", None, "Receipt No"], "Sales Report by Product": ["Date", "Receipt No", "Product ID", "Product Name", "Qty", "Price", "Line Total", "Net Total"]}


def report(kind, name, body, header_at=1):
    cells = [["Title"]] * header_at + [HEADERS[kind]] + body
    return [(f"{kind} {name}.csv", i, [None if c is None else str(c) for c in row]) for i, row in enumerate(cells)]


def uploads(seed=5):
    """Three uploads: receipts reported again, lines before their receipt, a product renamed, a price that changes and returns."""
    rng = random.Random(seed)
    names = ["HOT LATTE", "COLD LATTE", "LATTE", "Rice Bowl ", "rice bowl", "TEA 12OZ", "TEA", None]

    def line(r, p=None):
        p = rng.randrange(12) if p is None else p
        price = 100 + 10 * (p % 3) + rng.choice([0, 0, 5])
        return [None, r, f"P{p}", rng.choice(names) if p > 8 else names[p % len(names)], rng.randrange(1, 4), price, price * 2, price]
    head = lambda r: [str(dt.date(2024, 1 + r % 5, 1 + r % 28)), f"{r % 24:02d}:{r % 60:02d}", "x", r]
    lines = {r: [line(r) for _ in range(rng.randrange(1, 5))] for r in range(1, 40)}
    one = report("Sales Transaction List", "1", [head(r) for r in range(1, 20)]) + report("Sales Report by Product", "1", [x for r in range(1, 22) for x in lines[r]], 3)
    two = report("Sales Transaction List", "2", [head(r) for r in range(12, 30)], 0) + report("Sales Report by Product", "2", [x for r in range(12, 29) for x in lines[r]] + [line(3, 2), [None, 99, "P1", "no receipt", 1, 1, 1, 1]])
    two += [("Stock.csv", 0, ["a"]), ("Sales Transaction List 9.txt", 0, ["b"])]
    three = report("Sales Transaction List", "3", [head(r) for r in range(25, 40)] + [["2024-01-09", "10:00", "x", 99], ["no date", "?", "x", 5], [None, None, None, None]]) + report(
        "Sales Report by Product", "3", [x for r in range(29, 40) for x in lines[r]] + [[None, 2, "P0", "ICED LATTE", 1, "n/a", 5, 5]])
    return one, two, three


def tables(spark, state):
    return {t: rows(U.read_published(spark, state.manifest, t)) for t in (*state.tables, "time_dimension")}


@pytest.fixture(scope="module")
def once(spark):
    """All reports in one run."""
    state = WarehouseState(spark, folder(spark), 4)
    state.apply(spark.createDataFrame([r for u in uploads() for r in u], GRID), 0)
    return tables(spark, state)


def test_uploads_give_the_tables_of_one_run(spark, once):
    root = folder(spark)
    for k, upload in enumerate(uploads()):
        spark.createDataFrame(upload, GRID).write.parquet(f"{root}/landing/upload={k}")
        state = stream_warehouse(spark, f"{root}/landing/*", f"{root}/checkpoint", f"{root}/warehouse", buckets=4)
    assert tables(spark, state) == once
    assert len(once["fact_transaction_dimension"]) > 60 and len(once["time_dimension"]) == 24 + 1440
    rejected = spark.read.parquet(f"{root}/warehouse/rejected")
    assert {(r.file, r.reject_reason) for r in rejected.collect()} == {("Stock.csv", "unrecognised report name"), ("Sales Transaction List 9.txt", "unsupported extension")}
    # the last upload comes again under its own batch, and the tables stay
    state.apply(spark.createDataFrame(uploads()[2], GRID), 2)
    assert tables(spark, state) == once


def test_upload_writes_only_its_buckets(spark):
    state = WarehouseState(spark, folder(spark), 16)
    one, _, _ = uploads()
    state.apply(spark.createDataFrame(one, GRID), 0)
    state.apply(spark.createDataFrame(report("Sales Transaction List", "7", [["2024-02-02", "09:30", "x", 700]]) + report(
        "Sales Report by Product", "7", [["2024-02-02", 700, "P1", "COLD LATTE", 1, 110, 110, 110]]), GRID), 1)
    for name in ("fact_transaction_dimension", "transaction_records"):
        t = state.tables[name]
        was, now = t.folders(0), t.folders(1)
        assert sum(was.get(b) != f for b, f in now.items()) == 1, name
    assert {r.receipt_no for r in U.read_published(spark, state.manifest, "transaction_records").collect()} >= {1, 700}
