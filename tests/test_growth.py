"""What the larger tables asked for: shuffles, sorts and passes that the plans no longer have."""

import os

from pyspark.sql import functions as F

from tests.conftest import SF
from tillwise.operators import baskets as B
from tillwise.operators import cleaning as CL
from tillwise.operators import dimensions as D
from tillwise.operators.keyed import KeyedTable
from tillwise.plans.warehouse import Warehouse
from tillwise.sources import reports as R
from tillwise.streaming.warehouse import GRID, WarehouseState


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _lines(spark):
    rows = [("1", " Tea", "2.00", 3, 9, "2024-01-03"), ("2", "tea ", "2.00", 1, 1, None), ("2", None, "3.00", 5, 5, "2024-01-05"),
            (None, "TEA", "2.00", 0, 0, "2024-01-01"), ("1", "Milk", None, 7, 7, None), ("3", None, None, 8, 8, None)]
    df = spark.createDataFrame(rows, "product_id string, product_name string, price string, seq bigint, seq_last bigint, dt string")
    seq = [F.col(c).cast("decimal(38,0)").alias(c) for c in ("seq", "seq_last")]
    return df.select("product_id", "product_name", F.col("price").cast("decimal(10,2)").alias("price"), *seq, F.col("dt").cast("timestamp_ntz").alias("datetime"))


def test_lines_are_shuffled_once(spark):
    """Receipts and lines are each dealt once for join, distinct and write; before, all lines went through a second shuffle by month."""
    plan = _plan(Warehouse(spark, SF).lines_distinct)
    assert sum("Exchange" in line and "receipt_no" in line for line in plan.splitlines()) == 2
    assert "hashpartitioning(date" not in plan and "REBALANCE" not in plan


def test_first_ids_and_dimensions_sort_no_lines(spark):
    """The lines go through hash aggregates, as only numbers are buffers; before, all of them were sorted."""
    lines = _lines(spark)
    ids = CL.canonical_product_ids(lines)
    assert dict(map(tuple, ids.collect())) == {"tea": "2", "milk": "1"}
    current = {r.product_id: (r.product_name, r.price and float(r.price), r.last_transaction_datetime and r.last_transaction_datetime.day) for r in D.product_dim_current(lines).collect()}
    assert current == {"1": (" Tea", 2.0, 3), "2": ("tea ", 3.0, 5), "3": (None, None, None), None: ("TEA", 2.0, 1)}
    history = {(r.product_id, r.record_version): (r.product_name, r.is_current) for r in D.product_dim_history(lines).collect()}
    assert history == {("1", 1): (" Tea", False), ("1", 2): ("Milk", True), ("2", 1): ("tea ", False), ("2", 2): (None, True), ("3", 1): (None, True), (None, 1): ("TEA", True)}
    # one aggregate before the shuffle that is not sorted
    for df in (ids, D.product_dim_current(lines), D.product_dim_history(lines)):
        lowest = [line for line in _plan(df).splitlines() if "Aggregate(" in line][-1]
        assert "HashAggregate" in lowest


def test_baskets_are_mined_once(spark):
    """the baskets are dealt by their most frequent items and kept; the itemsets are mined once, not at every read of the model."""
    dim = spark.createDataFrame([("a", "A", "FOOD"), ("b", "B", "DRINK"), ("c", "C", "OTHERS")], "product_id string, product_name string, category string").withColumn("parent_sku", F.lit(None).cast("string"))
    rows = [(1, "a"), (1, "b"), (1, "b"), (2, "a"), (2, "b"), (3, "a"), (4, "c"), (None, "a")]
    out = B.frequent_itemsets_fpgrowth(spark.createDataFrame(rows, "receipt_no int, sku string"), dim, 0.3)
    assert {(r.itemsets, r.support) for r in out.collect()} == {("A", 1.0), ("B", 0.5), ("A, B", 0.5)}
    assert "InMemoryTableScan" in _plan(out)


def test_arrivals_are_written_without_a_shuffle(spark, tmp_path):
    """Rows are kept as they come to a merge; before, they were shuffled into buckets there and again for the table."""
    t = KeyedTable(spark, str(tmp_path / "t"), "id bigint, v string", ["id"], buckets=4)
    t.merge(spark.range(0, 100, 1, 3).select("id", F.lit("a").alias("v")), 0)
    (folder,) = os.listdir(tmp_path / "t" / "incoming")
    assert len([f for f in os.listdir(tmp_path / "t" / "incoming" / folder) if f.startswith("part-")]) == 3
    assert t.read().count() == 100


def test_cells_are_read_by_place(spark):
    """Columns are taken by their place in the header; the same cells as by a map of each row."""
    grid = spark.createDataFrame([
        ("f", 0, ["Title", None, None, None]), ("f", 1, ["Date", "Qty", "Date", None]), ("f", 2, ["d1", "5", "d2", "x"]), ("f", 3, ["d3"]),
        ("g", 1, ["Receipt", "Qty", None, None]), ("g", 2, ["1", None, "z", "z"])], GRID)
    headers = R.detect_header(grid, ("date", "receipt"))
    want = R.project_records(R.apply_header(grid, headers), ["Qty", "Date", "Lost"])
    got = R.read_columns(grid, R.header_names(grid, headers), ["Qty", "Date", "Lost"])
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert ("f", 2, "5", "d1", None) in [tuple(r) for r in got.collect()]


def test_an_upload_leaves_no_scratch(spark, tmp_path):
    """copies of the grid, of joined rows and of arrivals stayed on disk after every batch."""
    sales = "Sales Transaction List a.csv"
    sold = "Sales Report by Product a.csv"
    grid = spark.createDataFrame([
        (sales, 0, ["Report"]), (sales, 2, ["Date", "Time", "Receipt No"]), (sales, 3, ["2024-01-01", "10:00", "1"]),
        (sold, 2, ["Date", "Receipt No", "Product ID", "Product Name", "Qty", "Price", "Line Total", "Net Total"]), (sold, 3, ["2024-01-01", "1", "7", "Tea", "1", "2.0", "2.0", "2.0"])], GRID)
    state = WarehouseState(spark, str(tmp_path / "w"), 2)
    for _ in range(2):
        state.apply(grid, 0)
        left = [d for d, _, files in os.walk(tmp_path / "w") if files and ("/work" in d or "/incoming" in d)]
        assert not left
        assert [(r.receipt_no, r.product_id) for r in state.tables["fact_transaction_dimension"].read().collect()] == [(1, "7")]


def _upload(day: str, receipt: str, name: str = "Tea"):
    sales, sold = f"Sales Transaction List {day}.csv", f"Sales Report by Product {day}.csv"
    return [(sales, 0, ["Report"]), (sales, 2, ["Date", "Time", "Receipt No"]), (sales, 3, [f"2024-01-{day}", "10:00", receipt]),
            (sold, 2, ["Date", "Receipt No", "Product ID", "Product Name", "Qty", "Price", "Line Total", "Net Total"]),
            (sold, 3, [f"2024-01-{day}", receipt, "7", name, "1", "2.0", "2.0", "2.0"]), (sold, 4, [f"2024-01-{day}", None, "8", "no receipt", "1", "2.0", "2.0", "2.0"])]


def _named(table) -> set:
    return {f for v in table.versions() for f in table.folders(v).values()}


def _there(table) -> set:
    return {f"{d}/{b}" for d, buckets, _ in os.walk(f"{table.path}/data") for b in buckets if b.startswith("__bucket=")}


def test_a_replay_leaves_no_second_copy(spark, tmp_path):
    """r04 F2, F3: folders of a batch's first time stayed on disk, though no version names them; those of other versions stay."""
    state = WarehouseState(spark, str(tmp_path / "w"), 2)
    state.apply(spark.createDataFrame(_upload("01", "1"), GRID), 0)
    for _ in range(2):
        state.apply(spark.createDataFrame(_upload("02", "2"), GRID), 1)
    for t in (state.receipts, state.lines, state.names, state.states, *state.tables.values()):
        assert _there(t) == _named(t) and t.versions() == [0, 1], t.path
    assert sorted(r.receipt_no for r in state.tables["transaction_records"].read().collect()) == [1, 2]
    # version 0 again: version 1 names its folders still
    t = KeyedTable(spark, str(tmp_path / "t"), "id bigint, v string", ["id"], buckets=4)
    rows = lambda a, b, v: spark.range(a, b).select("id", F.lit(v).alias("v"))
    t.merge(rows(0, 100, "a"), 0)
    t.merge(rows(0, 1, "b"), 1)
    t.merge(rows(0, 100, "c"), 0)
    assert t.read(1).groupBy("v").count().orderBy("v").collect() == [("a", 99), ("b", 1)] and t.read(0).filter("v = 'c'").count() == 100


def test_dealt_rows_are_shuffled_once(spark, tmp_path):
    """r04 F1 to F3: rows went through one shuffle for their keys and another into their buckets."""
    t = KeyedTable(spark, str(tmp_path / "t"), "id bigint, v string", ["id", "v"], ["id"], buckets=4)
    rows = spark.range(0, 1000, 1, 3).select((F.col("id") % 50).alias("id"), (F.col("id") % 7).cast("string").alias("v"))
    rows = rows.unionByName(spark.createDataFrame([(None, "x"), (None, "x"), (1, None)], "id bigint, v string"))
    for size in (1, 15 << 20, 40 << 20):  # bytes, and the version
        parts, tasks = t.deals(size)
        dealt = t.dealt(rows, size)
        assert dealt.filter(F.col("__deal") % 4 != t.bucket()).count() == 0 and dealt.filter(F.col("__deal") >= 4 * parts).count() == 0
        one = dealt.distinct()
        assert _plan(one).count("Exchange") == 1
        t.replace([one], size, set(range(4)))
        assert t.read(size).count() == rows.distinct().count() == t.read(size).distinct().count()
        for b, f in t.folders(size).items():
            assert len([x for x in os.listdir(f) if x.startswith("part-")]) <= parts
            assert t.read(size, {b}).filter(t.bucket() != b).count() == 0
    # joined rows are read back as they were dealt: no shuffle for what is grouped by receipt
    state, scratch = WarehouseState(spark, str(tmp_path / "w"), 2), []
    state.apply(spark.createDataFrame(_upload("01", "1"), GRID), 0)
    joined = state._joined(spark.createDataFrame([(1,)], "receipt_no bigint"), {0, 1}, 0, scratch)
    assert joined.count() == 1 and "Exchange" not in _plan(state._fact_rows(joined))
    spark.sql(f"DROP TABLE {scratch[0]}")


def test_a_batch_leaves_no_shuffle_files(spark, tmp_path):
    """r04 F2, F3: shuffle files of all of a batch's steps stayed on the executors' disks."""
    env = spark._jvm.org.apache.spark.SparkEnv.get()
    dirs = [d.getAbsolutePath() for d in env.blockManager().diskBlockManager().localDirs()]
    held = lambda: {f for top in dirs for _, _, files in os.walk(top) for f in files if f.startswith("shuffle_") and f.endswith(".data")}
    was, tables = held(), set(t.name for t in spark.catalog.listTables())
    conf = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    WarehouseState(spark, str(tmp_path / "w"), 2).apply(spark.createDataFrame(_upload("01", "1"), GRID), 0)
    left = held() - was
    assert len(left) <= 12, len(left)  # of small questions to the tables, not of writes
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == conf and set(t.name for t in spark.catalog.listTables()) == tables


def test_slices_of_buckets_give_the_same_tables(spark, tmp_path, monkeypatch):
    """r04 F2, F3: a large batch is merged and joined some buckets at a time, so that not all of its lines are in shuffle files at once."""
    grids = [spark.createDataFrame([r for k in range(1, 9) for r in _upload(f"0{k}", str(k + shift))], GRID) for shift in (0, 4)]
    found = []
    for most in (1, 1 << 30):
        monkeypatch.setattr("tillwise.operators.keyed.SLICE_BYTES", most)
        state = WarehouseState(spark, str(tmp_path / f"w{most}"), 4)
        assert len(state.lines.slices({0, 1, 2}, 5)) == (3 if most == 1 else 1)
        for v, grid in enumerate(grids):
            state.apply(grid, v)
        found.append({name: sorted(map(str, t.read().collect())) for name, t in [("lines", state.lines), ("receipts", state.receipts), *state.tables.items()]})
    assert found[0] == found[1] and len(found[0]["transaction_records"]) == 12
