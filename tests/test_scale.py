"""Plans that must not read or shuffle their input again and again."""

from collections import Counter
from itertools import combinations

from pyspark.sql import functions as F

from tillwise.operators import baskets as B
from tillwise.operators import elasticity as EL
from tillwise.operators import quality


def _run_rows():
    dim = {"1": "FOOD", "2": "FOOD", "3": "DRINK", "4": "DRINK", "5": "EXTRA"}
    rows = [(r, i) for r, items in ((1, "123"), (2, "12"), (3, "34"), (4, "5"), (5, "1345"), (6, "3")) for i in items]
    return dim, rows + [(None, "1"), (None, "3")]


def test_run_rows_and_pairs_by_brute_force(spark):
    """all runs from one pass; a null receipt counts an item, and neither a meal nor a pair."""
    dim, rows = _run_rows()
    items = spark.createDataFrame(rows, "receipt_no bigint, item string")
    d = spark.createDataFrame(list(dim.items()), "product_id string, category string")
    ri = B.run_items(items, d, runs=("FOOD", "DRINK", "MEAL", "ALL"))
    meals = {r for r, _ in rows if r is not None and {"FOOD", "DRINK"} <= {dim[i] for q, i in rows if q == r}}
    want = {("ALL", r, i) for r, i in rows} | {(dim[i], r, i) for r, i in rows if dim[i] != "EXTRA"} | {("MEAL", r, i) for r, i in rows if r in meals and dim[i] != "EXTRA"}
    got = [(r.run, r.receipt_no, r.item) for r in ri.collect()]
    assert len(got) == len(set(got)) and set(got) == want
    n_run, singles, pairs = B.itemset_counts(ri, 0.0)
    assert {r.run: r.n for r in n_run.collect()} == Counter(run for run, r in {(run, r) for run, r, _ in want if r is not None})
    assert {(r.run, r.item): r.n_i for r in singles.collect()} == Counter((run, i) for run, _, i in want)
    sets = {(run, r): sorted(i for a, b, i in want if (a, b) == (run, r)) for run, r, _ in want if r is not None}
    assert {(r.run, r.a, r.b): r.n_ab for r in pairs.collect()} == Counter((run, a, b) for (run, _), s in sets.items() for a, b in combinations(s, 2))


def test_rules_read_the_baskets_once_for_the_pairs(spark):
    """The pairs of both directions are one count, and the run rows are never kept."""
    dim, rows = _run_rows()
    items = spark.createDataFrame(rows, "receipt_no bigint, item string")
    d = spark.createDataFrame(list(dim.items()), "product_id string, category string")
    ri = B.run_items(items, d)
    rules = B.pair_rules(ri, 0.0, 0.0, 0.0)
    assert not ri.storageLevel.useMemory and not ri.storageLevel.useDisk
    tree = rules._jdf.queryExecution().optimizedPlan().toString()
    assert tree.count("collect_list(item") == 1
    assert rules.count() == 10


def test_quartiles_read_their_rows_three_times(spark):
    """sketch, ranges and the few values between; before, each level read all rows of the one before it again."""
    df = spark.range(1000).select((F.col("id") % 7).cast("string").alias("g"), (F.col("id") % 90).cast("double").alias("x"), (F.col("id") * 1.5).alias("y"))
    q = quality._exact_quartiles(df, ["x", "y"], [], ())
    assert q._jdf.queryExecution().optimizedPlan().collectLeaves().size() <= 4
    got = {r.metric: (r.q1, r.q3) for r in q.collect()}
    for m in ("x", "y"):
        want = df.select(F.percentile(m, 0.25), F.percentile(m, 0.75)).first()
        assert got[m] == tuple(want)


def test_bundle_receipts_need_one_aggregate(spark):
    """Receipts of a bundle by one aggregate; before, a distinct count dealt the lines twice."""
    fact = spark.createDataFrame([(1, "a", 1), (1, "a", 2), (1, "b", 3), (2, "a", 4), (3, "b", 5), (3, "c", 6), (None, "a", 7), (None, "b", 8)], "receipt_no int, product_id string, seq int")
    fact = fact.withColumns({"line_total": F.col("seq").cast("decimal(12,2)"), "date": F.date_add(F.lit("2024-01-01").cast("date"), F.col("seq"))})
    bundles = spark.createDataFrame([("x", "a", "b"), ("y", "c", "b"), ("z", "a", "a")], "bundle_id string, product_id_1 string, product_id_2 string")
    out = EL.bundle_receipts(fact, bundles)
    plan = out._jdf.queryExecution().executedPlan().toString().splitlines()
    assert sum("Exchange hashpartitioning" in line and "receipt_no" in line for line in plan) == 1
    assert {(r.bundle_id, r.receipt_no, int(r.combined_price), r.date.day) for r in out.collect()} == {("x", 1, 6, 2), ("y", 3, 11, 6), ("x", None, 15, 8)}
