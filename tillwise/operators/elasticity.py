"""Bundle price elasticity.

All bundles are processed in one plan: the bundle table (at most
``TOP_BUNDLES`` rows, a bound fixed by construction) is one value that the
fact's lines are looked up in by product id, so only the lines of bundle products
are shuffled, once, by (bundle, receipt).  The fit uses Spark's ``regr_*`` aggregates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from .common import few_rows


def top_bundles(rules: DataFrame, n: int | None = C.TOP_BUNDLES) -> DataFrame:
    """The first n rows (None: all) of the rule table in table order (runs FOOD, DRINK,
    MEAL, each by bundle id) with their 0-based ``rule_row``."""
    order = F.create_map(F.lit("FOOD"), F.lit(0), F.lit("DRINK"), F.lit(1), F.lit("MEAL"), F.lit(2))
    w = Window.orderBy(F.coalesce(order[F.col("category")], F.lit(9)), F.col("bundle_id"))
    # the rule table holds at most five rows per run: a global window is fine here
    out = rules.withColumn("rule_row", F.row_number().over(w) - 1)
    return out if n is None else out.filter(F.col("rule_row") < n)


def resolve_bundles(bundles: DataFrame, dim: DataFrame) -> DataFrame:
    """Exact-name resolution of both sides to product ids (first id per
    name); unresolved bundles are dropped."""
    by_name = dim.groupBy("product_name").agg(F.min("product_id").alias("pid"))
    a = by_name.select(F.col("product_name").alias("__na"), F.col("pid").alias("product_id_1"))
    b = by_name.select(F.col("product_name").alias("__nb"), F.col("pid").alias("product_id_2"))
    return (
        bundles.join(few_rows(a), F.col("antecedents_names") == F.col("__na"), "inner")
        .join(few_rows(b), F.col("consequents_names") == F.col("__nb"), "inner")
        .drop("__na", "__nb")
    )


def bundle_receipts(fact: DataFrame, bundles: DataFrame, strict: bool = False) -> DataFrame:
    """(bundle_id, receipt_no, combined_price, date) for receipts containing
    both products (strict: whose product set is exactly the pair).  The
    combined price is the sum of the pair's line totals on the receipt."""
    # a bit for each product of a bundle (two of them): one aggregate counts those on a receipt, with a single shuffle
    sides = bundles.select("bundle_id", F.explode(F.array("product_id_1", "product_id_2")).alias("product_id"))
    place = F.dense_rank().over(Window.partitionBy("bundle_id").orderBy("product_id"))
    sides = sides.withColumn("__bit", F.call_function("shiftleft", F.lit(1).cast("long"), place - 1))
    of = sides.filter(F.col("product_id").isNotNull()).groupBy("product_id").agg(F.collect_list(F.struct("bundle_id", "__bit")).alias("__in"))
    product = of.select(F.map_from_entries(F.collect_list(F.struct("product_id", "__in")))).scalar()
    lines = fact.select("receipt_no", "line_total", "date", "seq", F.inline(product[F.col("product_id")]))
    per = lines.groupBy("bundle_id", "receipt_no").agg(
        F.bit_count(F.bit_or("__bit")).alias("__n"),
        F.sum("line_total").alias("combined_price"),
        F.min_by("date", "seq").alias("date"),
    ).filter(F.col("__n") == 2).drop("__n")
    if strict:
        # only receipts that hold a pair are counted, so the fact is pruned to them before its shuffle
        sizes = fact.join(per.select("receipt_no").distinct(), "receipt_no", "left_semi").groupBy("receipt_no").agg(F.count_distinct("product_id").alias("__all"))
        per = per.join(sizes.filter(F.col("__all") == 2).select("receipt_no"), "receipt_no", "left_semi")
    return per


def price_quantity_points(fact: DataFrame, bundles: DataFrame, strict: bool = False,
                          price_bin: float | None = None) -> DataFrame:
    """Receipts per distinct combined price of each bundle.  ``price_bin``
    rounds the combined price to a multiple of the bin (decimal, half-up)."""
    r = bundle_receipts(fact, bundles, strict)
    price = F.col("combined_price")
    if price_bin:
        b = F.lit(str(price_bin)).cast("decimal(12,2)")
        price = (F.round(price / b, 0) * b).cast("decimal(20,2)")
    return r.groupBy("bundle_id", price.alias("combined_price")).agg(
        F.count(F.lit(1)).alias("num_transactions"))


def estimate_elasticity(points: DataFrame) -> DataFrame:
    """Ln Q = k + eps ln P on positive points, per bundle.  Fewer than two
    points: eps = 0, k = 0, R^2 null.  Rounded to 6 places."""
    pos = points.filter((F.col("combined_price") > 0) & (F.col("num_transactions") > 0))
    x = F.ln(F.col("combined_price").cast("double"))
    y = F.ln(F.col("num_transactions").cast("double"))
    fit = pos.groupBy("bundle_id").agg(
        F.regr_count(y, x).alias("n_price_points"),
        F.regr_slope(y, x).alias("__eps"),
        F.regr_intercept(y, x).alias("__k"),
        F.regr_r2(y, x).alias("__r2"),
    )
    enough = F.col("n_price_points") >= 2
    return fit.select(
        "bundle_id",
        F.col("n_price_points").cast("int").alias("n_price_points"),
        F.when(enough, F.round(F.coalesce("__eps", F.lit(0.0)), 6)).otherwise(F.lit(0.0)).alias("elasticity_epsilon"),
        F.when(enough, F.round(F.coalesce("__k", F.lit(0.0)), 6)).otherwise(F.lit(0.0)).alias("intercept_logk"),
        F.when(enough, F.round("__r2", 6)).alias("r2_logspace"),
    )


def elasticity(rules: DataFrame, fact: DataFrame, dim: DataFrame, strict: bool = False,
               price_bin: float | None = None, n: int = C.TOP_BUNDLES) -> DataFrame:
    """E-stage output (ped_summary): one row per resolved top bundle."""
    b = resolve_bundles(top_bundles(rules, n), dim)
    pts = price_quantity_points(fact, b, strict, price_bin)
    fit = estimate_elasticity(pts)
    out = b.join(few_rows(fit), "bundle_id", "left")
    return out.select(
        "bundle_id", "category", F.col("rule_row").cast("int").alias("rule_row"),
        "product_id_1", "product_id_2",
        F.col("antecedents_names").alias("product_name_1"), F.col("consequents_names").alias("product_name_2"),
        F.lit("strict" if strict else "non_strict").alias("mode"),
        F.coalesce("n_price_points", F.lit(0)).alias("n_price_points"),
        F.coalesce("elasticity_epsilon", F.lit(0.0)).alias("elasticity_epsilon"),
        F.coalesce("intercept_logk", F.lit(0.0)).alias("intercept_logk"),
        "r2_logspace",
    )


def demand_curve(ped: DataFrame, points: DataFrame, grid: int = 200) -> DataFrame:
    """Fitted demand Q = exp(k) P^eps on a ``grid``-point price grid over the
    observed positive price range of each bundle."""
    rng = points.filter((F.col("combined_price") > 0) & (F.col("num_transactions") > 0)).groupBy("bundle_id").agg(
        F.min(F.col("combined_price").cast("double")).alias("p_min"),
        F.max(F.col("combined_price").cast("double")).alias("p_max"))
    j = ped.select("bundle_id", "elasticity_epsilon", "intercept_logk").join(few_rows(rng), "bundle_id")
    j = j.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))))
    step = F.when(F.lit(grid) > 1, (F.col("p_max") - F.col("p_min")) / F.lit(grid - 1)).otherwise(F.lit(0.0))
    price = F.col("p_min") + F.col("i") * step
    return j.select("bundle_id", F.col("i").alias("grid_index"), F.round(price, 6).alias("price"),
                    F.round(F.exp("intercept_logk") * F.pow(price, F.col("elasticity_epsilon")), 6).alias("demand"))


def pick_elasticity(pairs: DataFrame, ped: DataFrame) -> DataFrame:
    """Order-insensitive match of (id_a, id_b) to an elasticity row,
    preferring mode 'non_strict'."""
    p = ped.select(F.array_sort(F.array("product_id_1", "product_id_2")).alias("__key"),
                   "mode", "elasticity_epsilon", "intercept_logk", "n_price_points", F.col("bundle_id").alias("ped_bundle_id"))
    j = pairs.withColumn("__key", F.array_sort(F.array("product_id_1", "product_id_2"))).join(
        few_rows(p), "__key", "left")
    w = Window.partitionBy(*pairs.columns).orderBy(
        F.when(F.lower("mode") == "non_strict", 0).otherwise(1), F.col("ped_bundle_id"))
    return j.withColumn("__r", F.row_number().over(w)).filter("__r = 1").drop("__r", "__key")


def sample_bundles(rules: DataFrame) -> DataFrame:
    """One sample bundle per category, the first in rule order."""
    w = Window.partitionBy("category").orderBy("bundle_id")
    return rules.withColumn("__r", F.row_number().over(w)).filter("__r = 1").drop("__r")
