"""Market-basket mining of two-product bundles.

Plan shape (all runs in one query, keyed by ``run``):

1. SKU -> representative product id (M1): catalogue-sized lookup, broadcast
   after a size check.  Baskets become distinct (receipt, item) rows — a
   hash aggregate with map-side combine, so a receipt holding a third of all
   lines collapses to at most one row per distinct product before any shuffle.
2. Run membership (J5/J6): FOOD and DRINK runs take the receipts with >= 1
   item of the category; MEAL the receipts with both (flags over the
   receipt's rows, which one shuffle brings together for all runs).
3. Support pruning (A-priori, exact for 1->1 rules): only items with support
   >= min_support take part in pair counting.
4. Pair counting (J15): the frequent items of a (run, receipt) are gathered and
   paired with a < b where they are, and aggregated immediately (pair rows
   are never shuffled; per receipt the work is bounded by (frequent items in
   it)^2, independent of row counts).
5. Rule metrics, score, mirror removal and top-k are windows over the small
   per-run rule table.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from .common import few_rows


def sku_map(dim: DataFrame, *carried: str) -> DataFrame:
    """M1: (sku, product_id) and the product's ``carried`` columns.  Every id maps to
    itself; each parent-SKU entry maps to the last product listed with it
    (highest id); parent entries override ids."""
    product = F.struct(F.trim("product_id").alias("product_id"), *carried)
    ids = dim.select(F.trim("product_id").alias("sku"), product.alias("pid"), F.lit(0).alias("pri"))
    parents = (
        dim.filter(F.col("parent_sku").isNotNull() & (F.col("parent_sku") != ""))
        .select(F.explode(F.split("parent_sku", ",")).alias("s"), product.alias("pid"))
        .select(F.trim("s").alias("sku"), "pid")
        .filter(F.col("sku") != "")
        .groupBy("sku").agg(F.max("pid").alias("pid"))
        .withColumn("pri", F.lit(1))
    )
    return ids.unionByName(parents).groupBy("sku").agg(F.max_by("pid", "pri").alias("pid")).select("sku", "pid.*")


def basket_items(baskets: DataFrame, dim: DataFrame, *carried: str) -> DataFrame:
    """M1 + F5: (receipt_no, item) distinct, with the item's ``carried`` columns of ``dim``; unmapped SKUs vanish."""
    m = sku_map(dim, *carried)
    exploded = baskets.select("receipt_no", F.explode(F.split("sku", ",")).alias("sku")) \
        .withColumn("sku", F.trim("sku"))
    return exploded.join(m, "sku", "inner").select("receipt_no", F.col("product_id").alias("item"), *carried).distinct()


def item_categories(dim: DataFrame) -> DataFrame:
    return dim.select(F.trim("product_id").alias("item"), "category")


def run_items(items: DataFrame, dim: DataFrame, runs=("FOOD", "DRINK", "MEAL")) -> DataFrame:
    """(run, receipt_no, item, category) rows of every run, from one pass over the items."""
    return _members(items.join(item_categories(dim), "item", "inner"), runs)


def run_rows(baskets: DataFrame, dim: DataFrame, runs=("FOOD", "DRINK", "MEAL")) -> DataFrame:
    """`run_items` of the `basket_items`: item and category come from one lookup of the SKU."""
    return _members(basket_items(baskets, dim, "category").filter(F.col("item").isNotNull()), runs)


def _members(ic: DataFrame, runs) -> DataFrame:
    category = F.col("category")
    if "ALL" not in runs:
        ic = ic.filter(category.isin("FOOD", "DRINK"))
    member = [F.when(category == r, F.lit(r)) for r in runs if r in ("FOOD", "DRINK")]
    if "MEAL" in runs:
        # the rows of a receipt meet once, and stay together for the counts; a null receipt is no meal
        w = Window.partitionBy("receipt_no")
        ic = ic.withColumn("__meal", F.bool_or(category == "FOOD").over(w) & F.bool_or(category == "DRINK").over(w))
        member.append(F.when(F.col("__meal") & F.col("receipt_no").isNotNull() & category.isin("FOOD", "DRINK"), F.lit("MEAL")))
    if "ALL" in runs:
        member.append(F.lit("ALL"))
    return ic.select(F.explode(F.array_compact(F.array(*member))).alias("run"), "receipt_no", "item", "category")


def itemset_counts(ri: DataFrame, min_support: float = C.MIN_SUPPORT):
    """Run sizes, frequent single items and frequent pairs (counts).  The run rows are
    read twice and never kept: once for the singles, whose counts (one row per run
    and item) are persisted, and once for the pairs.  A receipt's first row of
    a run stands for the receipt in the run's size."""
    first = F.row_number().over(Window.partitionBy("receipt_no", "run").orderBy("item")) == 1
    counts = (
        ri.withColumn("__first", first & F.col("receipt_no").isNotNull())
        .groupBy("run", "item", "category").agg(F.count(F.lit(1)).alias("n_i"), F.count_if("__first").alias("__receipts"))
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    n_run = counts.groupBy("run").agg(F.sum("__receipts").alias("n"))
    # the runs' sizes as one value: there are four runs at most
    size = n_run.select(F.map_from_entries(F.collect_list(F.struct("run", "n")))).scalar()[F.col("run")]
    singles = (
        counts.drop("__receipts").withColumn("n", size)
        .filter(F.col("n_i") / F.col("n") >= F.lit(min_support))
    )
    # a receipt's frequent items: average basket / min_support of them at most
    pruned = ri.filter(F.col("receipt_no").isNotNull()).join(singles.select("run", "item"), ["run", "item"], "left_semi")
    sets = pruned.groupBy("run", "receipt_no").agg(F.collect_list("item").alias("items"))
    pairs = (
        sets.select("run", "items", F.explode("items").alias("a"))
        .select("run", "a", F.explode(F.filter("items", lambda x: x > F.col("a"))).alias("b"))
        .groupBy("run", "a", "b")
        .agg(F.count(F.lit(1)).alias("n_ab"))
        .withColumn("n", size)
        .filter(F.col("n_ab") / F.col("n") >= F.lit(min_support))
    )
    return n_run, singles, pairs


def pair_rules(ri: DataFrame, min_support: float = C.MIN_SUPPORT, min_confidence: float = C.MIN_CONFIDENCE,
               min_lift: float = C.MIN_LIFT) -> DataFrame:
    """M3: 1->1 rules in both directions with support, confidence, lift,
    leverage and conviction (+inf when confidence is 1), thresholds applied.
    MEAL rules must cross categories (food->drink or drink->food)."""
    _, singles, pairs = itemset_counts(ri, min_support)
    s = singles.select("run", "item", "n_i", "category")
    # both directions of each pair; the pairs are counted once
    ways = F.array(F.struct(F.col("a").alias("ant"), F.col("b").alias("con")), F.struct(F.col("b").alias("ant"), F.col("a").alias("con")))
    both = pairs.select("run", F.explode(ways).alias("way"), "n_ab", "n").select("run", "way.ant", "way.con", "n_ab", "n")
    sa = s.select("run", F.col("item").alias("ant"), F.col("n_i").alias("n_a"), F.col("category").alias("cat_a"))
    sc = s.select("run", F.col("item").alias("con"), F.col("n_i").alias("n_c"), F.col("category").alias("cat_c"))
    r = both.join(few_rows(sa), ["run", "ant"]).join(few_rows(sc), ["run", "con"])
    support = F.col("n_ab") / F.col("n")
    conf = F.col("n_ab") / F.col("n_a")
    s_a = F.col("n_a") / F.col("n")
    s_c = F.col("n_c") / F.col("n")
    r = r.select(
        "run", "ant", "con", "cat_a", "cat_c",
        support.alias("support"), conf.alias("confidence"),
        (conf / s_c).alias("lift"),
        (support - s_a * s_c).alias("leverage"),
        F.when(conf == F.lit(1.0), F.lit(float("inf"))).otherwise((F.lit(1.0) - s_c) / (F.lit(1.0) - conf)).alias("conviction"),
    )
    r = r.filter((F.col("confidence") >= F.lit(min_confidence)) & (F.col("lift") >= F.lit(min_lift)))
    return r.filter((F.col("run") != "MEAL") | (F.col("cat_a") != F.col("cat_c")))


def _names(dim: DataFrame) -> DataFrame:
    return dim.select(F.trim("product_id").alias("__nid"), F.col("product_name").alias("__nname"))


def translate(df: DataFrame, dim: DataFrame, id_col: str, out_col: str, few: bool = True) -> DataFrame:
    """Id -> name, falling back to the id.  ``few``: ``df`` is as small as the catalogue."""
    n = few_rows(_names(dim)) if few else _names(dim)
    return df.join(n, F.col(id_col) == F.col("__nid"), "left") \
        .withColumn(out_col, F.coalesce(F.col("__nname"), F.col(id_col))).drop("__nid", "__nname")


def score(rules: DataFrame) -> DataFrame:
    """M6: combined score = lift*0.7 + support/max(support in run)*30."""
    mx = F.max("support").over(Window.partitionBy("run"))
    return rules.withColumn(
        "combined_score",
        F.col("lift") * F.lit(C.SCORE_LIFT_WEIGHT) + F.col("support") / mx * F.lit(C.SCORE_SUPPORT_WEIGHT),
    )


def remove_mirrors(rules: DataFrame) -> DataFrame:
    """Of A->C and C->A keep the first by (score, confidence desc, antecedent)."""
    key_lo = F.least("antecedents_names", "consequents_names")
    key_hi = F.greatest("antecedents_names", "consequents_names")
    w = Window.partitionBy("run", key_lo, key_hi).orderBy(
        F.round("combined_score", 9).desc(), F.col("confidence").desc(), F.col("antecedents_names"))
    return rules.withColumn("__m", F.row_number().over(w)).filter("__m = 1").drop("__m")


def bundle_rules(baskets: DataFrame, dim: DataFrame, min_support: float = C.MIN_SUPPORT,
                 min_confidence: float = C.MIN_CONFIDENCE, min_lift: float = C.MIN_LIFT,
                 top_n: int = C.TOP_RULES_PER_RUN) -> DataFrame:
    """M4/M5 + W8/W10/W13/W14: top bundles of the FOOD, DRINK and MEAL runs with
    sequential ids BF01.., BD01.., BM01.. (score rank within run)."""
    ri = run_rows(baskets, dim)
    rules = pair_rules(ri, min_support, min_confidence, min_lift)
    rules = translate(translate(rules, dim, "ant", "antecedents_names"), dim, "con", "consequents_names")
    rules = remove_mirrors(score(rules))
    w = Window.partitionBy("run").orderBy(
        F.round("combined_score", 9).desc(), F.col("confidence").desc(), F.col("lift").desc(),
        F.col("antecedents_names"))
    prefix = F.create_map(*[x for k, v in C.RUN_PREFIX.items() for x in (F.lit(k), F.lit(v))])[F.col("run")]
    top = rules.withColumn("__rank", F.row_number().over(w)).filter(F.col("__rank") <= top_n)
    return top.select(
        F.format_string("%s%02d", prefix, F.col("__rank")).alias("bundle_id"),
        "antecedents_names", "consequents_names", "support", "confidence", "lift", "leverage",
        "conviction", "combined_score", F.col("run").alias("category"),
    )


def rules_exclude_categories(baskets: DataFrame, dim: DataFrame, min_support: float = C.MIN_SUPPORT,
                             min_confidence: float = C.MIN_CONFIDENCE, min_lift: float = C.MIN_LIFT) -> DataFrame:
    """All-category run; rules touching an EXTRA/OTHERS product dropped;
    mirrors removed *before* the score's max support; all rules, by score."""
    ri = run_rows(baskets, dim, runs=("ALL",))
    rules = pair_rules(ri, min_support, min_confidence, min_lift)
    rules = rules.filter(~F.col("cat_a").isin(*C.EXCLUDED_CATEGORIES) & ~F.col("cat_c").isin(*C.EXCLUDED_CATEGORIES))
    rules = translate(translate(rules, dim, "ant", "antecedents_names"), dim, "con", "consequents_names")
    key_lo = F.least("antecedents_names", "consequents_names")
    key_hi = F.greatest("antecedents_names", "consequents_names")
    w = Window.partitionBy("run", key_lo, key_hi).orderBy(
        F.col("confidence").desc(), F.col("lift").desc(), F.col("antecedents_names"))
    rules = rules.withColumn("__m", F.row_number().over(w)).filter("__m = 1").drop("__m")
    return score(rules).select("antecedents_names", "consequents_names", "support", "confidence", "lift",
                               "leverage", "conviction", "combined_score")


def frequent_itemsets(baskets: DataFrame, dim: DataFrame, min_support: float = C.MIN_SUPPORT,
                      top_n: int = C.TOP_RULES_PER_RUN) -> DataFrame:
    """M2 + W12: top itemsets by support per run (FOOD, DRINK, MEAL).

    Exact from sizes 1-2: any larger frequent itemset has at least six proper
    frequent subsets with support >= its own, and ties rank smaller itemsets
    first, so it can never reach the top five."""
    if top_n > 6:
        raise ValueError("sizes 1 and 2 decide the first six only; use frequent_itemsets_fpgrowth for more")
    ri = run_rows(baskets, dim)
    n_run, singles, pairs = itemset_counts(ri, min_support)
    s1 = translate(singles, dim, "item", "name").select(
        "run", F.lit(1).alias("size"), (F.col("n_i") / F.col("n")).alias("support"), F.col("name").alias("itemsets_names"))
    p = translate(translate(pairs, dim, "a", "na"), dim, "b", "nb")
    # ids sorted, then translated (names keep id order)
    s2 = p.select("run", F.lit(2).alias("size"), (F.col("n_ab") / F.col("n")).alias("support"),
                  F.concat_ws(", ", "na", "nb").alias("itemsets_names"))
    allsets = s1.unionByName(s2)
    w = Window.partitionBy("run").orderBy(F.col("support").desc(), F.col("size"), F.col("itemsets_names"))
    return allsets.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top_n) \
        .select(F.col("run").alias("category"), "rank", "itemsets_names", "support")


def frequent_itemsets_fpgrowth(baskets: DataFrame, dim: DataFrame, min_support: float = C.MIN_SUPPORT) -> DataFrame:
    """M2 (any size) with Spark ML's parallel FP-Growth over all baskets; itemsets
    containing an EXTRA/OTHERS product are dropped unless nothing would remain."""
    from pyspark.ml.fpm import FPGrowth

    items = basket_items(baskets, dim)
    # baskets that begin with the same most frequent items meet in a task, so its trees share their nodes; the
    # baskets are kept for the passes over them: the receipts' count, the items' counts and the trees
    often = items.groupBy("item").agg((-F.count(F.lit(1))).alias("__often"))
    node = F.when(F.col("item").isNotNull(), F.struct("__often", "item"))
    tx = items.join(often, "item", "left").groupBy("receipt_no").agg(F.array_sort(F.collect_set(node)).alias("__path")) \
        .repartitionByRange("__path").select("receipt_no", F.col("__path.item").alias("items")).persist(StorageLevel.MEMORY_AND_DISK)
    n = tx.select(F.count("receipt_no")).first()[0]
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=1.0).fit(tx)
    # the model mines its itemsets whenever they are read: they are read here, once
    fi = model.freqItemsets.select(F.array_sort("items").alias("items"), F.col("freq")).persist(StorageLevel.MEMORY_AND_DISK)
    fi.count()
    tx.unpersist()
    long = fi.select("items", "freq", F.posexplode("items").alias("pos", "item"))
    cats = item_categories(dim).select("item", F.col("category").isin(*C.EXCLUDED_CATEGORIES).alias("bad"))
    named = translate(long.join(cats, "item", "left"), dim, "item", "name", few=False)
    sets = named.groupBy("items", "freq").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "name"))), lambda x: x["name"]).alias("names"),  # one itemset: a few names
        F.coalesce(F.bool_or("bad"), F.lit(False)).alias("bad"))
    # the filter holds only where something remains
    any_left = sets.select(F.bool_or(~F.col("bad"))).scalar()
    kept = sets.filter(~F.col("bad") | ~F.coalesce(any_left, F.lit(False)))
    return kept.select(F.array_join("names", ", ").alias("itemsets"), F.size("items").alias("size"), (F.col("freq") / F.lit(n)).alias("support"))
