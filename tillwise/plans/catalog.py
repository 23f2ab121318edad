"""Query catalogue: one entry per operator of the inventory.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLES[name] -> SQL``.
Every query reads the given tables (or what Spark derives from them) in
full; there are no id subsets, samples or row caps except where the limit is
the feature (top-k reports).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import descriptive as D
from .oracle_sql import q
from .warehouse import Warehouse

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def wh(spark: SparkSession, sf_dir: str) -> Warehouse:
    return Warehouse.open(spark, sf_dir)


# --- 2.5 aggregations / KPI views ------------------------------------------------

@register("kpi_category_sales", q("""
agg AS (
  SELECT c.category, CAST(sum(f.line_total) AS DOUBLE) AS total_revenue, CAST(sum(f.net_total) AS DOUBLE) AS net_revenue
  FROM fact f JOIN cur c ON f.product_id = c.product_id GROUP BY c.category
)""", """
SELECT category, total_revenue, net_revenue, round(net_revenue / (SELECT sum(net_revenue) FROM agg), 6) AS revenue_share
FROM agg"""))
def kpi_category_sales(spark, sf_dir):
    w = wh(spark, sf_dir)
    return D.kpi_category_sales(w.fact, w.current)


for _unit, _key, _expr in (
    ("day", "date", "date"),
    ("month", "month", "CAST(date_trunc('month', date) AS DATE)"),
    ("quarter", "quarter", "CAST(date_trunc('quarter', date) AS DATE)"),
    ("year", "year", "CAST(year(date) AS INTEGER)"),
):
    _name = {"day": "sales_daily", "month": "sales_monthly", "quarter": "sales_quarterly", "year": "sales_annual"}[_unit]

    def _mk(unit):
        def fn(spark, sf_dir):
            return D.sales_by_period(wh(spark, sf_dir).fact, unit)
        return fn

    register(_name, q("", f"SELECT {_expr} AS {_key}, CAST(sum(net_total) AS DOUBLE) AS revenue FROM fact GROUP BY 1"))(_mk(_unit))


@register("monthly_count_revenue", q("", """
SELECT CAST(date_trunc('month', date) AS DATE) AS month, count(*) AS n_lines, CAST(sum(net_total) AS DOUBLE) AS revenue
FROM fact GROUP BY 1"""))
def monthly_count_revenue(spark, sf_dir):
    return D.monthly_count_revenue(wh(spark, sf_dir).fact)


@register("kpi_daily_summary", q("", """
SELECT date, CAST(date_trunc('month', date) AS DATE) AS month, CAST(date_trunc('quarter', date) AS DATE) AS quarter,
       CAST(date_trunc('year', date) AS DATE) AS year, CAST(sum(net_total) AS DOUBLE) AS total_revenue,
       count(DISTINCT receipt_no) AS total_transactions
FROM fact GROUP BY date"""))
def kpi_daily_summary(spark, sf_dir):
    return D.kpi_daily_summary(wh(spark, sf_dir).fact)


@register("kpi_product_sales", q("", """
SELECT c.product_id, c.product_name, c.category, CAST(sum(f.qty) AS BIGINT) AS total_quantity_sold,
       CAST(sum(f.line_total) AS DOUBLE) AS total_revenue
FROM fact f JOIN cur c ON f.product_id = c.product_id GROUP BY c.product_id, c.product_name, c.category"""))
def kpi_product_sales(spark, sf_dir):
    w = wh(spark, sf_dir)
    return D.kpi_product_sales(w.fact, w.current)


@register("monthly_demand", q("""
m AS (SELECT CAST(date_trunc('month', date) AS DATE) AS month, count(DISTINCT receipt_no) AS receipts FROM fact GROUP BY 1)""",
"SELECT month, receipts FROM m WHERE month < (SELECT max(month) FROM m)"))
def monthly_demand(spark, sf_dir):
    return D.monthly_demand(wh(spark, sf_dir).fact)


def _top_sql(metric: str) -> str:
    val = "CAST(sum(f.net_total) AS DOUBLE)" if metric == "revenue" else "CAST(sum(f.qty) AS BIGINT)"
    col = "revenue" if metric == "revenue" else "quantity"
    return q(f"""
agg AS (
  SELECT c.category, f.product_name, {val} AS v
  FROM fact f LEFT JOIN cur c ON f.product_id = c.product_id
  WHERE c.category IN ('FOOD', 'DRINK') GROUP BY c.category, f.product_name
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY v DESC, product_name) AS rank FROM agg)""",
             f"SELECT category, CAST(rank AS INTEGER) AS rank, product_name, v AS {col} FROM ranked WHERE rank <= 10")


@register("top_products_revenue", _top_sql("revenue"))
def top_products_revenue(spark, sf_dir):
    w = wh(spark, sf_dir)
    return D.top_products(w.fact, w.current, "revenue")


@register("top_products_quantity", _top_sql("quantity"))
def top_products_quantity(spark, sf_dir):
    w = wh(spark, sf_dir)
    return D.top_products(w.fact, w.current, "quantity")


# --- 2.9 market basket ----------------------------------------------------------
from ..operators import baskets as B  # noqa: E402
from .oracle_sql import basket_ctes, rules_ctes  # noqa: E402

#: Query parameters for the synthetic data (items are independent there, so the
#: library defaults 0.15 / 1.0 leave almost no rules): confidence 0.03, lift 0.5.
Q_SUPPORT, Q_CONF, Q_LIFT = 0.003, 0.03, 0.5


@register("bundle_rules", q(rules_ctes(Q_SUPPORT, Q_CONF, Q_LIFT) + """,
scored AS (SELECT *, lift * 0.7 + support / max(support) OVER (PARTITION BY run) * 30.0 AS combined_score FROM rules),
dedup AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY run, least(antecedents_names, consequents_names),
                 greatest(antecedents_names, consequents_names)
                 ORDER BY round(combined_score, 9) DESC, confidence DESC, antecedents_names) AS m FROM scored) WHERE m = 1
),
top AS (
  SELECT *, row_number() OVER (PARTITION BY run ORDER BY round(combined_score, 9) DESC, confidence DESC, lift DESC,
         antecedents_names) AS rk FROM dedup
)""", """
SELECT printf('%s%02d', CASE run WHEN 'FOOD' THEN 'BF' WHEN 'DRINK' THEN 'BD' ELSE 'BM' END, rk) AS bundle_id,
       antecedents_names, consequents_names, support, confidence, lift, leverage, conviction, combined_score,
       run AS category
FROM top WHERE rk <= 5"""))
def bundle_rules(spark, sf_dir):
    # the rules stage writes its result table; later stages read it
    return rules_table(spark, sf_dir)


@register("pair_rules", q(rules_ctes(Q_SUPPORT, Q_CONF, Q_LIFT), """
SELECT run, antecedents_names, consequents_names, support, confidence, lift, leverage, conviction FROM rules"""))
def pair_rules(spark, sf_dir):
    w = wh(spark, sf_dir)
    ri = B.run_rows(w.baskets, w.current)
    r = B.pair_rules(ri, Q_SUPPORT, Q_CONF, Q_LIFT)
    r = B.translate(B.translate(r, w.current, "ant", "antecedents_names"), w.current, "con", "consequents_names")
    return r.select("run", "antecedents_names", "consequents_names", "support", "confidence", "lift",
                    "leverage", "conviction")


def _some_extra(ctes: str) -> str:
    """No name in the synthetic data is an extra: every fifth product is taken for one."""
    plain = "SELECT i.receipt_no, i.item, c.category FROM items i"
    assert plain in ctes
    return ctes.replace(plain, "SELECT i.receipt_no, i.item, CASE WHEN CAST(c.product_id AS BIGINT) % 5 = 0 THEN 'EXTRA' ELSE c.category END AS category FROM items i")


@register("rules_exclude_categories", q(_some_extra(rules_ctes(Q_SUPPORT, Q_CONF, Q_LIFT, runs=("ALL",))) + """,
kept AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY least(antecedents_names, consequents_names),
                 greatest(antecedents_names, consequents_names) ORDER BY confidence DESC, lift DESC, antecedents_names) AS m
                 FROM rules WHERE cat_a NOT IN ('EXTRA', 'OTHERS') AND cat_c NOT IN ('EXTRA', 'OTHERS')) WHERE m = 1
)""", """
SELECT antecedents_names, consequents_names, support, confidence, lift, leverage, conviction,
       lift * 0.7 + support / max(support) OVER () * 30.0 AS combined_score
FROM kept"""))
def rules_exclude_categories(spark, sf_dir):
    w = wh(spark, sf_dir)
    extra = F.when(F.col("product_id").cast("long") % 5 == 0, F.lit("EXTRA")).otherwise(F.col("category"))
    return B.rules_exclude_categories(w.baskets, w.current.withColumn("category", extra), Q_SUPPORT, Q_CONF, Q_LIFT)


@register("frequent_itemsets", q(basket_ctes(Q_SUPPORT) + """,
sets AS (
  SELECT s.run, 1 AS size, s.n_i / s.n AS support, coalesce(nm.nname, s.item) AS itemsets_names
  FROM fs s LEFT JOIN names nm ON nm.nid = s.item
  UNION ALL
  SELECT p.run, 2 AS size, p.n_ab / p.n AS support,
         coalesce(na.nname, p.a) || ', ' || coalesce(nb.nname, p.b) AS itemsets_names
  FROM fp p LEFT JOIN names na ON na.nid = p.a LEFT JOIN names nb ON nb.nid = p.b
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY support DESC, size, itemsets_names) AS rank FROM sets)""",
"SELECT run AS category, CAST(rank AS INTEGER) AS rank, itemsets_names, support FROM ranked WHERE rank <= 5"))
def frequent_itemsets(spark, sf_dir):
    w = wh(spark, sf_dir)
    return B.frequent_itemsets(w.baskets, w.current, Q_SUPPORT)


@register("frequent_itemsets_fpgrowth")
def frequent_itemsets_fpgrowth(spark, sf_dir):
    w = wh(spark, sf_dir)
    return B.frequent_itemsets_fpgrowth(w.baskets, w.current, Q_SUPPORT)


@register("map_sku_to_product", q(basket_ctes(Q_SUPPORT), "SELECT receipt_no, item FROM items"))
def map_sku_to_product(spark, sf_dir):
    w = wh(spark, sf_dir)
    return B.basket_items(w.baskets, w.current)


@register("mba_category_baskets", q(basket_ctes(Q_SUPPORT), """
SELECT run, count(DISTINCT receipt_no) AS receipts, count(*) AS item_rows FROM ri WHERE run IN ('FOOD', 'DRINK') GROUP BY run"""))
def mba_category_baskets(spark, sf_dir):
    w = wh(spark, sf_dir)
    ri = B.run_rows(w.baskets, w.current, runs=("FOOD", "DRINK"))
    return ri.groupBy("run").agg(F.count_distinct("receipt_no").alias("receipts"), F.count(F.lit(1)).alias("item_rows"))


@register("mba_meal_baskets", q(basket_ctes(Q_SUPPORT), """
SELECT receipt_no, CAST(count(*) FILTER (WHERE category = 'FOOD') AS BIGINT) AS food_items,
       CAST(count(*) FILTER (WHERE category = 'DRINK') AS BIGINT) AS drink_items
FROM ri WHERE run = 'MEAL' GROUP BY receipt_no"""))
def mba_meal_baskets(spark, sf_dir):
    w = wh(spark, sf_dir)
    ri = B.run_rows(w.baskets, w.current, runs=("MEAL",))
    return ri.groupBy("receipt_no").agg(
        F.count_if(F.col("category") == "FOOD").alias("food_items"),
        F.count_if(F.col("category") == "DRINK").alias("drink_items"))


@register("pair_support", q(basket_ctes(Q_SUPPORT), """
SELECT p.run, coalesce(na.nname, p.a) AS item_a, coalesce(nb.nname, p.b) AS item_b, p.n_ab AS receipts, p.n_ab / p.n AS support
FROM fp p LEFT JOIN names na ON na.nid = p.a LEFT JOIN names nb ON nb.nid = p.b"""))
def pair_support(spark, sf_dir):
    w = wh(spark, sf_dir)
    ri = B.run_rows(w.baskets, w.current)
    _, _, pairs = B.itemset_counts(ri, Q_SUPPORT)
    p = B.translate(B.translate(pairs, w.current, "a", "item_a"), w.current, "b", "item_b")
    return p.select("run", "item_a", "item_b", F.col("n_ab").alias("receipts"), (F.col("n_ab") / F.col("n")).alias("support"))


@register("transaction_records", q("""
bl AS (
  SELECT d.receipt_no, coalesce(c.parent_sku, d.product_id) AS sku, d.seq
  FROM dlines d LEFT JOIN cur c ON d.product_id = c.product_id
)""", "SELECT receipt_no, string_agg(sku, ',' ORDER BY seq) AS sku FROM bl GROUP BY receipt_no"))
def transaction_records(spark, sf_dir):
    return wh(spark, sf_dir).transaction_records


# --- 2.10 / 2.11 elasticity and pricing ------------------------------------------
from ..operators import elasticity as EL  # noqa: E402
from ..operators import pricing as PR  # noqa: E402
from .oracle_sql import elasticity_ctes, pricing_ctes  # noqa: E402

#: Price bin of the ``*_binned`` variants: line totals are near-unique in the
#: synthetic data, so points at exact prices carry one receipt each.
PRICE_BIN = 10000


def rules_table(spark, sf_dir) -> DataFrame:
    w = wh(spark, sf_dir)
    return w.result("association_rules", lambda: B.bundle_rules(w.baskets, w.current, Q_SUPPORT, Q_CONF, Q_LIFT))


def ped_table(spark, sf_dir, strict: bool = False, price_bin: float | None = None) -> DataFrame:
    w = wh(spark, sf_dir)
    name = "ped_summary" + "_strict" * strict + "_binned" * bool(price_bin)
    return w.result(name, lambda: EL.elasticity(rules_table(spark, sf_dir), w.fact, w.current, strict, price_bin))


def _resolved(spark, sf_dir) -> DataFrame:
    w = wh(spark, sf_dir)
    return EL.resolve_bundles(EL.top_bundles(rules_table(spark, sf_dir)), w.current)


_E = elasticity_ctes(Q_SUPPORT, Q_CONF, Q_LIFT, None)
_ES = elasticity_ctes(Q_SUPPORT, Q_CONF, Q_LIFT, None, strict=True)


@register("resolve_bundles", q(_E, """
SELECT bundle_id, CAST(rule_row AS INTEGER) AS rule_row, product_id_1, product_id_2 FROM rb"""))
def resolve_bundles(spark, sf_dir):
    return _resolved(spark, sf_dir).select("bundle_id", F.col("rule_row").cast("int").alias("rule_row"),
                                           "product_id_1", "product_id_2")


@register("bundle_receipts", q(_E, "SELECT bundle_id, receipt_no, CAST(combined_price AS DOUBLE) AS combined_price, date FROM brc"))
def bundle_receipts(spark, sf_dir):
    r = EL.bundle_receipts(wh(spark, sf_dir).fact, _resolved(spark, sf_dir))
    return r.select("bundle_id", "receipt_no", F.col("combined_price").cast("double").alias("combined_price"), "date")


@register("bundle_receipts_strict", q(_ES, "SELECT bundle_id, receipt_no, CAST(combined_price AS DOUBLE) AS combined_price, date FROM brc"))
def bundle_receipts_strict(spark, sf_dir):
    r = EL.bundle_receipts(wh(spark, sf_dir).fact, _resolved(spark, sf_dir), strict=True)
    return r.select("bundle_id", "receipt_no", F.col("combined_price").cast("double").alias("combined_price"), "date")


def _register_price_chain(suffix: str, price_bin: float | None) -> None:
    """E1-E3 and O1-O5 at one price resolution."""
    for strict in (False, True):
        ctes = elasticity_ctes(Q_SUPPORT, Q_CONF, Q_LIFT, price_bin, strict=strict)
        tail = "_strict" * strict + suffix

        def points(spark, sf_dir, strict=strict):
            p = EL.price_quantity_points(wh(spark, sf_dir).fact, _resolved(spark, sf_dir), strict, price_bin)
            return p.select("bundle_id", F.col("combined_price").cast("double").alias("combined_price"), "num_transactions")

        register("price_quantity_points" + tail, q(ctes, "SELECT bundle_id, CAST(combined_price AS DOUBLE) AS combined_price, num_transactions FROM pts"))(points)
        register("elasticity" + tail, q(ctes, "SELECT * FROM ped"))(
            lambda spark, sf_dir, strict=strict: ped_table(spark, sf_dir, strict, price_bin))

    ctes = elasticity_ctes(Q_SUPPORT, Q_CONF, Q_LIFT, price_bin)

    def curve(spark, sf_dir):
        pts = EL.price_quantity_points(wh(spark, sf_dir).fact, _resolved(spark, sf_dir), False, price_bin)
        return EL.demand_curve(ped_table(spark, sf_dir, price_bin=price_bin), pts)

    register("demand_curve" + suffix, q(ctes + """,
rng AS (SELECT bundle_id, min(CAST(combined_price AS DOUBLE)) AS p_min, max(CAST(combined_price AS DOUBLE)) AS p_max
        FROM pts WHERE combined_price > 0 AND num_transactions > 0 GROUP BY bundle_id),
g AS (SELECT p.bundle_id, p.elasticity_epsilon, p.intercept_logk, r.p_min, r.p_max, i
      FROM ped p JOIN rng r ON p.bundle_id = r.bundle_id, range(200) t(i))""", """
SELECT bundle_id, CAST(i AS INTEGER) AS grid_index, round(p_min + i * ((p_max - p_min) / 199), 6) AS price,
       round(exp(intercept_logk) * pow(p_min + i * ((p_max - p_min) / 199), elasticity_epsilon), 6) AS demand FROM g"""))(curve)

    def economics(spark, sf_dir):
        e = PR.bundle_economics(ped_table(spark, sf_dir, price_bin=price_bin), wh(spark, sf_dir).current)
        return e.select("bundle_id", "bundle_name", "category", "product_a_price", "product_b_price", "current_price_total",
                        F.round("product_a_cogs_raw", 6).alias("product_a_cogs"),
                        F.round("product_b_cogs_raw", 6).alias("product_b_cogs"),
                        F.round(F.exp("intercept"), 6).alias("base_demand_k"), "skip_reason")

    register("bundle_economics" + suffix, q(ctes + pricing_ctes(), """
SELECT bundle_id, bundle_name, category, product_a_price, product_b_price, current_price_total,
       round(ca, 6) AS product_a_cogs, round(cb, 6) AS product_b_cogs, round(exp(intercept), 6) AS base_demand_k, skip_reason
FROM econ"""))(economics)
    register("pricing_skipped" + suffix, q(ctes + pricing_ctes(), "SELECT bundle_id, bundle_name, skip_reason AS reason FROM econ WHERE skip_reason IS NOT NULL"))(
        lambda spark, sf_dir: PR.pricing_skipped(ped_table(spark, sf_dir, price_bin=price_bin), wh(spark, sf_dir).current))
    for objective in ("quantity", "profit"):
        register("price_recommendation" + "_profit" * (objective == "profit") + suffix, q(ctes + pricing_ctes(objective), "SELECT * FROM rec"))(
            lambda spark, sf_dir, objective=objective: PR.price_recommendation(ped_table(spark, sf_dir, price_bin=price_bin), wh(spark, sf_dir).current, objective))


_register_price_chain("", None)
_register_price_chain("_binned", PRICE_BIN)


@register("sample_bundles", q(_E, """
SELECT bundle_id, antecedents_names, consequents_names, category FROM (
  SELECT *, row_number() OVER (PARTITION BY category ORDER BY bundle_id) AS r FROM br) WHERE r = 1"""))
def sample_bundles(spark, sf_dir):
    return EL.sample_bundles(rules_table(spark, sf_dir)).select(
        "bundle_id", "antecedents_names", "consequents_names", "category")


# --- 2.12 / 2.13 series, forecasts, scenario ---------------------------------------
from ..operators import forecast as FC  # noqa: E402
from ..operators import scenario as SC  # noqa: E402
from ..operators import series as S  # noqa: E402

_QEND = "last_day(CAST(date_trunc('quarter', {d}) AS DATE) + INTERVAL 2 MONTH)"


def _fill_sql(cnt: str, key: str, months: int = 3) -> str:
    """Gap-fill CTE text over a counts CTE (key, period, units)."""
    return f"""
rng_{cnt} AS (SELECT {key}, min(period) AS p0, max(period) AS p1 FROM {cnt} GROUP BY {key}),
grid_{cnt} AS (
  SELECT r.{key}, last_day(CAST(r.p0 + to_months(CAST(i * {months} AS INTEGER)) AS DATE)) AS period
  FROM rng_{cnt} r, generate_series(0, CAST(datediff('month', r.p0, r.p1) / {months} AS BIGINT)) t(i)
),
filled_{cnt} AS (
  SELECT g.{key}, g.period, coalesce(CAST(c.units AS DOUBLE), 0.0) AS units
  FROM grid_{cnt} g LEFT JOIN {cnt} c ON c.{key} = g.{key} AND c.period = g.period
)"""


_SERIES_PRODUCT_CTES = f"""
rd AS (SELECT product_id, receipt_no, arg_min(date, seq) AS date FROM fact GROUP BY product_id, receipt_no),
cnt_p AS (SELECT product_id, {_QEND.format(d='date')} AS period, count(*) AS units FROM rd WHERE date IS NOT NULL GROUP BY ALL),
""" + _fill_sql("cnt_p", "product_id").strip()


@register("series_product", q(_SERIES_PRODUCT_CTES, "SELECT product_id, period, units FROM filled_cnt_p"))
def series_product(spark, sf_dir):
    return S.product_series(wh(spark, sf_dir).fact)


@register("trend_label", q(_SERIES_PRODUCT_CTES, """
SELECT product_id, count(*) AS n, arg_min(units, period) AS first_value, arg_max(units, period) AS last_value,
       CASE WHEN count(*) < 2 THEN 'No data'
            WHEN arg_max(units, period) > arg_min(units, period) * 1.05 THEN 'Upward trend'
            WHEN arg_max(units, period) < arg_min(units, period) * 0.95 THEN 'Downward trend'
            ELSE 'Relatively flat trend' END AS trend
FROM filled_cnt_p GROUP BY product_id"""))
def trend_label(spark, sf_dir):
    return S.trend_label(S.product_series(wh(spark, sf_dir).fact), ["product_id"])


_SERIES_BUNDLE_CTES = _E + f""",
cnt_b AS (SELECT bundle_id, {_QEND.format(d='date')} AS period, count(*) AS units FROM brc WHERE date IS NOT NULL GROUP BY ALL),
""" + _fill_sql("cnt_b", "bundle_id").strip()


@register("series_bundle", q(_SERIES_BUNDLE_CTES, "SELECT bundle_id, period, units FROM filled_cnt_b"))
def series_bundle(spark, sf_dir):
    br = EL.bundle_receipts(wh(spark, sf_dir).fact, _resolved(spark, sf_dir))
    return S.bundle_series(br)


#: z, nb: months in order with their neighbours that had demand; filled_months: the interpolated series.
_MONTHS = """
rdm AS (SELECT receipt_no, arg_min(date, seq) AS date FROM fact GROUP BY receipt_no),
cnt_m AS (SELECT 1 AS k, last_day(date) AS period, count(*) AS units FROM rdm WHERE date IS NOT NULL GROUP BY ALL),
""" + _fill_sql("cnt_m", "k", 1).strip() + """,
z AS (SELECT period, row_number() OVER (ORDER BY period) AS i, CASE WHEN units <> 0 THEN units END AS v FROM filled_cnt_m),
nb AS (
  SELECT period, i, v,
         last_value(CASE WHEN v IS NOT NULL THEN i END IGNORE NULLS) OVER (ORDER BY period ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pi,
         last_value(v IGNORE NULLS) OVER (ORDER BY period ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pv,
         first_value(CASE WHEN v IS NOT NULL THEN i END IGNORE NULLS) OVER (ORDER BY period ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS ni,
         first_value(v IGNORE NULLS) OVER (ORDER BY period ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS nv
  FROM z
),
filled_months AS (
SELECT period AS month, round(CASE WHEN v IS NOT NULL THEN v WHEN pv IS NOT NULL AND nv IS NOT NULL
       THEN pv + (nv - pv) * (i - pi) / (ni - pi) WHEN pv IS NOT NULL THEN pv ELSE 0.0 END, 6) AS receipts FROM nb
)"""


@register("series_interpolated", q(_MONTHS, "SELECT month, receipts FROM filled_months"))
def series_interpolated(spark, sf_dir):
    return S.monthly_series_interpolated(wh(spark, sf_dir).fact)


def _scenario(spark, sf_dir) -> DataFrame:
    w = wh(spark, sf_dir)
    recs = QUERIES["price_recommendation"](spark, sf_dir)
    return w.result("scenario", lambda: SC.scenario_price(rules_table(spark, sf_dir), ped_table(spark, sf_dir),
                                                          w.current, recs))


_SCEN_REST = pricing_ctes("quantity") + """,
pk AS (
  SELECT rb.bundle_id, rb.category, rb.rule_row, rb.product_id_1, rb.product_id_2, rb.antecedents_names,
         rb.consequents_names, ped.elasticity_epsilon, ped.mode
  FROM rb JOIN ped ON list_sort([ped.product_id_1, ped.product_id_2]) = list_sort([rb.product_id_1, rb.product_id_2])
  QUALIFY row_number() OVER (PARTITION BY rb.bundle_id ORDER BY CASE WHEN lower(ped.mode) = 'non_strict' THEN 0 ELSE 1 END,
                             ped.bundle_id) = 1
),
scen AS (
  SELECT pk.bundle_id, pk.category, pk.rule_row AS bundle_row, pk.product_id_1, pk.product_id_2,
         pk.antecedents_names, pk.consequents_names, coalesce(pk.elasticity_epsilon, 0.0) AS epsilon,
         CAST(a.price AS DOUBLE) AS price_a, CAST(b.price AS DOUBLE) AS price_b,
         CAST(a.price AS DOUBLE) + CAST(b.price AS DOUBLE) AS current_price,
         coalesce(CAST(r.bundle_price_recommended AS DOUBLE), (CAST(a.price AS DOUBLE) + CAST(b.price AS DOUBLE)) * 0.95) AS new_price
  FROM pk LEFT JOIN cur a ON a.product_id = pk.product_id_1 LEFT JOIN cur b ON b.product_id = pk.product_id_2
  LEFT JOIN rec r ON r.bundle_id = pk.bundle_id
)"""


_SCEN_CTES = _E + _SCEN_REST
_SCEN_SQL = """
SELECT bundle_id, category, bundle_row, epsilon, round(current_price, 6) AS current_price, round(new_price, 6) AS new_price,
       round(CASE WHEN current_price > 0 THEN pow(new_price / current_price, epsilon) ELSE 1.0 END, 6) AS demand_multiplier
FROM scen"""


def _scenario_columns(s: DataFrame) -> DataFrame:
    return s.select("bundle_id", "category", "bundle_row", "epsilon", F.round("current_price", 6).alias("current_price"),
                    F.round("new_price", 6).alias("new_price"), F.round("demand_multiplier", 6).alias("demand_multiplier"))


@register("scenario_price", q(_SCEN_CTES, _SCEN_SQL))
def scenario_price(spark, sf_dir):
    return _scenario_columns(_scenario(spark, sf_dir))


@register("scenario_price_recommended", q(elasticity_ctes(Q_SUPPORT, Q_CONF, Q_LIFT, PRICE_BIN) + _SCEN_REST, _SCEN_SQL))
def scenario_price_recommended(spark, sf_dir):
    """J14 with a recommendation table that has rows: fits and prices of binned points."""
    recs = QUERIES["price_recommendation_binned"](spark, sf_dir)
    return _scenario_columns(SC.scenario_price(rules_table(spark, sf_dir), ped_table(spark, sf_dir, price_bin=PRICE_BIN), wh(spark, sf_dir).current, recs))


def _bundle_long(spark, sf_dir) -> DataFrame:
    return SC.bundle_series_long(wh(spark, sf_dir).fact, _scenario(spark, sf_dir))


@register("forecast_index", q(_SCEN_CTES + f""",
sides2 AS (SELECT bundle_id, product_id_1 AS product_id FROM scen UNION ALL SELECT bundle_id, product_id_2 FROM scen),
rdp AS (SELECT product_id, receipt_no, arg_min(date, seq) AS date FROM fact WHERE product_id IN (SELECT product_id FROM sides2)
        GROUP BY product_id, receipt_no),
lastp AS (SELECT s.bundle_id, max({_QEND.format(d='r.date')}) AS lp FROM rdp r JOIN sides2 s ON r.product_id = s.product_id GROUP BY s.bundle_id),
lastb AS (SELECT bundle_id, max({_QEND.format(d='date')}) AS lp FROM brc GROUP BY bundle_id),
lastall AS (SELECT bundle_id, max(lp) AS lp FROM (SELECT * FROM lastp UNION ALL SELECT * FROM lastb) GROUP BY bundle_id)""", """
SELECT bundle_id, CAST(i AS INTEGER) AS step, last_day(CAST(lp + to_months(CAST(i * 3 AS INTEGER)) AS DATE)) AS period
FROM lastall, generate_series(1, 4) t(i)"""))
def forecast_index(spark, sf_dir):
    long = _bundle_long(spark, sf_dir).withColumnRenamed("key", "bundle_id")
    return S.forecast_index(long, ["bundle_id"]).select("bundle_id", F.col("step").cast("int").alias("step"), "period")


@register("series_align")
def series_align(spark, sf_dir):
    return S.series_align(_bundle_long(spark, sf_dir).withColumnRenamed("key", "bundle_id"), ["bundle_id"])


@register("holt_winters")
def holt_winters_q(spark, sf_dir):
    return FC.holt_winters(_bundle_long(spark, sf_dir)).select(
        F.col("key").alias("bundle_id"), "series", "step", F.round("forecast", 6).alias("forecast"), "status")


@register("forecast_metrics")
def forecast_metrics(spark, sf_dir):
    return FC.forecast_metrics(FC.fitted_values(_bundle_long(spark, sf_dir)))


def _monthly_receipts(spark, sf_dir) -> DataFrame:
    """Monthly demand as one series, without the last month present."""
    m = S.monthly_series_interpolated(wh(spark, sf_dir).fact)
    m = m.filter(F.col("month") < m.select(F.max("month")).scalar())
    return m.select(F.lit("overall").alias("key"), F.lit("receipts").alias("series"), F.col("month").alias("period"),
                    F.col("receipts").alias("units"))


@register("holt_winters_tuned")
def holt_winters_tuned(spark, sf_dir):
    return FC.holt_winters_tuned(_monthly_receipts(spark, sf_dir)).withColumns({c: F.round(c, 6) for c in ("alpha", "beta", "gamma")})


@register("forecast_metrics_monthly")
def forecast_metrics_monthly(spark, sf_dir):
    return FC.tuned_metrics(_monthly_receipts(spark, sf_dir))


def _forecast(spark, sf_dir) -> DataFrame:
    w = wh(spark, sf_dir)
    return w.result("bundle_forecast", lambda: SC.bundle_forecast(w.fact, _scenario(spark, sf_dir)))


@register("bundle_forecast")
def bundle_forecast(spark, sf_dir):
    f = _forecast(spark, sf_dir).drop("bundle_units_raw")
    return f.select([F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in f.dtypes])


@register("revenue_impact")
def revenue_impact(spark, sf_dir):
    return SC.revenue_impact(_forecast(spark, sf_dir), _scenario(spark, sf_dir))


@register("break_even_by_period")
def break_even_by_period(spark, sf_dir):
    return SC.break_even_by_period(_forecast(spark, sf_dir), _scenario(spark, sf_dir))


@register("bundle_summary")
def bundle_summary(spark, sf_dir):
    return SC.bundle_summary(_forecast(spark, sf_dir), _scenario(spark, sf_dir), _bundle_long(spark, sf_dir))
from . import catalog_ops  # noqa: E402,F401
from . import catalog_more  # noqa: E402,F401
from . import catalog_uploads  # noqa: E402,F401
from . import forecast_sql  # noqa: E402,F401
