"""Bundle price recommendation.

The source optimises quantity K*P^eps over [max(0.9*list, cost/0.9), list]
with a bounded quasi-Newton solver.  For eps < 0 the objective is monotone,
so the optimum is the lower bound — a closed form, computed per row in the
JVM.  Infeasible bounds (lower > upper) fall back to the midpoint with
``optimization_success = false``.  The documented profit objective (O4) has
the closed form P* = list if eps >= -1, else clip(eps*c/(1+eps)).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.text import bundle_label, safe_float
from .common import few_rows

SKIP_INVALID = "Insufficient data or invalid elasticity (ε >= 0)"
SKIP_MISSING = "Product(s) not found in dimension"


def product_info(dim: DataFrame) -> DataFrame:
    """name -> (price, cost), cost = product cost, else 60 % of price; first
    product per name."""
    price = safe_float(F.col("price"), 0.0)
    cogs = F.coalesce(F.col("product_cost").cast("double"), price * F.lit(C.DEFAULT_COGS_MULTIPLIER))
    return dim.groupBy("product_name").agg(
        F.min_by(F.struct(price.alias("price"), cogs.alias("cogs")), F.col("product_id")).alias("i")
    ).select("product_name", "i.price", "i.cogs")


def bundle_economics(ped: DataFrame, dim: DataFrame) -> DataFrame:
    """O1/O2: bundle name, both products' price and cost, K = exp(intercept), and a
    skip reason (null when the bundle is priced)."""
    info = product_info(dim)
    a = info.select(F.col("product_name").alias("__a"), F.col("price").alias("product_a_price"),
                    F.col("cogs").alias("__cogs_a"))
    b = info.select(F.col("product_name").alias("__b"), F.col("price").alias("product_b_price"),
                    F.col("cogs").alias("__cogs_b"))
    eps = safe_float(F.col("elasticity_epsilon"), 0.0)
    r2 = F.col("r2_logspace").cast("double")
    j = ped.join(few_rows(a), F.col("product_name_1") == F.col("__a"), "left").join(few_rows(b), F.col("product_name_2") == F.col("__b"), "left")
    invalid = (F.coalesce(F.col("n_price_points"), F.lit(0)) < 2) | r2.isNull() | F.isnan(r2) | (eps >= 0)
    missing = F.col("__a").isNull() | F.col("__b").isNull()
    return j.select(
        "bundle_id", bundle_label(F.col("product_name_1"), F.col("product_name_2")).alias("bundle_name"),
        "category", F.col("product_name_1").alias("product_a"), F.col("product_name_2").alias("product_b"),
        "product_a_price", "product_b_price",
        (F.col("product_a_price") + F.col("product_b_price")).alias("current_price_total"),
        F.col("__cogs_a").alias("product_a_cogs_raw"), F.col("__cogs_b").alias("product_b_cogs_raw"),
        eps.alias("eps"), safe_float(F.col("intercept_logk"), 0.0).alias("intercept"), r2.alias("r2"),
        F.col("n_price_points").alias("n_points"),
        F.when(invalid, F.lit(SKIP_INVALID)).when(missing, F.lit(SKIP_MISSING)).alias("skip_reason"),
    )


def pricing_skipped(ped: DataFrame, dim: DataFrame) -> DataFrame:
    """O2: bundles not priced and why."""
    e = bundle_economics(ped, dim)
    return e.filter(F.col("skip_reason").isNotNull()).select("bundle_id", "bundle_name", F.col("skip_reason").alias("reason"))


def price_recommendation(ped: DataFrame, dim: DataFrame, objective: str = "quantity") -> DataFrame:
    """O3/O5 (objective='quantity', the source's code) or O4 ('profit', its
    docstring): recommended bundle price, expected quantity and profit."""
    e = bundle_economics(ped, dim).filter(F.col("skip_reason").isNull())
    cogs = F.col("product_a_cogs_raw") + F.col("product_b_cogs_raw")
    cap = F.col("current_price_total")
    lower = F.greatest(cap * F.lit(1 - C.MIN_DISCOUNT_PCT), cogs / F.lit(1 - C.MIN_DISCOUNT_PCT))
    feasible = lower <= cap
    mid = (lower + cap) / F.lit(2.0)
    if objective == "quantity":
        best = lower
    else:
        eps = F.col("eps")
        interior = eps * cogs / (F.lit(1.0) + eps)
        best = F.when(eps >= -1, cap).otherwise(F.least(F.greatest(interior, lower), cap))
    price = F.when(feasible, best).otherwise(mid)
    k = F.exp(F.col("intercept"))
    qty = k * F.pow(price, F.col("eps"))
    return e.select(
        "bundle_id", "bundle_name", "category", "product_a", "product_b",
        "product_a_price", "product_b_price", "current_price_total",
        F.round("product_a_cogs_raw", 2).alias("product_a_cogs"), F.round("product_b_cogs_raw", 2).alias("product_b_cogs"),
        F.round(cogs, 2).alias("cogs_total"),
        F.round("eps", 6).alias("elasticity_epsilon"), F.round(k, 6).alias("base_demand_k"),
        F.round("r2", 6).alias("r_squared"), F.col("n_points").cast("int").alias("n_points"),
        F.round(price, 2).alias("bundle_price_recommended"), F.round(qty, 4).alias("quantity_demanded"),
        F.round((price - cogs) * qty, 2).alias("profit"), F.round(cap, 2).alias("price_cap"),
        F.lit(round(C.MIN_DISCOUNT_PCT * 100, 6)).alias("min_discount_pct"), feasible.alias("optimization_success"),
    )
