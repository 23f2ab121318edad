"""Price scenario, cannibalisation and revenue impact.

One plan for all bundles: bundle metadata is a table of at most
``TOP_BUNDLES`` rows (fixed bound), the series and forecasts are long tables
keyed by bundle; everything is joins, pivots and row expressions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from . import elasticity as EL
from . import series as S
from .common import few_rows
from .forecast import holt_winters


def scenario_price(rules: DataFrame, ped: DataFrame, dim: DataFrame, recs: DataFrame | None,
                   discount: float = C.SCENARIO_DISCOUNT_RATE) -> DataFrame:
    """Per bundle row: ids, list prices, elasticity (non-strict
    preferred), new price = recommended price by bundle id, else list total
    less ``discount``; demand multiplier (new/current)^eps, 1 when current <= 0."""
    b = EL.resolve_bundles(EL.top_bundles(rules, None), dim)
    b = EL.pick_elasticity(b.select("bundle_id", "category", "rule_row", "product_id_1", "product_id_2",
                                    "antecedents_names", "consequents_names"), ped)
    b = b.filter(F.col("mode").isNotNull())
    price = dim.select("product_id", F.col("price").cast("double").alias("p"))
    b = (b.join(few_rows(price.withColumnRenamed("product_id", "product_id_1").withColumnRenamed("p", "price_a")), "product_id_1", "left")
         .join(few_rows(price.withColumnRenamed("product_id", "product_id_2").withColumnRenamed("p", "price_b")), "product_id_2", "left"))
    eps = F.coalesce(F.nanvl(F.col("elasticity_epsilon"), F.lit(0.0)), F.lit(0.0))
    cur = F.col("price_a") + F.col("price_b")
    if recs is not None:
        r = recs.select(F.col("bundle_id").alias("__rb"), F.col("bundle_price_recommended").cast("double").alias("__rec"))
        b = b.join(few_rows(r), F.col("bundle_id") == F.col("__rb"), "left")
        rec = F.nanvl(F.col("__rec"), F.lit(None).cast("double"))
    else:
        rec = F.lit(None).cast("double")
    new = F.coalesce(rec, cur * F.lit(1 - discount))
    mult = F.when(cur > 0, F.pow(new / cur, eps)).otherwise(F.lit(1.0))
    return b.select(
        "bundle_id", "category", F.col("rule_row").alias("bundle_row"), "product_id_1", "product_id_2",
        "antecedents_names", "consequents_names", eps.alias("epsilon"),
        "price_a", "price_b", cur.alias("current_price"), new.alias("new_price"), mult.alias("demand_multiplier"),
    )


def bundle_series_long(fact: DataFrame, sc: DataFrame) -> DataFrame:
    """(key=bundle_id, series, period, units) for the bundle and both products."""
    br = EL.bundle_receipts(fact, sc.select("bundle_id", "product_id_1", "product_id_2"))
    bundle = S.bundle_series(br).select(F.col("bundle_id").alias("key"), F.lit("bundle").alias("series"),
                                        "period", "units")
    ids = sc.select(F.explode(F.array("product_id_1", "product_id_2")).alias("product_id"))
    prod = S.product_series(fact, ids)
    roles = sc.select("bundle_id", F.posexplode(F.array("product_id_1", "product_id_2")).alias("pos", "product_id"))
    roles = roles.withColumn("series", F.when(F.col("pos") == 0, "antecedent").otherwise("consequent"))
    prod = prod.join(few_rows(roles), "product_id").select(F.col("bundle_id").alias("key"), "series",
                                                             "period", "units")
    return bundle.unionByName(prod)


def bundle_forecast(fact: DataFrame, sc: DataFrame, horizon: int = C.HORIZON) -> DataFrame:
    """V2/V3/V8 + T5/T6: actual rows (three unit columns) and forecast rows (six
    columns) per bundle.  Bundles with a series too short to initialise are
    skipped, as the source skips them."""
    long = bundle_series_long(fact, sc)
    fc = holt_winters(long, h=horizon)
    bad = fc.filter(F.col("status") != "ok").select("key").distinct()
    fc = fc.filter(F.col("status") == "ok")
    idx = S.forecast_index(long.withColumnRenamed("key", "bundle_id"), ["bundle_id"], horizon)
    piv = fc.groupBy(F.col("key").alias("bundle_id"), "step").pivot("series", ["bundle", "antecedent", "consequent"]) \
        .agg(F.first("forecast"))
    meta = sc.select("bundle_id", "bundle_row", "category", "demand_multiplier")
    f = idx.join(few_rows(piv), ["bundle_id", "step"], "left").join(few_rows(meta), "bundle_id")
    raw_b = F.coalesce(F.col("bundle"), F.lit(0.0))
    b_fc = F.greatest(raw_b, F.lit(0.0))
    a_fc = F.greatest(F.coalesce(F.col("antecedent"), F.lit(0.0)), F.lit(0.0))
    c_fc = F.greatest(F.coalesce(F.col("consequent"), F.lit(0.0)), F.lit(0.0))
    fcast = f.select(
        F.col("period").alias("date"), "bundle_id", "bundle_row", "category",
        b_fc.alias("bundle_units_forecast"), raw_b.alias("bundle_units_raw"),
        F.greatest(raw_b * F.col("demand_multiplier"), F.lit(0.0)).alias("bundle_units_adjusted_forecast"),
        a_fc.alias("antecedent_units_forecast"),
        F.greatest(a_fc - b_fc, F.lit(0.0)).alias("antecedent_units_after_cannibalization"),
        c_fc.alias("consequent_units_forecast"),
        F.greatest(c_fc - b_fc, F.lit(0.0)).alias("consequent_units_after_cannibalization"),
    )
    actual = S.series_align(long.withColumnRenamed("key", "bundle_id"), ["bundle_id"]).join(
        few_rows(meta.drop("demand_multiplier")), "bundle_id").select(
        F.col("period").alias("date"), "bundle_id", "bundle_row", "category",
        F.col("bundle").alias("bundle_units"), F.col("antecedent").alias("antecedent_units"),
        F.col("consequent").alias("consequent_units"))
    out = actual.unionByName(fcast, allowMissingColumns=True)
    return out.join(few_rows(bad.withColumnRenamed("key", "bundle_id")), "bundle_id", "left_anti")


def series_lengths(long: DataFrame) -> DataFrame:
    """Periods of a bundle's longest series (its own or either product's)."""
    n = long.groupBy("key", "series").agg(F.count(F.lit(1)).alias("n"))
    return n.groupBy(F.col("key").alias("bundle_id")).agg(F.max("n").alias("n_periods"))


def _cents(amount) -> F.Column:
    """An amount in cents, half up on its decimal value (a double's own half cents are not exact)."""
    return F.round(F.col(amount).cast("decimal(20,6)"), 2).cast("double")


def revenue_impact(forecast: DataFrame, sc: DataFrame) -> DataFrame:
    """V4: revenue before (A+B at list) and after (A', B' at list + bundle at the
    new price) over the horizon, absolute and % impact."""
    f = forecast.filter(F.col("bundle_units_forecast").isNotNull()).join(
        few_rows(sc.select("bundle_id", "price_a", "price_b", "new_price")), "bundle_id")
    before = F.col("antecedent_units_forecast") * F.col("price_a") + F.col("consequent_units_forecast") * F.col("price_b")
    after = (F.col("antecedent_units_after_cannibalization") * F.col("price_a")
             + F.col("consequent_units_after_cannibalization") * F.col("price_b")
             + F.col("bundle_units_adjusted_forecast") * F.col("new_price"))
    agg = f.groupBy("bundle_id", "category").agg(F.sum(before).alias("revenue_before"), F.sum(after).alias("revenue_after"),
                                                 F.first("new_price").alias("new_price"))
    impact = F.col("revenue_after") - F.col("revenue_before")
    return agg.select(
        "bundle_id", "category", _cents("new_price").alias("new_price"),
        F.round("revenue_before", 2).alias("revenue_before"), F.round("revenue_after", 2).alias("revenue_after"),
        F.round(impact, 2).alias("impact_abs"),
        F.round(F.when(F.col("revenue_before") != 0, impact / F.col("revenue_before") * 100), 4).alias("impact_pct"),
    )


def signed_units(impact: F.Column, price: F.Column) -> F.Column:
    """V5: floor(impact/price) when impact >= 0, else -ceil(-impact/price); 0 when price <= 0."""
    return (F.when(price <= 0, F.lit(0))
            .when(impact >= 0, F.floor(impact / price))
            .otherwise(-F.ceil(-impact / price))).cast("bigint")


def break_even_by_period(forecast: DataFrame, sc: DataFrame) -> DataFrame:
    """V6: per forecast period, the revenue gap (total impact < 0: bundles needed,
    ceiling) or surplus (floor) in bundle units at the new price."""
    f = forecast.filter(F.col("bundle_units_forecast").isNotNull()).join(
        few_rows(sc.select("bundle_id", "price_a", "price_b", "new_price")), "bundle_id")
    diff = ((F.col("antecedent_units_after_cannibalization") * F.col("price_a")
             + F.col("consequent_units_after_cannibalization") * F.col("price_b")
             + F.col("bundle_units_adjusted_forecast") * F.col("new_price"))
            - (F.col("antecedent_units_forecast") * F.col("price_a") + F.col("consequent_units_forecast") * F.col("price_b")))
    f = f.withColumn("diff", diff)
    tot = f.groupBy("bundle_id").agg(F.sum("diff").alias("total"))
    f = f.join(few_rows(tot), "bundle_id")
    gap = F.when(F.col("diff") < 0, -F.col("diff")).otherwise(F.lit(0.0))
    sur = F.when(F.col("diff") > 0, F.col("diff")).otherwise(F.lit(0.0))
    neg = F.col("total") < 0
    return f.select(
        "bundle_id", F.col("date").alias("period"),
        F.when(neg, "break_even").otherwise("surplus").alias("mode"),
        F.round(F.when(neg, gap).otherwise(sur), 2).alias("revenue_amount"),
        F.when(F.col("new_price") <= 0, F.lit(None)).when(neg, F.ceil(gap / F.col("new_price")))
        .otherwise(F.floor(sur / F.col("new_price"))).cast("bigint").alias("bundle_units"),
    )


def bundle_summary(forecast: DataFrame, sc: DataFrame, long: DataFrame, discount: float = C.SUMMARY_DISCOUNT_RATE,
                   horizon: int = C.HORIZON) -> DataFrame:
    """V7: one summary row per bundle at a ``discount`` bundle price: the raw bundle
    forecast takes the multiplier of that price and is clipped then; revenues,
    impact, signed bundle-unit equivalent of the unrounded impact, length of the
    longest of the three series and horizon."""
    new = F.col("current_price") * F.lit(1 - discount)
    priced = sc.select("bundle_id", "category", "antecedents_names", "consequents_names", "epsilon", "price_a", "price_b", "current_price",
                       new.alias("new_price")).withColumn(
        "multiplier", F.when((F.col("current_price") > 0) & (F.col("new_price") > 0), F.pow(F.col("new_price") / F.col("current_price"), F.col("epsilon"))).otherwise(F.lit(1.0)))
    f = forecast.filter(F.col("bundle_units_forecast").isNotNull()).drop("category").join(few_rows(priced), "bundle_id")
    before = F.col("antecedent_units_forecast") * F.col("price_a") + F.col("consequent_units_forecast") * F.col("price_b")
    after = (F.col("antecedent_units_after_cannibalization") * F.col("price_a")
             + F.col("consequent_units_after_cannibalization") * F.col("price_b")
             + F.greatest(F.col("bundle_units_raw") * F.col("multiplier"), F.lit(0.0)) * F.col("new_price"))
    g = f.groupBy("bundle_id", "category", "antecedents_names", "consequents_names", "current_price", "new_price").agg(
        F.sum(before).alias("before"), F.sum(after).alias("after")).join(few_rows(series_lengths(long)), "bundle_id", "left")
    impact = F.col("after") - F.col("before")
    return g.select(
        "bundle_id", "category", F.col("antecedents_names").alias("product_a"), F.col("consequents_names").alias("product_b"),
        _cents("current_price").alias("current_price"), _cents("new_price").alias("bundle_price"),
        F.round("before", 2).alias("revenue_before"), F.round("after", 2).alias("revenue_after"), F.round(impact, 2).alias("impact_abs"),
        F.round(F.when(F.col("before") != 0, impact / F.col("before") * 100), 4).alias("impact_pct"),
        signed_units(impact, F.col("new_price")).alias("bundle_units_equivalent"),
        F.coalesce("n_periods", F.lit(0)).alias("n_periods"), F.lit(horizon).alias("horizon"))
