"""Polynomial demand fits in price (E4-E7): power sums and closed-form solutions.

Prices are mapped to [-1, 1] per bundle, sums of powers are one aggregate, and
the normal equations of degree 1 to 3 are solved by Cramer's rule as row
expressions, so nothing leaves the JVM and a bundle costs one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DEGREES = (1, 2, 3)
GRID = 200
MARGIN = 0.2


def _det(m: list[list[str]]) -> str:
    if len(m) == 1:
        return m[0][0]
    terms = []
    for j, x in enumerate(m[0]):
        minor = [row[:j] + row[j + 1:] for row in m[1:]]
        terms.append(f"{'-' if j % 2 else '+'} {x} * ({_det(minor)})")
    return " ".join(terms).lstrip("+ ")


def coefficient_sql(degree: int, j: int) -> str:
    """Coefficient of the j-th power from sums s0..s6 (of powers) and t0..t3 (of demand times powers)."""
    a = [[f"s{r + c}" for c in range(degree + 1)] for r in range(degree + 1)]
    b = [[f"t{r}" if c == j else f"s{r + c}" for c in range(degree + 1)] for r in range(degree + 1)]
    return f"({_det(b)}) / ({_det(a)})"


def value_sql(degree: int, x: str) -> str:
    return " + ".join(f"c{degree}_{j} * pow({x}, {j})" for j in range(degree + 1))


def _on_unit(price: F.Column) -> F.Column:
    half = (F.col("p_max") - F.col("p_min")) / 2
    return (price - (F.col("p_max") + F.col("p_min")) / 2) / half


def polynomial_fit(points: DataFrame) -> DataFrame:
    """Per bundle with two or more price points: the degree (1 to 3, the lowest
    of equal R^2) with the best in-sample R^2, its coefficients on the unit scale
    and the price range.  A degree needs more points than itself; constant demand
    has no R^2 and takes degree 1."""
    p = points.select("bundle_id", F.col("combined_price").cast("double").alias("p"), F.col("num_transactions").cast("double").alias("y"))
    rng = p.groupBy("bundle_id").agg(F.min("p").alias("p_min"), F.max("p").alias("p_max"), F.count(F.lit(1)).alias("n"), F.avg("y").alias("y_mean")).filter("n > 1")
    u = p.join(rng, "bundle_id").withColumn("u", _on_unit(F.col("p")))
    sums = u.groupBy("bundle_id").agg(
        *[F.sum(F.pow("u", F.lit(k))).alias(f"s{k}") for k in range(7)], *[F.sum(F.col("y") * F.pow("u", F.lit(k))).alias(f"t{k}") for k in range(4)])
    coef = sums.join(rng, "bundle_id")
    for d in DEGREES:
        coef = coef.withColumns({f"c{d}_{j}": F.when(F.col("n") > d, F.expr(coefficient_sql(d, j))) for j in range(d + 1)})
    fitted = u.select("bundle_id", "u", "y").join(coef, "bundle_id")
    sse = fitted.groupBy("bundle_id").agg(
        F.sum((F.col("y") - F.col("y_mean")) ** 2).alias("sst"),
        *[F.sum((F.col("y") - F.expr(value_sql(d, "u"))) ** 2).alias(f"sse{d}") for d in DEGREES])
    r2 = {d: F.round(1 - F.col(f"sse{d}") / F.nullif("sst", F.lit(0.0)), 9) for d in DEGREES}
    out = coef.join(sse, "bundle_id").withColumns({f"r2_{d}": r2[d] for d in DEGREES})
    best = F.greatest(*[f"r2_{d}" for d in DEGREES])
    degree = F.lit(None).cast("int")
    for d in reversed(DEGREES):
        degree = F.when(F.col(f"r2_{d}") == best, F.lit(d)).otherwise(degree)
    return out.withColumn("degree", F.coalesce(degree, F.lit(1))).withColumn("r2", best)


def _predicted(price: F.Column) -> F.Column:
    """Demand at a price by the chosen polynomial of a joined fit row."""
    out = F.lit(None).cast("double")
    for d in DEGREES:
        value = F.lit(0.0)
        for j in range(d + 1):
            value = value + F.col(f"c{d}_{j}") * F.pow(_on_unit(price), F.lit(j))
        out = F.when(F.col("degree") == d, value).otherwise(out)
    return out


def polynomial_demand(points: DataFrame, grid: int = GRID) -> DataFrame:
    """Degree, R^2 and predicted demand on a grid over the price range and a fifth beyond it."""
    f = polynomial_fit(points)
    span = F.col("p_max") - F.col("p_min")
    lo, hi = F.greatest(F.lit(0.0), F.col("p_min") - span * MARGIN), F.col("p_max") + span * MARGIN
    g = f.withColumn("grid_index", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))))
    price = lo + F.col("grid_index") * ((hi - lo) / (grid - 1))
    return g.select("bundle_id", "degree", F.round("r2", 6).alias("r2"), "grid_index", F.round(price, 6).alias("price"), F.round(_predicted(price), 4).alias("demand"))


def regression_metrics(points: DataFrame) -> DataFrame:
    """E5: R^2, MSE, RMSE, MAE, WMAPE (%) and MASE (scale: mean step between neighbouring prices)."""
    by_price = Window.partitionBy("bundle_id").orderBy("p")
    p = points.select("bundle_id", F.col("combined_price").cast("double").alias("p"), F.col("num_transactions").cast("double").alias("y"))
    e = p.join(polynomial_fit(points), "bundle_id").withColumns({"e": F.abs(F.col("y") - _predicted(F.col("p"))), "step": F.abs(F.col("y") - F.lag("y").over(by_price))})
    m = e.groupBy("bundle_id", "degree", "r2").agg(F.avg(F.col("e") ** 2).alias("mse"), F.avg("e").alias("mae"), F.sum("e").alias("se"), F.sum(F.abs("y")).alias("sy"), F.avg("step").alias("scale"))
    return m.select("bundle_id", "degree", F.round("r2", 6).alias("r2"), F.round("mse", 6).alias("mse"), F.round(F.sqrt("mse"), 6).alias("rmse"), F.round("mae", 6).alias("mae"),
                    F.round(F.col("se") / F.nullif("sy", F.lit(0.0)) * 100, 6).alias("wmape"), F.round(F.col("mae") / F.nullif("scale", F.lit(0.0)), 6).alias("mase"))


def price_what_if(points: DataFrame, prices: DataFrame) -> DataFrame:
    """For (bundle_id, current_price, new_price): demand at both, floored at 0 for
    the new one, and the change in per cent where the baseline is above 0."""
    j = prices.join(polynomial_fit(points), "bundle_id")
    base, new = _predicted(F.col("current_price")), _predicted(F.col("new_price"))
    return j.select("bundle_id", F.round("current_price", 2).alias("current_price"), F.round("new_price", 2).alias("new_price"), F.round(base, 4).alias("baseline_demand"),
                    F.round(F.greatest(F.lit(0.0), new), 4).alias("predicted_demand"), F.round(F.when(base > 0, (new - base) / base * 100), 4).alias("change_pct"))
