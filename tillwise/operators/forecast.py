"""Per-series forecasting.

A series is one value per period: its values are gathered into one array, and
the recursion is a fold over that array inside the JVM, so many series run in
parallel without Python.

Holt-Winters (additive trend and season of length m) starts as follows.  With
n >= 10 + 2 (m // 2) values: a centred moving average of length m over the first
full seasons (five at most, but enough for ten averages); the start season is the
mean of value less average by position in the season, less the mean of these; level
and trend are intercept and slope of the least-squares line through the first ten
averages at 1..10.  With fewer values: the mean of the first season, the mean of
the second season less it, over m, and first-season values less the level.  Then
  l_t = a (y_t - s_{t-m}) + (1-a)(l_{t-1} + b_{t-1})
  b_t = b (l_t - l_{t-1}) + (1-b) b_{t-1}
  s_t = g (y_t - l_{t-1} - b_{t-1}) + (1-g) s_{t-m}
  forecast(h) = l_T + h b_T + s_{T-m+1+((h-1) mod m)}
A series shorter than two seasons cannot be initialised and is reported as
skipped.  A series with a null value forecasts null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C

#: Averages that the line of the start state goes through, and seasons they are taken from at most.
START_POINTS, START_SEASONS = 10, 5
#: Parameter search: step of the first grid, and how often the span around the best point is halved.
GRID_STEP, ROUNDS = 0.05, 6


def _gathered(series: DataFrame) -> DataFrame:
    """One row per series: key, series, periods and values ``y`` in order of period."""
    s = series.groupBy(F.col("key").cast("string").alias("key"), F.col("series").cast("string").alias("series")).agg(
        F.array_sort(F.collect_list(F.struct("period", F.col("units").cast("double").alias("units")))).alias("__v"))
    return s.select("key", "series", F.col("__v.period").alias("periods"), F.col("__v.units").alias("y"))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, v: total + v)


def _with_start(rows: DataFrame, m: int) -> DataFrame:
    """``rows`` with the start state ``start`` (level, trend, season); null where ``y`` is shorter than two seasons."""
    half, n = m // 2, F.size("y")
    seasons = F.greatest(F.least(F.lit(START_SEASONS), F.floor(n / m)), F.ceil(F.lit((START_POINTS + 2 * half) / m)))
    used = F.least(n, (seasons * m).cast("int"))
    long = (n >= 2 * m) & (n >= START_POINTS + 2 * half)

    def average(i: Column) -> Column:
        if m % 2:
            return _sum(F.slice("y", i + 1, m)) / m
        return (F.get("y", i) / 2 + _sum(F.slice("y", i + 2, m - 1)) + F.get("y", i + m) / 2) / m

    positions = F.sequence(F.lit(0), F.lit(m - 1))
    rows = rows.withColumn("__avg", F.when(long, F.transform(F.sequence(F.lit(0), used - 2 * half - 1), average)))
    rows = rows.withColumn("__rest", F.transform("__avg", lambda a, i: F.get("y", i + half) - a))

    def seasonal(j: Column) -> Column:
        mine = F.filter("__rest", lambda r, i: (i + half) % m == j)
        return _sum(mine) / F.size(mine)

    rows = rows.withColumn("__raw", F.transform(positions, seasonal))
    mid = (START_POINTS + 1) / 2
    spread = sum((x - mid) ** 2 for x in range(1, START_POINTS + 1))
    first = F.slice("__avg", 1, START_POINTS)
    rows = rows.withColumn("__slope", _sum(F.transform(first, lambda a, i: (i + 1 - mid) * a)) / spread)
    mean = _sum(F.slice("y", 1, m)) / m
    state = F.when(long, F.struct(
        (_sum(first) / START_POINTS - mid * F.col("__slope")).alias("level"), F.col("__slope").alias("trend"),
        F.transform("__raw", lambda r: r - _sum("__raw") / m).alias("season"),
    )).when(n >= 2 * m, F.struct(
        mean.alias("level"), ((_sum(F.slice("y", m + 1, m)) / m - mean) / m).alias("trend"),
        F.transform(F.slice("y", 1, m), lambda v: v - mean).alias("season"),
    ))
    return rows.withColumn("start", state).drop("__avg", "__rest", "__raw", "__slope")


def _step(acc: Column, v: Column, alpha, beta, gamma, m: int) -> tuple[Column, list[Column]]:
    """One step of the recursion: the value expected, and the next level, trend and season (its head is the next position)."""
    base, s = acc["level"] + acc["trend"], F.get(acc["season"], F.lit(0))
    level = alpha * (v - s) + (1 - alpha) * base
    season = F.concat(F.slice(acc["season"], 2, m - 1), F.array(gamma * (v - base) + (1 - gamma) * s))
    return base + s, [level.alias("level"), (beta * (level - acc["level"]) + (1 - beta) * acc["trend"]).alias("trend"), season.alias("season")]


def _smoothed(rows: DataFrame, alpha, beta, gamma, m: int) -> DataFrame:
    """``rows`` with ``start`` plus ``end`` (state after the last value) and ``fits`` (a value per period)."""
    empty = F.array().cast("array<double>")

    def step(acc, v):
        expected, state = _step(acc, v, alpha, beta, gamma, m)
        return F.struct(*state, F.concat(acc["fits"], F.array(expected)).alias("fits"))

    start = F.struct(*[F.col(f"start.{c}").alias(c) for c in ("level", "trend", "season")], empty.alias("fits"))
    rows = rows.withColumn("end", F.when(F.col("start").isNotNull(), F.aggregate("y", start, step)))
    return rows.withColumn("fits", F.col("end.fits"))


def _error(point: Column, m: int) -> Column:
    """Sum of squared one-step errors with the parameters of ``point``."""
    a, b, g = point["alpha"], point["beta"], point["gamma"]

    def step(acc, v):
        expected, state = _step(acc, v, a, b, g, m)
        return F.struct(*state, (acc["sse"] + (v - expected) * (v - expected)).alias("sse"))

    start = F.struct(*[F.col(f"start.{c}").alias(c) for c in ("level", "trend", "season")], F.lit(0.0).alias("sse"))
    return F.aggregate("y", start, step, lambda acc: acc["sse"])


def _ahead(m: int, h: int) -> Column:
    """Steps 1..h past the end as an array of (step, forecast)."""
    return F.transform(F.sequence(F.lit(1), F.lit(h)), lambda k: F.struct(
        k.alias("step"), (F.col("end.level") + k * F.col("end.trend") + F.get("end.season", (k - 1) % m)).alias("forecast")))


def holt_winters(series: DataFrame, alpha=C.HW_ALPHA, beta=C.HW_BETA, gamma=C.HW_GAMMA,
                 m=C.SEASON_LENGTH, h=C.HORIZON) -> DataFrame:
    """Forecasts h steps past each series' own end.

    ``series``: (key, series, period, units).  Output: (key, series, step,
    forecast, status); status 'too_short' (one row, null forecast) when the
    series cannot be initialised."""
    rows = _smoothed(_with_start(_gathered(series), m), alpha, beta, gamma, m)
    known = F.col("start").isNotNull()
    none = F.array(F.struct(F.lit(None).cast("int").alias("step"), F.lit(None).cast("double").alias("forecast")))
    return rows.select("key", "series", F.when(known, "ok").otherwise("too_short").alias("status"),
                       F.explode(F.when(known, _ahead(m, h)).otherwise(none)).alias("f")) \
        .select("key", "series", "f.step", "f.forecast", "status")


def _by_period(rows: DataFrame) -> DataFrame:
    z = rows.select("key", "series", F.explode(F.arrays_zip("periods", "y", F.coalesce("fits", F.array().cast("array<double>")).alias("fits"))).alias("z"))
    return z.select("key", "series", F.col("z.periods").alias("period"), F.col("z.y").alias("actual"), F.col("z.fits").alias("fitted"))


def fitted_values(series: DataFrame, alpha=C.HW_ALPHA, beta=C.HW_BETA, gamma=C.HW_GAMMA,
                  m=C.SEASON_LENGTH) -> DataFrame:
    """One-step values beside the actual ones; null for series too short to start."""
    return _by_period(_smoothed(_with_start(_gathered(series), m), alpha, beta, gamma, m))


def forecast_metrics(fitted: DataFrame, lag: int = C.SEASON_LENGTH) -> DataFrame:
    """In-sample MAE, MSE, RMSE, WMAPE (%), MASE with a lag-``lag``
    naive scale (4 = seasonal naive for Holt-Winters, 1 for ARIMA-type models).
    The naive errors come from a lag window over each ordered series."""
    w = Window.partitionBy("key", "series").orderBy("period")
    f = fitted.filter(F.col("fitted").isNotNull() & ~F.isnan("fitted")).withColumns({
        "err": F.col("actual") - F.col("fitted"),
        "naive": F.abs(F.col("actual") - F.lag("actual", lag).over(w)),
    })
    agg = f.groupBy("key", "series").agg(
        F.avg(F.abs("err")).alias("mae"), F.avg(F.col("err") * F.col("err")).alias("mse"),
        F.sum(F.abs("err")).alias("__sae"), F.sum(F.abs("actual")).alias("__sa"), F.sum("actual").alias("__s"),
        F.avg("naive").alias("__scale"),
    )
    return agg.select(
        "key", "series", F.round("mae", 6).alias("mae"), F.round("mse", 6).alias("mse"),
        F.round(F.sqrt("mse"), 6).alias("rmse"),
        F.round(F.when(F.col("__s") != 0, F.col("__sae") / F.col("__sa") * 100), 6).alias("wmape"),
        F.round(F.when(F.col("__scale") != 0, F.col("mae") / F.col("__scale")), 6).alias("mase"),
    )


def _point(alpha, beta, gamma) -> Column:
    """A parameter point pulled into its bounds: 0 <= alpha <= 1, 0 <= beta <= alpha, 0 <= gamma <= 1 - alpha."""
    a = F.least(F.greatest(alpha, F.lit(0.0)), F.lit(1.0))
    return F.struct(a.alias("alpha"), F.least(F.greatest(beta, F.lit(0.0)), a).alias("beta"), F.least(F.greatest(gamma, F.lit(0.0)), 1 - a).alias("gamma"))


def tuned(series: DataFrame, m: int = 12) -> DataFrame:
    """One row per series with the parameters of least in-sample squared error, ``sse``, and the smoothed state.

    First all points of a grid of GRID_STEP inside the bounds, then ROUNDS times five values of each parameter around the
    best point, the span halved each time; ties go to the smaller parameters.  Series too short to start are left out."""
    rows = _with_start(_gathered(series), m).filter(F.col("start").isNotNull())
    n = round(1 / GRID_STEP)
    of = lambda c, i: F.struct(*[(x / F.lit(float(n))).alias(y) for x, y in zip((c["a"], c["b"], i), ("alpha", "beta", "gamma"))])
    pairs = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(n)), lambda a: F.transform(
        F.sequence(F.lit(0), a), lambda b: F.struct(a.alias("a"), b.alias("b")))))
    points = F.flatten(F.transform(pairs, lambda c: F.transform(F.sequence(F.lit(0), n - c["a"]), lambda g: of(c, g))))

    def best(points: Column) -> Column:
        return F.array_min(F.transform(points, lambda p: F.struct(_error(p, m).alias("sse"), p["alpha"].alias("alpha"), p["beta"].alias("beta"), p["gamma"].alias("gamma"))))

    rows = rows.withColumn("__points", points).withColumn("best", best(F.col("__points")))
    moves = [-1.0, -0.5, 0.0, 0.5, 1.0]
    cells = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.lit(g).alias("g")) for a in moves for b in moves for g in moves])
    for r in range(ROUNDS):
        span = GRID_STEP / 2 ** r
        rows = rows.withColumn("__points", F.transform(cells, lambda d: _point(*[F.col(f"best.{c}") + d[x] * span for c, x in (("alpha", "a"), ("beta", "b"), ("gamma", "g"))])))
        rows = rows.withColumn("best", best(F.col("__points")))
    rows = rows.select("key", "series", "periods", "y", "start", "best.*")
    return _smoothed(rows, F.col("alpha"), F.col("beta"), F.col("gamma"), m)


def holt_winters_tuned(series: DataFrame, m: int = 12, h: int = 12) -> DataFrame:
    """Forecasts with fitted parameters, see `tuned`."""
    return tuned(series, m).select("key", "series", "alpha", "beta", "gamma", F.round("sse", 6).alias("sse"), F.explode(_ahead(m, h)).alias("f")) \
        .select("key", "series", "alpha", "beta", "gamma", "sse", "f.step", F.round("f.forecast", 6).alias("forecast"))


def tuned_metrics(series: DataFrame, m: int = 12, lag: int = 1) -> DataFrame:
    """Metrics of the model with fitted parameters; the naive scale is the step from one period to the next."""
    return forecast_metrics(_by_period(tuned(series, m)), lag)
