"""Data-quality flags (D1-D7): IQR outlier flags, row removal, value log and
the numeric-coercion report.

Exact quartiles are spread out: a mergeable quantile sketch gives values close below
and above each quartile, one count of the ranges between them says in which range
each neighbour of a quartile lies, and only the values of these ranges, some 4 / ACCURACY
of a group, are counted and ranked.  A value that is a bound is a range of its own, so a
frequent one is never ranked row by row.  Ranges follow the values' ranks, not their
size, so one extreme value changes nothing; where a sketch should err the range
that is found is larger, the result the same.  The rows are read three times and
never shuffled.  ``exact=False`` uses the bounded ``percentile_approx`` sketch alone.
"""

from __future__ import annotations

from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from .common import fixed_broadcast

METRICS = ("qty", "price", "line_total", "net_total")


#: Ranges of equal depth into which values are cut without other shares.
RANGES = 64
#: Accuracy of the sketch: a range is deeper than its share by 2 / ACCURACY at most.
ACCURACY = 10000
#: Shares around the quartiles that hold them whatever the sketch's error.
AROUND = tuple(q + d / ACCURACY for q in (0.25, 0.75) for d in (-2, 2))


def _range_of(v: F.Column, splits: F.Column, n: int) -> F.Column:
    """How many of the n rising splits are below v, by halving."""
    def among(lo: int, hi: int) -> F.Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(v > splits[mid], among(mid + 1, hi)).otherwise(among(lo, mid))
    return among(0, n)


def _joined(df: DataFrame, few: DataFrame, keys, fixed: bool) -> DataFrame:
    """Join on keys of which nulls match each other; `few` has a fixed number of rows where there are no groups."""
    few = few.withColumnsRenamed({k: f"__{k}" for k in keys})
    few = fixed_broadcast(few) if fixed else few
    return df.join(few, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]).drop(*[f"__{k}" for k in keys])


def _ranges(values: DataFrame, keys, fixed: bool, shares=tuple(i / RANGES for i in range(1, RANGES))) -> DataFrame:
    """The values with the number of their range among the values of the same keys, by bounds at the given
    shares; a value that is a bound has a number of its own between those of its neighbours."""
    splits = values.groupBy(*keys).agg(F.percentile_approx("v", list(shares), ACCURACY).alias("splits"))
    v, below = F.col("v"), F.col("__below")
    cut = _joined(values, splits, keys, fixed).withColumn("__below", _range_of(v, F.col("splits"), len(shares)))
    bound = F.coalesce(v == F.get("splits", below), F.lit(False))
    return cut.withColumn("bucket", below * 2 + bound.cast("int")).drop("splits", "__below")


def _exact_quartiles(df: DataFrame, metrics, by, log_metrics) -> DataFrame:
    """Group columns, metric, q1, q3 (linear interpolation between neighbours); nulls are left out."""
    by = list(by)
    values = []
    for m in metrics:
        x = F.col(m).cast("double")
        values.append(F.struct(F.lit(m).alias("metric"), (F.when(x > 0, F.ln(x)) if m in log_metrics else x).alias("v")))
    long = df.select(*by, F.explode(F.array(*values)).alias("x")).select(*by, "x.metric", "x.v").filter(F.col("v").isNotNull())
    group, fixed = [*by, "metric"], not by
    held = _ranges(long, group, fixed, AROUND)
    # at most 2 * len(AROUND) + 1 rows for each of the groups
    ranges = held.groupBy(*group, "bucket").agg(F.count(F.lit(1)).alias("n"))
    running = F.coalesce(F.sum("n").over(Window.partitionBy(*group).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranges = ranges.withColumns({"below": running, "all": F.sum("n").over(Window.partitionBy(*group))})
    ranks = F.explode(F.array(*[F.struct(F.lit(q).alias("q"), ((F.col("all") - 1) * F.lit(q)).alias("at")) for q in (0.25, 0.75)]))
    ranges = ranges.withColumn("r", ranks).select(*group, "bucket", "n", "below", "r.q", "r.at")
    wanted = ranges.filter((F.col("below") <= F.ceil("at")) & (F.col("below") + F.col("n") > F.floor("at")))
    held = _joined(held, wanted.select(*group, "bucket", "q", "at", "below"), [*group, "bucket"], fixed)
    keys = [*group, "q", "at", "below"]
    held = held.groupBy(*keys, "v").agg(F.count(F.lit(1)).alias("c"))
    before = F.coalesce(F.sum("c").over(Window.partitionBy(*keys).orderBy("v").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = held.withColumn("below", before + F.col("below"))
    has = lambda rank: (F.col("below") <= rank) & (rank < F.col("below") + F.col("c"))
    pick = lambda rank: F.max(F.when(has(rank), F.col("v")))
    two = ranked.groupBy(*group, "q", "at").agg(pick(F.floor("at")).alias("a"), pick(F.ceil("at")).alias("b"))
    value = F.col("a") + (F.col("b") - F.col("a")) * (F.col("at") - F.floor("at"))
    return two.groupBy(*group).agg(F.max(F.when(F.col("q") == 0.25, value)).alias("q1"), F.max(F.when(F.col("q") == 0.75, value)).alias("q3"))


def _quartiles(df: DataFrame, metrics, by, log_metrics, exact: bool) -> DataFrame:
    """One row per group with ``__q_<m>``, an array of the two quartiles of each metric."""
    by = list(by)
    if exact:
        q = _exact_quartiles(df, metrics, by, log_metrics)
        return q.groupBy(*by).agg(*[F.max(F.when(F.col("metric") == m, F.array("q1", "q3"))).alias(f"__q_{m}") for m in metrics])
    aggs = []
    for m in metrics:
        x = F.col(m).cast("double")
        aggs.append(F.percentile_approx(F.when(x > 0, F.ln(x)) if m in log_metrics else x, F.array(F.lit(0.25), F.lit(0.75)), 10000).alias(f"__q_{m}"))
    return df.groupBy(*by).agg(*aggs)


def iqr_bounds_wide(df: DataFrame, metrics=METRICS, k: dict | float = C.IQR_K, by=(), log_metrics=(),
                    exact: bool = True) -> DataFrame:
    """One row per group with ``lower_<m>``/``upper_<m>`` Tukey bounds;
    metrics in ``log_metrics`` get quartiles in log space, bounds mapped back."""
    ks = k if isinstance(k, dict) else {m: k for m in metrics}
    q = _quartiles(df, metrics, by, log_metrics, exact)
    cols = []
    for m in metrics:
        q1, q3 = F.col(f"__q_{m}")[0], F.col(f"__q_{m}")[1]
        lo, hi = q1 - F.lit(ks[m]) * (q3 - q1), q3 + F.lit(ks[m]) * (q3 - q1)
        if m in log_metrics:
            lo, hi = F.exp(lo), F.exp(hi)
        cols += [F.round(lo, 6).alias(f"lower_{m}"), F.round(hi, 6).alias(f"upper_{m}")]
    return q.select(*by, *cols)


def iqr_bounds(df: DataFrame, metrics=METRICS, k: dict | float = C.IQR_K, by=(), log_metrics=(),
               exact: bool = True) -> DataFrame:
    """Long form of :func:`iqr_bounds_wide`: (group..., metric, k, lower, upper)."""
    ks = k if isinstance(k, dict) else {m: k for m in metrics}
    w = iqr_bounds_wide(df, metrics, ks, by, log_metrics, exact)
    rows = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.lit(float(ks[m])).alias("k"),
                                        F.col(f"lower_{m}").alias("lower"), F.col(f"upper_{m}").alias("upper"))
                               for m in metrics]))
    return w.select(*by, rows.alias("r")).select(*by, "r.*")


def outlier_flags(df: DataFrame, metrics=METRICS, k=C.IQR_K, by=(), log_metrics=(), exact: bool = True) -> DataFrame:
    """One boolean flag column per metric plus ``n_flags``.  Without groups
    the bounds are one scalar subquery (a struct); with groups a join on the
    group keys (one row per group)."""
    # a row per group, kept as a caller may read the flagged rows more than once
    w = iqr_bounds_wide(df, metrics, k, by, log_metrics, exact).persist(StorageLevel.MEMORY_AND_DISK)
    if by:
        w = w.withColumnsRenamed({c: f"__{c}" for c in by})
        j = df.join(w, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in by], "left")
        bound = lambda c: F.col(c)
    else:
        j = df
        b = w.select(F.struct(*w.columns).alias("b")).scalar()
        bound = lambda c: b[c]
    flags = {}
    for m in metrics:
        x = F.col(m).cast("double")
        flags[f"flag_{m}"] = F.coalesce((x < bound(f"lower_{m}")) | (x > bound(f"upper_{m}")), F.lit(False))
    j = j.withColumns(flags).select(*df.columns, *flags.keys())
    n = reduce(lambda a, c: a + F.col(c).cast("int"), flags.keys(), F.lit(0))
    return j.withColumn("n_flags", n)


def outlier_rows_removed(flagged: DataFrame, min_flags: int = C.OUTLIER_MIN_FLAGS) -> tuple[DataFrame, DataFrame]:
    """(kept, removed): a row goes only when >= ``min_flags`` metrics are flagged."""
    return flagged.filter(F.col("n_flags") < min_flags), flagged.filter(F.col("n_flags") >= min_flags)


def outlier_value_log(df: DataFrame, id_cols, metrics=METRICS, k=C.IQR_K, method: str = "iqr",
                      exact: bool = True) -> DataFrame:
    """One row per flagged value: ids, column, value, method, k, bounds and
    the deviation beyond the violated bound."""
    b = F.broadcast(iqr_bounds(df, metrics, k, exact=exact))
    long = df.select(*id_cols, F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics])).alias("v")) \
        .select(*id_cols, "v.metric", "v.value")
    j = long.join(b, "metric")
    out = j.filter((F.col("value") < F.col("lower")) | (F.col("value") > F.col("upper")))
    dev = F.when(F.col("value") < F.col("lower"), F.col("value") - F.col("lower")).otherwise(F.col("value") - F.col("upper"))
    return out.select(*id_cols, F.col("metric").alias("column"), "value", F.lit(method).alias("method"), "k",
                      "lower", "upper", F.round(dev, 6).alias("deviation"))


def coercion_report(df: DataFrame, cols) -> DataFrame:
    """Per column, values that are present but not numeric (nulls introduced
    by numeric coercion)."""
    aggs = [F.count_if(F.col(c).isNotNull() & F.col(c).cast("string").try_cast("double").isNull()).alias(c)
            for c in cols]
    wide = df.agg(*aggs)
    return wide.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls_introduced"))
                                          for c in cols])).alias("r")).select("r.*")
