"""Cleaning and standardisation of the raw reports.

All functions are plan-time decisions on ``df.columns`` plus lazy column
expressions; none trigger a job.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.text import name_key, normalize_name, to_snake_case


def union_align(frames: list[DataFrame]) -> DataFrame:
    """Union of reports with different columns; missing -> null; sorted column order."""
    if not frames:
        raise ValueError("union_align needs at least one DataFrame")
    cols = sorted({c for f in frames for c in f.columns})
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return out.select(*cols)


def drop_columns(df: DataFrame, cols) -> DataFrame:
    """Drop listed columns when present."""
    return df.drop(*[c for c in cols if c in df.columns])


def snake_case(df: DataFrame) -> DataFrame:
    """Rename every column to snake_case."""
    return df.toDF(*[to_snake_case(c) for c in df.columns])


def rename_receipt(df: DataFrame) -> DataFrame:
    """C4: ``Receipt#`` -> ``Receipt No`` (before snake-casing)."""
    return df.withColumnsRenamed({"Receipt#": "Receipt No"}) if "Receipt#" in df.columns else df


def fact_projection(df: DataFrame, priority=C.FACT_PRIORITY_COLUMNS, drop=("time", "datetime")) -> DataFrame:
    """Priority columns first (when present), the rest after; time/datetime removed."""
    first = [c for c in priority if c in df.columns]
    rest = [c for c in df.columns if c not in first and c not in drop]
    return df.select(*first, *rest)


def _not_blank(c: str) -> F.Column:
    return F.col(c).isNotNull() & (F.trim(F.col(c).cast("string")) != "")


def drop_blank_datetime(df: DataFrame, date_col: str = "date", time_col: str = "time") -> DataFrame:
    """Drop rows whose date or time is null/blank (each only if the column exists)."""
    cond = F.lit(True)
    for c in (date_col, time_col):
        if c in df.columns:
            cond = cond & _not_blank(c)
    return df.filter(cond)


def coerce_date(c: F.Column) -> F.Column:
    """Text -> DATE, invalid -> null (ANSI-safe)."""
    s = F.trim(c.cast("string"))
    return F.coalesce(
        F.try_to_date(s, "yyyy-MM-dd"),
        F.try_to_date(s, "M/d/yyyy"),
        F.try_to_timestamp(s).cast("date"),
    )


def coerce_dates(df: DataFrame, cols=("date",)) -> DataFrame:
    """C7 on the listed columns that exist."""
    return df.withColumns({c: coerce_date(F.col(c)) for c in cols if c in df.columns})


def combine_datetime(df: DataFrame, date_col: str = "date", time_col: str = "time", out: str = "datetime") -> DataFrame:
    """Date + time text -> timestamp (invalid -> null); only when both exist."""
    if date_col not in df.columns or time_col not in df.columns:
        return df
    txt = F.concat_ws(" ", F.col(date_col).cast("string"), F.trim(F.col(time_col).cast("string")))
    ts = F.coalesce(
        F.try_to_timestamp(txt, F.lit("yyyy-MM-dd H:mm:ss")),
        F.try_to_timestamp(txt, F.lit("yyyy-MM-dd H:mm")),
        F.try_to_timestamp(txt),
    )
    return df.withColumn(out, ts.cast("timestamp_ntz"))


def numeric_sanity_filter(df: DataFrame, time_col: str = "time") -> DataFrame:
    """Only when a time column exists: price within [0, 50000], and qty,
    line_total, net_total, price >= 0; non-numeric values drop the row."""
    if time_col not in df.columns:
        return df
    cond = F.lit(True)
    if "price" in df.columns:
        p = F.col("price").cast("string").try_cast("double")
        cond = cond & p.between(C.PRICE_MIN, C.PRICE_MAX)
    for c in ("qty", "line_total", "net_total", "price"):
        if c in df.columns:
            cond = cond & (F.col(c).cast("string").try_cast("double") >= 0)
    return df.filter(F.coalesce(cond, F.lit(False)))


def rule_maps() -> tuple[F.Column, F.Column]:
    """C11 rules as two constant maps, by id and by name: key to (rule_no, to_id, to_name)
    (a key listed twice keeps its first rule)."""
    by_id: dict[str, F.Column] = {}
    by_name: dict[str, F.Column] = {}
    for no, (ids, names, to_id, to_name) in enumerate(C.STANDARDIZATION_RULES, start=1):
        rule = F.struct(F.lit(no).alias("rule_no"), F.lit(to_id).alias("to_id"), F.lit(to_name).alias("to_name"))
        for found, keys in ((by_id, ids), (by_name, [n.strip().upper() for n in names])):
            for k in keys:
                found.setdefault(k, rule)
    return tuple(F.create_map(*[x for k, rule in found.items() for x in (F.lit(k), rule)]) for found in (by_id, by_name))


def standardize_products(df: DataFrame, id_col: str = "product_id", name_col: str = "product_name") -> DataFrame:
    """C11: rewrite id and name by the first rule whose ids contain the id or whose
    names contain the upper-trimmed name.  Two lookups in constant maps (the rules are
    fixed), no join."""
    by_id, by_name = rule_maps()
    j = df.withColumns({
        "__rid": by_id[F.col(id_col).cast("string")],
        "__rnm": by_name[F.upper(F.trim(F.col(name_col).cast("string")))],
    })
    use_id = F.col("__rid").isNotNull() & (F.col("__rnm").isNull() | (F.col("__rid.rule_no") <= F.col("__rnm.rule_no")))
    use_nm = F.col("__rnm").isNotNull() & ~use_id
    j = j.withColumns({
        id_col: F.when(use_id, F.col("__rid.to_id")).when(use_nm, F.col("__rnm.to_id")).otherwise(F.col(id_col)),
        name_col: F.when(use_id, F.col("__rid.to_name")).when(use_nm, F.col("__rnm.to_name")).otherwise(F.col(name_col)),
    })
    return j.select(*df.columns)


def first_seen_ids(df: DataFrame, id_col: str = "product_id", name_col: str = "product_name", seq_col: str = "seq") -> DataFrame:
    """First-seen id of each trimmed, case-folded name, and where it was seen.  The rows
    are counted down to one for each name and id by a hash aggregate (a number is its only
    buffer), so no row is sorted; the id of a name is picked from those few."""
    seen = (
        df.filter(F.col(id_col).isNotNull() & F.col(name_col).isNotNull())
        .groupBy(name_key(F.col(name_col)).alias("__name_key"), F.col(id_col).alias("__id")).agg(F.min(seq_col).alias("__seq"))
    )
    return seen.groupBy("__name_key").agg(F.min_by("__id", "__seq").alias("__canon_id"), F.min("__seq").alias(seq_col))


def canonical_product_ids(df: DataFrame, id_col: str = "product_id", name_col: str = "product_name",
                          seq_col: str = "seq") -> DataFrame:
    """C12 lookup: first-seen id per trimmed, case-folded name.  Partial
    aggregation makes it skew-proof (one hot product collapses map-side)."""
    return first_seen_ids(df, id_col, name_col, seq_col).select("__name_key", "__canon_id")


def canonical_product_id(df: DataFrame, id_col: str = "product_id", name_col: str = "product_name",
                         seq_col: str = "seq") -> DataFrame:
    """Every row takes the first-seen id of its name; unmapped rows keep their id."""
    return apply_canonical_ids(df, canonical_product_ids(df, id_col, name_col, seq_col), id_col, name_col)


def apply_canonical_ids(df: DataFrame, lookup: DataFrame, id_col: str = "product_id", name_col: str = "product_name") -> DataFrame:
    """C12 with a lookup of one row per distinct name (in the warehouse a stored table, of known size)."""
    j = df.join(lookup, name_key(F.col(name_col)) == F.col("__name_key"), "left")
    return j.withColumn(id_col, F.coalesce(F.col("__canon_id"), F.col(id_col))).select(*df.columns)


def normalize_names(df: DataFrame, name_col: str = "product_name") -> DataFrame:
    """Upper + trim product names."""
    return df.withColumn(name_col, normalize_name(F.col(name_col)))


def exclude_latest_month(df: DataFrame, date_col: str = "date") -> DataFrame:
    """C14: drop rows of the latest month present; null dates survive.

    The latest month is a scalar subquery (one value, computed once by Spark,
    never collected into Python)."""
    latest = df.select(F.max(F.trunc(F.col(date_col), "MM"))).scalar()
    return df.filter(~F.trunc(F.col(date_col), "MM").eqNullSafe(latest))


def require_columns(df: DataFrame, cols, name: str = "input") -> DataFrame:
    """Fail at plan time with the list of missing columns."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"{name} is missing columns: {missing}")
    return df


def drop_missing(df: DataFrame, cols) -> DataFrame:
    """Drop rows with a null in any listed column."""
    return df.na.drop(subset=[c for c in cols if c in df.columns])
