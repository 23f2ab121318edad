"""Product dimension, current + history.

Both dimensions are catalogue-sized (one row per product / per product
state); every build is a hash aggregate over the lines followed by windows
over the already-aggregated states, so a hot product never lands in one task.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.products import parent_sku, product_category, product_cost

DIM_COLUMNS = (
    "product_id", "product_name", "price", "product_cost", "last_transaction_datetime",
    "record_version", "is_current", "parent_sku", "category",
)


def _datetime_col(df: DataFrame) -> F.Column:
    if "datetime" in df.columns:
        return F.col("datetime").cast("timestamp_ntz")
    if "date" in df.columns:
        return F.col("date").cast("timestamp_ntz")
    return F.lit(None).cast("timestamp_ntz")


def derived_columns(df: DataFrame, cost_lookup: DataFrame | None = None) -> DataFrame:
    """parent_sku (F1), category (F2), product_cost (F10) from name/id/price."""
    df = df.withColumns({
        "parent_sku": parent_sku(F.col("product_name")),
        "category": product_category(F.col("product_name"), F.col("product_id")),
    })
    if cost_lookup is not None:
        df = df.join(cost_lookup, "product_name", "left")
        cost = product_cost(F.col("category"), F.col("price"), F.col("matched_cost"))
    else:
        cost = product_cost(F.col("category"), F.col("price"))
    return df.withColumn("product_cost", cost)


def product_dim_current(lines: DataFrame, cost_lookup: DataFrame | None = None, seq_col: str = "seq") -> DataFrame:
    """Last non-null name, price and datetime per product (ingest order),
    version 1, current, plus derived columns.  On distinct lines the last
    position of each duplicate group (``seq_last``) orders "last"."""
    if "seq_last" in lines.columns:
        seq_col = "seq_last"
    dt = _datetime_col(lines)
    base = lines.select("product_id", "product_name", F.col("price").cast("decimal(10,2)").alias("price"),
                        dt.alias("__dt"), F.col(seq_col).alias("__seq"))

    # states of a product first: numbers are the only buffers, so the lines go through a hash aggregate and are not sorted
    seen = F.when(F.col("__dt").isNotNull(), F.col("__seq"))
    states = base.groupBy("product_id", "product_name", "price").agg(
        F.max("__seq").alias("__last"), F.max_by("__dt", seen).alias("__dt"), F.max(seen).alias("__dt_last"))

    def last_non_null(c: str) -> F.Column:
        return F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("__last")))

    cur = states.groupBy("product_id").agg(
        last_non_null("product_name").alias("product_name"),
        last_non_null("price").alias("price"),
        F.max_by("__dt", "__dt_last").alias("last_transaction_datetime"),
    ).withColumns({"record_version": F.lit(1), "is_current": F.lit(True)})
    return derived_columns(cur, cost_lookup).select(*DIM_COLUMNS)


def product_dim_history(lines: DataFrame, cost_lookup: DataFrame | None = None, seq_col: str = "seq") -> DataFrame:
    """One row per distinct (id, name, price) in first-seen order; version =
    running count per product; the highest version is current.  The datetime
    is that of the state's first row.  A price that returns to an old value
    adds no version."""
    dt = _datetime_col(lines)
    states = (
        lines.select("product_id", "product_name", F.col("price").cast("decimal(10,2)").alias("price"),
                     dt.alias("__dt"), F.col(seq_col).alias("__seq"))
        .groupBy("product_id", "product_name", "price")
        .agg(F.min("__seq").alias("__first"), F.min_by("__dt", "__seq").alias("last_transaction_datetime"))
    )
    w = Window.partitionBy("product_id").orderBy("__first")
    hist = states.withColumns({
        "record_version": F.row_number().over(w),
    }).withColumn(
        "is_current",
        F.col("record_version") == F.max("record_version").over(Window.partitionBy("product_id")),
    )
    return derived_columns(hist, cost_lookup).select(*DIM_COLUMNS)


def history_lookup(history: DataFrame, product_ids: DataFrame) -> DataFrame:
    """History rows of the products listed in ``product_ids`` (left semi join)."""
    ids = product_ids.select("product_id").distinct()
    return history.join(ids, "product_id", "left_semi")


def history_exists(spark: SparkSession, path: str) -> bool:
    """The history table exists and holds at least one row (drives P4)."""
    try:
        df = spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return not df.isEmpty()


def batch_latest(batch: DataFrame, seq_col: str = "seq") -> DataFrame:
    """Latest state per product in a batch: rows ordered by datetime (nulls
    last), ingest order breaking ties; last non-null value per column."""
    dt = _datetime_col(batch)
    b = batch.filter(F.col("product_id").isNotNull() & F.col("price").isNotNull()).select(
        "product_id", "product_name", F.col("price").cast("decimal(10,2)").alias("price"),
        dt.alias("__dt"), F.struct(dt.isNull().alias("n"), dt.alias("t"), F.col(seq_col).alias("s")).alias("__ord"),
    )

    def last_non_null(c: str) -> F.Column:
        return F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("__ord")))

    return b.groupBy("product_id").agg(
        last_non_null("product_name").alias("product_name"),
        last_non_null("price").alias("price"),
        last_non_null("__dt").alias("new_datetime"),
    )


def scd_incremental(batch: DataFrame, history: DataFrame, cost_lookup: DataFrame | None = None,
                    seq_col: str = "seq") -> tuple[DataFrame, DataFrame]:
    """Incremental SCD step.  Returns (current_rows, history_rows) to upsert.

    Per product in the batch's latest state:
      (a) no history      -> version 1, current;
      (b) same price      -> same version; last-seen datetime advanced only if
                             newer; the current row takes the new name, the
                             history row keeps the old one;
      (c) price differs   -> old row flagged not current, new row max+1.
    """
    latest = batch_latest(batch, seq_col)
    hist = history.join(latest.select("product_id"), "product_id", "left_semi")
    w = Window.partitionBy("product_id")
    cur = (
        hist.withColumns({
            "__max_rv": F.max("record_version").over(w),
            "__rank": F.row_number().over(w.orderBy(F.col("is_current").desc(), F.col("record_version").desc())),
        })
        .filter("__rank = 1")
        .select(*[F.col(c).alias("old_" + c) for c in DIM_COLUMNS], "__max_rv")
    )
    j = latest.join(cur, F.col("product_id") == F.col("old_product_id"), "left")
    new_derived = derived_columns(
        j.select("product_id", "product_name", "price"), cost_lookup
    ).select("product_id", F.col("parent_sku").alias("new_parent_sku"),
             F.col("category").alias("new_category"), F.col("product_cost").alias("new_cost"))
    j = j.join(new_derived, "product_id", "left")

    case_a = F.col("old_product_id").isNull()
    case_b = ~case_a & (F.col("price") == F.col("old_price"))
    advanced = F.when(
        F.col("new_datetime").isNotNull()
        & (F.col("old_last_transaction_datetime").isNull()
           | (F.col("new_datetime") > F.col("old_last_transaction_datetime"))),
        F.col("new_datetime"),
    ).otherwise(F.col("old_last_transaction_datetime"))

    def row(pid, name, price, cost, dt, rv, is_cur, psku, cat):
        return F.struct(
            pid.alias("product_id"), name.alias("product_name"), price.cast("decimal(10,2)").alias("price"),
            cost.cast("decimal(10,2)").alias("product_cost"), dt.alias("last_transaction_datetime"),
            rv.cast("int").alias("record_version"), is_cur.alias("is_current"),
            psku.alias("parent_sku"), cat.alias("category"),
        )

    new_row = row(F.col("product_id"), F.col("product_name"), F.col("price"), F.col("new_cost"),
                  F.col("new_datetime"), F.when(case_a, F.lit(1)).otherwise(F.col("__max_rv") + 1),
                  F.lit(True), F.col("new_parent_sku"), F.col("new_category"))
    old_kept = row(F.col("old_product_id"), F.col("old_product_name"), F.col("old_price"), F.col("old_product_cost"),
                   advanced, F.col("old_record_version"), F.lit(True), F.col("old_parent_sku"), F.col("old_category"))
    cur_same = row(F.col("product_id"), F.col("product_name"), F.col("old_price"), F.col("old_product_cost"),
                   advanced, F.col("old_record_version"), F.lit(True), F.col("old_parent_sku"), F.col("old_category"))
    old_closed = row(F.col("old_product_id"), F.col("old_product_name"), F.col("old_price"), F.col("old_product_cost"),
                     F.col("old_last_transaction_datetime"), F.col("old_record_version"), F.lit(False),
                     F.col("old_parent_sku"), F.col("old_category"))

    hist_rows = F.when(case_a, F.array(new_row)).when(case_b, F.array(old_kept)).otherwise(F.array(old_closed, new_row))
    cur_row = F.when(case_a, new_row).when(case_b, cur_same).otherwise(new_row)

    history_out = j.select(F.explode(hist_rows).alias("r")).select("r.*")
    current_out = j.select(cur_row.alias("r")).select("r.*")
    return current_out, history_out
