"""Catalogue entries for report intake, sinks, streaming and the end-to-end run, regression,
costing and mining parameters.  Reports and files are written from the given tables first."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from .. import config as C
from ..functions import products as P
from ..operators import baskets as B
from ..operators import cleaning as CL
from ..operators import costing, regression
from ..operators import elasticity as EL
from ..operators import upsert as U
from ..session import shared_path
from ..sources import reports as R
from ..sources.tables import read_table
from . import catalog
from .catalog import PRICE_BIN, Q_CONF, Q_LIFT, Q_SUPPORT, register, wh
from .oracle_sql import basket_ctes, category_sql, elasticity_ctes, q


def _folder(spark, name: str) -> str:
    return shared_path(spark, "exchange", f"{name}-{uuid.uuid4().hex}")


# --- report intake (S1-S4, S7, C2-C5, C13, C15, C18) ---------------------------------

@register("list_reports", "SELECT 'file=' || o_orderpriority AS folder, TRUE AS listed FROM orders GROUP BY 1")
def list_reports(spark, sf_dir):
    """One folder of CSV parts per order priority is written and listed by suffix."""
    path = _folder(spark, "reports")
    o = read_table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("file"), "o_orderkey")
    o.write.partitionBy("file").csv(path)
    found = R.list_reports(spark, path, ".CSV")
    return found.select(F.url_decode(F.regexp_extract("path", r"/([^/]+)/[^/]+$", 1)).alias("folder")).distinct().withColumn("listed", F.lit(True))


_FILE = """CASE o_orderkey % 4 WHEN 0 THEN 'Sales Transaction List ' || o_orderkey || '.xlsx' WHEN 1 THEN 'Sales Report by Product ' || o_orderkey || '.CSV'
  WHEN 2 THEN 'Sales Transaction List ' || o_orderkey || '.txt' ELSE 'Stock ' || o_orderkey || '.csv' END"""


@register("route_files", f"""
SELECT file_name, CASE WHEN o_orderkey % 4 = 0 THEN 'sales' WHEN o_orderkey % 4 = 1 THEN 'product' END AS dataset,
       CASE WHEN o_orderkey % 4 = 2 THEN 'unsupported extension' WHEN o_orderkey % 4 = 3 THEN 'unrecognised report name' END AS reject_reason
FROM (SELECT o_orderkey, {_FILE} AS file_name FROM orders)""")
def route_files(spark, sf_dir):
    return R.route_files(read_table(spark, sf_dir, "orders").select(F.expr(_FILE).alias("file_name")))


def _grid(spark, sf_dir):
    """Orders as report grids, one per priority: the title, a header row whose place depends on the file, the cells."""
    o = read_table(spark, sf_dir, "orders")
    head = F.substring("o_orderpriority", 1, 1).cast("long")
    files = o.select(F.col("o_orderpriority").alias("file"), head.alias("head")).distinct()
    text = lambda *c: F.array(*[F.lit(x).cast("string") if x is None or isinstance(x, str) else x.cast("string") for x in c])
    title = files.select("file", F.lit(0).cast("long").alias("row_idx"), text("Report", None, None, None).alias("cells"))
    names = files.select("file", F.col("head").alias("row_idx"), text("Date", "Receipt No", None, "Total").alias("cells"))
    rows = o.select(F.col("o_orderpriority").alias("file"), (head + 1 + F.col("o_orderkey")).alias("row_idx"),
                    text(F.date_format("o_orderdate", "yyyy-MM-dd"), F.col("o_orderkey"), F.col("o_orderstatus"), F.col("o_totalprice").cast("decimal(14,2)")).alias("cells"))
    return title.unionByName(names).unionByName(rows)


@register("detect_header", "SELECT DISTINCT o_orderpriority AS file, CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS header_idx FROM orders")
def detect_header(spark, sf_dir):
    return R.detect_header(_grid(spark, sf_dir))


@register("apply_header", """
SELECT o_orderpriority AS file, strftime(o_orderdate, '%Y-%m-%d') AS "Date", CAST(o_orderkey AS VARCHAR) AS "Receipt No",
       CAST(CAST(o_totalprice AS DECIMAL(14,2)) AS VARCHAR) AS "Total", CAST(NULL AS VARCHAR) AS "Time" FROM orders""")
def apply_header(spark, sf_dir):
    g = _grid(spark, sf_dir)
    return R.project_records(R.apply_header(g, R.detect_header(g)), ["Date", "Receipt No", "Total", "Time"]).drop("row_idx")


@register("scan_csv", "SELECT o_orderkey, o_orderstatus, CAST(o_orderdate AS DATE) AS o_orderdate, o_comment_len FROM (SELECT *, CAST(length(o_orderpriority) AS INTEGER) AS o_comment_len FROM orders)")
def scan_csv(spark, sf_dir):
    path = _folder(spark, "csv")
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", F.col("o_orderdate").cast("date").alias("o_orderdate"), F.length("o_orderpriority").alias("o_comment_len"))
    o.write.option("header", True).csv(path)
    return R.scan_csv(spark, path, o.schema)


@register("scan_table", "SELECT * FROM nation UNION ALL SELECT * FROM nation WHERE FALSE")
def scan_table(spark, sf_dir):
    return read_table(spark, sf_dir, "nation")


@register("drop_columns", "SELECT receipt_no, product_id, qty, line_total, take_out FROM (SELECT l_orderkey AS receipt_no, l_partkey AS product_id, l_quantity AS qty, l_extendedprice AS line_total, l_returnflag AS take_out FROM lineitem)")
def drop_columns(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("receipt_no"), F.col("l_partkey").alias("product_id"), F.col("l_quantity").alias("qty"), F.col("l_extendedprice").alias("line_total"),
        F.col("l_returnflag").alias("take_out"), F.col("l_linestatus").alias("Posted"), F.col("l_discount").alias("% Discount"), F.col("l_linenumber").alias("TM#"))
    return CL.drop_columns(li, C.PRODUCT_DROP_COLUMNS)


@register("snake_case", 'SELECT o_orderkey AS receipt_no, o_custkey AS customer_id, o_totalprice AS total_gross, o_orderstatus AS take_out_2 FROM orders')
def snake_case(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("Receipt#"), F.col("o_custkey").alias("customerId"), F.col("o_totalprice").alias("Total Gross"), F.col("o_orderstatus").alias("Take-Out 2"))
    return CL.snake_case(CL.rename_receipt(o))


@register("rename_receipt", 'SELECT o_orderkey AS "Receipt No", o_orderstatus AS "Posted" FROM orders')
def rename_receipt(spark, sf_dir):
    return CL.rename_receipt(read_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("Receipt#"), F.col("o_orderstatus").alias("Posted")))


@register("fact_projection", q("", "SELECT date, receipt_no, product_id, product_name, qty, CAST(price AS DOUBLE) AS price, CAST(line_total AS DOUBLE) AS line_total, CAST(net_total AS DOUBLE) AS net_total FROM combined"))
def fact_projection(spark, sf_dir):
    out = CL.fact_projection(wh(spark, sf_dir).combined)
    return out.select([F.col(c).cast("double") if c in ("price", "line_total", "net_total") else F.col(c) for c in out.columns if c != "seq"])


@register("normalize_names", "SELECT p_partkey, upper(trim(p_name)) AS product_name FROM part")
def normalize_names(spark, sf_dir):
    padded = read_table(spark, sf_dir, "part").select("p_partkey", F.concat(F.lit(" \t"), F.lower("p_name"), F.lit("\n ")).alias("product_name"))
    return CL.normalize_names(padded)


@register("require_columns", """
SELECT 'orders' AS input, TRUE AS accepted, count(*) AS n_rows FROM orders UNION ALL SELECT 'lineitem', FALSE, count(*) FROM lineitem""")
def require_columns(spark, sf_dir):
    """The frame with the columns passes, the one without is refused when the plan is made."""
    out = None
    for name in ("orders", "lineitem"):
        df = read_table(spark, sf_dir, name)
        try:
            CL.require_columns(df, ["o_orderkey", "o_orderdate"], name)
            accepted = True
        except ValueError:
            accepted = False
        row = df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("input"), F.lit(accepted).alias("accepted"), "n_rows")
        out = row if out is None else out.unionByName(row)
    return out


@register("drop_missing", "SELECT l_returnflag, count(*) AS rows_kept FROM lineitem WHERE l_linenumber <> 3 AND l_quantity >= 10 GROUP BY l_returnflag")
def drop_missing(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_returnflag", F.when(F.col("l_linenumber") != 3, F.col("l_partkey")).alias("product_id"), F.when(F.col("l_quantity") >= 10, F.col("l_quantity")).alias("qty"))
    return CL.drop_missing(li, ["product_id", "qty", "not_there"]).groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("rows_kept"))


# --- sinks as round trips (K2-K7, W16, S6) -----------------------------------------------

_ORDER = "SELECT o_orderkey AS receipt_no, o_orderpriority AS category, o_totalprice AS total FROM orders"


def _orders(spark, sf_dir):
    return read_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("receipt_no"), F.col("o_orderpriority").alias("category"), F.col("o_totalprice").alias("total"))


def _changed(orders):
    return orders.withColumns({"category": F.upper("category"), "total": 2 * F.col("total")})


@register("append_table", _ORDER)
def append_table(spark, sf_dir):
    path, o = _folder(spark, "append"), _orders(spark, sf_dir)
    for part in (o.filter("receipt_no % 2 = 0"), o.filter("receipt_no % 2 <> 0")):
        U.append_table(part, path)
    return spark.read.parquet(path)


@register("replace_table", "SELECT receipt_no, upper(category) AS category, 2 * total AS total FROM (" + _ORDER + ")")
def replace_table(spark, sf_dir):
    """The second load has the same receipts with other values."""
    path, o = _folder(spark, "replace"), _orders(spark, sf_dir)
    U.replace_table(o, path)
    U.replace_table(_changed(o), path)
    return spark.read.parquet(path)


@register("export_by_category", _ORDER)
def export_by_category(spark, sf_dir):
    path = _folder(spark, "export")
    U.export_by_category(_orders(spark, sf_dir), path)
    return spark.read.csv(path, header=True, schema="receipt_no bigint, total double, category string").select("receipt_no", "category", "total")


@register("publish_run", "SELECT 'fact' AS table_name, count(*) AS n_rows, CAST(2 * sum(CAST(o_totalprice AS DECIMAL(14,2))) AS DOUBLE) AS total FROM orders UNION ALL SELECT 'dimension', count(*), NULL FROM part")
def publish_run(spark, sf_dir):
    """Two runs publish; readers see the tables of the newer one."""
    root = _folder(spark, "publish")
    o, p = _orders(spark, sf_dir), read_table(spark, sf_dir, "part")
    for fact in (o, _changed(o)):
        U.publish_run(spark, f"{root}/manifest", {"fact": U.write_version(fact, f"{root}/fact"), "dimension": U.write_version(p, f"{root}/dimension")})
    def count(t, total):
        rows = U.read_published(spark, f"{root}/manifest", t).agg(F.count(F.lit(1)).alias("n_rows"), F.sum(total).cast("double").alias("total"))
        return rows.select(F.lit(t).alias("table_name"), "n_rows", "total")
    return count("fact", F.col("total").cast("decimal(14,2)")).unionByName(count("dimension", F.lit(None).cast("double")))


@register("table_keys", q("", """
SELECT 'current_product_dimension' AS table_name, count(*) AS n_rows, count(*) = count(DISTINCT product_id) AS unique_keys FROM cur
UNION ALL SELECT 'transaction_records', count(DISTINCT receipt_no), TRUE FROM dlines"""))
def table_keys(spark, sf_dir):
    w = wh(spark, sf_dir)

    def row(name, df):
        keys = F.struct(*U.TABLE_KEYS[name])
        return df.agg(F.count(F.lit(1)).alias("n_rows"), (F.count(F.lit(1)) == F.count_distinct(keys)).alias("unique_keys")).select(F.lit(name).alias("table_name"), "n_rows", "unique_keys")
    return row("current_product_dimension", w.current).unionByName(row("transaction_records", w.transaction_records))


@register("history_exists", "SELECT 'before' AS at, FALSE AS found, 0 AS n_rows UNION ALL SELECT 'empty', FALSE, 0 UNION ALL SELECT 'after', TRUE, count(*) FROM part")
def history_exists(spark, sf_dir):
    from ..operators.dimensions import history_exists as found
    path, p = _folder(spark, "history"), read_table(spark, sf_dir, "part")
    seen = [("before", found(spark, path))]
    p.filter("p_partkey < 0").write.parquet(path)
    seen.append(("empty", found(spark, path)))
    p.write.mode("overwrite").parquet(path)
    seen.append(("after", found(spark, path)))
    n = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n"))
    return n.select(F.explode(F.array(*[F.struct(F.lit(a).alias("at"), F.lit(b).alias("found"), F.when(F.lit(b), F.col("n")).otherwise(F.lit(0)).alias("n_rows")) for a, b in seen])).alias("r")).select("r.*")


# --- SQL of the incremental dimension and its sinks (P3, P4, W6, K1, R2) -----------------

def scd_sql(what: str) -> str:
    from .catalog_ops import _CUT
    from .oracle_sql import cost_sql, parent_sku_sql
    cols = "product_id, product_name, price, product_cost, last_transaction_datetime, record_version, is_current, parent_sku, category"
    derived = f"{cost_sql('', 'price')} AS product_cost"
    row = lambda p: ", ".join(p.get(c, f"h.{c}") + f" AS {c}" for c in cols.split(", "))
    new = {"product_id": "l.product_id", "product_name": "l.product_name", "price": "l.price", "product_cost": cost_sql("", "l.price"), "last_transaction_datetime": "l.dt", "is_current": "TRUE",
           "parent_sku": parent_sku_sql("l.product_name"), "category": category_sql("l.product_name", "l.product_id")}
    advanced = "CASE WHEN l.dt IS NOT NULL AND (h.last_transaction_datetime IS NULL OR l.dt > h.last_transaction_datetime) THEN l.dt ELSE h.last_transaction_datetime END"
    ctes = f"""
st AS (SELECT product_id, product_name, price, arg_min(datetime, seq) AS dt, min(seq) AS fs FROM combined WHERE date < DATE '{_CUT}' GROUP BY product_id, product_name, price),
hist AS (
  SELECT product_id, product_name, price, {derived}, dt AS last_transaction_datetime, CAST(row_number() OVER (PARTITION BY product_id ORDER BY fs) AS INTEGER) AS record_version,
         fs = max(fs) OVER (PARTITION BY product_id) AS is_current, {parent_sku_sql('product_name')} AS parent_sku, {category_sql('product_name', 'product_id')} AS category FROM st
),
l AS (
  SELECT product_id, arg_max(product_name, {{'t': datetime, 's': seq}}) AS product_name, arg_max(price, {{'t': datetime, 's': seq}}) AS price, max(datetime) AS dt
  FROM combined WHERE date >= DATE '{_CUT}' GROUP BY product_id
),
h AS (SELECT *, max(record_version) OVER (PARTITION BY product_id) AS mx FROM hist QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY is_current DESC, record_version DESC) = 1),
j AS (SELECT l.product_id AS pid, h.product_id IS NULL AS a, h.product_id IS NOT NULL AND h.price = l.price AS b FROM l LEFT JOIN h ON h.product_id = l.product_id),
up AS (
  SELECT {row(new | {'record_version': 'CAST(1 AS INTEGER)'})} FROM l JOIN j ON j.pid = l.product_id AND j.a
  UNION ALL SELECT {row({'last_transaction_datetime': advanced, 'is_current': 'TRUE'})} FROM l JOIN j ON j.pid = l.product_id AND j.b JOIN h ON h.product_id = l.product_id
  UNION ALL SELECT {row({'is_current': 'FALSE'})} FROM j JOIN h ON h.product_id = j.pid WHERE NOT j.a AND NOT j.b
  UNION ALL SELECT {row(new | {'record_version': 'CAST(h.mx + 1 AS INTEGER)'})} FROM l JOIN j ON j.pid = l.product_id AND NOT j.a AND NOT j.b JOIN h ON h.product_id = l.product_id
)"""
    out = f"product_id, product_name, CAST(price AS DOUBLE) AS price, CAST(product_cost AS DOUBLE) AS product_cost, last_transaction_datetime, record_version, is_current, parent_sku, category"
    if what == "updates":
        return q(ctes, f"SELECT {out} FROM up")
    return q(ctes, f"SELECT {out} FROM (SELECT {cols} FROM hist WHERE (product_id, record_version) NOT IN (SELECT (product_id, record_version) FROM up) UNION ALL SELECT {cols} FROM up)")


catalog.ORACLES["scd_incremental"] = scd_sql("updates")
catalog.ORACLES["upsert_merge"] = scd_sql("merged")
catalog.ORACLES["stream_scd"] = scd_sql("merged")


# --- streaming and the end-to-end run (R1, R3, R4, K8) -----------------------------------

@register("stream_ingest", "SELECT event_type, count(*) AS n_rows, count(*) FILTER (event_id % 2 = 0) AS n_archived FROM events GROUP BY event_type")
def stream_ingest(spark, sf_dir):
    """Two uploads are drained by two triggers, a third trigger finds nothing.  The source archives an upload's files
    when the next batch begins, so the first upload lies in the archive then (``n_archived``)."""
    from ..streaming.ingest import stream_ingest as drain
    base = _folder(spark, "stream")
    e = read_table(spark, sf_dir, "events").select("event_id", "event_type")
    for k in (0, 1, None):
        if k is not None:
            e.filter(F.col("event_id") % 2 == k).write.parquet(f"{base}/landing/upload={k}")
        drain(spark, f"{base}/landing/*", e.schema, f"{base}/checkpoint", lambda df, i: df.write.mode("overwrite").parquet(f"{base}/out/batch={i}"), archive_dir=f"{base}/archive")
    archived = spark.read.option("recursiveFileLookup", "true").schema(e.schema).parquet(f"{base}/archive").select("event_type", F.lit(0).alias("read"), F.lit(1).alias("kept"))
    rows = spark.read.parquet(f"{base}/out").select("event_type", F.lit(1).alias("read"), F.lit(0).alias("kept")).unionByName(archived)
    return rows.groupBy("event_type").agg(F.sum("read").alias("n_rows"), F.sum("kept").alias("n_archived"))


@register("stream_replay", scd_sql("merged"))
def stream_replay(spark, sf_dir):
    """A batch that is applied again under its own id leaves the same history."""
    from ..streaming.ingest import DimensionState
    from .catalog_ops import _split
    old, new = _split(spark, sf_dir)
    state = DimensionState(spark, _folder(spark, "replay"))
    for i, part in ((0, old), (1, new), (1, new)):
        state.apply(part, i)
    return state.latest("history").withColumn("price", F.col("price").cast("double")).withColumn("product_cost", F.col("product_cost").cast("double"))


def run_steps(steps, on_step=None) -> list[tuple[str, float]]:
    """Run named steps in order, timed; the first failure stops the run and is raised."""
    import time
    done = []
    for name, step in steps:
        begun = time.time()
        step()
        done.append((name, time.time() - begun))
        if on_step:
            on_step(*done[-1])
    return done


@register("run_all", q(elasticity_ctes(Q_SUPPORT, Q_CONF, Q_LIFT, None), """
SELECT 1 AS step, 'etl' AS name, (SELECT count(*) FROM fact) AS n_rows UNION ALL SELECT 2, 'rules', (SELECT count(*) FROM br)
UNION ALL SELECT 3, 'elasticity', (SELECT count(*) FROM ped) UNION ALL SELECT 4, 'prices', (SELECT count(*) FROM ped WHERE n_price_points >= 2 AND r2_logspace IS NOT NULL AND elasticity_epsilon < 0)
UNION ALL SELECT 5, 'forecast', (SELECT count(*) FROM ped)"""))
def run_all(spark, sf_dir):
    """ETL, rules, elasticity, prices and forecasts in order; each step's result table and its rows."""
    w = wh(spark, sf_dir)
    tables = {}
    run_steps([
        ("etl", lambda: tables.update(etl=w.fact)), ("rules", lambda: tables.update(rules=catalog.rules_table(spark, sf_dir))),
        ("elasticity", lambda: tables.update(elasticity=catalog.ped_table(spark, sf_dir))),
        ("prices", lambda: tables.update(prices=w.result("prices", lambda: catalog.QUERIES["price_recommendation"](spark, sf_dir)))),
        ("forecast", lambda: tables.update(forecast=catalog._forecast(spark, sf_dir).select("bundle_id").distinct()))])
    out = None
    for i, (name, df) in enumerate(tables.items(), start=1):
        row = df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(i).alias("step"), F.lit(name).alias("name"), "n_rows")
        out = row if out is None else out.unionByName(row)
    return out


# --- elasticity lookup, costing (J13, J16, F8-F10) ---------------------------------------

@register("pick_elasticity", q(elasticity_ctes(Q_SUPPORT, Q_CONF, Q_LIFT, PRICE_BIN), "SELECT product_id_2 AS product_id_1, product_id_1 AS product_id_2, mode, elasticity_epsilon FROM ped"))
def pick_elasticity(spark, sf_dir):
    """Pairs in reversed order find their row; the non-strict one is preferred over the strict one."""
    ped = catalog.ped_table(spark, sf_dir, price_bin=PRICE_BIN)
    both = ped.withColumn("mode", F.lit("strict")).withColumn("elasticity_epsilon", F.lit(-9.0)).unionByName(ped)
    pairs = ped.select(F.col("product_id_2").alias("product_id_1"), F.col("product_id_1").alias("product_id_2"))
    return EL.pick_elasticity(pairs, both).select("product_id_1", "product_id_2", "mode", "elasticity_epsilon")


_SHEETS = """SELECT DISTINCT p_name || CASE WHEN p_partkey % 3 = 0 THEN ' ICED ' ELSE ' HOT ' END || CASE WHEN p_size % 2 = 0 THEN '12OZ' ELSE '16OZ' END AS sheet,
  CAST(round(p_retailprice / 10) AS INTEGER) * 100000 + p_partkey AS sheet_order, round(p_retailprice / 2, 2) AS total_cost FROM part"""
_DRINKS = "SELECT DISTINCT upper(p_name) || CASE WHEN p_partkey % 2 = 0 THEN ' HOT 12OZ' WHEN p_partkey % 3 = 0 THEN ' COLD 16OZ' ELSE '' END AS product_name FROM part"


def _norm_sql(c: str) -> str:
    return f"replace(replace(replace(upper(replace(coalesce({c}, ''), 'CAR ', 'CARAMEL ')), ' ', ''), 'OZ', ''), 'CHOCO', 'CHOCOLATE')"


_MATCH = f"""
sheets AS ({_SHEETS}), drinks AS ({_DRINKS}),
p AS (SELECT product_name, {_norm_sql('product_name')} AS pn FROM drinks), s AS (SELECT sheet, sheet_order, total_cost, {_norm_sql('sheet')} AS sn FROM sheets),
sc AS (
  SELECT product_name, sheet, sheet_order, total_cost, CASE WHEN length(pn) >= 4 AND contains(sn, pn) THEN 2 ELSE 0 END
         + CASE WHEN contains(pn, '8') AND contains(sn, '8') OR contains(pn, '12') AND contains(sn, '12') OR contains(pn, '16') AND contains(sn, '16') THEN 1 ELSE 0 END
         + CASE WHEN contains(pn, 'HOT') AND contains(sn, 'HOT') THEN 1 WHEN (contains(pn, 'ICED') OR contains(pn, 'COLD')) AND contains(sn, 'ICED') THEN 1 ELSE 0 END AS score
  FROM p, s
),
best AS (SELECT * FROM sc WHERE score >= 2 QUALIFY row_number() OVER (PARTITION BY product_name ORDER BY score DESC, sheet_order) = 1)"""


def _cost_match(spark, sf_dir):
    read_table(spark, sf_dir, "part").createOrReplaceTempView("tillwise_part")
    return costing.fuzzy_cost_match(spark.sql(_DRINKS.replace("FROM part", "FROM tillwise_part")), spark.sql(_SHEETS.replace("FROM part", "FROM tillwise_part")))


@register("fuzzy_cost_match", "WITH " + _MATCH.strip() + " SELECT product_name, sheet, total_cost, score FROM best")
def fuzzy_cost_match(spark, sf_dir):
    return _cost_match(spark, sf_dir)


_DRINK_PRICES = _DRINKS.replace(" AS product_name FROM part", " AS product_name, CAST(p_retailprice AS DECIMAL(10,2)) AS price FROM part")


@register("product_cost", "WITH " + _MATCH.strip() + f""",
d AS ({_DRINK_PRICES}), c AS (SELECT product_name, price, {category_sql('product_name', "''")} AS category FROM d)
SELECT c.product_name, c.category, CAST(c.price AS DOUBLE) AS price, CAST(CASE WHEN c.category = 'DRINK' AND b.total_cost IS NOT NULL AND b.total_cost <> 0 THEN CAST(round(b.total_cost, 2) AS DECIMAL(10,2))
       ELSE CAST(round(c.price * CAST(0.60 AS DECIMAL(3,2)), 2) AS DECIMAL(10,2)) END AS DOUBLE) AS product_cost FROM c LEFT JOIN best b ON b.product_name = c.product_name""")
def product_cost(spark, sf_dir):
    match = _cost_match(spark, sf_dir)
    d = spark.sql(_DRINK_PRICES.replace("FROM part", "FROM tillwise_part")).withColumn("category", P.product_category(F.col("product_name"), F.lit("")))
    return d.join(match, "product_name", "left").select("product_name", "category", F.col("price").cast("double").alias("price"),
                                                         P.product_cost(F.col("category"), F.col("price"), F.col("total_cost")).cast("double").alias("product_cost"))


# --- regression (E4-E7) ---------------------------------------------------------------

_POLY = elasticity_ctes(Q_SUPPORT, Q_CONF, Q_LIFT, PRICE_BIN) + f""",
pp AS (SELECT bundle_id, CAST(combined_price AS DOUBLE) AS p, CAST(num_transactions AS DOUBLE) AS y FROM pts),
rg AS (SELECT bundle_id, min(p) AS p_min, max(p) AS p_max, count(*) AS n, avg(y) AS y_mean FROM pp GROUP BY bundle_id HAVING count(*) > 1),
uu AS (SELECT pp.bundle_id, p, y, p_min, p_max, n, y_mean, (p - (p_max + p_min) / 2) / ((p_max - p_min) / 2) AS u FROM pp JOIN rg ON pp.bundle_id = rg.bundle_id),
sm AS (SELECT bundle_id, any_value(n) AS n, {', '.join(f'sum(pow(u, {k})) AS s{k}' for k in range(7))}, {', '.join(f'sum(y * pow(u, {k})) AS t{k}' for k in range(4))} FROM uu GROUP BY bundle_id),
cf AS (SELECT bundle_id, {', '.join(f'CASE WHEN n > {d} THEN {regression.coefficient_sql(d, j)} END AS c{d}_{j}' for d in regression.DEGREES for j in range(d + 1))} FROM sm),
sq AS (SELECT uu.bundle_id, sum((y - y_mean) ** 2) AS sst, {', '.join(f'sum((y - ({regression.value_sql(d, "u")})) ** 2) AS sse{d}' for d in regression.DEGREES)} FROM uu JOIN cf ON uu.bundle_id = cf.bundle_id GROUP BY uu.bundle_id),
rr AS (SELECT bundle_id, {', '.join(f'round(1 - sse{d} / nullif(sst, 0), 9) AS r2_{d}' for d in regression.DEGREES)} FROM sq),
ft AS (SELECT cf.*, rg.p_min, rg.p_max, greatest(r2_1, r2_2, r2_3) AS r2, coalesce(CASE WHEN r2_1 = greatest(r2_1, r2_2, r2_3) THEN 1 WHEN r2_2 = greatest(r2_1, r2_2, r2_3) THEN 2
       WHEN r2_3 = greatest(r2_1, r2_2, r2_3) THEN 3 END, 1) AS degree FROM cf JOIN rr ON rr.bundle_id = cf.bundle_id JOIN rg ON rg.bundle_id = cf.bundle_id)"""


def _value(x: str) -> str:
    u = f"(({x} - (p_max + p_min) / 2) / ((p_max - p_min) / 2))"
    return "CASE degree " + " ".join(f"WHEN {d} THEN {regression.value_sql(d, u)}" for d in regression.DEGREES) + " END"


def _points(spark, sf_dir):
    w = wh(spark, sf_dir)
    return w.result("points_binned", lambda: EL.price_quantity_points(w.fact, catalog._resolved(spark, sf_dir), False, PRICE_BIN))


@register("polynomial_demand", q(_POLY + """,
gr AS (SELECT *, greatest(0.0, p_min - (p_max - p_min) * 0.2) AS lo, p_max + (p_max - p_min) * 0.2 AS hi, CAST(i AS INTEGER) AS grid_index FROM ft, range(200) t(i))""", f"""
SELECT bundle_id, degree, round(r2, 6) AS r2, grid_index, round(price, 6) AS price, round({_value('price')}, 4) AS demand FROM (SELECT *, lo + grid_index * ((hi - lo) / 199) AS price FROM gr)"""))
def polynomial_demand(spark, sf_dir):
    return regression.polynomial_demand(_points(spark, sf_dir))


@register("regression_metrics", q(_POLY + f""",
er AS (SELECT uu.bundle_id, degree, r2, uu.y, abs(uu.y - ({_value('uu.p').replace('(p_max', '(ft.p_max').replace('+ p_min', '+ ft.p_min').replace('- p_min', '- ft.p_min')})) AS e,
              abs(uu.y - lag(uu.y) OVER (PARTITION BY uu.bundle_id ORDER BY uu.p)) AS step FROM uu JOIN ft ON ft.bundle_id = uu.bundle_id)""", """
SELECT bundle_id, degree, round(r2, 6) AS r2, round(avg(e ** 2), 6) AS mse, round(sqrt(avg(e ** 2)), 6) AS rmse, round(avg(e), 6) AS mae, round(sum(e) / nullif(sum(abs(y)), 0) * 100, 6) AS wmape,
       round(avg(e) / nullif(avg(step), 0), 6) AS mase FROM er GROUP BY bundle_id, degree, r2"""))
def regression_metrics(spark, sf_dir):
    return regression.regression_metrics(_points(spark, sf_dir))


@register("price_what_if", q(_POLY + """,
pw AS (SELECT rb.bundle_id, CAST(a.price AS DOUBLE) + CAST(b.price AS DOUBLE) AS current_price, f.f FROM rb JOIN cur a ON a.product_id = rb.product_id_1 JOIN cur b ON b.product_id = rb.product_id_2, (VALUES (0.8), (1.0), (25.0)) f(f)),
wi AS (SELECT ft.*, current_price, current_price * CAST(f AS DOUBLE) AS new_price FROM pw JOIN ft ON ft.bundle_id = pw.bundle_id),
wv AS (SELECT *, """ + _value("current_price") + " AS base, " + _value("new_price") + " AS new FROM wi)", """
SELECT bundle_id, round(current_price, 2) AS current_price, round(new_price, 2) AS new_price, round(base, 4) AS baseline_demand, round(greatest(0.0, new), 4) AS predicted_demand,
       round(CASE WHEN base > 0 THEN (new - base) / base * 100 END, 4) AS change_pct FROM wv"""))
def price_what_if(spark, sf_dir):
    w = wh(spark, sf_dir)
    price = w.current.select("product_id", F.col("price").cast("double").alias("p"))
    b = catalog._resolved(spark, sf_dir).select("bundle_id", "product_id_1", "product_id_2")
    b = b.join(price.select(F.col("product_id").alias("product_id_1"), F.col("p").alias("pa")), "product_id_1").join(price.select(F.col("product_id").alias("product_id_2"), F.col("p").alias("pb")), "product_id_2")
    prices = b.select("bundle_id", (F.col("pa") + F.col("pb")).alias("current_price")).select(
        "bundle_id", "current_price", F.explode(F.array(*[F.col("current_price") * f for f in (0.8, 1.0, 25.0)])).alias("new_price"))
    return regression.price_what_if(_points(spark, sf_dir), prices)


# --- mining parameters (D7) --------------------------------------------------------------

def pair_rules_param(spark, sf_dir, source: str = "full", group_by: str = "product_id", exclude_flagged: bool = True, exclude_categories=C.EXCLUDED_CATEGORIES,
                     category_runs: bool = False, min_support: float = Q_SUPPORT, min_confidence: float = Q_CONF, min_lift: float = Q_LIFT, baskets: str = "baskets"):
    """Rules with the basket source (`transactions`, `fact`, `full`, `flags`), item granularity, flagged rows
    and thresholds as parameters; `transactions` falls back to `fact` where no table ``baskets`` is stored."""
    from ..operators import quality as QL
    w = wh(spark, sf_dir)
    if source == "transactions" and w._has(baskets):
        lines = w.baskets
    else:
        lines = w.fact if source in ("transactions", "fact") else w.distinct_lines
        if exclude_flagged and source in ("full", "flags"):
            lines = QL.outlier_flags(lines, QL.METRICS).filter("n_flags = 0")
        sku = lines.join(w.current.select("product_id", "parent_sku"), "product_id", "left")
        lines = sku.select("receipt_no", (F.coalesce("parent_sku", "product_id") if group_by == "parent_sku" else F.col("product_id")).alias("sku"))
    runs = ("FOOD", "DRINK", "MEAL") if category_runs else ("ALL",)
    ri = B.run_rows(lines, w.current, runs=runs)
    rules = B.pair_rules(ri, min_support, min_confidence, min_lift)
    rules = rules.filter(~F.col("cat_a").isin(*exclude_categories) & ~F.col("cat_c").isin(*exclude_categories))
    rules = B.translate(B.translate(rules, w.current, "ant", "antecedents_names"), w.current, "con", "consequents_names")
    return rules.select("run", "antecedents_names", "consequents_names", "support", "confidence", "lift")


def _param_sql(bl: str | None) -> str:
    """The rules over the basket lines ``bl`` (receipt_no, sku); None: the stored baskets."""
    from .oracle_sql import rules_ctes
    ctes = rules_ctes(Q_SUPPORT, Q_CONF, Q_LIFT, runs=("ALL",)).strip()
    if bl:
        ctes = ctes[:ctes.index("bl AS (")] + bl + ctes[ctes.index("skumap AS"):]
    return q(ctes, "SELECT run, antecedents_names, consequents_names, support, confidence, lift FROM rules WHERE cat_a NOT IN ('EXTRA', 'OTHERS') AND cat_c NOT IN ('EXTRA', 'OTHERS')")


def _unflagged_sql() -> str:
    flags = " AND ".join(f"coalesce(CAST({m} AS DOUBLE) BETWEEN lo_{m} AND hi_{m}, TRUE)" for m in ("qty", "price", "line_total", "net_total"))
    bounds = ", ".join(f"round(quantile_cont(CAST({m} AS DOUBLE), 0.25) - 1.5 * (quantile_cont(CAST({m} AS DOUBLE), 0.75) - quantile_cont(CAST({m} AS DOUBLE), 0.25)), 6) AS lo_{m}, "
                       f"round(quantile_cont(CAST({m} AS DOUBLE), 0.75) + 1.5 * (quantile_cont(CAST({m} AS DOUBLE), 0.75) - quantile_cont(CAST({m} AS DOUBLE), 0.25)), 6) AS hi_{m}"
                       for m in ("qty", "price", "line_total", "net_total"))
    return f"bd AS (SELECT {bounds} FROM dlines),\nbl AS (SELECT receipt_no, product_id AS sku FROM dlines, bd WHERE {flags}),\n"


_FACT_BL = "bl AS (SELECT receipt_no, product_id AS sku FROM fact),\n"
_SKU_BL = "bl AS (SELECT d.receipt_no, coalesce(c.parent_sku, d.product_id) AS sku FROM dlines d LEFT JOIN cur c ON c.product_id = d.product_id),\n"

register("pair_rules_param", _param_sql(_unflagged_sql()))(lambda spark, sf_dir: pair_rules_param(spark, sf_dir))
register("pair_rules_transactions", _param_sql(None))(lambda spark, sf_dir: pair_rules_param(spark, sf_dir, "transactions"))
register("pair_rules_fallback", _param_sql(_FACT_BL))(lambda spark, sf_dir: pair_rules_param(spark, sf_dir, "transactions", baskets="no_such_table"))
register("pair_rules_fact", _param_sql(_FACT_BL))(lambda spark, sf_dir: pair_rules_param(spark, sf_dir, "fact"))
register("pair_rules_parent_sku", _param_sql(_SKU_BL))(lambda spark, sf_dir: pair_rules_param(spark, sf_dir, "flags", "parent_sku", exclude_flagged=False))
