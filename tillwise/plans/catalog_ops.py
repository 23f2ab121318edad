"""Catalogue entries for the scalar rules, cleaning steps, dimensions, dedups,
joins on derived reports and data-quality flags.  Inputs are the given
tables (or reports Spark derives from them)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import config as C
from ..functions import products as P
from ..functions import text as T
from ..operators import cleaning as CL
from ..operators import descriptive as D
from ..operators import facts as FA
from ..operators import quality as QL
from ..operators.series import next_period_end, quarter_end
from ..sources.tables import read_table
from ..sources.time_dim import time_dimension
from .catalog import register, wh
from .oracle_sql import category_sql, parent_sku_sql, q


def _time_id_sql(x: str) -> str:
    s = f"trim({x})"
    h = f"split_part({s}, ':', 1)"
    m = f"substr({s}, strpos({s}, ':') + 1)"
    pat = r"'\s*[+-]?[0-9]+\s*'"
    return (f"CASE WHEN {x} IS NULL THEN NULL WHEN strpos({s}, ':') > 0 THEN "
            f"(CASE WHEN regexp_full_match({h}, {pat}) AND regexp_full_match({m}, {pat}) THEN "
            f"printf('H%02dM%02d', CAST(trim({h}) AS BIGINT), CAST(trim({m}) AS BIGINT)) END) "
            f"WHEN regexp_full_match({s}, '[0-9]{{4}}') THEN "
            f"printf('H%02dM%02d', CAST(substr({s}, 1, 2) AS BIGINT), CAST(substr({s}, 3, 2) AS BIGINT)) END")


# --- scalar rules (F1, F2, F3, F4, F7, F12, C16, C17) ------------------------------

def _name_variants(spark, sf_dir):
    """Product names as sold: plain, and with the part's size as an ounce suffix
    (exercises the size rules of F1)."""
    p = read_table(spark, sf_dir, "part")
    name = F.upper(F.trim("p_name"))
    sized = F.when(F.col("p_size").isin(8, 12, 16), F.concat(name, F.lit(" "), F.col("p_size").cast("string"), F.lit(" OZ.")))
    return p.select(F.explode(F.array(name, sized)).alias("product_name"), F.col("p_partkey").cast("string").alias("product_id")) \
        .filter(F.col("product_name").isNotNull())


_NAMES_SQL = """
nv AS (
  SELECT DISTINCT product_name, product_id FROM (
    SELECT upper(trim(p_name)) AS product_name, CAST(p_partkey AS VARCHAR) AS product_id FROM part
    UNION ALL
    SELECT upper(trim(p_name)) || ' ' || CAST(p_size AS VARCHAR) || ' OZ.', CAST(p_partkey AS VARCHAR)
    FROM part WHERE p_size IN (8, 12, 16))
)"""


@register("parent_sku", q(_NAMES_SQL, f"SELECT DISTINCT product_name, {parent_sku_sql('product_name')} AS parent_sku FROM nv"))
def parent_sku(spark, sf_dir):
    return _name_variants(spark, sf_dir).select("product_name", P.parent_sku(F.col("product_name")).alias("parent_sku")).distinct()


@register("product_category", q(_NAMES_SQL, f"SELECT product_name, product_id, {category_sql('product_name', 'product_id')} AS category FROM nv"))
def product_category(spark, sf_dir):
    return _name_variants(spark, sf_dir).distinct().select(
        "product_name", "product_id", P.product_category(F.col("product_name"), F.col("product_id")).alias("category"))


@register("time_id", q("", f"""
SELECT event_id, {_time_id_sql("strftime(ts, '%-H:%M')")} AS time_id_hm, {_time_id_sql("strftime(ts, '%H%M')")} AS time_id_hhmm,
       {_time_id_sql("strftime(ts, '%H:%M:%S')")} AS time_id_hms FROM events"""))
def time_id(spark, sf_dir):
    e = read_table(spark, sf_dir, "events")
    return e.select("event_id", T.time_id(F.date_format("ts", "H:mm")).alias("time_id_hm"),
                    T.time_id(F.date_format("ts", "HHmm")).alias("time_id_hhmm"),
                    T.time_id(F.date_format("ts", "HH:mm:ss")).alias("time_id_hms"))


@register("time_dimension", q("""
ev AS (SELECT strftime(ts, '%H') AS h, strftime(ts, '%M') AS m FROM events),
td AS (
  SELECT printf('H%02d', h) AS time_id, printf('%02d', h) AS time_desc, 1 AS time_level, 'NA' AS parent_id FROM range(24) t(h)
  UNION ALL
  SELECT printf('H%02dM%02d', h, m), printf('%02d:%02d', h, m), 0, printf('H%02d', h) FROM range(24) a(h), range(60) b(m)
),
cnt AS (
  SELECT 'H' || h AS time_id, count(*) AS n FROM ev GROUP BY 1
  UNION ALL SELECT 'H' || h || 'M' || m, count(*) FROM ev GROUP BY 1
)""", """
SELECT td.time_id, td.time_desc, CAST(td.time_level AS INTEGER) AS time_level, td.parent_id, coalesce(cnt.n, 0) AS events
FROM td LEFT JOIN cnt ON td.time_id = cnt.time_id"""))
def time_dimension_q(spark, sf_dir):
    e = read_table(spark, sf_dir, "events")
    ids = e.select(F.explode(F.array(F.date_format("ts", "'H'HH"), F.date_format("ts", "'H'HH'M'mm"))).alias("time_id"))
    cnt = ids.groupBy("time_id").agg(F.count(F.lit(1)).alias("events"))
    td = time_dimension(spark)
    return td.join(F.broadcast(cnt), "time_id", "left").select(
        "time_id", "time_desc", "time_level", "parent_id", F.coalesce("events", F.lit(0)).alias("events"))


@register("quarter_end", q("", """
SELECT DISTINCT date, last_day(CAST(date_trunc('quarter', date) AS DATE) + INTERVAL 2 MONTH) AS quarter_end,
       last_day(CAST(last_day(CAST(date_trunc('quarter', date) AS DATE) + INTERVAL 2 MONTH) + INTERVAL 3 MONTH AS DATE)) AS next_quarter_end,
       CAST(date_trunc('month', date) AS DATE) AS month_start, CAST(year(date) AS INTEGER) AS year
FROM fact"""))
def quarter_end_q(spark, sf_dir):
    f = wh(spark, sf_dir).fact.select("date").distinct()
    return f.select("date", quarter_end(F.col("date")).alias("quarter_end"),
                    next_period_end(quarter_end(F.col("date")), 1).alias("next_quarter_end"),
                    D.period_start(F.col("date"), "month").alias("month_start"), F.year("date").alias("year"))


@register("iso_dates", q("", """
SELECT DISTINCT strftime(date, '%Y-%m-%d') AS date_text, strftime(datetime, '%Y-%m-%d %H:%M:%S') AS datetime_text FROM combined"""))
def iso_dates(spark, sf_dir):
    l = wh(spark, sf_dir).lines_distinct
    return l.select(T.iso_date(F.col("date")).alias("date_text"), T.iso_timestamp(F.col("datetime")).alias("datetime_text")).distinct()


@register("safe_float", q("", """
SELECT o_orderkey, coalesce(TRY_CAST(o_orderpriority AS DOUBLE), -1.0) AS priority_value,
       coalesce(TRY_CAST(CAST(o_totalprice AS VARCHAR) AS DOUBLE), -1.0) AS total_value FROM orders"""))
def safe_float_q(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    return o.select("o_orderkey", T.safe_float(F.col("o_orderpriority"), -1.0).alias("priority_value"),
                    T.safe_float(F.col("o_totalprice").cast("string"), -1.0).alias("total_value"))


def _bundle_label_sql():
    from .catalog import _E
    return q(_E, """
SELECT bundle_id, antecedents_names || ' + ' || consequents_names AS bundle_label,
       antecedents_names AS side_a, consequents_names AS side_b FROM br""")


@register("bundle_label", _bundle_label_sql())
def bundle_label_q(spark, sf_dir):
    from .catalog import rules_table
    r = rules_table(spark, sf_dir)
    lab = T.bundle_label(F.col("antecedents_names"), F.col("consequents_names"))
    return r.select("bundle_id", lab.alias("bundle_label"), T.bundle_part(lab, 0).alias("side_a"),
                    T.bundle_part(lab, 1).alias("side_b"))


@register("text_cap_slug", q("", """
SELECT DISTINCT upper(trim(p_name)) || ' / ' || p_type || ' #' || p_brand AS label,
  CASE WHEN length(upper(trim(p_name)) || ' / ' || p_type || ' #' || p_brand) <= 20
       THEN upper(trim(p_name)) || ' / ' || p_type || ' #' || p_brand
       ELSE substr(upper(trim(p_name)) || ' / ' || p_type || ' #' || p_brand, 1, 19) || '…' END AS capped,
  substr(regexp_replace(regexp_replace(regexp_replace(upper(trim(p_name)) || ' / ' || p_type || ' #' || p_brand,
         '[^\\p{L}\\p{N}_-]', '-', 'g'), '-+', '-', 'g'), '^-|-$', '', 'g'), 1, 80) AS slug
FROM part"""))
def text_cap_slug(spark, sf_dir):
    p = read_table(spark, sf_dir, "part")
    lab = F.concat(F.upper(F.trim("p_name")), F.lit(" / "), F.col("p_type"), F.lit(" #"), F.col("p_brand"))
    return p.select(lab.alias("label")).distinct().select(
        "label", T.cap(F.col("label"), 20).alias("capped"), T.slugify(F.col("label")).alias("slug"))


# --- cleaning on reports derived from the tables (C1, C6-C10, C12, C14) ------------

@register("union_align", q("", """
SELECT * FROM (
  SELECT o_orderkey, o_orderdate, o_totalprice FROM orders WHERE year(o_orderdate) < 1998
  UNION ALL BY NAME
  SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders WHERE year(o_orderdate) >= 1998)"""))
def union_align(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    a = o.filter(F.year("o_orderdate") < 1998).select("o_orderkey", "o_orderdate", "o_totalprice")
    b = o.filter(F.year("o_orderdate") >= 1998).select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return CL.union_align([a, b])


@register("coerce_dates", q("", """
SELECT o_orderkey, TRY_CAST(strftime(o_orderdate, '%Y-%m-%d') AS DATE) AS iso_date,
       CAST(TRY_STRPTIME(strftime(o_orderdate, '%-m/%-d/%Y'), '%m/%d/%Y') AS DATE) AS us_date,
       CAST(NULL AS DATE) AS bad_date FROM orders"""))
def coerce_dates(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    return o.select("o_orderkey", CL.coerce_date(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("iso_date"),
                    CL.coerce_date(F.date_format("o_orderdate", "M/d/yyyy")).alias("us_date"),
                    CL.coerce_date(F.col("o_orderpriority")).alias("bad_date"))


@register("combine_datetime", q("", """
SELECT event_id, strptime(strftime(ts, '%Y-%m-%d') || ' ' || strftime(ts, '%-H:%M'), '%Y-%m-%d %H:%M') AS datetime FROM events"""))
def combine_datetime(spark, sf_dir):
    e = read_table(spark, sf_dir, "events").select(
        "event_id", F.date_format("ts", "yyyy-MM-dd").alias("date"), F.date_format("ts", "H:mm").alias("time"))
    return CL.combine_datetime(e).select("event_id", "datetime")


_BLANK = "CASE WHEN event_type = 'error' THEN '' WHEN event_type = 'signup' THEN NULL ELSE strftime(ts, '%H:%M') END"


@register("drop_blank_datetime", q("", f"""
SELECT event_type, count(*) AS rows_kept FROM events WHERE ({_BLANK}) IS NOT NULL AND trim({_BLANK}) <> '' GROUP BY event_type"""))
def drop_blank_datetime(spark, sf_dir):
    e = read_table(spark, sf_dir, "events")
    t = F.when(F.col("event_type") == "error", F.lit("")).when(F.col("event_type") == "signup", F.lit(None)) \
        .otherwise(F.date_format("ts", "HH:mm"))
    r = e.select("event_type", F.date_format("ts", "yyyy-MM-dd").alias("date"), t.alias("time"))
    return CL.drop_blank_datetime(r).groupBy("event_type").agg(F.count(F.lit(1)).alias("rows_kept"))


@register("numeric_sanity_filter", q("""
rep AS (
  SELECT l_returnflag, CAST(l_extendedprice / l_quantity - 1500 AS VARCHAR) AS price,
         CAST(l_quantity - 3 AS VARCHAR) AS qty,
         CASE WHEN l_linenumber = 7 THEN 'x' ELSE CAST(l_extendedprice AS VARCHAR) END AS line_total,
         CAST(l_extendedprice * (1 - l_discount) AS VARCHAR) AS net_total
  FROM lineitem
)""", """
SELECT l_returnflag, count(*) AS rows_kept FROM rep
WHERE TRY_CAST(price AS DOUBLE) BETWEEN 0 AND 50000 AND TRY_CAST(qty AS DOUBLE) >= 0
  AND TRY_CAST(line_total AS DOUBLE) >= 0 AND TRY_CAST(net_total AS DOUBLE) >= 0 GROUP BY l_returnflag"""))
def numeric_sanity_filter(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    r = li.select(
        "l_returnflag", (F.col("l_extendedprice") / F.col("l_quantity") - 1500).cast("string").alias("price"),
        (F.col("l_quantity") - 3).cast("string").alias("qty"),
        F.when(F.col("l_linenumber") == 7, F.lit("x")).otherwise(F.col("l_extendedprice").cast("string")).alias("line_total"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast("string").alias("net_total"),
        F.lit("12:00").alias("time"))
    return CL.numeric_sanity_filter(r).groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("rows_kept"))


_TAKEOUT_RAW = ("CASE WHEN o_orderpriority = '5-LOW' THEN NULL WHEN o_orderstatus = 'F' THEN ' y ' "
                "WHEN o_orderstatus = 'O' THEN '' ELSE o_orderstatus END")


@register("takeout_flag", q("", f"""
SELECT flag, count(*) AS n FROM (
  SELECT CASE WHEN upper(trim({_TAKEOUT_RAW})) = 'Y' THEN 'True'
              WHEN ({_TAKEOUT_RAW}) IS NULL OR trim({_TAKEOUT_RAW}) = '' THEN 'False' ELSE {_TAKEOUT_RAW} END AS flag
  FROM orders) GROUP BY flag"""))
def takeout_flag(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    raw = (F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None)).when(F.col("o_orderstatus") == "F", F.lit(" y "))
           .when(F.col("o_orderstatus") == "O", F.lit("")).otherwise(F.col("o_orderstatus")))
    return o.select(T.takeout_flag(raw).alias("flag")).groupBy("flag").agg(F.count(F.lit(1)).alias("n"))


def _rules_values_sql() -> str:
    rows = []
    seen = set()
    for no, (ids, names, to_id, to_name) in enumerate(C.STANDARDIZATION_RULES, start=1):
        for kind, keys in (("id", ids), ("name", [n.strip().upper() for n in names])):
            for k in keys:
                if (kind, k) in seen:
                    continue
                seen.add((kind, k))
                esc = lambda v: v.replace("'", "''")
                rows.append(f"('{kind}', '{esc(k)}', {no}, '{esc(to_id)}', '{esc(to_name)}')")
    return "rules(kind, key, rule_no, to_id, to_name) AS (VALUES " + ", ".join(rows) + ")"


_KNOWN = sorted({(i, n) for ids, names, _, _ in C.STANDARDIZATION_RULES for i in ids for n in names})


def _known_sql() -> str:
    """Parts renamed: by number, every third takes a rule's id, every third (with one over) a rule's name."""
    esc = lambda v: v.replace("'", "''")
    ids, names = "[" + ", ".join(f"'{esc(i)}'" for i, _ in _KNOWN) + "]", "[" + ", ".join(f"'{esc(n)}'" for _, n in _KNOWN) + "]"
    at = f"CAST(p_partkey % {len(_KNOWN)} + 1 AS INTEGER)"
    return f"""
nv AS (SELECT CASE WHEN p_partkey % 3 = 0 THEN ({ids})[{at}] ELSE CAST(p_partkey AS VARCHAR) END AS product_id,
              CASE WHEN p_partkey % 3 = 1 THEN lower(({names})[{at}]) || ' ' ELSE upper(trim(p_name)) END AS product_name FROM part)"""


def _known_variants(spark, sf_dir):
    p = read_table(spark, sf_dir, "part")
    at = (F.col("p_partkey") % len(_KNOWN)).cast("int")
    return p.select(
        F.when(F.col("p_partkey") % 3 == 0, F.get(F.array(*[F.lit(i) for i, _ in _KNOWN]), at)).otherwise(F.col("p_partkey").cast("string")).alias("product_id"),
        F.when(F.col("p_partkey") % 3 == 1, F.concat(F.lower(F.get(F.array(*[F.lit(n) for _, n in _KNOWN]), at)), F.lit(" "))).otherwise(F.upper(F.trim("p_name"))).alias("product_name"))


@register("standardize_products", q(_known_sql() + ",\n" + _rules_values_sql() + """,
m AS (
  SELECT nv.product_id, nv.product_name, ri.rule_no AS rid, ri.to_id AS tid, ri.to_name AS tnm,
         rn.rule_no AS rnm, rn.to_id AS nid, rn.to_name AS nnm
  FROM nv LEFT JOIN rules ri ON ri.kind = 'id' AND ri.key = nv.product_id
          LEFT JOIN rules rn ON rn.kind = 'name' AND rn.key = upper(trim(nv.product_name))
)""", """
SELECT CASE WHEN rid IS NOT NULL AND (rnm IS NULL OR rid <= rnm) THEN tid WHEN rnm IS NOT NULL THEN nid ELSE product_id END AS product_id,
       CASE WHEN rid IS NOT NULL AND (rnm IS NULL OR rid <= rnm) THEN tnm WHEN rnm IS NOT NULL THEN nnm ELSE product_name END AS product_name
FROM m"""))
def standardize_products(spark, sf_dir):
    return CL.standardize_products(_known_variants(spark, sf_dir)).select("product_id", "product_name")


@register("canonical_product_id", q("", "SELECT nk AS name_key, canon_id FROM canon"))
def canonical_product_id(spark, sf_dir):
    from ..sources.pos import line_report
    l = line_report(spark, sf_dir)
    return CL.canonical_product_ids(l).select(F.col("__name_key").alias("name_key"), F.col("__canon_id").alias("canon_id"))


@register("exclude_latest_month", q("", """
SELECT CAST(date_trunc('month', date) AS DATE) AS month, count(*) AS n_lines,
       (SELECT CAST(max(date_trunc('month', date)) AS DATE) FROM fact) AS last_month FROM fact GROUP BY 1"""))
def exclude_latest_month(spark, sf_dir):
    f = wh(spark, sf_dir).fact
    m = f.groupBy(F.trunc("date", "MM").alias("month")).agg(F.count(F.lit(1)).alias("n_lines"))
    return m.withColumn("last_month", m.select(F.max("month")).scalar())


# --- dimensions, dedups and joins (P1, P2, W1-W3, A14, J1, J2, J10, A11) ----------

@register("product_dim_current", q("", """
SELECT product_id, product_name, CAST(price AS DOUBLE) AS price, CAST(product_cost AS DOUBLE) AS product_cost,
       last_transaction_datetime, 1 AS record_version, TRUE AS is_current, parent_sku, category FROM cur"""))
def product_dim_current(spark, sf_dir):
    c = wh(spark, sf_dir).current
    return c.select("product_id", "product_name", F.col("price").cast("double").alias("price"),
                    F.col("product_cost").cast("double").alias("product_cost"), "last_transaction_datetime",
                    "record_version", "is_current", "parent_sku", "category")


@register("product_dim_history", q(f"""
st AS (SELECT product_id, product_name, price, arg_min(datetime, seq) AS dt, min(seq) AS fs
       FROM combined GROUP BY product_id, product_name, price),
h AS (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY fs) AS rv,
             count(*) OVER (PARTITION BY product_id) AS mx FROM st)""", f"""
SELECT product_id, product_name, CAST(price AS DOUBLE) AS price,
       CAST(round(CAST(price AS DECIMAL(10,2)) * CAST(0.60 AS DECIMAL(3,2)), 2) AS DOUBLE) AS product_cost,
       dt AS last_transaction_datetime, CAST(rv AS INTEGER) AS record_version, rv = mx AS is_current,
       {parent_sku_sql('product_name')} AS parent_sku, {category_sql('product_name', 'product_id')} AS category FROM h"""))
def product_dim_history(spark, sf_dir):
    h = wh(spark, sf_dir).history
    return h.select("product_id", "product_name", F.col("price").cast("double").alias("price"),
                    F.col("product_cost").cast("double").alias("product_cost"), "last_transaction_datetime",
                    "record_version", "is_current", "parent_sku", "category")


_LINE_COLS = ("date", "receipt_no", "product_id", "product_name", "qty")


def _line_select(df):
    return df.select(*_LINE_COLS, F.col("price").cast("double").alias("price"),
                     F.col("line_total").cast("double").alias("line_total"),
                     F.col("net_total").cast("double").alias("net_total"))


_LINE_SQL = ("date, receipt_no, product_id, product_name, qty, CAST(price AS DOUBLE) AS price, "
             "CAST(line_total AS DOUBLE) AS line_total, CAST(net_total AS DOUBLE) AS net_total")


@register("distinct_rows", q("", f"SELECT {_LINE_SQL} FROM dlines"))
def distinct_rows(spark, sf_dir):
    return _line_select(wh(spark, sf_dir).distinct_lines)


@register("join_header_lines", q("", f"SELECT {_LINE_SQL}, datetime FROM combined"))
def join_header_lines(spark, sf_dir):
    c = wh(spark, sf_dir).combined
    return c.select(*_LINE_COLS, F.col("price").cast("double").alias("price"),
                    F.col("line_total").cast("double").alias("line_total"),
                    F.col("net_total").cast("double").alias("net_total"), "datetime")


@register("dedup_keep_last", q("", f"""
SELECT receipt_no, date, product_id, arg_max(qty, seq) AS qty, CAST(arg_max(line_total, seq) AS DOUBLE) AS line_total
FROM fact GROUP BY receipt_no, date, product_id"""))
def dedup_keep_last(spark, sf_dir):
    f = wh(spark, sf_dir).fact
    d = FA.dedup_keep_last(f, ["receipt_no", "date", "product_id"])
    return d.select("receipt_no", "date", "product_id", "qty", F.col("line_total").cast("double").alias("line_total"))


@register("dedup_keep_first", q("", """
SELECT CAST(ts AS DATE) AS date, user_id AS receipt_no, strftime(ts, '%H:%M') AS time, arg_min(event_id, event_id) AS event_id,
       arg_min(event_type, event_id) AS event_type
FROM events GROUP BY 1, 2, 3"""))
def dedup_keep_first(spark, sf_dir):
    e = read_table(spark, sf_dir, "events").select(
        F.col("ts").cast("date").alias("date"), F.col("user_id").alias("receipt_no"),
        F.date_format("ts", "HH:mm").alias("time"), "event_id", "event_type", F.col("event_id").alias("seq"))
    return FA.dedup_keep_first(e, ["date", "receipt_no", "time"]).drop("seq")


@register("dedup_report", q("", """
SELECT (SELECT count(*) FROM combined) AS rows_before, (SELECT count(*) FROM dlines) AS rows_after,
       (SELECT count(*) FROM combined) - (SELECT count(*) FROM dlines) AS rows_removed"""))
def dedup_report(spark, sf_dir):
    w = wh(spark, sf_dir)
    return FA.dedup_report(w.combined, w.distinct_lines)


@register("fact_left_dim", q("", """
SELECT c.category, count(*) AS n_lines, CAST(sum(f.net_total) AS DOUBLE) AS revenue
FROM fact f LEFT JOIN cur c ON f.product_id = c.product_id GROUP BY c.category"""))
def fact_left_dim(spark, sf_dir):
    w = wh(spark, sf_dir)
    return D.fact_with_dim(w.fact, w.current, "left").groupBy("category").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("net_total").cast("double").alias("revenue"))


@register("file_overlap", q("""
fr AS (SELECT o_orderpriority AS file, CAST(min(o_orderdate) AS DATE) AS min_date, CAST(max(o_orderdate) AS DATE) AS max_date
       FROM orders WHERE o_orderdate IS NOT NULL GROUP BY o_orderpriority)""", """
SELECT a.file AS file_a, b.file AS file_b, greatest(a.min_date, b.min_date) AS overlap_start,
       least(a.max_date, b.max_date) AS overlap_end
FROM fr a JOIN fr b ON a.file < b.file AND a.min_date <= b.max_date AND b.min_date <= a.max_date"""))
def file_overlap(spark, sf_dir):
    from ..operators.joins import file_overlap as fo
    o = read_table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("file"),
                                                  F.col("o_orderdate").cast("date").alias("date"))
    return fo(o)


# --- data quality (D1-D6) -----------------------------------------------------------

_QM = ("qty", "price", "line_total", "net_total")


def _fact_metrics(spark, sf_dir):
    f = wh(spark, sf_dir).fact
    c = wh(spark, sf_dir).current.select("product_id", "category")
    return f.join(c, "product_id", "left").select(
        "receipt_no", "product_id", "category", *[F.col(m).cast("double").alias(m) for m in _QM])


def _bounds_sql(by: str = "", log_price: bool = False, k: float = 1.5) -> str:
    sel = []
    for m in _QM:
        x = f"ln({m})" if (log_price and m == "price") else m
        q1 = f"quantile_cont(CAST({x} AS DOUBLE), 0.25)"
        q3 = f"quantile_cont(CAST({x} AS DOUBLE), 0.75)"
        lo, hi = f"{q1} - {k} * ({q3} - {q1})", f"{q3} + {k} * ({q3} - {q1})"
        if log_price and m == "price":
            lo, hi = f"exp({lo})", f"exp({hi})"
        sel += [f"round({lo}, 6) AS lower_{m}", f"round({hi}, 6) AS upper_{m}"]
    grp = f"{by}, " if by else ""
    tail = f" GROUP BY {by}" if by else ""
    return (f"fm AS (SELECT f.receipt_no, f.product_id, c.category, " + ", ".join(f"CAST(f.{m} AS DOUBLE) AS {m}" for m in _QM)
            + " FROM fact f LEFT JOIN cur c ON f.product_id = c.product_id),\n"
            f"bd AS (SELECT {grp}" + ", ".join(sel) + f" FROM fm{tail})")


def _flags_sql(by: str = "") -> str:
    on = f"ON fm.{by} IS NOT DISTINCT FROM bd.{by}" if by else "ON TRUE"
    flags = ", ".join(f"coalesce(fm.{m} < bd.lower_{m} OR fm.{m} > bd.upper_{m}, FALSE) AS flag_{m}" for m in _QM)
    n = " + ".join(f"CAST(coalesce(fm.{m} < bd.lower_{m} OR fm.{m} > bd.upper_{m}, FALSE) AS INTEGER)" for m in _QM)
    return f"SELECT fm.receipt_no, fm.product_id, fm.category, {', '.join('fm.' + m for m in _QM)}, {flags}, {n} AS n_flags FROM fm JOIN bd {on}"


@register("outlier_flags", q(_bounds_sql(), _flags_sql()))
def outlier_flags(spark, sf_dir):
    return QL.outlier_flags(_fact_metrics(spark, sf_dir), _QM)


@register("outlier_flags_by_category", q(_bounds_sql("category"), _flags_sql("category")))
def outlier_flags_by_category(spark, sf_dir):
    return QL.outlier_flags(_fact_metrics(spark, sf_dir), _QM, by=("category",))


@register("outlier_flags_log", q(_bounds_sql(log_price=True), _flags_sql()))
def outlier_flags_log(spark, sf_dir):
    return QL.outlier_flags(_fact_metrics(spark, sf_dir), _QM, log_metrics=("price",))


#: At the default 1.5 nothing in the synthetic data is an outlier; a narrower fence flags both tails.
_NARROW = 0.4


@register("outlier_rows_removed", q(_bounds_sql(k=_NARROW), f"SELECT * FROM ({_flags_sql()}) WHERE n_flags >= 2"))
def outlier_rows_removed(spark, sf_dir):
    _, removed = QL.outlier_rows_removed(QL.outlier_flags(_fact_metrics(spark, sf_dir), _QM, k=_NARROW))
    return removed


@register("outlier_value_log", q(_bounds_sql(k=_NARROW) + ",\nlg AS (" + " UNION ALL ".join(
    f"SELECT fm.receipt_no, fm.product_id, '{m}' AS col, fm.{m} AS value, bd.lower_{m} AS lower, bd.upper_{m} AS upper FROM fm, bd"
    for m in _QM) + ")", """
SELECT receipt_no, product_id, col AS "column", value, 'iqr' AS method, CAST(0.4 AS DOUBLE) AS k, lower, upper,
       round(CASE WHEN value < lower THEN value - lower ELSE value - upper END, 6) AS deviation
FROM lg WHERE value < lower OR value > upper"""))
def outlier_value_log(spark, sf_dir):
    return QL.outlier_value_log(_fact_metrics(spark, sf_dir), ["receipt_no", "product_id"], _QM, k=_NARROW)


@register("coercion_report", q("", """
SELECT 'o_orderpriority' AS "column", count(*) FILTER (WHERE o_orderpriority IS NOT NULL AND TRY_CAST(o_orderpriority AS DOUBLE) IS NULL) AS nulls_introduced FROM orders
UNION ALL SELECT 'o_totalprice', count(*) FILTER (WHERE o_totalprice IS NOT NULL AND TRY_CAST(CAST(o_totalprice AS VARCHAR) AS DOUBLE) IS NULL) FROM orders
UNION ALL SELECT 'o_orderstatus', count(*) FILTER (WHERE o_orderstatus IS NOT NULL AND TRY_CAST(o_orderstatus AS DOUBLE) IS NULL) FROM orders"""))
def coercion_report(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    return QL.coercion_report(o, ["o_orderpriority", "o_totalprice", "o_orderstatus"])


# --- SCD incremental, upsert, history lookup, streaming (P3, P4, K1, S5, S6, R1-R3) ----

_CUT = "1998-01-01"


def _split(spark, sf_dir):
    l = wh(spark, sf_dir).lines_distinct
    return l.filter(F.col("date") < F.lit(_CUT).cast("date")), l.filter(F.col("date") >= F.lit(_CUT).cast("date"))


@register("scd_incremental")
def scd_incremental_q(spark, sf_dir):
    from ..operators.dimensions import product_dim_history, scd_incremental
    old, new = _split(spark, sf_dir)
    cur_rows, hist_rows = scd_incremental(new, product_dim_history(old))
    return hist_rows.withColumn("price", F.col("price").cast("double")).withColumn(
        "product_cost", F.col("product_cost").cast("double"))


@register("upsert_merge")
def upsert_merge_q(spark, sf_dir):
    from ..operators.dimensions import product_dim_history, scd_incremental
    from ..operators.upsert import upsert_merge
    old, new = _split(spark, sf_dir)
    base = product_dim_history(old)
    _, hist_rows = scd_incremental(new, base)
    return upsert_merge(base, hist_rows, ["product_id", "record_version"]).withColumn(
        "price", F.col("price").cast("double")).withColumn("product_cost", F.col("product_cost").cast("double"))


def _history_lookup_sql():
    return q("""
st AS (SELECT product_id, product_name, price, arg_min(datetime, seq) AS dt, min(seq) AS fs
       FROM combined GROUP BY product_id, product_name, price),
h AS (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY fs) AS rv,
             count(*) OVER (PARTITION BY product_id) AS mx FROM st)""", f"""
SELECT product_id, product_name, CAST(price AS DOUBLE) AS price,
       CAST(round(CAST(price AS DECIMAL(10,2)) * CAST(0.60 AS DECIMAL(3,2)), 2) AS DOUBLE) AS product_cost,
       dt AS last_transaction_datetime, CAST(rv AS INTEGER) AS record_version, rv = mx AS is_current,
       {parent_sku_sql('product_name')} AS parent_sku, {category_sql('product_name', 'product_id')} AS category
FROM h WHERE product_id IN (SELECT product_id FROM combined WHERE date >= DATE '{_CUT}' AND qty >= 50 AND line_total > 85000)""")


@register("history_lookup", _history_lookup_sql())
def history_lookup_q(spark, sf_dir):
    from ..operators.dimensions import history_lookup
    w = wh(spark, sf_dir)
    _, new = _split(spark, sf_dir)
    large = new.filter("qty >= 50 and line_total > 85000")
    return history_lookup(w.history, large.select("product_id")).withColumn("price", F.col("price").cast("double")) \
        .withColumn("product_cost", F.col("product_cost").cast("double"))


@register("stream_scd")
def stream_scd_q(spark, sf_dir):
    """Lines land in two batches (before / after the cut date); the stream drains
    them and maintains the dimensions.  Returns the final history table."""
    import uuid

    from ..session import shared_path
    from ..streaming.ingest import stream_scd
    base = shared_path(spark, "stream", uuid.uuid4().hex)
    old, new = _split(spark, sf_dir)
    cols = ["date", "datetime", "receipt_no", "product_id", "product_name", "price", "seq"]
    old.select(*cols).write.parquet(f"{base}/landing/part=1")
    schema = old.select(*cols).schema
    # one batch per trigger: drain the first upload, then the second
    stream_scd(spark, f"{base}/landing", schema, f"{base}/ckpt", f"{base}/state")
    new.select(*cols).write.parquet(f"{base}/landing/part=2")
    state = stream_scd(spark, f"{base}/landing", schema, f"{base}/ckpt", f"{base}/state")
    return state.latest("history").withColumn("price", F.col("price").cast("double")) \
        .withColumn("product_cost", F.col("product_cost").cast("double"))
