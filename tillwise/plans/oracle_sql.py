"""Reference SQL (DuckDB dialect) for the catalogue's queries.

Each statement re-derives its result from the raw tables independently of
the Spark code: the same warehouse rules (canonical ids, categories, parent
SKUs) are written out in SQL here.  Used as the correctness oracle.
"""

from __future__ import annotations

from .. import config as C


def _sql_list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def category_sql(name: str, pid: str) -> str:
    """F2 in SQL."""
    up = f"upper(coalesce({name}, ''))"
    others = " OR ".join(
        [f"{up} LIKE '%{s}%'" for s in C.OTHERS_SUBSTRINGS]
        + [f"regexp_matches({up}, '\\b{w}\\b')" for w in C.OTHERS_WORDS]
    )
    extra = " OR ".join(
        [f"{up} LIKE '%{s}%'" for s in C.EXTRA_SUBSTRINGS]
        + [f"regexp_matches({up}, '\\b{w}\\b')" for w in C.EXTRA_WORDS]
    )
    drink_id = " OR ".join(f"upper(coalesce({pid}, '')) LIKE '%{m}%'" for m in C.DRINK_ID_MARKERS)
    drink = f"list_has_any(regexp_extract_all({up}, '[A-Z0-9]+'), {_sql_list(C.DRINK_KEYWORDS)}) OR {drink_id}"
    return (f"CASE WHEN {others} THEN 'OTHERS' WHEN {extra} THEN 'EXTRA' "
            f"WHEN {drink} THEN 'DRINK' ELSE 'FOOD' END")


_SIZE = r"\b(" + "|".join(C.PARENT_SKU_SIZES) + r")\s*(?:O|0)Z\.?\b"
_ZERO = r"\b(" + "|".join(C.PARENT_SKU_SIZES) + r")0Z\b"


def _tokens(x: str) -> str:
    return f"list_filter(string_split_regex({x}, '\\s+'), lambda t: t <> '')"


def parent_sku_sql(name: str) -> str:
    """F1 in SQL (DuckDB's regex has no lookahead; a plain trailing \\b is equivalent)."""
    orig = f"upper(trim({name}))"
    work = f"regexp_replace(replace({orig}, '.', ' '), '{_ZERO}', '\\1OZ', 'g')"
    trig = f"(list_has_any({_tokens(work)}, {_sql_list(C.PARENT_SKU_TRIGGER_TOKENS)}) OR regexp_matches({work}, '{_SIZE}'))"
    drop = _sql_list(C.PARENT_SKU_TRIGGER_TOKENS + ("OZ",) + C.PARENT_SKU_SIZES)
    stripped = f"list_filter({_tokens(f'regexp_replace({work}, {chr(39)}{_SIZE}{chr(39)}, {chr(39)}{chr(39)}, {chr(39)}g{chr(39)})')}, lambda t: NOT list_contains({drop}, t))"
    toks = (f"CASE WHEN {trig} THEN (CASE WHEN len({stripped}) = 0 THEN {_tokens(orig)} ELSE {stripped} END) "
            f"ELSE {_tokens(orig)} END")
    digits = "[" + "".join(C.PARENT_SKU_TRAILING_DIGITS) + "]"
    spaced = f"regexp_replace(array_to_string({toks}, ' '), '(^|\\s){digits}(\\s{digits})*$', '')"
    return f"CASE WHEN {name} IS NULL OR trim({name}) = '' THEN '' ELSE replace({spaced}, ' ', '-') END"


def cost_sql(category: str, price: str) -> str:
    """F10 without a costing sheet: 60 % of price, half-up to cents."""
    return f"CAST(round(CAST({price} AS DECIMAL(10,2)) * CAST(0.60 AS DECIMAL(3,2)), 2) AS DECIMAL(10,2))"


# --- shared CTEs ---------------------------------------------------------------
#: raw_lines: line report; canon: first-seen id per name; lines: canonical lines;
#: combined: header x lines; dlines: distinct fact projection; fact: no latest month;
#: cur: current product dimension (+ category, parent SKU).
BASE = f"""
raw_lines AS (
  SELECT l.l_orderkey AS receipt_no, CAST(l.l_partkey AS VARCHAR) AS raw_id, p.p_name AS raw_name,
         CAST(l.l_quantity AS INTEGER) AS qty, CAST(p.p_retailprice AS DECIMAL(10,2)) AS price,
         CAST(l.l_extendedprice AS DECIMAL(12,2)) AS line_total,
         CAST(round(CAST(l.l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2))), 2) AS DECIMAL(12,2)) AS net_total,
         {{'k0': l.l_orderkey, 'k1': l.l_linenumber, 'k2': l.l_partkey, 'k3': l.l_extendedprice}} AS seq
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
),
canon AS (
  SELECT lower(trim(raw_name)) AS nk, arg_min(raw_id, seq) AS canon_id
  FROM raw_lines WHERE raw_id IS NOT NULL AND raw_name IS NOT NULL GROUP BY 1
),
lines AS (
  SELECT r.receipt_no, coalesce(c.canon_id, r.raw_id) AS product_id, upper(trim(r.raw_name)) AS product_name,
         r.qty, r.price, r.line_total, r.net_total, r.seq
  FROM raw_lines r LEFT JOIN canon c ON lower(trim(r.raw_name)) = c.nk
),
combined AS (
  SELECT CAST(o.o_orderdate AS DATE) AS date, CAST(o.o_orderdate AS TIMESTAMP) AS datetime, l.*
  FROM orders o JOIN lines l ON o.o_orderkey = l.receipt_no
),
dlines AS (
  SELECT date, receipt_no, product_id, product_name, qty, price, line_total, net_total, min(seq) AS seq
  FROM combined GROUP BY ALL
),
fact AS (
  SELECT * FROM dlines
  WHERE date_trunc('month', date) IS DISTINCT FROM (SELECT max(date_trunc('month', date)) FROM dlines)
),
cur0 AS (
  SELECT product_id, arg_max(product_name, seq) FILTER (WHERE product_name IS NOT NULL) AS product_name,
         arg_max(price, seq) FILTER (WHERE price IS NOT NULL) AS price,
         arg_max(datetime, seq) FILTER (WHERE datetime IS NOT NULL) AS last_transaction_datetime
  FROM combined GROUP BY product_id
),
cur AS (
  SELECT product_id, product_name, price, last_transaction_datetime,
         {category_sql('product_name', 'product_id')} AS category,
         {parent_sku_sql('product_name')} AS parent_sku,
         {cost_sql('category', 'price')} AS product_cost
  FROM cur0
)"""


def with_base(body: str) -> str:
    return "WITH " + BASE.strip() + ",\n" + body.strip()


def q(body_ctes: str, select: str) -> str:
    """Compose: base CTEs, optional extra CTEs, final select."""
    if body_ctes.strip():
        return "WITH " + BASE.strip() + ",\n" + body_ctes.strip() + "\n" + select.strip()
    return "WITH " + BASE.strip() + "\n" + select.strip()


# --- basket mining CTEs --------------------------------------------------------
def basket_ctes(min_support: float, runs=("FOOD", "DRINK", "MEAL")) -> str:
    """bl: basket lines (receipt, sku); skumap; items; ri: run rows; nrun; fs: frequent
    singles; fp: frequent pairs."""
    parts = []
    if "FOOD" in runs or "DRINK" in runs:
        parts += [f"SELECT '{r}' AS run, receipt_no, item, category FROM fd WHERE category = '{r}'"
                  for r in ("FOOD", "DRINK") if r in runs]
    if "MEAL" in runs:
        parts.append("SELECT 'MEAL' AS run, receipt_no, item, category FROM fd "
                     "WHERE receipt_no IN (SELECT receipt_no FROM meal_r)")
    if "ALL" in runs:
        parts.append("SELECT 'ALL' AS run, receipt_no, item, category FROM ic")
    ri = "\n  UNION ALL ".join(parts)
    return f"""
bl AS (
  SELECT d.receipt_no, coalesce(c.parent_sku, d.product_id) AS sku
  FROM dlines d LEFT JOIN cur c ON d.product_id = c.product_id
),
skumap AS (
  SELECT sku, arg_max(pid, pri) AS pid FROM (
    SELECT trim(product_id) AS sku, trim(product_id) AS pid, 0 AS pri FROM cur
    UNION ALL
    SELECT sku, max(pid) AS pid, 1 AS pri FROM (
      SELECT trim(s) AS sku, trim(product_id) AS pid
      FROM (SELECT product_id, unnest(string_split(parent_sku, ',')) AS s FROM cur
            WHERE parent_sku IS NOT NULL AND parent_sku <> '')
    ) WHERE sku <> '' GROUP BY sku
  ) GROUP BY sku
),
items AS (
  SELECT DISTINCT b.receipt_no, m.pid AS item
  FROM (SELECT receipt_no, trim(unnest(string_split(sku, ','))) AS s FROM bl) b JOIN skumap m ON b.s = m.sku
),
ic AS (SELECT i.receipt_no, i.item, c.category FROM items i JOIN cur c ON i.item = trim(c.product_id)),
fd AS (SELECT * FROM ic WHERE category IN ('FOOD', 'DRINK')),
meal_r AS (SELECT receipt_no FROM fd GROUP BY receipt_no HAVING bool_or(category = 'FOOD') AND bool_or(category = 'DRINK')),
ri AS (
  {ri}
),
nrun AS (SELECT run, count(DISTINCT receipt_no) AS n FROM ri GROUP BY run),
fs AS (
  SELECT s.run, s.item, s.category, s.n_i, r.n FROM (SELECT run, item, category, count(*) AS n_i FROM ri GROUP BY ALL) s
  JOIN nrun r USING (run) WHERE s.n_i / r.n >= {min_support}
),
pr AS (SELECT ri.* FROM ri JOIN fs USING (run, item)),
fp AS (
  SELECT p.*, r.n FROM (
    SELECT a.run, a.item AS a, b.item AS b, count(*) AS n_ab FROM pr a JOIN pr b
    ON a.run = b.run AND a.receipt_no = b.receipt_no AND a.item < b.item GROUP BY ALL
  ) p JOIN nrun r USING (run) WHERE p.n_ab / r.n >= {min_support}
),
names AS (SELECT trim(product_id) AS nid, product_name AS nname FROM cur)"""


def rules_ctes(min_support: float, min_conf: float, min_lift: float, runs=("FOOD", "DRINK", "MEAL")) -> str:
    """rules: both directions with metrics, thresholds, MEAL crossing, names."""
    return basket_ctes(min_support, runs) + f""",
dirs AS (
  SELECT run, a AS ant, b AS con, n_ab, n FROM fp UNION ALL SELECT run, b AS ant, a AS con, n_ab, n FROM fp
),
rules0 AS (
  SELECT d.run, d.ant, d.con, sa.category AS cat_a, sc.category AS cat_c,
         d.n_ab / d.n AS support, d.n_ab / sa.n_i AS confidence,
         (d.n_ab / sa.n_i) / (sc.n_i / d.n) AS lift,
         d.n_ab / d.n - (sa.n_i / d.n) * (sc.n_i / d.n) AS leverage,
         CASE WHEN d.n_ab / sa.n_i = 1.0 THEN CAST('inf' AS DOUBLE)
              ELSE (1.0 - sc.n_i / d.n) / (1.0 - d.n_ab / sa.n_i) END AS conviction
  FROM dirs d JOIN fs sa ON sa.run = d.run AND sa.item = d.ant JOIN fs sc ON sc.run = d.run AND sc.item = d.con
),
rules AS (
  SELECT r.*, coalesce(na.nname, r.ant) AS antecedents_names, coalesce(nc.nname, r.con) AS consequents_names
  FROM rules0 r LEFT JOIN names na ON na.nid = r.ant LEFT JOIN names nc ON nc.nid = r.con
  WHERE r.confidence >= {min_conf} AND r.lift >= {min_lift} AND (r.run <> 'MEAL' OR r.cat_a <> r.cat_c)
)"""


BUNDLE_RULES_CTES = """
scored AS (SELECT *, lift * 0.7 + support / max(support) OVER (PARTITION BY run) * 30.0 AS combined_score FROM rules),
dedup AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY run, least(antecedents_names, consequents_names),
                 greatest(antecedents_names, consequents_names)
                 ORDER BY round(combined_score, 9) DESC, confidence DESC, antecedents_names) AS m FROM scored) WHERE m = 1
),
topr AS (
  SELECT *, row_number() OVER (PARTITION BY run ORDER BY round(combined_score, 9) DESC, confidence DESC, lift DESC,
         antecedents_names) AS rk FROM dedup
),
br AS (
  SELECT printf('%s%02d', CASE run WHEN 'FOOD' THEN 'BF' WHEN 'DRINK' THEN 'BD' ELSE 'BM' END, rk) AS bundle_id,
         antecedents_names, consequents_names, support, confidence, lift, leverage, conviction, combined_score,
         run AS category
  FROM topr WHERE rk <= 5
)"""


def elasticity_ctes(min_support, min_conf, min_lift, price_bin, strict=False, n=15) -> str:
    """br (bundle rules) -> rb (resolved top bundles) -> brc (bundle receipts) -> pts -> ped."""
    strict_filter = ""
    if strict:
        strict_filter = ("AND receipt_no IN (SELECT receipt_no FROM fact GROUP BY receipt_no "
                         "HAVING count(DISTINCT product_id) = 2)")
    bin_ = f"CAST({price_bin} AS DECIMAL(12,2))"
    price = (f"CAST(round(combined_price / {bin_}, 0) * {bin_} AS DECIMAL(20,2))" if price_bin
             else "CAST(combined_price AS DECIMAL(20,2))")
    return rules_ctes(min_support, min_conf, min_lift) + "," + BUNDLE_RULES_CTES + f""",
top AS (
  SELECT *, row_number() OVER (ORDER BY CASE category WHEN 'FOOD' THEN 0 WHEN 'DRINK' THEN 1 WHEN 'MEAL' THEN 2 ELSE 9 END,
                               bundle_id) - 1 AS rule_row
  FROM br
),
byname AS (SELECT product_name, min(product_id) AS pid FROM cur GROUP BY product_name),
rb AS (
  SELECT t.*, a.pid AS product_id_1, b.pid AS product_id_2
  FROM top t JOIN byname a ON t.antecedents_names = a.product_name JOIN byname b ON t.consequents_names = b.product_name
  WHERE t.rule_row < {n}
),
sides AS (SELECT bundle_id, product_id_1 AS product_id FROM rb UNION ALL SELECT bundle_id, product_id_2 FROM rb),
brc0 AS (
  SELECT s.bundle_id, f.receipt_no, sum(f.line_total) AS combined_price, arg_min(f.date, f.seq) AS date
  FROM fact f JOIN sides s ON f.product_id = s.product_id
  GROUP BY s.bundle_id, f.receipt_no HAVING count(DISTINCT f.product_id) = 2
),
brc AS (SELECT * FROM brc0 WHERE TRUE {strict_filter}),
pts AS (SELECT bundle_id, {price} AS combined_price, count(*) AS num_transactions FROM brc GROUP BY ALL),
fit AS (
  SELECT bundle_id, regr_count(ln(num_transactions), ln(combined_price)) AS n,
         regr_slope(ln(num_transactions), ln(combined_price)) AS eps,
         regr_intercept(ln(num_transactions), ln(combined_price)) AS k,
         regr_r2(ln(num_transactions), ln(combined_price)) AS r2
  FROM pts WHERE combined_price > 0 AND num_transactions > 0 GROUP BY bundle_id
),
ped AS (
  SELECT rb.bundle_id, rb.category, CAST(rb.rule_row AS INTEGER) AS rule_row, rb.product_id_1, rb.product_id_2,
         rb.antecedents_names AS product_name_1, rb.consequents_names AS product_name_2,
         '{"strict" if strict else "non_strict"}' AS mode,
         CAST(coalesce(fit.n, 0) AS INTEGER) AS n_price_points,
         coalesce(CASE WHEN fit.n >= 2 THEN round(coalesce(fit.eps, 0.0), 6) ELSE 0.0 END, 0.0) AS elasticity_epsilon,
         coalesce(CASE WHEN fit.n >= 2 THEN round(coalesce(fit.k, 0.0), 6) ELSE 0.0 END, 0.0) AS intercept_logk,
         CASE WHEN fit.n >= 2 THEN round(fit.r2, 6) END AS r2_logspace
  FROM rb LEFT JOIN fit ON rb.bundle_id = fit.bundle_id
)"""


def pricing_ctes(objective: str = "quantity") -> str:
    """econ: bundle economics with skip reason; rec: recommendations."""
    best = "lower_b" if objective == "quantity" else (
        "CASE WHEN eps >= -1 THEN cap ELSE least(greatest(eps * cogs / (1.0 + eps), lower_b), cap) END")
    return f""",
info AS (
  SELECT product_name, arg_min({{'price': coalesce(TRY_CAST(price AS DOUBLE), 0.0),
         'cogs': coalesce(CAST(product_cost AS DOUBLE), coalesce(TRY_CAST(price AS DOUBLE), 0.0) * 0.6)}}, product_id) AS i
  FROM cur GROUP BY product_name
),
econ AS (
  SELECT p.bundle_id, p.product_name_1 || ' + ' || p.product_name_2 AS bundle_name, p.category,
         p.product_name_1 AS product_a, p.product_name_2 AS product_b,
         a.i.price AS product_a_price, b.i.price AS product_b_price, a.i.price + b.i.price AS current_price_total,
         a.i.cogs AS ca, b.i.cogs AS cb, coalesce(TRY_CAST(p.elasticity_epsilon AS DOUBLE), 0.0) AS eps,
         coalesce(TRY_CAST(p.intercept_logk AS DOUBLE), 0.0) AS intercept, CAST(p.r2_logspace AS DOUBLE) AS r2,
         p.n_price_points AS n_points,
         CASE WHEN coalesce(p.n_price_points, 0) < 2 OR p.r2_logspace IS NULL OR isnan(CAST(p.r2_logspace AS DOUBLE))
                   OR coalesce(TRY_CAST(p.elasticity_epsilon AS DOUBLE), 0.0) >= 0
              THEN 'Insufficient data or invalid elasticity (ε >= 0)'
              WHEN a.product_name IS NULL OR b.product_name IS NULL THEN 'Product(s) not found in dimension' END AS skip_reason
  FROM ped p LEFT JOIN info a ON p.product_name_1 = a.product_name LEFT JOIN info b ON p.product_name_2 = b.product_name
),
b0 AS (
  SELECT *, ca + cb AS cogs, current_price_total AS cap,
         greatest(current_price_total * 0.9, (ca + cb) / 0.9) AS lower_b
  FROM econ WHERE skip_reason IS NULL
),
b1 AS (SELECT *, CASE WHEN lower_b <= cap THEN {best} ELSE (lower_b + cap) / 2.0 END AS price, lower_b <= cap AS ok FROM b0),
rec AS (
  SELECT bundle_id, bundle_name, category, product_a, product_b, product_a_price, product_b_price, current_price_total,
         round(ca, 2) AS product_a_cogs, round(cb, 2) AS product_b_cogs, round(cogs, 2) AS cogs_total,
         round(eps, 6) AS elasticity_epsilon, round(exp(intercept), 6) AS base_demand_k, round(r2, 6) AS r_squared,
         CAST(n_points AS INTEGER) AS n_points, round(price, 2) AS bundle_price_recommended,
         round(exp(intercept) * pow(price, eps), 4) AS quantity_demanded,
         round((price - cogs) * (exp(intercept) * pow(price, eps)), 2) AS profit, round(cap, 2) AS price_cap,
         CAST(10.0 AS DOUBLE) AS min_discount_pct, ok AS optimization_success
  FROM b1
)"""
