"""DuckDB SQL of the forecasts and what follows from them: Holt-Winters as a recursive query."""

from __future__ import annotations

from .. import config as C
from ..operators import forecast as FC
from . import catalog
from .catalog import _MONTHS, _QEND, _SCEN_CTES, Q_SUPPORT, _fill_sql
from .oracle_sql import basket_ctes, q


def rq(ctes: str, select: str) -> str:
    return q(ctes, select).replace("WITH ", "WITH RECURSIVE ", 1)


def start_ctes(series: str, m: int = C.SEASON_LENGTH) -> str:
    """ser (series as lists) and st (those long enough, with the start state) from (key, series, period, units); m is even."""
    half, points = m // 2, FC.START_POINTS
    need, mid = points + 2 * half, (points + 1) / 2
    spread = sum((x - mid) ** 2 for x in range(1, points + 1))
    raw = ", ".join(f"list_avg([rest[p + 1] for p in range(0, len(rest)) if (p + {half}) % {m} = {j}])" for j in range(m))
    mean = f"list_sum(y[1:{m}]) / {m}"
    return f"""
ser AS (SELECT key, series, list(CAST(units AS DOUBLE) ORDER BY period) AS y, list(period ORDER BY period) AS periods, count(*) AS n FROM {series} GROUP BY key, series),
st0 AS (SELECT *, CAST(least(n, {m} * greatest(least({FC.START_SEASONS}, n // {m}), {-(-need // m)})) AS BIGINT) AS used FROM ser WHERE n >= {2 * m}),
st1 AS (SELECT *, CASE WHEN n >= {need} THEN [(y[i + 1] / 2 + list_sum(y[i + 2:i + {m}]) + y[i + {m + 1}] / 2) / {m} for i in range(0, used - {2 * half})] END AS ma FROM st0),
st2 AS (SELECT *, [y[p + {half + 1}] - ma[p + 1] for p in range(0, len(ma))] AS rest, list_sum([(x - {mid}) * ma[x] for x in range(1, {points + 1})]) / {spread} AS slope FROM st1),
st3 AS (SELECT *, [{raw}] AS raw FROM st2),
st AS (
  SELECT key, series, y, periods, n, list_sum(ma[1:{points}]) / {points} - {mid} * slope AS level0, slope AS trend0, [r - list_sum(raw) / {m} for r in raw] AS season0 FROM st3 WHERE n >= {need}
  UNION ALL SELECT key, series, y, periods, n, {mean}, (list_sum(y[{m + 1}:{2 * m}]) / {m} - {mean}) / {m}, [v - {mean} for v in y[1:{m}]] FROM st3 WHERE n < {need}
)"""


def hw_ctes(name: str = "hw", source: str = "st", a: str = str(C.HW_ALPHA), b: str = str(C.HW_BETA), g: str = str(C.HW_GAMMA), keep: str = "") -> str:
    """Level, trend, season (its head is the next position), fitted value and squared error after t periods of ``source``."""
    new = f"({a} * (y[t + 1] - season[1]) + (1 - {a}) * (level + trend))"
    return f"""
{name} AS (
  SELECT key, series{keep}, y, periods, n, CAST(0 AS BIGINT) AS t, level0 AS level, trend0 AS trend, season0 AS season, CAST(NULL AS DOUBLE) AS fitted, CAST(0 AS DOUBLE) AS sse FROM {source}
  UNION ALL
  SELECT key, series{keep}, y, periods, n, t + 1, {new}, {b} * ({new} - level) + (1 - {b}) * trend, list_append(season[2:], {g} * (y[t + 1] - (level + trend)) + (1 - {g}) * season[1]),
         level + trend + season[1], sse + (y[t + 1] - (level + trend + season[1])) * (y[t + 1] - (level + trend + season[1])) FROM {name} WHERE t < n
)"""


def tuned_ctes() -> str:
    """hwt: the recursion with the parameters of least error, found by the same grid and halvings as the operator."""
    n, p = round(1 / FC.GRID_STEP), "alpha, beta, gamma"
    span = lambda c, d, r: f"{c} + {d} * {FC.GRID_STEP / 2 ** r}"
    first = f"""
p0 AS (SELECT st.*, CAST(a AS DOUBLE) / {n} AS alpha, CAST(b AS DOUBLE) / {n} AS beta, CAST(g AS DOUBLE) / {n} AS gamma
  FROM st, range(0, {n + 1}) ra(a), range(0, {n + 1}) rb(b), range(0, {n + 1}) rg(g) WHERE b <= a AND g <= {n} - a)"""
    parts = [first]
    for r in range(FC.ROUNDS + 1):
        parts.append(hw_ctes(f"w{r}", f"p{r}", *p.split(", "), keep=f", {p}"))
        parts.append(f"\nb{r} AS (SELECT key, series, {p}, sse AS least FROM w{r} WHERE t = n QUALIFY row_number() OVER (PARTITION BY key, series ORDER BY sse, {p}) = 1)")
        if r < FC.ROUNDS:
            parts.append(f"""
p{r + 1} AS (
  SELECT DISTINCT st.*, q.alpha, least(greatest(q.beta, 0.0), q.alpha) AS beta, least(greatest(q.gamma, 0.0), 1 - q.alpha) AS gamma
  FROM st JOIN (SELECT key, series, least(greatest({span("alpha", "da", r)}, 0.0), 1.0) AS alpha, {span("beta", "db", r)} AS beta, {span("gamma", "dg", r)} AS gamma
                FROM b{r}, moves ma(da), moves mb(db), moves mg(dg)) q ON q.key = st.key AND q.series = st.series
)""")
    parts.insert(0, "\nmoves AS (SELECT unnest([CAST(-1 AS DOUBLE), -0.5, 0, 0.5, 1]) AS d)")
    best = f"\npt AS (SELECT st.*, {p}, least FROM st JOIN b{FC.ROUNDS} b ON b.key = st.key AND b.series = st.series)"
    return ",".join([*parts, best, hw_ctes("hwt", "pt", *p.split(", "), keep=f", {p}, least")])


_LONG = _SCEN_CTES + f""",
rd AS (SELECT product_id, receipt_no, arg_min(date, seq) AS date FROM fact GROUP BY product_id, receipt_no),
cnt_p AS (SELECT product_id, {_QEND.format(d='date')} AS period, count(*) AS units FROM rd WHERE date IS NOT NULL GROUP BY ALL),
{_fill_sql("cnt_p", "product_id").strip()},
cnt_b AS (SELECT bundle_id, {_QEND.format(d='date')} AS period, count(*) AS units FROM brc WHERE date IS NOT NULL GROUP BY ALL),
{_fill_sql("cnt_b", "bundle_id").strip()},
long AS (
  SELECT f.bundle_id AS key, 'bundle' AS series, period, units FROM filled_cnt_b f JOIN scen ON scen.bundle_id = f.bundle_id
  UNION ALL SELECT scen.bundle_id, 'antecedent', period, units FROM filled_cnt_p f JOIN scen ON f.product_id = scen.product_id_1
  UNION ALL SELECT scen.bundle_id, 'consequent', period, units FROM filled_cnt_p f JOIN scen ON f.product_id = scen.product_id_2
)"""
_HW = _LONG + "," + start_ctes("long") + "," + hw_ctes()
_STEP = f"level + k * trend + season[((k - 1) % {C.SEASON_LENGTH}) + 1]"
_FC = _HW + f""",
fc AS (SELECT key, series, k, {_STEP} AS f FROM hw, range(1, {C.HORIZON + 1}) r(k) WHERE t = n),
bad AS (SELECT DISTINCT key FROM ser WHERE n < 8),
mult AS (SELECT *, CASE WHEN current_price > 0 THEN pow(new_price / current_price, epsilon) ELSE 1.0 END AS demand_multiplier FROM scen),
lastp2 AS (SELECT key, max(period) AS lp FROM long GROUP BY key),
fx AS (
  SELECT l.key AS bundle_id, k, last_day(CAST(lp + to_months(CAST(k * 3 AS INTEGER)) AS DATE)) AS date,
         coalesce((SELECT f FROM fc WHERE fc.key = l.key AND fc.k = r.k AND series = 'bundle'), 0.0) AS raw_b,
         greatest(coalesce((SELECT f FROM fc WHERE fc.key = l.key AND fc.k = r.k AND series = 'antecedent'), 0.0), 0.0) AS a_fc,
         greatest(coalesce((SELECT f FROM fc WHERE fc.key = l.key AND fc.k = r.k AND series = 'consequent'), 0.0), 0.0) AS c_fc
  FROM lastp2 l, range(1, {C.HORIZON + 1}) r(k) WHERE l.key NOT IN (SELECT key FROM bad)
),
fz AS (
  SELECT m.*, date, raw_b, greatest(raw_b, 0.0) AS b_fc, greatest(raw_b * demand_multiplier, 0.0) AS b_adj, a_fc, greatest(a_fc - greatest(raw_b, 0.0), 0.0) AS a_after,
         c_fc, greatest(c_fc - greatest(raw_b, 0.0), 0.0) AS c_after FROM fx JOIN mult m ON m.bundle_id = fx.bundle_id
)"""

_MONTHLY = _MONTHS + """,
mon AS (SELECT 'overall' AS key, 'receipts' AS series, month AS period, receipts AS units FROM filled_months WHERE month < (SELECT max(month) FROM filled_months))""" + "," + start_ctes("mon", 12) + "," + tuned_ctes()
_METRICS = """
SELECT key, series, round(avg(abs(actual - fitted)), 6) AS mae, round(avg((actual - fitted) ** 2), 6) AS mse, round(sqrt(avg((actual - fitted) ** 2)), 6) AS rmse,
       round(CASE WHEN sum(actual) <> 0 THEN sum(abs(actual - fitted)) / sum(abs(actual)) * 100 END, 6) AS wmape,
       round(CASE WHEN avg(naive) <> 0 THEN avg(abs(actual - fitted)) / avg(naive) END, 6) AS mase FROM ft GROUP BY key, series"""


def _steps(hw: str, lag: int) -> str:
    return f""",
ft AS (SELECT key, series, t, y[t] AS actual, fitted, abs(y[t] - lag(y[t], {lag}) OVER (PARTITION BY key, series ORDER BY t)) AS naive FROM {hw} WHERE t > 0)"""


_SUMMARY = f"""
sp AS (SELECT *, current_price * {1 - C.SUMMARY_DISCOUNT_RATE} AS price2 FROM fz),
sv AS (SELECT *, CASE WHEN current_price > 0 AND price2 > 0 THEN pow(price2 / current_price, epsilon) ELSE 1.0 END AS mult2 FROM sp),
sg AS (
  SELECT bundle_id, category, antecedents_names AS product_a, consequents_names AS product_b, current_price, price2, sum(a_fc * price_a + c_fc * price_b) AS before,
         sum(a_after * price_a + c_after * price_b + greatest(raw_b * mult2, 0.0) * price2) AS after FROM sv GROUP BY ALL
)"""

SQL = {
    "series_align": q(_LONG, """
SELECT key AS bundle_id, period, max(units) FILTER (series = 'bundle') AS bundle, max(units) FILTER (series = 'antecedent') AS antecedent, max(units) FILTER (series = 'consequent') AS consequent
FROM long GROUP BY key, period"""),
    "holt_winters": rq(_HW, f"""
SELECT key AS bundle_id, series, CAST(k AS INTEGER) AS step, round({_STEP}, 6) AS forecast, 'ok' AS status FROM hw, range(1, {C.HORIZON + 1}) r(k) WHERE t = n
UNION ALL SELECT key, series, NULL, NULL, 'too_short' FROM ser WHERE n < 8"""),
    "forecast_metrics": rq(_HW + _steps("hw", C.SEASON_LENGTH), _METRICS),
    "holt_winters_tuned": rq(_MONTHLY, """
SELECT key, series, round(alpha, 6) AS alpha, round(beta, 6) AS beta, round(gamma, 6) AS gamma, round(least, 6) AS sse, CAST(k AS INTEGER) AS step,
       round(level + k * trend + season[k], 6) AS forecast FROM hwt, range(1, 13) r(k) WHERE t = n"""),
    "forecast_metrics_monthly": rq(_MONTHLY + _steps("hwt", 1), _METRICS),
    "bundle_forecast": rq(_FC, """
SELECT date, bundle_id, CAST(bundle_row AS INTEGER) AS bundle_row, category, CAST(NULL AS DOUBLE) AS bundle_units, CAST(NULL AS DOUBLE) AS antecedent_units, CAST(NULL AS DOUBLE) AS consequent_units,
       round(b_fc, 6) AS bundle_units_forecast, round(b_adj, 6) AS bundle_units_adjusted_forecast, round(a_fc, 6) AS antecedent_units_forecast, round(a_after, 6) AS antecedent_units_after_cannibalization,
       round(c_fc, 6) AS consequent_units_forecast, round(c_after, 6) AS consequent_units_after_cannibalization FROM fz
UNION ALL
SELECT period, key, CAST(any_value(scen.bundle_row) AS INTEGER), any_value(scen.category), max(units) FILTER (series = 'bundle'), max(units) FILTER (series = 'antecedent'), max(units) FILTER (series = 'consequent'),
       NULL, NULL, NULL, NULL, NULL, NULL FROM long JOIN scen ON scen.bundle_id = long.key WHERE key NOT IN (SELECT key FROM bad) GROUP BY key, period"""),
    "revenue_impact": rq(_FC + """,
rv AS (SELECT bundle_id, category, new_price, sum(a_fc * price_a + c_fc * price_b) AS before, sum(a_after * price_a + c_after * price_b + b_adj * new_price) AS after FROM fz GROUP BY ALL)""", """
SELECT bundle_id, category, CAST(round(CAST(new_price AS DECIMAL(20,6)), 2) AS DOUBLE) AS new_price, round(before, 2) AS revenue_before, round(after, 2) AS revenue_after, round(after - before, 2) AS impact_abs,
       round(CASE WHEN before <> 0 THEN (after - before) / before * 100 END, 4) AS impact_pct FROM rv"""),
    "break_even_by_period": rq(_FC + """,
df AS (SELECT bundle_id, date, new_price, (a_after * price_a + c_after * price_b + b_adj * new_price) - (a_fc * price_a + c_fc * price_b) AS diff FROM fz),
dt AS (SELECT *, sum(diff) OVER (PARTITION BY bundle_id) < 0 AS neg, CASE WHEN diff < 0 THEN -diff ELSE 0.0 END AS gap, CASE WHEN diff > 0 THEN diff ELSE 0.0 END AS sur FROM df)""", """
SELECT bundle_id, date AS period, CASE WHEN neg THEN 'break_even' ELSE 'surplus' END AS mode, round(CASE WHEN neg THEN gap ELSE sur END, 2) AS revenue_amount,
       CAST(CASE WHEN new_price <= 0 THEN NULL WHEN neg THEN ceil(gap / new_price) ELSE floor(sur / new_price) END AS BIGINT) AS bundle_units FROM dt"""),
    "bundle_summary": rq(_FC + "," + _SUMMARY, f"""
SELECT bundle_id, category, product_a, product_b, CAST(round(CAST(current_price AS DECIMAL(20,6)), 2) AS DOUBLE) AS current_price, CAST(round(CAST(price2 AS DECIMAL(20,6)), 2) AS DOUBLE) AS bundle_price, round(before, 2) AS revenue_before, round(after, 2) AS revenue_after,
       round(after - before, 2) AS impact_abs, round(CASE WHEN before <> 0 THEN (after - before) / before * 100 END, 4) AS impact_pct,
       CAST(CASE WHEN price2 <= 0 THEN 0 WHEN after - before >= 0 THEN floor((after - before) / price2) ELSE -ceil(-(after - before) / price2) END AS BIGINT) AS bundle_units_equivalent,
       (SELECT max(n) FROM ser WHERE ser.key = sg.bundle_id) AS n_periods, {C.HORIZON} AS horizon FROM sg"""),
}


def _itemset_ctes(size: int) -> str:
    """One more item joined to the frequent sets one smaller."""
    return f"""
k{size} AS (SELECT s.receipt_no, list_append(s.items, f.item) AS items FROM k{size - 1} s JOIN fi f ON f.receipt_no = s.receipt_no AND f.item > s.items[{size - 1}]),
h{size} AS (SELECT items, count(*) AS freq FROM k{size} GROUP BY items HAVING count(*) >= ceil({Q_SUPPORT} * (SELECT n FROM nn)))"""


SQL["frequent_itemsets_fpgrowth"] = q(basket_ctes(Q_SUPPORT, runs=("ALL",)) + f""",
nn AS (SELECT count(DISTINCT receipt_no) AS n FROM items),
fi AS (SELECT * FROM items WHERE item IN (SELECT item FROM items GROUP BY item HAVING count(*) >= ceil({Q_SUPPORT} * (SELECT n FROM nn)))),
k1 AS (SELECT receipt_no, [item] AS items FROM fi), h1 AS (SELECT items, count(*) AS freq FROM k1 GROUP BY items),""" + ",".join(_itemset_ctes(s) for s in (2, 3, 4)) + """,
alls AS (SELECT * FROM h1 UNION ALL SELECT * FROM h2 UNION ALL SELECT * FROM h3 UNION ALL SELECT * FROM h4),
un AS (SELECT items, freq, unnest(items) AS item, unnest(range(1, len(items) + 1)) AS pos FROM alls),
named AS (
  SELECT un.items, any_value(freq) AS freq, string_agg(coalesce(nm.nname, un.item), ', ' ORDER BY pos) AS nms, bool_or(coalesce(c.category IN ('EXTRA', 'OTHERS'), FALSE)) AS bad
  FROM un LEFT JOIN names nm ON nm.nid = un.item LEFT JOIN cur c ON trim(c.product_id) = un.item GROUP BY un.items
)""" , """
SELECT nms AS itemsets, CAST(len(items) AS INTEGER) AS size, freq / (SELECT n FROM nn) AS support FROM named
WHERE NOT bad OR NOT EXISTS (SELECT 1 FROM named WHERE NOT bad)""")

catalog.ORACLES.update(SQL)
