"""DuckDB statements that answer the registered queries over the same tables.

They are written independently of the operators: window functions and joins on the raw views, edges
from ``quantile_cont``, lags on dense panels. ``RELATIONS`` holds the shared building blocks, each
naming the ones it reads; :func:`statement` puts the needed ones into one WITH clause.
"""

from __future__ import annotations

import re

_OHLCV = """
SELECT d AS date, asset,
       max(CASE WHEN rn = 1 THEN px END) AS open, max(px) AS high, min(px) AS low,
       max(CASE WHEN rn = n THEN px END) AS close, sum(vol) AS volume
FROM (SELECT {day} AS d, concat('S', CAST(l_suppkey AS string)) AS asset,
             l_extendedprice / l_quantity AS px,
             CASE WHEN l_returnflag = 'R' THEN 0 ELSE l_quantity END AS vol,
             row_number() OVER (PARTITION BY {day}, l_suppkey ORDER BY {order}) AS rn,
             count(*) OVER (PARTITION BY {day}, l_suppkey) AS n
      FROM lineitem) x
GROUP BY d, asset"""
_ORDER = "l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity"
_DAY = "CAST(l_shipdate AS date)"
_MONTH = "CAST(date_trunc('month', l_shipdate) AS date)"


def _factors(unit: str, date: str) -> str:
    period = f"CAST(date_trunc('{unit}', l_shipdate) AS date)"
    group = f"""(SELECT {period} AS {date}, concat('S', CAST(l_suppkey AS string)) AS asset,
       CAST(sum(CAST(l_extendedprice AS decimal(18,2))) AS double) AS revenue,
       sum(l_quantity) AS units,
       CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS double)
         / CAST(count(*) AS double) AS return_rate
       FROM lineitem GROUP BY 1, 2)"""
    return f"""
SELECT {date}, asset, 'revenue' AS factor_name, revenue AS value FROM {group} a
UNION ALL
SELECT {date}, asset, 'units', CASE WHEN units % 7 = 0 THEN NULL ELSE units END FROM {group} b
UNION ALL
SELECT {date}, asset, 'return_rate', return_rate FROM {group} c"""


def _average_rank(keys: str, value: str, descending: bool = False) -> str:
    order = f"{value} {'DESC' if descending else 'ASC'} NULLS LAST"
    return (
        f"CASE WHEN {value} IS NULL THEN 0.0::DOUBLE ELSE "
        f"CAST(rank() OVER (PARTITION BY {keys} ORDER BY {order}) AS DOUBLE) "
        f"+ (count(*) OVER (PARTITION BY {keys}, {value}) - 1) / 2.0::DOUBLE END"
    )


def _quarter(date: str) -> str:
    """The window that contains the date, by comparing it with every window boundary."""
    md = f"(month({date}) * 100 + day({date}))"
    return f"""CASE WHEN {md} BETWEEN 516 AND 814 THEN year({date}) || '-Q1'
     WHEN {md} BETWEEN 815 AND 1114 THEN year({date}) || '-Q2'
     WHEN {md} >= 1115 THEN year({date}) || '-Q3'
     WHEN {md} <= 331 THEN (year({date}) - 1) || '-Q3'
     ELSE (year({date}) - 1) || '-Q4' END"""


def _r(x: str, digits: int) -> str:
    return f"round({x}, {digits}) + 0.0::DOUBLE"


def _significant(x: str) -> str:
    """Nine significant digits, for values of any size."""
    return f"CAST(printf('%.8e', {x}) AS DOUBLE) + 0.0::DOUBLE"


def _buckets(source: str) -> str:
    """Bucket of ``value`` per (factor_name, date) among rows of ``source``."""
    return f"""
SELECT s.*, CASE WHEN NOT e.flat THEN 1 + (value > e1)::INT + (value > e2)::INT
       + (value > e3)::INT + (value > e4)::INT END AS bucket
FROM {source} s JOIN (
  SELECT factor_name, date, q[2] AS e1, q[3] AS e2, q[4] AS e3, q[5] AS e4,
         q[1] = q[2] OR q[2] = q[3] OR q[3] = q[4] OR q[4] = q[5] OR q[5] = q[6] AS flat
  FROM (SELECT factor_name, date,
               quantile_cont(value, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]) AS q
        FROM {source} WHERE value IS NOT NULL GROUP BY 1, 2) g) e
USING (factor_name, date) WHERE value IS NOT NULL"""


def _factor_chain(p: str, source: str) -> dict[str, str]:
    """Aligned, complete, bucketed rows and everything derived from them, for one factor table."""
    rows = f"""
SELECT f.factor_name, f.date, f.asset, f.value, w.t, w.fwd_1, w.fwd_5, w.fwd_10,
       w.fwd_1 IS NOT NULL AND w.fwd_5 IS NOT NULL AND w.fwd_10 IS NOT NULL AS complete
FROM {source} f LEFT JOIN fwd w USING (date, asset) WHERE f.value IS NOT NULL"""
    tall = " UNION ALL ".join(
        f"SELECT factor_name, date, t, asset, value, bucket, {k} AS period, fwd_{k} AS r FROM {p}clean"
        for k in (1, 5, 10)
    )
    return {
        f"{p}joined": rows,
        f"{p}usable": f"SELECT * FROM {p}joined WHERE complete",
        f"{p}bucketed": _buckets(f"{p}usable"),
        f"{p}clean": f"SELECT * FROM {p}bucketed WHERE bucket IS NOT NULL",
        f"{p}tall": tall,
        f"{p}demeaned": f"SELECT *, r - avg(r) OVER (PARTITION BY factor_name, date, period) AS d FROM {p}tall",
        f"{p}weighted": f"SELECT *, value - avg(value) OVER (PARTITION BY factor_name, date, period) AS w FROM {p}tall",
        f"{p}factor_return": f"""
SELECT factor_name, date, period,
       CASE WHEN sum(abs(w)) > 0 THEN sum(w * r) / sum(abs(w)) END AS factor_return,
       avg(r) AS universe_return FROM {p}weighted GROUP BY 1, 2, 3""",
        f"{p}both_ranks": f"""
SELECT factor_name, date, period, {_average_rank("factor_name, date, period", "value")} AS rv,
       {_average_rank("factor_name, date, period", "r")} AS rr FROM {p}tall""",
        f"{p}ic": f"""
SELECT factor_name, date, period, corr(rv, rr) AS ic FROM {p}both_ranks GROUP BY 1, 2, 3""",
        f"{p}ic_stats": f"""
SELECT factor_name, period, count(ic) AS n, avg(ic) AS m, stddev_samp(ic) AS s,
       stddev_pop(ic) AS sp, kurtosis_pop(ic) AS k FROM {p}ic GROUP BY 1, 2""",
        f"{p}spread": f"""
SELECT factor_name, date, period, top - bottom AS spread,
       sqrt(top_e * top_e + bottom_e * bottom_e) AS std_error FROM (
  SELECT factor_name, date, period,
         avg(CASE WHEN bucket = 5 THEN r END) AS top, avg(CASE WHEN bucket = 1 THEN r END) AS bottom,
         stddev_samp(CASE WHEN bucket = 5 THEN r END) / sqrt(count(CASE WHEN bucket = 5 THEN r END)) AS top_e,
         stddev_samp(CASE WHEN bucket = 1 THEN r END) / sqrt(count(CASE WHEN bucket = 1 THEN r END)) AS bottom_e
  FROM {p}tall GROUP BY 1, 2, 3) g WHERE top IS NOT NULL AND bottom IS NOT NULL""",
        f"{p}headline": f"""
SELECT i.factor_name, i.period, {_r("i.m", 6)} AS ic_mean, {_r("i.s", 6)} AS ic_std,
       {_r("s.m", 6)} AS mean_spread, {_r("a.alpha", 6)} AS alpha, {_r("a.beta", 6)} AS beta
FROM {p}ic_stats i
LEFT JOIN (SELECT factor_name, period, avg(spread) AS m FROM {p}spread GROUP BY 1, 2) s USING (factor_name, period)
LEFT JOIN (SELECT factor_name, period, regr_intercept(factor_return, universe_return) AS alpha,
                  regr_slope(factor_return, universe_return) AS beta
           FROM {p}factor_return GROUP BY 1, 2) a USING (factor_name, period)""",
    }


_FACTORS = ("revenue", "units", "return_rate")
_EACH = "(20000000.0 * 0.9 / 40)"

RELATIONS: dict[str, str] = {
    "daily": _OHLCV.format(day=_DAY, order=_ORDER),
    "monthly": _OHLCV.format(day=_MONTH, order=f"l_shipdate, {_ORDER}"),
    "report": _factors("quarter", "report_date"),
    "month_factors": _factors("month", "date"),
    "company": """
SELECT concat('S', CAST(s_suppkey AS string)) AS stock_id, s_name AS company_name,
       DATE '1994-06-01' + CAST(s_suppkey * 7 AS int) AS list_date,
       CASE WHEN s_suppkey % 11 = 0 THEN NULL ELSE n_name END AS industry,
       CASE WHEN s_suppkey % 5 = 0 THEN 'otc' ELSE 'sii' END AS market
FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "mv": f"""
SELECT {_MONTH} AS date, concat('S', CAST(l_suppkey AS string)) AS stock_id,
       CAST(sum(CAST(l_extendedprice AS decimal(18,2))) AS double) AS market_value
FROM lineitem GROUP BY 1, 2""",
    "index_daily": """
SELECT CAST(ts AS date) AS date, concat('^', event_type) AS index_id, max(value) AS close
FROM events GROUP BY 1, 2""",
    "sales": """
SELECT CAST(l_shipdate AS date) AS date, concat('S', CAST(l_suppkey AS string)) AS stock_id,
       l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice AS price FROM lineitem""",
    "prev": """
SELECT *, lag(close) OVER (PARTITION BY asset ORDER BY date) AS pc,
       volume = 0 AND open = close AND high = low AS still FROM daily""",
    "fact_price": """
SELECT date, asset AS stock_id, open, high, low, close, volume,
       CAST(close / pc - 1 AS FLOAT) AS daily_return,
       CASE WHEN still AND close = pc THEN 1 ELSE 0 END AS is_suspended,
       CASE WHEN still AND close > pc THEN 1 ELSE 0 END AS is_limit_up,
       CASE WHEN still AND close < pc THEN 1 ELSE 0 END AS is_limit_down
FROM prev""",
    "gappy": """
SELECT date, asset, open, high, low, CASE WHEN volume > 0 THEN close END AS close,
       CASE WHEN volume > 0 THEN volume END AS volume FROM daily""",
    "days": "SELECT DISTINCT date FROM daily",
    "weekdays": "SELECT date FROM days WHERE dayofweek(date) NOT IN (0, 6)",
    "asof_daily": """
SELECT g.date, g.asset, g.factor_name, r.value
FROM (SELECT date, asset, s.factor_name FROM (
        SELECT DISTINCT factor_name, asset FROM report) s
      JOIN (SELECT f.factor_name, w.date FROM weekdays w, (SELECT DISTINCT factor_name FROM report) f
            UNION
            SELECT factor_name, report_date FROM report
            WHERE report_date BETWEEN (SELECT min(date) FROM weekdays) AND (SELECT max(date) FROM weekdays)) c
      USING (factor_name)) g
ASOF LEFT JOIN (SELECT * FROM report WHERE value IS NOT NULL) r
ON g.asset = r.asset AND g.factor_name = r.factor_name AND g.date >= r.report_date""",
    "asof_strict": """
SELECT g.date, g.asset, g.factor_name, r.value
FROM (SELECT w.date, s.asset, s.factor_name
      FROM weekdays w, (SELECT DISTINCT factor_name, asset FROM report) s) g
ASOF LEFT JOIN (SELECT * FROM report WHERE value IS NOT NULL) r
ON g.asset = r.asset AND g.factor_name = r.factor_name AND g.date >= r.report_date""",
    "universe": """
SELECT m.stock_id, company_name, strftime(list_date, '%Y-%m-%d') AS list_date, industry, market,
       market_value, strftime(m.date, '%Y-%m-%d') AS market_value_date,
       CAST(row_number() OVER (ORDER BY market_value DESC NULLS LAST, m.stock_id) AS INT) AS rank,
       20 AS top_n, CAST(NULL AS VARCHAR) AS delist_date
FROM mv m JOIN company c USING (stock_id)
WHERE m.date = (SELECT max(date) FROM mv WHERE date <= DATE '1998-03-10')
  AND (industry IS NULL OR industry NOT IN ('NATION_3', 'NATION_7'))
  AND market = 'sii' AND list_date < DATE '1995-10-01'
QUALIFY rank <= 20""",
    "targets": """
SELECT unnest([DATE '1996-03-10', DATE '1997-07-01', DATE '1999-12-31', DATE '2001-05-15']) AS target""",
    "star_members": """
SELECT m.stock_id, company_name, strftime(list_date, '%Y-%m-%d') AS list_date, industry, market,
       market_value, strftime(d, '%Y-%m-%d') AS market_value_date,
       CAST(row_number() OVER (PARTITION BY target ORDER BY market_value DESC NULLS LAST, m.stock_id) AS INT) AS rank,
       20 AS top_n, CAST(NULL AS VARCHAR) AS delist_date, '1995-01-01' AS run_start, '2001-12-31' AS run_end,
       strftime(target, '%Y-%m-%d') AS mv_date
FROM (SELECT target, (SELECT max(date) FROM mv WHERE date <= target) AS d
      FROM (SELECT unnest([DATE '1996-03-10', DATE '1998-03-10']) AS target) t) t
JOIN mv m ON m.date = t.d JOIN company USING (stock_id)
WHERE (industry IS NULL OR industry NOT IN ('NATION_3', 'NATION_7'))
  AND market = 'sii' AND list_date < DATE '1995-10-01'
QUALIFY rank <= 20""",
    "star_days": "SELECT DISTINCT date FROM daily WHERE asset IN (SELECT stock_id FROM star_members)",
    "measures": """
SELECT CAST(date_trunc('year', l_shipdate) AS date) AS date, concat('S', CAST(l_suppkey AS string)) AS asset,
       CAST(sum(CAST(l_extendedprice AS decimal(18,4))) AS double) AS f1,
       CASE WHEN sum(l_quantity) % 7 <> 0 THEN sum(l_quantity) END AS f2,
       CAST(count(*) FILTER (l_returnflag = 'R') AS double) / count(*) AS f3,
       CAST(count(*) AS double) AS f4,
       CAST(sum(CAST(l_extendedprice AS decimal(18,4))) AS double) / count(*) AS f5,
       CAST(sum(CAST(l_discount AS decimal(18,4))) AS double) / count(*) AS f6,
       CAST(sum(CAST(l_tax AS decimal(18,4))) AS double) / count(*) AS f7,
       max(l_extendedprice) AS f8, min(l_extendedprice) AS f9,
       CAST(sum(CAST(l_extendedprice * (1 - l_discount) AS decimal(18,4))) AS double) AS f10,
       CAST(count(*) FILTER (l_linestatus = 'O') AS double) / count(*) AS f11,
       CAST(max(l_partkey) - min(l_partkey) AS double) AS f12
FROM lineitem GROUP BY 1, 2""",
    "measure_names": """
SELECT * FROM (VALUES (1, 'revenue'), (2, 'units'), (3, 'return_rate'), (4, 'lines'), (5, 'mean_price'),
  (6, 'mean_discount'), (7, 'mean_tax'), (8, 'largest_line'), (9, 'smallest_line'), (10, 'net_revenue'),
  (11, 'open_share'), (12, 'part_spread')) t(i, factor_name)""",
    "measure_ranks": f"""
SELECT date, asset, i, {_average_rank("i, date", "value")} AS rank FROM (
  SELECT date, asset, i, [f1, f2, f3, f4, f5, f6, f7, f8, f9, f10, f11, f12][i] AS value
  FROM measures CROSS JOIN measure_names) m""",
    "measure_combos": """
SELECT row_number() OVER (ORDER BY a.i, b.i, c.i, d.i, e.i) - 1 AS combo_id,
       concat_ws('_', a.factor_name, b.factor_name, c.factor_name, d.factor_name, e.factor_name) AS combo,
       a.i AS a, b.i AS b, c.i AS c, d.i AS d, e.i AS e
FROM measure_names a JOIN measure_names b ON a.i < b.i JOIN measure_names c ON b.i < c.i
JOIN measure_names d ON c.i < d.i JOIN measure_names e ON d.i < e.i""",
    "report_ranks": f"""
SELECT report_date AS date, asset, factor_name, value,
       {_average_rank("factor_name, report_date", "value")} AS rank FROM report""",
    "cal": "SELECT date, row_number() OVER (ORDER BY date) AS t FROM (SELECT DISTINCT date FROM monthly)",
    "px": "SELECT date, asset, close, open, t FROM monthly JOIN cal USING (date)",
    "fwd": """
SELECT a.date, a.asset, a.t, b.close / a.close - 1 AS fwd_1, c.close / a.close - 1 AS fwd_5,
       d.close / a.close - 1 AS fwd_10
FROM px a LEFT JOIN px b ON b.asset = a.asset AND b.t = a.t + 1
LEFT JOIN px c ON c.asset = a.asset AND c.t = a.t + 5
LEFT JOIN px d ON d.asset = a.asset AND d.t = a.t + 10""",
    **_factor_chain("f_", "month_factors"),
    "month_ranks": f"""
SELECT date, asset, factor_name, {_average_rank("factor_name, date", "value")} AS rank
FROM month_factors""",
    "combos": """
SELECT * FROM (VALUES ('revenue_units', 'revenue', 'units'),
  ('revenue_return_rate', 'revenue', 'return_rate'),
  ('units_return_rate', 'units', 'return_rate')) t(combo, a, b)""",
    "combo_values": f"""
SELECT factor_name, date, asset, {_average_rank("factor_name, date", "w")} AS value FROM (
  SELECT combo AS factor_name, x.date, x.asset, x.rank * 0.75 + y.rank * 0.25 AS w
  FROM combos JOIN month_ranks x ON x.factor_name = a
  JOIN month_ranks y ON y.factor_name = b AND y.date = x.date AND y.asset = x.asset) s""",
    **_factor_chain("c_", "combo_values"),
    "complete_months": """
SELECT * FROM (SELECT date, asset, max(value) FILTER (factor_name = 'revenue') AS revenue,
  max(value) FILTER (factor_name = 'units') AS units,
  max(value) FILTER (factor_name = 'return_rate') AS return_rate FROM month_factors GROUP BY 1, 2) w
WHERE revenue IS NOT NULL AND units IS NOT NULL AND return_rate IS NOT NULL""",
    # eigenvectors of the 3 x 3 correlation matrix: trigonometric eigenvalues, cross product of rows
    "corr3": """
SELECT corr(revenue, units) AS a, corr(revenue, return_rate) AS b, corr(units, return_rate) AS c
FROM complete_months""",
    "eigen3": """
SELECT a, b, c, 1 + 2 * p * cos(phi) AS l1, 1 + 2 * p * cos(phi + 2 * pi() / 3) AS l3
FROM (SELECT *, acos(greatest(-1, least(1, a * b * c / pow(p, 3)))) / 3 AS phi
      FROM (SELECT *, sqrt((a * a + b * b + c * c) / 3) AS p FROM corr3) x) y""",
    "vector3": """
SELECT k, x * s / len AS x, y * s / len AS y, w * s / len AS w FROM (
  SELECT *, sqrt(x * x + y * y + w * w) AS len,
         CASE WHEN abs(x) >= abs(y) AND abs(x) >= abs(w) THEN sign(x)
              WHEN abs(y) >= abs(w) THEN sign(y) ELSE sign(w) END AS s
  FROM (SELECT k, a * c - b * (1 - l) AS x, a * b - c * (1 - l) AS y, (1 - l) * (1 - l) - a * a AS w
        FROM (SELECT 1 AS k, a, b, c, l1 AS l FROM eigen3
              UNION ALL SELECT 2, a, b, c, 3 - l1 - l3 FROM eigen3) e) v) n""",
    "pc_scores": """
SELECT date, asset, k, x * (revenue - avg(revenue) OVER (PARTITION BY k)) / stddev_pop(revenue) OVER (PARTITION BY k)
  + y * (units - avg(units) OVER (PARTITION BY k)) / stddev_pop(units) OVER (PARTITION BY k)
  + w * (return_rate - avg(return_rate) OVER (PARTITION BY k)) / stddev_pop(return_rate) OVER (PARTITION BY k) AS value
FROM complete_months CROSS JOIN vector3""",
    "pc_values": """
SELECT date, asset, 'revenue_units_return_rate_PC' || k AS factor_name, value FROM pc_scores""",
    **_factor_chain("p_", "pc_values"),
    "z": """
SELECT date, asset, (revenue - avg(revenue) OVER ()) / stddev_pop(revenue) OVER () AS z1,
       (return_rate - avg(return_rate) OVER ()) / stddev_pop(return_rate) OVER () AS z2,
       sign(corr(revenue, return_rate) OVER ()) AS s
FROM (SELECT date, asset, max(value) FILTER (factor_name = 'revenue') AS revenue,
             max(value) FILTER (factor_name = 'return_rate') AS return_rate
      FROM month_factors GROUP BY 1, 2) w
WHERE revenue IS NOT NULL AND return_rate IS NOT NULL""",
    # portfolio
    "filled": """
SELECT date, asset, factor_name,
       last_value(value IGNORE NULLS) OVER (PARTITION BY factor_name, asset ORDER BY date) AS value
FROM month_factors""",
    "filled_ranks": f"""
SELECT date, asset, factor_name, {_quarter("date")} AS quarter,
       {_average_rank("factor_name, date", "value")} AS rank FROM filled WHERE value IS NOT NULL""",
    "plan": """
SELECT quarter, factor_name, weight FROM (SELECT DISTINCT quarter FROM filled_ranks) q,
  (VALUES ('revenue', 0.5::DOUBLE), ('units', 0.5::DOUBLE)) d(factor_name, weight)
WHERE quarter NOT IN ('1996-Q2', '1997-Q1')
UNION ALL SELECT * FROM (VALUES ('1996-Q2', 'return_rate', 0.25::DOUBLE),
  ('1996-Q2', 'revenue', 0.75::DOUBLE), ('1997-Q1', 'return_rate', 1.0::DOUBLE)) o""",
    "scheduled": f"""
SELECT date, asset, {_average_rank("date", "w")} AS rank FROM (
  SELECT r.date, r.asset, sum(rank * weight) AS w
  FROM filled_ranks r JOIN plan p USING (quarter, factor_name)
  GROUP BY r.quarter, r.date, r.asset
  HAVING count(*) = (SELECT count(*) FROM plan n WHERE n.quarter = r.quarter)) s""",
    "grid": """
SELECT c.date, c.t, a.asset, m.open, m.high, m.low, m.close, m.volume, s.rank
FROM cal c CROSS JOIN (SELECT DISTINCT asset FROM monthly) a
LEFT JOIN monthly m ON m.date = c.date AND m.asset = a.asset
LEFT JOIN scheduled s ON s.date = c.date AND s.asset = a.asset""",
    "panel": """
SELECT * FROM (SELECT date, t, asset,
  last_value(open IGNORE NULLS) OVER w AS open, last_value(high IGNORE NULLS) OVER w AS high,
  last_value(low IGNORE NULLS) OVER w AS low, last_value(close IGNORE NULLS) OVER w AS close,
  last_value(volume IGNORE NULLS) OVER w AS volume, last_value(rank IGNORE NULLS) OVER w AS rank
  FROM grid WINDOW w AS (PARTITION BY asset ORDER BY t)) f
WHERE open IS NOT NULL AND close IS NOT NULL""",
    "places": """
SELECT *, row_number() OVER (PARTITION BY date ORDER BY rank DESC, asset DESC) AS high_place,
       row_number() OVER (PARTITION BY date ORDER BY rank ASC, asset ASC) AS low_place
FROM panel WHERE rank IS NOT NULL""",
    "membership": """
SELECT p.date, p.t, p.asset, p.open, p.close, side,
       coalesce(CASE WHEN side = 'long' THEN high_place <= 20 ELSE low_place <= 20 END, FALSE) AS held
FROM panel p CROSS JOIN (VALUES ('long'), ('short')) s(side)
LEFT JOIN places q ON q.t = p.t AND q.asset = p.asset""",
    "moves": f"""
SELECT *, held AND NOT was AS enter, was AND NOT held AS leave FROM (
  SELECT *, coalesce(lag(held) OVER (PARTITION BY asset, side ORDER BY t), FALSE) AS was
  FROM membership) x""",
    "sized": f"""
SELECT *, last_value(CASE WHEN enter THEN CAST(trunc({_EACH} / close) AS BIGINT) END IGNORE NULLS)
  OVER (PARTITION BY asset, side ORDER BY t) AS size FROM moves""",
    "ledger": """
SELECT n.date, o.asset, o.side, CASE WHEN o.enter THEN 'enter' ELSE 'exit' END AS action,
       CASE WHEN o.side = 'long' THEN 1 ELSE -1 END * CASE WHEN o.enter THEN 1 ELSE -1 END * o.size AS quantity,
       n.open AS price
FROM sized o JOIN panel n ON n.asset = o.asset AND n.t = o.t + 1 WHERE o.enter OR o.leave""",
    "positions": """
SELECT n.date, sum(CASE WHEN side = 'long' THEN 1 ELSE -1 END * size * n.close) AS worth
FROM sized o JOIN panel n ON n.asset = o.asset AND n.t = o.t + 1 WHERE held GROUP BY 1""",
    "curve": """
SELECT date, cash, worth, round(cash + worth, 2) AS equity FROM (
  SELECT c.date, round(20000000.0::DOUBLE + sum(coalesce(f.flow, 0)) OVER (ORDER BY c.date), 2) AS cash,
         round(coalesce(p.worth, 0), 2) AS worth
  FROM cal c
  LEFT JOIN (SELECT date, sum(-quantity * price - 0.001 * abs(quantity) * price) AS flow
             FROM ledger GROUP BY 1) f USING (date)
  LEFT JOIN positions p USING (date)) x""",
    "portfolio_returns": """
SELECT date, cash, worth, equity,
       equity / coalesce(lag(equity) OVER (ORDER BY date), 20000000.0) - 1 AS r FROM curve""",
    "market_returns": """
SELECT date, close / lag(close) OVER (ORDER BY date) - 1 AS r FROM (
  SELECT CAST(l_shipdate AS date) AS date,
         CAST(sum(CAST(l_extendedprice AS decimal(18,2))) AS double) AS close
  FROM lineitem GROUP BY 1) s""",
}


def _wealth(source: str) -> str:
    return f"""(SELECT date, r, wealth,
       round(wealth / greatest(1.0, max(wealth) OVER (ORDER BY date)) - 1, 12) AS drawdown
FROM (SELECT date, r, product(1 + r) OVER (ORDER BY date) AS wealth
      FROM {source} WHERE r IS NOT NULL) g)"""


def _performance(source: str, year: int, digits: int) -> str:
    level = f"""(SELECT regr_r2(lvl, day) AS v FROM (
  SELECT CAST(row_number() OVER (ORDER BY date) AS DOUBLE) AS day, sum(ln(CASE WHEN r > -1 THEN 1 + r END)) OVER (ORDER BY date) AS lvl
  FROM {source} WHERE r IS NOT NULL) q)"""
    r = lambda x: _r(x, digits)
    annual = f"CASE WHEN g > 0 THEN pow(CASE WHEN g > 0 THEN g END, {year}.0 / n) - 1 END"
    return f"""
SELECT n AS n_days, {r("g - 1")} AS total_return, {r(annual)} AS annual_return,
       {r(f"s * sqrt({year}.0)")} AS annual_volatility, {r(f"m / nullif(s, 0) * sqrt({year}.0)")} AS sharpe,
       {r(f"m / nullif(down, 0) * sqrt({year}.0)")} AS sortino, {r("dd")} AS max_drawdown,
       {r(f"({annual}) / nullif(abs(dd), 0)")} AS calmar, {r("gain / nullif(loss, 0)")} AS omega,
       {r("abs(p95) / nullif(abs(p05), 0)")} AS tail_ratio, {r("skew")} AS skew, {r("kurt")} AS kurtosis,
       {r("p05")} AS var_5pct, {r("m - 2 * s")} AS value_at_risk, CASE WHEN lowest > -1 THEN {r(level)} END AS stability
FROM (
  SELECT count(*) AS n, min(r) AS lowest, product(1 + r) AS g, avg(r) AS m, stddev_samp(r) AS s,
         sqrt(avg(least(r, 0) * least(r, 0))) AS down, min(drawdown) AS dd,
         sum(greatest(r, 0)) AS gain, sum(greatest(-r, 0)) AS loss,
         quantile_cont(r, 0.95) AS p95, quantile_cont(r, 0.05) AS p05,
         (SELECT avg(pow(r - mu, 3)) / pow(stddev_pop(r), 3) FROM
            (SELECT r, avg(r) OVER () AS mu FROM {source} WHERE r IS NOT NULL) c) AS skew,
         kurtosis_pop(r) AS kurt
  FROM {_wealth(source)} w) x"""


def _periodic(source: str, unit: str, digits: int) -> str:
    return f"""
SELECT CAST(date_trunc('{unit}', date) AS date) AS period_start,
       {_r("product(1 + coalesce(r, 0)) - 1", digits)} AS period_return FROM {source} GROUP BY 1"""


def _drawdowns(source: str) -> str:
    return f"""
SELECT CAST(row_number() OVER (ORDER BY depth, peak_date) AS INT) AS place, peak_date, valley_date,
       recovery_date, {_r("depth", 6)} AS depth, bars_under_water FROM (
  SELECT episode, min(date) AS peak_date, min(drawdown) AS depth,
         arg_min(date, (drawdown, date)) AS valley_date,
         count(*) FILTER (drawdown < 0) AS bars_under_water,
         lead(min(date)) OVER (ORDER BY episode) AS recovery_date
  FROM (SELECT *, count(*) FILTER (drawdown >= 0) OVER (ORDER BY date) AS episode
        FROM {_wealth(source)} w) e
  GROUP BY episode) x
WHERE depth < 0 QUALIFY place <= 5"""


_QUANTILE_RETURNS = """
SELECT factor_name, CAST(period AS INT) AS period, bucket, count(*) AS n,
       {mean} AS mean_return, {error} AS std_error FROM {source} GROUP BY 1, 2, 3"""

QUERIES: dict[str, str] = {
    "price_scan": "SELECT * FROM fact_price WHERE date BETWEEN DATE '1997-01-01' AND DATE '1998-12-31'",
    "factor_scan": """
SELECT report_date AS date, asset AS stock_id, value AS units FROM report
WHERE factor_name = 'units' AND report_date BETWEEN DATE '1997-01-01' AND DATE '1999-12-31'""",
    "factor_scan_wide": """
SELECT report_date AS date, asset AS stock_id, value AS return_rate FROM report
WHERE factor_name = 'return_rate' AND report_date BETWEEN DATE '1997-01-01' AND DATE '1999-12-31'""",
    "factor_sources": """
SELECT report_date AS date, asset, factor_name, CASE WHEN factor_name = 'return_rate' THEN value * 10 ELSE value END AS value
FROM report WHERE report_date BETWEEN DATE '1997-01-01' AND DATE '1999-12-31'""",
    "factor_sources_report": """
SELECT CAST(position AS INT) AS position, n.factor_name, source, count(r.asset) AS n_rows,
       CASE WHEN count(r.asset) > 0 THEN 'found' ELSE 'missing' END AS status
FROM (VALUES (0, 'revenue', 'local'), (1, 'unknown', NULL), (2, 'units', 'local'), (3, 'return_rate', 'warehouse'))
  n(position, factor_name, source)
LEFT JOIN (SELECT * FROM report WHERE report_date BETWEEN DATE '1997-01-01' AND DATE '1999-12-31') r
  ON r.factor_name = n.factor_name GROUP BY 1, 2, 3""",
    "snapshot_scan": """
SELECT date, stock_id, open * 2 AS open, high * 2 AS high, low * 2 AS low, close * 2 AS close, volume,
       daily_return, is_suspended, is_limit_up, is_limit_down
FROM fact_price WHERE year(date) = 1997""",
    "tagged_runs": """
SELECT strftime(report_date, '%Y-%m-%d') AS date, asset AS stock_id, factor_name, value, '1995-01-01' AS run_start,
       '2001-12-31' AS run_end, '1998-03-10' AS mv_date, CAST(top_n AS INT) AS top_n, factor_set
FROM report CROSS JOIN (VALUES ('value', 20), ('growth', 30)) s(factor_set, top_n)
WHERE factor_name = 'units'""",
    "export_upsert": """
SELECT stock_id, company_name, list_date, industry, market,
       '["' || market || '",' || CASE WHEN industry IS NULL THEN 'null' ELSE '"' || industry || '"' END || ']' AS tags,
       '' AS note
FROM company""",
    "upsert_stored": """
SELECT date, stock_id, open, high, low, CASE WHEN date >= DATE '1998-06-01' THEN close * 2 ELSE close END AS close,
       volume, daily_return, is_suspended, is_limit_up, is_limit_down
FROM fact_price WHERE year(date) < 2000""",
    "star_universe": "SELECT * FROM star_members",
    "star_prices": "SELECT * FROM fact_price WHERE stock_id IN (SELECT stock_id FROM star_members)",
    "star_benchmark": """
SELECT date, ltrim(index_id, '^') AS index_id, close,
       close / lag(close) OVER (PARTITION BY index_id ORDER BY date) - 1 AS daily_return
FROM index_daily WHERE date BETWEEN DATE '1995-01-01' AND DATE '2001-12-31'""",
    "star_factors": """
SELECT g.date, g.asset AS stock_id, g.factor_name, r.value, 'default' AS factor_set
FROM (SELECT date, asset, s.factor_name
      FROM (SELECT DISTINCT factor_name, asset FROM report WHERE factor_name IN ('revenue', 'units')
            AND asset IN (SELECT stock_id FROM star_members)) s
      JOIN (SELECT factor_name, date FROM star_days, (VALUES ('revenue'), ('units')) n(factor_name)
            UNION SELECT factor_name, report_date FROM report
            WHERE asset IN (SELECT stock_id FROM star_members)
              AND report_date BETWEEN (SELECT min(date) FROM star_days) AND (SELECT max(date) FROM star_days)) c
      USING (factor_name)) g
ASOF LEFT JOIN (SELECT * FROM report WHERE value IS NOT NULL) r
ON g.asset = r.asset AND g.factor_name = r.factor_name AND g.date >= r.report_date""",
    "no_factors": """
SELECT report_date AS date, asset AS stock_id, factor_name, value FROM report WHERE factor_name = 'unknown'""",
    "factor_wide_to_long": "SELECT * FROM report",
    "factor_triple": """
SELECT report_date AS date, asset, value FROM report
WHERE factor_name = 'units' AND value IS NOT NULL""",
    "vendor_assemble": """
SELECT CAST(ts AS date) AS datetime, event_type AS asset, CAST(NULL AS DOUBLE) AS open,
       max(value) AS high, min(value) AS low, CAST(NULL AS DOUBLE) AS close,
       CAST(count(value) AS DOUBLE) AS volume FROM events GROUP BY 1, 2""",
    "ingest_fill": """
SELECT date AS datetime, asset, open, high, low,
       last_value(close IGNORE NULLS) OVER w AS close, last_value(volume IGNORE NULLS) OVER w AS volume
FROM gappy WINDOW w AS (PARTITION BY asset ORDER BY date)""",
    "fill_both_ways": """
SELECT date, asset, coalesce(last_value(close IGNORE NULLS) OVER (PARTITION BY asset ORDER BY date),
  first_value(close IGNORE NULLS) OVER (PARTITION BY asset ORDER BY date
    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS close FROM gappy""",
    "clean_ohlcv": "SELECT * FROM fact_price",
    "daily_return": "SELECT date, stock_id, daily_return FROM fact_price",
    "tradability_flags": "SELECT date, stock_id, is_suspended, is_limit_up, is_limit_down FROM fact_price",
    "benchmark_return": """
SELECT date, ltrim(index_id, '^') AS index_id, close,
       close / lag(close) OVER (PARTITION BY index_id ORDER BY date) - 1 AS daily_return FROM index_daily""",
    "dedupe_prices": """
SELECT * FROM sales QUALIFY row_number() OVER (PARTITION BY date, stock_id
  ORDER BY l_orderkey, l_linenumber, l_partkey, price, l_quantity) = 1""",
    "duplicate_keys": """
SELECT count(*) - count(DISTINCT (date, stock_id)) AS duplicate_rows FROM sales""",
    "upsert_prices": """
SELECT date, asset, open, high, low, CASE WHEN date >= DATE '1998-06-01' THEN close * 2 ELSE close END AS close,
       volume FROM daily""",
    "panel_summary": "SELECT count(*) AS n_rows, count(DISTINCT asset) AS n_assets FROM daily",
    "export_scalars": """
SELECT stock_id, company_name, strftime(list_date, '%Y-%m-%d') AS list_date,
       coalesce(industry, '') AS industry, market,
       '["' || market || '",' || CASE WHEN industry IS NULL THEN 'null' ELSE '"' || industry || '"' END || ']' AS tags
FROM company""",
    "symbol_normalize": """
SELECT stock_id, stock_id || '.TW' AS ticker, stock_id || '.TW' AS ticker_again, stock_id AS root,
       company_name AS index_name, stock_id AS factor, stock_id || '_a_b_c' AS label,
       strftime(list_date, '%Y%m%d') AS list_tag, 2 AS n_items FROM company""",
    "share_sizes": f"SELECT date, asset, CAST(trunc((20000000.0 * 0.9 / 40) / close) AS BIGINT) AS shares FROM monthly",
    "trading_calendar": """
SELECT date, CAST(row_number() OVER (ORDER BY date) AS INT) AS t, 1 AS is_trading_day FROM days""",
    "calendar_range": "SELECT min(date) AS first_date, max(date) AS last_date FROM daily",
    "asset_list": "SELECT DISTINCT asset FROM daily",
    "universe_topn": "SELECT * FROM universe",
    "universe_rolling": """
SELECT target AS target_date, stock_id, company_name, strftime(list_date, '%Y-%m-%d') AS list_date,
       industry, market, market_value, strftime(d, '%Y-%m-%d') AS market_value_date,
       CAST(row_number() OVER (PARTITION BY target ORDER BY market_value DESC NULLS LAST, stock_id) AS INT) AS rank,
       10 AS top_n, CAST(NULL AS VARCHAR) AS delist_date
FROM (SELECT target, (SELECT max(date) FROM mv WHERE date <= target) AS d FROM targets) t
JOIN mv ON mv.date = t.d JOIN company USING (stock_id)
WHERE industry IS NULL OR industry <> 'NATION_3' QUALIFY rank <= 10""",
    "asof_dates": """
SELECT target, (SELECT max(date) FROM mv WHERE date <= target) AS as_of FROM targets
UNION ALL SELECT max(date), max(date) FROM mv""",
    "listed_members": """
SELECT date, asset AS stock_id, open, high, low, close, volume FROM monthly
WHERE asset IN (SELECT stock_id FROM company WHERE (industry IS NULL OR industry <> 'NATION_3')
  AND market = 'sii' AND list_date < DATE '1995-10-01')""",
    "quarter_of_date": f"SELECT date, {_quarter('date')} AS quarter FROM days",
    "quarter_windows": f"""
SELECT quarter, n_days,
  CASE right(quarter, 2) WHEN 'Q1' THEN make_date(y, 5, 16) WHEN 'Q2' THEN make_date(y, 8, 15)
       WHEN 'Q3' THEN make_date(y, 11, 15) ELSE make_date(y + 1, 4, 1) END AS window_start,
  CASE right(quarter, 2) WHEN 'Q1' THEN make_date(y, 8, 14) WHEN 'Q2' THEN make_date(y, 11, 14)
       WHEN 'Q3' THEN make_date(y + 1, 3, 31) ELSE make_date(y + 1, 5, 15) END AS window_end
FROM (SELECT {_quarter('date')} AS quarter, CAST(left({_quarter('date')}, 4) AS BIGINT) AS y, count(*) AS n_days
      FROM days GROUP BY 1, 2) q""",
    "quarters_in_range": f"""
SELECT DISTINCT asset, year, {_quarter('d')} AS quarter FROM (
  SELECT asset, year, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS date) AS d FROM (
    SELECT asset, CAST(year(date) AS INT) AS year, min(date) AS lo, max(date) AS hi FROM daily GROUP BY 1, 2) s) x""",
    "factor_asof_daily": "SELECT * FROM asof_daily",
    "factor_asof_strict": "SELECT * FROM asof_strict",
    "factor_daily": """
SELECT g.date, g.asset AS stock_id, g.factor_name, r.value
FROM (SELECT date, asset, s.factor_name
      FROM (SELECT DISTINCT factor_name, asset FROM report WHERE factor_name IN ('revenue', 'units')
            AND asset IN (SELECT stock_id FROM universe)) s
      JOIN (SELECT date FROM weekdays WHERE date BETWEEN DATE '1997-01-01' AND DATE '1999-12-31'
            UNION SELECT report_date FROM report WHERE report_date BETWEEN
              (SELECT min(date) FROM weekdays WHERE date >= DATE '1997-01-01')
              AND (SELECT max(date) FROM weekdays WHERE date <= DATE '1999-12-31')) c ON TRUE) g
ASOF LEFT JOIN (SELECT * FROM report WHERE value IS NOT NULL) r
ON g.asset = r.asset AND g.factor_name = r.factor_name AND g.date >= r.report_date""",
    "factor_matrix": """
SELECT * FROM (SELECT report_date AS date, asset, avg(value) FILTER (factor_name = 'revenue') AS revenue,
  avg(value) FILTER (factor_name = 'units') AS units,
  avg(value) FILTER (factor_name = 'return_rate') AS return_rate FROM report GROUP BY 1, 2) w
WHERE revenue IS NOT NULL AND units IS NOT NULL AND return_rate IS NOT NULL""",
    "price_matrix": """
SELECT date, max(close) FILTER (index_id = '^click') AS click, max(close) FILTER (index_id = '^error') AS error,
  max(close) FILTER (index_id = '^purchase') AS purchase, max(close) FILTER (index_id = '^signup') AS signup,
  max(close) FILTER (index_id = '^view') AS "view" FROM index_daily GROUP BY 1""",
    "factor_catalog": "SELECT factor_name, count(*) AS n_rows FROM report GROUP BY 1",
    "factor_counts": """
SELECT CAST(position AS INT) AS position, n.factor_name, count(value) AS n_values
FROM (VALUES (0, 'revenue'), (1, 'units'), (2, 'return_rate'), (3, 'unknown')) n(position, factor_name)
LEFT JOIN report r ON r.factor_name = n.factor_name GROUP BY 1, 2""",
    "rank_positive": f"SELECT date, asset, close, {_average_rank('date', 'close')} AS rank FROM monthly",
    "rank_negative": f"SELECT date, asset, volume, {_average_rank('date', 'volume', True)} AS rank FROM monthly",
    "rank_missing_zero": "SELECT date, asset, factor_name, value, rank FROM report_ranks",
    "rank_hot_date": f"""
SELECT l_orderkey, l_linenumber, l_partkey, date, {_average_rank('date', 'v')} AS rank FROM (
  SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_quantity <> 50 THEN l_discount END AS v,
         CASE WHEN l_orderkey % 3 = 0 THEN DATE '1995-01-01'
              WHEN l_linenumber <> 4 THEN CAST(date_trunc('year', l_shipdate) AS DATE) END AS date
  FROM lineitem) s""",
    "weighted_rank": f"""
SELECT date, asset, {_average_rank('date', 'w')} AS weighted_rank FROM (
  SELECT a.date, a.asset, a.rank * 0.5 + b.rank * 0.5 AS w FROM report_ranks a
  JOIN report_ranks b ON a.date = b.date AND a.asset = b.asset
  WHERE a.factor_name = 'revenue' AND b.factor_name = 'units') s""",
    "weighted_rank_lists": f"""
SELECT date, asset, {_average_rank('date', 'w', True)} AS weighted_rank FROM (
  SELECT a.date, a.asset, a.rank * 0.25 + b.rank * 0.75 AS w FROM report_ranks a
  JOIN report_ranks b ON a.date = b.date AND a.asset = b.asset
  WHERE a.factor_name = 'units' AND b.factor_name = 'return_rate') s""",
    "weighted_rank_combos": f"""
SELECT CAST(combo_id AS BIGINT) AS combo_id, combo, date, asset,
       {_average_rank('combo_id, date', 'w')} AS weighted_rank FROM (
  SELECT combo_id, combo, x.date, x.asset, x.rank * 0.75 + y.rank * 0.25 AS w
  FROM (VALUES (0, 'revenue_units', 'revenue', 'units'), (1, 'revenue_return_rate', 'revenue', 'return_rate'),
               (2, 'units_return_rate', 'units', 'return_rate')) c(combo_id, combo, a, b)
  JOIN report_ranks x ON x.factor_name = a
  JOIN report_ranks y ON y.factor_name = b AND y.date = x.date AND y.asset = x.asset) s""",
    "weighted_rank_catalogue": f"""
SELECT combo_id, combo, date, asset, {_average_rank('combo_id, date', 'w')} AS weighted_rank FROM (
  SELECT combo_id, combo, date, asset,
         r[a] * 0.5 + r[b] * 0.25 + r[c] * 0.125 + r[d] * 0.0625 + r[e] * 0.0625 AS w
  FROM measure_combos CROSS JOIN (
    SELECT date, asset, list(rank ORDER BY i) AS r FROM measure_ranks GROUP BY 1, 2) x) s""",
    "forward_returns": " UNION ALL ".join(
        f"SELECT date, asset, {k} AS period, {_r(f'fwd_{k}', 9)} AS forward_return FROM fwd" for k in (1, 5, 10)
    ),
    "quantile_buckets": f"""
SELECT date, asset, factor_name, value, bucket FROM ({_buckets("month_factors")}) b
UNION ALL SELECT date, asset, factor_name, value, NULL FROM month_factors WHERE value IS NULL""",
    "clean_factor_rows": f"""
SELECT factor_name, date, asset, bucket, {_r('fwd_1', 9)} AS fwd_1, {_r('fwd_5', 9)} AS fwd_5,
       {_r('fwd_10', 9)} AS fwd_10 FROM f_clean""",
    "loss_gate": f"""
SELECT factor_name, n_rows, n_with_returns, n_kept, {_r('1.0::DOUBLE - n_kept::DOUBLE / n_rows', 9)} AS loss,
       CASE WHEN 1.0::DOUBLE - n_kept::DOUBLE / n_rows > 0.1225 THEN 'skipped' ELSE 'ok' END AS status FROM (
  SELECT factor_name, count(*) AS n_rows, count(*) FILTER (complete) AS n_with_returns
  FROM f_joined GROUP BY 1) j
JOIN (SELECT factor_name, count(*) AS n_kept FROM f_clean GROUP BY 1) c USING (factor_name)""",
    "clean_factor_gated": f"""
SELECT factor_name, date, asset, value, t, bucket, {_r('fwd_1', 9)} AS fwd_1, {_r('fwd_5', 9)} AS fwd_5,
       {_r('fwd_10', 9)} AS fwd_10 FROM f_clean
WHERE factor_name IN (SELECT factor_name FROM f_clean c GROUP BY 1
  HAVING 1.0 - count(*)::DOUBLE / (SELECT count(*) FROM f_joined j WHERE j.factor_name = c.factor_name) <= 0.1225)""",
    "quantile_stats": f"""
SELECT factor_name, bucket, {_r('min(value)', 6)} AS min, {_r('max(value)', 6)} AS max,
       {_r('avg(value)', 6)} AS mean, {_r('stddev_samp(value)', 6)} AS std, count(*) AS count,
       {_r('count(*)::DOUBLE / (SELECT count(*) FROM f_clean d WHERE d.factor_name = c.factor_name)', 6)} AS share
FROM f_clean c GROUP BY 1, 2""",
    "quantile_returns": _QUANTILE_RETURNS.format(
        mean=_r("avg(r)", 6), error=_r("stddev_samp(r) / sqrt(count(*))", 6), source="f_tall"
    ),
    "quantile_returns_demeaned": _QUANTILE_RETURNS.format(
        mean=_r("avg(d)", 6), error=_r("stddev_samp(d) / sqrt(count(*))", 6), source="f_demeaned"
    ),
    "quantile_returns_by_date": f"""
SELECT factor_name, date, CAST(period AS INT) AS period, bucket, count(*) AS n,
       {_r('avg(d)', 6)} AS mean_return, {_r('stddev_samp(d) / sqrt(count(*))', 6)} AS std_error
FROM f_demeaned GROUP BY 1, 2, 3, 4""",
    "quantile_spread": f"""
SELECT factor_name, date, CAST(period AS INT) AS period, {_r('spread', 6)} AS spread,
       {_r('std_error', 6)} AS std_error FROM f_spread""",
    "factor_portfolio_return": f"""
SELECT factor_name, date, period, {_r('factor_return', 6)} AS factor_return,
       {_r('universe_return', 6)} AS universe_return FROM f_factor_return""",
    "cumulative_return": f"""
SELECT factor_name, period, date,
  {_significant('product(1 + coalesce(factor_return, 0)) OVER (PARTITION BY factor_name, period ORDER BY date) - 1')}
    AS cumulative_return
FROM f_factor_return""",
    "factor_alpha_beta": f"""
SELECT factor_name, period, {_r('alpha', 6)} AS alpha, {_r('beta', 6)} AS beta,
  {_significant('CASE WHEN alpha > -1 THEN pow(CASE WHEN alpha > -1 THEN 1 + alpha END, 252.0 / period) - 1 END')}
    AS annual_alpha
FROM (SELECT factor_name, period, regr_intercept(factor_return, universe_return) AS alpha,
             regr_slope(factor_return, universe_return) AS beta FROM f_factor_return GROUP BY 1, 2) f""",
    "ic_daily": f"SELECT factor_name, date, period, {_r('ic', 8)} AS ic FROM f_ic",
    "ic_summary": f"""
SELECT factor_name, period, n, {_r('m', 6)} AS ic_mean, {_r('s', 6)} AS ic_std,
       {_r('(SELECT avg(pow(ic - m, 3)) FROM f_ic i WHERE i.factor_name = g.factor_name AND i.period = g.period) / pow(sp, 3)', 6)} AS ic_skew,
       {_r('k', 6)} AS ic_kurtosis, {_r('m / s', 6)} AS risk_adjusted_ic,
       {_r('m / (s / sqrt(n))', 6)} AS t_stat FROM f_ic_stats g""",
    "ic_monthly": f"""
SELECT factor_name, period, CAST(date_trunc('month', date) AS date) AS month, {_r('avg(ic)', 8)} AS ic_mean
FROM f_ic GROUP BY 1, 2, 3""",
    "bucket_turnover": f"""
SELECT a.factor_name, a.date, a.bucket, period,
       {_r('1.0::DOUBLE - count(b.asset)::DOUBLE / count(*)', 9)} AS turnover
FROM f_clean a CROSS JOIN (VALUES (1), (5), (10)) p(period)
LEFT JOIN f_clean b ON b.factor_name = a.factor_name AND b.asset = a.asset AND b.bucket = a.bucket
  AND b.t = a.t - period
WHERE a.t > period GROUP BY 1, 2, 3, 4""",
    "rank_autocorr": f"""
SELECT a.factor_name, a.date, period, {_r('corr(a.rk, b.rk)', 8)} AS autocorrelation
FROM (SELECT *, {_average_rank('factor_name, date', 'value')} AS rk FROM f_clean) a
CROSS JOIN (VALUES (1), (5), (10)) p(period)
LEFT JOIN (SELECT *, {_average_rank('factor_name, date', 'value')} AS rk FROM f_clean) b
  ON b.factor_name = a.factor_name AND b.asset = a.asset AND b.t = a.t - period
WHERE a.t > period GROUP BY 1, 2, 3""",
    "factor_zscores": "SELECT date, asset, "
    + ", ".join(f"{_r(f'({n} - avg({n}) OVER ()) / stddev_pop({n}) OVER ()', 6)} AS {n}" for n in _FACTORS)
    + " FROM complete_months",
    "factor_covariance": " UNION ALL ".join(
        f"SELECT '{a}' AS factor_a, '{b}' AS factor_b, {_r(f'corr({a}, {b})', 8)} AS covariance FROM complete_months"
        for i, a in enumerate(_FACTORS)
        for b in _FACTORS[i:]
    ),
    "backtest_equity": f"""
SELECT date, {_r('cash', 2)} AS cash, {_r('worth', 2)} AS position_value, {_r('equity', 2)} AS equity,
       {_r('r', 6)} AS daily_return FROM portfolio_returns""",
    "pca_scores": f"""
SELECT date, asset, {_r('(z1 + s * z2) / sqrt(2.0)', 6)} AS "PC1", {_r('(z1 - s * z2) / sqrt(2.0)', 6)} AS "PC2" FROM z""",
    "pca_components": f"SELECT date, asset, 'PC2' AS factor_name, {_r('value', 6)} AS value FROM pc_scores WHERE k = 2",
    "component_study": "SELECT * FROM p_headline",
    "factor_study": "SELECT * FROM f_headline",
    "factor_study_default": """
SELECT CASE factor_name WHEN 'revenue' THEN 'EBITDA' ELSE '自由現金流量' END AS factor_name, * EXCLUDE (factor_name)
FROM f_headline WHERE factor_name IN ('revenue', 'units')""",
    "combo_study": "SELECT * FROM c_headline",
    "quarter_schedule_rank": "SELECT * FROM scheduled",
    "price_rank_merge": """
SELECT * FROM (SELECT date, asset,
  last_value(open IGNORE NULLS) OVER w AS open, last_value(high IGNORE NULLS) OVER w AS high,
  last_value(low IGNORE NULLS) OVER w AS low, last_value(close IGNORE NULLS) OVER w AS close,
  last_value(volume IGNORE NULLS) OVER w AS volume, last_value(rank IGNORE NULLS) OVER w AS rank
  FROM monthly FULL OUTER JOIN scheduled s USING (date, asset)
  WINDOW w AS (PARTITION BY asset ORDER BY date)) f WHERE open IS NOT NULL AND close IS NOT NULL""",
    "aligned_panel": "SELECT date, CAST(t AS INT) AS t, * EXCLUDE (date, t) FROM panel",
    "aligned_panel_lookahead": """
SELECT date, CAST(t AS INT) AS t, asset,
  coalesce(last_value(open IGNORE NULLS) OVER w, first_value(open IGNORE NULLS) OVER b) AS open,
  coalesce(last_value(high IGNORE NULLS) OVER w, first_value(high IGNORE NULLS) OVER b) AS high,
  coalesce(last_value(low IGNORE NULLS) OVER w, first_value(low IGNORE NULLS) OVER b) AS low,
  coalesce(last_value(close IGNORE NULLS) OVER w, first_value(close IGNORE NULLS) OVER b) AS close,
  coalesce(last_value(volume IGNORE NULLS) OVER w, first_value(volume IGNORE NULLS) OVER b) AS volume,
  coalesce(last_value(rank IGNORE NULLS) OVER w, first_value(rank IGNORE NULLS) OVER b, 999999) AS rank
FROM (
  SELECT c.date, c.t, a.asset, m.open, m.high, m.low, m.close, m.volume, m.rank
  FROM (SELECT date, row_number() OVER (ORDER BY date) AS t FROM monthly
        WHERE asset = (SELECT min(asset) FROM monthly)) c
  CROSS JOIN (SELECT DISTINCT asset FROM monthly) a
  LEFT JOIN (SELECT date, asset, open, high, low, close, volume,
               coalesce(last_value(rank IGNORE NULLS) OVER (PARTITION BY asset ORDER BY date), 999999) AS rank
             FROM monthly LEFT JOIN scheduled USING (date, asset)) m
  ON m.date = c.date AND m.asset = a.asset) g
WINDOW w AS (PARTITION BY asset ORDER BY t),
       b AS (PARTITION BY asset ORDER BY t ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)""",
    "long_short_signals": """
SELECT date, asset, 'long' AS side, CAST(high_place AS INT) AS position, rank FROM places WHERE high_place <= 20
UNION ALL
SELECT date, asset, 'short', CAST(low_place AS INT), rank FROM places WHERE low_place <= 20""",
    "holdings": "SELECT date, asset, side, size FROM sized WHERE held",
    "trade_orders": """
SELECT date, asset, side, CASE WHEN enter THEN 'enter' ELSE 'exit' END AS action, size FROM sized
WHERE enter OR leave""",
    "trade_ledger": """
SELECT date, asset, side, action, quantity, price,
       0.001::DOUBLE * (abs(quantity) * price) AS commission FROM ledger""",
    "equity_curve": f"""
SELECT date, {_r('cash', 2)} AS cash, {_r('worth', 2)} AS position_value, {_r('equity', 2)} AS equity,
       {_r('r', 6)} AS daily_return FROM portfolio_returns""",
    "performance_summary": _performance("portfolio_returns", 12, 6),
    "monthly_returns": _periodic("portfolio_returns", "month", 6),
    "yearly_returns": _periodic("portfolio_returns", "year", 4),
    "drawdowns": _drawdowns("portfolio_returns"),
    "benchmark_performance": _performance("market_returns", 252, 5),
    "benchmark_monthly": _periodic("market_returns", "month", 6),
    "benchmark_drawdowns": _drawdowns("market_returns"),
}

_NAME = re.compile(r"\b(?:" + "|".join(RELATIONS) + r")\b")


def _needed(sql: str, found: list[str], open_names: frozenset[str] = frozenset()) -> None:
    for name in _NAME.findall(sql):
        if name not in found and name not in open_names:
            _needed(RELATIONS[name], found, open_names | {name})
            found.append(name)


def statement(name: str) -> str:
    """The complete statement, with the building blocks it needs in front."""
    body = QUERIES[name]
    found: list[str] = []
    _needed(body, found)
    if not found:
        return body.strip()
    blocks = ",\n".join(f"{n} AS ({RELATIONS[n].strip()})" for n in found)
    return f"WITH {blocks}\n{body.strip()}"


def oracle_sql() -> dict[str, str]:
    return {name: statement(name) for name in QUERIES}
