"""DuckDB oracle: the same retail panel written as plain SQL.

``PANEL`` is a CTE prefix that mirrors ``sources.tpch_panel`` over the
driver's pre-registered views; each oracle query appends its own SELECT.
The five state names of the driver's ``region`` table appear as fixed
snap columns (the Spark side derives them from the table).
"""

from __future__ import annotations

# The driver's region names and keys, and the SNAP rule
# (days 1+2k .. 10+2k of each month for region key k).
STATES = [("AFRICA", 0), ("AMERICA", 1), ("ASIA", 2), ("EUROPE", 3), ("MIDDLE EAST", 4)]


def _snap_cols() -> str:
    out = []
    for name, k in STATES:
        col = "snap_" + name.replace(" ", "_")
        out.append(f"CASE WHEN day(dt) BETWEEN {1 + 2 * k} AND {10 + 2 * k} THEN 1 ELSE 0 END AS {col}")
    return ",\n    ".join(out)


SNAP_COLS = ", ".join("snap_" + n.replace(" ", "_") for n, _ in STATES)
# The SNAP flag of the row's own state (O-27), as an INTEGER.
SNAP_OWN = "CAST(CASE " + " ".join(
    f"WHEN state_id = '{n}' THEN snap_{n.replace(' ', '_')}" for n, _ in STATES) + " END AS INTEGER)"
DAYNUM = "CAST(date_diff('day', DATE '1995-01-02', CAST({} AS DATE)) + 1 AS INTEGER)"

PANEL = f"""
WITH
stores AS (
  SELECT s.s_suppkey, n.n_name AS store_id, r.r_name AS state_id, r.r_regionkey AS state_key
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey),
lines AS (
  SELECT p.p_brand AS item_id, st.store_id, st.state_id,
         {DAYNUM.format('l.l_shipdate')} AS day_num, l.l_quantity, l.l_extendedprice
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
  JOIN stores st ON l.l_suppkey = st.s_suppkey),
cells AS (
  SELECT item_id, store_id, state_id, day_num, CAST(SUM(l_quantity) AS INTEGER) AS sales
  FROM lines GROUP BY item_id, store_id, state_id, day_num),
prices AS (
  SELECT store_id, item_id, CAST(floor((day_num - 1) / 7) AS INTEGER) AS wm_yr_wk,
         MAX(l_extendedprice / l_quantity) AS sell_price
  FROM lines GROUP BY 1, 2, 3),
bounds AS (SELECT MIN(day_num) AS lo, MAX(day_num) AS hi FROM cells),
days AS (SELECT CAST(unnest(generate_series(lo, hi)) AS INTEGER) AS day_num FROM bounds),
calendar AS (
  SELECT day_num, dt AS date, CAST(floor((day_num - 1) / 7) AS INTEGER) AS wm_yr_wk,
    dayname(dt) AS weekday, CAST((dayofweek(dt) + 1) % 7 + 1 AS INTEGER) AS wday,
    CAST(month(dt) AS INTEGER) AS month, CAST(year(dt) AS INTEGER) AS year,
    'd_' || day_num AS d,
    CASE WHEN month(dt) = 2 AND day(dt) = 14 THEN 'ValentinesDay'
         WHEN month(dt) = 7 AND day(dt) = 4 THEN 'IndependenceDay'
         WHEN month(dt) = 12 AND day(dt) = 25 THEN 'Christmas' END AS event_name_1,
    CASE WHEN month(dt) = 2 AND day(dt) = 14 THEN 'Cultural'
         WHEN month(dt) = 7 AND day(dt) = 4 THEN 'National'
         WHEN month(dt) = 12 AND day(dt) = 25 THEN 'National' END AS event_type_1,
    CAST(NULL AS VARCHAR) AS event_name_2, CAST(NULL AS VARCHAR) AS event_type_2,
    {_snap_cols()}
  FROM (SELECT day_num, CAST(DATE '1995-01-02' + (day_num - 1) AS DATE) AS dt FROM days) c),
series AS (SELECT DISTINCT item_id, store_id, state_id FROM cells),
dense AS (
  SELECT s.item_id, s.store_id, s.state_id, d.day_num, COALESCE(c.sales, 0) AS sales
  FROM series s CROSS JOIN days d
  LEFT JOIN cells c ON c.item_id = s.item_id AND c.store_id = s.store_id AND c.day_num = d.day_num),
fact AS (
  SELECT ds.store_id, ds.item_id, cal.wm_yr_wk, cal.d, ds.item_id || '_' || ds.store_id AS id,
    'DEPT_' || CAST(CAST(regexp_extract(ds.item_id, '(\\d+)$', 1) AS INTEGER) % 6 AS VARCHAR) AS dept_id,
    'CAT_' || CAST(CAST(regexp_extract(ds.item_id, '(\\d+)$', 1) AS INTEGER) % 6 % 3 AS VARCHAR) AS cat_id,
    ds.state_id, ds.sales, cal.wday, cal.month, cal.year, cal.event_name_1, cal.event_type_1,
    {SNAP_COLS}, p.sell_price, ds.day_num
  FROM dense ds LEFT JOIN calendar cal ON ds.day_num = cal.day_num
  LEFT JOIN prices p ON p.store_id = ds.store_id AND p.item_id = ds.item_id
                    AND p.wm_yr_wk = cal.wm_yr_wk)
"""


def q(body: str) -> str:
    return PANEL + body


def q_recursive(body: str) -> str:
    """``q`` for bodies with recursive parts."""
    return "WITH RECURSIVE" + q(body).lstrip().removeprefix("WITH")


def gram_sql(regressors: list[str]) -> list[tuple[str, str]]:
    """(expression, name) of the sums that ``trend.gram_sums`` makes."""
    out = []
    for i, a in enumerate(regressors):
        out += [(f"SUM({a} * {b})", f"xx_{a}_{b}") for b in regressors[i:]]
        out.append((f"SUM({a} * y)", f"xy_{a}"))
    return out


def solve_sql(source: str, regressors: list[str], ridge: float, out: str) -> str:
    """CTEs that solve the normal equations of each store in ``source``
    (gram_sql columns) by Gauss-Jordan elimination; ``out`` has (store_id,
    beta list)."""
    n, place = len(regressors), {r: i for i, r in enumerate(regressors)}
    xx = lambda a, b: f"xx_{a}_{b}" if place[a] <= place[b] else f"xx_{b}_{a}"
    trace = " + ".join(xx(r, r) for r in regressors)
    cell = lambda a, b: xx(a, b) + (f" + {ridge!r} * ({trace}) / {n}" if a == b else "")
    matrix = ", ".join("[" + ", ".join([cell(a, b) for b in regressors] + [f"xy_{a}"]) + "]" for a in regressors)
    return f"""{out}_step AS (
  SELECT store_id, 1 AS k, [{matrix}] AS m FROM {source}
  UNION ALL
  SELECT store_id, k + 1, list_transform(m, lambda r, i: CASE WHEN i = k THEN list_transform(r, lambda x: x / m[k][k])
                                                         ELSE list_transform(r, lambda x, j: x - r[k] * m[k][j] / m[k][k]) END)
  FROM {out}_step WHERE k <= {n}),
{out} AS MATERIALIZED (SELECT store_id, list_transform(m, lambda r: r[{n + 1}]) AS beta FROM {out}_step WHERE k = {n + 1})"""
