"""SQL counterparts of the inputs, as named common table expressions."""

from __future__ import annotations

import re


def rnd(expression: str, digits: int) -> str:
    return f"(floor(({expression}) * 1e{digits} + 0.5e0) / 1e{digits})"


def money_avg(column: str) -> str:
    return f"(CAST(sum(CAST({column} AS DECIMAL(18,6))) AS DOUBLE) / count({column}))"


def stable_sum(column: str) -> str:
    return f"CAST(sum(CAST({column} AS DECIMAL(26,10))) AS DOUBLE)"


def stable_avg(column: str) -> str:
    return f"({stable_sum(column)} / count({column}))"


_UNIT = rnd("CAST(sum(CAST(l_extendedprice AS DECIMAL(15,2))) AS DOUBLE) / sum(l_quantity)", 2)
_IDS = "id, item_id, dept_id, cat_id, store_id, state_id"
_DOM = "extract(day FROM date)"
_DAY0 = "DATE '2000-01-01'"


def _event(rows, position: int) -> str:
    cases = " ".join(f"WHEN strftime(date, '%m-%d') = '{row[0]}' THEN '{row[position]}'" for row in rows)
    return f"CASE {cases} END"


_E1 = [
    ("02-14", "ValentinesDay", "Cultural"),
    ("07-04", "IndependenceDay", "National"),
    ("10-31", "Halloween", "Cultural"),
    ("12-25", "Christmas", "National"),
]
_E2 = [("01-07", "OrthodoxChristmas", "Religious"), ("02-14", "CupFinal", "Sporting")]

CTES = {
    "stores": "SELECT s_suppkey, n_name, r_name FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey",
    "fact": f"""SELECT CAST(l_shipdate AS DATE) AS date, CAST(p_partkey AS VARCHAR) AS item_id, p_brand AS dept_id, p_type AS cat_id,
        n_name AS store_id, r_name AS state_id, CAST(sum(l_quantity) AS BIGINT) AS sales, {_UNIT} AS sell_price
        FROM lineitem JOIN part ON l_partkey = p_partkey JOIN stores ON l_suppkey = s_suppkey GROUP BY 1, 2, 3, 4, 5, 6""",
    "series": f"""SELECT CAST(l_shipdate AS DATE) AS date, p_type AS item_id, p_type AS dept_id, p_type AS cat_id,
        r_name AS store_id, r_name AS state_id, CAST(sum(l_quantity) AS BIGINT) AS sales, {_UNIT} AS sell_price
        FROM lineitem JOIN part ON l_partkey = p_partkey JOIN stores ON l_suppkey = s_suppkey GROUP BY 1, 2, 3, 4, 5, 6""",
    "days": """SELECT lo, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date
        FROM (SELECT CAST(min(l_shipdate) AS DATE) AS lo, CAST(max(l_shipdate) AS DATE) AS hi FROM lineitem)""",
    "cal": f"""SELECT date, CAST(11101 + (date_diff('day', DATE '1994-12-31', date) // 7) AS BIGINT) AS wm_yr_wk,
        dayname(date) AS weekday, CAST((isodow(date) + 1) % 7 + 1 AS BIGINT) AS wday,
        CAST(month(date) AS BIGINT) AS month, CAST(year(date) AS BIGINT) AS year,
        'd_' || CAST(date_diff('day', lo, date) + 1 AS VARCHAR) AS d,
        {_event(_E1, 1)} AS event_name_1, {_event(_E1, 2)} AS event_type_1,
        {_event(_E2, 1)} AS event_name_2, {_event(_E2, 2)} AS event_type_2,
        CAST({_DOM} <= 10 AS BIGINT) AS "snap_CA", CAST({_DOM} <= 15 AND {_DOM} % 2 = 1 AS BIGINT) AS "snap_TX",
        CAST({_DOM} <= 16 AND {_DOM} % 2 = 0 AS BIGINT) AS "snap_WI" FROM days""",
    "prices": """SELECT store_id, item_id, wm_yr_wk, sell_price FROM (
        SELECT s.*, c.wm_yr_wk, row_number() OVER (PARTITION BY store_id, item_id, wm_yr_wk ORDER BY s.date, sell_price) AS rn
        FROM series s JOIN cal c ON s.date = c.date) WHERE rn = 1""",
    "ids": "SELECT DISTINCT item_id || '_' || store_id AS id, item_id, dept_id, cat_id, store_id, state_id FROM series",
    "cells": f"""SELECT {', '.join('i.' + c for c in _IDS.split(', '))}, c.d, c.date, c.wm_yr_wk,
        date_diff('day', c0.lo, c.date) + 1 AS n, coalesce(s.sales, 0) AS sales
        FROM ids i CROSS JOIN cal c CROSS JOIN (SELECT min(date) AS lo FROM cal) c0
        LEFT JOIN series s ON s.item_id = i.item_id AND s.store_id = i.store_id AND s.date = c.date""",
    "stg_cal": """SELECT date AS sales_date, wm_yr_wk, weekday, CAST(wday AS INTEGER) AS day_of_week, CAST(month AS INTEGER) AS month,
        CAST(year AS INTEGER) AS year, d AS day_id, event_name_1, event_type_1, event_name_2, event_type_2,
        CAST("snap_CA" AS INTEGER) AS snap_ca, CAST("snap_TX" AS INTEGER) AS snap_tx, CAST("snap_WI" AS INTEGER) AS snap_wi FROM cal""",
    "daily": """SELECT f.date AS sales_date, state_id, store_id, cat_id, dept_id, item_id, sales, sell_price, c.* EXCLUDE (sales_date)
        FROM fact f LEFT JOIN stg_cal c ON f.date = c.sales_date""",
    "mart": """SELECT sales_date AS date, sales_date, item_id, store_id, state_id, cat_id AS category, cat_id, dept_id AS department,
        dept_id, sales, sell_price, wm_yr_wk, year, month, weekday, day_of_week, day_id, event_name_1, event_type_1, event_name_2,
        event_type_2, snap_ca, snap_tx, snap_wi FROM daily""",
    "weekly": f"""SELECT wm_yr_wk, year, state_id, store_id, cat_id, dept_id, item_id, min(sales_date) AS week_start_date,
        max(sales_date) AS week_end_date, CAST(sum(sales) AS BIGINT) AS total_weekly_sales, {rnd(money_avg('sell_price'), 4)} AS avg_sell_price,
        min(sell_price) AS min_sell_price, max(sell_price) AS max_sell_price,
        count(DISTINCT CASE WHEN sales > 0 THEN sales_date END) AS selling_days, count(DISTINCT sales_date) AS recorded_days
        FROM daily GROUP BY ALL""",
    "monthly": f"""SELECT year, month, state_id, store_id, cat_id, dept_id, item_id, min(sales_date) AS month_start_date,
        max(sales_date) AS month_end_date, CAST(sum(sales) AS BIGINT) AS total_monthly_sales, {rnd(money_avg('sell_price'), 4)} AS avg_sell_price,
        min(sell_price) AS min_sell_price, max(sell_price) AS max_sell_price,
        count(DISTINCT CASE WHEN sales > 0 THEN sales_date END) AS selling_days, count(DISTINCT sales_date) AS recorded_days
        FROM daily GROUP BY ALL""",
    "faulty_daily": """SELECT * EXCLUDE (copy) REPLACE (CASE WHEN extract(day FROM sales_date) = 31 THEN -sales ELSE sales END AS sales,
        CASE WHEN extract(day FROM sales_date) = 30 THEN -sell_price ELSE sell_price END AS sell_price)
        FROM daily JOIN (VALUES (1), (2)) v(copy) ON copy = 1 OR extract(day FROM sales_date) = 29""",
    "faulty_fact": """SELECT CASE WHEN extract(day FROM sales_date) <> 28 THEN sales_date END AS date, item_id, dept_id, cat_id, store_id,
        state_id, sales, CASE WHEN extract(day FROM sales_date) <> 27 THEN sell_price END AS sell_price FROM faulty_daily""",
    "raw_cal": f"""SELECT CASE WHEN {_DOM} = 13 THEN 'not a date' WHEN {_DOM} <> 14 THEN CAST(date AS VARCHAR) END AS date,
        CASE WHEN {_DOM} = 15 THEN 'x' ELSE CAST(wm_yr_wk AS VARCHAR) END AS wm_yr_wk,
        CASE WHEN {_DOM} = 16 THEN 'nan' WHEN {_DOM} <> 17 THEN ' ' || weekday || ' ' END AS weekday,
        CAST(wday AS VARCHAR) AS wday, CAST(month AS VARCHAR) AS month,
        CASE WHEN {_DOM} = 18 THEN '1900' ELSE CAST(year AS VARCHAR) END AS year, d, event_name_1,
        CASE WHEN {_DOM} = 19 THEN 'Unknown' ELSE event_type_1 END AS event_type_1, event_name_2, event_type_2,
        CAST("snap_CA" AS VARCHAR) AS "snap_CA", CAST("snap_TX" AS VARCHAR) AS "snap_TX", CAST("snap_WI" AS VARCHAR) AS "snap_WI"
        FROM cal JOIN (VALUES (1), (2)) v(copy) ON copy = 1 OR {_DOM} = 20""",
    "raw_cells": f"""SELECT {', '.join(f"' ' || {c} AS {c}" for c in _IDS.split(', '))}, d, n, CASE WHEN sales % 97 = 5 THEN 'bad'
        WHEN sales % 89 = 7 THEN CAST(-sales AS VARCHAR) WHEN sales % 83 = 3 THEN NULL ELSE CAST(sales AS VARCHAR) END AS cell FROM cells""",
    "raw_prices": """SELECT ' ' || store_id AS store_id, CASE WHEN wm_yr_wk % 43 <> 0 THEN item_id || ' ' END AS item_id,
        CAST(wm_yr_wk AS VARCHAR) AS wm_yr_wk, CASE WHEN load_no = 2 THEN '1.5' WHEN wm_yr_wk % 29 = 0 THEN 'n/a'
        WHEN wm_yr_wk % 37 = 0 THEN '-' || CAST(sell_price AS VARCHAR) WHEN wm_yr_wk % 41 = 0 THEN '0'
        WHEN wm_yr_wk % 31 <> 0 THEN CAST(sell_price AS VARCHAR) END AS sell_price, load_no
        FROM prices JOIN (VALUES (1), (2)) v(load_no) ON load_no = 1 OR wm_yr_wk % 11 = 0""",
    # Gap-filled series: every day from first to last, the carried columns filled.
    "spans": "SELECT store_id, item_id, min(date) AS lo, max(date) AS hi FROM series GROUP BY 1, 2",
    "spine": "SELECT store_id, item_id, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM spans",
    "loose": """SELECT p.store_id, p.item_id, p.date, s.date IS NOT NULL AS original, coalesce(s.sales, 0) AS sales, s.sell_price,
        s.state_id, s.cat_id, s.dept_id FROM spine p LEFT JOIN series s
        ON p.store_id = s.store_id AND p.item_id = s.item_id AND p.date = s.date""",
    "filled": """SELECT store_id, item_id, date, original, CAST(sales AS BIGINT) AS sales,
        coalesce(last_value(sell_price IGNORE NULLS) OVER w, first_value(sell_price IGNORE NULLS) OVER x) AS sell_price,
        coalesce(last_value(state_id IGNORE NULLS) OVER w, first_value(state_id IGNORE NULLS) OVER x) AS state_id,
        coalesce(last_value(cat_id IGNORE NULLS) OVER w, first_value(cat_id IGNORE NULLS) OVER x) AS cat_id,
        coalesce(last_value(dept_id IGNORE NULLS) OVER w, first_value(dept_id IGNORE NULLS) OVER x) AS dept_id FROM loose
        WINDOW w AS (PARTITION BY store_id, item_id ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
        x AS (PARTITION BY store_id, item_id ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)""",
    "windowed": """SELECT *, lag(sales, 1) OVER o AS lag_1, lag(sales, 7) OVER o AS lag_7, lag(sales, 14) OVER o AS lag_14,
        lag(sales, 28) OVER o AS lag_28, avg(sales) OVER w7 AS rolling_mean_7, coalesce(stddev_samp(sales) OVER w7, 0) AS rolling_std_7,
        avg(sales) OVER w28 AS rolling_mean_28, coalesce(stddev_samp(sales) OVER w28, 0) AS rolling_std_28,
        lag(sell_price, 1) OVER o AS price_lag_1, sell_price - lag(sell_price, 1) OVER o AS price_diff_1,
        CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, CAST(day(date) AS INTEGER) AS day,
        CAST(isodow(date) - 1 AS INTEGER) AS day_of_week, CAST(weekofyear(date) AS INTEGER) AS week_of_year,
        CAST(isodow(date) >= 6 AS INTEGER) AS is_weekend FROM filled
        WINDOW o AS (PARTITION BY store_id, item_id ORDER BY date),
        w7 AS (PARTITION BY store_id, item_id ORDER BY date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING),
        w28 AS (PARTITION BY store_id, item_id ORDER BY date ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING)""",
    "featured": "SELECT * FROM windowed WHERE lag_28 IS NOT NULL",
    "edge": "SELECT max(date) - 28 AS cutoff FROM featured",
    "train": "SELECT f.* FROM featured f, edge WHERE date <= cutoff",
    "validation": "SELECT f.* FROM featured f, edge WHERE date > cutoff",
    "fits": f"""SELECT store_id, item_id, regr_slope(sales, t) AS b, regr_intercept(sales, t) AS a, count(*) AS n_days, max(date) AS last_date
        FROM (SELECT *, date_diff('day', {_DAY0}, date) AS t FROM train) GROUP BY 1, 2""",
    "season": f"""SELECT store_id, item_id, isodow(date) AS dow, avg(sales - (a + b * date_diff('day', {_DAY0}, date))) AS effect
        FROM train JOIN fits USING (store_id, item_id) GROUP BY 1, 2, 3""",
    "resid": f"""SELECT store_id, item_id, stddev_samp(sales - (a + b * date_diff('day', {_DAY0}, date) + effect)) AS s
        FROM train t JOIN fits USING (store_id, item_id) JOIN season e USING (store_id, item_id)
        WHERE e.dow = isodow(t.date) GROUP BY 1, 2""",
    "scored": f"""SELECT v.date, v.store_id, v.item_id, v.sales AS actual,
        a + b * date_diff('day', {_DAY0}, v.date) + coalesce(effect, 0) AS yhat FROM validation v JOIN fits USING (store_id, item_id)
        LEFT JOIN season e ON e.store_id = v.store_id AND e.item_id = v.item_id AND e.dow = isodow(v.date) WHERE b IS NOT NULL""",
    "predictions": "SELECT date, store_id, item_id, actual, greatest(yhat, 0) AS predicted_demand, 'additive' AS model_name FROM scored",
    "naive_preds": "SELECT date, store_id, item_id, sales AS actual, CAST(lag_28 AS DOUBLE) AS predicted_demand, 'naive' AS model_name FROM validation",
    "metrics": f"""SELECT model_name AS model, {rnd('avg(abs(actual - predicted_demand))', 4)} AS mae,
        {rnd('sqrt(avg((actual - predicted_demand) * (actual - predicted_demand)))', 4)} AS rmse,
        coalesce({rnd('100 * avg(CASE WHEN (abs(actual) + abs(predicted_demand)) / 2 > 1e-5 THEN abs(actual - predicted_demand) / ((abs(actual) + abs(predicted_demand)) / 2) END)', 2)}, 0) AS smape
        FROM (SELECT * FROM predictions UNION ALL SELECT * FROM naive_preds) GROUP BY 1""",
    "full_fits": f"""SELECT store_id, item_id, regr_slope(sales, t) AS b, regr_intercept(sales, t) AS a, max(date) AS last_date
        FROM (SELECT *, date_diff('day', {_DAY0}, date) AS t FROM filled) GROUP BY 1, 2""",
    "full_season": f"""SELECT store_id, item_id, isodow(date) AS dow, avg(sales - (a + b * date_diff('day', {_DAY0}, date))) AS effect
        FROM filled JOIN full_fits USING (store_id, item_id) GROUP BY 1, 2, 3""",
    "ahead": """SELECT store_id, item_id, a, b, CAST(unnest(generate_series(last_date + 1, last_date + 30, INTERVAL 1 DAY)) AS DATE) AS forecast_date
        FROM full_fits WHERE b IS NOT NULL""",
    "forecast": f"""SELECT forecast_date, f.item_id, f.store_id,
        {rnd(f"greatest(a + b * date_diff('day', {_DAY0}, forecast_date) + coalesce(effect, 0), 0)", 4)} AS predicted_demand,
        'additive' AS model_used FROM ahead f LEFT JOIN full_season e
        ON e.store_id = f.store_id AND e.item_id = f.item_id AND e.dow = isodow(f.forecast_date)""",
    "demand": """SELECT store_id, item_id, avg(sales) AS mean_sales, stddev_samp(sales) AS std_sales, count(sales) AS n_rows
        FROM series GROUP BY 1, 2""",
    "stock": "SELECT *, ceil(CAST(1.65 AS DOUBLE) * coalesce(std_sales, 0) * sqrt(7)) AS safety_stock FROM demand",
    "summary": f"""SELECT store_id, item_id, {stable_sum('predicted_demand')} AS total_30d_forecast,
        {stable_avg('predicted_demand')} AS avg_daily_forecast FROM forecast GROUP BY 1, 2""",
    "points": """SELECT m.*, coalesce(k.safety_stock, 0) AS safety_stock, round_even(avg_daily_forecast * 7, 2) AS lead_time_demand,
        ceil(round_even(avg_daily_forecast * 7, 2) + coalesce(k.safety_stock, 0)) AS reorder_point
        FROM summary m LEFT JOIN stock k ON m.store_id = k.store_id AND m.item_id = k.item_id""",
    "plan": """SELECT item_id, store_id, (SELECT max(forecast_date) FROM forecast) AS forecast_date,
        round_even(total_30d_forecast, 2) AS predicted_demand, safety_stock, reorder_point, ceil(reorder_point * CAST(0.5 AS DOUBLE)) AS available_inventory,
        greatest(0, ceil(total_30d_forecast + safety_stock - ceil(reorder_point * CAST(0.5 AS DOUBLE)))) AS recommended_order_quantity,
        CASE WHEN ceil(reorder_point * CAST(0.5 AS DOUBLE)) < safety_stock THEN 'HIGH' WHEN ceil(reorder_point * CAST(0.5 AS DOUBLE)) < reorder_point THEN 'MEDIUM' ELSE 'LOW' END AS stockout_risk,
        'additive' AS model_used FROM points""",
}

_NAME = re.compile(r"\b[a-z_][a-z0-9_]*\b")


def _needed(text: str, seen: dict[str, None], inside: tuple[str, ...] = ()) -> None:
    for word in _NAME.findall(text):
        if word in CTES and word not in seen and word not in inside:
            _needed(CTES[word], seen, (*inside, word))
            seen[word] = None


def query(body: str, **extra: str) -> str:
    """`body` preceded by the common table expressions it mentions, directly or not."""
    seen: dict[str, None] = {}
    for text in (*extra.values(), body):
        _needed(text, seen)
    parts = [f"{name} AS ({CTES[name]})" for name in seen] + [f"{name} AS ({text})" for name, text in extra.items()]
    return f"WITH {', '.join(parts)} {body}" if parts else body
