"""Descriptive statistics."""

from __future__ import annotations

from catalog import inputs as i
from catalog.sql import money_avg, query, rnd
from shelfline.operators import profiles as p

_BY = "SELECT %s, CAST(sum(sales) AS BIGINT) AS total_sales, avg(sales) AS %s, count(sales) AS record_count FROM fact GROUP BY ALL"
_ITEMS = """SELECT item_id, CAST(sum(sales) AS BIGINT) AS total_sales, avg(sales) AS avg_daily_sales, min(sales) AS min_daily_sales,
    max(sales) AS max_daily_sales FROM fact GROUP BY 1"""
_DAYS = "SELECT date, CAST(sum(sales) AS BIGINT) AS total FROM fact GROUP BY 1"
_MISSING_PCT = "100e0 * CAST(count(*) FILTER (WHERE sell_price IS NULL) AS DOUBLE) / count(*)"

ENTRIES = {
    "daily_totals": (
        lambda s, d: p.daily_totals(i.fact(s, d)),
        query(
            """SELECT date, CAST(sum(sales) AS BIGINT) AS total_sales, avg(sales) AS avg_sales, min(sales) AS min_sales,
            max(sales) AS max_sales, count(sales) AS record_count FROM fact GROUP BY 1"""
        ),
    ),
    "sales_by_store": (lambda s, d: p.sales_by_store(i.fact(s, d)), query(_BY % ("store_id", "avg_daily_sales"))),
    "sales_by_category": (lambda s, d: p.sales_by_category(i.fact(s, d)), query(_BY % ("cat_id", "avg_daily_sales"))),
    "sales_by_department": (lambda s, d: p.sales_by_department(i.fact(s, d)), query(_BY % ("dept_id", "avg_daily_sales"))),
    "item_totals": (lambda s, d: p.item_totals(i.fact(s, d)), query(_ITEMS)),
    "top_items": (lambda s, d: p.top_items(i.fact(s, d)), query(_ITEMS + " ORDER BY total_sales DESC, item_id LIMIT 5")),
    "bottom_items": (lambda s, d: p.bottom_items(i.fact(s, d)), query(_ITEMS + " ORDER BY total_sales, item_id LIMIT 5")),
    "sales_trend_summary": (
        lambda s, d: p.sales_trend_summary(i.fact(s, d)),
        query(
            """SELECT min(date) AS start_date, max(date) AS end_date, arg_min(total, date) AS first_day_sales,
            arg_max(total, date) AS last_day_sales, (SELECT date FROM t ORDER BY total DESC, date LIMIT 1) AS peak_day_date,
            max(total) AS peak_day_sales FROM t""",
            t=_DAYS,
        ),
    ),
    "sales_by_year": (lambda s, d: p.sales_by_year(i.fact(s, d)), query(_BY % ("CAST(year(date) AS INTEGER) AS year", "avg_sales"))),
    "sales_by_month": (lambda s, d: p.sales_by_month(i.fact(s, d)), query(_BY % ("CAST(month(date) AS INTEGER) AS month", "avg_sales"))),
    "sales_by_dow": (
        lambda s, d: p.sales_by_dow(i.fact(s, d)),
        query(_BY % ("CAST(isodow(date) - 1 AS INTEGER) AS day_of_week, dayname(date) AS day_name", "avg_sales")),
    ),
    "weekend_vs_weekday": (
        lambda s, d: p.weekend_vs_weekday(i.fact(s, d)),
        query(
            _BY
            % (
                "isodow(date) >= 6 AS is_weekend, CASE WHEN isodow(date) >= 6 THEN 'Weekend (Sat-Sun)' ELSE 'Weekday (Mon-Fri)' END AS period_type",
                "avg_daily_units",
            )
        ),
    ),
    "price_stats": (
        lambda s, d: p.price_stats(i.faulty_fact(s, d)),
        query(
            f"""SELECT {rnd(money_avg('sell_price'), 2)} AS avg_price, {rnd('min(sell_price)', 2)} AS min_price,
            {rnd('max(sell_price)', 2)} AS max_price, {rnd('median(sell_price)', 2)} AS median_price,
            count(*) FILTER (WHERE sell_price IS NULL) AS missing_count, {rnd(_MISSING_PCT, 2)} AS missing_pct FROM faulty_fact"""
        ),
    ),
    "price_by_category": (
        lambda s, d: p.price_by_category(i.fact(s, d)),
        query(f"SELECT cat_id, {money_avg('sell_price')} AS avg_price, min(sell_price) AS min_price, max(sell_price) AS max_price FROM fact GROUP BY 1"),
    ),
    "price_variation": (
        lambda s, d: i.rounded(p.price_variation(i.fact(s, d)), 4, ["std_price", "price_range"]),
        query(
            f"""SELECT item_id, store_id, {money_avg('sell_price')} AS avg_price, min(sell_price) AS min_price, max(sell_price) AS max_price,
            {rnd('stddev_samp(sell_price)', 4)} AS std_price, {rnd('max(sell_price) - min(sell_price)', 4)} AS price_range FROM fact GROUP BY 1, 2"""
        ),
    ),
    "category_profile": (
        lambda s, d: i.rounded(p.category_profile(i.fact(s, d)), 4, ["std_sales"]),
        query(
            f"""SELECT cat_id, CAST(sum(sales) AS BIGINT) AS total_sales, avg(sales) AS avg_sales, {rnd('stddev_samp(sales)', 4)} AS std_sales,
            max(sales) AS max_sales FROM fact GROUP BY 1"""
        ),
    ),
    "store_profile": (
        lambda s, d: p.store_profile(i.fact(s, d)),
        query("SELECT store_id, CAST(sum(sales) AS BIGINT) AS total_sales, avg(sales) AS avg_sales FROM fact GROUP BY 1"),
    ),
    "zero_sales_ratio": (
        lambda s, d: p.zero_sales_ratio(i.long_cells(s, d)),
        query(
            f"""SELECT count(*) FILTER (WHERE sales = 0) AS zero_count,
            {rnd('100e0 * CAST(count(*) FILTER (WHERE sales = 0) AS DOUBLE) / count(*)', 2)} AS zero_pct FROM cells"""
        ),
    ),
    "price_profile": (
        lambda s, d: p.price_profile(i.fact(s, d)),
        query(f"SELECT cat_id, min(sell_price) AS min_price, {money_avg('sell_price')} AS avg_price, max(sell_price) AS max_price FROM fact GROUP BY 1"),
    ),
    "dow_mean_profile": (
        lambda s, d: p.dow_mean_profile(i.fact(s, d)),
        query("SELECT CAST(isodow(date) - 1 AS INTEGER) AS day_of_week, dayname(date) AS day_name, avg(sales) AS avg_sales FROM fact GROUP BY 1, 2"),
    ),
    "dataset_profile": (
        lambda s, d: p.dataset_profile(i.fact(s, d)),
        query(
            """SELECT count(*) AS row_count, 8 AS column_count, min(date) AS min_date, max(date) AS max_date, count(DISTINCT item_id) AS unique_items,
            count(DISTINCT store_id) AS unique_stores, count(DISTINCT cat_id) AS unique_categories FROM fact"""
        ),
    ),
    "category_list": (lambda s, d: p.category_list(i.fact(s, d)), query("SELECT DISTINCT cat_id FROM fact")),
    "count_distinct_keys": (
        lambda s, d: p.count_distinct_keys(i.fact(s, d)),
        query(
            """SELECT count(DISTINCT item_id) AS unique_items, count(DISTINCT store_id) AS unique_stores, count(DISTINCT dept_id) AS unique_depts,
            count(DISTINCT cat_id) AS unique_cats, count(DISTINCT state_id) AS unique_states FROM fact"""
        ),
    ),
}
