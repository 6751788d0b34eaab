"""Cleaning, reshaping, joins and the daily, weekly and monthly models."""

from __future__ import annotations


from pyspark.sql import functions as F

from catalog import inputs as i
from catalog.sql import query
from shelfline.functions import clip_non_negative, coerce_numeric, outside_domain
from shelfline.operators import cleaning, forecasting, joins, keep, reshape, rollups
from shelfline.operators.quality import union_all
from shelfline.plans.layers import materialize_layers
from shelfline.schemas import ID_COLUMNS, PRICE_KEY
from shelfline.session import scratch_path
from shelfline.sources import tables


def _materialized_marts(spark, d):
    """The stored layers of a new dataset, summarised per mart and year through their views."""
    path = scratch_path(spark, "layers")
    dataset = f"shelf_{path.rsplit('-', 1)[1]}"
    tables.create_dataset(spark, dataset, path)
    layers = materialize_layers(spark, i.fact(spark, d), i.calendar(spark, d), dataset)
    frames = {"daily": layers.int_daily_sales, "weekly": layers.int_weekly_sales, "monthly": layers.int_monthly_sales}
    return union_all([
        df.groupBy(F.lit(name).alias("mart"), F.col("year").cast("int").alias("year")).agg(
            F.count(F.lit(1)).alias("row_count"), F.sum("sales" if name == "daily" else f"total_{name}_sales").alias("units")
        )
        for name, df in frames.items()
    ])


def _ffilled(spark, d):
    """Price known on the first days of a month only, carried over the rest of the series."""
    rows = i.series(spark, d).withColumn("known", F.when(F.dayofmonth("date") <= 3, F.col("sell_price")))
    return rows.select("store_id", "item_id", "date", reshape.ffill_bfill("known", ["store_id", "item_id"], ["date"]).alias("price"))


def _priced(spark, d):
    return joins.join_prices(joins.map_dates(i.long_cells(spark, d), i.calendar(spark, d)), i.prices(spark, d))


def _fact(spark, d):
    return joins.build_fact(i.wide(spark, d), i.calendar(spark, d), i.prices(spark, d))


def _coerced(spark, d):
    return i.raw_prices(spark, d).select("store_id", "item_id", "wm_yr_wk", "load_no", coerce_numeric("sell_price").alias("price"))


def _clipped(spark, d):
    return i.faulty_daily(spark, d).select("sales_date", "store_id", "item_id", clip_non_negative("sales").alias("units"))


def _domain(spark, d):
    return i.raw_calendar(spark, d).filter(outside_domain("event_type_1", ["Sporting", "Cultural", "National", "Religious"])).select("d", "event_type_1")


def _last_weeks(spark, d):
    return forecasting.time_split(i.fact(spark, d))[1].select("date", "store_id", "item_id", "sales")


_CAL_CLEAN = """SELECT TRY_CAST(date AS DATE) AS date, coalesce(TRY_CAST(wm_yr_wk AS BIGINT), 0) AS wm_yr_wk,
    CASE WHEN trim(weekday) NOT IN ('nan', 'None', '<NA>', '') THEN trim(weekday) END AS weekday,
    CAST(wday AS BIGINT) AS wday, CAST(month AS BIGINT) AS month, CAST(year AS BIGINT) AS year, d, event_name_1, event_type_1,
    event_name_2, event_type_2, CAST("snap_CA" AS BIGINT) AS "snap_CA", CAST("snap_TX" AS BIGINT) AS "snap_TX",
    CAST("snap_WI" AS BIGINT) AS "snap_WI" FROM raw_cal"""
_IDS = ", ".join(ID_COLUMNS)
_DIGEST = f"SELECT {_IDS}, count(*) AS cell_count, CAST(sum(%s) AS BIGINT) AS total, CAST(sum(%s * n) AS BIGINT) AS weighted_total FROM %s GROUP BY ALL"
_UNIT = "greatest(coalesce(TRY_CAST(cell AS BIGINT), 0), 0)"
_TRIMMED = ", ".join(f"trim({c}) AS {c}" for c in ID_COLUMNS)
_TOP = "SELECT store_id, item_id, CAST(sum(sales) AS BIGINT) AS total_sales FROM fact GROUP BY 1, 2 ORDER BY total_sales DESC, store_id, item_id LIMIT 10"

ENTRIES = {
    "stg_calendar": (lambda s, d: rollups.stg_calendar(i.calendar(s, d)), query("SELECT * FROM stg_cal")),
    "stg_sales": (lambda s, d: rollups.stg_sales(i.wide(s, d)), query("SELECT id AS series_id, item_id, dept_id, cat_id, store_id, state_id FROM ids")),
    "stg_sell_prices": (lambda s, d: rollups.stg_sell_prices(i.prices(s, d)), query("SELECT * FROM prices")),
    "clean_calendar": (lambda s, d: cleaning.clean_calendar(i.raw_calendar(s, d)), query(_CAL_CLEAN)),
    "clean_sales": (
        lambda s, d: i.wide_digest(cleaning.clean_sales(i.raw_sales(s, d))),
        query(_DIGEST % ("u", "u", "c"), c=f"SELECT {_TRIMMED}, n, {_UNIT} AS u FROM raw_cells"),
    ),
    "clean_prices": (
        lambda s, d: cleaning.clean_prices(i.raw_prices(s, d), tie_break=["load_no"]),
        query(
            """SELECT store_id, item_id, wm_yr_wk, sell_price FROM (SELECT *, row_number() OVER (
            PARTITION BY store_id, item_id, wm_yr_wk ORDER BY load_no, sell_price NULLS FIRST) AS rn FROM t) WHERE rn = 1""",
            t="""SELECT trim(store_id) AS store_id, trim(item_id) AS item_id, CAST(wm_yr_wk AS BIGINT) AS wm_yr_wk,
            TRY_CAST(sell_price AS DOUBLE) AS sell_price, load_no FROM raw_prices""",
        ),
    ),
    "coerce_numeric": (
        _coerced,
        query("SELECT store_id, item_id, wm_yr_wk, load_no, coalesce(TRY_CAST(sell_price AS DOUBLE), 0) AS price FROM raw_prices"),
    ),
    "clip_non_negative": (_clipped, query("SELECT sales_date, store_id, item_id, greatest(sales, 0) AS units FROM faulty_daily")),
    "is_in_domain": (
        _domain,
        query("SELECT d, event_type_1 FROM raw_cal WHERE event_type_1 NOT IN ('Sporting', 'Cultural', 'National', 'Religious')"),
    ),
    "date_bounds_filter": (
        _last_weeks,
        query("SELECT date, store_id, item_id, sales FROM fact WHERE date > (SELECT max(date) - 28 FROM fact)"),
    ),
    "hierarchy_alias": (
        lambda s, d: cleaning.hierarchy_alias(i.fact(s, d)),
        query("SELECT *, cat_id AS category, dept_id AS department FROM fact"),
    ),
    "pivot_days": (lambda s, d: i.wide_digest(i.wide(s, d)), query(_DIGEST % ("sales", "sales", "cells"))),
    "unpivot_days": (lambda s, d: reshape.unpivot_days(i.wide(s, d)), query(f"SELECT {_IDS}, d, sales FROM cells")),
    "wide_sales_total": (
        lambda s, d: reshape.wide_sales_total(i.raw_sales(s, d)),
        query(f"SELECT CAST(sum({_UNIT}) AS BIGINT) AS total_sales FROM raw_cells"),
    ),
    "gap_fill_dates": (
        lambda s, d: i.gap_filled(s, d).select("store_id", "item_id", "date", "sales", "sell_price", "state_id", "cat_id", "department", "day_id"),
        query(
            """SELECT f.store_id, f.item_id, f.date, f.sales, f.sell_price, f.state_id, f.cat_id, f.dept_id AS department,
            CASE WHEN original THEN c.d END AS day_id FROM filled f JOIN cal c ON f.date = c.date"""
        ),
    ),
    "ffill_bfill": (
        _ffilled,
        query(
            """SELECT store_id, item_id, date, coalesce(last_value(known IGNORE NULLS) OVER (PARTITION BY store_id, item_id ORDER BY date
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), first_value(known IGNORE NULLS) OVER (PARTITION BY store_id, item_id
            ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS price FROM k""",
            k="SELECT store_id, item_id, date, CASE WHEN extract(day FROM date) <= 3 THEN sell_price END AS known FROM series",
        ),
    ),
    "dedup_first": (
        lambda s, d: keep.dedup_first(i.raw_prices(s, d), PRICE_KEY, ["load_no", "sell_price"]),
        query(
            """SELECT store_id, item_id, wm_yr_wk, sell_price, load_no FROM (SELECT *, row_number() OVER (PARTITION BY store_id,
            item_id, wm_yr_wk ORDER BY load_no, sell_price NULLS FIRST) AS rn FROM raw_prices) WHERE rn = 1"""
        ),
    ),
    "map_dates": (
        lambda s, d: joins.map_dates(i.long_cells(s, d), i.calendar(s, d)),
        query(f"SELECT {_IDS}, d, sales, date, wm_yr_wk FROM cells"),
    ),
    "join_prices": (
        lambda s, d: _priced(s, d).select("id", "date", "wm_yr_wk", "sales", "sell_price"),
        query(
            """SELECT c.id, c.date, c.wm_yr_wk, c.sales, p.sell_price FROM cells c LEFT JOIN prices p
            ON c.store_id = p.store_id AND c.item_id = p.item_id AND c.wm_yr_wk = p.wm_yr_wk"""
        ),
    ),
    "fact_projection": (
        lambda s, d: joins.fact_projection(_priced(s, d).withColumn("source_week", F.col("wm_yr_wk"))),
        query(
            """SELECT c.date, c.item_id, dept_id, cat_id, c.store_id, state_id, c.sales, p.sell_price, c.wm_yr_wk AS source_week
            FROM cells c LEFT JOIN prices p ON c.store_id = p.store_id AND c.item_id = p.item_id AND c.wm_yr_wk = p.wm_yr_wk"""
        ),
    ),
    "build_fact": (
        _fact,
        query(
            """SELECT c.date, c.item_id, dept_id, cat_id, c.store_id, state_id, c.sales, p.sell_price
            FROM cells c LEFT JOIN prices p ON c.store_id = p.store_id AND c.item_id = p.item_id AND c.wm_yr_wk = p.wm_yr_wk"""
        ),
    ),
    "int_daily_sales": (i.daily, query("SELECT * FROM daily")),
    "weekly_sales": (lambda s, d: rollups.weekly_sales(i.daily(s, d)), query("SELECT * FROM weekly")),
    "monthly_sales": (lambda s, d: rollups.monthly_sales(i.daily(s, d)), query("SELECT * FROM monthly")),
    "mart_sales_forecasting": (i.mart, query("SELECT * FROM mart")),
    "materialize_layers": (
        _materialized_marts,
        query(
            """SELECT 'daily' AS mart, year, count(*) AS row_count, CAST(sum(sales) AS BIGINT) AS units FROM daily GROUP BY ALL UNION ALL
            SELECT 'weekly', year, count(*), CAST(sum(total_weekly_sales) AS BIGINT) FROM weekly GROUP BY ALL UNION ALL
            SELECT 'monthly', year, count(*), CAST(sum(total_monthly_sales) AS BIGINT) FROM monthly GROUP BY ALL"""
        ),
    ),
    "series_totals": (
        lambda s, d: keep.series_totals(i.fact(s, d)),
        query("SELECT store_id, item_id, CAST(sum(sales) AS BIGINT) AS total_sales FROM fact GROUP BY 1, 2"),
    ),
    "top_k_series": (lambda s, d: keep.top_k_series(i.fact(s, d), 10), query(_TOP)),
    "top_series_filter": (
        lambda s, d: keep.top_series_filter(i.fact(s, d), 10),
        query("SELECT f.* FROM fact f JOIN top ON f.store_id = top.store_id AND f.item_id = top.item_id", top=_TOP),
    ),
    "sample_rows": (
        lambda s, d: keep.sample_rows(rollups.stg_sales(i.wide(s, d)), 5, ["series_id"]),
        query("SELECT id AS series_id, item_id, dept_id, cat_id, store_id, state_id FROM ids ORDER BY id LIMIT 5"),
    ),
    "distinct_rows": (
        lambda s, d: keep.distinct_rows(i.mart(s, d), ["item_id", "store_id", "category"]),
        query("SELECT DISTINCT item_id, store_id, category FROM mart"),
    ),
    "union_all": (
        lambda s, d: i.fact(s, d).unionByName(i.series(s, d)).groupBy("store_id").agg(F.count(F.lit(1)).alias("row_count")),
        query("SELECT store_id, count(*) AS row_count FROM (SELECT * FROM fact UNION ALL SELECT * FROM series) GROUP BY 1"),
    ),
    "totals_cross_check": (
        lambda s, d: joins.totals_cross_check(
            i.faulty_daily(s, d).agg(F.sum("sales")), i.daily(s, d).agg(F.sum("sales")), "total_left", "total_right"
        ),
        query(
            """SELECT * FROM (SELECT CAST(sum(sales) AS BIGINT) AS total_left FROM faulty_daily),
            (SELECT CAST(sum(sales) AS BIGINT) AS total_right FROM daily) WHERE total_left <> total_right"""
        ),
    ),
    "sort_output": (
        lambda s, d: keep.sort_output(i.fact(s, d), ["date", "store_id", "item_id"]),
        query("SELECT * FROM fact"),
    ),
    "first_non_empty": (
        lambda s, d: tables.first_non_empty(
            [lambda: s.read.parquet(f"{d}/absent.parquet"), lambda: i.fact(s, d).filter(F.col("sales") < 0), lambda: i.fact(s, d)]
        ),
        query("SELECT * FROM fact"),
    ),
}

