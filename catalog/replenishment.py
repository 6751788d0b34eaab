"""Replenishment and serving queries, on the additive forecast of the dense series."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import functions as F

from catalog import inputs as i
from catalog.sql import query, rnd, stable_avg, stable_sum
from shelfline.operators import inventory as inv, joins, serving as sv

_Z98 = repr(NormalDist().inv_cdf(0.98))
_STATS_SQL = f"SELECT store_id, item_id, {stable_avg('predicted_demand')} AS m, stddev_samp(predicted_demand) AS sd FROM %s GROUP BY 1, 2"
_RISE = "SELECT * REPLACE (predicted_demand * (1e0 + -1.2e0 * 0.1e0) AS predicted_demand) FROM forecast"


def _plan(spark, d, **settings):
    return inv.inventory_recommendations(i.forecast(spark, d), i.series(spark, d), **settings)


def _points(spark, d):
    stock = inv.safety_stock(i.series(spark, d)).select("store_id", "item_id", "safety_stock")
    return inv.reorder_point(inv.forecast_summary(i.forecast(spark, d)), stock)


def _scenario(spark, d):
    demand = inv.price_scenario(i.forecast(spark, d), 0.10)
    return inv.inventory_scenario(_plan(spark, d), demand, lead_time_days=14, service_level=0.98, stock_factor=1.5)


def _with_category(spark, d):
    return joins.attach_category(i.forecast(spark, d), i.series_mart(spark, d))


def _policies(spark, d):
    rows = _points(spark, d).withColumn("available_inventory", inv.available_inventory())
    return rows.select(
        "store_id",
        "item_id",
        inv.order_quantity("cover_forecast").alias("cover_quantity"),
        inv.order_quantity("rop").alias("rop_quantity"),
    )


def _risks(spark, d):
    """Both rules, at four stock levels, so every class occurs."""
    rows = _points(spark, d)
    levels = rows.withColumn("ratio", F.explode(F.array(*[F.lit(x) for x in (0.2, 0.5, 1.1, 1.5)])))
    stocked = levels.withColumn("available_inventory", F.ceil(F.col("reorder_point") * F.col("ratio")).cast("double"))
    return stocked.select("store_id", "item_id", "ratio", inv.risk_class("safety_stock").alias("stock_risk"), inv.risk_class("rop_band").alias("band_risk"))


_SCENARIO = f"""SELECT p.item_id, p.store_id, p.forecast_date, p.predicted_demand, p.model_used, coalesce(t.m, 6e0) AS demand_mean,
    coalesce(t.sd, t.m * 0.2e0, 1.2e0) AS demand_std, CAST(round_even(CAST({_Z98} AS DOUBLE) * coalesce(t.sd, t.m * 0.2e0, 1.2e0) * sqrt(14), 0) AS BIGINT) AS ss,
    CAST(round_even(available_inventory * 1.5e0, 0) AS BIGINT) AS avail FROM plan p LEFT JOIN t ON t.store_id = p.store_id AND t.item_id = p.item_id"""
_SCENARIO_ROP = "SELECT *, CAST(round_even(demand_mean * 14 + ss, 0) AS BIGINT) AS rop FROM u"

ENTRIES = {
    "demand_stats": (
        lambda s, d: i.rounded(inv.demand_stats(i.fact(s, d)), 2),
        query(
            f"""SELECT store_id, item_id, {rnd('avg(sales)', 2)} AS mean_sales, {rnd('stddev_samp(sales)', 2)} AS std_sales, count(sales) AS n_rows
            FROM fact GROUP BY 1, 2"""
        ),
    ),
    "safety_stock": (
        lambda s, d: inv.safety_stock(i.fact(s, d)).select("store_id", "item_id", "z_score", "lead_time_days", "safety_stock"),
        query(
            """SELECT store_id, item_id, CAST(1.65 AS DOUBLE) AS z_score, 7 AS lead_time_days,
            ceil(CAST(1.65 AS DOUBLE) * coalesce(stddev_samp(sales), 0) * sqrt(7)) AS safety_stock FROM fact GROUP BY 1, 2"""
        ),
    ),
    "forecast_summary": (
        lambda s, d: i.rounded(inv.forecast_summary(i.forecast(s, d))),
        query(f"SELECT store_id, item_id, {rnd('total_30d_forecast', 4)} AS total_30d_forecast, {rnd('avg_daily_forecast', 4)} AS avg_daily_forecast FROM summary"),
    ),
    "attach_safety_stock": (
        lambda s, d: joins.attach_safety_stock(
            inv.forecast_summary(i.forecast(s, d)).select("store_id", "item_id"),
            inv.safety_stock(i.series(s, d)).filter(F.col("safety_stock") > 100).select("store_id", "item_id", "safety_stock"),
        ),
        query(
            """SELECT m.store_id, m.item_id, coalesce(k.safety_stock, 0) AS safety_stock FROM summary m
            LEFT JOIN (SELECT * FROM stock WHERE safety_stock > 100) k ON m.store_id = k.store_id AND m.item_id = k.item_id"""
        ),
    ),
    "reorder_point": (
        lambda s, d: _points(s, d).select("store_id", "item_id", "safety_stock", "lead_time_demand", "reorder_point"),
        query("SELECT store_id, item_id, safety_stock, lead_time_demand, reorder_point FROM points"),
    ),
    "available_inventory": (
        lambda s, d: _points(s, d).select("store_id", "item_id", inv.available_inventory().alias("available_inventory")),
        query("SELECT store_id, item_id, ceil(reorder_point * CAST(0.5 AS DOUBLE)) AS available_inventory FROM points"),
    ),
    "order_quantity": (
        _policies,
        query(
            """SELECT store_id, item_id, greatest(0, ceil(total_30d_forecast + safety_stock - ceil(reorder_point * CAST(0.5 AS DOUBLE)))) AS cover_quantity,
            greatest(0, reorder_point - ceil(reorder_point * CAST(0.5 AS DOUBLE))) AS rop_quantity FROM points"""
        ),
    ),
    "risk_class": (
        _risks,
        query(
            """SELECT store_id, item_id, ratio,
            CASE WHEN stock < safety_stock THEN 'HIGH' WHEN stock < reorder_point THEN 'MEDIUM' ELSE 'LOW' END AS stock_risk,
            CASE WHEN stock < reorder_point THEN 'HIGH' WHEN stock < reorder_point * 1.25e0 THEN 'MEDIUM' ELSE 'LOW' END AS band_risk
            FROM (SELECT *, ceil(reorder_point * ratio) AS stock FROM points, (SELECT CAST(unnest([0.2, 0.5, 1.1, 1.5]) AS DOUBLE) AS ratio))"""
        ),
    ),
    "inventory_recommendations": (_plan, query("SELECT * FROM plan")),
    "price_scenario": (
        lambda s, d: i.rounded(inv.price_scenario(i.forecast(s, d), 0.10)),
        query(
            f"""SELECT forecast_date, item_id, store_id, {rnd('predicted_demand * (1e0 + -1.2e0 * 0.1e0)', 4)} AS predicted_demand, model_used
            FROM forecast"""
        ),
    ),
    "attach_scenario_stats": (
        lambda s, d: i.rounded(
            joins_scenario(s, d).select("store_id", "item_id", "demand_mean", "demand_std")
        ),
        query(
            f"""SELECT p.store_id, p.item_id, {rnd('coalesce(t.m, 6e0)', 4)} AS demand_mean, {rnd('coalesce(t.sd, t.m * 0.2e0, 1.2e0)', 4)} AS demand_std
            FROM plan p LEFT JOIN t ON t.store_id = p.store_id AND t.item_id = p.item_id""",
            t=_STATS_SQL % "(SELECT * FROM forecast WHERE store_id <> 'ASIA')",
        ),
    ),
    "inventory_scenario": (
        lambda s, d: i.rounded(_scenario(s, d), 4, ["demand_mean", "demand_std"]),
        query(
            f"""SELECT store_id, item_id, forecast_date, predicted_demand, avail AS available_inventory, model_used, {rnd('demand_mean', 4)} AS demand_mean,
            {rnd('demand_std', 4)} AS demand_std, ss AS safety_stock, rop AS reorder_point, greatest(0, rop - avail) AS recommended_order_quantity,
            CASE WHEN avail < rop THEN 'HIGH' WHEN avail < rop * 1.25e0 THEN 'MEDIUM' ELSE 'LOW' END AS stockout_risk FROM w""",
            rise=_RISE,
            t=_STATS_SQL % "rise",
            u=_SCENARIO,
            w=_SCENARIO_ROP,
        ),
    ),
    "slice_filter": (
        lambda s, d: sv.slice_filter(i.mart(s, d), store="NATION_20", category="ECONOMY").select("date", "store_id", "item_id", "category", "sales"),
        query("SELECT date, store_id, item_id, category, sales FROM mart WHERE store_id = 'NATION_20' AND category = 'ECONOMY'"),
    ),
    "filter_options": (
        lambda s, d: sv.filter_options(i.mart(s, d), store="NATION_20", category="ECONOMY"),
        query(
            """SELECT DISTINCT 'store_id' AS filter, store_id AS value FROM mart UNION ALL
            SELECT DISTINCT 'category', category FROM mart WHERE store_id = 'NATION_20' UNION ALL
            SELECT DISTINCT 'item_id', item_id FROM mart WHERE store_id = 'NATION_20' AND category = 'ECONOMY'"""
        ),
    ),
    "attach_category": (
        _with_category,
        query("SELECT f.*, s.cat_id AS category FROM forecast f LEFT JOIN (SELECT DISTINCT item_id, store_id, cat_id FROM series) s ON f.item_id = s.item_id AND f.store_id = s.store_id"),
    ),
    "kpi_summary": (
        lambda s, d: i.rounded(sv.kpi_summary(i.forecast(s, d), _plan(s, d)), 2),
        query(
            f"""SELECT (SELECT {rnd(stable_sum('predicted_demand'), 2)} FROM forecast) AS total_forecast,
            (SELECT {rnd(stable_avg('t'), 2)} FROM (SELECT {stable_sum('predicted_demand')} AS t FROM forecast GROUP BY forecast_date)) AS avg_daily_forecast,
            (SELECT count(*) FROM plan WHERE stockout_risk = 'HIGH') AS high_risk_count,
            (SELECT {rnd('sum(recommended_order_quantity)', 2)} FROM plan) AS total_order_quantity"""
        ),
    ),
    "daily_history": (
        lambda s, d: sv.daily_history(i.mart(s, d)),
        query("SELECT date, CAST(sum(sales) AS BIGINT) AS sales FROM mart GROUP BY 1"),
    ),
    "daily_forecast": (
        lambda s, d: sv.daily_forecast(i.forecast(s, d)),
        query(f"SELECT forecast_date, {rnd(stable_sum('predicted_demand'), 2)} AS projected_demand FROM forecast GROUP BY 1"),
    ),
    "demand_by_category": (
        lambda s, d: i.rounded(sv.demand_by_category(_with_category(s, d))),
        query(
            f"""SELECT s.cat_id AS category, {rnd(stable_sum('predicted_demand'), 4)} AS predicted_demand FROM forecast f
            JOIN (SELECT DISTINCT item_id, store_id, cat_id FROM series) s ON f.item_id = s.item_id AND f.store_id = s.store_id GROUP BY 1"""
        ),
    ),
    "risk_counts": (
        lambda s, d: sv.risk_counts(_plan(s, d)),
        query("SELECT stockout_risk, count(*) AS item_count FROM plan GROUP BY 1"),
    ),
    "replenishment_plan": (
        lambda s, d: sv.replenishment_plan(_plan(s, d)),
        query(
            """SELECT item_id, store_id, safety_stock, reorder_point, available_inventory, recommended_order_quantity, stockout_risk FROM plan"""
        ),
    ),
}


def joins_scenario(spark, d):
    """Scenario demand is missing for one region, so the defaults are used there."""
    return inv.attach_scenario_stats(_plan(spark, d), i.forecast(spark, d).filter(F.col("store_id") != "ASIA"))
