"""Replenishment maths per series: safety stock, reorder point, order quantity, risk."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.functions import as_column, stable_avg, stable_sum
from shelfline.operators.joins import attach_safety_stock
from shelfline.schemas import SERIES_KEY

# Service level -> z, and the z used for a level that is not listed.
Z_TABLE = {0.80: 0.84, 0.85: 1.04, 0.90: 1.28, 0.95: 1.65, 0.98: 2.05, 0.99: 2.33}
Z_DEFAULT = 1.65

SERVICE_LEVEL = 0.95
LEAD_TIME_DAYS = 7
STOCK_RATIO = 0.5
PRICE_ELASTICITY = -1.2
# A series without scenario demand is simulated with these.
DEFAULT_MEAN, DEFAULT_STD, STD_SHARE_OF_MEAN = 6.0, 1.2, 0.20


def z_score(service_level: float, method: str = "table") -> float:
    """z of a service level given as a fraction: the published table, or the exact normal quantile."""
    if method == "table":
        return Z_TABLE.get(service_level, Z_DEFAULT)
    if method == "quantile":
        return NormalDist().inv_cdf(service_level)
    raise ValueError(f"unknown method {method!r}")


def ceil(c) -> Column:
    return F.ceil(as_column(c)).cast("double")


def demand_stats(history: DataFrame) -> DataFrame:
    """Mean and sample deviation of recorded sales (no gap filling); deviation null for one row."""
    return history.groupBy(*SERIES_KEY).agg(
        F.avg("sales").alias("mean_sales"), F.stddev_samp("sales").alias("std_sales"), F.count("sales").alias("n_rows")
    )


def safety_stock(history: DataFrame, service_level: float = SERVICE_LEVEL, lead_time_days: int = LEAD_TIME_DAYS) -> DataFrame:
    z = z_score(service_level)
    spread = F.coalesce(F.col("std_sales"), F.lit(0.0))
    return demand_stats(history).select(
        *SERIES_KEY,
        F.bround("mean_sales", 2).alias("historical_mean_daily_sales"),
        F.bround("std_sales", 2).alias("historical_std_daily_sales"),
        F.lit(float(service_level)).alias("service_level_target"),
        F.lit(lead_time_days).alias("lead_time_days"),
        F.lit(float(z)).alias("z_score"),
        ceil(F.lit(float(z)) * spread * F.sqrt(F.lit(float(lead_time_days)))).alias("safety_stock"),
    )


def forecast_summary(forecast: DataFrame) -> DataFrame:
    return forecast.groupBy(*SERIES_KEY).agg(
        stable_sum("predicted_demand").alias("total_30d_forecast"), stable_avg("predicted_demand").alias("avg_daily_forecast")
    )


def reorder_point(summary: DataFrame, stock: DataFrame, lead_time_days: int = LEAD_TIME_DAYS) -> DataFrame:
    """Lead-time demand (2 decimals) plus safety stock, rounded up."""
    joined = attach_safety_stock(summary, stock)
    demand = F.bround(F.col("avg_daily_forecast") * lead_time_days, 2)
    return joined.withColumns({"lead_time_demand": demand, "reorder_point": ceil(demand + F.col("safety_stock"))})


def available_inventory(c="reorder_point", ratio: float = STOCK_RATIO) -> Column:
    return ceil(as_column(c) * ratio)


def order_quantity(policy: str = "cover_forecast") -> Column:
    """cover_forecast: forecast + safety stock - available; rop: up to the reorder point."""
    if policy == "cover_forecast":
        need = ceil(F.col("total_30d_forecast") + F.col("safety_stock") - F.col("available_inventory"))
    elif policy == "rop":
        need = F.col("reorder_point") - F.col("available_inventory")
    else:
        raise ValueError(f"unknown policy {policy!r}")
    return F.greatest(F.lit(0.0), need)


def risk_class(policy: str = "safety_stock") -> Column:
    """safety_stock: below it HIGH, below the reorder point MEDIUM. rop_band: below the reorder
    point HIGH, below 1.25 times it MEDIUM."""
    stock, rop = F.col("available_inventory"), F.col("reorder_point")
    if policy == "safety_stock":
        high, medium = F.col("safety_stock"), rop
    elif policy == "rop_band":
        high, medium = rop, rop * 1.25
    else:
        raise ValueError(f"unknown policy {policy!r}")
    return F.when(stock < high, "HIGH").when(stock < medium, "MEDIUM").otherwise("LOW")


def inventory_recommendations(
    forecast: DataFrame,
    history: DataFrame,
    service_level: float = SERVICE_LEVEL,
    lead_time_days: int = LEAD_TIME_DAYS,
    stock_ratio: float = STOCK_RATIO,
    quantity_policy: str = "cover_forecast",
    risk_policy: str = "safety_stock",
) -> DataFrame:
    """One recommendation per forecast series. Every row carries the latest forecast date overall
    and the forecast's model name, both read as scalars."""
    facts = forecast.agg(F.struct(F.max("forecast_date").alias("day"), F.min("model_used").alias("model"))).scalar()
    points = reorder_point(
        forecast_summary(forecast), safety_stock(history, service_level, lead_time_days).select(*SERIES_KEY, "safety_stock"), lead_time_days
    )
    stocked = points.withColumn("available_inventory", available_inventory(ratio=stock_ratio))
    return stocked.select(
        "item_id",
        "store_id",
        facts["day"].alias("forecast_date"),
        F.bround("total_30d_forecast", 2).alias("predicted_demand"),
        "safety_stock",
        "reorder_point",
        "available_inventory",
        order_quantity(quantity_policy).alias("recommended_order_quantity"),
        risk_class(risk_policy).alias("stockout_risk"),
        facts["model"].alias("model_used"),
    )


def price_scenario(forecast: DataFrame, price_change: float) -> DataFrame:
    """Forecast demand after a relative price change (0.10 = ten percent dearer)."""
    factor = 1.0 + PRICE_ELASTICITY * price_change
    return forecast.withColumn("predicted_demand", F.col("predicted_demand") * F.lit(factor))


def attach_scenario_stats(inventory: DataFrame, forecast: DataFrame) -> DataFrame:
    """Mean and deviation of scenario demand per series, with defaults where there is none."""
    stats = forecast.groupBy(*SERIES_KEY).agg(
        stable_avg("predicted_demand").alias("demand_mean"), F.stddev_samp("predicted_demand").alias("demand_std")
    )
    stats = stats.withColumn("demand_std", F.coalesce("demand_std", F.col("demand_mean") * STD_SHARE_OF_MEAN))
    return inventory.join(stats, SERIES_KEY, "left").withColumns(
        {"demand_mean": F.coalesce("demand_mean", F.lit(DEFAULT_MEAN)), "demand_std": F.coalesce("demand_std", F.lit(DEFAULT_STD))}
    )


def inventory_scenario(
    inventory: DataFrame,
    forecast: DataFrame,
    lead_time_days: int = LEAD_TIME_DAYS,
    service_level: float = SERVICE_LEVEL,
    stock_factor: float = 1.0,
) -> DataFrame:
    """What-if recomputation of an inventory table from scenario demand, in whole units."""
    derived = ["safety_stock", "reorder_point", "recommended_order_quantity", "stockout_risk"]
    base = attach_scenario_stats(inventory.drop(*derived), forecast)
    z = z_score(service_level, "quantile")

    def whole(c) -> Column:
        return F.bround(c, 0).cast("bigint")

    stocked = base.withColumn(
        "safety_stock", whole(F.lit(z) * F.col("demand_std") * F.sqrt(F.lit(float(lead_time_days))))
    ).withColumns(
        {
            "reorder_point": whole(F.col("demand_mean") * lead_time_days + F.col("safety_stock")),
            "available_inventory": whole(F.col("available_inventory") * stock_factor),
        }
    )
    short = F.col("reorder_point") - F.col("available_inventory")
    return stocked.withColumns(
        {"recommended_order_quantity": F.greatest(F.lit(0).cast("bigint"), short), "stockout_risk": risk_class("rop_band")}
    )
