"""Queries behind the planning screens: filters, key figures, and daily or category totals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.functions import round_half_up, stable_avg, stable_sum

# Columns of the exported plan.
PLAN_COLUMNS = [
    "item_id",
    "store_id",
    "safety_stock",
    "reorder_point",
    "available_inventory",
    "recommended_order_quantity",
    "stockout_risk",
]


def slice_filter(df: DataFrame, store: str | None = None, category: str | None = None, item: str | None = None) -> DataFrame:
    """Equality filters that are set; a filter on a column the table lacks is ignored."""
    for name, value in (("store_id", store), ("category", category), ("item_id", item)):
        if value is not None and name in df.columns:
            df = df.filter(F.col(name) == value)
    return df


def filter_options(df: DataFrame, store: str | None = None, category: str | None = None) -> DataFrame:
    """Choices for the three filters, each narrowed by the picks before it: (filter, value)."""
    in_store = slice_filter(df, store=store)
    in_category = slice_filter(in_store, category=category)

    def choices(name: str, rows: DataFrame) -> DataFrame:
        return rows.select(F.lit(name).alias("filter"), F.col(name).alias("value")).filter(F.col("value").isNotNull()).distinct()

    options = choices("store_id", df)
    if "category" in df.columns:
        options = options.unionByName(choices("category", in_store))
    return options.unionByName(choices("item_id", in_category)).orderBy("filter", "value")


def daily_history(history: DataFrame) -> DataFrame:
    return history.groupBy("date").agg(F.sum("sales").alias("sales"))


def daily_forecast(forecast: DataFrame) -> DataFrame:
    return forecast.groupBy("forecast_date").agg(round_half_up(stable_sum("predicted_demand"), 2).alias("projected_demand"))


def demand_by_category(forecast: DataFrame) -> DataFrame:
    return forecast.groupBy("category").agg(stable_sum("predicted_demand").alias("predicted_demand"))


def risk_counts(inventory: DataFrame) -> DataFrame:
    return inventory.groupBy("stockout_risk").agg(F.count(F.lit(1)).alias("item_count"))


def kpi_summary(forecast: DataFrame, inventory: DataFrame) -> DataFrame:
    """Total forecast, mean of the daily totals, series at high risk and units to order.

    The two one-row results meet in a union that is summed, not in a product.
    """
    days = forecast.groupBy("forecast_date").agg(stable_sum("predicted_demand").alias("day_total"))
    none = F.lit(None)
    demand = days.agg(stable_sum("day_total").alias("total_forecast"), stable_avg("day_total").alias("avg_daily_forecast")).select(
        "*", none.cast("bigint").alias("high_risk_count"), none.cast("double").alias("total_order_quantity")
    )
    stock = inventory.agg(
        F.count_if(F.col("stockout_risk") == "HIGH").alias("high_risk_count"),
        F.sum("recommended_order_quantity").cast("double").alias("total_order_quantity"),
    ).select(none.cast("double").alias("total_forecast"), none.cast("double").alias("avg_daily_forecast"), "*")
    both = demand.unionByName(stock)
    return both.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in both.columns])


def replenishment_plan(inventory: DataFrame) -> DataFrame:
    return inventory.select(*[c for c in PLAN_COLUMNS if c in inventory.columns])
