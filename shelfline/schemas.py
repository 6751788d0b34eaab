"""Declared table shapes."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names and types of the inputs and of the stored tables.
SERIES_KEY = ["store_id", "item_id"]
PRICE_KEY = ["store_id", "item_id", "wm_yr_wk"]
FACT_KEY = ["date", "item_id", "store_id"]
ID_COLUMNS = ["id", "item_id", "dept_id", "cat_id", "store_id", "state_id"]
DAY_PREFIX = "d_"

CALENDAR = T.StructType(
    [
        T.StructField("date", T.StringType()),
        T.StructField("wm_yr_wk", T.LongType()),
        T.StructField("weekday", T.StringType()),
        T.StructField("wday", T.LongType()),
        T.StructField("month", T.LongType()),
        T.StructField("year", T.LongType()),
        T.StructField("d", T.StringType()),
        T.StructField("event_name_1", T.StringType()),
        T.StructField("event_type_1", T.StringType()),
        T.StructField("event_name_2", T.StringType()),
        T.StructField("event_type_2", T.StringType()),
        T.StructField("snap_CA", T.LongType()),
        T.StructField("snap_TX", T.LongType()),
        T.StructField("snap_WI", T.LongType()),
    ]
)

PRICES = T.StructType(
    [
        T.StructField("store_id", T.StringType()),
        T.StructField("item_id", T.StringType()),
        T.StructField("wm_yr_wk", T.LongType()),
        T.StructField("sell_price", T.DoubleType()),
    ]
)

FACT = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("item_id", T.StringType()),
        T.StructField("dept_id", T.StringType()),
        T.StructField("cat_id", T.StringType()),
        T.StructField("store_id", T.StringType()),
        T.StructField("state_id", T.StringType()),
        T.StructField("sales", T.LongType()),
        T.StructField("sell_price", T.DoubleType()),
    ]
)

_MART_TEXTS = ["item_id", "store_id", "state_id", "category", "cat_id", "department", "dept_id"]
_EVENTS = [f"event_{kind}_{slot}" for slot in (1, 2) for kind in ("name", "type")]
MART = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("sales_date", T.DateType()),
        *[T.StructField(c, T.StringType()) for c in _MART_TEXTS],
        T.StructField("sales", T.LongType()),
        T.StructField("sell_price", T.DoubleType()),
        T.StructField("wm_yr_wk", T.LongType()),
        T.StructField("weekday", T.StringType()),
        *[T.StructField(c, T.IntegerType()) for c in ("day_of_week", "month", "year")],
        T.StructField("day_id", T.StringType()),
        *[T.StructField(c, T.StringType()) for c in _EVENTS],
        *[T.StructField(c, T.IntegerType()) for c in ("snap_ca", "snap_tx", "snap_wi")],
    ]
)

FORECAST = T.StructType(
    [
        T.StructField("forecast_date", T.DateType()),
        T.StructField("item_id", T.StringType()),
        T.StructField("store_id", T.StringType()),
        T.StructField("predicted_demand", T.DoubleType()),
        T.StructField("model_used", T.StringType()),
    ]
)

METRICS = T.StructType(
    [
        T.StructField("model", T.StringType()),
        T.StructField("mae", T.DoubleType()),
        T.StructField("rmse", T.DoubleType()),
        T.StructField("smape", T.DoubleType()),
        T.StructField("is_best_model", T.BooleanType()),
    ]
)

RECOMMENDATIONS = T.StructType(
    [
        T.StructField("item_id", T.StringType()),
        T.StructField("store_id", T.StringType()),
        T.StructField("forecast_date", T.DateType()),
        T.StructField("predicted_demand", T.DoubleType()),
        T.StructField("safety_stock", T.DoubleType()),
        T.StructField("reorder_point", T.DoubleType()),
        T.StructField("available_inventory", T.DoubleType()),
        T.StructField("recommended_order_quantity", T.DoubleType()),
        T.StructField("stockout_risk", T.StringType()),
        T.StructField("model_used", T.StringType()),
    ]
)

# Columns each raw input must carry before a fact can be built from it.
REQUIRED = {
    "calendar": {"date", "wm_yr_wk", "d"},
    "sales": {"item_id", "dept_id", "cat_id", "store_id", "state_id"},
    "prices": {"store_id", "item_id", "wm_yr_wk", "sell_price"},
}


def sales_wide(day_columns: list[str]) -> T.StructType:
    """Schema of the wide sales file for a given list of day columns; cells are text in the file."""
    return T.StructType([T.StructField(name, T.StringType()) for name in [*ID_COLUMNS, *day_columns]])


def require_columns(df, table: str) -> None:
    """Raise before any plan runs when a mandatory column is absent."""
    missing = REQUIRED[table] - set(df.columns)
    if missing:
        raise ValueError(f"{table}: missing columns {sorted(missing)}")


def day_columns(df) -> list[str]:
    return [name for name in df.columns if name.startswith(DAY_PREFIX)]


def column_list(names: list[str]) -> str:
    """Quoted column names for SQL text. Thousands of day columns are far quicker to plan from one
    string than from as many Column objects."""
    return ", ".join(f"`{name}`" for name in names)
