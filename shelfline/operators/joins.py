"""Joins that build and enrich the fact. All are equi-joins; join strategy is left to the
optimizer, which broadcasts a side only when its measured size is below the session threshold
and otherwise shuffles, splitting skewed partitions at run time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.functions import coerce_long, to_number
from shelfline.operators.cleaning import parse_date
from shelfline.operators.reshape import unpivot_days
from shelfline.schemas import PRICE_KEY, SERIES_KEY, require_columns

FACT_COLUMNS = ["date", "item_id", "dept_id", "cat_id", "store_id", "state_id", "sales", "sell_price"]
JOIN_ONLY = ["id", "d", "wm_yr_wk"]


def map_dates(long: DataFrame, calendar: DataFrame) -> DataFrame:
    """Date and week key of each day id; the week key of an unknown day is 0."""
    # Keys are read as numbers in the calendar, so only the null of an unknown day is left to the rows.
    cal = calendar.select("d", parse_date("date").alias("date"), coerce_long("wm_yr_wk").alias("wm_yr_wk"))
    return long.join(cal, "d", "left").withColumn("wm_yr_wk", F.coalesce("wm_yr_wk", F.lit(0).cast("bigint")))


def join_prices(dated: DataFrame, prices: DataFrame) -> DataFrame:
    """Weekly price per row; a week without price stays null."""
    keyed = prices.select(*PRICE_KEY, to_number("sell_price").alias("sell_price"))
    return dated.join(keyed, PRICE_KEY, "left")


def fact_projection(df: DataFrame) -> DataFrame:
    """The fact columns in order, then any extra column that is not a join helper."""
    first = [c for c in FACT_COLUMNS if c in df.columns]
    return df.select(*first, *[c for c in df.columns if c not in first and c not in JOIN_ONLY])


def build_fact(sales: DataFrame, calendar: DataFrame, prices: DataFrame) -> DataFrame:
    for name, df in (("sales", sales), ("calendar", calendar), ("prices", prices)):
        require_columns(df, name)
    return fact_projection(join_prices(map_dates(unpivot_days(sales), calendar), prices))


def attach_actuals(actuals: DataFrame, predictions: DataFrame) -> DataFrame:
    """Held-out rows with their prediction, null where none was made."""
    keys = [*SERIES_KEY, "date"]
    return actuals.select(*keys, F.col("sales").alias("actual")).join(
        predictions.select(*keys, "predicted_demand"), keys, "left"
    )


def series_pairing(train: DataFrame, validation: DataFrame) -> DataFrame:
    """Series present on both sides of the split, with their row counts."""
    left = train.groupBy(*SERIES_KEY).agg(F.count(F.lit(1)).alias("train_rows"))
    right = validation.groupBy(*SERIES_KEY).agg(F.count(F.lit(1)).alias("validation_rows"))
    return left.join(right, SERIES_KEY)


def attach_safety_stock(summary: DataFrame, stock: DataFrame) -> DataFrame:
    joined = summary.join(stock, SERIES_KEY, "left")
    return joined.withColumn("safety_stock", F.coalesce("safety_stock", F.lit(0.0)))


def attach_category(df: DataFrame, history: DataFrame) -> DataFrame:
    """Category of each series, looked up in the sales history."""
    meta = history.select("item_id", "store_id", "category").distinct()
    return df.join(meta, ["item_id", "store_id"], "left")


def totals_cross_check(left: DataFrame, right: DataFrame, left_name: str, right_name: str) -> DataFrame:
    """One row when two single-value totals differ, none when they agree.

    Both totals travel through a union and one aggregate, so no product of tables is formed.
    """
    side = left.select(F.col(left.columns[0]).alias(left_name), F.lit(None).cast("bigint").alias(right_name)).unionByName(
        right.select(F.lit(None).cast("bigint").alias(left_name), F.col(right.columns[0]).alias(right_name))
    )
    return side.agg(F.max(left_name).alias(left_name), F.max(right_name).alias(right_name)).filter(
        F.col(left_name) != F.col(right_name)
    )
