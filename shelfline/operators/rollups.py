"""Daily, weekly and monthly models."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.functions import epoch_day, money_avg, round_half_up
from shelfline.schemas import SERIES_KEY

HIERARCHY = ["state_id", "store_id", "cat_id", "dept_id", "item_id"]


def stg_calendar(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("date").cast("date").alias("sales_date"),
        F.col("wm_yr_wk").cast("bigint"),
        F.col("weekday").cast("string"),
        F.col("wday").cast("int").alias("day_of_week"),
        F.col("month").cast("int"),
        F.col("year").cast("int"),
        F.col("d").cast("string").alias("day_id"),
        *[F.col(f"event_{kind}_{slot}").cast("string") for slot in (1, 2) for kind in ("name", "type")],
        *[F.col(f"snap_{state}").cast("int").alias(f"snap_{state.lower()}") for state in ("CA", "TX", "WI")],
    )


def stg_sales(df: DataFrame) -> DataFrame:
    others = ["item_id", "dept_id", "cat_id", "store_id", "state_id"]
    return df.select(F.col("id").cast("string").alias("series_id"), *[F.col(c).cast("string") for c in others])


def stg_sell_prices(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("store_id").cast("string"),
        F.col("item_id").cast("string"),
        F.col("wm_yr_wk").cast("bigint"),
        F.col("sell_price").cast("double"),
    )


def daily_sales(fact: DataFrame, calendar: DataFrame, series_parts: int | None = None) -> DataFrame:
    """Fact with its calendar columns; `calendar` is the staged one.

    `series_parts`: the rows of a series are brought together first, in so many tasks, while they are narrow;
    the calendar, at most a row for each day, is then broadcast, so they stay there."""
    sold = fact.select(
        F.col("date").cast("date").alias("sales_date"),
        *[F.col(c).cast("string") for c in HIERARCHY],
        F.col("sales").cast("bigint"),
        F.col("sell_price").cast("double"),
    )
    extra = [c for c in calendar.columns if c != "sales_date"]
    if series_parts:
        sold, calendar = sold.repartition(series_parts, *SERIES_KEY), F.broadcast(calendar)
    return sold.join(calendar, "sales_date", "left").select("sales_date", *HIERARCHY, "sales", "sell_price", *extra)


# Days of one word of bits; day numbers less than this apart own different bits.
WORD_DAYS = 64


def _figures(label: str, selling: Column, recorded: Column) -> list[Column]:
    price = F.col("sell_price")
    return [
        F.min("sales_date").alias(f"{label}_start_date"),
        F.max("sales_date").alias(f"{label}_end_date"),
        F.sum("sales").alias(f"total_{label}ly_sales"),
        round_half_up(money_avg(price), 4).alias("avg_sell_price"),
        F.min(price).alias("min_sell_price"),
        F.max(price).alias("max_sell_price"),
        F.coalesce(selling, F.lit(0)).cast("bigint").alias("selling_days"),
        F.coalesce(recorded, F.lit(0)).cast("bigint").alias("recorded_days"),
    ]


def _rollup(daily: DataFrame, period: list[str], label: str, together: bool) -> DataFrame:
    """Totals per period and series, one grouping and one shuffle of the rows as they are: a series has few
    rows in a period and they seldom lie together, so sums on the map side would be as many as the rows, but
    wider, and a task that reads a large file would hold them all. A task holds a shuffle partition's groups.
    Where the rows of a series are `together`, as in a table with buckets of series, they are sorted and grouped
    where they are, without a shuffle.

    Each day owns one bit of a 64-bit word, by its day number modulo 64, so distinct days are the bits
    set. That is exact where the days of a period lie less than 64 apart, as those of a week or month
    do. Periods that reach further (days without a calendar row share one null period) are found from
    their dates alone and counted by word and bit; without any, that branch is empty and never runs."""
    keys = [*period, *HIERARCHY]
    day = epoch_day("sales_date")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(day, F.lit(WORD_DAYS)).cast("int"))
    sold = F.when(F.col("sales") > 0, bit)

    spans = daily.groupBy(*[F.col(c).alias(f"_{c}") for c in period]).agg((F.max(day) - F.min(day)).alias("_span"))
    far = F.broadcast(spans.where(F.col("_span") >= WORD_DAYS))  # no more rows than the calendar has periods
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in period])
    rows = daily.join(far, same, "left_anti").select(*keys, "sales_date", "sales", "sell_price")
    figures = _figures(label, F.bit_count(F.bit_or(sold)), F.bit_count(F.bit_or(bit)))
    if together:
        order = ["year", *SERIES_KEY]  # as they are written
        order += [c for c in keys if c not in order]
        near = rows.sortWithinPartitions(*order).groupBy(*order).agg(*figures)
        near = near.select(*keys, *[c for c in near.columns if c not in keys])
    else:
        near = rows.repartition(*keys).groupBy(*keys).agg(*figures)

    reaching = daily.join(far, same, "left_semi")
    words = reaching.groupBy(*keys, F.floor(day / WORD_DAYS).alias("_word")).agg(F.bit_or(sold).alias("sold"), F.bit_or(bit).alias("seen"))
    counted = words.groupBy(*keys).agg(F.sum(F.bit_count("sold")).alias("_sold"), F.sum(F.bit_count("seen")).alias("_seen"))
    counted = counted.select(*[F.col(c).alias(f"_{c}") for c in keys], "_sold", "_seen")
    totals = reaching.groupBy(*keys).agg(*_figures(label, F.lit(0), F.lit(0)))
    match = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in keys])
    exact = {"selling_days": F.coalesce("_sold", F.lit(0)).cast("bigint"), "recorded_days": F.coalesce("_seen", F.lit(0)).cast("bigint")}
    return near.unionByName(totals.join(counted, match).select(*[exact.get(c, F.col(c)).alias(c) for c in near.columns]))


def weekly_sales(daily: DataFrame, together: bool = False) -> DataFrame:
    """Per week key, year and series; a week across a year end gives two rows."""
    return _rollup(daily, ["wm_yr_wk", "year"], "week", together)


def monthly_sales(daily: DataFrame, together: bool = False) -> DataFrame:
    return _rollup(daily, ["year", "month"], "month", together)


def mart_sales_forecasting(daily: DataFrame) -> DataFrame:
    """The table the models read: the daily model with its documented alias columns."""
    tail = [c for c in daily.columns if c not in ("sales_date", *HIERARCHY)]
    return daily.select(
        F.col("sales_date").alias("date"),
        "sales_date",
        "item_id",
        "store_id",
        "state_id",
        F.col("cat_id").alias("category"),
        "cat_id",
        F.col("dept_id").alias("department"),
        "dept_id",
        *tail,
    )
