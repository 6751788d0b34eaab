"""Descriptive statistics of the fact: sales, calendar and price profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.functions import is_weekend, money_avg, monday_zero, percent, round_half_up, to_number
from shelfline.operators import ranks
from shelfline.operators.keep import top_rows

# Labels of the two parts of the week.
WEEKEND_LABEL = "Weekend (Sat-Sun)"
WEEKDAY_LABEL = "Weekday (Mon-Fri)"


def _sales_by(df: DataFrame, key: str, mean_name: str = "avg_daily_sales") -> DataFrame:
    return df.groupBy(key).agg(
        F.sum("sales").alias("total_sales"), F.avg("sales").alias(mean_name), F.count("sales").alias("record_count")
    )


def daily_totals(df: DataFrame) -> DataFrame:
    return df.groupBy("date").agg(
        F.sum("sales").alias("total_sales"),
        F.avg("sales").alias("avg_sales"),
        F.min("sales").alias("min_sales"),
        F.max("sales").alias("max_sales"),
        F.count("sales").alias("record_count"),
    )


def sales_by_store(df: DataFrame) -> DataFrame:
    return _sales_by(df, "store_id").orderBy(F.desc("total_sales"), "store_id")


def sales_by_category(df: DataFrame) -> DataFrame:
    return _sales_by(df, "cat_id").orderBy(F.desc("total_sales"), "cat_id")


def sales_by_department(df: DataFrame) -> DataFrame:
    return _sales_by(df, "dept_id").orderBy(F.desc("total_sales"), "dept_id")


def item_totals(df: DataFrame) -> DataFrame:
    return df.groupBy("item_id").agg(
        F.sum("sales").alias("total_sales"),
        F.avg("sales").alias("avg_daily_sales"),
        F.min("sales").alias("min_daily_sales"),
        F.max("sales").alias("max_daily_sales"),
    )


def top_items(df: DataFrame, k: int = 5) -> DataFrame:
    return top_rows(item_totals(df), "total_sales", k, ["item_id"])


def bottom_items(df: DataFrame, k: int = 5) -> DataFrame:
    return top_rows(item_totals(df), "total_sales", k, ["item_id"], largest=False)


def sales_trend_summary(df: DataFrame) -> DataFrame:
    """First and last day with their totals, and the best day (the earliest on a tie)."""
    days = daily_totals(df).filter(F.col("date").isNotNull())
    # Rank by total, then by how early the day is.
    rank = F.struct(F.col("total_sales"), -F.datediff("date", F.lit("1970-01-01").cast("date")))
    return days.agg(
        F.min("date").alias("start_date"),
        F.max("date").alias("end_date"),
        F.min_by("total_sales", "date").alias("first_day_sales"),
        F.max_by("total_sales", "date").alias("last_day_sales"),
        F.max_by("date", rank).alias("peak_day_date"),
        F.max_by("total_sales", rank).alias("peak_day_sales"),
    )


def _calendar_part(df: DataFrame, name: str, part: Column) -> DataFrame:
    return df.groupBy(part.alias(name)).agg(
        F.sum("sales").alias("total_sales"), F.avg("sales").alias("avg_sales"), F.count("sales").alias("record_count")
    )


def sales_by_year(df: DataFrame) -> DataFrame:
    return _calendar_part(df, "year", F.year("date"))


def sales_by_month(df: DataFrame) -> DataFrame:
    return _calendar_part(df, "month", F.month("date"))


def sales_by_dow(df: DataFrame) -> DataFrame:
    """Monday first."""
    by_day = _calendar_part(df, "day_of_week", monday_zero("date"))
    # The name belongs to the number, so it is added after grouping (1970-01-05 was a Monday).
    name = F.date_format(F.date_add(F.lit("1970-01-05").cast("date"), F.col("day_of_week")), "EEEE")
    return by_day.select("day_of_week", name.alias("day_name"), "total_sales", "avg_sales", "record_count").orderBy("day_of_week")


def weekend_vs_weekday(df: DataFrame) -> DataFrame:
    parts = _calendar_part(df, "is_weekend", is_weekend("date"))
    label = F.when(F.col("is_weekend"), WEEKEND_LABEL).otherwise(WEEKDAY_LABEL)
    return parts.withColumnRenamed("avg_sales", "avg_daily_units").withColumn("period_type", label)


def exact_median(df: DataFrame, column: str) -> float | None:
    """Median of a numeric column; nulls and NaN are left out."""
    return ranks.median(df, F.col(column)).first().value


def price_stats(df: DataFrame) -> DataFrame:
    """One row of price statistics; NaN counts as missing, and no price at all gives nulls and 100 % missing."""
    price = to_number("sell_price")
    missing = F.count_if(price.isNull())
    return df.agg(
        round_half_up(money_avg(price), 2).alias("avg_price"),
        round_half_up(F.min(price), 2).alias("min_price"),
        round_half_up(F.max(price), 2).alias("max_price"),
        round_half_up(ranks.median(df, price).scalar(), 2).alias("median_price"),
        missing.alias("missing_count"),
        percent(missing, F.count(F.lit(1))).alias("missing_pct"),
    )


def price_by_category(df: DataFrame) -> DataFrame:
    return df.groupBy("cat_id").agg(
        money_avg("sell_price").alias("avg_price"), F.min("sell_price").alias("min_price"), F.max("sell_price").alias("max_price")
    )


def price_variation(df: DataFrame) -> DataFrame:
    return df.groupBy("item_id", "store_id").agg(
        money_avg("sell_price").alias("avg_price"),
        F.min("sell_price").alias("min_price"),
        F.max("sell_price").alias("max_price"),
        F.stddev_samp("sell_price").alias("std_price"),
        (F.max("sell_price") - F.min("sell_price")).alias("price_range"),
    )


def category_profile(df: DataFrame) -> DataFrame:
    return df.groupBy("cat_id").agg(
        F.sum("sales").alias("total_sales"),
        F.avg("sales").alias("avg_sales"),
        F.stddev_samp("sales").alias("std_sales"),
        F.max("sales").alias("max_sales"),
    )


def store_profile(df: DataFrame) -> DataFrame:
    return df.groupBy("store_id").agg(F.sum("sales").alias("total_sales"), F.avg("sales").alias("avg_sales"))


def zero_sales_ratio(df: DataFrame) -> DataFrame:
    zero = F.count_if(F.col("sales") == 0)
    return df.agg(zero.alias("zero_count"), percent(zero, F.count(F.lit(1))).alias("zero_pct"))


def price_profile(df: DataFrame) -> DataFrame:
    return df.groupBy("cat_id").agg(
        F.min("sell_price").alias("min_price"), money_avg("sell_price").alias("avg_price"), F.max("sell_price").alias("max_price")
    )


def dow_mean_profile(df: DataFrame) -> DataFrame:
    return sales_by_dow(df).select("day_of_week", "day_name", "avg_sales")


def dataset_profile(df: DataFrame) -> DataFrame:
    """Shape, date range and entity counts in one row.

    Rows are first reduced to entity tuples, so the distinct counts expand those and not the fact.
    """
    tuples = df.groupBy("item_id", "store_id", "cat_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("date").alias("lo"), F.max("date").alias("hi")
    )
    return tuples.agg(
        F.sum("n").alias("row_count"),
        F.lit(len(df.columns)).alias("column_count"),
        F.min("lo").alias("min_date"),
        F.max("hi").alias("max_date"),
        F.countDistinct("item_id").alias("unique_items"),
        F.countDistinct("store_id").alias("unique_stores"),
        F.countDistinct("cat_id").alias("unique_categories"),
    )


def category_list(df: DataFrame) -> DataFrame:
    return df.select("cat_id").filter(F.col("cat_id").isNotNull()).distinct().orderBy("cat_id")


def count_distinct_keys(df: DataFrame) -> DataFrame:
    """Distinct items, stores, departments, categories and states, nulls not counted.

    The key tuples are made distinct first, so the five counts expand a table of entities and
    not the fact.
    """
    names = {"item_id": "items", "store_id": "stores", "dept_id": "depts", "cat_id": "cats", "state_id": "states"}
    return df.select(*names).distinct().agg(*[F.countDistinct(c).alias(f"unique_{label}") for c, label in names.items()])
