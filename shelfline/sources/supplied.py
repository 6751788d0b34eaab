"""The supplied order tables seen as retail data.

`daily_fact`   one row per part, nation and ship date (fine grain).
`daily_series` one row per part type, region and ship date (dense grain, used for forecasting).

Grouping is done on integer keys and names are joined to the sums. A part that owns a third of all
line items does not skew the fine grain, because its line items are summed per nation and day
before the part table is joined; in the dense grain the join on parts is an inner equi-join, whose
skewed partitions are split at run time, and the sum behind it combines on the map side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.functions import round_half_up
from shelfline.operators.keep import dedup_first
from shelfline.schemas import ID_COLUMNS, PRICE_KEY

# Fixed values of the derived calendar: (month-day, event, type) for the two event slots.
EVENTS_1 = [
    ("02-14", "ValentinesDay", "Cultural"),
    ("07-04", "IndependenceDay", "National"),
    ("10-31", "Halloween", "Cultural"),
    ("12-25", "Christmas", "National"),
]
EVENTS_2 = [("01-07", "OrthodoxChristmas", "Religious"), ("02-14", "CupFinal", "Sporting")]
FIRST_WEEK_KEY = 11101
FIRST_WEEK_START = "1994-12-31"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their supplier's nation; money as whole cents, so sums are exact."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_partkey",
        "l_suppkey",
        F.to_date("l_shipdate").alias("date"),
        "l_quantity",
        F.floor(F.col("l_extendedprice") * 100 + F.lit(0.5)).alias("cents"),
    )
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    return lines.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))


def _sums() -> list:
    return [F.sum("l_quantity").alias("quantity"), F.sum("cents").alias("cents")]


def _measures() -> list:
    unit = F.try_divide(F.col("cents").cast("double") / F.lit(100.0), F.col("quantity"))
    return [F.col("quantity").cast("bigint").alias("sales"), round_half_up(unit, 2).alias("sell_price")]


def daily_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    sold = _lines(spark, sf_dir).groupBy("l_partkey", "s_nationkey", "date").agg(*_sums())
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    nation = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    named = sold.join(part, F.col("l_partkey") == F.col("p_partkey")).join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    return named.select(
        "date",
        F.col("p_partkey").cast("string").alias("item_id"),
        F.col("p_brand").alias("dept_id"),
        F.col("p_type").alias("cat_id"),
        F.col("n_name").alias("store_id"),
        F.col("r_name").alias("state_id"),
        *_measures(),
    )


def daily_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    sold = (
        _lines(spark, sf_dir)
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("p_type", "n_regionkey", "date")
        .agg(*_sums())
    )
    kind, region = F.col("p_type"), F.col("r_name")
    return sold.join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(
        "date",
        kind.alias("item_id"),
        kind.alias("dept_id"),
        kind.alias("cat_id"),
        region.alias("store_id"),
        region.alias("state_id"),
        *_measures(),
    )


def _event(slot: list[tuple[str, str, str]], position: int):
    month_day = F.date_format("date", "MM-dd")
    value = F.lit(None).cast("string")
    for row in slot:
        value = F.when(month_day == row[0], row[position]).otherwise(value)
    return value


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per day between the first and last ship date, dates as DATE.

    Its size is at most the number of days a DATE can hold, so the optimizer's own broadcast
    of it is safe at any data volume.
    """
    ship = F.to_date("l_shipdate")
    span = table(spark, sf_dir, "lineitem").agg(F.min(ship).alias("lo"), F.max(ship).alias("hi"))
    lo, hi = span.select("lo").scalar(), span.select("hi").scalar()
    days = spark.range(1).select(lo.alias("lo"), F.explode(F.sequence(lo, hi)).alias("date"))
    dom = F.dayofmonth("date")
    return days.select(
        "date",
        (F.lit(FIRST_WEEK_KEY) + F.floor(F.datediff("date", F.lit(FIRST_WEEK_START).cast("date")) / 7)).cast("bigint").alias("wm_yr_wk"),
        F.date_format("date", "EEEE").alias("weekday"),
        (F.pmod(F.weekday("date") + 2, F.lit(7)) + 1).cast("bigint").alias("wday"),
        F.month("date").cast("bigint").alias("month"),
        F.year("date").cast("bigint").alias("year"),
        F.concat(F.lit("d_"), (F.datediff("date", "lo") + 1).cast("string")).alias("d"),
        _event(EVENTS_1, 1).alias("event_name_1"),
        _event(EVENTS_1, 2).alias("event_type_1"),
        _event(EVENTS_2, 1).alias("event_name_2"),
        _event(EVENTS_2, 2).alias("event_type_2"),
        (dom <= 10).cast("bigint").alias("snap_CA"),
        ((dom <= 15) & (dom % 2 == 1)).cast("bigint").alias("snap_TX"),
        ((dom <= 16) & (dom % 2 == 0)).cast("bigint").alias("snap_WI"),
    )


def prices(daily: DataFrame, cal: DataFrame) -> DataFrame:
    """Weekly price per store and item: the price of the first selling day of the week."""
    keyed = daily.join(cal.select("date", "wm_yr_wk"), "date").select(*PRICE_KEY, "date", "sell_price")
    return dedup_first(keyed, PRICE_KEY, ["date", "sell_price"]).select(*PRICE_KEY, "sell_price")


def wide_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per series with a column for every day of the calendar, missing days 0."""
    from shelfline.operators.reshape import pivot_days

    series = daily_series(spark, sf_dir)
    span = table(spark, sf_dir, "lineitem").agg(
        F.min(F.to_date("l_shipdate")).alias("lo"), F.max(F.to_date("l_shipdate")).alias("hi")
    )
    bounds = span.first()
    names = [f"d_{n + 1}" for n in range((bounds.hi - bounds.lo).days + 1)]
    long = series.select(
        F.concat_ws("_", "item_id", "store_id").alias("id"),
        *ID_COLUMNS[1:],
        F.concat(F.lit("d_"), (F.datediff("date", F.lit(bounds.lo)) + 1).cast("string")).alias("d"),
        "sales",
    )
    return pivot_days(long, ID_COLUMNS, names)
