"""Inputs of the registered queries, all derived by Spark from the supplied tables.

The tables that a run keeps in its warehouse (fact, calendar, mart, wide sales, features) are
written once per application to the shared folder; queries read those copies. Everything behind
a stored table is computed from whole supplied tables.

Dirty variants spoil whole tables by rule (day of month, week key, cell value), so audits and
cleaners have something to find at every data volume.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from shelfline.functions import round_half_up
from shelfline.operators import features, forecasting, joins, reshape, rollups
from shelfline.schemas import ID_COLUMNS, day_columns
from shelfline.session import DROP_SHUFFLES, scratch_path, settings
from shelfline.sources import supplied

_written: dict[tuple[str, str, str], str] = {}


def stored(spark: SparkSession, sf_dir: str, label: str, build) -> DataFrame:
    """A derived table written once per application to the shared folder, then read from there.
    It is written anew when the folder was emptied in between."""
    key = (spark.sparkContext.applicationId, sf_dir, label)
    if key in _written:
        try:
            return spark.read.parquet(_written[key])
        except AnalysisException:
            del _written[key]
    path = scratch_path(spark, label)
    with settings(spark, DROP_SHUFFLES):
        build().write.parquet(path)
    _written[key] = path
    return spark.read.parquet(path)


def fact(spark, d):
    return stored(spark, d, "fact", lambda: supplied.daily_fact(spark, d))


def series(spark, d):
    return stored(spark, d, "series", lambda: supplied.daily_series(spark, d))


def calendar(spark, d):
    return stored(spark, d, "calendar", lambda: supplied.calendar(spark, d))


def prices(spark, d):
    return stored(spark, d, "prices", lambda: supplied.prices(series(spark, d), calendar(spark, d)))


def wide(spark, d):
    return stored(spark, d, "wide", lambda: supplied.wide_sales(spark, d))


def long_cells(spark, d):
    return reshape.unpivot_days(wide(spark, d))


def daily(spark, d):
    return rollups.daily_sales(fact(spark, d), rollups.stg_calendar(calendar(spark, d)))


def mart(spark, d):
    return rollups.mart_sales_forecasting(daily(spark, d))


def dense_daily(spark, d):
    return rollups.daily_sales(series(spark, d), rollups.stg_calendar(calendar(spark, d)))


def series_mart(spark, d):
    return rollups.mart_sales_forecasting(dense_daily(spark, d))


def faulty_daily(spark, d):
    """Daily model with negative units on the 31st, negative prices on the 30th and every row of
    a 29th twice."""
    dom = F.dayofmonth("sales_date")
    rows = daily(spark, d).withColumns(
        {
            "sales": F.when(dom == 31, -F.col("sales")).otherwise(F.col("sales")),
            "sell_price": F.when(dom == 30, -F.col("sell_price")).otherwise(F.col("sell_price")),
            "_copies": F.when(dom == 29, F.sequence(F.lit(1), F.lit(2))).otherwise(F.sequence(F.lit(1), F.lit(1))),
        }
    )
    return rows.withColumn("_copy", F.explode("_copies")).drop("_copies", "_copy")


def faulty_fact(spark, d):
    rows = faulty_daily(spark, d)
    # Dates of the 28th are lost, prices of the 27th too.
    dom = F.dayofmonth("sales_date")
    return rows.select(
        F.when(dom != 28, F.col("sales_date")).alias("date"),
        "item_id",
        "dept_id",
        "cat_id",
        "store_id",
        "state_id",
        "sales",
        F.when(dom != 27, F.col("sell_price")).alias("sell_price"),
    )


def built(spark, d):
    """The fact as a run stores it: built from the wide table, calendar and prices."""
    return stored(spark, d, "built", lambda: joins.build_fact(wide(spark, d), calendar(spark, d), prices(spark, d)))


def stored_faulty_fact(spark, d):
    return stored(spark, d, "faulty-fact", lambda: faulty_fact(spark, d))


def raw_calendar(spark, d):
    """Calendar as text with bad cells; days of the 20th occur twice."""
    dom = F.dayofmonth("date")
    text = {c: F.col(c).cast("string") for c in ("month", "snap_CA", "snap_TX", "snap_WI", "wday")}
    rows = calendar(spark, d).withColumns(
        {
            **text,
            "wm_yr_wk": F.when(dom == 15, "x").otherwise(F.col("wm_yr_wk").cast("string")),
            "year": F.when(dom == 18, "1900").otherwise(F.col("year").cast("string")),
            "weekday": F.when(dom == 16, "nan").when(dom != 17, F.concat(F.lit(" "), "weekday", F.lit(" "))),
            "event_type_1": F.when(dom == 19, "Unknown").otherwise(F.col("event_type_1")),
            "_copies": F.when(dom == 20, F.sequence(F.lit(1), F.lit(2))).otherwise(F.sequence(F.lit(1), F.lit(1))),
            "date": F.when(dom == 13, "not a date").when(dom != 14, F.col("date").cast("string")),
        }
    )
    return rows.withColumn("_copy", F.explode("_copies")).drop("_copies", "_copy")


def raw_sales(spark, d):
    """Wide sales as text: some cells unreadable, negative, or missing, by their value."""

    def build():
        base = wide(spark, d)

        def cell(c: str) -> str:
            return (
                f"CASE WHEN `{c}` % 97 = 5 THEN 'bad' WHEN `{c}` % 89 = 7 THEN cast(-`{c}` AS string) "
                f"WHEN `{c}` % 83 = 3 THEN NULL ELSE cast(`{c}` AS string) END AS `{c}`"
            )

        return base.selectExpr(*[f"concat(' ', {c}) AS {c}" for c in ID_COLUMNS], *[cell(c) for c in day_columns(base)])

    return stored(spark, d, "raw-wide", build)


def raw_prices(spark, d):
    """Prices as text: bad, missing, negative and zero ones, lost item ids, second copies."""
    week = F.col("wm_yr_wk")
    text = F.col("sell_price").cast("string")
    rows = prices(spark, d).withColumn(
        "load_no", F.explode(F.when(week % 11 == 0, F.sequence(F.lit(1), F.lit(2))).otherwise(F.sequence(F.lit(1), F.lit(1))))
    )
    return rows.select(
        F.concat(F.lit(" "), "store_id").alias("store_id"),
        F.when(week % 43 != 0, F.concat("item_id", F.lit(" "))).alias("item_id"),
        week.cast("string").alias("wm_yr_wk"),
        F.when(F.col("load_no") == 2, "1.5")
        .when(week % 29 == 0, "n/a")
        .when(week % 37 == 0, F.concat(F.lit("-"), text))
        .when(week % 41 == 0, "0")
        .when(week % 31 != 0, text)
        .alias("sell_price"),
        "load_no",
    )


def gap_filled(spark, d):
    """The gap filling itself, not a stored copy of it."""
    return reshape.gap_fill_dates(forecasting.load_series(series_mart(spark, d)))


def filled(spark, d):
    return stored(spark, d, "filled", lambda: gap_filled(spark, d))


def featured(spark, d):
    return stored(spark, d, "featured", lambda: features.feature_matrix(filled(spark, d)))


def split(spark, d):
    return forecasting.time_split(featured(spark, d))


def forecast(spark, d):
    """Additive 30-day forecast, to four decimals; stored once, as a run keeps it."""

    def build():
        rows = forecasting.additive_future(filled(spark, d))
        return rows.withColumn("predicted_demand", round_half_up("predicted_demand", 4))

    return stored(spark, d, "forecast", build)


def wide_digest(df: DataFrame) -> DataFrame:
    """Ids plus count, total and position-weighted total of the day cells: every cell counts."""
    cells, _ = reshape.day_cells(df)
    numbered = F.transform(cells, lambda x, i: x.cast("bigint") * (i + 1))
    add = (F.lit(0).cast("bigint"), lambda a, x: a + F.coalesce(x, F.lit(0).cast("bigint")))
    return df.select(
        *ID_COLUMNS,
        F.size(cells).cast("bigint").alias("cell_count"),
        F.aggregate(F.transform(cells, lambda x: x.cast("bigint")), *add).alias("total"),
        F.aggregate(numbered, *add).alias("weighted_total"),
    )


def rounded(df: DataFrame, digits: int = 4, columns: list[str] | None = None) -> DataFrame:
    """Doubles rounded for comparison with another engine."""
    names = columns or [f.name for f in df.schema.fields if f.dataType.typeName() == "double"]
    return df.withColumns({c: round_half_up(c, digits) for c in names})


