"""Staging, intermediate and mart layers over the clean tables and the fact."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from shelfline.operators import rollups
from shelfline.schemas import SERIES_KEY, column_list
from shelfline.session import settings
from shelfline.sources.tables import MART, write_table

# Rows of the daily model that a task sorts at once, and the most buckets that Spark takes.
ROWS_PER_BUCKET = 1_000_000
MOST_BUCKETS = 100_000
# A task reads a bucket even where nothing is grouped by its columns, and sorted rows are grouped as they come.
BY_BUCKET = {"spark.sql.sources.bucketing.autoBucketedScan.enabled": "false", "spark.sql.execution.replaceHashWithSortAgg": "true"}


@dataclass(frozen=True)
class Layers:
    """Lazy models; nothing runs until one of them is used."""

    stg_calendar: DataFrame
    int_daily_sales: DataFrame
    int_weekly_sales: DataFrame
    int_monthly_sales: DataFrame
    mart_sales_forecasting: DataFrame


def build_layers(fact: DataFrame, calendar: DataFrame) -> Layers:
    staged = rollups.stg_calendar(calendar)
    daily = rollups.daily_sales(fact, staged)
    return Layers(
        staged, daily, rollups.weekly_sales(daily), rollups.monthly_sales(daily), rollups.mart_sales_forecasting(daily)
    )


def series_buckets(fact: DataFrame) -> int:
    return min(MOST_BUCKETS, max(1, -(-fact.count() // ROWS_PER_BUCKET)))


def materialize_layers(spark: SparkSession, fact: DataFrame, calendar: DataFrame, dataset: str) -> Layers:
    """The staged calendar and the marts as tables of the dataset (marts by year), and views of the same
    dataset under the names of the intermediate models.

    The daily model is stored first and the other marts read the stored copy, so the join behind it
    runs once. An intermediate model is what its mart stores, so its view reads that table.

    Rows are shuffled once, before the calendar makes them wide: the daily table keeps each series in one
    bucket, and a task that reads a bucket groups or widens its rows and writes them, a file for each year.
    """
    staged = rollups.stg_calendar(calendar)
    write_table(staged, f"{dataset}.stg_calendar", sort_by=["sales_date"])
    parts = series_buckets(fact)

    def stored(period: str, model: DataFrame, sort_by: list[str], buckets: tuple[int, list[str]] | None = None) -> DataFrame:
        write_table(model, f"{dataset}.fct_{period}_sales", partition_by=["year"], sort_by=sort_by, buckets=buckets, dealt=True)
        columns = column_list(model.columns)  # the partition column comes last in the table
        spark.sql(f"CREATE OR REPLACE VIEW {dataset}.int_{period}_sales AS SELECT {columns} FROM {dataset}.fct_{period}_sales")
        return spark.table(f"{dataset}.int_{period}_sales")

    daily = stored("daily", rollups.daily_sales(fact, staged, parts), [*SERIES_KEY, "sales_date"], (parts, SERIES_KEY))
    with settings(spark, BY_BUCKET):
        weekly = stored("weekly", rollups.weekly_sales(daily, together=True), SERIES_KEY)
        monthly = stored("monthly", rollups.monthly_sales(daily, together=True), SERIES_KEY)
        mart = rollups.mart_sales_forecasting(daily)
        write_table(mart, f"{dataset}.{MART}", partition_by=["year"], sort_by=[*SERIES_KEY, "date"], dealt=True)
    return Layers(spark.table(f"{dataset}.stg_calendar"), daily, weekly, monthly, spark.table(f"{dataset}.{MART}").select(*mart.columns))
