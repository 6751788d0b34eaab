"""Catalog tables: create, write, read, verify, and the fallbacks between them."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from shelfline.functions.observed import seen_by
from shelfline.schemas import FACT, FORECAST, METRICS, RECOMMENDATIONS
from shelfline.schemas import MART as MART_SHAPE
from shelfline.session import DROP_SHUFFLES, settings

# Names of the stored tables.
RAW_CALENDAR = "raw_calendar"
RAW_SALES = "raw_sales_train_validation"
RAW_SALES_ALIAS = "raw_sales_train"
RAW_PRICES = "raw_sell_prices"
CLEAN_CALENDAR = "clean_calendar"
CLEAN_SALES = "clean_sales_train_validation"
CLEAN_SALES_ALIAS = "clean_sales"
CLEAN_PRICES = "clean_sell_prices"
FACT_TABLE = "fact_daily_sales"
FACT_ALIAS = "stg_sales_long"
MART = "mart_sales_forecasting"
FORECASTS = "forecast_results"
EVALUATION = "model_evaluation_metrics"
INVENTORY = "inventory_recommendations"
# Error conditions that say a table or path is not there.
ABSENT = {"TABLE_OR_VIEW_NOT_FOUND", "SCHEMA_NOT_FOUND", "PATH_NOT_FOUND"}


def create_dataset(spark: SparkSession, name: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}{where}")


def scan_table(spark: SparkSession, query: str) -> DataFrame:
    """A table by name, or the result of a SELECT."""
    text = query.strip()
    return spark.sql(text) if " " in text else spark.table(text)


VERSION_MARK = "__v_"


class UnverifiedTable(RuntimeError):
    """A staged table does not hold the rows that were to be written."""


def fingerprint(df: DataFrame) -> dict[str, Column]:
    """Aggregates that tell two tables apart whatever the order of rows: their number and two digests."""
    row = F.xxhash64(*[F.col(f"`{c}`") for c in sorted(df.columns)])
    return {"rows": F.count(F.lit(1)), "mixed": F.bit_xor(row), "added": F.sum((row % F.lit(1 << 31)).cast("bigint"))}


def _figures(df: DataFrame) -> dict:
    return df.agg(*[c.alias(n) for n, c in fingerprint(df).items()]).first().asDict()


def _save(
    df: DataFrame,
    name: str,
    mode: str,
    partition_by: list[str] | None,
    sort_by: list[str] | None,
    buckets: tuple[int, list[str]] | None,
    dealt: bool,
    path: str | None = None,
) -> None:
    if not dealt and buckets:
        df = df.repartition(buckets[0], *buckets[1])
    elif not dealt and partition_by:
        df = df.hint("rebalance", *partition_by)
    if sort_by and not buckets:  # with buckets, the writer sorts by partition, bucket and these
        df = df.sortWithinPartitions(*(partition_by or []), *sort_by)
    writer = df.write.mode(mode).format("parquet")
    if path:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if buckets:
        writer = writer.bucketBy(buckets[0], *buckets[1])
        writer = writer.sortBy(*sort_by) if sort_by else writer
    writer.saveAsTable(name)


def _version_folder(spark: SparkSession, name: str, version: str) -> str:
    """A folder of its own for every version of a table, beside the dataset's other tables."""
    dataset, _, table = name.rpartition(".")
    base = spark.catalog.getDatabase(dataset or spark.catalog.currentDatabase()).locationUri
    return f"{base.rstrip('/')}/{table}{VERSION_MARK}{version}"


def _drop(spark: SparkSession, name: str) -> None:
    """Drops a table together with the version folder this module wrote it to."""
    if not spark.catalog.tableExists(name):
        return
    details = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    spark.sql(f"DROP TABLE {name}")
    location = details.get("Location", "")
    if VERSION_MARK in location.rsplit("/", 1)[-1]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(location)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def write_table(
    df: DataFrame,
    name: str,
    mode: str = "overwrite",
    partition_by: list[str] | None = None,
    sort_by: list[str] | None = None,
    buckets: tuple[int, list[str]] | None = None,
    dealt: bool = False,
) -> None:
    """Replace or append a table.

    A replacement is staged beside the table, compared with the rows that were written (their number and
    digests are observed on the way), and only then takes the table's name; a write that fails leaves the
    old table. An input may therefore read the table it replaces.

    A partitioned table is rebalanced on its partition columns first: files get an even size and a
    year that holds most rows is split over many tasks. Rows are ordered inside files only.

    `buckets`: their number and the columns whose hash decides; a reader that groups by these columns and
    others needs no shuffle. `dealt`: the rows are in the tasks that shall write them, and are not moved again.
    """
    with settings(df.sparkSession, DROP_SHUFFLES):
        if mode == "overwrite":
            _replace(df, name, partition_by, sort_by, buckets, dealt)
        else:
            _save(df, name, mode, partition_by, sort_by, buckets, dealt)


def _replace(
    df: DataFrame,
    name: str,
    partition_by: list[str] | None,
    sort_by: list[str] | None,
    buckets: tuple[int, list[str]] | None,
    dealt: bool,
) -> None:
    spark, version, seen = df.sparkSession, uuid.uuid4().hex[:12], Observation()
    staged = f"{name}__staged_{version}"
    try:
        watched = df.observe(seen, *[c.alias(n) for n, c in fingerprint(df).items()])
        _save(watched, staged, "error", partition_by, sort_by, buckets, dealt, _version_folder(spark, name, version))
        stored = _figures(spark.table(staged))
        # A map task that ran again after a lost executor was observed twice: then the input is counted anew.
        if stored != seen_by(seen) and stored != (wanted := _figures(df)):
            raise UnverifiedTable(f"{name}: staged {stored}, to be written {wanted}")
        publish(spark, staged, name)
    finally:
        _drop(spark, staged)


def publish(spark: SparkSession, staged: str, name: str) -> None:
    """Gives a staged table its name; the table that had it stays until then and comes back on failure."""
    previous = f"{name}__previous_{uuid.uuid4().hex[:12]}"
    replaced = spark.catalog.tableExists(name)
    if replaced:
        spark.sql(f"ALTER TABLE {name} RENAME TO {previous}")
    try:
        spark.sql(f"ALTER TABLE {staged} RENAME TO {name}")
    except Exception:
        if replaced:
            spark.sql(f"ALTER TABLE {previous} RENAME TO {name}")
        raise
    if replaced:
        _drop(spark, previous)


def alias_view(spark: SparkSession, dataset: str, alias: str, name: str) -> None:
    """A second name for a table of the same dataset, without a second copy."""
    spark.sql(f"CREATE OR REPLACE VIEW {dataset}.{alias} AS SELECT * FROM {dataset}.{name}")


def verify_table(spark: SparkSession, name: str, sample_limit: int = 5) -> dict:
    """Existence, row count, columns and a small sample frame."""
    if not spark.catalog.tableExists(name):
        return {"exists": False, "row_count": 0, "columns": [], "sample": None}
    df = spark.table(name)
    return {"exists": True, "row_count": df.count(), "columns": df.columns, "sample": df.limit(sample_limit)}


def count_union(tables: dict[str, DataFrame]) -> DataFrame:
    """Row counts of several tables: (tbl, cnt)."""
    counts = [df.agg(F.count(F.lit(1)).alias("cnt")).select(F.lit(name).alias("tbl"), "cnt") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def first_non_empty(candidates: list[Callable[[], DataFrame]]) -> DataFrame:
    """First candidate that exists and has a row. `isEmpty` stops at the first row found. Any error
    other than an absent table or path is raised."""
    for read in candidates:
        try:
            df = read()
            if not df.isEmpty():
                return df
        except AnalysisException as error:
            if error.getCondition() not in ABSENT:
                raise
    raise ValueError("no candidate table exists with rows")


def first_table(spark: SparkSession, names: list[str]) -> DataFrame:
    return first_non_empty([lambda n=n: spark.table(n) for n in names])


def read_snapshot(spark: SparkSession, table: str, parquet_path: str, csv_path: str, schema: T.StructType = FACT) -> DataFrame:
    """Catalog table, else its Parquet copy, else its CSV copy."""
    return first_non_empty(
        [
            lambda: spark.table(table),
            lambda: spark.read.parquet(parquet_path),
            lambda: spark.read.schema(schema).option("header", True).csv(csv_path),
        ]
    )


def scan_serving(spark: SparkSession, dataset: str) -> dict[str, DataFrame]:
    """The four output tables; a missing one becomes an empty frame of its declared shape."""
    shapes = {MART: MART_SHAPE, FORECASTS: FORECAST, INVENTORY: RECOMMENDATIONS, EVALUATION: METRICS}
    out = {}
    for name, shape in shapes.items():
        full = f"{dataset}.{name}"
        out[name] = spark.table(full) if spark.catalog.tableExists(full) else spark.createDataFrame([], shape)
    return out


def ingest_all(spark: SparkSession, sources: dict[str, DataFrame], dataset: str) -> DataFrame:
    """Store the raw inputs and report (table_name, success, row_count, elapsed_sec).

    An input that is missing or cannot be read or stored is reported with success false and no
    rows; the others are stored all the same."""
    create_dataset(spark, dataset)
    rows = []
    for source, name in (("calendar", RAW_CALENDAR), ("sales", RAW_SALES), ("prices", RAW_PRICES)):
        started, stored, success = time.time(), 0, source in sources
        try:
            if success:
                write_table(sources[source], f"{dataset}.{name}")
                stored = spark.table(f"{dataset}.{name}").count()
        except PySparkException:
            success = False
        rows.append((name, success, stored, round(time.time() - started, 2)))
        if success and name == RAW_SALES:
            alias_view(spark, dataset, RAW_SALES_ALIAS, RAW_SALES)
    return spark.createDataFrame(rows, "table_name string, success boolean, row_count bigint, elapsed_sec double")


def ingest_summary(report: DataFrame) -> DataFrame:
    return report.agg(
        F.sum("row_count").alias("total_rows"),
        F.sum("elapsed_sec").alias("total_sec"),
        F.when(F.every("success"), "SUCCESS").otherwise("FAILURE").alias("overall_status"),
    )
