"""Readers and writers: derived tables are written, read back and compared."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import inputs as i
from catalog.quality import ENTRIES as QUALITY
from catalog.quality import JOB_AUDIT, rounded_prices
from catalog.sql import query
from shelfline.operators import audit
from shelfline.plans import jobs
from shelfline.schemas import FACT, ID_COLUMNS, PRICES
from shelfline.session import scratch_path
from shelfline.sources import files, tables


def _dataset(spark) -> str:
    """A new schema below the shared folder."""
    path = scratch_path(spark, "dataset")
    name = f"shelf_{path.rsplit('-', 1)[1]}"
    tables.create_dataset(spark, name, path)
    return name


def _csv(spark, df, label):
    path = scratch_path(spark, label)
    files.export_csv(df, path)
    return path


def _scan_calendar(spark, d):
    text = i.calendar(spark, d).withColumn("date", F.col("date").cast("string"))
    return files.scan_calendar(spark, _csv(spark, text, "calendar"))


def _scan_prices(spark, d):
    return files.scan_prices(spark, _csv(spark, i.prices(spark, d), "prices"))


def _odd_prices(spark, d):
    """A price file whose weeks are written with decimals, one week in seven with a word for a price."""
    rows = i.prices(spark, d).select("store_id", "item_id", F.concat(F.col("wm_yr_wk").cast("string"), F.lit(".0")).alias("wm_yr_wk"),
                                     F.when(F.col("wm_yr_wk") % 7 == 0, "none").otherwise(F.col("sell_price").cast("string")).alias("sell_price"))
    return _csv(spark, rows, "odd-prices")


def _scan_widened(spark, d):
    return files.scan_widened(spark, _odd_prices(spark, d), PRICES)[0]


def _scan_rejects(spark, d):
    return files.scan_widened(spark, _odd_prices(spark, d), PRICES)[1]


def _scan_wide(spark, d):
    return i.wide_digest(files.scan_sales_wide(spark, _csv(spark, i.wide(spark, d), "sales")))


def _scan_table(spark, d):
    spark.read.parquet(f"{d}/lineitem.parquet").createOrReplaceTempView("shelf_lineitem")
    return tables.scan_table(spark, "SELECT l_returnflag, count(*) AS n FROM shelf_lineitem GROUP BY l_returnflag")


def _write_table(spark, d):
    """Replace, then append the same rows: every row is there twice."""
    name = f"{_dataset(spark)}.{tables.FACT_TABLE}"
    fact = i.fact(spark, d)
    tables.write_table(fact, name, sort_by=["date"])
    tables.write_table(fact, name, mode="append", sort_by=["date"])
    return tables.scan_table(spark, name)


def _verify(spark, d):
    name = f"{_dataset(spark)}.{tables.FACT_TABLE}"
    tables.write_table(i.fact(spark, d), name)
    found = tables.verify_table(spark, name)
    return spark.createDataFrame([(found["exists"], found["row_count"], len(found["columns"]))], "found boolean, row_count bigint, column_count int")


def _snapshot(spark, d):
    path = scratch_path(spark, "snapshot")
    files.write_snapshot(i.fact(spark, d), path)
    return tables.read_snapshot(spark, "no_such_table", path, f"{path}-none.csv")


def _read_csv_snapshot(spark, d):
    path = _csv(spark, i.fact(spark, d), "snapshot-csv")
    return tables.read_snapshot(spark, "no_such_table", f"{path}-none", path, FACT)


def _serving(spark, d):
    """Only the mart and the forecast exist; the other two come back empty."""
    dataset = _dataset(spark)
    tables.write_table(i.series_mart(spark, d), f"{dataset}.{tables.MART}")
    tables.write_table(i.forecast(spark, d), f"{dataset}.{tables.FORECASTS}")
    return tables.count_union(tables.scan_serving(spark, dataset))


def _export(spark, d):
    path = _csv(spark, i.forecast(spark, d), "forecast")
    shape = "forecast_date date, item_id string, store_id string, predicted_demand double, model_used string"
    return spark.read.schema(shape).option("header", True).csv(path)


def _report(spark, d):
    """The audit of the raw calendar as text, read back."""
    path = scratch_path(spark, "report")
    files.write_report(audit.render_audit(audit.audit(i.raw_calendar(spark, d), "calendar")), path)
    return spark.read.text(path).withColumnRenamed("value", "line")


def _sources(spark, d):
    return {"calendar": i.calendar(spark, d), "sales": i.wide(spark, d), "prices": i.prices(spark, d)}


def _ingest(spark, d):
    return tables.ingest_all(spark, _sources(spark, d), _dataset(spark)).select("table_name", "success", "row_count")


def _ingest_summary(spark, d):
    report = tables.ingest_all(spark, _sources(spark, d), _dataset(spark))
    return tables.ingest_summary(report).select("total_rows", "overall_status")


def _count_union(spark, d):
    return tables.count_union({"raw_calendar": i.calendar(spark, d), "raw_sales_train_validation": i.wide(spark, d), "raw_sell_prices": i.prices(spark, d)})


def _ingested(spark, d):
    dataset = _dataset(spark)
    tables.ingest_all(spark, _sources(spark, d), dataset)
    return dataset


def _job_quality(spark, d):
    """The stored audit, observed while the cleaned tables were written, with the state of those tables."""
    return rounded_prices(jobs.job_quality(spark, _ingested(spark, d))["audit"])


def _job_transform(spark, d):
    return jobs.job_transform(spark, _ingested(spark, d))["fact"]


def _job_prepare(spark, d):
    return jobs.job_prepare(spark, _ingested(spark, d))


def _job_validate(spark, d):
    dataset = _ingested(spark, d)
    jobs.job_transform(spark, dataset)
    return jobs.job_validate(spark, dataset)["report"]


def _job_etl(spark, d):
    dataset = _dataset(spark)
    jobs.job_etl(spark, _sources(spark, d), dataset)
    return spark.table(f"{dataset}.{tables.FACT_TABLE}")


def _job_all(spark, d):
    return jobs.job_all(spark, _sources(spark, d), _dataset(spark))["recommendations"]


_BUILT = """SELECT c.date, c.item_id, dept_id, cat_id, c.store_id, state_id, c.sales, p.sell_price FROM cells c LEFT JOIN prices p
    ON c.store_id = p.store_id AND c.item_id = p.item_id AND c.wm_yr_wk = p.wm_yr_wk"""
_RAW_COUNTS = """SELECT 'raw_calendar' AS {0}, {2}count(*) AS {1} FROM cal UNION ALL
    SELECT 'raw_sales_train_validation', {2}count(*) FROM ids UNION ALL SELECT 'raw_sell_prices', {2}count(*) FROM prices"""

ENTRIES = {
    "scan_calendar": (_scan_calendar, query("SELECT * REPLACE (CAST(date AS VARCHAR) AS date) FROM cal")),
    "scan_sales_wide": (
        _scan_wide,
        query(f"SELECT {', '.join(ID_COLUMNS)}, count(*) AS cell_count, CAST(sum(sales) AS BIGINT) AS total, CAST(sum(sales * n) AS BIGINT) AS weighted_total FROM cells GROUP BY ALL"),
    ),
    "scan_prices": (_scan_prices, query("SELECT * FROM prices")),
    "scan_widened": (_scan_widened, query("SELECT * FROM prices WHERE wm_yr_wk % 7 <> 0")),
    "scan_rejects": (
        _scan_rejects,
        query("SELECT store_id, item_id, wm_yr_wk || '.0' AS wm_yr_wk, 'none' AS sell_price, 'sell_price' AS reason FROM prices WHERE wm_yr_wk % 7 = 0"),
    ),
    "scan_table": (_scan_table, "SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY 1"),
    "write_table": (_write_table, query("SELECT * FROM fact UNION ALL SELECT * FROM fact")),
    "verify_table": (_verify, query("SELECT true AS found, count(*) AS row_count, 8 AS column_count FROM fact")),
    "write_snapshot": (_snapshot, query("SELECT * FROM fact")),
    "read_snapshot": (_read_csv_snapshot, query("SELECT * FROM fact")),
    "scan_serving": (
        _serving,
        query(
            """SELECT 'mart_sales_forecasting' AS tbl, count(*) AS cnt FROM series UNION ALL SELECT 'forecast_results', count(*) FROM forecast
            UNION ALL SELECT 'inventory_recommendations', 0 UNION ALL SELECT 'model_evaluation_metrics', 0"""
        ),
    ),
    "export_csv": (_export, query("SELECT * FROM forecast")),
    "write_report": (_report, f"SELECT line FROM ({QUALITY['render_audit'][1]}) WHERE dataset = 'calendar'"),
    "ingest_all": (_ingest, query(_RAW_COUNTS.format("table_name", "row_count", "true AS success, ", ""))),
    "ingest_summary": (
        _ingest_summary,
        query("SELECT (SELECT count(*) FROM cal) + (SELECT count(*) FROM ids) + (SELECT count(*) FROM prices) AS total_rows, 'SUCCESS' AS overall_status"),
    ),
    "count_union": (_count_union, query(_RAW_COUNTS.format("tbl", "cnt", ""))),
    "job_quality": (_job_quality, JOB_AUDIT),
    "job_transform": (_job_transform, query(_BUILT)),
    "job_prepare": (_job_prepare, query(_BUILT)),
    "job_validate": (_job_validate, QUALITY["validation_report"][1]),
    "job_etl": (_job_etl, query(_BUILT)),
    "job_all": (_job_all, None),
}

