"""Jobs: the stages of a run, each reading and writing catalog tables of one dataset.

A stage stores its result and later stages read the stored table, so nothing is computed twice
and a lost executor costs at most the running stage.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.operators import audit, boosted, cleaning, features, forecasting, inventory, joins, keep, quality, reshape, rollups
from shelfline.plans.layers import Layers, materialize_layers
from shelfline.schemas import require_columns
from shelfline.session import scratch_path
from shelfline.sources import tables as tb
from shelfline.sources.files import write_report, write_snapshot


def _raw(spark: SparkSession, dataset: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return tuple(spark.table(f"{dataset}.{name}") for name in (tb.RAW_CALENDAR, tb.RAW_SALES, tb.RAW_PRICES))


def job_quality(spark: SparkSession, dataset: str, report_path: str | None = None) -> dict:
    """Write cleaned copies of the raw tables, audit the raw rows on the way, verify the copies.

    The audits are observed while the copies are written; only repeated keys are counted by themselves."""
    raw = dict(zip(("calendar", "sales", "prices"), _raw(spark, dataset)))
    seen = {name: audit.Observed(df, name) for name, df in raw.items()}
    tb.write_table(cleaning.clean_calendar(seen["calendar"].rows), f"{dataset}.{tb.CLEAN_CALENDAR}", sort_by=["date"])
    tb.write_table(cleaning.clean_sales(seen["sales"].rows), f"{dataset}.{tb.CLEAN_SALES}", sort_by=["store_id", "item_id"])
    tb.alias_view(spark, dataset, tb.CLEAN_SALES_ALIAS, tb.CLEAN_SALES)
    tb.write_table(cleaning.clean_prices(seen["prices"].rows), f"{dataset}.{tb.CLEAN_PRICES}", sort_by=["store_id", "item_id", "wm_yr_wk"])
    found = quality.union_all([audit.audit(df, name, found=seen[name].figures()) for name, df in raw.items()])
    tb.write_table(found, f"{dataset}.data_quality_audit")
    audits = spark.table(f"{dataset}.data_quality_audit")
    tb.write_table(audit.checks_of(audits), f"{dataset}.data_quality_checks")
    if report_path:
        write_report(audit.render_audit(audits), report_path)
    names = (tb.CLEAN_CALENDAR, tb.CLEAN_SALES, tb.CLEAN_PRICES)
    return {
        "audit": audits,
        "checks": spark.table(f"{dataset}.data_quality_checks"),
        "status": audit.audit_summary(audits),
        "verification": {name: tb.verify_table(spark, f"{dataset}.{name}") for name in names},
    }


def _inputs(spark: SparkSession, dataset: str, prefer_clean_lookups: bool = True) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Wide sales, calendar and prices, from the dataset's first table of each kind that has rows."""

    def first(*names: str) -> DataFrame:
        return tb.first_table(spark, [f"{dataset}.{n}" for n in names])

    calendars, prices = [tb.CLEAN_CALENDAR, tb.RAW_CALENDAR], [tb.CLEAN_PRICES, tb.RAW_PRICES]
    if not prefer_clean_lookups:
        calendars.reverse()
        prices.reverse()
    return first(tb.CLEAN_SALES, tb.RAW_SALES, tb.RAW_SALES_ALIAS), first(*calendars), first(*prices)


def job_transform(spark: SparkSession, dataset: str, snapshot_path: str | None = None) -> dict:
    """Build and store the fact, then check it against the wide total."""
    sales, calendar, prices = _inputs(spark, dataset)
    fact = joins.build_fact(sales, calendar, prices)
    tb.write_table(fact, f"{dataset}.{tb.FACT_TABLE}", sort_by=["date", "store_id", "item_id"])
    stored = spark.table(f"{dataset}.{tb.FACT_TABLE}")
    tb.alias_view(spark, dataset, tb.FACT_ALIAS, tb.FACT_TABLE)
    if snapshot_path:
        write_snapshot(stored, snapshot_path)
    return {"fact": stored, "metrics": quality.validate_transform(stored, sales)}


def job_prepare(spark: SparkSession, dataset: str, max_items: int | None = None) -> DataFrame:
    """Fact from raw-first inputs, optionally for the first `max_items` wide rows."""
    sales, calendar, prices = _inputs(spark, dataset, prefer_clean_lookups=False)
    for name, df in (("sales", sales), ("calendar", calendar), ("prices", prices)):
        require_columns(df, name)
    if max_items:
        sales = keep.sample_rows(sales, max_items, ["id"])
    return joins.build_fact(sales, calendar, prices)


def job_validate(spark: SparkSession, dataset: str, report_path: str | None = None) -> dict:
    """Full validation of the stored fact; the report is stored as a table and optionally as text."""
    fact = spark.table(f"{dataset}.{tb.FACT_TABLE}")
    wide = tb.first_table(spark, [f"{dataset}.{tb.CLEAN_SALES}", f"{dataset}.{tb.RAW_SALES}"])
    tb.write_table(quality.validation_report(fact, wide), f"{dataset}.validation_report")
    report = spark.table(f"{dataset}.validation_report")
    if report_path:
        write_report(quality.render_report(report), report_path)
    overall = report.filter(F.col("section") == "overall").first().status
    return {"report": report, "metrics": quality.validate_fact(fact), "status": overall}


def job_etl(spark: SparkSession, sources: dict[str, DataFrame], dataset: str) -> dict:
    """Ingest, audit and clean, transform, validate."""
    started = time.time()
    ingestion = tb.ingest_all(spark, sources, dataset)
    if failed := [r.table_name for r in ingestion.collect() if not r.success]:  # three rows
        raise ValueError(f"ingestion failed: {failed}")
    audited = job_quality(spark, dataset)
    transformed = job_transform(spark, dataset)
    validated = job_validate(spark, dataset)
    rows = spark.table(f"{dataset}.{tb.FACT_TABLE}").isEmpty()
    return {
        "ingestion": ingestion,
        "quality": audited,
        "transform": transformed,
        "validation": validated,
        "status": "FAIL" if rows else "PASS",
        "elapsed_sec": round(time.time() - started, 2),
    }


def forecast_frames(mart: DataFrame, k: int | None = None) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Gap-filled series, featured rows, and the train and validation parts of the latter."""
    series = forecasting.load_series(mart, k)
    filled = reshape.gap_fill_dates(series)
    featured = features.feature_matrix(filled)
    train, validation = forecasting.time_split(featured, cutoff=forecasting.cutoff_after_warmup(series))
    return filled, featured, train, validation


def job_forecast(
    spark: SparkSession,
    dataset: str,
    k: int | None = None,
    horizon_days: int = forecasting.HORIZON_DAYS,
    trees: int = boosted.TREES,
) -> dict:
    """Prepare the series, compare both models, forecast with the winner, store the results.

    The gap-filled and the featured frames are stored once; training, scoring and the final
    forecast read those copies. Only the winner's name and the fitted trees reach the driver.
    """
    mart = spark.table(f"{dataset}.{tb.MART}")
    if mart.isEmpty():
        raise ValueError(f"{dataset}.{tb.MART} has no rows")
    series = forecasting.load_series(mart, k)
    work = scratch_path(spark, "forecast")
    reshape.gap_fill_dates(series).write.parquet(f"{work}/filled")
    filled = spark.read.parquet(f"{work}/filled")
    features.feature_matrix(filled).write.parquet(f"{work}/featured")
    featured = spark.read.parquet(f"{work}/featured")
    train, validation = forecasting.time_split(featured)

    fits = forecasting.fit_additive(train)
    additive = forecasting.additive_predict(fits, validation)
    model = boosted.fit_boosted(train, trees=trees)
    scored = boosted.boosted_predict(model, validation)
    tb.write_table(forecasting.evaluate_models(additive, scored), f"{dataset}.{tb.EVALUATION}")
    metrics = spark.table(f"{dataset}.{tb.EVALUATION}")
    winner = forecasting.pick_winner(metrics).first().model
    if winner is None:
        raise ValueError("no model produced validation predictions")

    if winner == forecasting.BOOSTED:
        forecast = boosted.recursive_forecast(model, filled, horizon_days)
    else:
        forecast = forecasting.additive_future(filled, horizon_days)
    tb.write_table(forecast, f"{dataset}.{tb.FORECASTS}")
    stored = spark.table(f"{dataset}.{tb.FORECASTS}")
    verdict = forecasting.check_forecast(stored).first()
    if not verdict.passed:
        raise ValueError(f"forecast rejected: {verdict.asDict()}")
    return {"metrics": metrics, "winner": winner, "forecast": stored, "rejected": forecasting.failed_series_report(fits)}


def job_inventory(spark: SparkSession, dataset: str, **settings) -> DataFrame:
    """Recommendations from the stored forecast and mart, stored in turn."""
    forecast, history = spark.table(f"{dataset}.{tb.FORECASTS}"), spark.table(f"{dataset}.{tb.MART}")
    if forecast.isEmpty() or history.isEmpty():
        raise ValueError("forecast or history table has no rows")
    tb.write_table(inventory.inventory_recommendations(forecast, history, **settings), f"{dataset}.{tb.INVENTORY}")
    return spark.table(f"{dataset}.{tb.INVENTORY}")


def job_assertions(spark: SparkSession, dataset: str, layers: Layers) -> DataFrame:
    """Declared column rules and model assertions over the stored models, stored in turn as
    (model, column_name, rule, violations)."""
    sales = rollups.stg_sales(spark.table(f"{dataset}.{tb.CLEAN_SALES}"))
    prices = rollups.stg_sell_prices(spark.table(f"{dataset}.{tb.CLEAN_PRICES}"))
    daily, weekly, monthly = (spark.table(f"{dataset}.fct_{period}_sales") for period in ("daily", "weekly", "monthly"))
    mart = spark.table(f"{dataset}.{tb.MART}")
    # The intermediate models are what the marts store, so the stored copies are checked once.
    models = {
        "stg_calendar": layers.stg_calendar,
        "stg_sales": sales,
        "stg_sell_prices": prices,
        tb.MART: mart,
        "fct_daily_sales": daily,
        "fct_weekly_sales": weekly,
        "fct_monthly_sales": monthly,
    }
    found = {
        ("fct_daily_sales", "non_negative"): quality.assert_daily_non_negative(daily),
        ("fct_daily_sales", "unique_key"): quality.assert_daily_unique(daily),
        ("fct_weekly_sales", "unique_key"): quality.assert_weekly_unique(weekly),
        ("fct_monthly_sales", "unique_key"): quality.assert_monthly_unique(monthly),
        (tb.MART, "unique_key"): quality.assert_mart_unique(mart),
        (tb.MART, "non_negative"): quality.assert_mart_non_negative(mart),
        ("fct_weekly_sales", "same_total"): quality.assert_weekly_total(daily, weekly),
        ("fct_monthly_sales", "same_total"): quality.assert_monthly_total(daily, monthly),
    }
    rules = [quality.check_not_null(df, name) for name, df in models.items()]
    rules += [quality.check_unique(models[name], name) for name in quality.UNIQUE]
    rules += [quality.check_accepted_values(models[name], name) for name in quality.ACCEPTED]
    for (model, rule), rows in found.items():
        counted = rows.agg(F.count(F.lit(1)).alias("violations"))
        rules.append(counted.select(F.lit(model).alias("model"), F.lit("*").alias("column_name"), F.lit(rule).alias("rule"), "violations"))
    tb.write_table(quality.union_all(rules), f"{dataset}.model_assertions")
    return spark.table(f"{dataset}.model_assertions")


def job_all(
    spark: SparkSession, sources: dict[str, DataFrame], dataset: str, k: int | None = None, trees: int = boosted.TREES
) -> dict:
    """Everything from the raw inputs to the recommendations; PASS needs every assertion to hold."""
    etl = job_etl(spark, sources, dataset)
    layers: Layers = materialize_layers(
        spark, spark.table(f"{dataset}.{tb.FACT_TABLE}"), spark.table(f"{dataset}.{tb.CLEAN_CALENDAR}"), dataset
    )
    assertions = job_assertions(spark, dataset, layers)
    passed = etl["status"] == "PASS" and assertions.filter("violations > 0").isEmpty()
    forecast = job_forecast(spark, dataset, k, trees=trees)
    recommendations = job_inventory(spark, dataset)
    return {
        "etl": etl,
        "layers": layers,
        "assertions": assertions,
        "forecast": forecast,
        "recommendations": recommendations,
        "status": "PASS" if passed else "FAIL",
    }
