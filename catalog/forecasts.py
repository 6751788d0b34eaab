"""Features, models, metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import inputs as i
from catalog.sql import query, rnd
from shelfline.functions import round_half_up
from shelfline.operators import boosted, features as f, forecasting as fc, joins, piecewise
from shelfline.plans.jobs import job_forecast
from shelfline.session import scratch_path
from shelfline.sources import tables

_KEY = ["store_id", "item_id", "date"]
# Fitted once per application and folder.
_fitted: dict[tuple[str, str], object] = {}
_STATS = [f"rolling_{kind}_{n}" for n in (7, 28) for kind in ("mean", "std")]
_STATS_SQL = ", ".join(f"{rnd(c, 4)} AS {c}" for c in _STATS)
_DATES = ["year", "month", "day", "day_of_week", "week_of_year", "is_weekend"]


def _rolling(spark, d):
    return i.rounded(f.rolling_features(i.filled(spark, d)).select(*_KEY, *_STATS))


def _matrix(spark, d):
    lags = [f"lag_{k}" for k in f.LAGS]
    columns = [*_KEY, "sales", "sell_price", *lags, *_STATS, "price_lag_1", "price_diff_1", *_DATES]
    return i.rounded(f.feature_matrix(i.filled(spark, d)).select(*columns), 4, [*_STATS, "price_diff_1"])


def _split(spark, d):
    train, validation = i.split(spark, d)
    return train.select(*_KEY, F.lit("train").alias("part")).unionByName(validation.select(*_KEY, F.lit("validation").alias("part")))


def _additive(spark, d):
    return fc.additive_fit_predict(*i.split(spark, d))


def _naive(spark, d):
    """A second model for the comparison: the value 28 days earlier."""
    return i.split(spark, d)[1].select(
        "date", "store_id", "item_id", F.col("sales").alias("actual"), F.col("lag_28").cast("double").alias("predicted_demand"), F.lit("naive").alias("model_name")
    )


def _evaluated(spark, d):
    return fc.evaluate_models(_additive(spark, d), _naive(spark, d))


def _interval(spark, d):
    rows = fc.additive_fit_predict(*i.split(spark, d), interval=True)
    return i.rounded(rows.drop("model_name"))


def _failed(spark, d):
    """Fine grain, where most series have one or two days."""
    return fc.failed_series_report(fc.fit_additive(i.fact(spark, d)))


def _boosted_model(spark, d):
    train, validation = i.split(spark, d)
    key = (spark.sparkContext.applicationId, d)
    if key not in _fitted:
        _fitted[key] = boosted.fit_boosted(train)
    return _fitted[key], validation


def _boosted(spark, d):
    model, validation = _boosted_model(spark, d)
    return boosted.boosted_predict(model, validation)


def _recursive(spark, d):
    model, _ = _boosted_model(spark, d)
    return boosted.recursive_forecast(model, i.filled(spark, d))


def _forecast_job(spark, d):
    dataset = f"shelf_{scratch_path(spark, 'db').rsplit('-', 1)[1]}"
    tables.create_dataset(spark, dataset, scratch_path(spark, "forecast-job"))
    tables.write_table(i.series_mart(spark, d), f"{dataset}.{tables.MART}")
    return job_forecast(spark, dataset)["forecast"]


_LAST = "max(sales) FILTER (WHERE k = {0})"
_LAGS = ", ".join(f"CAST(coalesce({', '.join(_LAST.format(n) for n in (28, 14, 7, 1) if n <= k)}, 0) AS DOUBLE) AS lag_{k}" for k in (1, 7, 14, 28))
_ROLLED = ", ".join(
    f"{rnd(f'avg(sales) FILTER (WHERE k <= {n})', 4)} AS rolling_mean_{n}, {rnd(f'CASE WHEN count(*) >= {n} THEN stddev_pop(sales) FILTER (WHERE k <= {n}) ELSE 0 END', 4)} AS rolling_std_{n}"
    for n in (7, 28)
)
_STEP = f"""SELECT store_id, item_id, sell_price, last_date, {', '.join(f'lag_{k}' for k in (1, 7, 14, 28))}, {', '.join(f'rolling_{m}_{n}' for n in (7, 28) for m in ('mean', 'std'))},
    CAST(year(day0) AS INTEGER) AS year, CAST(month(day0) AS INTEGER) AS month, CAST(day(day0) AS INTEGER) AS day, CAST(isodow(day0) - 1 AS INTEGER) AS day_of_week,
    CAST(weekofyear(day0) AS INTEGER) AS week_of_year, CAST(isodow(day0) >= 6 AS INTEGER) AS is_weekend FROM (
    SELECT store_id, item_id, {rnd('max(sell_price) FILTER (WHERE k = 1)', 4)} AS sell_price, max(date) AS last_date, CAST(max(date) + 1 AS DATE) AS day0, {_LAGS}, {_ROLLED}
    FROM (SELECT *, row_number() OVER (PARTITION BY store_id, item_id ORDER BY date DESC) AS k FROM filled) GROUP BY 1, 2)"""

ENTRIES = {
    "load_series": (
        lambda s, d: fc.load_series(i.mart(s, d), k=20).select("date", "store_id", "item_id", "category", "department", "sales", "sell_price"),
        query(
            """SELECT date, m.store_id, m.item_id, category, department, coalesce(sales, 0) AS sales, coalesce(sell_price, 0) AS sell_price
            FROM mart m JOIN (SELECT store_id, item_id, sum(sales) AS t FROM mart GROUP BY 1, 2 ORDER BY t DESC, store_id, item_id LIMIT 20) k
            ON m.store_id = k.store_id AND m.item_id = k.item_id"""
        ),
    ),
    "calendar_features": (
        lambda s, d: f.calendar_features(i.fact(s, d)).select("date", "store_id", "item_id", *_DATES),
        query(
            """SELECT date, store_id, item_id, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, CAST(day(date) AS INTEGER) AS day,
            CAST(isodow(date) - 1 AS INTEGER) AS day_of_week, CAST(weekofyear(date) AS INTEGER) AS week_of_year,
            CAST(isodow(date) >= 6 AS INTEGER) AS is_weekend FROM fact"""
        ),
    ),
    "event_fill": (
        lambda s, d: f.event_fill(i.mart(s, d)).select("date", "store_id", "item_id", "event_name_1", "event_type_1"),
        query(
            """SELECT date, store_id, item_id, coalesce(event_name_1, 'None') AS event_name_1, coalesce(event_type_1, 'None') AS event_type_1 FROM mart"""
        ),
    ),
    "lag_features": (
        lambda s, d: f.lag_features(i.filled(s, d)).select(*_KEY, *[f"lag_{k}" for k in f.LAGS]),
        query("SELECT store_id, item_id, date, lag_1, lag_7, lag_14, lag_28 FROM windowed"),
    ),
    "rolling_features": (_rolling, query(f"SELECT store_id, item_id, date, {_STATS_SQL} FROM windowed")),
    "price_features": (
        lambda s, d: f.price_features(i.filled(s, d)).select(*_KEY, "price_lag_1", round_half_up("price_diff_1", 4).alias("price_diff_1")),
        query(f"SELECT store_id, item_id, date, price_lag_1, {rnd('price_diff_1', 4)} AS price_diff_1 FROM windowed"),
    ),
    "drop_warmup": (
        lambda s, d: f.drop_warmup(f.lag_features(i.filled(s, d))).select(*_KEY, "sales", "lag_28"),
        query("SELECT store_id, item_id, date, sales, lag_28 FROM featured"),
    ),
    "feature_matrix": (
        _matrix,
        query(
            f"""SELECT store_id, item_id, date, sales, sell_price, lag_1, lag_7, lag_14, lag_28, {_STATS_SQL}, price_lag_1,
            {rnd('price_diff_1', 4)} AS price_diff_1, {', '.join(_DATES)} FROM featured"""
        ),
    ),
    "time_split": (
        _split,
        query("SELECT store_id, item_id, date, 'train' AS part FROM train UNION ALL SELECT store_id, item_id, date, 'validation' FROM validation"),
    ),
    "series_pairing": (
        lambda s, d: joins.series_pairing(*i.split(s, d)),
        query(
            """SELECT * FROM (SELECT store_id, item_id, count(*) AS train_rows FROM train GROUP BY 1, 2)
            JOIN (SELECT store_id, item_id, count(*) AS validation_rows FROM validation GROUP BY 1, 2) USING (store_id, item_id)"""
        ),
    ),
    "attach_actuals": (
        lambda s, d: i.rounded(joins.attach_actuals(i.split(s, d)[1], _additive(s, d))),
        query(
            f"""SELECT v.store_id, v.item_id, v.date, v.sales AS actual, {rnd('predicted_demand', 4)} AS predicted_demand
            FROM validation v LEFT JOIN predictions p ON v.store_id = p.store_id AND v.item_id = p.item_id AND v.date = p.date"""
        ),
    ),
    "additive_fit_predict": (
        lambda s, d: i.rounded(_additive(s, d)),
        query(f"SELECT date, store_id, item_id, actual, {rnd('predicted_demand', 4)} AS predicted_demand, model_name FROM predictions"),
    ),
    "additive_future": (i.forecast, query("SELECT * FROM forecast")),
    "prediction_interval": (
        _interval,
        query(
            f"""SELECT c.date, c.store_id, c.item_id, actual, {rnd('greatest(yhat, 0)', 4)} AS predicted_demand, {rnd('yhat - 1.96e0 * s', 4)} AS lower_95,
            {rnd('yhat + 1.96e0 * s', 4)} AS upper_95 FROM scored c JOIN resid r ON c.store_id = r.store_id AND c.item_id = r.item_id"""
        ),
    ),
    "failed_series_report": (
        _failed,
        query(
            """SELECT store_id, item_id, count(*) AS n_days, 'fewer than two distinct days' AS reason FROM fact GROUP BY 1, 2
            HAVING count(DISTINCT date) < 2"""
        ),
    ),
    "forecast_metrics": (
        lambda s, d: fc.forecast_metrics(_additive(s, d).unionByName(_naive(s, d))),
        query("SELECT * FROM metrics"),
    ),
    "evaluate_models": (
        _evaluated,
        query("SELECT *, model = (SELECT arg_min(model, rmse) FROM metrics) AS is_best_model FROM metrics"),
    ),
    "pick_winner": (
        lambda s, d: fc.pick_winner(_evaluated(s, d)),
        query("SELECT model FROM metrics ORDER BY rmse, model LIMIT 1"),
    ),
    "check_forecast": (
        lambda s, d: fc.check_forecast(i.forecast(s, d)),
        query(
            """SELECT count(*) AS row_count, count(*) FILTER (WHERE predicted_demand < 0) AS negative_count,
            count(*) FILTER (WHERE predicted_demand IS NULL) AS null_count, count(DISTINCT (store_id, item_id)) AS series_count,
            count(*) > 0 AND count(*) FILTER (WHERE predicted_demand < 0 OR predicted_demand IS NULL) = 0 AS passed FROM forecast"""
        ),
    ),
    "additive_piecewise": (lambda s, d: piecewise.piecewise_fit_predict(*i.split(s, d)), None),
    "boosted_fit_predict": (_boosted, None),
    "recursive_forecast": (_recursive, None),
    # What does not depend on the trained trees, exactly: keys, dates, actuals, the features of the first step.
    "boosted_fit_predict_rows": (
        lambda s, d: _boosted(s, d).select("date", "store_id", "item_id", "actual", "model_name", (F.col("predicted_demand") >= 0).alias("not_negative")),
        query("SELECT date, store_id, item_id, sales AS actual, 'boosted' AS model_name, true AS not_negative FROM validation"),
    ),
    "recursive_forecast_rows": (
        lambda s, d: _recursive(s, d).select("forecast_date", "item_id", "store_id", "model_used", (F.col("predicted_demand") >= 0).alias("not_negative")),
        query(
            """SELECT CAST(unnest(generate_series(max(date) + 1, max(date) + 30, INTERVAL 1 DAY)) AS DATE) AS forecast_date, item_id, store_id,
            'boosted' AS model_used, true AS not_negative FROM filled GROUP BY item_id, store_id"""
        ),
    ),
    "forecast_step_features": (
        lambda s, d: i.rounded(boosted.step_features(boosted.last_known(i.filled(s, d)), 1).drop("sales_so_far"), 4),
        query(_STEP),
    ),
    "piecewise_interval": (
        lambda s, d: piecewise.piecewise_interval(i.filled(s, d)).select("forecast_date", "item_id", "store_id", "model_used", (F.col("lower_95") <= F.col("upper_95")).alias("ordered")),
        query(
            """SELECT CAST(unnest(generate_series(max(date) + 1, max(date) + 30, INTERVAL 1 DAY)) AS DATE) AS forecast_date, item_id, store_id,
            'additive_piecewise' AS model_used, true AS ordered FROM filled GROUP BY item_id, store_id HAVING min(date) < max(date)"""
        ),
    ),
    "job_forecast": (_forecast_job, None),
}
