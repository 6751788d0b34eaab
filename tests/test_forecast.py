"""Features, models, metrics, inventory."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

import frames
from shelfline.operators import boosted, features, forecasting as fc, inventory as inv, piecewise, reshape, serving as sv

D = dt.date


def test_features_of_a_ramp(spark):
    rows = features.feature_matrix(frames.one_series(spark)).orderBy("date").collect()
    assert len(rows) == 12
    first = rows[0]
    assert (first.sales, first.lag_1, first.lag_7, first.lag_28) == (29, 28, 22, 1)
    assert (first.rolling_mean_7, first.rolling_mean_28) == (25.0, 14.5)
    assert first.rolling_std_7 == pytest.approx(np.std(range(22, 29), ddof=1))
    assert (first.day_of_week, first.is_weekend, first.price_diff_1) == (4, 0, 0.0)


def test_features_do_not_look_ahead(spark):
    base = frames.one_series(spark)
    changed = base.withColumn("sales", F.when(F.col("date") == D(2021, 2, 9), 999).otherwise(F.col("sales")).cast("bigint"))
    keep = [c for c in features.feature_matrix(base).columns if c != "sales"]
    left, right = (features.feature_matrix(df).select(*keep).collect() for df in (base, changed))
    assert left == right


def test_time_split_uses_the_global_date(spark):
    both = frames.one_series(spark).unionByName(frames.one_series(spark, 20, item="J"))
    train, validation = fc.time_split(both)
    assert train.agg(F.max("date")).first()[0] == D(2021, 2, 9) - dt.timedelta(28)
    assert {r.item_id for r in validation.collect()} == {"I", "J"}
    assert train.count() + validation.count() == 60


def test_cutoff_shortcut_equals_the_featured_frame(spark):
    series = frames.one_series(spark, 60, skip=(5, 6)).unionByName(
        frames.one_series(spark, 25, item="J").withColumn("date", F.date_add("date", 60))
    )
    featured = features.feature_matrix(reshape.gap_fill_dates(series))
    direct = featured.agg(F.date_sub(F.max("date"), 28)).first()[0]
    assert fc.cutoff_after_warmup(series).first()[0] == direct


def additive_by_hand(days, values):
    t = np.array(days, float)
    y = np.array(values, float)
    slope, intercept = np.polyfit(t, y, 1)
    rest = y - (intercept + slope * t)
    dow = np.array([(d + 3) % 7 for d in days])
    season = {k: rest[dow == k].mean() for k in set(dow)}
    return lambda d: intercept + slope * d + season.get((d + 3) % 7, 0.0)


def test_additive_model_against_numpy(spark):
    base = D(2021, 1, 1)
    values = [(7 * n) % 13 + n // 3 for n in range(50)]
    rows = [(base + dt.timedelta(n), "I", "D", "C", "S", "ST", v, 5.0) for n, v in enumerate(values)]
    series = frames.fact(spark, rows)
    start = (base - D(1970, 1, 1)).days
    predict = additive_by_hand([start + n for n in range(50)], values)
    future = fc.additive_future(series, 10).orderBy("forecast_date").collect()
    assert [r.forecast_date for r in future] == [base + dt.timedelta(50 + n) for n in range(10)]
    for n, row in enumerate(future):
        assert row.predicted_demand == pytest.approx(max(0.0, predict(start + 50 + n)), abs=1e-8)
    fitted = fc.fit_additive(series).first()
    residuals = [v - predict(start + n) for n, v in enumerate(values)]
    assert fitted.residual_std == pytest.approx(np.std(residuals, ddof=1), rel=1e-8)


def test_failed_series_are_reported_and_skipped(spark):
    both = frames.one_series(spark).unionByName(frames.one_series(spark, 1, item="J"))
    fits = fc.fit_additive(both)
    assert [r.item_id for r in fc.failed_series_report(fits).collect()] == ["J"]
    assert {r.item_id for r in fc.additive_future(both, 3).collect()} == {"I"}


def predictions(spark, pairs, name="m"):
    rows = [(D(2021, 1, 1) + dt.timedelta(n), "S", "I", float(y), float(p), name) for n, (y, p) in enumerate(pairs)]
    return spark.createDataFrame(rows, "date date, store_id string, item_id string, actual double, predicted_demand double, model_name string")


PAIRS = [(10, 12), (20, 18), (30, 33), (40, 38), (50, 52)]


def test_metrics(spark):
    row = fc.forecast_metrics(predictions(spark, PAIRS)).first()
    assert (row.mae, round(row.rmse, 2)) == (2.2, 2.24)
    with_zero = fc.forecast_metrics(predictions(spark, [*PAIRS, (0, 0)])).first()
    assert with_zero.smape == row.smape
    assert fc.forecast_metrics(predictions(spark, [(0, 0)])).first().smape == 0.0


def test_winner(spark):
    good, bad = predictions(spark, PAIRS, "b"), predictions(spark, [(10, 50)], "a")
    result = {r.model: r.is_best_model for r in fc.evaluate_models(good, bad).collect()}
    assert result == {"b": True, "a": False}
    assert fc.pick_winner(fc.evaluate_models(good, bad)).first().model == "b"
    with pytest.raises(ValueError):
        fc.evaluate_models()


def test_check_forecast(spark):
    forecast = fc.additive_future(frames.one_series(spark), 5)
    row = fc.check_forecast(forecast).first()
    assert (row.row_count, row.series_count, row.passed) == (5, 1, True)
    assert not fc.check_forecast(forecast.limit(0)).first().passed
    assert not fc.check_forecast(forecast.withColumn("predicted_demand", F.lit(-1.0))).first().passed


@pytest.fixture(scope="module")
def tree_model(spark):
    series = frames.one_series(spark, 80).unionByName(frames.one_series(spark, 60, item="J"))
    featured = features.feature_matrix(series).persist()
    return boosted.fit_boosted(featured, trees=4), series, featured


def test_boosted_predictions(tree_model):
    model, _, featured = tree_model
    rows = boosted.boosted_predict(model, featured).collect()
    assert len(rows) == featured.count() and min(r.predicted_demand for r in rows) >= 0
    assert sum(abs(r.predicted_demand - r.actual) for r in rows) / len(rows) < 12


def test_recursive_forecast(spark, tree_model):
    model, series, _ = tree_model
    forecast = boosted.recursive_forecast(model, series, 7).collect()
    assert len(forecast) == 14 and min(r.predicted_demand for r in forecast) >= 0
    first = {r.item_id: r for r in forecast if (r.item_id, r.forecast_date) in {("I", D(2021, 3, 22)), ("J", D(2021, 3, 2))}}
    assert set(first) == {"I", "J"}
    # Step 1 equals one-step scoring of hand-made features.
    row = {
        "lag_1": 80, "lag_7": 74, "lag_14": 67, "lag_28": 53,
        "rolling_mean_7": 77.0, "rolling_std_7": 2.0, "rolling_mean_28": 66.5, "rolling_std_28": float(np.std(range(53, 81))),
        "year": 2021, "month": 3, "day": 22, "day_of_week": 0, "week_of_year": 12, "is_weekend": 0, "sell_price": 5.0,
    }
    scored = model.transform(boosted._assemble(spark.createDataFrame([row]), model.input_features)).first().prediction
    assert first["I"].predicted_demand == pytest.approx(max(0.0, scored))


def test_flat_forest_takes_the_same_steps(spark, tree_model):
    """Against one Spark scoring per step, for long, short and one-row series; one exchange, no checkpoint."""
    model, series, _ = tree_model
    history = series.unionByName(frames.one_series(spark, 9, item="K")).unionByName(frames.one_series(spark, 1, item="L"))
    df = boosted.recursive_forecast(model, history, 6)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Scan ExistingRDD" not in plan.replace("Scan ExistingRDD[date", "")
    got = {(r.item_id, r.forecast_date): r.predicted_demand for r in df.collect()}
    state = boosted.last_known(history)
    for step in range(1, 7):
        scored = model.transform(boosted._assemble(boosted.step_features(state, step), model.input_features))
        value = F.greatest(F.lit(0.0), F.col("prediction"))
        rows = scored.select("store_id", "item_id", "sell_price", "last_date", F.concat("sales_so_far", F.array(value)).alias("sales_so_far")).collect()
        for r in rows:
            assert got[r.item_id, r.last_date + dt.timedelta(step)] == pytest.approx(r.sales_so_far[-1], abs=1e-9)
        state = spark.createDataFrame(rows, "store_id string, item_id string, sell_price double, last_date date, sales_so_far array<double>")


def test_forest_arrays_agree_with_the_model(spark, tree_model):
    model, _, featured = tree_model
    forest = boosted.flat_forest(model)
    assert len(forest.roots) == 4 and forest.depth <= boosted.DEPTH
    rows = model.transform(boosted._assemble(featured, model.input_features)).select("features", "prediction").collect()
    x = np.array([r.features.toArray() for r in rows])
    assert np.allclose(forest.predict(x), [r.prediction for r in rows], rtol=0, atol=1e-9)


def test_step_features_of_a_short_series(spark):
    state = boosted.last_known(frames.one_series(spark, 10))
    row = boosted.step_features(state, 1).first()
    assert (row.lag_1, row.lag_7, row.lag_14, row.lag_28) == (10.0, 4.0, 4.0, 4.0)
    assert (row.rolling_mean_7, row.rolling_mean_28, row.rolling_std_28) == (7.0, 5.5, 0.0)
    one = boosted.step_features(boosted.last_known(frames.one_series(spark, 1)), 1).first()
    assert (one.lag_28, one.rolling_mean_7, one.rolling_std_7) == (1.0, 1.0, 0.0)


def test_safety_stock_and_z(spark):
    sales = [10, 12, 8, 15, 9, 11, 14, 7, 10, 13]
    rows = [(D(2021, 1, 1) + dt.timedelta(n), "I", "D", "C", "S", "ST", v, 5.0) for n, v in enumerate(sales)]
    row = inv.safety_stock(frames.fact(spark, rows)).first()
    assert row.safety_stock == math.ceil(1.65 * np.std(sales, ddof=1) * math.sqrt(7)) > 0
    assert inv.safety_stock(frames.fact(spark, rows[:1])).first().safety_stock == 0.0
    assert inv.z_score(0.95) == 1.65 and inv.z_score(0.951) == 1.65
    assert inv.z_score(0.95, "quantile") == pytest.approx(1.6449, abs=1e-4)


def test_reorder_point(spark):
    summary = spark.createDataFrame([("S", "I", 300.0, 10.0), ("S", "J", 30.0, 1.0)], "store_id string, item_id string, total_30d_forecast double, avg_daily_forecast double")
    stock = spark.createDataFrame([("S", "I", 15.0)], "store_id string, item_id string, safety_stock double")
    got = {r.item_id: (r.safety_stock, r.reorder_point) for r in inv.reorder_point(summary, stock).collect()}
    assert got == {"I": (15.0, 85.0), "J": (0.0, 7.0)}


def test_risk_and_quantity_policies(spark):
    df = spark.createDataFrame(
        [(5.0, 10.0, 25.0, 60.0), (15.0, 10.0, 25.0, 60.0), (30.0, 10.0, 25.0, 60.0), (40.0, 10.0, 25.0, 1.0)],
        "available_inventory double, safety_stock double, reorder_point double, total_30d_forecast double",
    )
    got = df.select(inv.risk_class().alias("a"), inv.risk_class("rop_band").alias("b"), inv.order_quantity().alias("c"), inv.order_quantity("rop").alias("d")).collect()
    assert [r.a for r in got] == ["HIGH", "MEDIUM", "LOW", "LOW"]
    assert [r.b for r in got] == ["HIGH", "HIGH", "MEDIUM", "LOW"]
    assert [r.c for r in got] == [65.0, 55.0, 40.0, 0.0] and [r.d for r in got] == [20.0, 10.0, 0.0, 0.0]


def test_scenarios(spark):
    history = frames.one_series(spark)
    forecast = fc.additive_future(history)
    plan = inv.inventory_recommendations(forecast, history)
    assert plan.count() == 1 and len(plan.columns) == 10
    for change, factor in ((-0.10, 1.12), (0.0, 1.0), (0.10, 0.88)):
        base = forecast.agg(F.sum("predicted_demand")).first()[0]
        assert inv.price_scenario(forecast, change).agg(F.sum("predicted_demand")).first()[0] == pytest.approx(base * factor)
    alone = inv.inventory_scenario(plan, forecast.limit(0)).first()
    assert (alone.demand_mean, alone.demand_std) == (6.0, 1.2)
    assert alone.safety_stock == round(inv.z_score(0.95, "quantile") * 1.2 * math.sqrt(7))
    assert sv.kpi_summary(forecast, plan).first().total_order_quantity == plan.first().recommended_order_quantity


def test_filters(spark):
    mart = frames.fact(spark).withColumn("category", F.col("cat_id"))
    assert sv.slice_filter(mart, store="CA_1", item="H1").count() == 4
    got = {(r["filter"], r["value"]) for r in sv.filter_options(mart, "CA_1", "FOODS").collect()}
    assert got == {("store_id", "CA_1"), ("store_id", "TX_1"), ("category", "FOODS"), ("category", "HOBBIES"), ("item_id", "F1")}


def test_piecewise_trend_follows_a_bend(spark):
    base = D(2021, 1, 1)
    # Flat, then rising, with a weekly pattern; the straight trend misses the later level.
    values = [40 + (n % 7) * 3 + max(0, n - 100) for n in range(200)]
    rows = [(base + dt.timedelta(n), "I", "D", "C", "S", "ST", v, 5.0) for n, v in enumerate(values)]
    short = [(base, "J", "D", "C", "S", "ST", 3, 5.0), (base + dt.timedelta(180), "J", "D", "C", "S", "ST", 3, 5.0)]
    train, validation = fc.time_split(frames.fact(spark, rows + short))
    bent = piecewise.piecewise_fit_predict(train, validation)
    assert {r.item_id for r in bent.collect()} == {"I"} and bent.count() == 28
    straight = fc.additive_fit_predict(train, validation)

    def mae(df):
        return fc.forecast_metrics(df).first().mae

    assert mae(bent) < 3 < mae(straight)
    future = piecewise.piecewise_future(frames.fact(spark, rows), 7).orderBy("forecast_date").collect()
    assert len(future) == 7 and future[0].forecast_date == base + dt.timedelta(200)


def plain_piecewise(days, y, ahead):
    """The same model fitted on all rows at once."""
    days, y, ahead = (np.array(v, dtype=float) for v in (days, y, ahead))
    unit, start, span = max(np.abs(y).max(), 1e-12), days.min(), np.ptp(days)
    n = min(25, max(int(len(y) * 0.8) - 1, 0))
    bends = np.linspace(0.0, 0.8, n + 1)[1:]

    def design(day):
        t, angle = (day - start) / span, 2.0 * np.pi * np.outer(day, np.arange(1, 4)) / 7.0
        return np.column_stack([np.ones_like(t), t, np.sin(angle), np.cos(angle), np.maximum(t[:, None] - bends[None, :], 0.0)])

    x = design(days)
    free = min(n, max(0, (len(y) - 1) // 2 - 8))
    chosen = [*range(8), *(8 + np.unique(np.linspace(0, n - 1, free).round().astype(int)) if free else [])]
    noise = max(float(np.mean((y / unit - x[:, chosen] @ np.linalg.lstsq(x[:, chosen], y / unit, rcond=None)[0]) ** 2)), 1e-12)
    scale = np.array([np.inf] * 2 + [10.0] * 6 + [0.05] * n)
    w = np.linalg.lstsq(x.T @ x + np.diag(noise / scale**2), x.T @ y / unit, rcond=None)[0]
    return np.maximum(design(ahead) @ w * unit, 0.0)


def noisy(spark, lengths, seed=5):
    rng, rows = np.random.default_rng(seed), []
    for item, n in lengths.items():
        for k in sorted(rng.choice(n * 2, n, replace=False)):
            y = int(50 + 0.3 * k - 0.5 * max(0, k - n) + 8 * (k % 7 == 3) + rng.normal() * 4)
            rows.append((D(2021, 1, 1) + dt.timedelta(int(k)), item, "D", "C", "S", "ST", y, 5.0))
    return rows


def test_piecewise_from_sums_equals_fit_on_rows(spark):
    """Short, middle and long series with gaps, and one with a single day, which is left out."""
    rows = noisy(spark, {"A": 3, "B": 12, "C": 40, "E": 66, "F": 90, "G": 700}) + [(D(2021, 1, 1), "H", "D", "C", "S", "ST", 3, 5.0)]
    got = {}
    df = piecewise.piecewise_future(frames.fact(spark, rows), 20)
    for r in df.collect():
        got.setdefault(r.item_id, []).append((r.forecast_date, r.predicted_demand))
    assert set(got) == {"A", "B", "C", "E", "F", "G"}
    number = lambda d: (d - D(1970, 1, 1)).days
    for item, found in got.items():
        own = [r for r in rows if r[1] == item]
        ahead, values = zip(*sorted(found))
        want = plain_piecewise([number(r[0]) for r in own], [r[6] for r in own], [number(d) for d in ahead])
        assert np.allclose(values, want, rtol=1e-6, atol=1e-6), item
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]
    assert "FlatMapGroups" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_simulated_bounds_widen_and_repeat(spark):
    history = frames.fact(spark, noisy(spark, {"F": 90, "G": 700}))
    one, two = (sorted(map(tuple, piecewise.piecewise_interval(history, 30).collect())) for _ in range(2))
    assert one == two
    other = sorted(map(tuple, piecewise.piecewise_interval(history.repartition(5, "date"), 30).collect()))
    assert [r[:3] for r in one] == [r[:3] for r in other] and np.allclose([r[3:6] for r in one], [r[3:6] for r in other], atol=1e-6)
    for item in ("F", "G"):
        width = [r[5] - r[4] for r in one if r[1] == item]
        assert np.mean(width[-5:]) > np.mean(width[:5]) and min(width) > 0
    low, high = piecewise.simulate_bounds(100.0, 10.0, np.zeros(0), 0.04, 400, 1)
    # Noise alone: the quantile of 1,000 draws has a standard error of 0.17 here.
    assert np.mean(low) == pytest.approx(-1.96 * 2, abs=0.5) and np.mean(high) == pytest.approx(1.96 * 2, abs=0.5)
