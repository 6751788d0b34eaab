"""Rounding keeps what cannot be rounded, and a model with broken predictions never wins."""

import math

from pyspark.sql import functions as F

from shelfline.functions import round_half_up
from shelfline.operators.forecasting import evaluate_models, forecast_metrics, pick_winner


def test_round_half_up_extremes(spark):
    values = [0.12345, -2.5, 1e16, -1e16, float("inf"), float("-inf"), float("nan"), None]
    rows = [r[0] for r in spark.createDataFrame([(v,) for v in values], "x double").select(round_half_up("x", 4)).collect()]
    assert rows[:6] == [0.1235, -2.5, 1e16, -1e16, math.inf, -math.inf]
    assert math.isnan(rows[6]) and rows[7] is None


def _predictions(spark, model, values):
    rows = [("2020-01-01", "i", "s", 10.0, v, model) for v in values]
    names = "date string, item_id string, store_id string, actual double, predicted_demand double, model_name string"
    return spark.createDataFrame(rows, names).withColumn("date", F.to_date("date"))


def test_broken_models_do_not_win(spark):
    sound, broken, absent = (_predictions(spark, m, v) for m, v in (("sound", [9.0, 12.0]), ("a_nan", [10.0, math.nan]), ("a_null", [None])))
    rows = {r["model"]: r for r in evaluate_models(sound, broken, absent).collect()}
    assert [m for m, r in rows.items() if r["is_best_model"]] == ["sound"]
    assert all(math.isnan(rows["a_nan"][c]) for c in ("mae", "rmse", "smape"))
    assert pick_winner(forecast_metrics(sound.unionByName(broken))).first()[0] == "sound"
