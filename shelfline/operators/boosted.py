"""Global boosted-tree demand model and its multi-step forecast.

Training is the distributed tree learner of Spark ML. The forecast keeps each series' recent
sales in one array; every step derives the features from that array, scores a batch of series at
once on the trees as flat arrays, and appends the prediction.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.functions import clip_non_negative, is_weekend, monday_zero
from shelfline.operators.forecasting import BOOSTED, HORIZON_DAYS
from shelfline.schemas import SERIES_KEY
from shelfline.session import shared_dir

# Model inputs and learner settings.
FEATURES = [
    "lag_1",
    "lag_7",
    "lag_14",
    "lag_28",
    "rolling_mean_7",
    "rolling_std_7",
    "rolling_mean_28",
    "rolling_std_28",
    "year",
    "month",
    "day",
    "day_of_week",
    "week_of_year",
    "is_weekend",
    "sell_price",
]
TREES = 150
LEARNING_RATE = 0.05
SEED = 42
# Five levels give up to 32 leaves per tree.
DEPTH = 5
HISTORY = 28
# Series scored together: bounds the arrays of one step.
SERIES_AT_ONCE = 1024


def available_features(df: DataFrame) -> list[str]:
    return [c for c in FEATURES if c in df.columns]


def _assemble(df: DataFrame, features: list[str]) -> DataFrame:
    """Feature vector with nulls as 0, as the series were loaded."""
    ready = df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features})
    return VectorAssembler(inputCols=features, outputCol="features").transform(ready)


def fit_boosted(train: DataFrame, features: list[str] | None = None, trees: int = TREES) -> GBTRegressionModel:
    """Fit on all rows of all series; the feature list travels with the model."""
    features = features or available_features(train)
    context = train.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(train.sparkSession))
    # Node ids are not cached: at this depth, keeping and checkpointing them costs more than it saves.
    learner = GBTRegressor(
        featuresCol="features", labelCol="label", maxIter=trees, stepSize=LEARNING_RATE, maxDepth=DEPTH, seed=SEED, checkpointInterval=10
    )
    rows = _assemble(train.select(F.col("sales").cast("double").alias("label"), *features), features)
    model = learner.fit(rows.select("features", "label"))
    model.input_features = features
    return model


def boosted_predict(model: GBTRegressionModel, rows: DataFrame) -> DataFrame:
    scored = model.transform(_assemble(rows.withColumn("actual", F.col("sales")), model.input_features))
    return scored.select("date", *SERIES_KEY, "actual", clip_non_negative("prediction").alias("predicted_demand"), F.lit(BOOSTED).alias("model_name"))


def boosted_fit_predict(train: DataFrame, validation: DataFrame, trees: int = TREES) -> DataFrame:
    return boosted_predict(fit_boosted(train, trees=trees), validation)


def last_known(history: DataFrame) -> DataFrame:
    """One row per series: its last 28 sales oldest first, last price and last date."""
    latest = Window.partitionBy(*SERIES_KEY).orderBy(F.desc("date"))
    price = F.col("sell_price").cast("double") if "sell_price" in history.columns else F.lit(0.0)
    recent = history.select(*SERIES_KEY, "date", F.col("sales").cast("double").alias("sales"), price.alias("price"))
    recent = recent.withColumn("_n", F.row_number().over(latest)).filter(F.col("_n") <= HISTORY)
    rows = F.array_sort(F.collect_list(F.struct("date", "sales", "price")))
    return recent.groupBy(*SERIES_KEY).agg(rows.alias("rows")).select(
        *SERIES_KEY,
        F.transform("rows", lambda r: r["sales"]).alias("sales_so_far"),
        F.element_at("rows", -1)["price"].alias("sell_price"),
        F.element_at("rows", -1)["date"].alias("last_date"),
    )


def _lag(k: int) -> Column:
    """k-th last value; a shorter history falls back to the next shorter lag."""
    reach = [n for n in (28, 14, 7, 1) if n <= k]
    return F.coalesce(*[F.try_element_at(F.col("sales_so_far"), F.lit(-n)) for n in reach], F.lit(0.0))


def _tail(n: int) -> Column:
    h = F.col("sales_so_far")
    return F.when(F.size(h) >= n, F.slice(h, -n, n)).otherwise(h)


def _mean(values: Column) -> Column:
    total = F.aggregate(values, F.lit(0.0), lambda a, x: a + x)
    return F.coalesce(F.try_divide(total, F.size(values).cast("double")), F.lit(0.0))


def _population_std(n: int) -> Column:
    """Population deviation of the last n values, 0 for a shorter history. (The training features
    use the sample deviation; the difference is part of the specified behaviour.)"""
    values, mean = _tail(n), F.col(f"rolling_mean_{n}")
    squares = F.aggregate(values, F.lit(0.0), lambda a, x: a + (x - mean) * (x - mean))
    return F.when(F.size("sales_so_far") >= n, F.sqrt(squares / float(n))).otherwise(F.lit(0.0))


def step_features(state: DataFrame, step: int) -> DataFrame:
    """Feature columns for the day `step` days after each series' last date."""
    day = F.date_add("last_date", step)
    lags = {f"lag_{k}": _lag(k) for k in (1, 7, 14, 28)}
    means = {f"rolling_mean_{n}": _mean(_tail(n)) for n in (7, 28)}
    dates = {
        "year": F.year(day),
        "month": F.month(day),
        "day": F.dayofmonth(day),
        "day_of_week": monday_zero(day),
        "week_of_year": F.weekofyear(day),
        "is_weekend": is_weekend(day).cast("int"),
    }
    with_means = state.withColumns({**lags, **means, **dates})
    return with_means.withColumns({f"rolling_std_{n}": _population_std(n) for n in (7, 28)})


@dataclass(frozen=True)
class Forest:
    """All trees of a model as flat arrays: a node asks whether a feature is at most its threshold and
    goes left or right; a leaf points to itself. `roots` has one node per tree."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    weights: np.ndarray
    depth: int

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Weighted sum of the trees for every row of x, all rows and trees at once."""
        node = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            node = np.where(x[rows, self.feature[node]] <= self.threshold[node], self.left[node], self.right[node])
        return self.value[node] @ self.weights


def flat_forest(model: GBTRegressionModel) -> Forest:
    """Reads the trees of a fitted model from its description."""
    feature, threshold, left, right, value = [], [], [], [], []
    roots, open_, deepest = [], [], 0
    for line in model.toDebugString.splitlines():
        text = line.strip()
        if text.startswith("Tree "):
            open_ = []
            roots.append(len(value))
            continue
        if found := _ASKS.match(text):  # the second branch of the innermost open node is next
            if found["word"] == "Else":
                while open_[-1][1]:
                    open_.pop()
                open_[-1] = (open_[-1][0], True)
                continue
            new, cells = len(value), (int(found["feature"]), float(found["threshold"]), 0.0)
        elif text.startswith("Predict:"):
            new, cells = len(value), (0, np.inf, float(text.removeprefix("Predict:")))
        else:
            continue
        if open_:
            parent, second = open_[-1]
            (right if second else left)[parent] = new
        feature.append(cells[0]), threshold.append(cells[1]), value.append(cells[2]), left.append(new), right.append(new)
        if found:
            open_.append((new, False))
            deepest = max(deepest, len(open_))
    whole = lambda cells: np.array(cells, dtype=np.int64)
    return Forest(whole(feature), np.array(threshold), whole(left), whole(right), np.array(value), whole(roots), np.array(model.treeWeights), deepest)


_ASKS = re.compile(r"(?P<word>If|Else) \(feature (?P<feature>\d+) (<=|>) (?P<threshold>[^)]+)\)")


def _array_features(h: np.ndarray, size: np.ndarray, price: np.ndarray, day: np.ndarray) -> dict[str, np.ndarray]:
    """`step_features` for many series: h holds their values right-aligned, the last `size` of them count."""
    at = lambda k: np.where(size >= k, h[:, -k], np.nan)
    out, lag = {}, np.zeros(len(h))
    for k in (1, 7, 14, 28):
        lag = np.where(np.isnan(at(k)), lag, at(k))
        out[f"lag_{k}"] = lag
    for n in (7, 28):
        known = np.minimum(size, n)
        inside = [np.where(known >= k, h[:, -k], 0.0) for k in range(n, 0, -1)]  # oldest first, added in that order
        total = sum(inside, np.zeros(len(h)))
        mean = np.nan_to_num(np.divide(total, known, out=np.zeros(len(h)), where=known > 0))
        squares = sum(((x - mean) * (x - mean) for x in inside), np.zeros(len(h)))
        out[f"rolling_mean_{n}"] = mean
        out[f"rolling_std_{n}"] = np.nan_to_num(np.where(size >= n, np.sqrt(squares / n), 0.0))
    dates = pd.DatetimeIndex(day.astype("datetime64[D]").astype("datetime64[ns]"))
    out |= {"year": dates.year, "month": dates.month, "day": dates.day, "day_of_week": dates.weekday, "week_of_year": dates.isocalendar().week, "is_weekend": dates.weekday >= 5, "sell_price": price}
    return {name: np.asarray(cells, dtype=float) for name, cells in out.items()}


def recursive_forecast(model: GBTRegressionModel, history: DataFrame, horizon_days: int = HORIZON_DAYS) -> DataFrame:
    """`horizon_days` steps beyond each series' own last date; each step sees earlier predictions.

    The trees travel as flat arrays and all steps of a batch of series run in one narrow stage on its
    array of recent sales, so the only exchange is the one that brings the last days of a series together."""
    shared = history.sparkSession.sparkContext.broadcast((flat_forest(model), list(model.input_features)))  # trees x nodes numbers

    def ahead(batches):
        forest, names = shared.value
        for whole in batches:
            for start in range(0, whole.num_rows, SERIES_AT_ONCE):
                batch = whole.slice(start, SERIES_AT_ONCE)
                recent = batch.column("sales_so_far").to_pylist()
                size = np.array([len(values) for values in recent])
                h = np.full((len(recent), HISTORY + horizon_days), np.nan)
                for row, values in enumerate(recent):
                    h[row, HISTORY - len(values) : HISTORY] = values
                price = np.nan_to_num(batch.column("sell_price").to_numpy(zero_copy_only=False).astype(float))
                last = batch.column("last_date").to_numpy(zero_copy_only=False).astype("datetime64[D]")
                for step in range(horizon_days):
                    seen = h[:, step : HISTORY + step]
                    features = _array_features(seen, np.minimum(size + step, HISTORY), price, last + step + 1)
                    h[:, HISTORY + step] = np.maximum(0.0, forest.predict(np.column_stack([features[n] for n in names])))
                days = (last[:, None] + np.arange(1, horizon_days + 1)).ravel()
                times = lambda name: batch.column(name).take(pa.array(np.repeat(np.arange(len(recent)), horizon_days)))
                cells = [pa.array(days), times("item_id"), times("store_id"), pa.array(h[:, HISTORY:].ravel())]
                yield pa.RecordBatch.from_arrays(cells, ["forecast_date", "item_id", "store_id", "predicted_demand"])

    kinds = dict(history.dtypes)
    shape = f"forecast_date date, item_id {kinds['item_id']}, store_id {kinds['store_id']}, predicted_demand double"
    return last_known(history).mapInArrow(ahead, shape).withColumn("model_used", F.lit(BOOSTED))
