"""Additive model whose trend may bend, fitted with penalised least squares from sums per series.

A second variant of the additive model, after the published one: change points spread over the
first part of the history, weekly Fourier terms, and a prior that keeps bends small (normal here,
so the fit is one linear solve). Between two change points, and on one weekday, every term is a line
in time, so six sums per (series, weekday, segment) hold all that the fit needs: at most 7 x 26 rows
a series, however long it is. Each series is then solved on its own short array of sums.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.operators.forecasting import HORIZON_DAYS
from shelfline.schemas import SERIES_KEY

PIECEWISE = "additive_piecewise"
# Fixed values of the published model: change points, the share of history they cover, weekly
# Fourier order, prior scales of bends and of seasonal terms.
CHANGE_POINTS = 25
CHANGE_RANGE = 0.8
WEEKLY_ORDER = 3
BEND_SCALE = 0.05
SEASON_SCALE = 10.0
FLOOR = 1e-12
# Rows of history for every coefficient of the fit that estimates the noise.
ROWS_PER_TERM = 2
# Samples of simulated futures and the shares they are cut at.
SAMPLES, SEED, LEVELS = 1000, 42, (0.025, 0.975)

_FIT = "intercept double, slope double, season array<double>, bends array<double>, weights array<double>, noise double"


def _day(c) -> Column:
    return F.datediff(c, F.lit("1970-01-01").cast("date")).cast("bigint")


def _bends(count: int) -> np.ndarray:
    return np.linspace(0.0, CHANGE_RANGE, count + 1)[1:]


def series_sums(history: DataFrame) -> DataFrame:
    """One row per series: first day, span, rows, largest |sales|, last date, and its cells of sums.

    The series comes together once, by a window; the grouping by weekday and segment stays in place. Sums
    of whole units are exact, so a fit does not depend on the order of rows."""
    whole = Window.partitionBy(*SERIES_KEY)
    known = history.select(*SERIES_KEY, "date", F.col("sales").cast("double").alias("y")).where("y IS NOT NULL AND date IS NOT NULL")
    day = _day("date")
    rows = known.withColumns({
        "start": F.min(day).over(whole), "span": F.max(day).over(whole) - F.min(day).over(whole), "rows": F.count(F.lit(1)).over(whole),
        "unit": F.greatest(F.max(F.abs("y")).over(whole), F.lit(FLOOR)), "last_date": F.max("date").over(whole),
    }).where("span > 0")
    count = F.least(F.lit(CHANGE_POINTS), F.greatest(F.floor(F.col("rows") * CHANGE_RANGE) - 1, F.lit(0))).cast("int")
    d = day - F.col("start")
    # The segment of a day: how many change points lie before it.
    step = F.lit(CHANGE_RANGE) / F.col("count")
    segment = F.when(F.col("count") > 0, F.least(F.ceil(d / F.col("span") / step).cast("int") - 1, F.col("count"))).otherwise(0)
    placed = rows.withColumn("count", count).withColumns({"weekday": F.pmod(day, F.lit(7)).cast("int"), "segment": F.greatest(segment, F.lit(0)), "d": d})
    whole_series = [*SERIES_KEY, "start", "span", "rows", "unit", "last_date", "count"]
    cells = placed.groupBy(*whole_series, "weekday", "segment").agg(
        F.count(F.lit(1)).alias("n"), F.sum("d").alias("sd"), F.sum(F.col("d") * F.col("d")).alias("sdd"),
        F.sum("y").alias("sy"), F.sum(F.col("d") * F.col("y")).alias("sdy"), F.sum(F.col("y") * F.col("y")).alias("syy"),
    )
    cell = F.array(*[F.col(c).cast("double") for c in ("weekday", "segment", "n", "sd", "sdd", "sy", "sdy", "syy")])
    return cells.groupBy(*whole_series).agg(F.array_sort(F.collect_list(cell)).alias("cells"))


def _season(weekday: np.ndarray) -> np.ndarray:
    angle = 2.0 * np.pi * np.outer(weekday, np.arange(1, WEEKLY_ORDER + 1)) / 7.0
    return np.column_stack([np.sin(angle), np.cos(angle)])


def _pseudo_rows(cells: np.ndarray, span: float, bends: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Two weighted rows per cell that have the same least-squares problem as its days, and the squares
    that no fit can explain."""
    weekday, segment, n, sd, sdd, sy, sdy, syy = cells.T
    st, stt, sty = sd / span, (n * sdd - sd * sd) / (n * span * span), sdy / span  # stt around the cell's mean
    passed = np.arange(len(bends))[None, :] < segment[:, None]
    ones, none = np.ones((len(cells), 1)), np.zeros((len(cells), 2 * WEEKLY_ORDER))
    at_zero = np.hstack([ones, 0 * ones, _season(weekday), np.where(passed, -bends[None, :], 0.0)])
    per_time = np.hstack([0 * ones, ones, none, passed.astype(float)])
    root, spread = np.sqrt(n), np.sqrt(stt)
    first = root[:, None] * (at_zero + (st / n)[:, None] * per_time)
    second = spread[:, None] * per_time
    y_first = sy / root
    y_second = np.divide(sty - st * sy / n, spread, out=np.zeros(len(cells)), where=spread > 0)
    return np.vstack([first, second]), np.r_[y_first, y_second], float(np.maximum(syy - y_first**2 - y_second**2, 0.0).sum())


def solve_series(cells: np.ndarray, span: float, rows: int, count: int, unit: float) -> tuple[np.ndarray, np.ndarray, float]:
    """Coefficients in units of the largest value, change points, and the noise variance.

    Noise is what remains when the trend bends freely at as many of the change points as leave
    ROWS_PER_TERM rows for every coefficient, so a real bend is not mistaken for noise."""
    bends, fixed = _bends(count), 2 + 2 * WEEKLY_ORDER
    x, y, rest = _pseudo_rows(cells / np.array([1, 1, 1, 1, 1, unit, unit, unit * unit]), span, bends)
    free = min(count, max(0, (rows - 1) // ROWS_PER_TERM - fixed))
    chosen = [*range(fixed), *(fixed + np.unique(np.linspace(0, count - 1, free).round().astype(int)) if free else [])]
    left = y - x[:, chosen] @ np.linalg.lstsq(x[:, chosen], y, rcond=None)[0]
    noise = max((float(left @ left) + rest) / rows, FLOOR)
    scale = np.array([np.inf, np.inf] + [SEASON_SCALE] * (2 * WEEKLY_ORDER) + [BEND_SCALE] * count)
    weights = np.linalg.lstsq(x.T @ x + np.diag(noise / np.square(scale)), x.T @ y, rcond=None)[0]
    return weights, bends, noise


def fit_piecewise(history: DataFrame) -> DataFrame:
    """One row per series that has two different days: the sums' frame and the columns of _FIT."""
    sums = series_sums(history)
    kept = [c for c in sums.columns if c != "cells"]
    shape = ", ".join(f"`{c}` {t}" for c, t in sums.dtypes if c != "cells") + f", {_FIT}"

    def solve(batches):
        for batch in batches:
            found = []
            numbers = (batch.column(c).to_pylist() for c in ("cells", "span", "rows", "count", "unit"))
            for cells, span, rows, count, unit in zip(*numbers):
                w, bends, noise = solve_series(np.array(cells), float(span), rows, count, unit)
                season = _season(np.arange(7)) @ w[2 : 2 + 2 * WEEKLY_ORDER]
                found.append((w[0], w[1], season, bends, w[2 + 2 * WEEKLY_ORDER :], noise))
            names = [part.split()[0] for part in _FIT.split(", ")]
            cells = [pa.array(column, pa.list_(pa.float64()) if names[k] in ("season", "bends", "weights") else pa.float64()) for k, column in enumerate(zip(*found))]
            if found:
                yield pa.RecordBatch.from_arrays([batch.column(c) for c in kept] + cells, kept + names)

    return sums.mapInArrow(solve, shape)


def _trend(date: Column) -> Column:
    """Fitted value of a day in sales units, negative ones included."""
    t = (_day(date) - F.col("start")) / F.col("span")
    hinges = F.zip_with("bends", "weights", lambda at, weight: weight * F.greatest(t - at, F.lit(0.0)))
    bent = F.aggregate(hinges, F.lit(0.0), lambda total, part: total + part)
    season = F.element_at("season", F.pmod(_day(date), F.lit(7)).cast("int") + 1)
    return F.col("unit") * (F.col("intercept") + F.col("slope") * t + season + bent)


def piecewise_fit_predict(train: DataFrame, validation: DataFrame) -> DataFrame:
    asked = validation.select(*SERIES_KEY, "date", F.col("sales").cast("double").alias("actual"))
    value = F.greatest(_trend(F.col("date")), F.lit(0.0)).alias("predicted_demand")
    return asked.join(fit_piecewise(train), SERIES_KEY).select("date", *SERIES_KEY, "actual", value, F.lit(PIECEWISE).alias("model_name"))


def piecewise_future(history: DataFrame, horizon_days: int = HORIZON_DAYS) -> DataFrame:
    """Forecast of the days after each series' own last date, join-free."""
    days = F.explode(F.sequence(F.date_add("last_date", 1), F.date_add("last_date", horizon_days)))
    ahead = fit_piecewise(history).withColumn("forecast_date", days)
    value = F.greatest(_trend(F.col("forecast_date")), F.lit(0.0)).alias("predicted_demand")
    return ahead.select("forecast_date", "item_id", "store_id", value, F.lit(PIECEWISE).alias("model_used"))


def simulate_bounds(span: float, unit: float, weights: np.ndarray, noise: float, horizon: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Distances of the lower and upper bound from the forecast for every day ahead.

    Each sample lets the trend change again as often as the history's change points did, by Laplace
    steps of the size of the fitted bends, and adds noise; bounds are exact quantiles of the samples."""
    draw = np.random.default_rng(seed)
    size, often = float(np.mean(np.abs(weights))) if len(weights) else 0.0, len(weights) / span
    changes = draw.laplace(0.0, size or FLOOR, (SAMPLES, horizon)) * (draw.random((SAMPLES, horizon)) < often)
    slopes = np.cumsum(changes, axis=1)
    paths = (np.cumsum(slopes, axis=1) - slopes) / span  # a change on a day bends what follows it
    paths = (paths + draw.normal(0.0, np.sqrt(noise), (SAMPLES, 1))) * unit  # one draw a sample: bounds do not jitter by day
    low, high = np.quantile(paths, LEVELS, axis=0, method="inverted_cdf")
    return low, high


def piecewise_interval(history: DataFrame, horizon_days: int = HORIZON_DAYS, seed: int = SEED) -> DataFrame:
    """piecewise_future with lower_95 and upper_95 from simulated trend changes, so bounds widen with the
    distance. The draws of a series depend on the seed and its keys only, so any task gives the same."""
    fits = fit_piecewise(history)
    kinds = dict(fits.dtypes)
    fits = fits.withColumn("own_seed", F.xxhash64(F.lit(seed), *SERIES_KEY))
    kept = [*SERIES_KEY, "start", "span", "unit", "last_date", "intercept", "slope", "season", "bends", "weights"]
    shape = ", ".join(f"`{c}` {kinds[c]}" for c in kept) + ", below array<double>, above array<double>"

    def bounds(batches):
        for batch in batches:
            names = ("span", "unit", "weights", "noise", "own_seed")
            found = [
                simulate_bounds(float(span), unit, np.array(weights), noise, horizon_days, own % (1 << 64))
                for span, unit, weights, noise, own in zip(*(batch.column(c).to_pylist() for c in names))
            ]
            cells = [pa.array([list(side[k]) for side in found], pa.list_(pa.float64())) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in kept] + cells, [*kept, "below", "above"])

    rows = fits.mapInArrow(bounds, shape).withColumn("ahead", F.explode(F.sequence(F.lit(1), F.lit(horizon_days))))
    rows = rows.withColumn("forecast_date", F.date_add("last_date", F.col("ahead")))
    value = _trend(F.col("forecast_date"))
    return rows.select(
        "forecast_date", "item_id", "store_id", F.greatest(value, F.lit(0.0)).alias("predicted_demand"),
        (value + F.element_at("below", F.col("ahead"))).alias("lower_95"), (value + F.element_at("above", F.col("ahead"))).alias("upper_95"), F.lit(PIECEWISE).alias("model_used"),
    )
