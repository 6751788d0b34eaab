"""Series preparation, the additive demand model, and model comparison.

The additive model is a linear trend plus a day-of-week effect per series. Both parts follow from
sums per series and weekday, so fitting is one aggregate that combines on the map side: there is
no loop over series and no per-series task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.functions import clip_non_negative, coerce_numeric, round_half_up
from shelfline.operators.cleaning import hierarchy_alias
from shelfline.operators.keep import top_series_filter
from shelfline.schemas import SERIES_KEY

ADDITIVE = "additive"
BOOSTED = "boosted"
VALIDATION_DAYS = 28
HORIZON_DAYS = 30
# Normal quantile for a two-sided 95 % interval.
INTERVAL_Z = 1.96
# A pair counts towards sMAPE only when the mean of |actual| and |predicted| exceeds this.
SMAPE_FLOOR = 1e-5
# Day numbers are counted from here to keep the sums small.
DAY_ZERO = "2000-01-01"


def load_series(mart: DataFrame, k: int | None = None) -> DataFrame:
    """Mart rows ready for modelling: numbers readable, nulls 0, optionally the k largest series."""
    sales_type = mart.schema["sales"].dataType.typeName()
    sales = F.coalesce(F.col("sales"), F.lit(0).cast("bigint")) if sales_type in ("long", "integer") else coerce_numeric("sales")
    ready = mart.withColumn("sales", sales)
    if "sell_price" in mart.columns:
        ready = ready.withColumn("sell_price", coerce_numeric("sell_price"))
    ready = hierarchy_alias(ready)
    return top_series_filter(ready, k) if k else ready


def cutoff_after_warmup(series: DataFrame, warmup_days: int = 28, validation_days: int = VALIDATION_DAYS) -> DataFrame:
    """Split date of the featured frame, worked out from the raw series.

    A gap-filled series keeps rows after warm-up only if it spans more than `warmup_days`, and its
    last date does not change, so no window has to run to find the latest date.
    """
    spans = series.groupBy(*SERIES_KEY).agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    kept = spans.filter(F.datediff("hi", "lo") >= warmup_days)
    return kept.agg(F.date_sub(F.max("hi"), validation_days).alias("cutoff"))


def time_split(df: DataFrame, validation_days: int = VALIDATION_DAYS, cutoff: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows up to, and after, the latest date overall minus `validation_days`.

    The date arrives as a scalar subquery. `cutoff` is a one-value frame for callers that know a
    cheaper way to it than scanning `df`.
    """
    if cutoff is None:
        cutoff = df.agg(F.date_sub(F.max("date"), validation_days).alias("cutoff"))
    edge = cutoff.scalar()
    return df.filter(F.col("date") <= edge), df.filter(F.col("date") > edge)


def _day_number(c) -> Column:
    return F.datediff(c, F.lit(DAY_ZERO).cast("date")).cast("bigint")


def fit_additive(df: DataFrame) -> DataFrame:
    """Trend and weekday effects: one row per series.

    Columns: intercept, slope, season (weekday -> effect), residual_std, n_days, last_date.
    slope is null when a series has fewer than two distinct days.
    """
    y, t = F.col("sales"), _day_number("date")
    by_weekday = (
        df.filter(y.isNotNull())
        .groupBy(*SERIES_KEY, F.weekday("date").alias("dow"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(y).alias("sy"),
            F.sum(t).alias("st"),
            F.sum(t * y).alias("sty"),
            F.sum(t * t).alias("stt"),
            F.sum(y * y).alias("syy"),
            F.max("date").alias("last_date"),
        )
    )

    def total(name: str) -> Column:
        return F.sum(name).cast("double").alias(name)

    # The collected list has one entry per weekday, so at most seven.
    sums = by_weekday.groupBy(*SERIES_KEY).agg(
        *[total(name) for name in ("n", "sy", "st", "sty", "stt", "syy")],
        F.max("last_date").alias("last_date"),
        F.collect_list(
            F.struct("dow", *[F.col(name).cast("double").alias(name) for name in ("n", "sy", "st")])
        ).alias("weekdays"),
    )
    n, sy, st, sty, stt, syy = (F.col(name) for name in ("n", "sy", "st", "sty", "stt", "syy"))
    trend = sums.withColumn("slope", F.try_divide(n * sty - st * sy, n * stt - st * st))
    trend = trend.withColumn("intercept", (sy - F.col("slope") * st) / n)
    a, b = F.col("intercept"), F.col("slope")
    season = F.map_from_entries(
        F.transform("weekdays", lambda d: F.struct(d["dow"].alias("dow"), (d["sy"] / d["n"] - (a + b * d["st"] / d["n"])).alias("effect")))
    )
    fitted = trend.withColumn("season", season)
    around_trend = syy - 2 * a * sy - 2 * b * sty + n * a * a + 2 * a * b * st + b * b * stt
    explained = F.aggregate(
        "weekdays", F.lit(0.0), lambda acc, d: acc + d["n"] * F.pow(F.element_at(F.col("season"), d["dow"]), F.lit(2.0))
    )
    spread = F.sqrt(F.try_divide(F.greatest(around_trend - explained, F.lit(0.0)), n - 1))
    return fitted.select(*SERIES_KEY, "intercept", "slope", "season", spread.alias("residual_std"), n.cast("bigint").alias("n_days"), "last_date")


def usable_fits(fits: DataFrame) -> DataFrame:
    return fits.filter(F.col("slope").isNotNull())


def failed_series_report(fits: DataFrame) -> DataFrame:
    """Series that cannot be fitted: they are reported and skipped, the rest go on."""
    return fits.filter(F.col("slope").isNull()).select(*SERIES_KEY, "n_days", F.lit("fewer than two distinct days").alias("reason"))


def _additive_value(date: Column) -> Column:
    effect = F.coalesce(F.try_element_at(F.col("season"), F.weekday(date)), F.lit(0.0))
    return F.col("intercept") + F.col("slope") * _day_number(date) + effect


def additive_predict(fits: DataFrame, rows: DataFrame, interval: bool = False) -> DataFrame:
    """Predictions for held-out rows of series that were fitted."""
    joined = rows.select(*SERIES_KEY, "date", F.col("sales").alias("actual")).join(usable_fits(fits), SERIES_KEY)
    value = _additive_value(F.col("date"))
    out = ["date", *SERIES_KEY, "actual", clip_non_negative(value).alias("predicted_demand"), F.lit(ADDITIVE).alias("model_name")]
    if interval:
        margin = F.lit(INTERVAL_Z) * F.col("residual_std")
        out += [(value - margin).alias("lower_95"), (value + margin).alias("upper_95")]
    return joined.select(*out)


def additive_fit_predict(train: DataFrame, validation: DataFrame, interval: bool = False) -> DataFrame:
    return additive_predict(fit_additive(train), validation, interval)


def additive_future(history: DataFrame, horizon_days: int = HORIZON_DAYS) -> DataFrame:
    """Fit on all history and forecast the days after each series' own last date, join-free."""
    fits = usable_fits(fit_additive(history))
    days = fits.withColumn(
        "forecast_date", F.explode(F.sequence(F.date_add("last_date", 1), F.date_add("last_date", horizon_days)))
    )
    return days.select(
        "forecast_date",
        "item_id",
        "store_id",
        clip_non_negative(_additive_value(F.col("forecast_date"))).alias("predicted_demand"),
        F.lit(ADDITIVE).alias("model_used"),
    )


def forecast_metrics(predictions: DataFrame) -> DataFrame:
    """MAE, RMSE and sMAPE per model in one pass; sMAPE skips pairs that are both about zero."""
    y, p = F.col("actual").cast("double"), F.col("predicted_demand")
    miss, size = F.abs(y - p), (F.abs(y) + F.abs(p)) / 2.0
    smape = F.avg(F.when(size > SMAPE_FLOOR, miss / size)) * 100.0
    return predictions.groupBy(F.col("model_name").alias("model")).agg(
        round_half_up(F.avg(miss), 4).alias("mae"),
        round_half_up(F.sqrt(F.avg((y - p) * (y - p))), 4).alias("rmse"),
        F.coalesce(round_half_up(smape, 2), F.lit(0.0)).alias("smape"),  # null: no pair above the floor
    )


def pick_winner(metrics: DataFrame) -> DataFrame:
    """The model with the lowest RMSE; the name decides a tie. NaN and null rank behind every number."""
    return metrics.agg(F.min_by("model", _rank()).alias("model"))


def _rank() -> Column:
    return F.struct(F.coalesce("rmse", F.lit(float("nan"))).alias("rmse"), "model")


def evaluate_models(*predictions: DataFrame) -> DataFrame:
    """Metrics of every model, the winner flagged. A model without predictions has no row."""
    if not predictions:
        raise ValueError("no predictions to evaluate")
    columns = ["date", *SERIES_KEY, "actual", "predicted_demand", "model_name"]
    stacked = predictions[0].select(*columns)
    for more in predictions[1:]:
        stacked = stacked.unionByName(more.select(*columns))
    # One pass over the predictions; the flag comes from the one-row-per-model result.
    scored = forecast_metrics(stacked).agg(
        F.collect_list(F.struct("model", "mae", "rmse", "smape")).alias("models"),
        F.min_by("model", _rank()).alias("best"),
    )
    return scored.select(F.explode("models").alias("m"), "best").select("m.*", (F.col("m.model") == F.col("best")).alias("is_best_model"))


def check_forecast(forecast: DataFrame) -> DataFrame:
    """Row count, violations and number of series of a forecast, in one row."""
    value = F.col("predicted_demand")
    per_series = forecast.groupBy(*SERIES_KEY).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(value < 0).alias("negative"), F.count_if(value.isNull() | F.isnan(value)).alias("missing")
    )
    return per_series.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("row_count"),
        F.coalesce(F.sum("negative"), F.lit(0)).cast("bigint").alias("negative_count"),
        F.coalesce(F.sum("missing"), F.lit(0)).cast("bigint").alias("null_count"),
        F.count(F.lit(1)).alias("series_count"),
    ).withColumn("passed", (F.col("row_count") > 0) & (F.col("negative_count") == 0) & (F.col("null_count") == 0))
