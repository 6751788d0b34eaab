"""Model features per series. All windows share one specification, so the plan holds a single
shuffle and sort by series; after gap filling a series has one row per day."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfline.functions import is_weekend, monday_zero
from shelfline.schemas import SERIES_KEY

LAGS = (1, 7, 14, 28)
SPANS = (7, 28)
WARMUP_LAG = 28


def _by_date():
    return Window.partitionBy(*SERIES_KEY).orderBy("date")


def calendar_features(df: DataFrame) -> DataFrame:
    """Date parts with Monday = 0 and ISO weeks; replaces same-named columns."""
    return df.withColumns(
        {
            "year": F.year("date"),
            "month": F.month("date"),
            "day": F.dayofmonth("date"),
            "day_of_week": monday_zero("date"),
            "week_of_year": F.weekofyear("date"),
            "is_weekend": is_weekend("date").cast("int"),
        }
    )


def event_fill(df: DataFrame) -> DataFrame:
    names = [c for c in ("event_name_1", "event_type_1") if c in df.columns]
    return df.withColumns({c: F.coalesce(F.col(c), F.lit("None")) for c in names}) if names else df


def lag_features(df: DataFrame) -> DataFrame:
    w = _by_date()
    return df.withColumns({f"lag_{k}": F.lag("sales", k).over(w) for k in LAGS})


def rolling_features(df: DataFrame) -> DataFrame:
    """Mean and sample deviation of the rows before the current one; deviation 0 when undefined."""
    columns = {}
    for n in SPANS:
        before = _by_date().rowsBetween(-n, -1)
        columns[f"rolling_mean_{n}"] = F.avg("sales").over(before)
        columns[f"rolling_std_{n}"] = F.coalesce(F.stddev_samp("sales").over(before), F.lit(0.0))
    return df.withColumns(columns)


def price_features(df: DataFrame) -> DataFrame:
    if "sell_price" not in df.columns:
        return df
    previous = F.lag("sell_price", 1).over(_by_date())
    return df.withColumns({"price_lag_1": previous, "price_diff_1": F.col("sell_price") - previous})


def drop_warmup(df: DataFrame) -> DataFrame:
    return df.filter(F.col(f"lag_{WARMUP_LAG}").isNotNull())


def feature_matrix(df: DataFrame) -> DataFrame:
    """All features of a gap-filled frame, without each series' first 28 days."""
    windows = price_features(rolling_features(lag_features(df)))
    return drop_warmup(event_fill(calendar_features(windows)))
