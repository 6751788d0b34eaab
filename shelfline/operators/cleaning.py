"""Standardised copies of the three raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.functions import clean_text, coerce_long, to_number
from shelfline.operators.keep import dedup_first
from shelfline.schemas import ID_COLUMNS, PRICE_KEY, day_columns

# Calendar columns to convert.
WHOLE_NUMBERS = ["wm_yr_wk", "wday", "month", "year", "snap_CA", "snap_TX", "snap_WI"]
TEXTS = ["weekday", "d", "event_name_1", "event_type_1", "event_name_2", "event_type_2"]
# A full date, alone or before a time. A bare year or a bare time is no date.
DATE_SHAPE = r"^\s*\d{4}-\d{1,2}-\d{1,2}(\s*$|[ T])"


def parse_date(c):
    """Date from a date, a timestamp or ISO text; unreadable text becomes null."""
    text = F.col(c).cast("string")
    return F.when(text.rlike(DATE_SHAPE), F.to_date(F.trim(text).try_cast("timestamp")))


def clean_calendar(df: DataFrame) -> DataFrame:
    def cell(name: str):
        if name == "date":
            return parse_date(name).alias(name)
        if name in WHOLE_NUMBERS:
            return coerce_long(name).alias(name)
        if name in TEXTS:
            return clean_text(name).alias(name)
        return F.col(name)

    return df.select(*[cell(name) for name in df.columns])


def _clean_cell(df: DataFrame, name: str) -> str:
    """SQL for one day cell: unreadable or null to 0, negative to 0, whole units."""
    if isinstance(df.schema[name].dataType, T.IntegralType):
        return f"greatest(coalesce(`{name}`, 0), 0) AS `{name}`"
    number = f"try_cast(nullif(try_cast(`{name}` AS double), double('NaN')) AS bigint)"
    return f"greatest(coalesce({number}, 0), 0) AS `{name}`"


def clean_sales(df: DataFrame) -> DataFrame:
    """Trimmed ids (a null id stays null) and non-negative whole day cells, in one projection."""
    days = set(day_columns(df))

    def cell(name: str) -> str:
        if name in days:
            return _clean_cell(df, name)
        if name in ID_COLUMNS:
            return f"trim(cast(`{name}` AS string)) AS `{name}`"
        return f"`{name}`"

    return df.selectExpr(*[cell(name) for name in df.columns])


def clean_prices(df: DataFrame, tie_break: list[str] | None = None) -> DataFrame:
    """Typed prices, one row per store, item and week; an unreadable price is left null.

    `tie_break` names the columns that say which copy came first (for example a load number);
    without it the smallest price wins.
    """
    typed = df.withColumns(
        {
            "store_id": F.trim(F.col("store_id").cast("string")),
            "item_id": F.trim(F.col("item_id").cast("string")),
            "wm_yr_wk": coerce_long("wm_yr_wk"),
            "sell_price": to_number("sell_price"),
        }
    )
    return dedup_first(typed, PRICE_KEY, tie_break or ["sell_price"]).select(*PRICE_KEY, "sell_price")


def hierarchy_alias(df: DataFrame) -> DataFrame:
    """Add category and department from the ids where a table lacks them."""
    wanted = {"category": "cat_id", "department": "dept_id"}
    return df.withColumns({new: F.col(old) for new, old in wanted.items() if new not in df.columns and old in df.columns})
