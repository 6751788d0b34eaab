"""Choosing rows: first per key, largest, smallest, distinct, a stable sample."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.schemas import SERIES_KEY


def dedup_first(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """One row per key: the smallest by `order`, remaining columns breaking ties.

    Written as an aggregate rather than row_number(): copies of a key are reduced on the map
    side, so a key that owns a large share of the rows never lands in one task.
    """
    rest = [c for c in df.columns if c not in key]
    if not rest:
        return df.distinct()
    order = [c for c in order if c not in key]
    ranked = order + [c for c in rest if c not in order]
    first = df.groupBy(*key).agg(F.min(F.struct(*ranked)).alias("_first"))
    return first.select(*[F.col(c) if c in key else F.col(f"_first.{c}").alias(c) for c in df.columns])


def top_rows(df: DataFrame, by: str, k: int, tie: list[str], largest: bool = True) -> DataFrame:
    """k rows with the largest (or smallest) `by`; ties go to the smaller `tie` columns."""
    first = F.desc(by) if largest else F.asc(by)
    return df.orderBy(first, *[F.asc(c) for c in tie]).limit(k)


def series_totals(df: DataFrame) -> DataFrame:
    return df.groupBy(*SERIES_KEY).agg(F.sum("sales").alias("total_sales"))


def top_k_series(df: DataFrame, k: int) -> DataFrame:
    return top_rows(series_totals(df), "total_sales", k, SERIES_KEY)


def top_series_filter(df: DataFrame, k: int) -> DataFrame:
    """Rows of the k largest series. The k-row side is small enough to broadcast only when k is,
    and its size is known from the limit, so the choice is left to the optimizer."""
    return df.join(top_k_series(df, k).select(*SERIES_KEY), SERIES_KEY, "left_semi")


def distinct_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*columns).distinct()


def sample_rows(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """First n rows by a stable order (the feature behind a row-capped run)."""
    return df.orderBy(*order).limit(n)


def sort_output(df: DataFrame, columns: list[str]) -> DataFrame:
    """Order rows inside each output file; a global sort would add a shuffle for no reader."""
    return df.sortWithinPartitions(*columns)
