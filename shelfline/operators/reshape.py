"""Wide to long and back, totals on the wide form, and daily gap filling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.functions import clip_non_negative, coerce_long
from shelfline.operators.keep import dedup_first
from shelfline.schemas import ID_COLUMNS, SERIES_KEY, column_list, day_columns

# Attributes carried into inserted days.
CARRIED = ["state_id", "category", "department", "cat_id", "dept_id", "sell_price"]


def day_cells(df: DataFrame, names: list[str] | None = None) -> tuple[Column, bool]:
    """All day columns as one array, and whether its elements are already whole numbers."""
    names = day_columns(df) if names is None else names
    kinds = {df.schema[name].dataType for name in names}
    whole = all(isinstance(kind, T.IntegralType) for kind in kinds)
    cells = F.expr(f"array({column_list(names)})")
    if whole or len(kinds) == 1:
        return cells, whole
    texts = ", ".join(f"cast(`{name}` as string)" for name in names)
    return F.expr(f"array({texts})"), False


def _units(cell: Column, whole: bool) -> Column:
    number = F.coalesce(cell.cast("bigint"), F.lit(0).cast("bigint")) if whole else coerce_long(cell)
    return clip_non_negative(number)


def unpivot_days(df: DataFrame) -> DataFrame:
    """One row per series and day column. No shuffle: every wide row expands where it lies."""
    ids = [c for c in ID_COLUMNS if c in df.columns]
    cells, whole = day_cells(df)
    long = df.select(*ids, F.posexplode(cells).alias("_pos", "_cell"))
    labels = F.split(F.lit(",".join(day_columns(df))), ",")
    return long.select(*ids, F.element_at(labels, F.col("_pos") + 1).alias("d"), _units(F.col("_cell"), whole).alias("sales"))


def pivot_days(long: DataFrame, ids: list[str], names: list[str]) -> DataFrame:
    """Inverse of `unpivot_days`; the column list is explicit, so no extra pass finds it."""
    return long.groupBy(*ids).pivot("d", names).agg(F.sum("sales")).na.fill(0, names)


def wide_row_total(df: DataFrame) -> Column:
    """Sum of the clipped day cells of one wide row."""
    cells, whole = day_cells(df)
    return F.aggregate(cells, F.lit(0).cast("bigint"), lambda total, cell: total + _units(cell, whole))


def wide_sales_total(df: DataFrame) -> DataFrame:
    """Total units taken from the wide form, independent of the unpivot."""
    return df.select(wide_row_total(df).alias("units")).agg(
        F.coalesce(F.sum("units"), F.lit(0).cast("bigint")).alias("total_sales")
    )


def ffill_bfill(column: str, key: list[str], order: list[str]) -> Column:
    """Last known value up to this row, else the first known value of the whole series.

    Where nothing is known yet, the next known value is the first of the series, so one
    whole-partition frame replaces a frame that would be rescanned for every row.
    """
    ordered = Window.partitionBy(*key).orderBy(*order)
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return F.coalesce(F.last(column, ignorenulls=True).over(so_far), F.first(column, ignorenulls=True).over(whole))


def gap_fill_dates(df: DataFrame, unique: bool = False) -> DataFrame:
    """Every day from a series' first to its last date, inserted days with 0 sales.

    Each row emits itself and the missing days up to the next row, so there is no date spine and
    no join: one shuffle by series serves this and the later feature windows. Rows are first
    reduced to one per series and day unless `unique` says they already are; a series window
    therefore holds at most one row per day.

    Carried attributes are filled (last known, else next known) only in a series that has a gap;
    other columns are null on inserted days.
    """
    if not unique:
        df = dedup_first(df, [*SERIES_KEY, "date"], [c for c in ("sales", "sell_price") if c in df.columns])
    ordered = Window.partitionBy(*SERIES_KEY).orderBy("date")
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    carried = [c for c in CARRIED if c in df.columns]
    span = F.datediff(F.max("date").over(whole), F.min("date").over(whole)) + 1
    marked = df.withColumns(
        {
            "_next": F.lead("date").over(ordered),
            "_gappy": span > F.count(F.lit(1)).over(whole),
            **{f"_fill_{c}": ffill_bfill(c, SERIES_KEY, ["date"]) for c in carried},
        }
    )
    until = F.coalesce(F.date_sub("_next", 1), F.col("date"))
    days = marked.withColumn("_day", F.explode(F.sequence("date", until)))
    original = F.col("_day") == F.col("date")

    def value(name: str) -> Column:
        if name == "date":
            return F.col("_day").alias(name)
        if name in SERIES_KEY:
            return F.col(name)
        if name == "sales":
            filled = F.coalesce(F.when(original, F.col(name)), F.lit(0))
            return F.when(F.col("_gappy"), filled).otherwise(F.col(name)).alias(name)
        if name in carried:
            return F.when(F.col("_gappy"), F.col(f"_fill_{name}")).otherwise(F.col(name)).alias(name)
        return F.when(original, F.col(name)).alias(name)

    return days.select(*[value(name) for name in df.columns])
