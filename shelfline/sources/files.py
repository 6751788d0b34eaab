"""Typed readers of the three raw inputs, and file sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.schemas import CALENDAR, DAY_PREFIX, PRICES, sales_wide

CORRUPT = "_corrupt_record"
REASON = "reason"


def _read(spark: SparkSession, path: str, schema: T.StructType, fmt: str, keep_bad_rows: bool) -> DataFrame:
    """A cell that does not fit its type becomes null instead of failing the read. With
    `keep_bad_rows` the raw line is kept next to it."""
    if fmt == "parquet":
        df = spark.read.parquet(path)
        return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields if f.name in df.columns])
    # The file's own header gives the order; columns it has beyond the schema are left out.
    header = spark.read.option("header", True).csv(path).columns
    if missing := [f.name for f in schema.fields if f.name not in header]:
        raise ValueError(f"{path}: missing columns {missing}")
    known = {f.name: f.dataType for f in schema.fields}
    wanted = [f.name for f in schema.fields]
    if not keep_bad_rows:
        texts = spark.read.schema(T.StructType([T.StructField(name, T.StringType()) for name in header])).option("header", True).csv(path)
        return texts.selectExpr(*[f"{_cell(name, known[name])} AS `{name}`" for name in wanted])
    present = [T.StructField(name, known.get(name, T.StringType())) for name in header]
    if keep_bad_rows:
        present.append(T.StructField(CORRUPT, T.StringType()))
        wanted.append(CORRUPT)
    reader = spark.read.schema(T.StructType(present)).option("header", True).option("mode", "PERMISSIVE")
    rows = reader.option("columnNameOfCorruptRecord", CORRUPT).csv(path)
    return rows.selectExpr(*[f"`{name}`" for name in wanted])


def _cell(name: str, kind: T.DataType) -> str:
    """SQL that reads a text cell as its declared type; `2011.0` is a whole number, what does not fit is null."""
    if isinstance(kind, T.IntegralType):
        number = f"try_cast(`{name}` AS double)"
        return f"coalesce(try_cast(`{name}` AS bigint), CASE WHEN {number} = floor({number}) THEN try_cast({number} AS bigint) END)"
    return f"`{name}`" if isinstance(kind, T.StringType) else f"try_cast(`{name}` AS {kind.simpleString()})"


def scan_widened(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "csv") -> tuple[DataFrame, DataFrame]:
    """The rows with the narrowest type that holds each column's numbers, and the rejected rows.

    One pass over the texts decides per number column: whole numbers stay bigint, a fraction anywhere makes
    the column double. A row with a cell that is no number at all goes to the rejects, whole and as text,
    with the names of such cells in `reason`."""
    names = [f.name for f in schema.fields]
    texts = _read(spark, path, T.StructType([T.StructField(n, T.StringType()) for n in names]), fmt, False)
    numbers = [f.name for f in schema.fields if isinstance(f.dataType, T.NumericType)]
    whole = {f.name for f in schema.fields if isinstance(f.dataType, T.IntegralType)}
    value = lambda n: F.col(n).try_cast("double")
    broken = {n: F.col(n).isNotNull() & (value(n).isNull() | F.isnan(value(n))) for n in numbers}
    fraction = {n: F.coalesce(value(n) != F.floor(value(n)), F.lit(False)) for n in numbers if n in whole}
    found = texts.agg(F.count(F.lit(1)), *[F.count_if(test).alias(n) for n, test in fraction.items()]).first()
    kinds = {n: T.DoubleType() if n not in fraction or found[n] else T.LongType() for n in numbers}
    reason = F.array_join(F.array_compact(F.array(*[F.when(broken[n], F.lit(n)) for n in numbers])), ", ") if numbers else F.lit("")
    judged = texts.withColumn(REASON, reason)
    good = judged.where(F.col(REASON) == "").selectExpr(*[f"{_cell(n, kinds.get(n, T.StringType()))} AS `{n}`" for n in names])
    return good, judged.where(F.col(REASON) != "")


def scan_calendar(spark: SparkSession, path: str, fmt: str = "csv", keep_bad_rows: bool = False) -> DataFrame:
    return _read(spark, path, CALENDAR, fmt, keep_bad_rows)


def scan_prices(spark: SparkSession, path: str, fmt: str = "csv", keep_bad_rows: bool = False) -> DataFrame:
    return _read(spark, path, PRICES, fmt, keep_bad_rows)


def scan_sales_wide(spark: SparkSession, path: str, fmt: str = "csv", keep_bad_rows: bool = False) -> DataFrame:
    """The day columns come from the header, so only the first line is read to plan the scan. Cells
    are read as text and then converted, so `3.0` and counts beyond 32 bits keep their units."""
    header = spark.read.option("header", True).csv(path) if fmt == "csv" else spark.read.parquet(path)
    days = [c for c in header.columns if c.startswith(DAY_PREFIX)]
    rows = _read(spark, path, sales_wide(days), fmt, keep_bad_rows)
    cell = "coalesce(try_cast(`{0}` AS bigint), try_cast(try_cast(`{0}` AS double) AS bigint)) AS `{0}`"
    chosen = set(days)
    return rows.selectExpr(*[cell.format(c) if c in chosen else f"`{c}`" for c in rows.columns])


def load_sources(spark: SparkSession, folder: str, fmt: str = "csv") -> dict[str, DataFrame]:
    """The three inputs of one folder as a set."""
    base = folder.rstrip("/")
    return {
        "calendar": scan_calendar(spark, f"{base}/calendar.{fmt}", fmt),
        "sales": scan_sales_wide(spark, f"{base}/sales_train_validation.{fmt}", fmt),
        "prices": scan_prices(spark, f"{base}/sell_prices.{fmt}", fmt),
    }


def write_snapshot(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def export_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header, one file per partition."""
    df.write.mode(mode).option("header", True).csv(path)


def write_report(lines: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Report lines (column `line`) as text."""
    lines.select("line").write.mode(mode).text(path)
