"""Audits of the three raw tables.

An audit is defined as plain aggregates over one pass. They can be computed by a query of their own or
observed while the cleaned table is written, which saves that scan; repeated keys need a grouping.
Every audit gives rows of AUDIT: shape, column types, nulls per column, statistics, and checks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.functions import outside_domain, percent, round_half_up, status, to_number
from shelfline.functions.observed import seen_by
from shelfline.operators.cleaning import parse_date
from shelfline.operators.reshape import day_cells
from shelfline.schemas import ID_COLUMNS, PRICE_KEY, day_columns

# Check names, allowed event types and limits.
EVENT_TYPES = ["Sporting", "Cultural", "National", "Religious"]
YEAR_RANGE = (2000, 2050)
OUTLIER_UNITS = 500
CALENDAR_CHECKS = [
    "Missing Dates",
    "Duplicate Dates",
    "Valid Date Format",
    "Missing Weekday Values",
    "Valid Year/Week Ranges",
    "Unexpected Event Types",
    "Event Coverage",
]
SALES_CHECKS = [
    "Duplicate Item-Store Identifiers",
    "Missing Primary Identifiers",
    "Missing Department/Category Information",
    "Negative Sales Volumes",
    "Missing Sales Values",
    "Numeric Sales Data Types",
    "Sales Outliers Audit",
]
PRICE_CHECKS = [
    "Duplicate Store-Item-Week Keys",
    "Missing Identifiers (Store/Item/Week)",
    "Missing Prices",
    "Negative Prices",
    "Zero Prices",
    "Numeric Price Data Type",
]
# Checks that report a number but never fail, with the words for it.
INFORMATIONAL = {"Event Coverage": "days with an event", "Sales Outliers Audit": f"cells above {OUTLIER_UNITS}"}

KEYS = {"calendar": ["date"], "sales": ["item_id", "store_id"], "prices": PRICE_KEY}
AUDIT = "dataset string, kind string, name string, passed boolean, amount bigint, detail string, min_value double, max_value double, mean_value double"
FOLDED = ("_cells_", "_fold_", "_absent_")
KINDS = ["shape", "type", "missing", "stat", "check"]


def zero_if_none(total: Column) -> Column:
    return F.coalesce(total, F.lit(0)).cast("bigint")


def count_duplicates(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Rows beyond the first of each key (whole row by default); a null key equals another null.

    Day columns are folded into a digest, so a whole-row check of a wide table shuffles a fixed
    number of bytes per row.
    """
    days = [] if keys else day_columns(df)
    columns = [F.col(c) for c in (keys or df.columns) if c not in days]
    if days:
        cells = F.transform(day_cells(df, days)[0], lambda x: F.coalesce(x.cast("string"), F.lit("null")))
        columns.append(F.sha2(F.to_json(cells), 256).alias("_cells"))
    groups = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(zero_if_none(F.sum(F.col("n") - 1)).alias("duplicate_count"))


def count_nulls(*columns: str) -> Column:
    return reduce(Column.__add__, [F.count_if(F.col(c).isNull()) for c in columns])


def fold_cells(numbers: Column) -> Column:
    """Counters of an array of converted cells, all in one pass: negative, outlier, known, lo, hi, total."""
    start = {"negative": 0, "outlier": 0, "known": 0}
    empty = F.struct(*[F.lit(v).cast("bigint").alias(k) for k, v in start.items()], *[F.lit(None).cast("double").alias(k) for k in ("lo", "hi")], F.lit(0.0).alias("total"))
    one = lambda test: F.when(test, 1).otherwise(0)

    def add(so_far: Column, x: Column) -> Column:
        return F.struct(
            (so_far["negative"] + one(x < 0)).alias("negative"),
            (so_far["outlier"] + one(x > OUTLIER_UNITS)).alias("outlier"),
            (so_far["known"] + one(x.isNotNull())).alias("known"),
            F.least(so_far["lo"], x).alias("lo"),
            F.greatest(so_far["hi"], x).alias("hi"),
            (so_far["total"] + F.coalesce(x, F.lit(0.0))).alias("total"),
        )

    return F.aggregate(numbers, empty, add)


def _stat(name: str, number: Column) -> dict[str, Column]:
    return {f"{name}_lo": F.min(number).cast("double"), f"{name}_hi": F.max(number).cast("double"), f"{name}_mean": F.avg(number)}


def _parts(df: DataFrame) -> list[tuple[str, list[str], bool]]:
    """(suffix, columns, kept as text) of the day columns, as text and number cells are judged differently."""
    days = set(day_columns(df))
    kinds = [(f.name, isinstance(f.dataType, T.NumericType)) for f in df.schema.fields if f.name in days]
    texts, numeric = [c for c, number in kinds if not number], [c for c, number in kinds if number]
    return [(suffix, names, suffix == "text") for suffix, names in (("text", texts), ("number", numeric)) if names]


def prepared(df: DataFrame, dataset: str, keep: bool = False) -> DataFrame:
    """df with what its audit folds per row; every day cell is converted once. Without `keep` the day
    columns themselves are left out."""
    if dataset != "sales":
        return df
    parts = _parts(df)
    cells = {f"_cells_{suffix}": day_cells(df, names)[0] for suffix, names, _ in parts}
    days = set(day_columns(df))
    rows = df.withColumns(cells) if keep else df.select(*[c for c in df.columns if c not in days], *[column.alias(c) for c, column in cells.items()])
    for suffix, _, _ in parts:
        among = F.col(f"_cells_{suffix}")
        rows = rows.withColumns({f"_fold_{suffix}": fold_cells(F.transform(among, to_number)), f"_absent_{suffix}": F.size(F.filter(among, lambda x: x.isNull()))})
    return rows


def metrics(df: DataFrame, dataset: str) -> dict[str, Column]:
    """Aggregates of one pass over `prepared(df)`; each check counts what is wrong."""
    columns = [c for c in ID_COLUMNS if c in df.columns] if dataset == "sales" else df.columns
    found = {"rows": F.count(F.lit(1)), **{f"null_{c}": F.count_if(F.col(c).isNull()) for c in columns}}
    if dataset == "calendar":
        date, year = parse_date("date"), to_number("year")
        bad_year = (F.col("year").isNotNull() & year.isNull()) | (year < YEAR_RANGE[0]) | (year > YEAR_RANGE[1])
        checks = {
            "Missing Dates": count_nulls("date"),
            "Valid Date Format": F.count_if(F.col("date").isNotNull() & date.isNull()),
            "Missing Weekday Values": count_nulls("weekday"),
            "Valid Year/Week Ranges": F.count_if(bad_year),
            "Unexpected Event Types": F.count_if(outside_domain("event_type_1", EVENT_TYPES)),
            "Event Coverage": F.count("event_name_1") if "event_name_1" in df.columns else F.count_if(F.lit(False)),
        }
        found |= {"first_day": F.min(date), "last_day": F.max(date)}
        for c in ("year", "month", "wday"):
            found |= _stat(c, to_number(c)) if c in df.columns else {}
    elif dataset == "sales":
        parts = _parts(df)
        totals = lambda name: reduce(Column.__add__, [zero_if_none(F.sum(f"_fold_{suffix}.{name}")) for suffix, _, _ in parts], F.lit(0))
        absent = reduce(Column.__add__, [zero_if_none(F.sum(f"_absent_{suffix}")) for suffix, _, _ in parts], F.lit(0))
        # A text column counts every cell that cannot be read as a number, nulls included.
        unread = reduce(Column.__add__, [zero_if_none(F.sum(F.lit(len(names)) - F.col(f"_fold_{suffix}.known"))) for suffix, names, text in parts if text], F.lit(0))
        checks = {
            "Missing Primary Identifiers": count_nulls("id", "item_id", "store_id"),
            "Missing Department/Category Information": count_nulls("dept_id", "cat_id", "state_id"),
            "Negative Sales Volumes": totals("negative"),
            "Missing Sales Values": absent,
            "Numeric Sales Data Types": unread,
            "Sales Outliers Audit": totals("outlier"),
        }
        none = F.lit(None).cast("double")
        total = reduce(Column.__add__, [F.coalesce(F.sum(f"_fold_{suffix}.total"), F.lit(0.0)) for suffix, _, _ in parts], F.lit(0.0))
        found |= {
            "daily_sales_volume_lo": F.least(none, none, *[F.min(f"_fold_{suffix}.lo") for suffix, _, _ in parts]),
            "daily_sales_volume_hi": F.greatest(none, none, *[F.max(f"_fold_{suffix}.hi") for suffix, _, _ in parts]),
            "daily_sales_volume_mean": round_half_up(F.try_divide(total, totals("known").cast("double")), 2),
        }
    else:
        price = to_number("sell_price")
        numeric = isinstance(df.schema["sell_price"].dataType, T.NumericType)
        checks = {
            "Missing Identifiers (Store/Item/Week)": count_nulls(*PRICE_KEY),
            "Missing Prices": count_nulls("sell_price"),
            "Negative Prices": F.count_if(price < 0),
            "Zero Prices": F.count_if(price == 0),
            "Numeric Price Data Type": F.count_if(F.lit(not numeric)),
        }
        found |= _stat("sell_price", price)
    return found | {f"check_{name}": amount for name, amount in checks.items()}


def figures(df: DataFrame, dataset: str) -> DataFrame:
    """The metrics as one row, by a pass of its own."""
    return prepared(df, dataset).agg(*[column.alias(name) for name, column in metrics(df, dataset).items()])


class Observed:
    """The metrics of a raw table, taken while something else reads it."""

    def __init__(self, df: DataFrame, dataset: str):
        self.df, self.dataset, self.observation = df, dataset, Observation()
        rows = prepared(df, dataset, keep=True).observe(self.observation, *[c.alias(n) for n, c in metrics(df, dataset).items()])
        self.rows = rows.drop(*[c for c in rows.columns if c.startswith(FOLDED)]) if dataset == "sales" else rows

    def figures(self) -> DataFrame:
        """One row. A map task that runs again after a lost executor is observed twice, so a row count that
        differs from the table's own (kept in its file footers) discards the observation."""
        seen = seen_by(self.observation)
        if seen is None or seen["rows"] != self.df.count():
            return figures(self.df, self.dataset)
        shape = figures(self.df, self.dataset).schema
        return self.df.sparkSession.createDataFrame([tuple(seen[f.name] for f in shape.fields)], shape)


def audit(df: DataFrame, dataset: str, kinds: list[str] = KINDS, found: DataFrame | None = None) -> DataFrame:
    """Rows of AUDIT for a raw table; `found` may bring its figures along."""
    names = list(metrics(df, dataset))
    found = figures(df, dataset) if found is None else found
    checks = [n.removeprefix("check_") for n in names if n.startswith("check_")]
    repeated = next(n for n in {"calendar": CALENDAR_CHECKS, "sales": SALES_CHECKS, "prices": PRICE_CHECKS}[dataset] if n not in checks)
    rows: dict[str, list] = {kind: [] for kind in KINDS}
    if "shape" in kinds:
        found = found.withColumn("_duplicates", count_duplicates(df).scalar())
        shape = {"rows": F.col("rows"), "columns": F.lit(len(df.columns)), "duplicate rows": F.col("_duplicates")}
        rows["shape"] = [{"name": name, "amount": amount} for name, amount in shape.items()]
    if "check" in kinds:
        found = found.withColumn(f"check_{repeated}", count_duplicates(df, KEYS[dataset]).scalar())
    days = set(day_columns(df))
    rows["type"] = [{"name": name, "detail": F.lit(kind)} for name, kind in df.dtypes if name not in days]
    rows["missing"] = [{"name": n[5:], "amount": F.col(f"`{n}`"), "mean_value": percent(F.col(f"`{n}`"), F.col("rows"))} for n in names if n.startswith("null_")]
    rows["stat"] = [{"name": n[:-3], "min_value": F.col(n), "max_value": F.col(f"{n[:-3]}_hi"), "mean_value": F.col(f"{n[:-3]}_mean")} for n in names if n.endswith("_lo")]
    if dataset == "calendar":
        whole = (F.col("`check_Missing Dates`") == 0) & (F.col("`check_Valid Date Format`") == 0)
        span = F.concat_ws(" to ", F.col("first_day").cast("string"), F.col("last_day").cast("string"))
        rows["stat"].append({"name": "date_range", "detail": F.when(whole, span)})
    for name in [repeated, *checks]:
        words, amount = INFORMATIONAL.get(name), F.col(f"`check_{name}`")
        detail = F.concat(amount.cast("string"), F.lit(f" {words or 'issues'}"))
        amount = F.lit(0) if name == "Event Coverage" else amount  # events are no issues
        rows["check"].append({"name": name, "passed": F.lit(True) if words else amount == 0, "amount": amount, "detail": detail if words else F.when(amount == 0, "no issues").otherwise(detail)})
    cells = [part.split() for part in AUDIT.split(", ")][2:]
    entries = [
        F.struct(F.lit(dataset).alias("dataset"), F.lit(kind).alias("kind"), *[F.lit(row.get(c)).cast(t).alias(c) for c, t in cells])
        for kind in kinds for row in rows[kind]
    ]
    return found.select(F.inline(F.array(*entries)))


def checks_of(rows: DataFrame) -> DataFrame:
    """The check rows of an audit: (dataset, check_name, passed, issue_count, detail)."""
    return rows.where("kind = 'check'").select("dataset", F.col("name").alias("check_name"), "passed", F.col("amount").alias("issue_count"), "detail")


def dq_calendar(df: DataFrame) -> DataFrame:
    """Checks of a raw calendar; the event coverage always passes and tells how many days have an event."""
    return checks_of(audit(df, "calendar", ["check"]))


def dq_sales(df: DataFrame) -> DataFrame:
    """Checks of raw wide sales. Cells are folded row by row, without unpivoting."""
    return checks_of(audit(df, "sales", ["check"]))


def dq_prices(df: DataFrame) -> DataFrame:
    return checks_of(audit(df, "prices", ["check"]))


def audit_summary(rows: DataFrame) -> DataFrame:
    """One row per dataset: shape, nulls, checks and overall status of whole audits."""
    kind, name, amount = F.col("kind"), F.col("name"), F.col("amount")
    return rows.groupBy("dataset").agg(
        F.max(F.when((kind == "shape") & (name == "rows"), amount)).alias("row_count"),
        F.max(F.when((kind == "shape") & (name == "columns"), amount)).alias("column_count"),
        F.max(F.when((kind == "shape") & (name == "duplicate rows"), amount)).alias("duplicate_rows"),
        F.count_if((kind == "missing") & (amount > 0)).alias("columns_with_nulls"),
        zero_if_none(F.sum(F.when(kind == "missing", amount))).alias("null_cells"),
        F.count_if(kind == "check").alias("check_count"),
        F.count_if((kind == "check") & ~F.col("passed")).alias("failed_count"),
        zero_if_none(F.sum(F.when(kind == "check", amount))).alias("issue_count"),
        status(F.every(F.coalesce("passed", F.lit(True)))).alias("overall_status"),
    )


def render_audit(rows: DataFrame) -> DataFrame:
    """Report lines (dataset, line_no, line): a heading per dataset with its shape, columns with nulls and
    statistics, then its checks."""
    kind = F.col("kind")
    mark = F.when(F.col("passed"), "[PASS]").otherwise("[FAIL]")
    checks = rows.where(kind == "check").select("dataset", F.lit(1).alias("line_no"), F.format_string("  %s %s: %s", mark, "name", "detail").alias("line"))
    piece = (
        F.when(kind == "shape", F.format_string("%,d %s", "amount", "name"))
        .when((kind == "missing") & (F.col("amount") > 0), F.format_string("nulls in %s: %,d (%.2f%%)", "name", "amount", "mean_value"))
        .when((kind == "stat") & F.col("min_value").isNotNull(), F.format_string("%s: min %.2f, max %.2f, mean %.2f", "name", "min_value", "max_value", "mean_value"))
        .when((kind == "stat") & F.col("detail").isNotNull(), F.format_string("%s: %s", "name", "detail"))
    )
    order = F.array_position(F.array(*map(F.lit, ("shape", "missing", "stat"))), kind)
    pieces = rows.where(kind != "check").select("dataset", order.alias("order"), "name", piece.alias("piece")).where("piece IS NOT NULL")
    # A few pieces per dataset: one for each of its shape figures, columns and statistics.
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("order", "name", "piece"))), lambda x: x["piece"]), "; ")
    heads = pieces.groupBy("dataset").agg(joined.alias("pieces"))
    heads = heads.select("dataset", F.lit(0).alias("line_no"), F.concat(F.upper("dataset"), F.lit(": "), F.col("pieces")).alias("line"))
    return heads.unionByName(checks).orderBy("dataset", "line_no", "line")
