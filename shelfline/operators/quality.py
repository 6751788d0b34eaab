"""Audits and assertions.

A check is a row (dataset, check_name, passed, issue_count). Counts of one table come from a
single pass; key duplicates need their own grouping. Assertions return the violating rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.functions import outside_domain, percent, round_half_up, status, to_number
from shelfline.operators import cube, ranks
from shelfline.operators.audit import INFORMATIONAL, count_duplicates, dq_calendar, dq_prices, dq_sales, zero_if_none  # noqa: F401
from shelfline.operators.joins import totals_cross_check
from shelfline.operators.profiles import WEEKDAY_LABEL, WEEKEND_LABEL
from shelfline.operators.reshape import day_cells, wide_sales_total
from shelfline.schemas import FACT_KEY

# The declared rules of the models.
HIERARCHY_RULES = [("item_id", "dept_id"), ("dept_id", "cat_id"), ("item_id", "cat_id"), ("store_id", "state_id")]

NOT_NULL = {
    "stg_calendar": ["sales_date", "day_id", "wm_yr_wk"],
    "stg_sales": ["series_id", "item_id", "store_id", "cat_id", "state_id"],
    "stg_sell_prices": ["store_id", "item_id", "wm_yr_wk", "sell_price"],
    "int_daily_sales": ["sales_date", "item_id", "store_id", "state_id", "cat_id", "dept_id", "sales"],
    "int_weekly_sales": ["wm_yr_wk", "item_id", "store_id", "total_weekly_sales"],
    "int_monthly_sales": ["year", "month", "item_id", "store_id", "total_monthly_sales"],
    "mart_sales_forecasting": [
        "date", "sales_date", "item_id", "store_id", "state_id", "category", "cat_id", "department", "dept_id", "sales",
    ],
    "fct_daily_sales": ["sales_date", "item_id", "store_id", "sales"],
    "fct_weekly_sales": ["wm_yr_wk", "item_id", "store_id", "total_weekly_sales"],
    "fct_monthly_sales": ["year", "month", "item_id", "store_id", "total_monthly_sales"],
}
UNIQUE = {"stg_calendar": ["sales_date", "day_id"], "stg_sales": ["series_id"]}
ACCEPTED = {"stg_sales": {"cat_id": ["FOODS", "HOBBIES", "HOUSEHOLD"], "state_id": ["CA", "TX", "WI"]}}


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def count_missing(df: DataFrame) -> DataFrame:
    """Nulls per column, all columns in one pass: (column_name, missing_count)."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("missing_count")) for c in df.columns])
    return counts.select(F.inline(pairs))


def column_stats(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, min_value, max_value, mean_value) of number columns, also those kept as text
    (what cannot be read is left out), one pass."""
    entries = []
    aggregates = []
    for i, c in enumerate(columns):
        number = to_number(c)
        aggregates += [F.min(number).alias(f"lo{i}"), F.max(number).alias(f"hi{i}"), F.avg(number).alias(f"mean{i}")]
        entries.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.col(f"lo{i}").alias("min_value"),
                F.col(f"hi{i}").alias("max_value"),
                F.col(f"mean{i}").alias("mean_value"),
            )
        )
    return df.agg(*aggregates).select(F.inline(F.array(*entries)))


def cell_stats(sales: DataFrame) -> DataFrame:
    """Smallest, largest and mean (2 decimals) day cell of wide sales."""
    known = F.filter(F.transform(day_cells(sales)[0], to_number), lambda x: x.isNotNull())
    per_row = sales.select(
        F.array_min(known).alias("lo"),
        F.array_max(known).alias("hi"),
        F.aggregate(known, F.lit(0.0), lambda a, x: a + x).alias("s"),
        F.size(known).alias("n"),
    )
    return per_row.agg(
        F.lit("daily_sales_volume").alias("column_name"),
        F.min("lo").alias("min_value"),
        F.max("hi").alias("max_value"),
        round_half_up(F.try_divide(F.sum("s"), F.sum("n")), 2).alias("mean_value"),
    )


def dq_report(checks: DataFrame) -> DataFrame:
    """Overall status per dataset."""
    return checks.groupBy("dataset").agg(
        F.count(F.lit(1)).alias("check_count"),
        F.count_if(~F.col("passed")).alias("failed_count"),
        F.sum("issue_count").alias("issue_count"),
        status(F.every("passed")).alias("overall_status"),
    )


def table_shape(df: DataFrame, dataset: str) -> DataFrame:
    """Rows, columns and whole-row duplicates of one table."""
    rows = df.agg(F.count(F.lit(1)).alias("row_count"), F.lit(len(df.columns)).alias("column_count"), F.lit(0).cast("bigint").alias("duplicate_count"))
    duplicates = count_duplicates(df).select(F.lit(0).cast("bigint").alias("row_count"), F.lit(0).alias("column_count"), "duplicate_count")
    both = rows.unionByName(duplicates)
    return both.agg(F.lit(dataset).alias("dataset"), *[F.max(c).alias(c) for c in both.columns])


def column_types(df: DataFrame, dataset: str) -> list[tuple[str, str, str]]:
    """(dataset, column, type) taken from the schema; nothing runs."""
    return [(dataset, name, kind) for name, kind in df.dtypes]


def render_checks(checks: DataFrame, shape: DataFrame) -> DataFrame:
    """Report lines (dataset, line_no, line) ready for a text sink."""
    header = shape.select(
        "dataset",
        F.lit(0).alias("line_no"),
        F.format_string("%s: %,d rows, %d columns, %,d duplicate rows", F.upper("dataset"), "row_count", "column_count", "duplicate_count").alias("line"),
    )
    mark = F.when(F.col("passed"), "[PASS]").otherwise("[FAIL]")
    lines = checks.select(
        "dataset", F.lit(1).alias("line_no"), F.format_string("  %s %s (%,d issues)", mark, "check_name", "issue_count").alias("line")
    )
    return header.unionByName(lines).orderBy("dataset", "line_no", "line")


def validate_fact(df: DataFrame) -> DataFrame:
    """Integrity of the fact in one row.

    Everything but the duplicate count is added up per entity tuple on the map side, so the fact
    itself is shuffled once only, for the key grouping that finds duplicates.
    """
    sales, price = F.col("sales"), F.col("sell_price")
    names = {"item_id": "items", "store_id": "stores", "dept_id": "depts", "cat_id": "cats", "state_id": "states"}
    entities = df.groupBy(*names).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(sales).alias("units"),
        F.count(sales).alias("sales_n"),
        F.min(sales).alias("lo"),
        F.max(sales).alias("hi"),
        F.count_if(sales < 0).alias("negative"),
        F.count_if(price.isNull()).alias("no_price"),
        F.count_if(price <= 0).alias("bad_price"),
        F.min("date").alias("min_date"),
        F.max("date").alias("max_date"),
        F.count_if(F.col("date").isNull()).alias("no_date"),
    )
    facts = entities.agg(
        zero_if_none(F.sum("n")).alias("row_count"),
        F.min("min_date").alias("min_date"),
        F.max("max_date").alias("max_date"),
        *[F.countDistinct(c).alias(f"unique_{label}") for c, label in names.items()],
        F.sum("units").alias("total_sales"),
        round_half_up(F.try_divide(F.sum("units").cast("double"), F.sum("sales_n")), 4).alias("avg_daily_sales"),
        F.min("lo").alias("min_sales"),
        F.max("hi").alias("max_sales"),
        zero_if_none(F.sum("negative")).alias("negative_sales_count"),
        zero_if_none(F.sum("no_date")).alias("missing_dates"),
        zero_if_none(F.sum("no_price")).alias("missing_prices"),
        zero_if_none(F.sum("bad_price")).alias("invalid_prices"),
    )
    duplicates = count_duplicates(df, FACT_KEY).scalar()
    measured = facts.withColumns(
        {"missing_price_pct": percent("missing_prices", "row_count"), "duplicate_combinations": duplicates}
    )
    return measured.withColumns(
        {
            "row_count_status": status(F.col("row_count") > 0),
            "date_range_status": status(F.col("min_date").isNotNull()),
            "negative_sales_status": status(F.col("negative_sales_count") == 0),
            "missing_dates_status": status(F.col("missing_dates") == 0),
            "missing_prices_status": status(F.col("missing_prices") == 0, "WARNING"),
            "duplicates_status": status(F.col("duplicate_combinations") == 0),
            "invalid_prices_status": status(F.col("invalid_prices") == 0),
        }
    )


def validate_transform(fact: DataFrame, wide: DataFrame) -> DataFrame:
    """Post-transform checks, including that no unit was lost against the wide total."""
    keep = ["row_count", "min_date", "max_date", "unique_items", "unique_stores", "unique_depts", "unique_cats", "total_sales"]
    issues = ["negative_sales_count", "missing_dates", "missing_prices", "duplicate_combinations"]
    raw = wide_sales_total(wide).scalar()
    return validate_fact(fact).select(*keep, *issues, raw.alias("raw_total_sales")).withColumn(
        "sales_match", F.col("total_sales") == F.col("raw_total_sales")
    )


def _parent_links(df: DataFrame) -> DataFrame:
    """(rule, child, lowest parent, highest parent). Two different ends mean several parents, so
    no distinct count is needed; the fact is reduced to its entities before the four rules."""
    entities = df.select("item_id", "dept_id", "cat_id", "store_id", "state_id").distinct()
    links = F.array(
        *[
            F.struct(F.lit(f"{child}->{parent}").alias("rule"), F.col(child).alias("child"), F.col(parent).alias("parent"))
            for child, parent in HIERARCHY_RULES
        ]
    )
    return entities.select(F.inline(links)).groupBy("rule", "child").agg(F.min("parent").alias("lo"), F.max("parent").alias("hi"))


def check_hierarchy(df: DataFrame) -> DataFrame:
    """(rule, passed, offender_count) for the four parent rules."""
    offends = F.coalesce(F.col("lo") != F.col("hi"), F.lit(False)) & F.col("child").isNotNull()
    return _parent_links(df).groupBy("rule").agg(
        (F.count_if(offends) == 0).alias("passed"), F.count_if(offends).alias("offender_count")
    )


def hierarchy_offenders(df: DataFrame, k: int = 5) -> DataFrame:
    """First k offending children of each rule. Spark cuts every partition to k rows per rule
    before the shuffle, so a rule broken by millions of children stays small."""
    bad = _parent_links(df).filter(F.col("child").isNotNull() & (F.col("lo") != F.col("hi")))
    place = F.row_number().over(Window.partitionBy("rule").orderBy("child"))
    return bad.withColumn("place", place).filter(F.col("place") <= k).select("rule", "child")


def check_not_null(df: DataFrame, model: str, columns: list[str] | None = None) -> DataFrame:
    """(model, column_name, rule, violations) for the declared not-null columns."""
    columns = NOT_NULL[model] if columns is None else columns
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return _violations(counts, model, "not_null", columns)


def _violations(counts: DataFrame, model: str, rule: str, columns: list[str]) -> DataFrame:
    entries = [
        F.struct(
            F.lit(model).alias("model"), F.lit(c).alias("column_name"), F.lit(rule).alias("rule"), F.col(c).cast("bigint").alias("violations")
        )
        for c in columns
    ]
    return counts.select(F.inline(F.array(*entries)))


def check_unique(df: DataFrame, model: str, columns: list[str] | None = None) -> DataFrame:
    """Values that occur more than once, counted per declared column; nulls are not compared."""
    columns = UNIQUE[model] if columns is None else columns
    checks = []
    for c in columns:
        repeated = df.filter(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
        checks.append(_violations(repeated.agg(F.count(F.lit(1)).alias(c)), model, "unique", [c]))
    return union_all(checks)


def check_accepted_values(df: DataFrame, model: str, accepted: dict[str, list[str]] | None = None) -> DataFrame:
    """Distinct values outside the declared list, counted per column."""
    accepted = ACCEPTED[model] if accepted is None else accepted
    checks = []
    for c, allowed in accepted.items():
        stray = df.filter(outside_domain(c, allowed)).select(c).distinct()
        checks.append(_violations(stray.agg(F.count(F.lit(1)).alias(c)), model, "accepted_values", [c]))
    return union_all(checks)


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("record_count")).filter(F.col("record_count") > 1)


def assert_daily_non_negative(daily: DataFrame) -> DataFrame:
    return daily.filter(F.col("sales") < 0).select("sales_date", "store_id", "item_id", "sales")


def assert_daily_unique(daily: DataFrame) -> DataFrame:
    return repeated_keys(daily, ["sales_date", "store_id", "item_id"])


def assert_weekly_unique(weekly: DataFrame) -> DataFrame:
    """Returns the weeks that a year end splits in two, as the weekly model keeps year in its key."""
    return repeated_keys(weekly, ["wm_yr_wk", "store_id", "item_id"])


def assert_monthly_unique(monthly: DataFrame) -> DataFrame:
    return repeated_keys(monthly, ["year", "month", "store_id", "item_id"])


def assert_mart_unique(mart: DataFrame) -> DataFrame:
    return repeated_keys(mart, ["date", "store_id", "item_id"])


def assert_mart_non_negative(mart: DataFrame) -> DataFrame:
    return mart.filter((F.col("sales") < 0) | (F.col("sell_price") < 0)).select("date", "store_id", "item_id", "sales", "sell_price")


def assert_weekly_total(daily: DataFrame, weekly: DataFrame) -> DataFrame:
    return totals_cross_check(daily.agg(F.sum("sales")), weekly.agg(F.sum("total_weekly_sales")), "total_daily", "total_weekly")


def assert_monthly_total(daily: DataFrame, monthly: DataFrame) -> DataFrame:
    return totals_cross_check(daily.agg(F.sum("sales")), monthly.agg(F.sum("total_monthly_sales")), "total_daily", "total_monthly")


# Sections of the report in order, and the statuses that decide its verdict.
SECTIONS = ["size", "integrity", "hierarchy", "sales", "calendar", "prices", "overall"]
CRITICAL = ["row_count", "date_range", "negative_sales_count", "missing_dates", "duplicate_combinations", "invalid_prices", "overall_hierarchy"]
REPORT = "section string, place int, name string, key string, status string, value bigint, mean double, low double, high double"
TOP_ITEMS = 3


def validation_report(fact: DataFrame, wide: DataFrame | None = None) -> DataFrame:
    """The full report as rows of REPORT: size and coverage, integrity, hierarchy with the first
    offenders, sales by store, category, department and best items, calendar patterns, prices, and the
    verdict from the CRITICAL statuses.

    The fact is scanned four times: twice for the cube, for repeated keys, for the median price. An empty
    fact gives the lines that need no rows and fails."""
    whole = cube.sales_cube(fact)
    facts = cube.overall_row(whole, HIERARCHY_RULES).withColumns(
        {"duplicates": count_duplicates(fact, FACT_KEY).scalar(), "median": ranks.median(fact, to_number("sell_price")).scalar()}
    )
    facts = facts.withColumn("raw_total", wide_sales_total(wide).scalar() if wide is not None else F.lit(None).cast("bigint"))
    total = lambda name: zero_if_none(F.col(name))
    rules = [f"{child}->{parent}" for child, parent in HIERARCHY_RULES]
    broken = reduce(Column.__add__, [F.col(f"`{rule}`") for rule in rules])
    passed = {
        "row_count": total("n") > 0,
        "date_range": F.col("first_day").isNotNull(),
        "negative_sales_count": total("negative") == 0,
        "missing_dates": total("no_date") == 0,
        "duplicate_combinations": F.col("duplicates") == 0,
        "invalid_prices": total("bad_price") == 0,
        "overall_hierarchy": broken == 0,
    }
    match = F.when(F.col("raw_total").isNull(), "INFO").otherwise(status(F.col("raw_total") == F.col("units"), "WARNING"))
    span = F.concat_ws(" to ", F.col("first_day").cast("string"), F.col("last_day").cast("string"))
    lines = {
        "size": [
            ("row_count", None, total("n"), {}),
            ("date_range", F.when(F.col("first_day").isNotNull(), span), F.datediff("last_day", "first_day"), {}),
            *[(f"unique_{plural}", None, F.col(f"unique_{level}"), {}) for plural, level in
              (("items", "item"), ("stores", "store"), ("departments", "department"), ("categories", "category"), ("states", "state"))],
        ],
        "integrity": [
            ("raw_sales_match", None, F.col("raw_total"), {"status": match}),
            ("negative_sales_count", None, total("negative"), {}),
            ("missing_dates", None, total("no_date"), {}),
            ("missing_prices", None, total("no_price"), {"status": status(total("no_price") == 0, "WARNING"), "mean": percent("no_price", "n")}),
            ("duplicate_combinations", None, F.col("duplicates"), {}),
            ("invalid_prices", None, total("bad_price"), {}),
        ],
        "hierarchy": [
            *[(rule, None, F.col(f"`{rule}`"), {"status": status(F.col(f"`{rule}`") == 0)}) for rule in rules],
            ("overall_hierarchy", None, broken, {}),
        ],
        "sales": [
            ("total_sales", None, F.col("units"), {}),
            ("daily_sales", None, F.col("sales_n"), {"mean": cube.mean_sales(), "low": F.col("lo").cast("double"), "high": F.col("hi").cast("double")}),
        ],
        "calendar": [],
        "prices": [
            ("sell_price", None, F.col("price_n"), {"mean": cube.mean_price(2), "low": round_half_up("price_lo", 2), "high": round_half_up("price_hi", 2)}),
            ("median_price", None, F.col("price_n"), {"mean": round_half_up("median", 2)}),
        ],
    }
    failed = reduce(Column.__add__, [F.when(passed[name], 0).otherwise(1) for name in CRITICAL])
    lines["overall"] = [("overall_status", None, failed, {"status": status(failed == 0)})]
    fixed = facts.select(F.inline(F.array(*[
        _line(section, place, F.lit(name), key, value, **{"status": status(passed[name]) if name in passed else None, **more})
        for section, entries in lines.items() for place, (name, key, value, more) in enumerate(entries)
    ])))
    first = cube.offenders(whole, HIERARCHY_RULES).select(F.col("rule").alias("_rule"), "children")
    fixed = fixed.join(first, (F.col("section") == "hierarchy") & (F.col("name") == F.col("_rule")), "left")
    fixed = fixed.withColumn("key", F.coalesce("children", "key")).drop("_rule", "children")

    level = F.col("level")
    day = F.date_format(F.date_add(F.lit("1970-01-05").cast("date"), F.col("key").try_cast("int")), "EEEE")  # a Monday
    part = F.when(F.col("key") == "true", WEEKEND_LABEL).otherwise(WEEKDAY_LABEL)
    known = whole.where(F.col("key").isNotNull())
    by_entity = known.where(level.isin("store", "category", "department")).select(
        _line("sales", F.when(level == "store", 2).when(level == "category", 3).otherwise(4), F.concat(F.lit("sales_by_"), level), F.col("key"), F.col("units"), mean=cube.mean_sales()).alias("line")
    )
    best = known.where(level == "item").orderBy(F.desc("units"), "key").limit(TOP_ITEMS)
    best = best.select(_line("sales", 5, F.lit("top_items"), F.col("key"), F.col("units"), mean=cube.mean_sales()).alias("line"))
    by_day = known.where(level.isin("weekday", "weekend")).select(
        _line("calendar", F.when(level == "weekday", F.col("key").try_cast("int")).otherwise(7), F.when(level == "weekday", "sales_by_weekday").otherwise("weekend_contrast"),
              F.when(level == "weekday", day).otherwise(part), F.col("units"), mean=cube.mean_sales()).alias("line")
    )
    priced = known.where(level == "category").select(
        _line("prices", 2, F.lit("price_by_category"), F.col("key"), F.col("price_n"), mean=cube.mean_price(4), low=F.col("price_lo"), high=F.col("price_hi")).alias("line")
    )
    return union_all([fixed, *[frame.select("line.*") for frame in (by_entity, best, by_day, priced)]])


def _line(section: str, place, name: Column, key: Column | None, value: Column, status: Column | None = None, mean: Column | None = None, low: Column | None = None, high: Column | None = None) -> Column:
    """One report row as a struct with the columns of REPORT."""
    place = place if isinstance(place, Column) else F.lit(place)
    cells = {"place": place, "name": name, "key": key, "status": status, "value": value, "mean": mean, "low": low, "high": high}
    kinds = dict(part.split() for part in REPORT.split(", "))
    return F.struct(F.lit(section).alias("section"), *[(F.lit(None) if cell is None else cell).cast(kinds[c]).alias(c) for c, cell in cells.items()])


def render_report(report: DataFrame) -> DataFrame:
    """Report lines (line_no, line) in reading order, one heading per section, ready for a text sink."""
    number = F.array_position(F.array(*map(F.lit, SECTIONS)), F.col("section"))
    figures = [
        F.when(F.col("value").isNotNull(), F.format_string("%,d", "value")),
        F.when(F.col("mean").isNotNull(), F.format_string("mean %.2f", "mean")),
        F.when(F.col("low").isNotNull(), F.format_string("from %.2f to %.2f", "low", "high")),
        F.when(F.col("status").isNotNull(), F.format_string("[%s]", "status")),
    ]
    body = F.concat(F.lit("  "), F.rpad(F.concat_ws(" ", "name", F.col("key")), 48, " "), F.lit(" "), F.concat_ws(", ", *figures))
    lines = report.select(number.alias("section_no"), F.col("place"), F.col("value"), F.col("key"), body.alias("line"))
    heads = report.select(number.alias("section_no"), F.lit(-1).alias("place"), F.lit(None).cast("bigint").alias("value"), F.lit(None).cast("string").alias("key"),
                          F.concat(number.cast("string"), F.lit(". "), F.upper("section")).alias("line")).distinct()
    ordered = lines.unionByName(heads).orderBy("section_no", "place", F.desc("value"), "key", "line")
    return ordered.select(F.monotonically_increasing_id().alias("line_no"), "line")
