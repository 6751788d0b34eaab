"""Audits, validation and assertions."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import inputs as i
from catalog.sql import query, rnd
from shelfline.functions import round_half_up
from shelfline.operators import audit, quality as q, rollups
from shelfline.schemas import FACT_KEY


def _checks(dataset: str, counts: dict[str, str], table: str) -> str:
    """Check rows in SQL: one SELECT per check over the same table."""
    rows = []
    for name, expression in counts.items():
        passed = "true" if name in q.INFORMATIONAL else f"({expression}) = 0"
        rows.append(
            f"SELECT '{dataset}' AS dataset, '{name}' AS check_name, {passed} AS passed, CAST({expression} AS BIGINT) AS issue_count FROM {table}"
        )
    return " UNION ALL ".join(rows)


def _dup(keys: str) -> str:
    return f"count(*) - count(DISTINCT ({keys}))"


def _where(test: str) -> str:
    return f"count(*) FILTER (WHERE {test})"


def rounded_prices(rows):
    """The mean price to four decimals, because averages of doubles depend on the order of rows."""
    return rows.withColumn("mean_value", F.when(F.col("name") == "sell_price", round_half_up("mean_value", 4)).otherwise(F.col("mean_value")))


_CAL = _checks(
    "calendar",
    {
        "Missing Dates": _where("date IS NULL"),
        "Duplicate Dates": _dup("coalesce(date, '~')"),
        "Valid Date Format": _where("date IS NOT NULL AND TRY_CAST(date AS DATE) IS NULL"),
        "Missing Weekday Values": _where("weekday IS NULL"),
        "Valid Year/Week Ranges": _where("CAST(year AS BIGINT) < 2000 OR CAST(year AS BIGINT) > 2050"),
        "Unexpected Event Types": _where("event_type_1 NOT IN ('Sporting', 'Cultural', 'National', 'Religious')"),
        "Event Coverage": "0 * count(*)",
    },
    "raw_cal",
)
_SALES = _checks(
    "sales",
    {
        "Duplicate Item-Store Identifiers": "0 * count(*)",
        "Missing Primary Identifiers": "0 * count(*)",
        "Missing Department/Category Information": "0 * count(*)",
        "Negative Sales Volumes": _where("TRY_CAST(cell AS BIGINT) < 0"),
        "Missing Sales Values": _where("cell IS NULL"),
        "Numeric Sales Data Types": _where("TRY_CAST(cell AS BIGINT) IS NULL"),
        "Sales Outliers Audit": _where("TRY_CAST(cell AS BIGINT) > 500"),
    },
    "raw_cells",
)
_NUM = "TRY_CAST(sell_price AS DOUBLE)"
_PRICES = _checks(
    "prices",
    {
        "Duplicate Store-Item-Week Keys": _dup("store_id, coalesce(item_id, '~'), wm_yr_wk"),
        "Missing Identifiers (Store/Item/Week)": _where("item_id IS NULL"),
        "Missing Prices": _where("sell_price IS NULL"),
        "Negative Prices": _where(f"{_NUM} < 0"),
        "Zero Prices": _where(f"{_NUM} = 0"),
        "Numeric Price Data Type": "count(*)",
    },
    "raw_prices",
)
_ALL = f"{_CAL} UNION ALL {_SALES} UNION ALL {_PRICES}"


def _detailed(checks: str, events: str) -> str:
    """Check rows with their detail; `events` is a table of calendar rows."""
    return f"""SELECT *, CASE check_name WHEN 'Event Coverage' THEN (SELECT count(event_name_1) FROM {events}) || ' days with an event'
        WHEN 'Sales Outliers Audit' THEN issue_count || ' cells above 500' ELSE CASE WHEN issue_count = 0 THEN 'no issues' ELSE issue_count || ' issues' END END AS detail
        FROM ({checks})"""


def _row(dataset: str, kind: str, name: str, source: str = "", passed: str = "NULL", amount: str = "NULL", detail: str = "NULL", low: str = "NULL", high: str = "NULL", mean: str = "NULL") -> str:
    return f"""SELECT '{dataset}' AS dataset, '{kind}' AS kind, '{name}' AS name, CAST({passed} AS BOOLEAN) AS passed, CAST({amount} AS BIGINT) AS amount, CAST({detail} AS VARCHAR) AS detail,
        CAST({low} AS DOUBLE) AS min_value, CAST({high} AS DOUBLE) AS max_value, CAST({mean} AS DOUBLE) AS mean_value {source}"""


_CAL_COLUMNS = "date wm_yr_wk weekday wday month year d event_name_1 event_type_1 event_name_2 event_type_2 snap_CA snap_TX snap_WI".split()
_CAL_TYPES = ["date", "bigint", "string", "bigint", "bigint", "bigint", *["string"] * 5, *["bigint"] * 3]


def _audit_sql(cal: str, cells: str, prices: str, checks: str, types: dict[str, list[tuple[str, str]]]) -> str:
    """Whole audits of three tables: shape, types, nulls, statistics, checks."""
    def pct(test):
        return rnd(f"100e0 * CAST({_where(test)} AS DOUBLE) / count(*)", 2)

    def num(c):
        return f"TRY_CAST({c} AS DOUBLE)"

    whole = {"calendar": (cal, "count(*)", f"max({len(types['calendar'])})"), "prices": (prices, "count(*)", f"max({len(types['prices'])})")}
    whole["sales"] = (cells, "count(DISTINCT id)", "6 + count(DISTINCT n)")
    rows = []
    for dataset, (table, count, columns) in whole.items():
        rows += [_row(dataset, "shape", "rows", f"FROM {table}", amount=count), _row(dataset, "shape", "columns", f"FROM {table}", amount=columns)]
        again = "0" if dataset == "sales" else f"(SELECT count(*) FROM {table}) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {table}))"
        rows.append(_row(dataset, "shape", "duplicate rows", amount=again))
        rows += [_row(dataset, "type", name, detail=f"'{kind}'") for name, kind in types[dataset]]
        source = f"FROM (SELECT DISTINCT id, item_id, dept_id, cat_id, store_id, state_id FROM {table})" if dataset == "sales" else f"FROM {table}"
        for name, _ in types[dataset]:
            absent = f'"{name}" IS NULL'
            rows.append(_row(dataset, "missing", name, source, amount=_where(absent), mean=pct(absent)))
    for c in ("year", "month", "wday"):
        rows.append(_row("calendar", "stat", c, f"FROM {cal}", low=f"min({num(c)})", high=f"max({num(c)})", mean=f"avg({num(c)})"))
    day = "TRY_CAST(date AS DATE)"
    span = f"CASE WHEN count(*) = count({day}) THEN CAST(min({day}) AS VARCHAR) || ' to ' || CAST(max({day}) AS VARCHAR) END"
    rows.append(_row("calendar", "stat", "date_range", f"FROM {cal}", detail=span))
    rows.append(_row("sales", "stat", "daily_sales_volume", f"FROM (SELECT {num('cell')} AS v FROM {cells})", low="min(v)", high="max(v)", mean=rnd("avg(v)", 2)))
    rows.append(_row("prices", "stat", "sell_price", f"FROM {prices}", low=f"min({num('sell_price')})", high=f"max({num('sell_price')})", mean=rnd(f"avg({num('sell_price')})", 4)))
    found = " UNION ALL ".join(rows)
    return f"""{found} UNION ALL SELECT dataset, 'check', check_name, passed, issue_count, detail, CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE)
        FROM ({_detailed(checks, cal)})"""


_RAW_TYPES = {
    "calendar": [(c, "string") for c in _CAL_COLUMNS],
    "sales": [(c, "string") for c in ("id", "item_id", "dept_id", "cat_id", "store_id", "state_id")],
    "prices": [(c, "string") for c in ("store_id", "item_id", "wm_yr_wk", "sell_price")] + [("load_no", "int")],
}
_RAW_AUDIT = _audit_sql("raw_cal", "raw_cells", "raw_prices", _ALL, _RAW_TYPES)
# The same audit over clean inputs, where every count is zero but those of the events.
_CLEAN_CHECKS = _ALL.replace("raw_cal", "cal").replace("raw_cells", "(SELECT *, sales AS cell FROM cells)").replace("raw_prices", "prices").replace("coalesce(date, '~')", "date").replace(_checks("prices", {"Numeric Price Data Type": "count(*)"}, "prices"), _checks("prices", {"Numeric Price Data Type": "0 * count(*)"}, "prices"))
JOB_AUDIT = query(
    _audit_sql(
        "cal", "(SELECT *, sales AS cell FROM cells)", "prices", _CLEAN_CHECKS,
        {"calendar": list(zip(_CAL_COLUMNS, _CAL_TYPES)), "sales": _RAW_TYPES["sales"], "prices": [("store_id", "string"), ("item_id", "string"), ("wm_yr_wk", "bigint"), ("sell_price", "double")]},
    )
)


def _audits(spark, d):
    tables = {"calendar": i.raw_calendar(spark, d), "sales": i.raw_sales(spark, d), "prices": i.raw_prices(spark, d)}
    return q.union_all([audit.audit(df, name) for name, df in tables.items()])


_DUP_FACT = "count(*) - count(DISTINCT (coalesce(date, DATE '1900-01-01'), item_id, store_id))"
_VALID = f"""SELECT count(*) AS row_count, min(date) AS min_date, max(date) AS max_date, count(DISTINCT item_id) AS unique_items,
    count(DISTINCT store_id) AS unique_stores, count(DISTINCT dept_id) AS unique_depts, count(DISTINCT cat_id) AS unique_cats,
    count(DISTINCT state_id) AS unique_states, CAST(sum(sales) AS BIGINT) AS total_sales,
    {rnd('CAST(sum(sales) AS DOUBLE) / count(sales)', 4)} AS avg_daily_sales, min(sales) AS min_sales, max(sales) AS max_sales,
    {_where('sales < 0')} AS negative_sales_count, {_where('date IS NULL')} AS missing_dates, {_where('sell_price IS NULL')} AS missing_prices,
    {_where('sell_price <= 0')} AS invalid_prices,
    {rnd("100e0 * CAST(" + _where('sell_price IS NULL') + " AS DOUBLE) / count(*)", 2)} AS missing_price_pct,
    {_DUP_FACT} AS duplicate_combinations, 'PASS' AS row_count_status, 'PASS' AS date_range_status,
    CASE WHEN {_where('sales < 0')} = 0 THEN 'PASS' ELSE 'FAIL' END AS negative_sales_status,
    CASE WHEN {_where('date IS NULL')} = 0 THEN 'PASS' ELSE 'FAIL' END AS missing_dates_status,
    CASE WHEN {_where('sell_price IS NULL')} = 0 THEN 'PASS' ELSE 'WARNING' END AS missing_prices_status,
    CASE WHEN {_DUP_FACT} = 0 THEN 'PASS' ELSE 'FAIL' END AS duplicates_status,
    CASE WHEN {_where('sell_price <= 0')} = 0 THEN 'PASS' ELSE 'FAIL' END AS invalid_prices_status FROM faulty_fact"""

_RULES = " UNION ALL ".join(
    f"SELECT '{a}->{b}' AS rule, {a} AS child, count(DISTINCT {b}) AS parents FROM fact GROUP BY {a}" for a, b in q.HIERARCHY_RULES
)
_PRICED = """SELECT c.date, c.item_id, dept_id, cat_id, c.store_id, state_id, c.sales, p.sell_price FROM cells c LEFT JOIN prices p
    ON c.store_id = p.store_id AND c.item_id = p.item_id AND c.wm_yr_wk = p.wm_yr_wk"""


_SECTIONS = ", ".join(f"'{section}'" for section in q.SECTIONS)


def _line(section: str, place: str, name: str, value: str, source: str = "", key: str = "NULL", status: str = "NULL", mean: str = "NULL", low: str = "NULL", high: str = "NULL") -> str:
    return f"""SELECT '{section}' AS section, CAST({place} AS INTEGER) AS place, {name} AS name, CAST({key} AS VARCHAR) AS key, CAST({status} AS VARCHAR) AS status,
        CAST({value} AS BIGINT) AS value, CAST({mean} AS DOUBLE) AS mean, CAST({low} AS DOUBLE) AS low, CAST({high} AS DOUBLE) AS high {source}"""


def _report_sql(wide: str) -> str:
    """The report over a fact named t, one SELECT per line or list."""
    fail = lambda test, word="FAIL": f"CASE WHEN {test} THEN 'PASS' ELSE '{word}' END"
    one, mean = "FROM t", rnd("CAST(sum(sales) AS DOUBLE) / count(sales)", 4)
    price = f"(CAST(sum(CAST(sell_price AS DECIMAL(18,6))) AS DOUBLE) / count(sell_price))"
    counts = {
        "negative_sales_count": _where("sales < 0"),
        "missing_dates": _where("date IS NULL"),
        "duplicate_combinations": _DUP_FACT,
        "invalid_prices": _where("sell_price <= 0"),
    }
    no_price = _where("sell_price IS NULL")
    lines = [
        _line("size", "0", "'row_count'", "count(*)", one, status=fail("count(*) > 0")),
        _line("size", "1", "'date_range'", "date_diff('day', min(date), max(date))", one, "CAST(min(date) AS VARCHAR) || ' to ' || CAST(max(date) AS VARCHAR)", fail("min(date) IS NOT NULL")),
    ]
    for place, (name, column) in enumerate((("items", "item_id"), ("stores", "store_id"), ("departments", "dept_id"), ("categories", "cat_id"), ("states", "state_id")), 2):
        lines.append(_line("size", str(place), f"'unique_{name}'", f"count(DISTINCT {column})", one))
    raw = f"(SELECT sum(sales) FROM {wide})"
    lines.append(_line("integrity", "0", "'raw_sales_match'", raw, one, status=fail(f"sum(sales) = {raw}", "WARNING")))
    for place, name in enumerate(("negative_sales_count", "missing_dates", None, "duplicate_combinations", "invalid_prices"), 1):
        if name is None:
            lines.append(_line("integrity", str(place), "'missing_prices'", no_price, one, status=fail(f"{no_price} = 0", "WARNING"), mean=rnd(f"100e0 * CAST({no_price} AS DOUBLE) / count(*)", 2)))
        else:
            lines.append(_line("integrity", str(place), f"'{name}'", counts[name], one, status=fail(f"{counts[name]} = 0")))
    broken = {}
    for place, (child, parent) in enumerate(q.HIERARCHY_RULES):
        bad = f"(SELECT {child} AS c FROM t WHERE {child} IS NOT NULL GROUP BY 1 HAVING count(DISTINCT {parent}) > 1)"
        broken[place] = f"(SELECT count(*) FROM {bad})"
        shown = f"(SELECT string_agg(c, ', ' ORDER BY c) FROM (SELECT c FROM {bad} ORDER BY c LIMIT 5))"
        lines.append(_line("hierarchy", str(place), f"'{child}->{parent}'", broken[place], key=shown, status=fail(f"{broken[place]} = 0")))
    all_broken = " + ".join(broken.values())
    lines.append(_line("hierarchy", str(len(broken)), "'overall_hierarchy'", all_broken, status=fail(f"{all_broken} = 0")))
    lines.append(_line("sales", "0", "'total_sales'", "sum(sales)", one))
    lines.append(_line("sales", "1", "'daily_sales'", "count(sales)", one, mean=mean, low="min(sales)", high="max(sales)"))
    for place, (level, column) in enumerate((("store", "store_id"), ("category", "cat_id"), ("department", "dept_id")), 2):
        lines.append(_line("sales", str(place), f"'sales_by_{level}'", "sum(sales)", f"FROM t WHERE {column} IS NOT NULL GROUP BY {column}", column, mean=mean))
    best = "(SELECT item_id FROM t WHERE item_id IS NOT NULL GROUP BY 1 ORDER BY sum(sales) DESC NULLS LAST, item_id LIMIT 3)"
    lines.append(_line("sales", "5", "'top_items'", "sum(sales)", f"FROM t WHERE item_id IN {best} GROUP BY item_id", "item_id", mean=mean))
    lines.append(_line("calendar", "isodow(date) - 1", "'sales_by_weekday'", "sum(sales)", "FROM t WHERE date IS NOT NULL GROUP BY isodow(date), dayname(date)", "dayname(date)", mean=mean))
    weekend = "isodow(date) >= 6"
    lines.append(_line("calendar", "7", "'weekend_contrast'", "sum(sales)", f"FROM t WHERE date IS NOT NULL GROUP BY {weekend}", f"CASE WHEN {weekend} THEN 'Weekend (Sat-Sun)' ELSE 'Weekday (Mon-Fri)' END", mean=mean))
    lines.append(_line("prices", "0", "'sell_price'", "count(sell_price)", one, mean=rnd(price, 2), low=rnd("min(sell_price)", 2), high=rnd("max(sell_price)", 2)))
    lines.append(_line("prices", "1", "'median_price'", "count(sell_price)", one, mean=rnd("median(sell_price)", 2)))
    lines.append(_line("prices", "2", "'price_by_category'", "count(sell_price)", "FROM t WHERE cat_id IS NOT NULL GROUP BY cat_id", "cat_id", mean=rnd(price, 4), low="min(sell_price)", high="max(sell_price)"))
    tests = ["count(*) = 0", "min(date) IS NULL", *[f"{c} > 0" for c in counts.values()], f"({all_broken}) > 0"]
    failed = " + ".join(f"CAST({test} AS INTEGER)" for test in tests)
    lines.append(_line("overall", "0", "'overall_status'", failed, one, status=fail(f"{failed} = 0")))
    return " UNION ALL ".join(lines)


def _models(spark, d):
    daily = i.daily(spark, d)
    return {
        "stg_calendar": rollups.stg_calendar(i.calendar(spark, d)),
        "stg_sales": rollups.stg_sales(i.wide(spark, d)),
        "stg_sell_prices": rollups.stg_sell_prices(i.raw_prices(spark, d).withColumn("sell_price", q.to_number("sell_price"))),
        "int_daily_sales": daily,
        "int_weekly_sales": rollups.weekly_sales(daily),
        "int_monthly_sales": rollups.monthly_sales(daily),
        "mart_sales_forecasting": rollups.mart_sales_forecasting(daily),
        "fct_daily_sales": daily,
        "fct_weekly_sales": rollups.weekly_sales(daily),
        "fct_monthly_sales": rollups.monthly_sales(daily),
    }


def _not_null(spark, d):
    return q.union_all([q.check_not_null(df, name) for name, df in _models(spark, d).items()])


_MODEL_SQL = {
    "stg_calendar": "stg_cal",
    "stg_sales": "(SELECT id AS series_id, item_id, store_id, cat_id, state_id FROM ids)",
    "stg_sell_prices": "(SELECT store_id, item_id, wm_yr_wk, TRY_CAST(sell_price AS DOUBLE) AS sell_price FROM raw_prices)",
    "int_daily_sales": "daily",
    "int_weekly_sales": "weekly",
    "int_monthly_sales": "monthly",
    "mart_sales_forecasting": "mart",
    "fct_daily_sales": "daily",
    "fct_weekly_sales": "weekly",
    "fct_monthly_sales": "monthly",
}
_NOT_NULL = " UNION ALL ".join(
    f"SELECT '{m}' AS model, '{c}' AS column_name, 'not_null' AS rule, {_where(c + ' IS NULL')} AS violations FROM {_MODEL_SQL[m]}"
    for m, columns in q.NOT_NULL.items()
    for c in columns
)
# The supplied categories and states differ from the declared ones, so every value is a violation.
_ACCEPTED = " UNION ALL ".join(
    f"""SELECT 'stg_sales' AS model, '{c}' AS column_name, 'accepted_values' AS rule,
    count(DISTINCT {c}) FILTER (WHERE {c} NOT IN ({', '.join(repr(v) for v in allowed)})) AS violations FROM ids"""
    for c, allowed in q.ACCEPTED["stg_sales"].items()
)


def _unique(spark, d):
    """Uniqueness on the calendar with repeated days, and on the series list."""
    calendar = i.raw_calendar(spark, d).selectExpr("date AS sales_date", "d AS day_id")
    return q.check_unique(calendar, "stg_calendar").unionByName(q.check_unique(rollups.stg_sales(i.wide(spark, d)), "stg_sales"))


def _repeats(column: str) -> str:
    return f"(SELECT count(*) FROM (SELECT {column} FROM raw_cal WHERE {column} IS NOT NULL GROUP BY 1 HAVING count(*) > 1))"


ENTRIES = {
    "count_missing": (
        lambda s, d: q.count_missing(i.raw_calendar(s, d)),
        query(
            " UNION ALL ".join(
                f"SELECT '{c}' AS column_name, {_where(chr(34) + c + chr(34) + ' IS NULL')} AS missing_count FROM raw_cal"
                for c in (
                    "date wm_yr_wk weekday wday month year d event_name_1 event_type_1 event_name_2 event_type_2 snap_CA snap_TX snap_WI"
                ).split()
            )
        ),
    ),
    "count_duplicates": (lambda s, d: q.count_duplicates(i.faulty_fact(s, d), FACT_KEY), query(f"SELECT {_DUP_FACT} AS duplicate_count FROM faulty_fact")),
    "dq_calendar": (lambda s, d: q.dq_calendar(i.raw_calendar(s, d)), query(_detailed(_CAL, "raw_cal"))),
    "dq_sales": (lambda s, d: q.dq_sales(i.raw_sales(s, d)), query(_detailed(_SALES, "raw_cal"))),
    "dq_prices": (lambda s, d: q.dq_prices(i.raw_prices(s, d)), query(_detailed(_PRICES, "raw_cal"))),
    "dq_audit": (lambda s, d: rounded_prices(_audits(s, d)), query(_RAW_AUDIT)),
    "render_audit": (
        lambda s, d: audit.render_audit(_audits(s, d)),
        query(
            """SELECT dataset, 1 AS line_no, '  [' || CASE WHEN passed THEN 'PASS' ELSE 'FAIL' END || '] ' || name || ': ' || detail AS line FROM r WHERE kind = 'check'
            UNION ALL SELECT dataset, 0, upper(dataset) || ': ' || string_agg(piece, '; ' ORDER BY list_position(['shape', 'missing', 'stat'], kind), name)
            FROM (SELECT *, CASE WHEN kind = 'shape' THEN format('{:,}', amount) || ' ' || name
            WHEN kind = 'missing' AND amount > 0 THEN 'nulls in ' || name || ': ' || format('{:,}', amount) || printf(' (%.2f%%)', mean_value)
            WHEN kind = 'stat' AND min_value IS NOT NULL THEN name || printf(': min %.2f, max %.2f, mean %.2f', min_value, max_value, mean_value)
            WHEN kind = 'stat' AND detail IS NOT NULL THEN name || ': ' || detail END AS piece FROM r) WHERE piece IS NOT NULL GROUP BY dataset""",
            r=_RAW_AUDIT,
        ),
    ),
    "dq_report": (
        lambda s, d: audit.audit_summary(_audits(s, d)),
        query(
            """SELECT dataset, max(amount) FILTER (kind = 'shape' AND name = 'rows') AS row_count, max(amount) FILTER (kind = 'shape' AND name = 'columns') AS column_count,
            max(amount) FILTER (kind = 'shape' AND name = 'duplicate rows') AS duplicate_rows, count(*) FILTER (kind = 'missing' AND amount > 0) AS columns_with_nulls,
            CAST(sum(amount) FILTER (kind = 'missing') AS BIGINT) AS null_cells, count(*) FILTER (kind = 'check') AS check_count,
            count(*) FILTER (kind = 'check' AND NOT passed) AS failed_count, CAST(sum(amount) FILTER (kind = 'check') AS BIGINT) AS issue_count,
            CASE WHEN bool_and(coalesce(passed, true)) THEN 'PASS' ELSE 'FAIL' END AS overall_status FROM r GROUP BY 1""",
            r=_RAW_AUDIT,
        ),
    ),
    "dq_stats": (
        lambda s, d: q.column_stats(i.calendar(s, d), ["year", "month", "wday"]).unionByName(q.cell_stats(i.raw_sales(s, d))),
        query(
            " UNION ALL ".join(
                f"SELECT '{c}' AS column_name, CAST(min({c}) AS DOUBLE) AS min_value, CAST(max({c}) AS DOUBLE) AS max_value, avg({c}) AS mean_value FROM cal"
                for c in ("year", "month", "wday")
            )
            + f""" UNION ALL SELECT 'daily_sales_volume', min(TRY_CAST(cell AS DOUBLE)), max(TRY_CAST(cell AS DOUBLE)),
            {rnd('avg(TRY_CAST(cell AS DOUBLE))', 2)} FROM raw_cells"""
        ),
    ),
    "validate_fact": (lambda s, d: q.validate_fact(i.faulty_fact(s, d)), query(_VALID)),
    "validate_transform": (
        lambda s, d: q.validate_transform(i.built(s, d), i.wide(s, d)),
        query(
            f"""SELECT count(*) AS row_count, min(date) AS min_date, max(date) AS max_date, count(DISTINCT item_id) AS unique_items,
            count(DISTINCT store_id) AS unique_stores, count(DISTINCT dept_id) AS unique_depts, count(DISTINCT cat_id) AS unique_cats,
            CAST(sum(sales) AS BIGINT) AS total_sales, {_where('sales < 0')} AS negative_sales_count, {_where('date IS NULL')} AS missing_dates,
            {_where('sell_price IS NULL')} AS missing_prices, {_DUP_FACT} AS duplicate_combinations,
            (SELECT CAST(sum(sales) AS BIGINT) FROM cells) AS raw_total_sales, sum(sales) = (SELECT sum(sales) FROM cells) AS sales_match FROM t""",
            t=_PRICED,
        ),
    ),
    "check_hierarchy": (
        lambda s, d: q.check_hierarchy(i.fact(s, d)),
        query(f"SELECT rule, {_where('parents > 1')} = 0 AS passed, {_where('parents > 1')} AS offender_count FROM t GROUP BY 1", t=_RULES),
    ),
    "hierarchy_offenders": (
        lambda s, d: q.hierarchy_offenders(i.fact(s, d)),
        query(
            "SELECT rule, child FROM (SELECT *, row_number() OVER (PARTITION BY rule ORDER BY child) AS rn FROM t WHERE parents > 1) WHERE rn <= 5",
            t=_RULES,
        ),
    ),
    "validation_report": (lambda s, d: q.validation_report(i.built(s, d), i.wide(s, d)), query(_report_sql("cells"), t=_PRICED)),
    "validation_report_faulty": (
        # A fact with negative units and prices, lost dates and prices, repeated keys, and other items than the wide table.
        lambda s, d: q.validation_report(i.stored_faulty_fact(s, d), i.wide(s, d)),
        query(_report_sql("cells"), t="SELECT * FROM faulty_fact"),
    ),
    "render_report": (
        lambda s, d: q.render_report(q.validation_report(i.stored_faulty_fact(s, d), i.wide(s, d))),
        query(
            f"""SELECT row_number() OVER (ORDER BY section_no, place, value DESC NULLS LAST, key NULLS FIRST, line) - 1 AS line_no, line FROM (
            SELECT section_no, place, value, key, '  ' || rpad(concat_ws(' ', name, key), 48, ' ') || ' ' || concat_ws(', ',
                format('{{:,}}', value), 'mean ' || printf('%.2f', mean), 'from ' || printf('%.2f', low) || ' to ' || printf('%.2f', high), '[' || status || ']') AS line
            FROM (SELECT *, list_position([{_SECTIONS}], section) AS section_no FROM r)
            UNION ALL SELECT DISTINCT list_position([{_SECTIONS}], section), -1, NULL, NULL, list_position([{_SECTIONS}], section) || '. ' || upper(section) FROM r)""",
            t="SELECT * FROM faulty_fact",
            r=_report_sql("cells"),
        ),
    ),
    "check_not_null": (_not_null, query(_NOT_NULL)),
    "check_unique": (
        _unique,
        query(
            f"""SELECT 'stg_calendar' AS model, 'sales_date' AS column_name, 'unique' AS rule, {_repeats('date')} AS violations
            UNION ALL SELECT 'stg_calendar', 'day_id', 'unique', {_repeats('d')}
            UNION ALL SELECT 'stg_sales', 'series_id', 'unique', (SELECT count(*) - count(DISTINCT id) FROM ids)"""
        ),
    ),
    "check_accepted_values": (lambda s, d: q.check_accepted_values(rollups.stg_sales(i.wide(s, d)), "stg_sales"), query(_ACCEPTED)),
    "assert_daily_non_negative": (
        lambda s, d: q.assert_daily_non_negative(i.faulty_daily(s, d)),
        query("SELECT sales_date, store_id, item_id, sales FROM faulty_daily WHERE sales < 0"),
    ),
    "assert_daily_unique": (
        lambda s, d: q.assert_daily_unique(i.faulty_daily(s, d)),
        query("SELECT sales_date, store_id, item_id, count(*) AS record_count FROM faulty_daily GROUP BY 1, 2, 3 HAVING count(*) > 1"),
    ),
    "assert_weekly_unique": (
        # On the dense grain, where weeks across a year end do occur.
        lambda s, d: q.assert_weekly_unique(rollups.weekly_sales(i.dense_daily(s, d))),
        query(
            """SELECT wm_yr_wk, store_id, item_id, count(*) AS record_count FROM (SELECT DISTINCT c.wm_yr_wk, c.year, store_id, item_id
            FROM series s JOIN cal c ON s.date = c.date) GROUP BY 1, 2, 3 HAVING count(*) > 1"""
        ),
    ),
    "assert_monthly_unique": (
        lambda s, d: q.assert_monthly_unique(rollups.monthly_sales(i.daily(s, d))),
        query("SELECT year, month, store_id, item_id, count(*) AS record_count FROM monthly GROUP BY 1, 2, 3, 4 HAVING count(*) > 1"),
    ),
    "assert_mart_unique": (
        lambda s, d: q.assert_mart_unique(rollups.mart_sales_forecasting(i.faulty_daily(s, d))),
        query("SELECT sales_date AS date, store_id, item_id, count(*) AS record_count FROM faulty_daily GROUP BY 1, 2, 3 HAVING count(*) > 1"),
    ),
    "assert_mart_non_negative": (
        lambda s, d: q.assert_mart_non_negative(rollups.mart_sales_forecasting(i.faulty_daily(s, d))),
        query("SELECT sales_date AS date, store_id, item_id, sales, sell_price FROM faulty_daily WHERE sales < 0 OR sell_price < 0"),
    ),
    "assert_weekly_total": (
        lambda s, d: q.assert_weekly_total(i.faulty_daily(s, d), rollups.weekly_sales(i.daily(s, d))),
        query(
            """SELECT * FROM (SELECT CAST(sum(sales) AS BIGINT) AS total_daily FROM faulty_daily),
            (SELECT CAST(sum(total_weekly_sales) AS BIGINT) AS total_weekly FROM weekly) WHERE total_daily <> total_weekly"""
        ),
    ),
    "assert_monthly_total": (
        lambda s, d: q.assert_monthly_total(i.faulty_daily(s, d), rollups.monthly_sales(i.daily(s, d))),
        query(
            """SELECT * FROM (SELECT CAST(sum(sales) AS BIGINT) AS total_daily FROM faulty_daily),
            (SELECT CAST(sum(total_monthly_sales) AS BIGINT) AS total_monthly FROM monthly) WHERE total_daily <> total_monthly"""
        ),
    ),
}

