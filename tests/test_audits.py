"""Whole audits: observed and by their own pass, mixed cells, statistics, report lines."""

import frames
from pyspark.sql import functions as F
from shelfline.operators import audit, cube, quality as q, rollups


def rows_of(df):
    return {(r.kind, r.name): r for r in df.collect()}


def test_calendar_statistics(spark):
    good = rows_of(audit.audit(frames.calendar(spark), "calendar"))
    assert good["stat", "date_range"].detail == "2011-01-29 to 2011-01-31"
    assert (good["stat", "wday"].min_value, good["stat", "wday"].max_value, good["stat", "wday"].mean_value) == (1.0, 3.0, 2.0)
    assert (good["shape", "rows"].amount, good["shape", "columns"].amount, good["shape", "duplicate rows"].amount) == (3, 14, 0)
    bad = rows_of(audit.audit(frames.broken_calendar(spark), "calendar"))
    assert bad["stat", "date_range"].detail is None and bad["check", "Event Coverage"].detail == "2 days with an event"
    assert (bad["missing", "weekday"].amount, bad["missing", "weekday"].mean_value, bad["type", "date"].detail) == (1, 25.0, "string")


def test_mixed_cells_are_counted_once_each(spark):
    wide = frames.broken_wide(spark).withColumns({"d_1": F.when(F.col("item_id") == "H1", "x").otherwise("-3"), "d_3": F.lit(600)})
    got = rows_of(audit.audit(wide, "sales"))
    assert {n: got["check", n].amount for n in audit.SALES_CHECKS[3:]} == {
        "Negative Sales Volumes": 1, "Missing Sales Values": 1, "Numeric Sales Data Types": 1, "Sales Outliers Audit": 2}
    volume = got["stat", "daily_sales_volume"]
    assert (volume.min_value, volume.max_value, volume.mean_value) == (-3.0, 600.0, 301.75)
    none = rows_of(audit.audit(wide.drop("d_1", "d_2", "d_3"), "sales"))
    assert none["check", "Missing Sales Values"].amount == 0 and none["stat", "daily_sales_volume"].mean_value is None


def test_observed_equals_own_pass(spark, tmp_path):
    for name, df in (("calendar", frames.broken_calendar(spark)), ("sales", frames.broken_wide(spark)), ("prices", frames.broken_prices(spark)), ("prices", frames.prices(spark).limit(0))):
        seen = audit.Observed(df, name)
        assert seen.rows.columns == df.columns
        seen.rows.write.mode("overwrite").parquet(str(tmp_path / name))
        observed, own = audit.audit(df, name, found=seen.figures()), audit.audit(df, name)
        assert sorted(map(str, observed.collect())) == sorted(map(str, own.collect()))


def test_an_observation_of_repeated_tasks_is_discarded(spark, tmp_path):
    df = frames.broken_prices(spark)
    seen = audit.Observed(df, "prices")
    seen.rows.unionByName(seen.rows).write.parquet(str(tmp_path / "twice"))
    assert rows_of(audit.audit(df, "prices", found=seen.figures()))["shape", "rows"].amount == 3


def test_audit_lines_and_summary(spark):
    rows = audit.audit(frames.broken_prices(spark), "prices").unionByName(audit.audit(frames.calendar(spark), "calendar"))
    lines = [r.line for r in audit.render_audit(rows).collect()]
    assert len(lines) == 2 + 13 and "  [FAIL] Negative Prices: 1 issues" in lines
    head = next(line for line in lines if line.startswith("PRICES"))
    assert head == "PRICES: 4 columns; 0 duplicate rows; 3 rows; sell_price: min -0.50, max 1.99, mean 0.50"
    summary = {r.dataset: r for r in audit.audit_summary(rows).collect()}
    assert (summary["prices"].overall_status, summary["prices"].failed_count, summary["calendar"].overall_status) == ("FAIL", 3, "PASS")


def test_report_sections_and_offenders(spark):
    rows = [list(r) for r in frames.fact_rows()]
    rows[0][2], rows[0][5] = "F_1", "TX"
    got = {(r.section, r.name, r.key): r for r in q.validation_report(frames.fact(spark, [tuple(r) for r in rows]), frames.wide(spark)).collect()}
    assert {section for section, _, _ in got} == set(q.SECTIONS)
    assert got["hierarchy", "item_id->dept_id", "H1"].status == "FAIL" and got["hierarchy", "store_id->state_id", "CA_1"].value == 1
    assert got["overall", "overall_status", None].status == "FAIL" and got["overall", "overall_status", None].value == 1
    assert got["sales", "sales_by_store", "CA_1"].value == 40 and got["calendar", "sales_by_weekday", "Monday"].mean == 5.0
    assert (got["prices", "price_by_category", "FOODS"].mean, got["prices", "median_price", None].mean) == (3.5, 5.88)
    empty = {r.name: r.status for r in q.validation_report(frames.fact(spark).limit(0)).collect()}
    assert empty["row_count"] == empty["date_range"] == empty["overall_status"] == "FAIL"
    lines = [r.line for r in q.render_report(q.validation_report(frames.fact(spark))).collect()]
    assert lines[0] == "1. SIZE" and any("top_items" in line for line in lines)


def test_only_sums_are_dealt_to_the_levels_of_the_report(spark, monkeypatch):
    monkeypatch.setattr(cube, "cut_lineage", lambda df: df)
    plan = cube.sales_cube(frames.fact(spark))._jdf.queryExecution().optimizedPlan().toString()
    expanded = [line for line in plan.splitlines() if "Expand [" in line]
    assert len(expanded) == 1 and expanded[0].count("], [") <= 3  # whole rows are repeated three times at most
    assert "min(dept_id" not in plan[plan.index("Expand ["):]  # names are compared among sums


def test_rollups_shuffle_rows_before_they_hold_groups(spark):
    daily = rollups.daily_sales(frames.fact(spark), rollups.stg_calendar(frames.calendar(spark)))
    for model, keys in ((rollups.weekly_sales(daily), "wm_yr_wk"), (rollups.monthly_sales(daily), "year")):
        plan = model._jdf.queryExecution().executedPlan().toString().splitlines()
        partial = next(n for n, line in enumerate(plan) if "HashAggregate(keys=[" + keys in line and "partial_bit_or" in line)
        assert "Exchange hashpartitioning" in plan[partial + 1]  # no task holds the groups of what it happened to read
