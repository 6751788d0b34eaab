"""Audits, validation and assertions, on clean and on broken frames."""

from pyspark.sql import functions as F

import frames
from shelfline.operators import profiles, quality as q, rollups


def checks(df):
    return {r.check_name: (r.passed, r.issue_count) for r in df.collect()}


def test_calendar_audit(spark):
    got = checks(q.dq_calendar(frames.broken_calendar(spark)))
    assert got["Missing Dates"] == (False, 1)
    assert got["Valid Date Format"] == (False, 1)
    assert got["Unexpected Event Types"] == (False, 1)
    assert got["Missing Weekday Values"] == (False, 1)
    assert got["Duplicate Dates"] == (True, 0) and got["Event Coverage"] == (True, 0)
    assert all(passed for passed, _ in checks(q.dq_calendar(frames.calendar(spark))).values())


def test_sales_audit(spark):
    got = checks(q.dq_sales(frames.broken_wide(spark)))
    assert got["Negative Sales Volumes"] == (False, 1)
    assert got["Missing Sales Values"] == (False, 1)
    assert got["Numeric Sales Data Types"] == (True, 0)
    big = frames.wide(spark).withColumn("d_1", F.lit(501))
    assert checks(q.dq_sales(big))["Sales Outliers Audit"] == (True, 2)
    text = frames.wide(spark).withColumn("d_1", F.when(F.col("item_id") == "H1", "x").otherwise("3"))
    assert checks(q.dq_sales(text))["Numeric Sales Data Types"] == (False, 1)


def test_price_audit(spark):
    got = checks(q.dq_prices(frames.broken_prices(spark)))
    assert got["Duplicate Store-Item-Week Keys"] == (False, 1)
    assert got["Negative Prices"] == (False, 1) and got["Zero Prices"] == (False, 1)
    as_text = frames.prices(spark).withColumn("sell_price", F.col("sell_price").cast("string"))
    assert checks(q.dq_prices(as_text))["Numeric Price Data Type"] == (False, 2)


def test_report_status(spark):
    both = q.dq_prices(frames.broken_prices(spark)).unionByName(q.dq_calendar(frames.calendar(spark)))
    assert {r.dataset: r.overall_status for r in q.dq_report(both).collect()} == {"prices": "FAIL", "calendar": "PASS"}
    lines = [r.line for r in q.render_checks(both, q.table_shape(frames.broken_prices(spark), "prices")).collect()]
    assert lines[0].startswith("  [") or "PRICES" in "".join(lines)


def test_duplicates_count_null_keys(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "a")], "a int, b string")
    assert q.count_duplicates(df).first()[0] == 1
    assert q.count_duplicates(df, ["b"]).first()[0] == 1
    wide = frames.wide(spark)
    assert q.count_duplicates(wide.unionByName(wide)).first()[0] == 2
    assert q.count_duplicates(wide).first()[0] == 0


def test_fact_validation_clean(spark):
    row = q.validate_fact(frames.fact(spark)).first()
    assert (row.row_count, row.total_sales) == (16, 80)
    assert (str(row.min_date), str(row.max_date)) == ("2011-01-29", "2011-02-01")
    assert (row.unique_items, row.unique_stores, row.unique_depts, row.unique_cats, row.unique_states) == (2, 2, 2, 2, 2)
    assert {v for k, v in row.asDict().items() if k.endswith("_status")} == {"PASS"}


def test_fact_validation_corrupted(spark):
    rows = [list(r) for r in frames.fact_rows()]
    rows[0][6] = -5
    rows[1][7] = -1.0
    rows.append(list(rows[2]))
    row = q.validate_fact(frames.fact(spark, [tuple(r) for r in rows])).first()
    assert row.negative_sales_status == row.duplicates_status == row.invalid_prices_status == "FAIL"
    assert (row.negative_sales_count, row.duplicate_combinations, row.invalid_prices) == (1, 1, 1)
    empty = q.validate_fact(frames.fact(spark).limit(0)).first()
    assert empty.row_count == 0 and empty.row_count_status == "FAIL" and empty.date_range_status == "FAIL"


def test_hierarchy(spark):
    assert all(r.passed for r in q.check_hierarchy(frames.fact(spark)).collect())
    rows = [list(r) for r in frames.fact_rows()]
    rows[0][2], rows[0][5] = "F_1", "TX"
    broken = frames.fact(spark, [tuple(r) for r in rows])
    got = {r.rule: r.passed for r in q.check_hierarchy(broken).collect()}
    assert not got["item_id->dept_id"] and not got["store_id->state_id"]
    assert {(r.rule, r.child) for r in q.hierarchy_offenders(broken).collect()} >= {("item_id->dept_id", "H1"), ("store_id->state_id", "CA_1")}


def test_validation_report(spark):
    got = {r.name: r.status for r in q.validation_report(frames.fact(spark)).collect()}
    assert got["overall_status"] == "PASS"
    wide = frames.wide(spark)
    got = {r.name: r.status for r in q.validation_report(frames.fact(spark), wide).collect()}
    assert got["raw_sales_match"] == "WARNING" and got["overall_status"] == "PASS"


def test_assertions_are_empty_on_clean_models(spark):
    daily = rollups.daily_sales(frames.fact(spark), rollups.stg_calendar(frames.calendar(spark)))
    weekly, monthly = rollups.weekly_sales(daily), rollups.monthly_sales(daily)
    mart = rollups.mart_sales_forecasting(daily)
    for rows in (
        q.assert_daily_non_negative(daily),
        q.assert_daily_unique(daily),
        q.assert_weekly_unique(weekly),
        q.assert_monthly_unique(monthly),
        q.assert_mart_unique(mart),
        q.assert_mart_non_negative(mart),
        q.assert_weekly_total(daily, weekly),
        q.assert_monthly_total(daily, monthly),
    ):
        assert rows.isEmpty()
    assert {r.violations for r in q.check_not_null(mart, "mart_sales_forecasting").collect()} == {0}


def test_accepted_and_unique(spark):
    staged = rollups.stg_sales(frames.wide(spark))
    assert {r.violations for r in q.check_accepted_values(staged, "stg_sales").collect()} == {0}
    odd = staged.withColumn("cat_id", F.lit("TOYS"))
    assert {r.column_name: r.violations for r in q.check_accepted_values(odd, "stg_sales").collect()} == {"cat_id": 1, "state_id": 0}
    assert {r.violations for r in q.check_unique(staged.unionByName(staged), "stg_sales").collect()} == {2}


def test_profiles(spark):
    fact = frames.fact(spark)
    assert profiles.daily_totals(fact).count() == 4
    trend = profiles.sales_trend_summary(fact).first()
    assert (trend.first_day_sales, trend.last_day_sales, trend.peak_day_sales, str(trend.peak_day_date)) == (20, 20, 20, "2011-01-29")
    stats = profiles.price_stats(fact).first()
    assert (stats.min_price, stats.max_price, stats.median_price, stats.missing_count) == (3.5, 8.26, 5.88, 0)
    no_price = profiles.price_stats(fact.withColumn("sell_price", F.lit(None).cast("double"))).first()
    assert no_price.avg_price is None and no_price.missing_pct == 100.0
    assert [r.day_name for r in profiles.sales_by_dow(fact).collect()] == ["Monday", "Tuesday", "Saturday", "Sunday"]
    assert {r.period_type: r.record_count for r in profiles.weekend_vs_weekday(fact).collect()} == {"Weekend (Sat-Sun)": 8, "Weekday (Mon-Fri)": 8}


def test_exact_median_matches_sorting(spark):
    """Skewed values: most are equal, a few are huge, so several narrowing passes are needed."""
    import random
    import statistics

    rng = random.Random(3)
    for n in (1, 2, 5000, 5001):
        values = [rng.choice([1.0, rng.random(), rng.random() * 1e-6, rng.random() * 1e9]) for _ in range(n)]
        df = spark.createDataFrame([(v,) for v in values], "x double")
        assert profiles.exact_median(df, "x") == statistics.median(values)
    equal = spark.createDataFrame([(2.0,)] * 9 + [(None,)], "x double")
    assert profiles.exact_median(equal, "x") == 2.0


def test_dirty_calendar_text(spark):
    rows = [("2011-01-29", "2011"), ("12:30", "20xx"), ("2011", None), ("2011-02-30", "1999"), (" 2011-03-01 10:00:00", "2012.0")]
    raw = spark.createDataFrame(rows, "date string, year string").selectExpr("*", "'Monday' AS weekday", "CAST(NULL AS STRING) AS event_type_1")
    found = {r.check_name: r.issue_count for r in q.dq_calendar(raw).collect()}
    assert found["Valid Date Format"] == 3 and found["Valid Year/Week Ranges"] == 2
    stats = q.column_stats(raw, ["year"]).first()
    assert (stats.min_value, stats.max_value) == (1999.0, 2012.0)


def test_order_keys_keep_every_double(spark):
    import math
    import random
    import struct

    from shelfline.operators import ranks

    rng = random.Random(1)
    values = [0.0, -0.0, 5e-324, -5e-324, math.inf, -math.inf, 1.7976931348623157e308]
    values += [near for k in range(-1060, 1024) for near in (2.0**k, math.nextafter(2.0**k, 0), math.nextafter(2.0**k, math.inf))]
    values += [v for v in (struct.unpack("d", struct.pack("Q", rng.getrandbits(64)))[0] for _ in range(3000)) if v == v]
    df = spark.createDataFrame([(v,) for v in values], "v double").select("v", ranks.order_key(F.col("v")).alias("key"))
    rows = df.select("v", "key", ranks.from_key(F.col("key")).alias("back")).collect()
    assert all(r.v == r.back for r in rows)
    by_value, by_key = sorted(rows, key=lambda r: r.v), sorted(rows, key=lambda r: r.key)
    assert [r.v for r in by_value] == [r.v for r in by_key]


def test_ranks_of_many_and_no_values(spark):
    from shelfline.operators import ranks

    df = spark.range(1, 10_001).select((F.col("id") % 1000).cast("double").alias("x"))
    quarters = {"q1": (1, 3, 4), "q3": (3, 3, 4)}
    assert {r.name: r.value for r in ranks.ranked_values(df, F.col("x"), quarters).collect()} == {"q1": 249.0, "q3": 749.0}
    assert ranks.median(df.limit(0), F.col("x")).first().value is None


def test_price_statistics_of_odd_prices(spark):
    nan, inf = float("nan"), float("inf")
    prices = [1.0, nan, 3.0, None, 2e12, 4e35]
    fact = frames.fact(spark, [(*frames.fact_rows()[0][:7], p) for p in prices])
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "planning")
    planned = profiles.price_stats(fact)
    assert not tracker.getJobIdsForGroup("planning")  # nothing has run yet
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    row = planned.first()
    assert (row.min_price, row.max_price, row.missing_count, row.missing_pct) == (1.0, 4e35, 2, 33.33)
    assert row.median_price == (3.0 + 2e12) / 2 and row.avg_price == 1e35
    endless = profiles.price_stats(frames.fact(spark, [(*frames.fact_rows()[0][:7], p) for p in (1.0, inf, 2.0)])).first()
    assert (endless.median_price, endless.max_price, endless.avg_price) == (2.0, inf, inf)


def test_rollups_shuffle_once_and_count_far_days(spark):
    import datetime as dt

    calendar = rollups.stg_calendar(frames.calendar(spark))
    daily = rollups.daily_sales(frames.fact(spark), calendar)
    for rollup in (rollups.weekly_sales, rollups.monthly_sales):
        df = rollup(daily)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]
        assert sum("hashpartitioning" in line and "item_id" in line for line in plan.splitlines()) == 1
    # Days without a calendar row share the null period: 200 of them, each twice, every second one without sales.
    start = dt.date(2030, 1, 1)
    rows = [(start + dt.timedelta(n), "H1", "H_1", "HOBBIES", "CA_1", "CA", n % 2, 1.0) for n in range(200) for _ in range(2)]
    far = rollups.weekly_sales(rollups.daily_sales(frames.fact(spark, rows + frames.fact_rows()), calendar))
    got = {(r.wm_yr_wk, r.item_id, r.store_id): r for r in far.collect()}
    lost = got[None, "H1", "CA_1"]
    assert (lost.recorded_days, lost.selling_days, lost.total_weekly_sales, lost.avg_sell_price) == (201, 101, 205, 1.0181)  # and the fourth day of the frames
    # The fourth day of the frames has no calendar row either.
    assert got[11101, "H1", "CA_1"].recorded_days == 3 and got[None, "F1", "TX_1"].recorded_days == 1
