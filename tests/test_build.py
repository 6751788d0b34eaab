"""Cleaning, unpivot, joins, gap filling and the rollups."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import frames
from shelfline.operators import cleaning, joins, keep, reshape, rollups
from shelfline.schemas import require_columns

D = dt.date


def test_unpivot_keeps_every_cell(spark):
    long = reshape.unpivot_days(frames.wide(spark))
    assert long.count() == 6
    assert long.agg(F.sum("sales")).first()[0] == 18
    assert reshape.wide_sales_total(frames.wide(spark)).first().total_sales == 18
    cells = {(r.item_id, r.d): r.sales for r in long.collect()}
    assert cells[("F1", "d_2")] == 10 and cells[("H1", "d_3")] == 1


def test_unpivot_clips_and_reads_text(spark):
    rows = [("a", "i", "d", "c", "s", "t", "7", "-3"), ("b", "j", "d", "c", "s", "t", "x", None), ("c", "k", "d", "c", "s", "t", "nan", " 4 ")]
    text = spark.createDataFrame(rows, "id string, item_id string, dept_id string, cat_id string, store_id string, state_id string, d_1 string, d_2 string")
    got = {(r.id, r.d): r.sales for r in reshape.unpivot_days(text).collect()}
    assert got == {("a", "d_1"): 7, ("a", "d_2"): 0, ("b", "d_1"): 0, ("b", "d_2"): 0, ("c", "d_1"): 0, ("c", "d_2"): 4}
    cleaned = {r.id: (r.d_1, r.d_2) for r in cleaning.clean_sales(text).collect()}
    assert cleaned == {"a": (7, 0), "b": (0, 0), "c": (0, 4)}
    assert reshape.wide_sales_total(text).first().total_sales == 11


def test_pivot_is_inverse_of_unpivot(spark):
    wide = frames.wide(spark)
    ids = [c for c in wide.columns if not c.startswith("d_")]
    again = reshape.pivot_days(reshape.unpivot_days(wide), ids, ["d_1", "d_2", "d_3"])
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, wide.collect()))


def test_small_wide_set(spark):
    rows = [(f"x{k}", f"i{k}", "d", "c", "s", "t", *range(14)) for k in range(5)]
    assert reshape.unpivot_days(frames.wide(spark, rows)).count() == 70


def test_build_fact(spark):
    fact = joins.build_fact(frames.wide(spark), frames.calendar(spark), frames.prices(spark))
    assert fact.columns == ["date", "item_id", "dept_id", "cat_id", "store_id", "state_id", "sales", "sell_price"]
    rows = fact.collect()
    assert len(rows) == 6 and len({(r.date, r.item_id, r.store_id) for r in rows}) == 6
    assert min(r.date for r in rows) == D(2011, 1, 29)
    assert {r.item_id: r.sell_price for r in rows} == {"H1": 8.26, "F1": 3.97}


def test_missing_price_and_day_stay_visible(spark):
    prices = frames.prices(spark).filter(F.col("item_id") == "H1")
    calendar = frames.calendar(spark).filter(F.col("d") != "d_3")
    dated = joins.map_dates(reshape.unpivot_days(frames.wide(spark)), calendar)
    assert {r.wm_yr_wk for r in dated.filter(F.col("d") == "d_3").collect()} == {0}
    priced = joins.join_prices(dated, prices)
    assert priced.count() == 6
    assert priced.filter(F.col("sell_price").isNull()).count() == 4


def test_required_columns(spark):
    with pytest.raises(ValueError, match="prices"):
        require_columns(frames.prices(spark).drop("sell_price"), "prices")


def test_clean_calendar(spark):
    raw = frames.broken_calendar(spark).withColumns({"weekday": F.concat(F.lit(" "), "weekday"), "event_name_2": F.lit("nan")})
    rows = cleaning.clean_calendar(raw).collect()
    assert [r.date for r in rows] == [D(2011, 1, 29), D(2011, 1, 30), None, None]
    assert rows[0].weekday == "Saturday" and rows[0].event_name_2 is None


def test_clean_prices_keeps_first_copy_and_null_price(spark):
    raw = spark.createDataFrame(
        [(" s ", "i", "1", "2.5", 2), ("s", "i ", "1", "9.0", 1), ("s", "j", "x", "bad", 1), ("s", None, "1", "-1", 1)],
        "store_id string, item_id string, wm_yr_wk string, sell_price string, load_no int",
    )
    got = {(r.store_id, r.item_id, r.wm_yr_wk): r.sell_price for r in cleaning.clean_prices(raw, ["load_no"]).collect()}
    assert got == {("s", "i", 1): 9.0, ("s", "j", 0): None, ("s", None, 1): -1.0}


def test_dedup_first_is_total_and_skew_safe(spark):
    # One key owns a third of all rows.
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), (F.col("id") * 7 % 1000).alias("v"), "id")
    got = keep.dedup_first(df, ["k"], ["v"])
    assert got.count() == df.select("k").distinct().count()
    best = min((r.v, r.id) for r in df.filter("k = 0").collect())
    row = got.filter("k = 0").first()
    assert (row.v, row.id) == best
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_gap_fill(spark):
    gappy = frames.one_series(spark, 10, skip=(3, 4, 7)).withColumn("note", F.lit("x"))
    whole = frames.one_series(spark, 5, item="J").withColumns({"note": F.lit("y"), "sell_price": F.lit(None).cast("double")})
    holed = gappy.withColumn("sell_price", F.when(F.col("sales") > 2, F.col("sales").cast("double")))
    rows = reshape.gap_fill_dates(holed.unionByName(whole)).orderBy("item_id", "date").collect()
    first = [r for r in rows if r.item_id == "I"]
    assert [r.sales for r in first] == [1, 2, 3, 0, 0, 6, 7, 0, 9, 10]
    # Carried forward, and backward at the start of a series with a gap.
    assert [r.sell_price for r in first] == [3.0, 3.0, 3.0, 3.0, 3.0, 6.0, 7.0, 7.0, 9.0, 10.0]
    assert [r.note for r in first] == ["x", "x", "x", None, None, "x", "x", None, "x", "x"]
    # A series without a gap is left alone.
    assert [r.sell_price for r in rows if r.item_id == "J"] == [None] * 5


def test_gap_fill_drops_repeated_days_and_uses_one_shuffle(spark):
    df = frames.one_series(spark, 5, skip=(2,))
    twice = df.unionByName(df.withColumn("sales", F.col("sales") + 100))
    assert [r.sales for r in reshape.gap_fill_dates(twice).orderBy("date").collect()] == [1, 2, 0, 4, 5]
    plan = reshape.gap_fill_dates(df, unique=True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_rollups(spark):
    daily = rollups.daily_sales(frames.fact(spark), rollups.stg_calendar(frames.calendar(spark)))
    assert daily.count() == 16 and len(daily.columns) == 21
    weekly = rollups.weekly_sales(daily)
    known = weekly.filter("wm_yr_wk = 11101 AND item_id = 'H1' AND store_id = 'CA_1'").first()
    assert (known.total_weekly_sales, known.selling_days, known.recorded_days, known.avg_sell_price) == (15, 3, 3, 8.26)
    # A day without calendar row falls into the null week instead of being lost.
    assert weekly.agg(F.sum("total_weekly_sales")).first()[0] == 80
    assert rollups.monthly_sales(daily).agg(F.sum("total_monthly_sales")).first()[0] == 80


def test_rollup_counts_days_exactly_over_long_spans(spark):
    """Without calendar rows all days share one null period, far longer than one bitmap."""
    series = frames.one_series(spark, 500, skip=range(100, 150))
    doubled = series.unionByName(series.withColumn("sales", F.lit(0).cast("bigint")))
    empty = rollups.stg_calendar(frames.calendar(spark).limit(0))
    row = rollups.monthly_sales(rollups.daily_sales(doubled, empty)).first()
    assert (row.year, row.selling_days, row.recorded_days) == (None, 450, 450)


def test_weekly_splits_at_year_end(spark):
    days = [D(2010, 12, 31), D(2011, 1, 1)]
    fact = frames.fact(spark, [(day, "i", "d", "c", "s", "t", 1, 1.0) for day in days])
    cal = spark.createDataFrame(
        [(d.isoformat(), 7, "x", 1, d.month, d.year, f"d_{n}", None, None, None, None, 0, 0, 0) for n, d in enumerate(days)], frames.CALENDAR
    )
    assert rollups.weekly_sales(rollups.daily_sales(fact, rollups.stg_calendar(cal))).count() == 2


def test_mart_columns(spark):
    daily = rollups.daily_sales(frames.fact(spark), rollups.stg_calendar(frames.calendar(spark)))
    mart = rollups.mart_sales_forecasting(daily)
    assert len(mart.columns) == 24 and mart.columns[:4] == ["date", "sales_date", "item_id", "store_id"]


def test_top_series(spark):
    fact = frames.fact(spark).withColumn("sales", F.when(F.col("store_id") == "TX_1", 9).otherwise(F.col("sales")).cast("bigint"))
    assert {(r.store_id, r.item_id) for r in keep.top_k_series(fact, 2).collect()} == {("TX_1", "H1"), ("TX_1", "F1")}
    assert keep.top_series_filter(fact, 2).count() == 8
