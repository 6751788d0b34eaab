"""Readers, writers and the end-to-end jobs on small inputs."""

import time
import uuid

import pytest
from pyspark.sql import functions as F

from pyspark.errors import AnalysisException

import frames
from shelfline.operators import joins, rollups
from shelfline.plans import jobs, layers as layers_plan
from shelfline.plans.layers import materialize_layers
from shelfline.session import scratch_path, settings
from shelfline.sources import files, tables


@pytest.fixture()
def dataset(spark):
    name = f"shelf_test_{uuid.uuid4().hex[:8]}"
    tables.create_dataset(spark, name, scratch_path(spark, name))
    return name


def small_sources(spark, days=70):
    import datetime as dt

    start = dt.date(2011, 1, 29)
    cal = [
        ((start + dt.timedelta(n)).isoformat(), 11101 + n // 7, "x", n % 7 + 1, (start + dt.timedelta(n)).month, (start + dt.timedelta(n)).year,
         f"d_{n + 1}", None, None, None, None, 0, 0, 0)
        for n in range(days)
    ]
    wide = [(f"{i}_{s}", i, i[0], "FOODS", s, s[:2], *[(n * k) % 9 for n in range(days)]) for k, (i, s) in enumerate([("A1", "CA_1"), ("B1", "CA_1"), ("A1", "TX_1")], 1)]
    prices = [(s, i, 11101 + w, 2.0 + w) for i, s in (("A1", "CA_1"), ("B1", "CA_1"), ("A1", "TX_1")) for w in range(days // 7)]
    return {"calendar": spark.createDataFrame(cal, frames.CALENDAR), "sales": frames.wide(spark, wide), "prices": spark.createDataFrame(prices, frames.PRICES)}


def test_csv_round_trip(spark):
    base = scratch_path(spark, "csv")
    files.export_csv(frames.calendar(spark), f"{base}/calendar.csv")
    files.export_csv(frames.wide(spark), f"{base}/sales_train_validation.csv")
    files.export_csv(frames.prices(spark), f"{base}/sell_prices.csv")
    got = files.load_sources(spark, base)
    assert {k: v.count() for k, v in got.items()} == {"calendar": 3, "sales": 2, "prices": 2}
    assert dict(got["sales"].dtypes)["d_2"] == "bigint"
    assert sorted(map(tuple, got["sales"].collect())) == sorted(map(tuple, frames.wide(spark).collect()))


def test_bad_cells_are_kept_visible(spark):
    path = scratch_path(spark, "bad")
    spark.createDataFrame([("store_id,item_id,wm_yr_wk,sell_price",), ("s,i,1,2.5",), ("s,j,x,3.5",)], "value string").coalesce(1).write.text(path)
    rows = {r.item_id: r for r in files.scan_prices(spark, path, keep_bad_rows=True).cache().collect()}
    assert rows["j"].wm_yr_wk is None and rows["j"]._corrupt_record == "s,j,x,3.5"
    assert rows["i"]._corrupt_record is None


def text_file(spark, *lines):
    path = scratch_path(spark, "text")
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    return path


def test_columns_are_found_by_name(spark):
    prices = files.scan_prices(spark, text_file(spark, "item_id,note,store_id,sell_price,wm_yr_wk", "i,n,s,2.5,7")).first()
    assert (prices.store_id, prices.item_id, prices.wm_yr_wk, prices.sell_price) == ("s", "i", 7, 2.5) and len(prices) == 4
    wide = files.scan_sales_wide(spark, text_file(spark, "d_1,d_2,item_id,id,dept_id,cat_id,store_id,state_id,d_3", "3.0,5000000000,i,x,d,c,s,t,bad")).first()
    assert (wide.item_id, wide.store_id, wide.d_1, wide.d_2, wide.d_3) == ("i", "s", 3, 5_000_000_000, None)
    with pytest.raises(ValueError):
        files.scan_prices(spark, text_file(spark, "item_id,wm_yr_wk,sell_price", "i,1,2"))


def test_broken_input_is_reported(spark, dataset):
    sources = small_sources(spark)
    sources["sales"] = sources["sales"].withColumn("d_1", F.raise_error(F.lit("broken")).cast("int"))
    del sources["prices"]
    report = tables.ingest_all(spark, sources, dataset)
    assert {r.table_name: r.success for r in report.collect()} == {tables.RAW_CALENDAR: True, tables.RAW_SALES: False, tables.RAW_PRICES: False}
    assert tables.ingest_summary(report).first().overall_status == "FAILURE"
    with pytest.raises(ValueError):
        jobs.job_etl(spark, sources, dataset)


def test_datasets_stay_apart(spark, dataset):
    other = f"{dataset}_b"
    tables.create_dataset(spark, other, scratch_path(spark, other))
    sources = small_sources(spark)
    tables.ingest_all(spark, sources, dataset)
    tables.ingest_all(spark, {**sources, "sales": sources["sales"].limit(0)}, other)
    assert spark.table(f"{dataset}.{tables.RAW_SALES_ALIAS}").count() == 3
    with pytest.raises(ValueError):
        jobs.job_transform(spark, other)


def test_only_absence_is_skipped(spark, dataset):
    tables.write_table(spark.range(3), f"{dataset}.t")
    with pytest.raises(AnalysisException):
        tables.first_non_empty([lambda: spark.table(f"{dataset}.t").select("no_such_column"), lambda: spark.range(1)])
    mart = tables.scan_serving(spark, dataset)[tables.MART]
    assert len(mart.columns) == 24 and joins.attach_category(spark.createDataFrame([], "item_id string, store_id string"), mart).isEmpty()


def test_tables(spark, dataset):
    name = f"{dataset}.t"
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, val string")
    tables.write_table(df, name)
    tables.write_table(df, name, mode="append")
    found = tables.verify_table(spark, name, sample_limit=3)
    assert found["exists"] and found["row_count"] == 4 and found["columns"] == ["id", "val"] and found["sample"].count() == 3
    tables.write_table(df, name)
    assert spark.table(name).count() == 2
    assert not tables.verify_table(spark, f"{dataset}.none")["exists"]
    assert tables.first_table(spark, [f"{dataset}.none", name]).count() == 2
    with pytest.raises(ValueError):
        tables.first_table(spark, [f"{dataset}.none"])
    assert tables.scan_table(spark, f"SELECT count(*) AS n FROM {name}").first().n == 2
    empty = tables.scan_serving(spark, dataset)
    assert all(frame.isEmpty() for frame in empty.values()) and len(empty) == 4


def test_partitioned_table_is_rebalanced(spark, dataset):
    df = spark.range(1000).select((F.col("id") % 3).alias("year"), "id")
    tables.write_table(df, f"{dataset}.p", partition_by=["year"], sort_by=["id"])
    assert spark.table(f"{dataset}.p").filter("year = 1").count() == 333


def test_etl(spark, dataset):
    report = scratch_path(spark, "report")
    sources = small_sources(spark)
    result = jobs.job_etl(spark, sources, dataset)
    assert result["status"] == "PASS" and result["validation"]["status"] == "PASS"
    fact = spark.table(f"{dataset}.{tables.FACT_TABLE}")
    assert fact.count() == 210
    metrics = result["transform"]["metrics"].first()
    assert metrics.sales_match and metrics.missing_prices == 0
    assert tables.ingest_summary(result["ingestion"]).first().overall_status == "SUCCESS"
    assert set(result["quality"]["verification"]) == {tables.CLEAN_CALENDAR, tables.CLEAN_SALES, tables.CLEAN_PRICES}
    jobs.job_quality(spark, dataset, report_path=f"{report}/quality")
    assert spark.read.text(f"{report}/quality").count() == 23
    jobs.job_validate(spark, dataset, report_path=f"{report}/validation")
    assert spark.read.text(f"{report}/validation").filter(F.col("value").contains("overall_status")).count() == 1
    assert jobs.job_prepare(spark, dataset, max_items=2).count() == 140


def test_everything(spark, dataset):
    result = jobs.job_all(spark, small_sources(spark), dataset, trees=3)
    assert result["status"] == "PASS"
    assert result["assertions"].count() > 40 and result["assertions"].filter("violations > 0").isEmpty()
    assert result["forecast"]["forecast"].count() == 90
    assert {r.model for r in result["forecast"]["metrics"].collect()} == {"additive", "boosted"}
    assert result["recommendations"].count() == 3
    assert spark.table(f"{dataset}.fct_weekly_sales").agg(F.sum("total_weekly_sales")).first()[0] == spark.table(
        f"{dataset}.fct_daily_sales"
    ).agg(F.sum("sales")).first()[0]
    # The winner can be either model; the other path works on the same tables.
    mart = spark.table(f"{dataset}.{tables.MART}")
    filled, featured, train, validation = jobs.forecast_frames(mart)
    assert filled.count() == 210 and featured.count() == 126 and validation.count() == 84


def test_layers_are_stored_by_year(spark, dataset):
    layers = materialize_layers(spark, frames.fact(spark), frames.calendar(spark), dataset)
    assert layers.int_weekly_sales.count() == spark.table(f"{dataset}.fct_weekly_sales").count()
    assert "year" in [c.name for c in spark.catalog.listColumns(f"{dataset}.fct_daily_sales") if c.isPartition]


def test_whole_numbers_with_decimals_keep_their_value(spark):
    header = "date,wm_yr_wk,weekday,wday,month,year,d,event_name_1,event_type_1,event_name_2,event_type_2,snap_CA,snap_TX,snap_WI"
    path = text_file(spark, header, "2011-01-29,11101.0,Saturday,1,1.5,2011.0,d_1,,,,,0,x,1")
    row = files.scan_calendar(spark, path).first()
    assert (row.year, row.wm_yr_wk, row.wday, row.month, row.snap_TX, row.snap_WI) == (2011, 11101, 1, None, None, 1)


def test_narrowest_types_and_rejects(spark):
    path = text_file(spark, "item_id,store_id,wm_yr_wk,sell_price", "i,s,7.0,2.5", "i,s,8,", "j,s,x,3", "k,s,9,NaN")
    rows, rejects = files.scan_widened(spark, path, frames.PRICES)
    assert dict(rows.dtypes) == {"store_id": "string", "item_id": "string", "wm_yr_wk": "bigint", "sell_price": "double"}
    assert {(r.item_id, r.wm_yr_wk, r.sell_price) for r in rows.collect()} == {("i", 7, 2.5), ("i", 8, None)}
    assert {(r.item_id, r.wm_yr_wk, r.reason) for r in rejects.collect()} == {("j", "x", "wm_yr_wk"), ("k", "9", "sell_price")}
    wider, none = files.scan_widened(spark, text_file(spark, "item_id,store_id,wm_yr_wk,sell_price", "i,s,7.5,1", "i,s,8,1"), frames.PRICES)
    assert dict(wider.dtypes)["wm_yr_wk"] == "double" and none.isEmpty()


def test_failed_replacement_leaves_the_old_table(spark, dataset, monkeypatch):
    name = f"{dataset}.kept"
    tables.write_table(spark.range(5), name)
    with pytest.raises(Exception, match="broken"):
        tables.write_table(spark.range(9).select(F.when(F.col("id") == 8, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).alias("id")), name)
    assert spark.table(name).count() == 5
    with monkeypatch.context() as patch:  # a staged table that lost rows is not published
        save = tables._save
        patch.setattr(tables, "_save", lambda df, *rest: save(df.limit(3), *rest))
        with pytest.raises(tables.UnverifiedTable):
            tables.write_table(spark.range(9), name)
    assert spark.table(name).count() == 5
    tables.write_table(spark.table(name).where("id < 4"), name)  # reads what it replaces
    assert spark.table(name).count() == 4
    assert {t.name for t in spark.catalog.listTables(dataset) if not t.isTemporary} == {"kept"}


def test_views_of_layers_belong_to_their_dataset(spark, dataset):
    other = f"{dataset}_v"
    tables.create_dataset(spark, other, scratch_path(spark, other))
    materialize_layers(spark, frames.fact(spark), frames.calendar(spark), dataset)
    materialize_layers(spark, frames.fact(spark).limit(0), frames.calendar(spark), other)
    assert spark.table(f"{dataset}.int_daily_sales").count() == 16 and spark.table(f"{other}.int_daily_sales").count() == 0
    assert spark.table(f"{dataset}.int_weekly_sales").columns == rollups.weekly_sales(spark.table(f"{dataset}.int_daily_sales")).columns


def test_layers_group_their_rows_in_buckets(spark, dataset, monkeypatch):
    monkeypatch.setattr(layers_plan, "ROWS_PER_BUCKET", 5)
    undated = [(frames.D(2012, 1 + n % 12, 5), f"N{n % 3}" if n % 5 else None, "N_1", "HOBBIES", "CA_1", "CA", n, 1.5) for n in range(24)]
    fact, calendar = frames.fact(spark, frames.fact_rows() + undated), frames.calendar(spark)
    made = materialize_layers(spark, fact, calendar, dataset)
    plain = layers_plan.build_layers(fact, calendar)
    for name in ("int_daily_sales", "int_weekly_sales", "int_monthly_sales", "mart_sales_forecasting"):
        kept, wanted = getattr(made, name), getattr(plain, name)
        assert kept.columns == wanted.columns and wanted.count() == kept.count() > 0
        assert kept.exceptAll(wanted).isEmpty()
    details = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {dataset}.fct_daily_sales").collect()}
    assert details["Num Buckets"] == "8"  # 40 rows


def test_models_of_a_bucketed_table_need_no_shuffle(spark, dataset):
    materialize_layers(spark, frames.fact(spark).where("date < '2011-02-01'"), frames.calendar(spark), dataset)
    with settings(spark, layers_plan.BY_BUCKET):
        for model in (rollups.weekly_sales, rollups.monthly_sales):
            df = model(spark.table(f"{dataset}.int_daily_sales"), together=True)
            assert df.count() > 0 and len(df.collect()) > 0
            ran = df._jdf.queryExecution().executedPlan().toString().partition("Initial Plan")[0]
            assert "SortAggregate" in ran and "FileScan" in ran and "Exchange" not in ran
    assert spark.conf.get("spark.sql.sources.bucketing.autoBucketedScan.enabled") == "true"


def test_a_write_leaves_no_shuffle_files(spark, dataset):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        files = blocks.getAllFiles()
        names = [files.apply(n).getName() for n in range(files.size())]
        return {name for name in names if name.startswith("shuffle_")}

    before = shuffled()
    tables.write_table(spark.range(1000).selectExpr("id", "id % 3 AS year"), f"{dataset}.p", partition_by=["year"], sort_by=["id"])
    until = time.time() + 20
    while shuffled() - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffled() - before and spark.table(f"{dataset}.p").count() == 1000
