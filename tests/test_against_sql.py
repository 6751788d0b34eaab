"""Registered queries against their SQL counterparts on the smallest supplied tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import catalog  # noqa: E402
import compare  # noqa: E402

# Long runs that repeat operators checked here on their own, or fit all 150 trees; the compare tool covers them.
SLOW = {"boosted_fit_predict_rows", "recursive_forecast_rows", "job_quality", "validation_report_faulty", "dq_audit", "job_transform", "job_validate", "job_prepare", "job_etl", "scan_sales_wide", "validate_transform", "validation_report", "check_not_null", "ingest_all", "ingest_summary"}
TEXTS = catalog.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return compare.connect(sf_dir)


@pytest.mark.parametrize("name", [n for n in catalog.queries() if n in TEXTS and n not in SLOW])
def test_same_rows(spark, sf_dir, duck, name):
    names, rows, types = compare.spark_rows(catalog.queries()[name](spark, sf_dir))
    duck_names, duck_rows, duck_types = compare.duck_rows(duck, TEXTS[name])
    assert names == duck_names
    assert rows == duck_rows
    assert not compare.same_types(types, duck_types)
