"""Small frames with known answers."""

import datetime as dt

from shelfline.schemas import CALENDAR, FACT, PRICES

D = dt.date


def calendar(spark):
    rows = [
        ("2011-01-29", 11101, "Saturday", 1, 1, 2011, "d_1", None, None, None, None, 0, 0, 0),
        ("2011-01-30", 11101, "Sunday", 2, 1, 2011, "d_2", None, None, None, None, 0, 0, 0),
        ("2011-01-31", 11101, "Monday", 3, 1, 2011, "d_3", None, None, None, None, 0, 0, 0),
    ]
    return spark.createDataFrame(rows, CALENDAR)


def broken_calendar(spark):
    rows = [
        ("2011-01-29", 11101, "Saturday", 1, 1, 2011, "d_1", None, None, None, None, 0, 0, 0),
        ("2011-01-30", 11101, None, 2, 1, 2011, "d_2", "Final", "Sporting", None, None, 0, 0, 0),
        ("invalid_date", 11101, "Monday", 3, 1, 2011, "d_3", "Odd", "InvalidType", None, None, 0, 0, 0),
        (None, 11101, "Tuesday", 4, 1, 2011, "d_4", None, None, None, None, 0, 0, 0),
    ]
    return spark.createDataFrame(rows, CALENDAR)


def wide(spark, rows=None):
    rows = rows or [
        ("H1_CA_1", "H1", "H", "HOBBIES", "CA_1", "CA", 0, 2, 1),
        ("F1_CA_1", "F1", "F", "FOODS", "CA_1", "CA", 5, 10, 0),
    ]
    days = ", ".join(f"d_{n + 1} int" for n in range(len(rows[0]) - 6))
    return spark.createDataFrame(rows, f"id string, item_id string, dept_id string, cat_id string, store_id string, state_id string, {days}")


def broken_wide(spark):
    return wide(spark, [("a", "H1", "H", "HOBBIES", "CA_1", "CA", 5, 10), ("b", "F1", "F", "FOODS", "CA_1", "CA", -2, None)])


def prices(spark):
    return spark.createDataFrame([("CA_1", "H1", 11101, 8.26), ("CA_1", "F1", 11101, 3.97)], PRICES)


def broken_prices(spark):
    rows = [("CA_1", "H1", 11101, 1.99), ("CA_1", "H1", 11101, -0.50), ("CA_1", "F1", 11101, 0.0)]
    return spark.createDataFrame(rows, PRICES)


def fact_rows():
    out = []
    for n in range(4):
        for item, dept, cat, price in (("H1", "H_1", "HOBBIES", 8.26), ("F1", "F_1", "FOODS", 3.50)):
            for store, state in (("CA_1", "CA"), ("TX_1", "TX")):
                out.append((D(2011, 1, 29) + dt.timedelta(n), item, dept, cat, store, state, 5, price))
    return out


def fact(spark, rows=None):
    return spark.createDataFrame(rows or fact_rows(), FACT)


def one_series(spark, days=40, skip=(), store="S", item="I"):
    rows = [
        (D(2021, 1, 1) + dt.timedelta(n), item, "D", "C", store, "ST", n + 1, 5.0) for n in range(days) if n not in skip
    ]
    return spark.createDataFrame(rows, FACT)
