"""Small frames for the tests."""

import datetime

from demandloom.columns import RAW_SCHEMA

WEEKLY_DDL = (
    "store int, item int, year int, week_of_year int, weekly_sales bigint, week_has_holiday int"
)
PREDICTED_DDL = "store int, item int, year int, week int, sales_prediction double"


def day(text):
    return datetime.date.fromisoformat(text)


def raw(spark, rows):
    return spark.createDataFrame(
        [(day(d) if d else None, s, i, n) for d, s, i, n in rows], RAW_SCHEMA
    )


def holidays(spark, *dates):
    return spark.createDataFrame([(day(d), 1) for d in dates], "holiday_date date, is_holiday int")


def weekly(spark, rows):
    return spark.createDataFrame([(*r, 0) if len(r) == 5 else r for r in rows], WEEKLY_DDL)


def series(spark, values, store=1, item=1, start=(2013, 1), skip=()):
    """One series of consecutive weeks, 52 a year, from a list of values."""
    year, week = start
    rows = []
    for n, v in enumerate(values):
        y, w = year + (week - 1 + n) // 52, (week - 1 + n) % 52 + 1
        if n not in skip:
            rows.append((store, item, y, w, v))
    return weekly(spark, rows)


def tuples(df):
    return [tuple(r) for r in df.collect()]
