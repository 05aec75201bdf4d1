from pyspark.sql import functions as F

from demandloom.operators import cleaning
from demandloom.operators.weekly import to_weekly
from demandloom.sources import holiday_dates
from helpers import day, holidays, raw, tuples

ROWS = [
    ("2013-01-01", 1, 1, 5),
    ("2013-01-01", 1, 1, 5),
    ("2013-01-01", 1, 1, 6),
    ("2013-01-02", 1, 1, -1),
    ("2013-01-03", 1, 1, None),
    ("2013-01-04", 1, 1, 0),
]


def test_only_equal_rows_are_repeats(spark):
    assert cleaning.drop_repeats(raw(spark, ROWS)).count() == 5


def test_null_and_negative_sales_are_left_out(spark):
    kept = cleaning.keep_nonnegative(raw(spark, ROWS))
    assert sorted(r.sales for r in kept.collect()) == [0, 5, 5, 6]


def test_date_guard_casts_text_and_leaves_dates(spark):
    text = spark.createDataFrame([("2013-05-06",), ("no date",)], "date string")
    assert [r.date for r in cleaning.ensure_date(text).collect()] == [day("2013-05-06"), None]
    dates = raw(spark, ROWS)
    assert cleaning.ensure_date(dates) is dates


def test_a_date_under_two_names_joins_once(spark):
    listed = spark.createDataFrame(
        [("2013-01-01", "New Year"), ("2013-01-01", "Another name"), ("bad", "x")], "Date string, Holiday string"
    )
    dates = holiday_dates(listed)
    assert tuples(dates) == [(day("2013-01-01"), 1)]
    daily = cleaning.flag_holidays(raw(spark, ROWS), dates)
    assert daily.count() == len(ROWS)
    assert {(str(r.date), r.is_holiday) for r in daily.collect()} >= {("2013-01-01", 1), ("2013-01-04", 0)}


def test_report_counts_every_step(spark):
    report = cleaning.cleaning_report(raw(spark, ROWS), holidays(spark, "2013-01-01")).first()
    assert tuple(report) == (6, 1, 2, 2, 3)


def test_report_on_no_rows(spark):
    report = cleaning.cleaning_report(raw(spark, []), holidays(spark, "2013-01-01")).first()
    assert tuple(report) == (0, 0, 0, 0, 0)


def test_weekly_totals_keep_the_daily_sum(spark):
    daily = cleaning.clean_daily(raw(spark, ROWS), holidays(spark, "2013-01-04"))
    weekly = to_weekly(daily)
    assert tuples(weekly) == [(1, 1, 2013, 1, 11, 1)]
    assert weekly.agg(F.sum("weekly_sales")).first() == daily.agg(F.sum("sales")).first()


def test_many_copies_of_one_row(spark):
    copies = spark.range(200_000).select(
        F.lit("2013-01-01").cast("date").alias("date"), F.lit(1).alias("store"), F.lit(1).alias("item"), F.lit(3).alias("sales")
    )
    report = cleaning.cleaning_report(copies, holidays(spark, "2013-01-01")).first()
    assert tuple(report) == (200_000, 199_999, 0, 1, 1)
