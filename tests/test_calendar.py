import datetime

from pyspark.sql import functions as F

from demandloom.functions import iso_monday, season_month
from demandloom.operators.features import calendar_features
from demandloom.operators.weekly import to_weekly
from helpers import day, raw, tuples, weekly


def expected_monday(year, week):
    try:
        return datetime.date.fromisocalendar(year, week, 1)
    except ValueError:
        pass
    if week == 53:
        try:
            return datetime.date.fromisocalendar(year - 1, 53, 1)
        except ValueError:
            pass
    return datetime.date(year, 1, 1) + datetime.timedelta(weeks=week - 1)


def test_iso_monday_matches_the_calendar_for_every_week(spark):
    keys = [(y, w) for y in range(1995, 2031) for w in range(1, 54)]
    df = spark.createDataFrame(keys, "year int, week int")
    got = tuples(df.select("year", "week", iso_monday(F.col("year"), F.col("week"))))
    assert all(d == expected_monday(y, w) for y, w, d in got)


def test_week_53_dates(spark):
    df = spark.createDataFrame([(y,) for y in (2015, 2016, 2017, 2018)], "year int")
    got = [r[0] for r in df.orderBy("year").select(iso_monday(F.col("year"), F.lit(53))).collect()]
    assert got == [day(d) for d in ("2015-12-28", "2015-12-28", "2017-12-31", "2018-12-31")]


def test_days_at_year_edges_keep_their_calendar_year(spark):
    buckets = {
        "2013-12-31": (2013, 1),
        "2014-01-01": (2014, 1),
        "2014-12-31": (2014, 1),
        "2015-01-01": (2015, 1),
        "2016-01-01": (2016, 53),
        "2016-12-31": (2016, 52),
        "2017-01-01": (2017, 52),
        "2017-12-31": (2017, 52),
    }
    daily = raw(spark, [(d, 1, n, 1) for n, d in enumerate(buckets)]).withColumn("is_holiday", F.lit(0))
    got = {r.item: (r.year, r.week_of_year) for r in to_weekly(daily).collect()}
    assert [got[n] for n in range(len(buckets))] == list(buckets.values())


def test_five_years_of_days_make_262_weeks(spark):
    daily = spark.sql(
        "select explode(sequence(date'2013-01-01', date'2017-12-31')) as date, 1 as store, 1 as item,"
        " 1 as sales, 0 as is_holiday"
    )
    rows = to_weekly(daily)
    per_year = {r.year: r["count"] for r in rows.groupBy("year").count().collect()}
    assert per_year == {2013: 52, 2014: 52, 2015: 53, 2016: 53, 2017: 52}
    assert rows.where("weekly_sales <> 7").count() == 7


def test_calendar_features(spark):
    rows = calendar_features(weekly(spark, [(1, 1, 2016, w, 1) for w in (1, 14, 50, 51, 53)]), 2013)
    got = tuples(rows.orderBy("week_of_year").select("abs_week", "month", "quarter", "is_year_end"))
    assert got == [(160, 1, 1, 0), (173, 4, 2, 0), (209, 12, 4, 0), (210, 12, 4, 1), (212, 12, 4, 1)]


def test_season_month_runs_from_one_to_twelve(spark):
    df = spark.range(1, 54).select(F.col("id").cast("int").alias("w"))
    got = {r.w: r.m for r in df.select("w", season_month(F.col("w")).alias("m")).collect()}
    assert got == {w: min(12, max(1, (w - 1) * 12 // 52 + 1)) for w in range(1, 54)}
