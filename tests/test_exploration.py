import numpy as np
import pytest

from demandloom.operators import exploration, weekly as rollup
from helpers import holidays, raw, series, tuples, weekly
from demandloom.operators.cleaning import clean_daily


def test_histogram_counts_match_numpy(spark):
    values = [int(v) for v in np.random.default_rng(4).integers(0, 1000, 400)]
    got = exploration.histogram(series(spark, values, start=(1990, 1)), bins=10).orderBy("bin").collect()
    counts, edges = np.histogram(values, bins=10)
    assert [r.rows for r in got] == counts.tolist()
    assert [r.bin_start for r in got] == pytest.approx(edges[:-1].tolist())
    assert got[0].mean == pytest.approx(np.mean(values)) and got[0].median == np.median(values)


def test_histogram_lists_empty_bins_and_a_single_value(spark):
    got = exploration.histogram(series(spark, [0, 0, 100]), bins=4).orderBy("bin").collect()
    assert [r.rows for r in got] == [2, 0, 0, 1]
    assert sum(r.rows for r in exploration.histogram(series(spark, [5, 5]), bins=4).collect()) == 2


def test_summary(spark):
    row = exploration.weekly_summary(series(spark, [1, 2, 3, 10])).first()
    assert (row["count"], row["mean"], row["std"], row["min"], row["q1"], row["median"], row["q3"], row["max"]) == (
        4, 4.0, 4.08, 1.0, 1.75, 2.5, 4.75, 10.0,
    )
    assert row.null_cells == 0


def test_weekly_totals_number_the_weeks(spark):
    rows = series(spark, [1, 2, 3], start=(2013, 51)).unionByName(series(spark, [10, 20, 30], store=2, start=(2013, 51)))
    assert tuples(exploration.weekly_totals(rows)) == [(2013, 51, 11, 0), (2013, 52, 22, 1), (2014, 1, 33, 2)]
    assert tuples(exploration.first_week_places(rows)) == [(2013, 0), (2014, 2)]


def test_monthly_whiskers_leave_outliers_out(spark):
    got = exploration.monthly_boxes(weekly(spark, [(1, i, 2013, 1, v) for i, v in enumerate([10, 11, 12, 13, 14, 500])]))
    row = got.first()
    assert (row.month, row.q1, row.median, row.q3) == (1, 11.25, 12.5, 13.75)
    assert (row.whisker_low, row.whisker_high) == (10.0, 14.0)


def test_heat_sums_stores_then_averages_items(spark):
    rows = weekly(spark, [(1, 1, 2013, 1, 10), (2, 1, 2013, 1, 20), (1, 2, 2013, 1, 50)])
    heat = exploration.year_week_heat(rows)
    assert tuples(heat) == [(2013, 1, 40.0)]
    wide = exploration.pivot_weeks(heat, "year", "week_of_year").first()
    assert wide.w1 == 40.0 and wide.w2 is None and len(wide) == 54


def test_weekday_heat_counts_monday_as_zero(spark):
    daily = clean_daily(
        raw(spark, [("2013-01-07", 1, 1, 4), ("2013-01-07", 2, 1, 6), ("2013-01-13", 1, 1, 1)]), holidays(spark)
    )
    assert sorted(tuples(exploration.weekday_week_heat(daily))) == [(0, 2, 10.0), (6, 2, 1.0)]


def test_store_season_averages_averages(spark):
    rows = weekly(spark, [(1, 1, 2013, 1, 10), (1, 2, 2013, 1, 20), (1, 1, 2014, 1, 40)])
    assert tuples(exploration.store_season(rows)) == [(1, 1, 27.5)]


def test_top_and_bottom_items(spark):
    rows = weekly(spark, [(1, i, 2013, 1, v) for i, v in enumerate([5, 9, 9, 1, 7])])
    assert tuples(exploration.top_items(rows, 3)) == [(1, 9), (2, 9), (4, 7)]
    assert tuples(exploration.bottom_items(rows, 3)) == [(4, 7), (0, 5), (3, 1)]


def test_correlations_match_numpy(spark):
    rng = np.random.default_rng(6)
    data = rng.normal(size=(60, 3))
    data[:, 2] += data[:, 0]
    df = spark.createDataFrame([tuple(map(float, r)) for r in data], "a double, b double, c double")
    got = {(r.row, r.column): r.r for r in exploration.correlations(df, ("a", "b", "c")).collect()}
    full = np.corrcoef(data.T)
    names = "abc"
    assert set(got) == {(names[i], names[j]) for i in range(3) for j in range(i + 1)}
    assert all(got[names[i], names[j]] == pytest.approx(full[i, j]) for i in range(3) for j in range(i + 1))


@pytest.mark.parametrize("offset", [1e6, 1e8])
def test_correlations_of_large_means(spark, offset):
    rng = np.random.default_rng(9)
    data = rng.random((5000, 2))
    df = spark.createDataFrame([tuple(map(float, r)) for r in data + offset], "a double, b double").repartition(7)
    got = {(r.row, r.column): r.r for r in exploration.correlations(df, ("a", "b")).collect()}
    assert got["b", "a"] == pytest.approx(np.corrcoef(data.T)[0, 1], abs=1e-6) and got["a", "a"] == pytest.approx(1)


def test_correlation_of_a_constant_is_null(spark):
    df = spark.createDataFrame([(5.1, float(i)) for i in range(90)], "a double, b double").repartition(5)
    assert {(r.row, r.column): r.r for r in exploration.correlations(df, ("a", "b")).collect()} == {
        ("a", "a"): None, ("b", "a"): None, ("b", "b"): pytest.approx(1.0)
    }


def test_summary_of_layers(spark):
    daily = clean_daily(raw(spark, [("2013-01-07", 1, 1, 4), ("2013-01-08", 2, 1, 6)]), holidays(spark, "2013-01-07"))
    rows = rollup.to_weekly(daily)
    row = exploration.dataset_summary(daily, rows, rows.limit(0)).first()
    assert (row.stores, row["items"], row.daily_rows, row.weekly_rows, row.gold_rows) == (2, 1, 2, 2, 0)
    assert (row.avg_weekly_sales, row.max_weekly_sales, row.holiday_weeks, row.holiday_pct) == (5.0, 6, 1, 50.0)
    shapes = exploration.layer_shapes(daily=daily, weekly=rows)
    assert tuples(shapes) == [("daily", 2, 5), ("weekly", 2, 6)]


def test_describe(spark):
    row = rollup.describe_columns(series(spark, [1, 2, 3]), ["weekly_sales"]).first()
    assert tuple(row) == ("weekly_sales", 3, 2.0, 1.0, 1.0, 3.0)
