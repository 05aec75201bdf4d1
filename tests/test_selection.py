import pytest

from demandloom.operators import selection
from helpers import PREDICTED_DDL, series, tuples

ROWS = [(1, 1, 2017, 1, 5.0), (1, 2, 2017, 2, 6.0), (2, 1, 2017, 3, 7.0), (2, 2, 2018, 3, 8.0)]


@pytest.fixture
def predicted(spark):
    return spark.createDataFrame(ROWS, PREDICTED_DDL)


@pytest.mark.parametrize(
    "filters, left",
    [
        ({}, 4),
        ({"year": 2017}, 3),
        ({"stores": []}, 4),
        ({"stores": [1]}, 2),
        ({"items": [2], "year": 2017}, 1),
        ({"weeks": (2, 3)}, 3),
        ({"year": 1900}, 0),
    ],
)
def test_filters(predicted, filters, left):
    assert selection.filter_predictions(predicted, **filters).count() == left


def test_filters_ignore_absent_columns(predicted):
    rows = predicted.drop("year", "week")
    assert selection.filter_predictions(rows, year=2017, weeks=(1, 1)).count() == 4


def test_split_is_disjoint_and_reported(spark):
    rows = series(spark, range(150), start=(2015, 1))
    train, test = selection.split_by_year(rows, 2016, 2017)
    assert (train.count(), test.count()) == (104, 46) and train.intersect(test).count() == 0
    assert tuple(selection.split_report(rows, 2016, 2017).first()) == (150, 104, 46, 69.3, 30.7)


def test_totals_and_options(predicted):
    assert tuples(selection.predicted_totals(predicted, "store")) == [(2, 15.0), (1, 11.0)]
    assert sorted(tuples(selection.predicted_by_week(predicted, "item"))) == [
        (1, 1, 5.0), (2, 2, 6.0), (3, 1, 7.0), (3, 2, 8.0)
    ]
    options = {}
    for name, value in tuples(selection.filter_options(predicted)):
        options.setdefault(name, []).append(value)
    assert options == {"item": [1, 2], "store": [1, 2], "week_max": [3], "week_min": [1], "year": [2017, 2018]}


def test_week_given_as_text(predicted):
    text = predicted.withColumn("week", predicted.week.cast("string"))
    assert dict(selection.predicted_by_week(text, "store").dtypes)["week"] == "int"
