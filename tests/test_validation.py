import pytest

from demandloom.operators import validation
from helpers import raw

LIMITS = {"stores": (1, 10), "items": (1, 50), "dates": ("2013-01-01", "2017-12-31")}
GOOD = [("2013-01-01", 1, 1, 5)] * 100


def verdict(spark, rows, expected=100):
    return validation.validation_report(raw(spark, rows), expected, **LIMITS)


def test_clean_rows_pass(spark):
    report = verdict(spark, GOOD)
    assert report.first()["passed"]
    assert validation.require_valid(report) is report


@pytest.mark.parametrize(
    "row, column",
    [
        (("2013-01-01", 1, 1, -5), "negative_sales"),
        (("2013-01-01", 0, 1, 5), "bad_store"),
        (("2013-01-01", 11, 1, 5), "bad_store"),
        (("2013-01-01", 1, 51, 5), "bad_item"),
        (("2012-12-31", 1, 1, 5), "bad_date"),
        (("2018-01-01", 1, 1, 5), "bad_date"),
        ((None, 1, 1, 5), "null_date"),
        (("2013-01-01", None, 1, 5), "null_store"),
        (("2013-01-01", 1, 1, None), "null_sales"),
    ],
)
def test_one_bad_row_fails(spark, row, column):
    report = verdict(spark, GOOD + [row])
    found = report.first()
    assert found[column] == 1 and not found["passed"]
    with pytest.raises(ValueError, match="validation failed"):
        validation.require_valid(report)


@pytest.mark.parametrize("rows, passed", [(96, True), (95, False), (104, True), (105, False)])
def test_row_count_lies_strictly_inside_the_tolerance(spark, rows, passed):
    assert verdict(spark, (GOOD * 2)[:rows]).first()["passed"] is passed


def test_no_rows_fail_without_an_error(spark):
    assert verdict(spark, []).first()["passed"] is False
    assert verdict(spark, [], expected=0).first()["passed"] is False
