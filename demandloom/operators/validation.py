"""Data quality checks over raw daily rows, each a single aggregation pass."""

from pyspark.sql import functions as F

from ..columns import DATES, EXPECTED_ROWS, ITEMS, STORES


def _violations(condition):
    # A plain sum stays null on empty input, which the verdict counts as failing.
    return F.sum(condition.cast("bigint"))


def _null_counts(columns):
    return [_violations(F.col(c).isNull()).alias(f"null_{c}") for c in columns]


def _range_counts(stores, items, dates):
    def outside(column, bounds):
        low, high = bounds
        return (F.col(column) < low) | (F.col(column) > high)

    days = tuple(F.lit(d).cast("date") for d in dates)
    checks = {
        "negative_sales": F.col("sales") < 0,
        "bad_store": outside("store", stores),
        "bad_item": outside("item", items),
        "bad_date": outside("date", days),
    }
    return [_violations(cond).alias(name) for name, cond in checks.items()]


def null_profile(df):
    return df.agg(*_null_counts(df.columns))


def range_violations(df, stores=STORES, items=ITEMS, dates=DATES):
    return df.agg(*_range_counts(stores, items, dates))


def validation_report(
    df, expected_rows=EXPECTED_ROWS, stores=STORES, items=ITEMS, dates=DATES, tolerance=0.05
):
    """Row count, null and range counts and the verdict on them, as one row.

    ``expected_rows`` is a number or a scalar Column. The row count must lie strictly
    inside the tolerance; empty input never passes.
    """
    nulls = [f"null_{c}" for c in df.columns]
    broken = ["negative_sales", "bad_store", "bad_item", "bad_date"]
    report = df.agg(
        F.count(F.lit(1)).alias("row_count"),
        *_null_counts(df.columns),
        *_range_counts(stores, items, dates),
    )
    return with_verdict(report, expected_rows, tolerance, nulls + broken)


def with_verdict(report, expected_rows, tolerance, counts):
    """Add ``passed``: the row count is near the expected one and all ``counts`` are 0."""
    expected = F.lit(expected_rows) if isinstance(expected_rows, (int, float)) else expected_rows
    # A column of its own, so that a subquery behind it runs once.
    report = report.withColumn("_expected", expected)
    passed = F.try_divide(F.abs(F.col("row_count") - F.col("_expected")), F.col("_expected")) < tolerance
    for name in counts:
        passed = passed & (F.col(name) == 0)
    return report.withColumn("passed", F.coalesce(passed, F.lit(False))).drop("_expected")


def require_valid(report):
    """Raise if the one-row report did not pass; otherwise hand it on."""
    row = report.first()
    if not row["passed"]:
        raise ValueError(f"data validation failed: {row.asDict()}")
    return report
