import numpy as np
import pytest
from pyspark.sql import functions as F

from demandloom.operators import monitoring
from demandloom.plans.monitoring import check_forecaster
from helpers import PREDICTED_DDL, tuples, weekly

METRICS_DDL = "model string, rmse double"


def drift(spark, current, stored):
    return monitoring.performance_drift(
        spark.createDataFrame(current, METRICS_DDL), spark.createDataFrame(stored, METRICS_DDL)
    )


@pytest.mark.parametrize("rmse, expected", [(11.0, False), (11.1, True), (5.0, False)])
def test_drift_is_strictly_above_ten_percent(spark, rmse, expected):
    assert drift(spark, [("m", rmse)], [("m", 10.0)]).first().drift_detected is expected


def test_unknown_model_does_not_drift(spark):
    row = drift(spark, [("new", 99.0)], [("m", 10.0)]).first()
    assert row.baseline_rmse is None and row.drift_detected is False


@pytest.mark.parametrize("nulls, alert", [(1, False), (2, True)])
def test_null_share_is_strictly_above_one_percent(spark, nulls, alert):
    rows = [(None if i < nulls else i, "x") for i in range(100)]
    got = monitoring.missing_data_alert(spark.createDataFrame(rows, "a int, b string"))
    assert {r.column: r.alert for r in got.collect()} == {"a": alert, "b": False}


def test_missing_data_of_no_rows(spark):
    got = monitoring.missing_data_alert(spark.createDataFrame([], "a int"))
    assert [r.alert for r in got.collect()] == [False]


def predictions(spark, rows):
    return spark.createDataFrame(rows, PREDICTED_DDL)


def test_only_matching_weeks_count(spark):
    actual = weekly(spark, [(1, 1, 2017, 1, 10), (1, 1, 2017, 2, 20), (2, 1, 2017, 1, 5)])
    got = monitoring.ground_truth_errors(
        predictions(spark, [(1, 1, 2017, 1, 13.0), (1, 1, 2017, 2, 16.0), (9, 1, 2017, 1, 0.0)]), actual
    ).first()
    assert (got.rmse, got.mae, got.matched_rows) == (pytest.approx(np.sqrt(12.5)), 3.5, 2)


def test_check_logs_matched_rounds_only(spark, tmp_path):
    log = str(tmp_path / "log")
    actual = weekly(spark, [(1, 1, 2017, 1, 10)])
    stored = spark.createDataFrame([("m", 1.0)], METRICS_DDL)
    upload = spark.createDataFrame([(1, None), (2, 3)], "a int, b int")
    hit = predictions(spark, [(1, 1, 2017, 1, 12.0)])
    miss = predictions(spark, [(5, 5, 2017, 1, 12.0)])

    row = check_forecaster("m", hit, actual, stored, upload, log).first()
    assert (row.rmse, row.drift_detected, row.missing_data) == (2.0, True, True)
    empty = check_forecaster("m", miss, actual, stored, upload, log).first()
    assert (empty.rmse, empty.drift_detected, empty.matched_rows) == (None, False, 0)
    check_forecaster("m", hit, actual, stored, upload, log)

    logged = spark.read.parquet(log)
    assert logged.columns == ["timestamp", "model", "rmse", "mae", "drift_detected"]
    assert tuples(logged.select("model", "rmse", "mae", "drift_detected")) == [("m", 2.0, 2.0, True)] * 2


def ks(spark, a, b):
    rows = [(int(v), True) for v in a] + [(int(v), False) for v in b]
    df = spark.createDataFrame(rows, "weekly_sales bigint, old boolean")
    return monitoring.distribution_drift(df, F.col("old"), ~F.col("old")).first()


def test_distribution_drift_matches_brute_force(spark):
    rng = np.random.default_rng(8)
    a, b = rng.integers(0, 3_000_000, 400), rng.integers(200_000, 3_400_000, 300)
    grid = np.concatenate([a, b])
    expected = max(abs((a <= x).mean() - (b <= x).mean()) for x in grid)
    got = ks(spark, a, b)
    assert got.statistic == pytest.approx(expected)
    assert (got.reference_rows, got.current_rows) == (400, 300)


def test_equal_and_disjoint_samples(spark):
    same = ks(spark, range(50), range(50))
    assert (same.statistic, same.p_value) == (0.0, 1.0)
    apart = ks(spark, range(50), range(1000, 1050))
    assert apart.statistic == 1.0 and apart.p_value < 1e-9
