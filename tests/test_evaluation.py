import math

import numpy as np
import pytest

from demandloom.operators import evaluation

DDL = "weekly_sales double, prediction double"


def metrics(spark, rows, **kw):
    return evaluation.forecast_metrics(spark.createDataFrame(rows, DDL), **kw).first()


def test_metrics_match_numpy(spark):
    rng = np.random.default_rng(2)
    y, p = rng.integers(1, 100, 300).astype(float), rng.normal(50, 20, 300)
    got = metrics(spark, list(zip(y.tolist(), p.tolist())))
    e = y - p
    expected = (
        np.sqrt((e**2).mean()), np.abs(e).mean(), (np.abs(e) / y).mean() * 100, 1 - (e**2).sum() / ((y - y.mean()) ** 2).sum()
    )
    assert (got.rmse, got.mae, got.mape, got.r2) == pytest.approx(expected, abs=1e-4)
    assert got.n_rows == 300


def test_perfect_forecast(spark):
    got = metrics(spark, [(1.0, 1.0), (2.0, 2.0)])
    assert (got.rmse, got.mae, got.mape, got.r2) == (0.0, 0.0, 0.0, 1.0)


def test_constant_target_has_no_r2(spark):
    assert math.isnan(metrics(spark, [(0.1, 1.0)] * 7).r2)


def test_zero_target_uses_the_floor(spark):
    assert metrics(spark, [(0.0, 1.0)]).mape == pytest.approx(1e8)


@pytest.mark.parametrize("missing", [None, float("nan")])
def test_missing_predictions(spark, missing):
    rows = [(1.0, 2.0), (3.0, missing)]
    kept = metrics(spark, rows)
    assert math.isnan(kept.rmse) and kept.n_rows == 2
    left_out = metrics(spark, rows, drop_missing=True)
    assert (left_out.rmse, left_out.n_rows) == (1.0, 1)


def test_several_models_at_once(spark):
    rows = [(1.0, 2.0), (3.0, None), (5.0, 5.0)]
    df = spark.createDataFrame(rows, DDL)
    got = {r.model: r for r in evaluation.metrics_by_model({"a": df, "b": df}, drop_missing=("a",)).collect()}
    alone = evaluation.forecast_metrics(df, model="a", drop_missing=True).first()
    assert got["a"] == alone and math.isnan(got["b"].rmse) and got["b"].n_rows == 3


def table(spark, rows):
    return spark.createDataFrame(rows, "model string, rmse double, mae double, mape double, r2 double, n_rows bigint")


def test_ranking_cuts_shared_ranks_and_orders_by_their_mean(spark):
    rows = [
        ("a", 1.0, 5.0, 3.0, 0.9, 1),
        ("b", 1.0, 4.0, 2.0, 0.9, 1),
        ("c", 2.0, 3.0, 1.0, 0.9, 1),
        ("d", 3.0, 6.0, 4.0, 0.1, 1),
    ]
    got = [tuple(r) for r in evaluation.rank_models(table(spark, rows)).orderBy("overall").collect()]
    # Two share ranks 1 and 2 -> 1.5 -> 1; three share 1, 2 and 3 -> 2.
    assert got == [
        (1, "b", 1, 2, 2, 2, 1.75),
        (2, "c", 3, 1, 1, 2, 1.75),
        (3, "a", 1, 3, 3, 2, 2.25),
        (4, "d", 4, 4, 4, 4, 4.0),
    ]


def test_comparison_sorts_and_excludes(spark):
    rows = [("x", 2.0, 1.0, 1.0, 0.0, 1), ("ARIMA", 9.0, 1.0, 1.0, 0.0, 1), ("y", 1.0, 1.0, 1.0, 0.0, 1)]
    assert [r.model for r in evaluation.compare_models(table(spark, rows)).collect()] == ["y", "x", "ARIMA"]
    assert [r.model for r in evaluation.compare_models(table(spark, rows), ["ARIMA"]).collect()] == ["y", "x"]
