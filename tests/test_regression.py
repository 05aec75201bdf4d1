import pytest
from pyspark.sql import functions as F

from demandloom.operators.regression import INPUTS, Regressor
from demandloom.plans.lake import build_gold
from demandloom.plans.training import train_and_compare
from demandloom.sources import read_metrics
from helpers import series


@pytest.fixture(scope="module")
def gold(spark):
    rows = [series(spark, [100 * s + 3 * n + (n * 7) % 13 for n in range(130)], store=s) for s in (1, 2)]
    return build_gold(rows[0].unionByName(rows[1]), 2013).cache()


def test_unfitted_model_raises(gold):
    for call in (lambda m: m.predict(gold), lambda m: m.save("unused")):
        with pytest.raises(RuntimeError, match="not fitted"):
            call(Regressor("LinearRegression"))


def test_linear_regression_fits_saves_and_loads(gold, tmp_path):
    model = Regressor("LinearRegression").fit(gold)
    assert model.training_fit()["r2"] > 0.95
    model.save(str(tmp_path / "m"))
    again = Regressor.load("LinearRegression", str(tmp_path / "m"))
    both = model.predict(gold).select("abs_week", "store", F.col("prediction").alias("a")).join(
        again.predict(gold).select("abs_week", "store", F.col("prediction").alias("b")), ["abs_week", "store"]
    )
    assert both.where("abs(a - b) > 1e-9").count() == 0 and both.count() == gold.count()


def test_importances_are_named_and_sorted(gold):
    model = Regressor("RandomForest", numTrees=5, maxDepth=4).fit(gold)
    rows = model.importances(gold).collect()
    assert len(rows) == len(INPUTS) - 2 + 2 + 1  # ten scalars, two stores, one item
    assert sum(r.importance for r in rows) == pytest.approx(1.0)
    assert [r.importance for r in rows] == sorted((r.importance for r in rows), reverse=True)
    assert {"lag_1_week", "rolling_4_week_avg"} <= {r.feature for r in rows}
    assert len(model.importances(gold, n=3).collect()) == 3


def test_training_stores_models_and_metrics(spark, gold, tmp_path):
    small = {"RandomForest": {"numTrees": 3, "maxDepth": 3}, "GradientBoosting": {"maxIter": 2, "maxDepth": 2}}
    table = train_and_compare(gold, str(tmp_path), 2014, 2015, settings=small).collect()
    assert {r.model for r in table} == {"LinearRegression", "RandomForest", "GradientBoosting", "ARIMA", "Seasonal"}
    assert [r.rmse for r in table] == sorted(r.rmse for r in table)
    assert read_metrics(spark, str(tmp_path / "metrics_csv")).count() == 5
    for name in ("ARIMA", "Seasonal"):
        assert spark.read.parquet(str(tmp_path / "models" / name)).count() == 2
    assert not spark.sparkContext._jsc.getPersistentRDDs().size() > 1  # the fixture's own cache
