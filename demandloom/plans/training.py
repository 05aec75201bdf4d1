"""Train every forecaster on one split and compare them."""

import json

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from ..columns import GOLD_SCALARS, TEST_YEAR, TRAIN_UNTIL
from ..operators import arima, arima_exact, seasonal
from ..operators.evaluation import compare_models, metrics_by_model
from ..operators.regression import DEFAULTS, ESTIMATORS, Regressor
from ..operators.selection import split_by_year
from ..sources.writers import write_metrics, write_plain

TREES = ("RandomForest", "GradientBoosting")
PER_SERIES = {"ARIMA": (arima, arima_exact.fit_exact), "Seasonal": (seasonal, seasonal.fit_seasonal)}


def _finished(spark, path, made_of):
    """The stored metrics row of a model of these settings, or None."""
    try:
        row = spark.read.parquet(path)
        return row.drop("made_of") if row.where(F.col("made_of") == made_of).count() else None
    except AnalysisException:
        return None


def train_and_compare(gold, root, train_until=TRAIN_UNTIL, test_year=TEST_YEAR, settings=None, resume=False):
    """Fit all five forecasters, save them and their metrics below ``root`` and
    return the stored metric table, lowest rmse first.

    ARIMA is fitted by exact likelihood. Tree models are stored as node tables too, which
    ``scoring.score_by_nodes`` reads without MLlib.
    ``settings`` overrides regressor parameters by model name. A model is complete when its
    own metrics row is stored. With ``resume``, complete models of the same settings and years
    are taken as they are, so a run that failed goes on with the model that failed; give it only
    for unchanged gold rows.
    """
    spark, settings = gold.sparkSession, settings or {}
    # The regressors learn their encoder from the training years and are stored with it.
    # The cache only spares reading: a lost block is read from the gold table again.
    train, test = (
        part.persist(StorageLevel.MEMORY_AND_DISK)
        for part in split_by_year(gold.select(*GOLD_SCALARS), train_until, test_year)
    )

    def forecast(name):
        if name in ESTIMATORS:
            model = Regressor(name, **settings.get(name, {})).fit(train)
            model.save(f"{root}/models/{name}")
            if name in TREES:
                write_plain(model.nodes(train), f"{root}/nodes/{name}")
            return model.predict(test)
        # Fitted once: the forecasts come from the stored coefficients.
        module, fit = PER_SERIES[name]
        write_plain(fit(train), f"{root}/models/{name}")
        return module.forecast_from(spark.read.parquet(f"{root}/models/{name}"), test)

    try:
        rows = []
        for name in (*ESTIMATORS, *PER_SERIES):
            path = f"{root}/metrics_of/{name}"
            made_of = json.dumps([DEFAULTS.get(name, {}) | settings.get(name, {}), train_until, test_year], sort_keys=True)
            done = _finished(spark, path, made_of) if resume else None
            if done is None:
                found = metrics_by_model({name: forecast(name)}, drop_missing=tuple(PER_SERIES))
                found.withColumn("made_of", F.lit(made_of)).write.mode("overwrite").parquet(path)
                done = spark.read.parquet(path).drop("made_of")
            rows.append(done)
        metrics = rows[0]
        for row in rows[1:]:
            metrics = metrics.unionByName(row)
        write_metrics(metrics, f"{root}/metrics_csv", f"{root}/metrics")
    finally:
        train.unpersist()
        test.unpersist()
    return compare_models(spark.read.parquet(f"{root}/metrics"))
