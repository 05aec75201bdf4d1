"""Forecast steps lined up with the test rows of each series."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..columns import SERIES, TARGET, WEEK_KEY

DEFAULT_HORIZON = 52


def keyed(rows):
    """Rows that belong to a series. Dropping the others on the training and on the
    test side alike also leaves both with one plan, so their shared input runs once."""
    return rows.where(F.col("store").isNotNull() & F.col("item").isNotNull())


def last_values(train):
    """Last observed value of each series; the model of the naive forecast."""
    return keyed(train).groupBy(*SERIES).agg(
        F.max_by(TARGET, F.struct("year", "week_of_year")).cast("double").alias("last_value"),
        F.count(F.lit(1)).alias("train_rows"),
    )


def test_lengths(train, test, default=DEFAULT_HORIZON):
    """Forecast horizon of each trained series: its number of test rows."""
    counted = keyed(test).groupBy(*SERIES).agg(F.count(F.lit(1)).alias("n"))
    return (
        keyed(train)
        .select(*SERIES)
        .dropDuplicates()
        .join(counted, list(SERIES), "left")
        .select(*SERIES, F.coalesce("n", F.lit(default).cast("bigint")).alias("test_len"))
    )


def with_step(test, *more):
    """Number the test rows of a series 1, 2, ... in time order; keeps the columns ``more``."""
    order = Window.partitionBy(*SERIES).orderBy("year", "week_of_year")
    return keyed(test).select(*WEEK_KEY, TARGET, *more).withColumn("h", F.row_number().over(order))


def align_forecast(test, models, forecast, horizon=None):
    """Forecast table: one row per test row, the h-th forecast on the h-th row.

    ``forecast`` is a Column over the model columns and the step ``h``. Rows past
    ``horizon`` and rows of series without a model get NaN.
    """
    nan = F.lit(float("nan"))
    known = F.coalesce(forecast, nan)
    prediction = known if horizon is None else F.when(F.col("h") <= horizon, known).otherwise(nan)
    return (
        with_step(test)
        .join(models, list(SERIES), "left")
        .select(*WEEK_KEY, F.col(TARGET).cast("double").alias(TARGET), prediction.alias("prediction"))
    )


def last_value_forecast(train, test, horizon=None):
    return align_forecast(test, last_values(train), F.col("last_value"), horizon)
