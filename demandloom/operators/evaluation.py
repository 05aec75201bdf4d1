"""Forecast errors and model comparison."""

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..columns import TARGET

EPSILON = 1e-6


def _pair(label, prediction):
    """Actual and predicted value as doubles, a missing one as NaN."""
    nan = F.lit(float("nan"))
    return (
        F.coalesce(F.col(label).cast("double"), nan).alias("_y"),
        F.coalesce(F.col(prediction).cast("double"), nan).alias("_p"),
    )


def _errors(grouped, digits):
    """rmse, mae, mape, r2 and row count of grouped pairs, in one aggregation."""
    y, error = F.col("_y"), F.col("_y") - F.col("_p")
    mse, spread = F.avg(error * error), F.var_pop(y)
    r2 = F.when(spread > 0, 1 - mse / spread).otherwise(F.lit(float("nan")))
    return grouped.agg(
        F.round(F.sqrt(mse), digits).alias("rmse"),
        F.round(F.avg(F.abs(error)), digits).alias("mae"),
        F.round(F.avg(F.abs(error) / F.greatest(F.abs(y), F.lit(EPSILON))) * 100, digits).alias("mape"),
        F.round(r2, digits).alias("r2"),
        F.count(F.lit(1)).alias("n_rows"),
    )


def _complete():
    return ~F.isnan("_y") & ~F.isnan("_p")


def forecast_metrics(
    forecasts, label=TARGET, prediction="prediction", model="model", drop_missing=False, digits=4
):
    """Metric row of one forecast table.

    A missing value makes the errors NaN unless ``drop_missing`` leaves its row out.
    R² is NaN where the actual values do not vary.
    """
    pairs = forecasts.select(*_pair(label, prediction))
    if drop_missing:
        pairs = pairs.where(_complete())
    return _errors(pairs.groupBy(), digits).select(F.lit(model).alias("model"), "*")


def metrics_by_model(forecasts, drop_missing=(), label=TARGET, prediction="prediction", digits=4):
    """Metric rows of several forecast tables, given by model name, in one
    aggregation. Models in ``drop_missing`` leave incomplete rows out."""
    pairs = [
        rows.select(F.lit(name).alias("model"), *_pair(label, prediction), F.lit(name in drop_missing).alias("_drop"))
        for name, rows in forecasts.items()
    ]
    kept = union_all(pairs).where(~F.col("_drop") | _complete())
    return _errors(kept.groupBy("model"), digits)


def metrics_side_by_side(rows, predictions, drop_missing=(), label=TARGET, digits=4):
    """Metric rows of several predictions on the same rows, given as columns by model name."""
    nan = F.lit(float("nan"))
    cells = F.array(
        *[
            F.struct(
                F.lit(name).alias("model"),
                F.coalesce(value.cast("double"), nan).alias("_p"),
                F.lit(name in drop_missing).alias("_drop"),
            )
            for name, value in predictions.items()
        ]
    )
    pairs = rows.select(F.coalesce(F.col(label).cast("double"), nan).alias("_y"), F.inline(cells))
    return _errors(pairs.where(~F.col("_drop") | _complete()).groupBy("model"), digits)


def union_all(frames):
    return reduce(lambda a, b: a.unionByName(b), frames)


def compare_models(metrics, exclude=()):
    """Metric rows from lowest to highest rmse, optionally without some models."""
    kept = metrics.where(~F.col("model").isin(list(exclude))) if exclude else metrics
    return kept.orderBy("rmse", "model")


def rank_models(metrics):
    """Rank of each model per metric, their mean and the overall position.

    Ties share their average rank, cut to a whole number. The input has one row per
    model, so the windows stay small.
    """

    def rank(column, descending=False):
        order = F.desc(column) if descending else F.asc(column)
        shared = F.count(F.lit(1)).over(Window.partitionBy(column))
        return F.floor(F.rank().over(Window.orderBy(order)) + (shared - 1) / 2).cast("int")

    ranks = ["rmse_rank", "mae_rank", "mape_rank", "r2_rank"]
    ranked = metrics.select(
        "model",
        rank("rmse").alias("rmse_rank"),
        rank("mae").alias("mae_rank"),
        rank("mape").alias("mape_rank"),
        rank("r2", descending=True).alias("r2_rank"),
    ).withColumn("avg_rank", sum(F.col(c) for c in ranks) / 4)
    position = F.row_number().over(Window.orderBy("avg_rank", "model"))
    return ranked.select(position.alias("overall"), "model", *ranks, "avg_rank")
