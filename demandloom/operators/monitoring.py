"""Checks of a deployed forecaster against new data."""

from pyspark.sql import functions as F

from ..columns import SERIES, TARGET
from ..functions import running_shares

#: Size of a stored quantile sketch, and points at which two of them are compared.
SKETCH_K = 1600
SKETCH_POINTS = 400
DRIFT_LIMIT = 0.10
NULL_LIMIT = 0.01
SERIES_TERMS = 100


def match_actuals(predictions, weekly):
    """Predictions joined with the actual sales of the same series and week."""
    actuals = weekly.select("year", F.col("week_of_year").alias("week"), *SERIES, TARGET)
    return predictions.join(actuals, ["year", "week", *SERIES])


def ground_truth_errors(predictions, weekly):
    """One row with the errors on matched rows; null where nothing matched."""
    error = F.col(TARGET) - F.col("sales_prediction")
    return match_actuals(predictions, weekly).agg(
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        F.count(F.lit(1)).alias("matched_rows"),
    )


def with_baseline(current, stored):
    """Stored rmse next to the current one; null for a model never stored."""
    return current.join(stored.select("model", F.col("rmse").alias("baseline_rmse")), "model", "left")


def judge_drift(rows, limit=DRIFT_LIMIT):
    """Relative growth of rmse over baseline_rmse and whether it exceeds ``limit``;
    without a baseline there is no drift."""
    base = F.col("baseline_rmse")
    change = F.try_divide(F.col("rmse") - base, base)
    return rows.withColumns(
        {"degradation": change, "drift_detected": F.coalesce(change > limit, F.lit(False))}
    )


def performance_drift(current, stored, limit=DRIFT_LIMIT):
    """Drift of every model in ``current`` against the stored metrics."""
    return judge_drift(with_baseline(current, stored), limit)


def missing_data_alert(df, limit=NULL_LIMIT):
    """Null share of each column and whether it exceeds ``limit``."""
    shares = [
        F.struct(F.lit(c).alias("column"), F.avg(F.col(c).isNull().cast("double")).alias("null_share"))
        for c in df.columns
    ]
    return (
        df.agg(F.array(*shares).alias("s"))
        .select(F.inline("s"))
        .withColumn("alert", F.coalesce(F.col("null_share") > limit, F.lit(False)))
    )


def distribution_drift(rows, reference, current, value=TARGET):
    """Two-sample Kolmogorov-Smirnov statistic and its asymptotic p-value.

    ``reference`` and ``current`` are conditions that pick the two samples out of
    ``rows``, so both come from one pass.
    """
    shares = running_shares(rows.where(reference | current), value, {"old": reference, "new": current})
    statistic = shares.agg(
        F.max(F.abs(F.col("old") - F.col("new"))).alias("statistic"),
        F.max("old_rows").alias("reference_rows"),
        F.max("new_rows").alias("current_rows"),
    )
    return with_p_value(statistic)


def with_p_value(statistic):
    """Add the asymptotic p-value to (statistic, reference_rows, current_rows)."""
    m, n = F.col("reference_rows").cast("double"), F.col("current_rows").cast("double")
    scaled = F.col("statistic") * F.sqrt(F.try_divide(m * n, m + n))
    tail = F.aggregate(
        F.sequence(F.lit(1), F.lit(SERIES_TERMS)),
        F.lit(0.0),
        lambda total, k: total
        + F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2.0 * k * k * scaled * scaled),
    )
    # The alternating series only settles away from zero; below, the tail is 1.
    p_value = F.when(scaled < 0.2, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), tail)))
    return statistic.withColumn("p_value", p_value)


def sketched(rows, columns, by=(), k=SKETCH_K):
    """A mergeable quantile sketch (KLL) of each column, one row per group and column.

    Null and NaN are left out. A sketch is a few kilobytes whatever the rows, so those of
    days or partitions are stored and merged, and later rounds read new rows only.
    """
    values = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in columns]))
    return (
        rows.select(*by, values.alias("x"))
        .where(F.col("x.v").isNotNull() & ~F.isnan("x.v"))
        .groupBy(*by, F.col("x.column").alias("column"))
        .agg(F.count(F.lit(1)).alias("rows"), F.kll_sketch_agg_double("x.v", k).alias("sketch"))
    )


def merged_sketches(sketches, by=()):
    """Sketches of parts as one per group and column."""
    return sketches.groupBy(*by, "column").agg(F.sum("rows").alias("rows"), F.kll_merge_agg_double("sketch").alias("sketch"))


def sketch_error(k=SKETCH_K, points=SKETCH_POINTS):
    """Bound on the error of ``sketch_drift``: a sketch's ranks are off by at most 2.446 / k^0.9433
    with a confidence of 99 %, twice that with next to certainty, for each of two sketches; the
    functions are known to a step, and between two points they rise by one more."""
    return 2 * 2 * 2.446 / k**0.9433 + 2 / points


def sketch_drift(reference, current, points=SKETCH_POINTS):
    """Kolmogorov-Smirnov statistic per column from one stored sketch on either side.

    A distribution function at a value is the share of the sketch's evenly spaced quantiles up
    to it. Both functions are compared at the quantiles of both sketches.
    """
    ranks = F.array(*[F.lit(i / points) for i in range(points + 1)])

    def side(sketches, name):
        return sketches.select(
            "column", F.col("rows").alias(f"{name}_rows"), F.kll_sketch_get_quantile_double("sketch", ranks).alias(f"_{name}")
        )

    def up_to(quantiles, value):
        return F.size(F.filter(quantiles, lambda q: q <= value))

    both = side(reference, "reference").join(side(current, "current"), "column")
    gaps = F.transform(
        F.concat("_reference", "_current"), lambda v: F.abs(up_to(F.col("_reference"), v) - up_to(F.col("_current"), v)) / points
    )
    return with_p_value(both.select("column", F.array_max(gaps).alias("statistic"), "reference_rows", "current_rows"))
