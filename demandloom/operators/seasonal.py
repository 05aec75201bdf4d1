"""Trend plus yearly seasonality, one additive model per series.

Fitting is a small penalised regression per series inside a grouped map: a normal prior on
level, slope and season, and a Laplace prior on the bends of the trend, which leaves most of
them at zero. The series is summed per date first, so a group holds at most one row per
calendar week whatever the input. The result is a coefficient table; scoring is a join and a dot
product in column expressions, without Python.
"""

import datetime

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..columns import SERIES, TARGET, WEEK_KEY
from ..functions import iso_monday
from .alignment import keyed

YEAR_DAYS = 365.25
FOURIER_ORDER = 10
ORIGIN = datetime.date(2000, 1, 1)
PENALTY = 1e-3
#: Prior deviations of level and slope, and of the season, against the largest value.
LEVEL_SCALE = 5.0
SEASON_SCALE = 10.0
TREND_SHARE = 0.8
N_BENDS = 25
BEND_SCALE = 0.05

MODEL_SCHEMA = T.StructType(
    [
        T.StructField("store", T.IntegerType()),
        T.StructField("item", T.IntegerType()),
        T.StructField("coefficients", T.ArrayType(T.DoubleType())),
        T.StructField("bends", T.ArrayType(T.DoubleType())),
        T.StructField("last_value", T.DoubleType()),
        T.StructField("train_rows", T.LongType()),
    ]
)


def years_since_origin(date):
    return F.date_diff(date, F.lit(ORIGIN)) / F.lit(YEAR_DAYS)


def design(t, bends):
    """Columns [1, t, sin and cos of 1..FOURIER_ORDER cycles a year, hinges]."""
    t = np.asarray(t, dtype=float)
    angles = 2 * np.pi * np.outer(t, np.arange(1, FOURIER_ORDER + 1))
    hinges = np.maximum(t[:, None] - np.asarray(bends, dtype=float)[None, :], 0.0)
    return np.hstack([np.ones((len(t), 1)), t[:, None], np.sin(angles), np.cos(angles), hinges])


def bend_places(t, n_bends):
    """Up to ``n_bends`` observed times spread over the first part of the history."""
    early = np.sort(t)[: int(TREND_SHARE * len(t))]
    n = min(n_bends, len(early) - 1)
    if n < 1:
        return np.array([])
    return early[np.linspace(0, len(early) - 1, n + 1).round().astype(int)][1:]


def ridge_fit(points, n_bends=N_BENDS, bend_scale=BEND_SCALE, penalty=PENALTY):
    """Coefficients and trend bends from columns t, rows and total (of y per t).

    Bends are shrunk as under a normal prior of ``bend_scale``, relative to the
    largest value and the length of the history, with the noise variance taken from
    the fit before.
    """
    t, weight, total = (points[c].to_numpy(dtype=float) for c in ("t", "rows", "total"))
    y = total / weight
    span, largest = t.max() - t.min(), np.abs(y).max() or 1.0
    bends = bend_places(t, n_bends)
    x = design(t, bends)
    first_bend = x.shape[1] - len(bends)
    ridge = np.full(x.shape[1], penalty)
    ridge[:2] = 1e-6
    noise = bend_scale
    for _ in range(3 if len(bends) else 1):
        ridge[first_bend:] = max((noise / bend_scale * span) ** 2, 1e-6)
        coefficients = np.linalg.solve((x * weight[:, None]).T @ x + np.diag(ridge), x.T @ total)
        noise = np.sqrt((weight * (y - x @ coefficients) ** 2).sum() / weight.sum()) / largest
    return coefficients, bends


def lasso(gram, right, penalty, sweeps=2000, tolerance=1e-12):
    """The x with the least x'Gx/2 - r'x + penalty * sum|x|, one coordinate at a time."""
    x, size = np.zeros(len(right)), np.diag(gram).copy()
    pull = right.astype(float).copy()  # right - gram @ x, kept up to date
    for _ in range(sweeps):
        most = 0.0
        for j in np.flatnonzero(size > 0):
            free = pull[j] + size[j] * x[j]
            new = np.sign(free) * max(abs(free) - penalty, 0.0) / size[j]
            if new != x[j]:
                pull -= gram[:, j] * (new - x[j])
                most = max(most, abs(new - x[j]))
                x[j] = new
        if most <= tolerance * max(1.0, np.abs(x).max(initial=0.0)):
            break
    return x


def sparse_fit(points, n_bends=N_BENDS, bend_scale=BEND_SCALE):
    """Coefficients and trend bends from columns t, rows and total (of y per t).

    Values count against the largest one and time against the length of the history. The
    smooth part is taken out of the equations exactly, which leaves a lasso on the bends
    alone. The noise that weighs the priors is that of the fit before. Bends at zero are left out.
    """
    t, weight, total = (points[c].to_numpy(dtype=float) for c in ("t", "rows", "total"))
    y = total / weight
    span, largest = (t.max() - t.min()) or 1.0, np.abs(y).max() or 1.0
    bends = bend_places(t, n_bends)
    x = design(t, bends)
    smooth = x.shape[1] - len(bends)
    # In scaled units: slope and bends per history.
    scale = np.ones(x.shape[1])
    scale[1], scale[smooth:] = 1 / span, 1 / span
    z = x * scale
    z[:, 1] -= t.min() / span
    prior = np.full(smooth, SEASON_SCALE)
    prior[:2] = LEVEL_SCALE
    gram, right = (z * weight[:, None]).T @ z, z.T @ (total / largest)
    noise = bend_scale
    for _ in range(5 if len(bends) else 2):
        own = gram[:smooth, :smooth] + np.diag((noise / prior) ** 2 + 1e-9)
        taken = np.linalg.solve(own, np.column_stack([gram[:smooth, smooth:], right[:smooth]]))
        rest = gram[smooth:, smooth:] - gram[smooth:, :smooth] @ taken[:, :-1]
        bend = lasso(rest, right[smooth:] - gram[smooth:, :smooth] @ taken[:, -1], noise**2 / bend_scale)
        found = np.concatenate([taken[:, -1] - taken[:, :-1] @ bend, bend])
        noise = max(np.sqrt((weight * (y / largest - z @ found) ** 2).sum() / weight.sum()), 1e-6)
    coefficients = found * scale * largest
    coefficients[0] -= coefficients[1] * t.min()
    kept = np.flatnonzero(bend)
    return np.concatenate([coefficients[:smooth], coefficients[smooth:][kept]]), bends[kept]


def fit_seasonal(train, fit=sparse_fit):
    """Model table with one row per series.

    ``fit(points) -> (coefficients, bends)`` may be replaced by the caller. A series
    it cannot fit, or of fewer than two rows, keeps its last value as a constant.
    """
    points = (
        keyed(train).withColumn("_day", iso_monday(F.col("year"), F.col("week_of_year")))
        .groupBy(*SERIES, years_since_origin(F.col("_day")).alias("t"))
        .agg(
            F.sum(TARGET).cast("double").alias("total"),
            F.count(TARGET).alias("rows"),
            F.max(F.struct("year", "week_of_year", F.col(TARGET).cast("double").alias("y"))).alias("_last"),
        )
        .select(
            *SERIES, "t", "total", "rows", "_last.year", "_last.week_of_year", F.col("_last.y").alias("y")
        )
    )

    def per_series(key, pdf):
        latest = pdf.sort_values(["year", "week_of_year"])["y"].iloc[-1]
        rows = int(pdf["rows"].sum())
        observed = pdf[pdf["rows"] > 0]
        coefficients, bends = np.array([latest]), np.array([])
        if rows >= 2:
            try:
                coefficients, bends = fit(observed)
            except (np.linalg.LinAlgError, ValueError):
                pass
        return pd.DataFrame(
            {
                "store": [key[0]],
                "item": [key[1]],
                "coefficients": [list(map(float, coefficients))],
                "bends": [list(map(float, bends))],
                "last_value": [float(latest)],
                "train_rows": [rows],
            }
        )

    return points.groupBy(*SERIES).applyInPandas(per_series, MODEL_SCHEMA)


def seasonal_value(date, coefficients="coefficients", bends="bends"):
    """Model value at a date; coefficients missing at the end count as zero."""
    t = years_since_origin(date)
    cycles = [t * F.lit(2 * np.pi * k) for k in range(1, FOURIER_ORDER + 1)]
    base = F.array(F.lit(1.0), t, *[F.sin(c) for c in cycles], *[F.cos(c) for c in cycles])
    hinges = F.transform(bends, lambda b: F.greatest(t - b, F.lit(0.0)))
    terms = F.zip_with(
        coefficients, F.concat(base, hinges), lambda c, x: F.coalesce(c, F.lit(0.0)) * x
    )
    return F.aggregate(terms, F.lit(0.0), lambda total, term: total + term)


def score_weeks(weeks, models):
    """Predictions for (store, item, year, week) rows of series that have a model."""
    return weeks.join(models, list(SERIES)).select(
        *SERIES,
        "year",
        "week",
        seasonal_value(iso_monday(F.col("year"), F.col("week"))).alias("sales_prediction"),
    )


def seasonal_forecast(train, test, fit=sparse_fit):
    return forecast_from(fit_seasonal(train, fit), test)


def forecast_from(models, test):
    """Forecast table over the test rows, NaN for series without a model."""
    value = seasonal_value(iso_monday(F.col("year"), F.col("week_of_year")))
    return keyed(test).join(models, list(SERIES), "left").select(
        *WEEK_KEY,
        F.col(TARGET).cast("double").alias(TARGET),
        F.coalesce(value, F.lit(float("nan"))).alias("prediction"),
    )
