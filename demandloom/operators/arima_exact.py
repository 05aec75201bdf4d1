"""ARIMA(1, 1, 1) by exact likelihood, one small search per series.

The differences of a series follow an ARMA(1, 1). Its one-step errors come from the
innovations recursion of Brockwell and Davis: the variance of the first is that of the
stationary process, later ones approach one, and no start value is assumed. The noise
variance is taken out of the likelihood, so only phi and theta are searched, both inside the
unit circle. The search looks at whole grids of both at once, the first of which holds the
two-step estimate, and narrows them around the best point: it never ends below its start.

A series is summed to one row per calendar week before, so a group is bounded. The result
has the columns of ``arima.fit_arima`` and is scored by the same closed form.
"""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from ..columns import SERIES, TARGET
from . import arima
from .alignment import keyed

#: Half the width and the points a side of the first grid, and how grids narrow.
EDGE = 0.98
POINTS = 33
ROUNDS = 7
NARROWED = 0.12
#: Differences that a search needs; fewer leave the last value as forecast.
LEAST = 4


def deviance(w, phi, theta):
    """Minus twice the log likelihood of differences ``w``, the noise variance taken out.

    ``phi`` and ``theta`` may be arrays of one shape; so is the result. Also the last error.
    """
    phi, theta = np.asarray(phi, dtype=float), np.asarray(theta, dtype=float)
    r = (1 + 2 * theta * phi + theta**2) / (1 - phi**2)
    expected, squares, logs = np.zeros_like(phi), np.zeros_like(phi), np.zeros_like(phi)
    error = expected
    for x in w:
        error = x - expected
        squares = squares + error * error / r
        logs = logs + np.log(r)
        gain = theta / r
        expected = phi * x + gain * error
        r = 1 + theta**2 - theta * gain
    n = len(w)
    with np.errstate(divide="ignore"):
        return n * np.log(squares / n) + logs + n * (1 + np.log(2 * np.pi)), error


def best_fit(w, start=None):
    """phi, theta, their deviance and the last error; ``start`` is one more point to look at."""
    w = np.asarray(w, dtype=float)
    axis = np.linspace(-EDGE, EDGE, POINTS)
    phi, theta = (g.ravel() for g in np.meshgrid(axis, axis))
    if start is not None and all(v is not None and abs(v) < 1 for v in start):
        phi, theta = np.append(phi, start[0]), np.append(theta, start[1])
    half = axis[1] - axis[0]
    best = None
    for _ in range(ROUNDS):
        values, errors = deviance(w, phi, theta)
        k = int(np.nanargmin(values))
        if best is None or values[k] < best[2]:
            best = (float(phi[k]), float(theta[k]), float(values[k]), float(errors[k]))
        axis = np.linspace(-half, half, 17)
        phi, theta = (g.ravel() for g in np.meshgrid(np.clip(best[0] + axis, -EDGE, EDGE), np.clip(best[1] + axis, -EDGE, EDGE)))
        half *= NARROWED
    return best


def fit_exact(train):
    """One coefficient row per series, as ``arima.fit_arima`` gives, and both deviances.

    ``start_deviance`` belongs to the two-step estimate and is null without one. Series of
    few or constant differences keep null coefficients: the forecast is the last value.
    """
    place = F.struct("year", "week_of_year", F.col(TARGET).cast("double").alias("y"))
    levels = keyed(train).groupBy(*SERIES).agg(F.sort_array(F.collect_list(place)).alias("weeks"))  # one row per week
    started = arima.fit_arima(train).select(
        *SERIES, F.get("phi", F.lit(0)).alias("phi_0"), F.get("theta", F.lit(0)).alias("theta_0")
    )
    rows = levels.join(started, list(SERIES), "left").select(*SERIES, F.col("weeks.y").alias("y"), "phi_0", "theta_0")

    def search(batches):
        for pdf in batches:
            out = []
            for row in pdf.itertuples(index=False):
                y = np.array([v for v in row.y if v is not None and v == v], dtype=float)
                w = np.diff(y)
                start = None if pd.isna(row.phi_0) else (row.phi_0, row.theta_0)
                first = float(deviance(w, *start)[0]) if start and len(w) >= LEAST else None
                if len(w) < LEAST or not np.any(w != 0):
                    phi = theta = value = None
                    error = 0.0
                else:
                    phi, theta, value, error = best_fit(w, start)
                last = float(y[-1]) if len(y) else None
                out.append((phi, theta, last, float(w[-1]) if len(w) else None, error, len(w), value, first))
            columns = list(zip(*out)) if out else [[]] * 8
            yield pdf[list(SERIES)].assign(
                **dict(zip(("phi_1", "theta_1", "last_value", "last_diff", "last_error", "used_rows", "deviance", "start_deviance"), map(list, columns)))
            )

    ddl = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in SERIES)
    found = rows.mapInPandas(
        search,
        f"{ddl}, phi_1 double, theta_1 double, last_value double, last_diff double, last_error double, used_rows long, "
        "deviance double, start_deviance double",
    )
    fitted = F.col("phi_1").isNotNull()
    return found.select(
        *SERIES,
        F.when(fitted, F.array("phi_1")).alias("phi"),
        F.when(fitted, F.array("theta_1")).alias("theta"),
        "last_value",
        F.lit(0.0).alias("centre"),
        F.array("last_diff").alias("values"),
        F.array("last_error").alias("residuals"),
        F.array("last_value").alias("levels"),
        "used_rows",
        "deviance",
        "start_deviance",
    )


def deviance_of(differences, phi, theta):
    """``deviance`` as a column expression, for given coefficients and an array of differences."""
    n = F.size(differences).cast("double")
    first = (1 + 2 * theta * phi + theta * theta) / (1 - phi * phi)

    def step(s, x):
        error = x - s["expected"]
        gain = theta / s["r"]
        return F.struct(
            (phi * x + gain * error).alias("expected"),
            (1 + theta * theta - theta * gain).alias("r"),
            (s["squares"] + error * error / s["r"]).alias("squares"),
            (s["logs"] + F.log(s["r"])).alias("logs"),
        )

    start = F.struct(F.lit(0.0).alias("expected"), first.alias("r"), F.lit(0.0).alias("squares"), F.lit(0.0).alias("logs"))
    done = F.aggregate(differences, start, step)
    return n * F.log(done["squares"] / n) + done["logs"] + n * (1 + F.log(F.lit(2 * np.pi)))
