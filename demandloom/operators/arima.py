"""ARIMA(p, d, q) for every series at once, in column expressions.

The two-step least-squares estimator of Hannan and Rissanen (1982): a long
autoregression of the differenced series gives residuals, then the series is regressed
on its own p lags and q lagged residuals. It is not the exact-likelihood estimator, so
coefficients differ slightly from it. All windows and the final aggregation use the
same series partitioning: one exchange fits every series, and a series has one row per
calendar week.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..columns import SERIES, TARGET
from .alignment import align_forecast, keyed

ORDER = (1, 1, 1)
SINGULAR = 1e-9
STATIONARY = 0.99


def _cross(i, j):
    return f"s_{min(i, j)}_{max(i, j)}"


def _normal_equations(regressors, response, total):
    """Named sums for least squares; ``total`` turns a product into its sum."""
    k = range(len(regressors))
    sums = {_cross(i, j): total(regressors[i] * regressors[j]) for i in k for j in k if i <= j}
    return sums | {f"r_{i}": total(response * regressors[i]) for i in k}


def _solve(df, k, name):
    """Add <name>_0.. solving the normal equations by elimination, one projection per
    step. A pivot that vanishes against its own diagonal makes all unknowns null."""
    col = F.col
    df = df.withColumns({f"tol_{i}": SINGULAR * col(_cross(i, i)) for i in range(k)})
    for i in range(k):
        df = df.withColumn(f"pivot_{i}", F.when(col(_cross(i, i)) > col(f"tol_{i}"), col(_cross(i, i))))
        reduced = {}
        for j in range(i + 1, k):
            factor = col(_cross(i, j)) / col(f"pivot_{i}")
            reduced[f"r_{j}"] = col(f"r_{j}") - factor * col(f"r_{i}")
            for m in range(j, k):
                reduced[_cross(j, m)] = col(_cross(j, m)) - factor * col(_cross(i, m))
        df = df.withColumns(reduced) if reduced else df
    for i in reversed(range(k)):
        known = sum((col(_cross(i, j)) * col(f"{name}_{j}") for j in range(i + 1, k)), F.lit(0.0))
        df = df.withColumn(f"{name}_{i}", (col(f"r_{i}") - known) / col(f"pivot_{i}"))
    return df


def _with_stationary(df, p):
    """Add ``stationary``: every partial autocorrelation of the AR part, found by
    stepping its order down, stays inside the unit circle by a margin."""
    df = df.withColumns({f"a_{i}": F.col(f"x_{i}") for i in range(p)})
    stationary = F.lit(True)
    for order in range(p, 0, -1):
        df = df.withColumn(f"k_{order}", F.col(f"a_{order - 1}"))
        last = F.col(f"k_{order}")
        stationary = stationary & (F.abs(last) < STATIONARY)
        df = df.withColumns(
            {
                f"a_{i}": F.try_divide(F.col(f"a_{i}") + last * F.col(f"a_{order - 2 - i}"), 1 - last * last)
                for i in range(order - 1)
            }
        )
    return df.withColumn("stationary", stationary)


def fit_arima(train, order=ORDER):
    """One coefficient row per series.

    ``phi`` and ``theta`` are null where the equations of a series have no single
    solution, as with fewer rows than coefficients, or its fit is not clearly stationary; the forecast is then the last value. ``values``, ``residuals``
    and ``levels`` hold what the recursion starts from, latest first.
    """
    p, d, q = order
    longest = max(p, q) + 1
    series = Window.partitionBy(*SERIES)
    past = series.orderBy("year", "week_of_year")

    df = keyed(train).select(*SERIES, "year", "week_of_year", F.col(TARGET).cast("double").alias("level_0"))
    centre = F.avg("level_0").over(series) if d == 0 else F.lit(0.0)
    df = df.withColumn("centre", centre)
    for i in range(d):
        df = df.withColumn(f"level_{i + 1}", F.col(f"level_{i}") - F.lag(f"level_{i}").over(past))
    df = df.withColumn("w", F.col(f"level_{d}") - F.col("centre"))
    df = df.withColumns({f"w_{k}": F.lag("w", k).over(past) for k in range(1, longest + 1)})

    lags = [F.col(f"w_{k}") for k in range(1, longest + 1)]
    complete = lags[-1].isNotNull()
    df = df.withColumns(
        _normal_equations(lags, F.col("w"), lambda product: F.sum(F.when(complete, product)).over(series))
    )
    df = _solve(df, longest, "ar")
    explained = sum((F.col(f"ar_{k}") * lags[k] for k in range(longest)), F.lit(0.0))
    df = df.withColumn("e", F.col("w") - explained)
    df = df.withColumns({f"e_{k}": F.lag("e", k).over(past) for k in range(1, q + 1)})

    regressors = lags[:p] + [F.col(f"e_{k}") for k in range(1, q + 1)]
    usable = F.col(f"e_{q}") if q else F.col("e")
    when = F.struct("year", "week_of_year")

    def latest(column):
        return F.max_by(column, when)

    fitted = df.groupBy(*SERIES).agg(
        F.count(usable).alias("used_rows"),
        latest("level_0").alias("last_value"),
        latest("centre").alias("centre"),
        latest(F.array("w", *[f"w_{k}" for k in range(1, p)])).alias("values"),
        latest(F.array("e", *[f"e_{k}" for k in range(1, q)])).alias("residuals"),
        latest(F.array(*[f"level_{i}" for i in range(max(d, 1))])).alias("levels"),
        *[
            column.alias(name)
            for name, column in _normal_equations(
                regressors, F.col("w"), lambda product: F.sum(F.when(usable.isNotNull(), product))
            ).items()
        ],
    )
    fitted = _with_stationary(_solve(fitted, p + q, "x"), p)
    solved = F.lit(True)
    for i in range(p + q):
        solved = solved & F.col(f"x_{i}").isNotNull()
    accepted = solved & (F.col("used_rows") >= p + q) & F.col("stationary")

    def coefficients(first, count):
        array = F.array(*[F.col(f"x_{i}") for i in range(first, first + count)]).cast("array<double>")
        return F.when(accepted, array)

    return fitted.select(
        *SERIES,
        coefficients(0, p).alias("phi"),
        coefficients(p, q).alias("theta"),
        "last_value",
        "centre",
        "values",
        "residuals",
        "levels",
        "used_rows",
    )


def arima_value(h, order=ORDER):
    """Forecast ``h`` steps past the last value, or the last value without a fit.

    Orders up to (1, 1, 1) have a closed form, the sum of a geometric series of
    changes; others recurse over the steps.
    """
    p, d, q = order
    closed = p <= 1 and d == 1 and q <= 1
    value = _closed_form(h, p, q) if closed else _recursion(h, d)
    return F.when(F.col("phi").isNull(), F.col("last_value")).otherwise(value)


def _closed_form(h, p, q):
    phi = F.get("phi", F.lit(0)) if p else F.lit(0.0)
    theta = F.get("theta", F.lit(0)) if q else F.lit(0.0)
    first = phi * F.get("values", F.lit(0)) + theta * F.get("residuals", F.lit(0))
    return F.col("last_value") + first * (1 - F.pow(phi, h)) / (1 - phi)


def _recursion(h, d):
    def dot(coefficients, history):
        terms = F.zip_with(coefficients, history, lambda c, x: F.coalesce(c * x, F.lit(0.0)))
        return F.aggregate(terms, F.lit(0.0), lambda total, term: total + term)

    def state(values, residuals, levels):
        return F.struct(values.alias("values"), residuals.alias("residuals"), levels.alias("levels"))

    def shifted(new, history):
        return F.slice(F.concat(F.array(new), history), 1, F.size(history))

    def step(s, _):
        change = dot(F.col("phi"), s["values"]) + dot(F.col("theta"), s["residuals"])
        levels, carried = [], change
        for i in reversed(range(d)):
            carried = s["levels"][i] + carried
            levels.insert(0, carried)
        new_levels = F.array(*levels) if d else F.array(change + F.col("centre"))
        return state(shifted(change, s["values"]), shifted(F.lit(0.0), s["residuals"]), new_levels)

    start = state(F.col("values"), F.col("residuals"), F.col("levels"))
    steps = F.sequence(F.lit(1), h)
    return F.aggregate(steps, start, step, lambda s: s["levels"][0])


def forecast_from(models, test, order=ORDER, horizon=None):
    """Forecast table over the test rows from a fitted or stored model table."""
    return align_forecast(test, models, arima_value(F.col("h"), order), horizon)


def arima_forecast(train, test, order=ORDER, horizon=None):
    return forecast_from(fit_arima(train, order), test, order, horizon)
