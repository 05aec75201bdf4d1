import datetime
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandloom.operators import alignment, arima, arima_exact, seasonal
from demandloom.plans.scoring import score_upload
from helpers import holidays, series, tuples, weekly


def arma_values(phi, theta, n, seed=1):
    rng = np.random.default_rng(seed)
    e = rng.normal(0, 100, n)
    d = np.zeros(n)
    for t in range(1, n):
        d[t] = phi * d[t - 1] + e[t] + theta * e[t - 1]
    return [int(v) for v in np.round(np.cumsum(d))]


def brute_force(y, p, d, q, steps):
    """The same two least-squares steps with numpy."""
    w = np.array(y, dtype=float)
    tails = [w[-1]]
    for _ in range(d):
        w = np.diff(w)
        tails.append(w[-1])
    centre = w.mean() if d == 0 else 0.0
    w = w - centre
    m = max(p, q) + 1
    lagged = np.column_stack([w[m - k : len(w) - k] for k in range(1, m + 1)])
    e = np.full(len(w), np.nan)
    e[m:] = w[m:] - lagged @ np.linalg.lstsq(lagged, w[m:], rcond=None)[0]
    rows = range(m + q, len(w))
    x = np.array([[w[t - k] for k in range(1, p + 1)] + [e[t - k] for k in range(1, q + 1)] for t in rows])
    beta = np.linalg.lstsq(x, w[m + q :], rcond=None)[0]
    phi, theta = beta[:p], beta[p:]
    hist, res, out = list(w[::-1]), list(e[::-1]), []
    levels = tails[:d]
    for _ in range(steps):
        new = sum(phi[i] * hist[i] for i in range(p)) + sum(theta[j] * res[j] for j in range(q))
        hist.insert(0, new)
        res.insert(0, 0.0)
        carried = new
        for i in reversed(range(d)):
            levels[i] += carried
            carried = levels[i]
        out.append(levels[0] if d else new + centre)
    return phi, theta, out


@pytest.mark.parametrize("order", [(1, 1, 1), (2, 1, 1), (1, 0, 1), (2, 2, 2), (1, 1, 0), (0, 1, 1)])
def test_arima_matches_numpy(spark, order):
    values = arma_values(0.5, 0.3, 240)  # integrated once
    if order[1] == 2:
        values = [int(v) for v in np.cumsum(values)]
    elif order[1] == 0:
        values = [int(v) for v in np.diff(values)]
    train, test = series(spark, values[:200]), series(spark, [0] * 12, start=(2020, 1))
    phi, theta, expected = brute_force(values[:200], *order, steps=12)
    model = arima.fit_arima(train, order).first()
    assert model.phi is not None
    assert model.phi == pytest.approx(list(phi), rel=1e-6)
    assert model.theta == pytest.approx(list(theta), rel=1e-6)
    got = arima.arima_forecast(train, test, order).orderBy("week_of_year").collect()
    assert [r.prediction for r in got] == pytest.approx(expected, rel=1e-6)


def test_closed_form_equals_the_recursion(spark):
    train = series(spark, arma_values(-0.4, 0.5, 200))
    steps = arima.fit_arima(train).crossJoin(spark.range(1, 30).select(F.col("id").cast("int").alias("h")))
    got = steps.select(
        arima.arima_value(F.col("h")).alias("a"), arima._recursion(F.col("h"), 1).alias("b")
    ).collect()
    assert [r.a for r in got] == pytest.approx([r.b for r in got], rel=1e-9)


def test_arima_recovers_simulated_coefficients(spark):
    model = arima.fit_arima(series(spark, arma_values(0.6, 0.3, 4000), start=(1900, 1))).first()
    assert model.phi[0] == pytest.approx(0.6, abs=0.06) and model.theta[0] == pytest.approx(0.3, abs=0.08)


@pytest.mark.parametrize("values", [[5], [5, 6, 7], [9] * 60, list(range(60))])
def test_arima_falls_back_to_the_last_value(spark, values):
    train, test = series(spark, values), series(spark, [1, 2], start=(2020, 1))
    assert arima.fit_arima(train).first().phi is None
    got = arima.arima_forecast(train, test).collect()
    assert [r.prediction for r in got] == [float(values[-1])] * 2


def test_alignment_by_position_and_horizon(spark):
    train = series(spark, [3, 4, 8])
    test = series(spark, [10, 20, 30, 40], start=(2014, 1), skip=(1,))
    got = alignment.last_value_forecast(train, test, horizon=2).orderBy("week_of_year").collect()
    assert [(r.week_of_year, r.weekly_sales) for r in got] == [(1, 10.0), (3, 30.0), (4, 40.0)]
    assert [r.prediction for r in got[:2]] == [8.0, 8.0] and math.isnan(got[2].prediction)


def test_series_without_training_rows_gets_nan(spark):
    train, test = series(spark, [3]), series(spark, [1], store=2)
    for forecast in (alignment.last_value_forecast, arima.arima_forecast, seasonal.seasonal_forecast):
        assert math.isnan(forecast(train, test).first().prediction)


def test_lengths_default_to_a_year(spark):
    train = series(spark, [1], store=1).unionByName(series(spark, [1], store=2))
    test = series(spark, [1, 2, 3], store=1)
    assert sorted(tuples(alignment.test_lengths(train, test))) == [(1, 1, 3), (2, 1, 52)]


def wave(n, level=500.0, slope=40.0, height=80.0):
    """Values of a trend plus one yearly cycle on the Mondays of n weeks from 2013."""
    monday, out = datetime.date(2012, 12, 31), []
    for _ in range(n):
        t = (monday - seasonal.ORIGIN).days / seasonal.YEAR_DAYS
        out.append((monday.isocalendar(), level + slope * (t - 13) + height * math.sin(2 * math.pi * t)))
        monday += datetime.timedelta(weeks=1)
    return out


def wave_rows(spark, points):
    return weekly(spark, [(1, 1, iso[0], iso[1], round(1000 * v)) for iso, v in points])


def test_seasonal_recovers_a_known_cycle(spark):
    points = wave(260)
    train, test = wave_rows(spark, points[:208]), wave_rows(spark, points[208:])
    got = seasonal.seasonal_forecast(train, test).collect()
    worst = max(abs(r.prediction - r.weekly_sales) / r.weekly_sales for r in got)
    assert len(got) == 52 and worst < 0.01


def test_seasonal_scoring_equals_the_design_matrix(spark):
    models = seasonal.fit_seasonal(wave_rows(spark, wave(208)))
    model = models.first()
    weeks = spark.createDataFrame([(1, 1, 2017, w) for w in (1, 20, 52)], "store int, item int, year int, week int")
    got = {r.week: r.sales_prediction for r in seasonal.score_weeks(weeks, models).collect()}
    for w, value in got.items():
        t = (datetime.date.fromisocalendar(2017, w, 1) - seasonal.ORIGIN).days / seasonal.YEAR_DAYS
        assert value == pytest.approx(float((seasonal.design([t], model.bends) @ np.array(model.coefficients))[0]))


def test_seasonal_trend_bends(spark):
    points = [(iso, v if n < 100 else v + 5 * (n - 100)) for n, (iso, v) in enumerate(wave(200))]
    train = wave_rows(spark, points)

    def error(n_bends):
        fit = lambda rows: seasonal.ridge_fit(rows, n_bends=n_bends)
        got = seasonal.seasonal_forecast(train, train, fit).collect()
        return max(abs(r.prediction - r.weekly_sales) for r in got)

    assert error(8) < error(0) / 2
    assert error(25) < error(0) / 2


def test_seasonal_bends_stay_straight_on_a_straight_trend(spark):
    rng = np.random.default_rng(9)
    points = [(iso, v + rng.normal(0, 10)) for iso, v in wave(260)]
    train, test = wave_rows(spark, points[:208]), wave_rows(spark, points[208:])
    got = seasonal.seasonal_forecast(train, test).collect()
    assert np.sqrt(np.mean([(r.prediction - r.weekly_sales) ** 2 for r in got])) < 20_000


def test_seasonal_short_and_failing_series_keep_the_last_value(spark):
    def failing(rows):
        raise ValueError("no fit")

    one = seasonal.fit_seasonal(series(spark, [7])).first()
    assert (one.coefficients, one.train_rows) == ([7.0], 1)
    test = series(spark, [1, 1], start=(2014, 1))
    got = seasonal.seasonal_forecast(series(spark, [5, 6, 9]), test, failing).collect()
    assert [r.prediction for r in got] == [9.0, 9.0]


def test_repeated_dates_weigh_as_separate_rows(spark):
    # (2015, 53) and (2016, 53) start on the same Monday.
    rows = weekly(spark, [(1, 1, 2015, 53, 10), (1, 1, 2016, 53, 20), (1, 1, 2015, 1, 15)])
    assert seasonal.fit_seasonal(rows).first().train_rows == 3


def test_upload_scores_only_series_with_a_model(spark):
    models = seasonal.fit_seasonal(wave_rows(spark, wave(208)))
    upload = spark.createDataFrame(
        [("02/01/2017", 1, 1), ("03/01/2017", 1, 1), ("09/01/2017", 1, 1), ("02/01/2017", 5, 5)],
        "date string, store int, item int",
    )
    got = score_upload(upload, holidays(spark, "2017-01-02"), models)
    assert sorted(tuples(got.select("store", "item", "year", "week"))) == [(1, 1, 2017, 1), (1, 1, 2017, 2)]
    assert got.where(F.col("sales_prediction") > 0).count() == 2


def kalman_deviance(w, phi, theta):
    """The likelihood of an ARMA(1, 1) from its covariance matrix, with the noise variance taken out."""
    n = len(w)
    cover = [(1 + 2 * theta * phi + theta**2) / (1 - phi**2), (1 + phi * theta) * (phi + theta) / (1 - phi**2)]
    while len(cover) < n:
        cover.append(phi * cover[-1])
    full = np.array([[cover[abs(i - j)] for j in range(n)] for i in range(n)])
    squares = w @ np.linalg.solve(full, w)
    return n * np.log(squares / n) + np.linalg.slogdet(full)[1] + n * (1 + np.log(2 * np.pi))


def arma(rng, n, phi, theta):
    e = rng.normal(size=n + 50)
    x = np.zeros(n + 50)
    for t in range(1, n + 50):
        x[t] = phi * x[t - 1] + e[t] + theta * e[t - 1]
    return x[50:]


def test_deviance_is_the_exact_likelihood():
    rng = np.random.default_rng(3)
    for phi, theta in ((0.5, 0.3), (-0.8, 0.6), (0.95, -0.9), (0.0, 0.0)):
        w = arma(rng, 60, phi, theta)
        for a, b in ((phi, theta), (0.2, -0.4)):
            assert float(arima_exact.deviance(w, a, b)[0]) == pytest.approx(kalman_deviance(w, a, b))


def test_search_finds_the_best_point():
    rng = np.random.default_rng(8)
    for phi, theta in ((0.6, 0.3), (-0.5, -0.4), (0.8, -0.3)):
        w = arma(rng, 600, phi, theta)
        best = arima_exact.best_fit(w, (0.1, 0.1))
        assert abs(best[0] - phi) < 0.15 and abs(best[1] - theta) < 0.15
        fine = np.linspace(-0.01, 0.01, 21)
        around, _ = arima_exact.deviance(w, *np.meshgrid(best[0] + fine, best[1] + fine))
        assert best[2] <= around.min() + 1e-6 and best[2] <= float(arima_exact.deviance(w, 0.1, 0.1)[0])


def test_exact_fit_is_never_worse_and_forecasts(spark):
    rng = np.random.default_rng(5)
    frames = [series(spark, [int(1000 + 40 * v) for v in np.cumsum(arma(rng, 150, 0.5, 0.3))], item=i) for i in range(1, 6)]
    frames += [series(spark, [7, 7, 7, 7, 7, 7], item=90), series(spark, [3], item=91), series(spark, [1, 5, 2], item=92), series(spark, [None, None], item=93)]
    train = frames[0]
    for f in frames[1:]:
        train = train.unionByName(f)
    models = arima_exact.fit_exact(train)
    rows = {r["item"]: r for r in models.collect()}
    assert len(rows) == 9 and all(rows[i].deviance <= rows[i].start_deviance + 1e-9 for i in range(1, 6))
    assert all(rows[i].phi is None for i in (90, 91, 92, 93))
    test = series(spark, [0] * 4, item=1, start=(2020, 1))
    for i in (90, 92):
        test = test.unionByName(series(spark, [0] * 4, item=i, start=(2020, 1)))
    got = {(r["item"], r.week_of_year): r.prediction for r in arima.forecast_from(models, test).collect()}
    one = rows[1]
    value, change = one.last_value, one["values"][0]
    error = one.residuals[0]
    for week in range(1, 4):
        change, error = one.phi[0] * change + one.theta[0] * error, 0.0
        value += change
        assert got[1, week] == pytest.approx(value)
    assert got[90, 1] == 7.0 and got[92, 1] == 2.0


def test_lasso_meets_its_conditions():
    rng = np.random.default_rng(2)
    for _ in range(20):
        z = rng.normal(size=(40, 12))
        z[:, 5] = z[:, 4]  # columns that say the same
        gram, right, penalty = z.T @ z, z.T @ rng.normal(size=40) * 3, 4.0
        x = seasonal.lasso(gram, right, penalty)
        pull = right - gram @ x
        assert np.all(np.abs(pull) <= penalty + 1e-6)
        assert np.allclose(pull[x != 0], penalty * np.sign(x[x != 0]), atol=1e-6)
    assert np.all(seasonal.lasso(np.eye(3), np.array([0.5, -0.5, 2.0]), 1.0) == [0, 0, 1])


def test_sparse_trend_bends_only_where_it_must(spark):
    rng = np.random.default_rng(4)
    straight = wave_rows(spark, [(iso, v + rng.normal(0, 2)) for iso, v in wave(200)])
    broken = wave_rows(spark, [(iso, (v if n < 100 else v + 5 * (n - 100)) + rng.normal(0, 2)) for n, (iso, v) in enumerate(wave(200))])
    none, some = seasonal.fit_seasonal(straight).first(), seasonal.fit_seasonal(broken).first()
    assert len(none.bends) < len(some.bends) < seasonal.N_BENDS
    assert len(some.coefficients) == 22 + len(some.bends)
    got = seasonal.seasonal_forecast(broken, broken).collect()
    assert max(abs(r.prediction - r.weekly_sales) / r.weekly_sales for r in got) < 0.05
    sizes = dict(zip(some.bends, some.coefficients[22:]))
    turn = (datetime.date(2012, 12, 31) + datetime.timedelta(weeks=100) - seasonal.ORIGIN).days / seasonal.YEAR_DAYS
    assert sum(c for b, c in sizes.items() if abs(b - turn) < 0.5) > 0.8 * sum(sizes.values()) > 0
