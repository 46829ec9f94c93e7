"""Linear models from sums against fits on the rows themselves, and the closed recursion against single steps."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from stockloom.operators import forecast as fc
from stockloom.operators import ridge, series
from stockloom.plans.forecasting import forecast_demand
from stockloom.schemas import EXOGENOUS


def direct(x, y, penalty):
    """Ridge on standardised inputs, from the rows."""
    means, spread = x.mean(0), x.std(0)
    known = spread > 1e-9
    z = np.where(known, (x - means) / np.where(known, spread, 1), 0)
    system = z.T @ z / len(z) + np.diag(np.where(known, penalty, 1.0))
    beta = np.linalg.solve(system, z.T @ (y - y.mean()) / len(z))
    coefficients = np.where(known, beta / np.where(known, spread, 1), 0)
    return y.mean() - coefficients @ means, coefficients


def sums_of(x, y):
    rows = np.column_stack([x, y])
    low = np.tril_indices(rows.shape[1])
    return float(len(rows)), rows.sum(0), (rows.T @ rows)[low]


def some_series(seed, n=200, p=4, signal=1.0):
    pick = np.random.default_rng(seed)
    x = pick.normal(size=(n, p)) * [1, 100, 0.01, 0] + [5, -300, 0, 7]
    return x, 50 + signal * (x[:, 0] * 3 + x[:, 1] * 0.02) + pick.normal(size=n)


def test_models_from_sums_equal_models_from_rows():
    data = [some_series(s) for s in range(6)]
    n, sums, products = (np.array(v) for v in zip(*[sums_of(x, y) for x, y in data]))
    intercepts, coefficients = ridge.shrunk(n, sums, ridge.unpacked(products, 5))
    for i, penalty in enumerate(ridge.PENALTIES[:-1]):
        for k, (x, y) in enumerate(data):
            a, b = direct(x, y, penalty)
            assert intercepts[i, k] == pytest.approx(a, rel=1e-6) and coefficients[i, k] == pytest.approx(b, rel=1e-5, abs=1e-9)
            want = ((y - a - x @ b) ** 2).sum()
            got = ridge.squared_error(intercepts[i], coefficients[i], n, sums, ridge.unpacked(products, 5))[k]
            assert got == pytest.approx(want, rel=1e-6)
    assert (coefficients[-1] == 0).all() and intercepts[-1] == pytest.approx(sums[:, -1] / n)


@pytest.mark.parametrize("signal", [1.0, 0.0])
def test_the_penalty_is_the_best_on_left_out_parts(signal):
    x, y = some_series(3, signal=signal)
    parts = np.array_split(np.arange(len(x)), ridge.FOLDS)
    packed = [np.array(v)[None] for v in zip(*[sums_of(x[p], y[p]) for p in parts])]
    intercept, coefficients, penalty = ridge.solve(*packed)
    missed = []
    for candidate in ridge.PENALTIES[:-1]:
        each = []
        for p in parts:
            rest = np.setdiff1d(np.arange(len(x)), p)
            a, b = direct(x[rest], y[rest], candidate)
            each.append((((y[p] - a - x[p] @ b) ** 2).sum(), ((y[p] - y[rest].mean()) ** 2).sum()))
        ours, mean = np.array(each).T
        missed.append(ours.sum() if (ours <= mean).all() and ours.sum() <= ridge.GAIN * mean.sum() else np.inf)
    want = ridge.PENALTIES[int(np.argmin(missed))] if min(missed) < np.inf else np.inf
    assert penalty[0] == want and (want == np.inf) == (signal == 0.0)
    if signal:
        assert coefficients[0][0] == pytest.approx(3, abs=0.3) and coefficients[0][3] == 0
    else:
        assert intercept[0] == pytest.approx(y.mean())


def test_powers_of_the_companion_equal_single_steps():
    pick = np.random.default_rng(1)
    response, given, history = pick.normal(size=(5, 14)) * 0.3, pick.normal(size=(5, 7)), pick.normal(size=(5, 14))
    got = ridge.closed_recursion(response, given, history)
    for k in range(5):
        days = list(history[k])
        for step in range(7):
            value = given[k, step] + response[k] @ days[:14]
            days.insert(0, value)
            assert got[k, step] == pytest.approx(value)


def weekly(spark, n_series=3, days=200, noise=0.0):
    """Demand that follows its value a week ago."""
    rows = []
    for s in range(n_series):
        pick = np.random.default_rng(s)
        for d in range(days):
            rows.append((s, 1, dt.date(2024, 1, 1) + dt.timedelta(days=d), float(10 + s + 5 * (d % 7 in (4, 5)) + noise * pick.normal())))
    frame = spark.createDataFrame(rows, "store_id int, product_id int, dt date, sale_amount double")
    return frame.withColumns({c: F.lit(1.0) for c in EXOGENOUS})


def test_a_week_that_repeats_is_forecast_and_beats_the_mean(spark):
    made = forecast_demand(weekly(spark, noise=0.2))
    for r in made.metrics.collect():
        assert r["RMSE"] < 0.5 * r["mean_RMSE"] and r["n_train"] + r["n_test"] == 186
    assert fc.no_worse_than_mean(made.metrics).collect() == [(True,)]
    for r in made.long.collect():
        day = 199 + r["horizon_day"]
        assert r["forecast_demand"] == pytest.approx(10 + r["store_id"] + 5 * (day % 7 in (4, 5)), abs=1.2)


def test_forecast_equals_the_model_applied_day_by_day(spark):
    made = forecast_demand(weekly(spark, noise=1.0))
    models = {r["store_id"]: r for r in made.model.collect()}
    place = {c: i for i, c in enumerate(series.FEATURES)}
    got = {(r["store_id"], r["horizon_day"]): r["forecast_demand"] for r in made.long.collect()}
    history = {}
    for r in made.features.orderBy("dt").collect():
        history.setdefault(r["store_id"], []).append(r["demand"])
    for s, model in models.items():
        b, days = model["coefficients"], list(history[s])
        for k in range(1, 8):
            date = dt.date(2024, 1, 1) + dt.timedelta(days=199 + k)
            inputs = {"dayofweek": date.weekday(), "month": date.month, "lag_1": days[-1], "lag_7": days[-7],
                      "roll_7_mean": np.mean(days[-7:]), "roll_14_mean": np.mean(days[-14:]), **{c: 1.0 for c in EXOGENOUS}}
            days.append(model["intercept"] + sum(b[place[c]] * v for c, v in inputs.items()))
            assert got[s, k] == pytest.approx(min(max(days[-1], 0), model["most"]), abs=1e-6)


def test_a_broken_model_is_worse_than_the_mean(spark):
    made = forecast_demand(weekly(spark, noise=1.0))
    broken = made.model.withColumn("intercept", F.col("intercept") + 3)
    assert fc.no_worse_than_mean(ridge.evaluate(made.features, broken)).collect() == [(False,)]
    rows = [(1, 1, d, d + 0.5, 2.0, 8) for d in (1.0, 2.0, 3.0)]
    far = spark.createDataFrame(rows, "store_id int, product_id int, demand double, prediction double, level double, n_train int")
    for shift, fine in ((0.0, True), (0.3, True), (0.4, False)):
        assert fc.no_worse_than_mean(ridge.compare(far.withColumn("prediction", F.col("prediction") + shift)), 0.0).collect() == [(fine,)]
