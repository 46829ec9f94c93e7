"""One linear demand model per series, from sums, and its forecast in closed form.

All a least-squares fit needs of the training rows of a series are counts, sums and sums of products. One grouped
aggregation takes them for all series at once, with partial sums before the shuffle; what is left is a small
system of equations per series, solved in batches. A ridge penalty shrinks the coefficients. The sums are kept for
FOLDS consecutive parts of a series, so a model without one part, and its error on that part, follow from sums, too:
the penalty with the least such error is chosen. One that does not beat the training mean in every part is out, so a
series whose demand does not follow its inputs is forecast by its level.

A forecast day is linear in the 14 days before it, so a step is a matrix (shift by a day, append the new value)
and seven steps are its powers: the whole horizon is one projection of the last days of a series.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from stockloom.operators.demand import SERIES
from stockloom.operators.forecast import starting_state
from stockloom.operators.series import FEATURES, TRAIN_SHARE, future_days
from stockloom.schemas import EXOGENOUS, HORIZON

PENALTIES = (1e-3, 1e-2, 1e-1, 1.0, 10.0, 100.0, np.inf)  # the last one leaves the mean
FOLDS = 5
#: Inputs are used only where they lower the error of left-out folds to this share of the mean's.
GAIN = 0.99
HISTORY = 14
CALENDAR = ("dayofweek", "month")


def training_sums(features: DataFrame, inputs: Sequence[str] = FEATURES, keys: Sequence[str] = SERIES) -> DataFrame:
    """Per series: `most` (largest demand) and FOLDS consecutive parts of its training rows, each with `n`, `sums` of the
    inputs and the demand, and `products` of all pairs of them."""
    columns = [F.col(c).cast("double") for c in (*inputs, "demand")]
    pairs = [(i, j) for i in range(len(columns)) for j in range(i + 1)]
    fold = F.least(F.lit(FOLDS - 1), F.floor((F.col("part") - 1) * FOLDS / F.greatest(F.col("n_rows") * TRAIN_SHARE, F.lit(1.0))))
    parts = features.where("is_train").groupBy(*keys, fold.cast("int").alias("fold")).agg(
        F.count("*").alias("n"), F.max("demand").alias("most"),
        *[F.sum(c).alias(f"_s{i}") for i, c in enumerate(columns)],
        *[F.sum(columns[i] * columns[j]).alias(f"_p{i}_{j}") for i, j in pairs],
    )
    packed = F.struct(
        "fold", F.col("n").cast("double").alias("n"), F.array(*[f"_s{i}" for i in range(len(columns))]).alias("sums"),
        F.array(*[f"_p{i}_{j}" for i, j in pairs]).alias("products"),
    )
    return parts.groupBy(*keys).agg(F.max("most").alias("most"), F.collect_list(packed).alias("folds"))  # FOLDS rows at most


def unpacked(products: np.ndarray, size: int) -> np.ndarray:
    """Symmetric matrices from their lower halves."""
    low = np.tril_indices(size)
    full = np.zeros((*products.shape[:-1], size, size))
    full[..., low[0], low[1]] = products
    full[..., low[1], low[0]] = products
    return full


def shrunk(n: np.ndarray, sums: np.ndarray, full: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(intercepts, coefficients) of many series for each of PENALTIES, from their sums."""
    means = sums / np.maximum(n, 1)[:, None]
    spread = full - n[:, None, None] * means[:, :, None] * means[:, None, :]
    own = np.einsum("kii->ki", spread)
    known = own > 1e-10 * np.maximum(np.einsum("kii->ki", full), 1e-300)  # an input that never changes says nothing
    scale = np.sqrt(np.where(known, own, 1.0))
    correlation = spread / (scale[:, :, None] * scale[:, None, :]) * (known[:, :, None] & known[:, None, :])
    values, vectors = np.linalg.eigh(correlation[:, :-1, :-1])
    values = np.maximum(values, 0)
    along = np.einsum("kij,ki->kj", vectors, correlation[:, :-1, -1])
    beta = np.stack([np.einsum("kij,kj->ki", vectors, along / (values + penalty)) for penalty in PENALTIES])
    coefficients = beta * scale[:, -1:] / scale[:, :-1] * known[:, :-1] * known[:, -1:]
    return means[:, -1] - (coefficients * means[:, :-1]).sum(-1), coefficients


def squared_error(intercept: np.ndarray, coefficients: np.ndarray, n: np.ndarray, sums: np.ndarray, full: np.ndarray) -> np.ndarray:
    """The sum of squared errors of models on rows known by their sums only."""
    weights = np.concatenate([-coefficients, np.ones((*coefficients.shape[:-1], 1))], axis=-1)
    return (
        np.einsum("...ki,kij,...kj->...k", weights, full, weights)
        - 2 * intercept * np.einsum("...ki,ki->...k", weights, sums) + n * intercept**2
    )


def solve(n: np.ndarray, sums: np.ndarray, products: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(intercepts, coefficients, penalties) of many series from the sums of their folds: (series, fold, …)."""
    full = unpacked(products, sums.shape[-1])
    whole = n.sum(1), sums.sum(1), full.sum(1)
    missed = []
    for k in range(n.shape[1]):  # leave a fold out, and score the models on it
        others = [a - b for a, b in zip(whole, (n[:, k], sums[:, k], full[:, k]))]
        missed.append(squared_error(*shrunk(*others), n[:, k], sums[:, k], full[:, k]))
    error = np.stack(missed)  # (fold, penalty, series)
    mean = error[:, -1:]
    total = np.where((error <= mean).all(0) & (error.sum(0) <= GAIN * mean.sum(0)), error.sum(0), np.inf)
    total[-1] = mean[:, 0].sum(0)
    best = np.argmin(total, axis=0)
    intercept, coefficients = shrunk(*whole)
    rows = np.arange(len(n))
    return intercept[best, rows], coefficients[best, rows], np.asarray(PENALTIES)[best]


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), -1)


def fit(features: DataFrame, inputs: Sequence[str] = FEATURES, keys: Sequence[str] = SERIES) -> DataFrame:
    """One row per series: `n_train`, `level` (mean demand), `most`, `intercept`, `coefficients` in the order of
    `inputs`, and `penalty`."""
    sums = training_sums(features, inputs, keys)
    key_fields = [sums.schema[k] for k in keys]
    schema = T.StructType([
        *key_fields, T.StructField("n_train", T.LongType()), T.StructField("level", T.DoubleType()), T.StructField("most", T.DoubleType()),
        T.StructField("intercept", T.DoubleType()), T.StructField("coefficients", T.ArrayType(T.DoubleType())),
        T.StructField("penalty", T.DoubleType()),
    ])
    kinds, n_keys = to_arrow_schema(schema), len(key_fields)

    width = len(inputs) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            most, folds = batch.columns[n_keys:]
            row = np.repeat(np.arange(len(folds)), np.asarray(folds.value_lengths()))
            packed = folds.flatten()
            place = row, np.asarray(packed.field("fold"))
            n, sums_, products = (np.zeros((len(folds), FOLDS, *shape)) for shape in ((), (width,), (width * (width + 1) // 2,)))
            n[place] = np.asarray(packed.field("n"))
            sums_[place], products[place] = _matrix(packed.field("sums")), _matrix(packed.field("products"))
            intercept, coefficients, penalty = solve(n, sums_, products)
            count = n.sum(1)
            yield pa.RecordBatch.from_arrays([
                *batch.columns[:n_keys], pa.array(count.astype(np.int64)), pa.array(sums_[:, :, -1].sum(1) / count), most,
                pa.array(intercept), pa.array(list(coefficients), pa.list_(pa.float64())), pa.array(penalty),
            ], schema=kinds)

    return sums.mapInArrow(run, schema)


def _value(inputs: Sequence[str], names: Sequence[str] | None = None) -> Column:
    """Intercept and coefficients applied to the inputs (only those named, if so)."""
    total = F.col("intercept")
    for i, c in enumerate(inputs):
        if names is None or c in names:
            total = total + F.get("coefficients", F.lit(i)) * F.col(c)
    return total


def in_range(value: Column) -> Column:
    """Demand is not negative, and no model knows of more than it has seen."""
    return F.least(F.greatest(value, F.lit(0.0)), F.col("most"))


def predict_holdout(features: DataFrame, models: DataFrame, inputs: Sequence[str] = FEATURES, keys: Sequence[str] = SERIES) -> DataFrame:
    """The rows held out, with `prediction` and the mean of the training rows, `level`."""
    rows = features.where("NOT is_train").select(*keys, "dt", "demand", *inputs).join(models, list(keys))
    return rows.select(*keys, "dt", "demand", "n_train", "level", in_range(_value(inputs)).alias("prediction"))


def evaluate(features: DataFrame, models: DataFrame, inputs: Sequence[str] = FEATURES, keys: Sequence[str] = SERIES) -> DataFrame:
    """(keys…, MAE, RMSE, mean_MAE, mean_RMSE, n_train, n_test): errors of the model and of the training mean."""
    rows = predict_holdout(features, models, inputs, keys)
    return compare(rows, keys)


def compare(predicted: DataFrame, keys: Sequence[str] = SERIES) -> DataFrame:
    """The same from rows that hold `demand`, `prediction`, `level` and `n_train`."""
    miss, plain = F.col("prediction") - F.col("demand"), F.col("level") - F.col("demand")
    return predicted.groupBy(*keys).agg(
        F.avg(F.abs(miss)).alias("MAE"), F.sqrt(F.avg(miss * miss)).alias("RMSE"),
        F.avg(F.abs(plain)).alias("mean_MAE"), F.sqrt(F.avg(plain * plain)).alias("mean_RMSE"),
        F.max("n_train").alias("n_train"), F.count("*").alias("n_test"),
    )


def closed_recursion(response: np.ndarray, given: np.ndarray, history: np.ndarray) -> np.ndarray:
    """The next days of many series. A day is `given` (a column per day ahead) plus `response` · the days before it,
    newest first; every day is one of the days before for the next.

    With the companion matrix C of the responses, day k is the first entry of C^k history + sum_j C^(k-j) given_j e1."""
    n, size = response.shape
    companion = np.zeros((n, size, size))
    companion[:, 0] = response
    companion[:, np.arange(1, size), np.arange(size - 1)] = 1
    power = np.broadcast_to(np.eye(size), companion.shape)
    impulse, from_history = [], []
    for _ in range(given.shape[1]):
        impulse.append(power[:, 0, 0])
        power = power @ companion
        from_history.append(np.einsum("ki,ki->k", power[:, 0], history))
    days = [
        from_history[k] + sum(impulse[k - j] * given[:, j] for j in range(k + 1)) for k in range(given.shape[1])
    ]
    return np.stack(days, axis=1)


def response_of(coefficients: np.ndarray, inputs: Sequence[str] = FEATURES) -> np.ndarray:
    """What each of the last days, newest first, adds to the next one."""
    place = {c: i for i, c in enumerate(inputs)}
    out = np.zeros((len(coefficients), HISTORY))
    for name, days in (("lag_1", [0]), ("lag_7", [6]), ("roll_7_mean", range(7)), ("roll_14_mean", range(14))):
        if name in place:
            for d in days:
                out[:, d] += coefficients[:, place[name]] / len(days)
    return out


def forecast(features: DataFrame, models: DataFrame, horizon: int = HORIZON, keys: Sequence[str] = SERIES) -> DataFrame:
    """(horizon_day, date, forecast_demand, keys…): every series has one row of state and becomes `horizon` rows."""
    keys = list(keys)
    state = starting_state(features.withColumn("series_level", F.lit(None).cast("double")), keys).join(models, keys)
    days = [F.date_add("last_day", k) for k in range(1, horizon + 1)]
    place = {c: i for i, c in enumerate(FEATURES)}
    steady = _value(FEATURES, EXOGENOUS)
    given = F.array(*[
        steady + F.get("coefficients", F.lit(place["dayofweek"])) * F.weekday(d) + F.get("coefficients", F.lit(place["month"])) * F.month(d)
        for d in days
    ])
    state = state.select(*keys, "last_day", "most", "coefficients", given.alias("given"), F.reverse("tail").alias("history"))
    schema = T.StructType([*[state.schema[c] for c in (*keys, "last_day", "most")], T.StructField("ahead", T.ArrayType(T.DoubleType()))])
    kinds, kept = to_arrow_schema(schema), len(keys) + 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            coefficients, given_days, history = map(_matrix, batch.columns[kept:])
            ahead = closed_recursion(response_of(coefficients), given_days, history)
            yield pa.RecordBatch.from_arrays([*batch.columns[:kept], pa.array(list(ahead), pa.list_(pa.float64()))], schema=kinds)

    made = future_days(state.mapInArrow(run, schema), horizon)
    value = in_range(F.get("ahead", F.col("horizon_day") - 1))
    return made.select("horizon_day", "date", value.alias("forecast_demand"), *keys)
