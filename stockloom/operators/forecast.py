"""Seven-day demand forecast with one pooled random forest, hold-out errors and the wide result.

The forest is the alternative to the linear models per series in `ridge`. One model is trained over all rows of
all series, its trees by many tasks (`forest`), instead of one model per series in a loop. A series is told apart by
its mean demand in the training rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockloom.functions.values import half_even
from stockloom.operators import forest
from stockloom.operators.demand import SERIES
from stockloom.operators.series import FEATURES, future_days, last_rows, tail_features
from stockloom.schemas import EXOGENOUS, HORIZON
from stockloom.session import settle

INPUTS = [*FEATURES, "series_level"]


def with_level(features: DataFrame, keys: Sequence[str] = SERIES) -> DataFrame:
    """Add the mean demand of the series over its training rows."""
    whole = Window.partitionBy(*keys)
    return features.withColumn("series_level", F.avg(F.when(F.col("is_train"), F.col("demand"))).over(whole))


#: Training rows a leaf has at least. Leaves of single rows repeat the noise of the demand; trees with larger ones are
#: better on left-out days, small enough to be sent with the tasks, and much faster to grow.
LEAF_ROWS = 250


def fit_forest(
    features: DataFrame, trees: int = 300, depth: int = 15, seed: int = 42, leaf: int = LEAF_ROWS, keys: Sequence[str] = SERIES
) -> forest.Forest:
    """Train on all rows of the training part. Every split may use every feature."""
    rows = settle(features.where("is_train").select(*keys, "dt", "demand", *INPUTS))
    return forest.fit(rows, INPUTS, "demand", keys, "dt", trees, depth, leaf, seed)


def predict_holdout(features: DataFrame, model: forest.Forest) -> DataFrame:
    return forest.predict(features.where("NOT is_train"), model, INPUTS)


def no_worse_than_mean(metrics: DataFrame, slack: float = 0.01) -> DataFrame:
    """One row (`no_worse`): whether the squared error over all series together is below that of the training
    means, or its root above theirs by no more than the share `slack`."""
    ours, theirs = (F.sum(F.pow(c, F.lit(2.0)) * F.col("n_test")) for c in ("RMSE", "mean_RMSE"))
    return metrics.agg((F.sqrt(ours) <= (1 + slack) * F.sqrt(theirs)).alias("no_worse"))


def errors(predicted: DataFrame, keys: Sequence[str] = SERIES) -> DataFrame:
    """Mean absolute and root mean squared error per series, from (demand, prediction)."""
    miss = F.col("prediction") - F.col("demand")
    return predicted.groupBy(*keys).agg(
        F.avg(F.abs(miss)).alias("MAE"), F.sqrt(F.avg(miss * miss)).alias("RMSE"), F.count("*").alias("n_test")
    )


def evaluate(features: DataFrame, model: forest.Forest, keys: Sequence[str] = SERIES) -> DataFrame:
    """(keys…, MAE, RMSE, mean_MAE, mean_RMSE, n_train, n_test): errors of the forest and of the training mean."""
    sizes = features.where("is_train").groupBy(*keys).agg(F.count("*").alias("n_train"))
    predicted = settle(predict_holdout(features, model).select(*keys, "demand", "prediction", "series_level"))
    level = errors(predicted.withColumn("prediction", F.col("series_level")), keys)
    plain = level.select(*keys, F.col("MAE").alias("mean_MAE"), F.col("RMSE").alias("mean_RMSE"))
    return errors(predicted, keys).join(plain, list(keys)).join(sizes, list(keys)).select(
        *keys, "MAE", "RMSE", "mean_MAE", "mean_RMSE", "n_train", "n_test"
    )


def starting_state(features: DataFrame, keys: Sequence[str] = SERIES) -> DataFrame:
    """Per series: last day, the last 14 demands, the mean context of its last 7 rows, and its level."""
    tail_rows = last_rows(features.select(*keys, "dt", "demand", "series_level", *EXOGENOUS), 14, keys)
    history = F.array_sort(F.collect_list(F.struct("dt", "demand")))  # 14 rows per series
    recent = Window.partitionBy(*keys).orderBy(F.desc("dt"))
    ranked = tail_rows.withColumn("_back", F.row_number().over(recent))
    context = [F.avg(F.when(F.col("_back") <= 7, F.col(c))).alias(c) for c in EXOGENOUS]
    return ranked.groupBy(*keys).agg(
        F.max("dt").alias("last_day"),
        F.transform(history, lambda p: p["demand"]).alias("tail"),
        F.max("series_level").alias("series_level"),
        *context,
    )


def forecast(
    features: DataFrame, model: forest.Forest, horizon: int = HORIZON, keys: Sequence[str] = SERIES
) -> DataFrame:
    """(horizon_day, date, forecast_demand, keys…): each predicted day is history for the next one.

    The state has one row per series and every step is a projection of it, so the steps need no shuffle
    and no stored state; their number is the fixed horizon.
    """
    state = starting_state(features, keys)
    for step in range(1, horizon + 1):
        day = F.date_add("last_day", step)
        inputs = state.withColumns(
            {"dayofweek": F.weekday(day), "month": F.month(day), **tail_features(F.col("tail"))}
        )
        scored = forest.predict(inputs, model, INPUTS)
        longer = F.concat("tail", F.array("prediction"))
        state = scored.withColumn("tail", longer).drop("prediction", *tail_features(F.col("tail")), "dayofweek", "month")
    ahead = future_days(state, horizon)
    value = F.element_at("tail", F.size("tail") - horizon + F.col("horizon_day"))
    return ahead.select("horizon_day", "date", value.alias("forecast_demand"), *keys)


def to_wide(long: DataFrame, horizon: int = HORIZON, keys: Sequence[str] = SERIES) -> DataFrame:
    """One column per day ahead (`day+1` …), rounded to 3 digits."""
    days = list(range(1, horizon + 1))
    wide = long.groupBy(*keys).pivot("horizon_day", days).agg(F.avg("forecast_demand"))
    return wide.select(*keys, *[half_even(F.col(f"`{d}`"), 3).alias(f"day+{d}") for d in days])


def store_total(long: DataFrame) -> DataFrame:
    """Forecast per store and date over all its products."""
    return long.groupBy("store_id", "date").agg(F.sum("forecast_demand").alias("total_forecast"))


def store_matrix(wide: DataFrame, store_id: int) -> DataFrame:
    """The product × day table of one store."""
    return wide.where(F.col("store_id") == store_id).drop("store_id")


@dataclass(frozen=True)
class Forecast:
    long: DataFrame
    metrics: DataFrame
    model: DataFrame | forest.Forest
    features: DataFrame
