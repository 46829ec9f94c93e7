"""Daily series: gap-free calendar, fills, lags, rolling means, splits and feature tables.

Every window here is over one (store, product) series after the rows have been summed per day, so a
group never has more rows than there are days in the calendar, however many raw rows its key has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockloom.operators.demand import SERIES
from stockloom.schemas import EXOGENOUS

MIN_ROWS = 60
TRAIN_SHARE = 0.8
FEATURES = ["dayofweek", "month", *EXOGENOUS, "lag_1", "lag_7", "roll_7_mean", "roll_14_mean"]


def daily_with_context(demand: DataFrame, keys: Sequence[str] = SERIES) -> DataFrame:
    """Demand and the seven context columns per series and day."""
    flags = {"holiday_flag", "activity_flag"}
    context = [(F.max(c) if c in flags else F.avg(c)).alias(c) for c in EXOGENOUS]
    return (
        demand.dropna(subset=["dt", "sale_amount", *keys])
        .groupBy(*keys, "dt")
        .agg(F.sum("sale_amount").alias("demand"), *context)
    )


def top_products(demand: DataFrame, n: int = 50) -> DataFrame:
    """The n best-selling products of each store, with their totals and ranks.

    Sales are summed per store and product first; the rank filter then drops all but n rows per store
    and task before the shuffle.
    """
    totals = demand.dropna(subset=["store_id", "product_id"]).groupBy(*SERIES).agg(F.sum("sale_amount").alias("total_sales"))
    best = Window.partitionBy("store_id").orderBy(F.desc("total_sales"), "product_id")
    return totals.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= n)


def dense_calendar(daily: DataFrame, keys: Sequence[str] = SERIES, day: str = "dt") -> DataFrame:
    """All days from the first to the last of each series; demand is 0 on added days, context is null.

    Added days are generated from each row and its successor, so the calendar needs no join: one sort
    per series, shared with the windows that follow.
    """
    keys = list(keys)
    following = F.lead(day).over(Window.partitionBy(*keys).orderBy(day))
    until = F.coalesce(F.date_sub(following, 1), F.col(day))
    context = [c for c in daily.columns if c not in (*keys, day, "demand")]
    spread = daily.withColumn("_until", until).withColumn("_day", F.explode(F.sequence(F.col(day), F.col("_until"))))
    own = F.col("_day") == F.col(day)
    return spread.select(
        *keys,
        F.col("_day").alias(day),
        F.when(own, F.coalesce("demand", F.lit(0.0))).otherwise(F.lit(0.0)).alias("demand"),
        *[F.when(own, F.col(c)).alias(c) for c in context],
    )


def fill_context(
    dense: DataFrame, columns: Sequence[str] = EXOGENOUS, keys: Sequence[str] = SERIES, day: str = "dt"
) -> DataFrame:
    """Fill missing values forward, then backward, within each series.

    A value still missing afterwards means the series has none at all, so its mean is missing too.
    """
    order = Window.partitionBy(*keys).orderBy(day)
    before = order.rowsBetween(Window.unboundedPreceding, 0)
    # Only the rows before the first known value are left for the backward fill: that value fills them all.
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    filled = {
        c: F.coalesce(
            F.last(c, ignorenulls=True).over(before).cast("double"),
            F.first(c, ignorenulls=True).over(whole).cast("double"),
        )
        for c in columns
    }
    return dense.withColumns(filled)


def _rolling_mean(value: str, order: Window, days: int, ending: int) -> Column:
    frame = order.rowsBetween(ending - days + 1, ending)
    full = F.count(value).over(frame) == days
    return F.when(full, F.avg(value).over(frame))


def lags_and_means(
    dense: DataFrame, keys: Sequence[str] = SERIES, day: str = "dt", include_current: bool = True
) -> DataFrame:
    """Demand 1 and 7 days back, and means over 7 and 14 days, null until enough days exist.

    `include_current=True` lets the means end at the row itself. A model that predicts the row must not
    see it, so the feature table uses means that end one row earlier.
    """
    order = Window.partitionBy(*keys).orderBy(day)
    ending = 0 if include_current else -1
    return dense.withColumns(
        {
            "lag_1": F.lag("demand", 1).over(order),
            "lag_7": F.lag("demand", 7).over(order),
            "roll_7_mean": _rolling_mean("demand", order, 7, ending),
            "roll_14_mean": _rolling_mean("demand", order, 14, ending),
        }
    )


def feature_table(
    daily: DataFrame,
    keys: Sequence[str] = SERIES,
    min_rows: int = MIN_ROWS,
    include_current: bool = False,
    train_share: float = TRAIN_SHARE,
) -> DataFrame:
    """Model input: calendar, context, lags and means; complete rows of series with enough of them.

    `part` numbers the rows of a series, and `is_train` marks its first 80 percent.
    """
    keys = list(keys)
    dense = fill_context(dense_calendar(daily, keys), EXOGENOUS, keys)
    shaped = lags_and_means(dense, keys, include_current=include_current).withColumns(
        {"dayofweek": F.weekday("dt"), "month": F.month("dt")}
    )
    usable = shaped.dropna(subset=[*FEATURES, "demand"])
    whole = Window.partitionBy(*keys)
    return (
        usable.withColumns(
            {"n_rows": F.count("*").over(whole), "part": F.row_number().over(whole.orderBy("dt"))}
        )
        .where(F.col("n_rows") >= min_rows)
        .withColumn("is_train", F.col("part") <= F.floor(F.col("n_rows") * F.lit(train_share)))
    )


def last_rows(df: DataFrame, n: int, keys: Sequence[str] = SERIES, day: str = "dt") -> DataFrame:
    """The last n rows of each series."""
    latest = Window.partitionBy(*keys).orderBy(F.desc(day))
    return df.withColumn("_back", F.row_number().over(latest)).where(F.col("_back") <= n).drop("_back")


def first_rows(df: DataFrame, n: int, keys: Sequence[str] = SERIES, day: str = "dt") -> DataFrame:
    """The first n rows of each series."""
    earliest = Window.partitionBy(*keys).orderBy(day)
    return df.withColumn("_place", F.row_number().over(earliest)).where(F.col("_place") <= n).drop("_place")


def history_tail(df: DataFrame, n: int = 14, keys: Sequence[str] = SERIES, day: str = "dt") -> DataFrame:
    """The last n demand values of each series as an array, oldest first, with the last day."""
    kept = last_rows(df.select(*keys, day, "demand"), n, keys, day)
    pairs = F.array_sort(F.collect_list(F.struct(day, "demand")))
    return kept.groupBy(*keys).agg(
        F.max(day).alias("last_day"), F.transform(pairs, lambda p: p["demand"]).alias("tail")
    )


def future_days(tails: DataFrame, horizon: int = 7, last_day: str = "last_day") -> DataFrame:
    """One row per series and day ahead."""
    steps = tails.withColumn("horizon_day", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    return steps.withColumn("date", F.date_add(last_day, F.col("horizon_day")))


def tail_features(tail: Column) -> dict[str, Column]:
    """Lags and means for the day after the end of an array of past demand."""

    def mean_of(days: int) -> Column:
        held = F.slice(tail, F.greatest(F.lit(1), F.size(tail) - days + 1), F.lit(days))
        return F.aggregate(held, F.lit(0.0), lambda total, x: total + x) / F.size(held)

    return {
        "lag_1": F.element_at(tail, -1),
        "lag_7": F.element_at(tail, -7),
        "roll_7_mean": mean_of(7),
        "roll_14_mean": mean_of(14),
    }
