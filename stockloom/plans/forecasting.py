"""From raw demand to a seven-day forecast with its hold-out errors."""

from __future__ import annotations

from pyspark.sql import DataFrame

from stockloom.operators import demand as dm
from stockloom.operators import forecast as fc
from stockloom.operators import ridge, series
from stockloom.session import settle
from stockloom.sources.tables import keep_stores


def chosen_demand(demand: DataFrame, stores: int = 20, products: int = 50) -> DataFrame:
    """Demand of the best-selling products of the top stores."""
    usable = demand.dropna(subset=["dt", "sale_amount"])
    rows = keep_stores(usable, dm.top_stores(usable, stores))
    best = series.top_products(rows, products)
    return rows.join(best.select(*dm.SERIES), dm.SERIES, "left_semi")


def daily_features(demand: DataFrame, stores: int = 20, products: int = 50, min_rows: int = series.MIN_ROWS) -> DataFrame:
    """The feature table of the chosen series, stored once: training, scoring and the recursion read it."""
    daily = series.daily_with_context(chosen_demand(demand, stores, products))
    return settle(series.feature_table(daily, min_rows=min_rows))


def forecast_demand(demand: DataFrame, stores: int = 20, products: int = 50, min_rows: int = series.MIN_ROWS) -> fc.Forecast:
    """A linear model per series."""
    return _linear(daily_features(demand, stores, products, min_rows))


def _linear(features: DataFrame) -> fc.Forecast:
    models = settle(ridge.fit(features))
    return fc.Forecast(ridge.forecast(features, models), ridge.evaluate(features, models), models, features)


def forecast_with_forest(
    demand: DataFrame, stores: int = 20, products: int = 50, trees: int = 300, depth: int = 15, leaf: int = fc.LEAF_ROWS,
    min_rows: int = series.MIN_ROWS,
) -> fc.Forecast:
    """One forest over all series."""
    return _forest(daily_features(demand, stores, products, min_rows), trees, depth, leaf)


def _forest(features: DataFrame, trees: int = 300, depth: int = 15, leaf: int = fc.LEAF_ROWS) -> fc.Forecast:
    features = fc.with_level(features)
    model = fc.fit_forest(features, trees, depth, leaf=leaf)
    return fc.Forecast(fc.forecast(features, model), fc.evaluate(features, model), model, features)


def forecast_both(
    demand: DataFrame, stores: int = 20, products: int = 50, trees: int = 300, depth: int = 15, leaf: int = fc.LEAF_ROWS,
    min_rows: int = series.MIN_ROWS,
) -> tuple[fc.Forecast, fc.Forecast]:
    """Both, over one stored feature table."""
    features = daily_features(demand, stores, products, min_rows)
    return _linear(features), _forest(features, trees, depth, leaf)
