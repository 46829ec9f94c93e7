"""Forecast queries: the model itself, and the result tables checked on a forecast SQL can express."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from catalog.registry import query, r, rounded
from catalog.series_queries import ALL, DAILY, _mean
from catalog.views import DEMAND, EVENT_SERIES, with_views
from stockloom.operators import demand as dm
from stockloom.operators import forecast as fc
from stockloom.operators import series
from stockloom.plans.forecasting import forecast_both, forecast_demand, forecast_with_forest
from stockloom.session import settle
from stockloom.sources import domain_views as views

# The last seven selling days of every series, repeated.
NAIVE = """
tails AS (SELECT store_id, product_id, dt, demand, CAST(8 - row_number() OVER (PARTITION BY store_id, product_id ORDER BY dt DESC) AS INTEGER) AS horizon_day,
  max(dt) OVER (PARTITION BY store_id, product_id) AS last_day FROM daily),
naive AS (SELECT store_id, product_id, horizon_day, CAST(last_day + horizon_day AS DATE) AS "date", demand / 3 AS forecast_demand
  FROM tails WHERE horizon_day >= 1)"""
N = with_views(DEMAND, DAILY, NAIVE)


def naive(spark, folder):
    daily = series.daily_with_context(views.demand(spark, folder)).select(*dm.SERIES, "dt", "demand")
    latest = Window.partitionBy(*dm.SERIES).orderBy(F.desc("dt"))
    last = F.max("dt").over(Window.partitionBy(*dm.SERIES))
    tail = series.last_rows(daily.withColumns({"horizon_day": 8 - F.row_number().over(latest), "last_day": last}), 7)
    return tail.select(
        *dm.SERIES, "horizon_day", F.date_add("last_day", F.col("horizon_day")).alias("date"),
        (F.col("demand") / 3).alias("forecast_demand"),
    )


@query("a27_wide_forecast", N + "SELECT store_id, product_id, " + ", ".join(
    f'round_even(avg(forecast_demand) FILTER (horizon_day = {d}), 3) AS "day+{d}"' for d in range(1, 8)
) + " FROM naive GROUP BY 1, 2")
def wide_forecast(spark, folder):
    return fc.to_wide(naive(spark, folder))


@query("a32_store_forecast_total", N + f"""SELECT store_id, "date", {r('sum(forecast_demand)', 'total_forecast')}
    FROM naive GROUP BY 1, 2""")
def store_forecast_total(spark, folder):
    return rounded(fc.store_total(naive(spark, folder)))


@query("a43_store_matrix", N + "SELECT product_id, " + ", ".join(
    f'round_even(avg(forecast_demand) FILTER (horizon_day = {d}), 3) AS "day+{d}"' for d in range(1, 8)
) + " FROM naive WHERE store_id = 1 GROUP BY 1")
def store_matrix(spark, folder):
    return fc.store_matrix(fc.to_wide(naive(spark, folder)), 1)


@query("p12_weekly_total", N + f"""SELECT store_id, product_id, {r('sum(round_even(forecast_demand, 3))', 'total_demand_7d')}
    FROM naive GROUP BY 1, 2""")
def weekly_total(spark, folder):
    from stockloom.functions.values import horizontal_sum

    wide = fc.to_wide(naive(spark, folder))
    total = horizontal_sum([f"day+{d}" for d in range(1, 8)])
    return rounded(wide.select(*dm.SERIES, total.alias("total_demand_7d")))


@query(
    "a38_forecast_errors",
    with_views(EVENT_SERIES) + f""", p AS (SELECT series, demand,
    {_mean(7, -1, 'OVER (PARTITION BY series ORDER BY dt')} AS prediction FROM event_series)
    SELECT series, {r('avg(abs(prediction - demand))', '"MAE"')}, {r('sqrt(avg((prediction - demand) * (prediction - demand)))', '"RMSE"')},
    count(*) AS n_test FROM p WHERE prediction IS NOT NULL GROUP BY 1""",
)
def forecast_errors(spark, folder):
    rows = series.lags_and_means(views.event_series(spark, folder), ["series"], include_current=False)
    predicted = rows.withColumn("prediction", F.col("roll_7_mean")).dropna(subset=["prediction"])
    return rounded(fc.errors(predicted, ["series"]))


def in_range(made, spark, folder):
    """Whether every forecast is a demand that can be: not negative, not above the highest one of any day."""
    top = views.demand(spark, folder, "store_id", "product_id", "dt", "sale_amount").groupBy("store_id", "product_id", "dt").agg(
        F.sum("sale_amount").alias("demand")
    ).agg(F.max("demand").alias("most"))
    fits = F.col("forecast_demand").between(0, F.col("most"))
    return made.long.join(F.broadcast(top)).select(*dm.SERIES, "horizon_day", "date", fits.alias("in_range"))


FORECAST = ALL + """, ends AS (SELECT store_id, product_id, max(dt) AS last_day FROM features GROUP BY 1, 2)
    SELECT store_id, product_id, CAST(h AS INTEGER) AS horizon_day, CAST(last_day + CAST(h AS INTEGER) AS DATE) AS "date",
    true AS in_range FROM ends, generate_series(1, 7) AS g(h)"""
METRICS = ALL + f""", levels AS (SELECT store_id, product_id, avg(demand) AS level FROM features WHERE is_train GROUP BY 1, 2)
    SELECT store_id, product_id, count(*) FILTER (is_train) AS n_train, count(*) FILTER (NOT is_train) AS n_test,
    {r('avg(abs(demand - level)) FILTER (NOT is_train)', '"mean_MAE"')},
    {r('sqrt(avg((demand - level) * (demand - level)) FILTER (NOT is_train))', '"mean_RMSE"')},
    true AS consistent, true AS no_worse FROM features JOIN levels USING (store_id, product_id) GROUP BY 1, 2"""


def checked_metrics(made, slack):
    """(store_id, product_id, n_train, n_test, mean_MAE, mean_RMSE, consistent, no_worse). Errors of every series on its own last fifth, next to those of its training mean, which SQL states. `consistent`:
    they are errors of values in the range of the demands, the squared one not below the absolute one. `no_worse`:
    over all series together the model's squared error is not above that of the means, but for a small share."""
    metrics = settle(made.metrics)
    top = made.features.agg(F.max("demand").alias("most"))
    consistent = (F.col("MAE") >= 0) & (F.col("RMSE") >= F.col("MAE") - 1e-9) & (F.col("RMSE") <= F.col("most"))
    rows = metrics.join(F.broadcast(top)).select(
        *dm.SERIES, "n_train", "n_test", "mean_MAE", "mean_RMSE", consistent.alias("consistent"))
    return rounded(rows.join(F.broadcast(fc.no_worse_than_mean(metrics, slack))))


@query("m02_m04_forecast", FORECAST)
def forecast(spark, folder):
    """Every series has a value for each of the seven days after its last one. What a model predicts is beyond SQL;
    that it lies in the range of the demands is not."""
    return in_range(forecast_demand(views.demand(spark, folder)), spark, folder)


@query("m05_forecast_metrics", METRICS)
def forecast_metrics(spark, folder):
    """Errors of both models on the same rows: the linear one of every series, and the forest at its full size. `consistent` and
    `no_worse` hold where they do for both."""
    linear, forest = forecast_both(views.demand(spark, folder))
    ours = checked_metrics(linear, 0.01)
    theirs = checked_metrics(forest, 0.05).select(*dm.SERIES, F.col("consistent").alias("_consistent"), F.col("no_worse").alias("_no_worse"))
    both = {c: F.col(c) & F.coalesce(F.col(f"_{c}"), F.lit(False)) for c in ("consistent", "no_worse")}
    return ours.join(theirs, dm.SERIES, "left").withColumns(both).select(*ours.columns)


@query("m02_forest_forecast", FORECAST)
def forest_forecast(spark, folder):
    """The same by one forest of 300 trees of depth 15 over all series."""
    return in_range(forecast_with_forest(views.demand(spark, folder)), spark, folder)


@query("m05_forest_metrics", METRICS)
def forest_metrics(spark, folder):
    return checked_metrics(forecast_with_forest(views.demand(spark, folder)), 0.05)
