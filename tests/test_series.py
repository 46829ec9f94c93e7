import datetime as dt

from pyspark.sql import functions as F

from stockloom.operators import series
from stockloom.schemas import EXOGENOUS


def daily(spark, rows):
    """rows: (store, product, day offset, demand, temperature)"""
    start = dt.date(2024, 1, 1)
    df = spark.createDataFrame(
        [(s, p, start + dt.timedelta(days=d), y, t) for s, p, d, y, t in rows],
        "store_id int, product_id int, dt date, demand double, avg_temperature double",
    )
    return df.withColumns({c: F.lit(1.0) for c in EXOGENOUS if c != "avg_temperature"})


def test_calendar_has_no_gaps(spark):
    got = series.dense_calendar(daily(spark, [(1, 1, 0, 2.0, 5.0), (1, 1, 3, 4.0, 6.0), (2, 1, 9, 1.0, 7.0)])).orderBy("store_id", "dt").collect()
    assert [(r["store_id"], r["dt"].day, r["demand"], r["avg_temperature"]) for r in got] == [
        (1, 1, 2.0, 5.0), (1, 2, 0.0, None), (1, 3, 0.0, None), (1, 4, 4.0, 6.0), (2, 10, 1.0, 7.0)
    ]


def test_fill_forward_then_backward(spark):
    rows = [(1, 1, 0, 1.0, None), (1, 1, 2, 1.0, 3.0), (1, 1, 4, 1.0, None), (1, 1, 5, 1.0, 8.0), (2, 1, 0, 1.0, None)]
    filled = series.fill_context(series.dense_calendar(daily(spark, rows))).orderBy("store_id", "dt").collect()
    assert [r["avg_temperature"] for r in filled] == [3.0, 3.0, 3.0, 3.0, 3.0, 8.0, None]


def test_rolling_means_need_full_windows(spark):
    df = daily(spark, [(1, 1, d, float(d), 1.0) for d in range(20)])
    got = series.lags_and_means(df).orderBy("dt").collect()
    assert sum(r["roll_7_mean"] is None for r in got) == 6 and sum(r["roll_14_mean"] is None for r in got) == 13
    assert got[10]["lag_1"] == 9.0 and got[10]["lag_7"] == 3.0 and got[10]["roll_7_mean"] == 7.0
    before = series.lags_and_means(df, include_current=False).orderBy("dt").collect()
    assert before[10]["roll_7_mean"] == 6.0 and sum(r["roll_14_mean"] is None for r in before) == 14


def test_gate_and_split(spark):
    # With means that include the row itself, 13 rows are lost: 73 days leave 60, 72 leave 59.
    df = daily(spark, [(1, 1, d, 1.0, 1.0) for d in range(73)] + [(2, 1, d, 1.0, 1.0) for d in range(72)])
    got = series.feature_table(df, include_current=True)
    assert got.groupBy("store_id").agg(F.count("*"), F.count_if("is_train")).collect()[0][:] == (1, 60, 48)


def test_top_products_per_store(spark):
    df = spark.createDataFrame([(1, 7, 2.0), (1, 3, 2.0), (1, 9, 1.0), (2, 9, 4.0)], "store_id int, product_id int, sale_amount double")
    got = {(r["store_id"], r["product_id"], r["rank"]) for r in series.top_products(df, 2).collect()}
    assert got == {(1, 3, 1), (1, 7, 2), (2, 9, 1)}


def test_tail_features(spark):
    df = spark.createDataFrame([([float(x) for x in range(1, 21)],)], "tail array<double>")
    got = df.withColumns(series.tail_features(F.col("tail"))).first()
    assert (got["lag_1"], got["lag_7"], got["roll_7_mean"], got["roll_14_mean"]) == (20.0, 14.0, 17.0, 13.5)


def test_forecast_feeds_predictions_back(spark):
    from stockloom.operators import forecast as fc
    from stockloom.plans.forecasting import forecast_with_forest

    rows = [(s, 1, dt.date(2024, 1, 1) + dt.timedelta(days=d), float(s * 10 + d % 7)) for s in (1, 2) for d in range(100)]
    df = spark.createDataFrame(rows, "store_id int, product_id int, dt date, sale_amount double").withColumns(
        {c: F.lit(1.0) for c in EXOGENOUS}
    )
    made = forecast_with_forest(df, trees=8, depth=6, leaf=1)
    long = made.long.orderBy("store_id", "horizon_day").collect()
    assert [r["horizon_day"] for r in long] == [*range(1, 8)] * 2
    assert str(long[0]["date"]) == "2024-04-10"
    for r in long:
        weekday = (99 + r["horizon_day"]) % 7
        assert abs(r["forecast_demand"] - (r["store_id"] * 10 + weekday)) < 2.5
    metrics = made.metrics.collect()
    assert {(r["n_train"], r["n_test"]) for r in metrics} == {(68, 18)} and all(r["RMSE"] >= r["MAE"] >= 0 for r in metrics)
    wide = fc.to_wide(made.long)
    assert wide.columns == ["store_id", "product_id", *[f"day+{i}" for i in range(1, 8)]] and wide.count() == 2
    assert fc.store_matrix(wide, 2).count() == 1
