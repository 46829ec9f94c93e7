"""Daily series: calendar, fills, lags, rolling means, ranks and splits."""

from pyspark.sql import functions as F

from catalog.registry import query, r, rounded
from catalog.views import DEMAND, EVENT_SERIES, with_views
from stockloom.operators import demand as dm
from stockloom.operators import series
from stockloom.schemas import EXOGENOUS
from stockloom.sources import domain_views as views
from stockloom.sources import tables

D = with_views(DEMAND)
E = with_views(EVENT_SERIES)
_context = ", ".join(f"{'max' if c in ('holiday_flag', 'activity_flag') else 'avg'}({c}) AS {c}" for c in EXOGENOUS)
DAILY = f"""
daily AS (SELECT store_id, product_id, dt, sum(sale_amount) AS demand, {_context} FROM demand GROUP BY 1, 2, 3)"""
TOP_STORES = """
top_stores AS (SELECT store_id FROM demand GROUP BY 1 ORDER BY sum(sale_amount) DESC, store_id LIMIT 20)"""
TOP_PRODUCTS = """
sales AS (SELECT store_id, product_id, sum(sale_amount) AS total_sales FROM demand GROUP BY 1, 2),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY store_id ORDER BY total_sales DESC, product_id) AS INTEGER) AS "rank"
  FROM sales)"""
# Calendar, fills and features of the best-selling products of the top stores.
PRODUCTS = 50
DENSE = """
chosen AS (SELECT store_id, product_id FROM ranked WHERE "rank" <= 50 AND store_id IN (SELECT store_id FROM top_stores)),
kept AS (SELECT daily.* FROM daily JOIN chosen USING (store_id, product_id)),
calendar AS (SELECT store_id, product_id, CAST(unnest(generate_series(min(dt), max(dt), INTERVAL 1 DAY)) AS DATE) AS dt
  FROM kept GROUP BY 1, 2),
dense AS (SELECT c.store_id, c.product_id, c.dt, coalesce(demand, 0) AS demand, %s
  FROM calendar c LEFT JOIN kept k ON c.store_id = k.store_id AND c.product_id = k.product_id AND c.dt = k.dt)""" % (
    ", ".join(EXOGENOUS)
)
_w = "OVER (PARTITION BY store_id, product_id ORDER BY dt"
FILLED = (
    "\nfilled AS (SELECT store_id, product_id, dt, demand, "
    + ", ".join(f"CAST(last_value({c} IGNORE NULLS) {_w}) AS DOUBLE) AS {c}" for c in EXOGENOUS)
    + " FROM dense)"
)


def _mean(days: int, ending: int, w: str = _w, value: str = "demand") -> str:
    frame = f"{w} ROWS BETWEEN {days - 1 - ending} PRECEDING AND {-ending} FOLLOWING)" if ending >= 0 else ""
    if ending < 0:
        frame = f"{w} ROWS BETWEEN {days - 1 - ending} PRECEDING AND {-ending} PRECEDING)"
    elif ending == 0:
        frame = f"{w} ROWS BETWEEN {days - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count({value}) {frame} = {days} THEN avg({value}) {frame} END"


FEATURES = (
    f"""
shaped AS (SELECT *, CAST(isodow(dt) - 1 AS INTEGER) AS dayofweek, CAST(month(dt) AS INTEGER) AS "month",
  lag(demand, 1) {_w}) AS lag_1, lag(demand, 7) {_w}) AS lag_7,
  {_mean(7, -1)} AS roll_7_mean, {_mean(14, -1)} AS roll_14_mean FROM filled),
usable AS (SELECT * FROM shaped WHERE roll_14_mean IS NOT NULL AND lag_7 IS NOT NULL),
counted AS (SELECT *, count(*) OVER (PARTITION BY store_id, product_id) AS n_rows,
  CAST(row_number() {_w}) AS INTEGER) AS part FROM usable),
features AS (SELECT *, part <= floor(n_rows * 0.8::DOUBLE) AS is_train FROM counted WHERE n_rows >= 60)"""
)
ALL = with_views(DEMAND, DAILY, TOP_STORES, TOP_PRODUCTS, DENSE, FILLED, FEATURES)


def chosen_rows(spark, folder, products: int = PRODUCTS):
    """Demand of the top stores' best-selling products."""
    rows = tables.keep_stores(views.demand(spark, folder), dm.top_stores(views.demand(spark, folder, "store_id", "sale_amount")))
    best = series.top_products(rows.select("store_id", "product_id", "sale_amount"), products)
    return rows.join(best.select(*dm.SERIES), dm.SERIES, "left_semi")


@query("a25_daily_with_context", with_views(DEMAND, DAILY) + "SELECT store_id, product_id, dt, demand, "
       + ", ".join(r(f"CAST({c} AS DOUBLE)", c) for c in EXOGENOUS) + " FROM daily")
def daily_with_context(spark, folder):
    daily = series.daily_with_context(views.demand(spark, folder))
    return rounded(daily.withColumns({c: F.col(c).cast("double") for c in EXOGENOUS}))


@query("w06_top_products", with_views(DEMAND, TOP_PRODUCTS) + 'SELECT * FROM ranked WHERE "rank" <= 50')
def top_products(spark, folder):
    return series.top_products(views.demand(spark, folder, "store_id", "product_id", "sale_amount"), PRODUCTS)


@query("w03_dense_calendar", with_views(DEMAND, DAILY, TOP_STORES, TOP_PRODUCTS, DENSE)
       + "SELECT store_id, product_id, dt, demand, round(discount + 3e-8, 6) AS discount FROM dense")
def dense_calendar(spark, folder):
    daily = series.daily_with_context(chosen_rows(spark, folder)).select(*dm.SERIES, "dt", "demand", "discount")
    return rounded(series.dense_calendar(daily))


@query("w04_filled_context", with_views(DEMAND, DAILY, TOP_STORES, TOP_PRODUCTS, DENSE, FILLED)
       + "SELECT store_id, product_id, dt, demand, " + ", ".join(r(c) for c in EXOGENOUS) + " FROM filled")
def filled_context(spark, folder):
    daily = series.daily_with_context(chosen_rows(spark, folder))
    return rounded(series.fill_context(series.dense_calendar(daily)))


@query(
    "w01_w02_lags_and_means",
    E + f"""SELECT series, dt, demand, lag(demand, 1) OVER (PARTITION BY series ORDER BY dt) AS lag_1,
    lag(demand, 7) OVER (PARTITION BY series ORDER BY dt) AS lag_7,
    {r(_mean(7, 0, 'OVER (PARTITION BY series ORDER BY dt'), 'roll_7_mean')},
    {r(_mean(14, 0, 'OVER (PARTITION BY series ORDER BY dt'), 'roll_14_mean')} FROM event_series""",
)
def lags_and_means(spark, folder):
    made = series.lags_and_means(views.event_series(spark, folder), ["series"])
    return made.withColumns({c: F.round(F.col(c) + 3e-8, 6) for c in ("roll_7_mean", "roll_14_mean")})


@query("w05_last_rows", E + """SELECT series, dt, demand FROM event_series
    QUALIFY row_number() OVER (PARTITION BY series ORDER BY dt DESC) <= 7""")
def last_rows(spark, folder):
    return series.last_rows(views.event_series(spark, folder), 7, ["series"])


@query("p22_first_rows", E + """SELECT series, dt, demand FROM event_series
    QUALIFY row_number() OVER (PARTITION BY series ORDER BY dt) <= 5""")
def first_rows(spark, folder):
    return series.first_rows(views.event_series(spark, folder), 5, ["series"])


@query(
    "w07_w10_split_and_gate",
    ALL + """SELECT store_id, product_id, n_rows, count(*) FILTER (is_train) AS n_train,
    count(*) FILTER (NOT is_train) AS n_test, max(dt) FILTER (is_train) AS last_train_day FROM features GROUP BY 1, 2, 3""",
)
def split_and_gate(spark, folder):
    made = series.feature_table(series.daily_with_context(chosen_rows(spark, folder)))
    return made.groupBy(*dm.SERIES, "n_rows").agg(
        F.count_if("is_train").alias("n_train"),
        F.count_if(~F.col("is_train")).alias("n_test"),
        F.max(F.when(F.col("is_train"), F.col("dt"))).alias("last_train_day"),
    )


@query(
    "w09_w12_tail_and_future",
    E + """, t AS (SELECT series, max(dt) AS last_day, list(demand ORDER BY dt)[-14:] AS tail FROM event_series GROUP BY 1)
    SELECT series, CAST(h AS INTEGER) AS horizon_day, CAST(last_day + CAST(h AS INTEGER) AS DATE) AS "date",
    tail[-1] AS lag_1, tail[-7] AS lag_7, round(list_avg(tail[-7:]) + 3e-8, 6) AS roll_7_mean,
    round(list_avg(tail) + 3e-8, 6) AS roll_14_mean FROM t, generate_series(1, 7) AS g(h)""",
)
def tail_and_future(spark, folder):
    tails = series.history_tail(views.event_series(spark, folder), 14, ["series"])
    ahead = series.future_days(tails).withColumns(series.tail_features(F.col("tail")))
    shown = {c: F.round(F.col(c) + 3e-8, 6) for c in ("roll_7_mean", "roll_14_mean")}
    return ahead.drop("tail", "last_day").withColumns(shown)


@query(
    "m03_feature_table",
    ALL + "SELECT store_id, product_id, dt, demand, n_rows, part, is_train, "
    + ", ".join(r(c) if c not in ("dayofweek", "month") else f'"{c}"' for c in series.FEATURES) + " FROM features",
)
def feature_table(spark, folder):
    return rounded(series.feature_table(series.daily_with_context(chosen_rows(spark, folder))))
