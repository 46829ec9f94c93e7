"""Scans, cleaning, profiling and preparation queries."""

from pyspark.sql import functions as F

from catalog.registry import query, r, rounded
from catalog.views import DEMAND, LOGISTICS, PARAMS, SERIES_DAY, with_views
from stockloom.functions import values
from stockloom.operators import demand as dm
from stockloom.operators import profile, quantiles
from stockloom.sources import domain_views as views
from stockloom.sources import tables

NUMBERS = [
    "historical_demand", "warehouse_inventory_level", "shipping_costs", "lead_time_days",
    "delivery_time_deviation", "delay_probability", "disruption_likelihood_score", "route_risk_level",
    "weather_condition_severity", "traffic_congestion_level", "port_congestion_level",
]
KEY_METRICS = [
    "warehouse_inventory_level", "lead_time_days", "shipping_costs", "delay_probability", "delivery_time_deviation",
]
D = with_views(DEMAND)
L = with_views(LOGISTICS)
P = with_views(DEMAND, SERIES_DAY, PARAMS)


def params(spark, folder):
    return dm.series_params(dm.series_day(views.demand(spark, folder)))


def _describe_sql(source: str, columns: list[str], by: str = "") -> str:
    lead = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    return " UNION ALL ".join(
        f"""SELECT {lead}'{c}' AS "column", CAST(count({c}) AS BIGINT) AS "count", round(avg({c}) + 3e-8, 6) AS mean,
            round(stddev_samp({c}) + 3e-8, 6) AS std, round(CAST(min({c}) AS DOUBLE) + 3e-8, 6) AS "min",
            round(quantile_cont({c}, 0.25) + 3e-8, 6) AS q25, round(quantile_cont({c}, 0.5) + 3e-8, 6) AS q50,
            round(quantile_cont({c}, 0.75) + 3e-8, 6) AS q75, round(CAST(max({c}) AS DOUBLE) + 3e-8, 6) AS "max"
            FROM {source} {group}"""
        for c in columns
    )


# ---- Scans and row-level operators ----


@query(
    "p01_calendar_and_status",
    L + """SELECT "timestamp", "date", CAST(hour("timestamp") AS INTEGER) AS "hour",
    CAST(isodow("timestamp") - 1 AS INTEGER) AS dayofweek, CAST(month("timestamp") AS INTEGER) AS "month",
    warehouse_inventory_level - historical_demand AS inventory_gap,
    CASE WHEN warehouse_inventory_level > historical_demand THEN 'Surplus'
         WHEN warehouse_inventory_level < historical_demand THEN 'Shortage' ELSE 'Balanced' END AS inventory_status
    FROM logistics""",
)
def calendar_and_status(spark, folder):
    rows = views.logistics(spark, folder, "timestamp", "warehouse_inventory_level", "historical_demand")
    gap = F.col("warehouse_inventory_level") - F.col("historical_demand")
    parts = values.calendar_parts(rows, "timestamp").withColumn("inventory_gap", gap)
    return parts.withColumn("inventory_status", values.inventory_status(F.col("inventory_gap"))).drop(
        "warehouse_inventory_level", "historical_demand"
    )


@query(
    "p02_lenient_parsing",
    """SELECT doc_id, TRY_CAST(regexp_extract("text", '[0-9]+') AS DOUBLE) AS as_number FROM documents""",
)
def lenient_parsing(spark, folder):
    docs = views.table(spark, folder, "documents")
    return docs.select("doc_id", values.lenient_number(F.regexp_extract("text", "[0-9]+", 0)).alias("as_number"))


@query(
    "p02_lenient_dates",
    """SELECT o_orderkey, TRY_CAST(CASE WHEN o_orderkey % 3 = 0 THEN '2024-13-01' WHEN o_orderkey % 5 = 0 THEN o_orderpriority
       ELSE strftime(o_orderdate, '%Y-%m-%d') END AS DATE) AS as_date FROM orders""",
)
def lenient_dates(spark, folder):
    """Dates in text, some with a month 13 and some with no date at all."""
    key, day = F.col("o_orderkey"), F.date_format("o_orderdate", "yyyy-MM-dd")
    text = F.when(key % 3 == 0, "2024-13-01").when(key % 5 == 0, F.col("o_orderpriority")).otherwise(day)
    return views.table(spark, folder, "orders").select("o_orderkey", values.lenient_date(text).alias("as_date"))


@query(
    "p03_strict_dates",
    """SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y-%m-%d') AS DATE) AS order_day,
       CAST(strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS TIMESTAMP) AS order_time FROM orders""",
)
def strict_dates(spark, folder):
    text = views.table(spark, folder, "orders").select(
        "o_orderkey",
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("time"),
    )
    return text.select(
        "o_orderkey",
        values.strict_date(F.col("day")).alias("order_day"),
        values.strict_timestamp(F.col("time")).alias("order_time"),
    )


@query(
    "p04_complete_rows",
    L + """SELECT historical_demand, port_congestion_level, cargo_condition_status, CAST(count(*) AS BIGINT) AS n_rows
    FROM logistics WHERE port_congestion_level IS NOT NULL AND cargo_condition_status IS NOT NULL GROUP BY 1, 2, 3""",
)
def complete_rows(spark, folder):
    rows = views.logistics(spark, folder, "historical_demand", "port_congestion_level", "cargo_condition_status")
    return rows.dropna().groupBy(*rows.columns).agg(F.count("*").alias("n_rows"))


_texts = ["order_fulfillment_status", "cargo_condition_status", "risk_classification"]


@query(
    "p06_columns_by_type",
    L + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", {str(c not in _texts + ['timestamp', 'date']).lower()} AS is_numeric,
        count("{c}") AS n_present FROM logistics""" for c in views.LOGISTICS_NAMES
    ),
)
def columns_by_type(spark, folder):
    """Numeric and other columns, with the number of values each has."""
    rows = views.logistics(spark, folder)
    present = rows.agg(*[F.count(c).alias(c) for c in rows.columns]).unpivot([], rows.columns, "column", "n_present")
    return present.withColumn("is_numeric", F.col("column").isin(values.numeric_columns(rows)))


_types = {"store_id": "bigint", "dt": "date"} | dict.fromkeys(
    ["city_id", "product_id", "stock_hour6_22_cnt", "holiday_flag", "activity_flag"], "int")


@query("p23_schema_listing", D + " UNION ALL ".join(
    f"""SELECT CAST({i} AS INTEGER) AS position, '{c}' AS "column", '{_types.get(c, 'double')}' AS "type", count({c}) AS n_present FROM demand"""
    for i, c in enumerate(views.DEMAND_NAMES)))
def schema_listing(spark, folder):
    """Columns and types with the number of values each has."""
    rows = views.demand(spark, folder)
    present = rows.agg(*[F.count(c).alias(c) for c in rows.columns]).unpivot([], rows.columns, "column", "n_present")
    return profile.schema_listing(rows).join(F.broadcast(present), "column")  # one row per column


@query(
    "p07_row_filter",
    D + """SELECT store_id, product_id, dt, sale_amount FROM demand WHERE sale_amount > 45 AND discount > 0.05""",
)
def row_filter(spark, folder):
    rows = views.demand(spark, folder, "store_id", "product_id", "dt", "sale_amount", "discount")
    return rows.where("sale_amount > 45 AND discount > 0.05").drop("discount")


@query(
    "p11_row_arithmetic",
    P + """SELECT store_id, product_id, round(avg_daily_demand * 7 + 3e-8, 6) AS week,
    round(greatest(avg_daily_demand * 7 - 200, 0) + 3e-8, 6) AS above, round(coalesce(demand_std, 0.5 * avg_daily_demand) + 3e-8, 6) AS std,
    CAST(floor(avg_daily_demand) AS INTEGER) AS whole, CAST(product_id AS VARCHAR) AS product_text,
    round_even(avg_daily_demand, 2) AS shown FROM params""",
)
def row_arithmetic(spark, folder):
    level = F.col("avg_daily_demand")
    shown = params(spark, folder).select(
        "store_id", "product_id", (level * 7).alias("week"), values.not_below(level * 7 - 200).alias("above"),
        F.coalesce("demand_std", 0.5 * level).alias("std"), F.floor(level).cast("int").alias("whole"),
        F.col("product_id").cast("string").alias("product_text"), values.half_even(level, 2).alias("shown"),
    )
    return rounded(shown)


@query(
    "p14_winsorize",
    L + """, bounds AS (SELECT quantile_cont(shipping_costs, 0.01) AS s1, quantile_cont(shipping_costs, 0.99) AS s9,
    quantile_cont(delivery_time_deviation, 0.01) AS d1, quantile_cont(delivery_time_deviation, 0.99) AS d9,
    quantile_cont(historical_demand, 0.01) AS h1, quantile_cont(historical_demand, 0.99) AS h9 FROM logistics)
    SELECT round(least(greatest(shipping_costs, s1), s9) + 3e-8, 6) AS shipping_costs,
    round(least(greatest(delivery_time_deviation, d1), d9) + 3e-8, 6) AS delivery_time_deviation,
    round(least(greatest(historical_demand, h1), h9) + 3e-8, 6) AS historical_demand,
    warehouse_inventory_level - historical_demand AS inventory_gap FROM logistics, bounds""",
)
def winsorize(spark, folder):
    rows = views.logistics(
        spark, folder, "shipping_costs", "delivery_time_deviation", "historical_demand", "warehouse_inventory_level"
    )
    gap = rows.withColumn("inventory_gap", F.col("warehouse_inventory_level") - F.col("historical_demand"))
    clipped = quantiles.winsorize(gap, ["shipping_costs", "delivery_time_deviation", "historical_demand"])
    return rounded(clipped.drop("warehouse_inventory_level"))


@query("p19_repeatable_sample", L + """ SELECT historical_demand, warehouse_inventory_level, risk_classification FROM logistics
    ORDER BY md5(concat_ws('|', historical_demand, warehouse_inventory_level, risk_classification, 42)), 1, 2, 3 LIMIT 5000""")
def repeatable_sample(spark, folder):
    rows = views.logistics(spark, folder, "historical_demand", "warehouse_inventory_level", "risk_classification")
    return values.repeatable_sample(rows, rows.columns, 5000)


@query(
    "p20_inventory_with_fallback",
    P + """SELECT store_id, product_id, round(coalesce(CASE WHEN product_id % 3 <> 0 THEN total_demand / 10 END,
    avg_daily_demand * 7 * 0.55) + 3e-8, 6) AS current_inventory FROM params""",
)
def inventory_with_fallback(spark, folder):
    series = params(spark, folder)
    known = series.where("product_id % 3 <> 0").select("store_id", "product_id", (F.col("total_demand") / 10).alias("known"))
    stock = F.coalesce("known", F.col("avg_daily_demand") * 7 * 0.55).alias("current_inventory")
    return rounded(series.join(known, dm.SERIES, "left").select(*dm.SERIES, stock))


@query("p21_simulated_inventory")
def simulated_inventory(spark, folder):
    return dm.with_inventory(params(spark, folder)).select(*dm.SERIES, "current_inventory", "inventory_imbalance")


@query(
    "s06_rows_of_top_stores",
    D + """, top AS (SELECT store_id FROM demand GROUP BY 1 ORDER BY sum(sale_amount) DESC, store_id LIMIT 20)
    SELECT store_id, product_id, dt, sale_amount FROM demand WHERE store_id IN (SELECT store_id FROM top)""",
)
def rows_of_top_stores(spark, folder):
    rows = views.demand(spark, folder, "store_id", "product_id", "dt", "sale_amount")
    return tables.keep_stores(rows, dm.top_stores(rows, 20))


_hours = "[" + ", ".join(f"l_quantity * {h} / 276" for h in range(24)) + "]"


@query(
    "s10_hourly_lists",
    """SELECT l_orderkey, l_linenumber, CAST(count(*) AS BIGINT) AS n, CAST(24 * count(*) AS BIGINT) AS entries,
       CAST(sum(CASE WHEN l_linenumber <= 4 THEN 1 ELSE 0 END) AS BIGINT) AS n_ok FROM lineitem GROUP BY ALL""",
)
def hourly_lists(spark, folder):
    """Writes each row's quantity as a text list of 24 hours, parses it back and checks the sums. The
    stock-out count is right only where the line number is at most 4, as flags are set for 4 hours."""
    rows = views.table(spark, folder, "lineitem")
    hours = F.transform(F.sequence(F.lit(0), F.lit(23)), lambda h: F.col("l_quantity") * h / 276)
    flags = F.transform(
        F.sequence(F.lit(0), F.lit(23)),
        lambda h: (h.between(6, 21) & (h - 5 <= F.least(F.col("l_linenumber"), F.lit(4)))).cast("int"),
    )
    text = rows.select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").alias("sale_amount"),
        F.col("l_linenumber").alias("stock_hour6_22_cnt"),
        F.to_json(hours).alias("hours_sale"), F.to_json(flags).alias("hours_stock_status"),
    )
    parsed = tables.parse_hours(text)
    return parsed.groupBy("l_orderkey", "l_linenumber").agg(
        F.count("*").alias("n"), F.sum(F.size("hours_sale")).alias("entries"), F.count_if("hours_ok").alias("n_ok")
    )


# ---- Totals, coverage, shares ----


@query("a01_daily_demand", D + "SELECT dt, sum(sale_amount) AS total_demand FROM demand GROUP BY 1")
def daily_demand(spark, folder):
    return profile.total_by(views.demand(spark, folder, "dt", "sale_amount"), ["dt"], "sale_amount", "total_demand")


@query(
    "a02_a03_coverage",
    D + """SELECT count(DISTINCT city_id) AS n_cities, count(DISTINCT store_id) AS n_stores,
    count(DISTINCT product_id) AS n_products, count(DISTINCT dt) AS n_days, min(dt) AS first_day, max(dt) AS last_day
    FROM demand""",
)
def coverage(spark, folder):
    return profile.coverage(views.demand(spark, folder, "city_id", "store_id", "product_id", "dt"))


@query("a04_city_day_demand", D + "SELECT dt, city_id, sum(sale_amount) AS demand FROM demand GROUP BY 1, 2")
def city_day_demand(spark, folder):
    rows = views.demand(spark, folder, "dt", "city_id", "sale_amount")
    return profile.total_by(rows, ["dt", "city_id"], "sale_amount", "demand")


@query(
    "a05_city_volatility",
    D + """, daily AS (SELECT dt, city_id, sum(sale_amount) AS demand FROM demand GROUP BY 1, 2),
    spread AS (SELECT stddev_samp(demand) AS daily_std FROM daily GROUP BY city_id) """ + _describe_sql("spread", ["daily_std"]),
)
def city_volatility(spark, folder):
    return rounded(profile.city_volatility(views.demand(spark, folder, "dt", "city_id", "sale_amount")))


@query(
    "a06_grain_frequency",
    D + """, g AS (SELECT count(*) AS records_per_day FROM demand GROUP BY store_id, product_id, dt)
    SELECT records_per_day, count(*) AS frequency FROM g GROUP BY 1""",
)
def grain_frequency(spark, folder):
    keys = ["store_id", "product_id", "dt"]
    return profile.grain_frequency(views.demand(spark, folder, *keys), keys)


@query("a07_describe_logistics", L + _describe_sql("logistics", NUMBERS))
def describe_logistics(spark, folder):
    return rounded(quantiles.describe(views.logistics(spark, folder, *NUMBERS), NUMBERS))


@query("a07_describe_demand", D + _describe_sql("demand", ["sale_amount", "stock_hour6_22_cnt"]))
def describe_demand(spark, folder):
    columns = ["sale_amount", "stock_hour6_22_cnt"]
    return rounded(quantiles.describe(views.demand(spark, folder, *columns), columns))


@query(
    "a08_sales_shares",
    D + f"""SELECT count(*) AS n_rows, count(*) FILTER (sale_amount = 0) AS zero_sales,
    count(*) FILTER (stock_hour6_22_cnt > 0) AS stockout_days,
    {r('avg(CASE WHEN stock_hour6_22_cnt > 0 THEN 1 ELSE 0 END)', 'stockout_rate')} FROM demand""",
)
def sales_shares(spark, folder):
    return rounded(profile.sales_shares(views.demand(spark, folder, "sale_amount", "stock_hour6_22_cnt")))


@query(
    "a08_imbalance_shares",
    P + f""", stock AS (SELECT *, total_demand / 10 - avg_daily_demand * 7 AS gap FROM params)
    SELECT count(*) AS n_series, count(*) FILTER (gap > 0) AS n_surplus, count(*) FILTER (gap < 0) AS n_shortage,
    {r('avg(demand_cv)', 'mean_cv')}, count(*) FILTER (demand_cv > 0.6) AS n_high_cv FROM stock""",
)
def imbalance_shares(spark, folder):
    stocked = params(spark, folder).withColumn("current_inventory", F.col("total_demand") / 10)
    return rounded(profile.imbalance_shares(dm.with_inventory(stocked), high_cv=0.6))


@query(
    "a09_describe_by_stockout",
    D + ", split AS (SELECT stock_hour6_22_cnt > 0 AS has_stockout, sale_amount FROM demand) "
    + _describe_sql("split", ["sale_amount"], by="has_stockout"),
)
def describe_by_stockout(spark, folder):
    rows = views.demand(spark, folder, "sale_amount", "stock_hour6_22_cnt")
    split = rows.withColumn("has_stockout", F.col("stock_hour6_22_cnt") > 0)
    return rounded(quantiles.describe(split, ["sale_amount"], by=["has_stockout"]))


@query(
    "a10_mean_by_flag",
    D + """SELECT 'discount' AS flag, CASE WHEN discount > 0 THEN 1 ELSE 0 END AS flag_value,
    round(avg(sale_amount) + 3e-8, 6) AS mean_value FROM demand GROUP BY 1, 2
    UNION ALL SELECT 'holiday', holiday_flag, round(avg(sale_amount) + 3e-8, 6) FROM demand GROUP BY 1, 2
    UNION ALL SELECT 'activity', activity_flag, round(avg(sale_amount) + 3e-8, 6) FROM demand GROUP BY 1, 2""",
)
def mean_by_flag(spark, folder):
    rows = views.demand(spark, folder, "sale_amount", "discount", "holiday_flag", "activity_flag")
    flags = {"discount": F.col("discount") > 0, "holiday": F.col("holiday_flag"), "activity": F.col("activity_flag")}
    return rounded(profile.mean_by_flag(rows, flags, "sale_amount"))


@query(
    "a11_value_counts",
    L + """SELECT * FROM (SELECT 'order_fulfillment_status' AS "column", order_fulfillment_status AS label, count(*) AS n_rows
    FROM logistics GROUP BY 2 ORDER BY n_rows DESC, label LIMIT 20)
    UNION ALL SELECT * FROM (SELECT 'cargo_condition_status', cargo_condition_status, count(*) AS n FROM logistics
    GROUP BY 2 ORDER BY n DESC, 2 LIMIT 20)
    UNION ALL SELECT * FROM (SELECT 'risk_classification', risk_classification, count(*) AS n FROM logistics
    GROUP BY 2 ORDER BY n DESC, 2 LIMIT 20)""",
)
def label_counts(spark, folder):
    out = None
    for c in ["order_fulfillment_status", "cargo_condition_status", "risk_classification"]:
        counted = profile.value_counts(views.logistics(spark, folder, c), c)
        named = counted.select(F.lit(c).alias("column"), F.col(c).alias("label"), "n_rows")
        out = named if out is None else out.unionByName(named)
    return out


_all_logistics = list(views.LOGISTICS_NAMES)


@query(
    "a12_missing_values",
    L + "SELECT * FROM ("
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", CAST(sum(CASE WHEN "{c}" IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing_count,
        round_even(100.0::DOUBLE * sum(CASE WHEN "{c}" IS NULL THEN 1 ELSE 0 END) / count(*), 2) AS missing_pct FROM logistics"""
        for c in _all_logistics
    )
    + ") WHERE missing_count > 0",
)
def missing_values(spark, folder):
    return profile.missing_values(views.logistics(spark, folder))


@query(
    "a13_duplicate_rows",
    """SELECT CAST(sum(n - 1) AS BIGINT) AS duplicate_rows FROM (SELECT count(*) AS n FROM lineitem
    GROUP BY l_orderkey, l_linenumber, l_returnflag)""",
)
def duplicate_rows(spark, folder):
    return profile.duplicate_rows(views.table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag"))


@query(
    "a13_duplicate_logistics",
    L + "SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_rows FROM (SELECT count(*) AS n FROM logistics GROUP BY ALL)".replace(
        "GROUP BY ALL", "GROUP BY " + ", ".join(f'"{c}"' for c in _all_logistics)
    ),
)
def duplicate_logistics(spark, folder):
    return profile.duplicate_rows(views.logistics(spark, folder))


@query(
    "a14_outlier_fences",
    L + ", q AS (" + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM logistics"""
        for c in NUMBERS
    ) + "), f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q), v AS (" + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", {c} AS v FROM logistics WHERE {c} IS NOT NULL""" for c in NUMBERS
    ) + """) SELECT "column", round(q1 + 3e-8, 6) AS q1, round(q3 + 3e-8, 6) AS q3, round(lo + 3e-8, 6) AS lo, round(hi + 3e-8, 6) AS hi,
    round(round_even(100.0::DOUBLE * sum(CASE WHEN v < lo OR v > hi THEN 1 ELSE 0 END) / count(*), 2) + 3e-8, 6) AS outlier_pct
    FROM v JOIN f USING ("column") GROUP BY ALL ORDER BY outlier_pct DESC, "column" LIMIT 15""",
)
def outlier_fences(spark, folder):
    return rounded(quantiles.outlier_fences(views.logistics(spark, folder, *NUMBERS), NUMBERS))


@query(
    "a15_correlations",
    L + " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}) + 3e-8, 6) AS corr FROM logistics" for a in NUMBERS for b in NUMBERS
    ),
)
def correlations(spark, folder):
    return rounded(profile.correlations(views.logistics(spark, folder, *NUMBERS), NUMBERS))


@query(
    "a16_daily_supply",
    L + f"""SELECT "date", sum(historical_demand) AS demand, sum(warehouse_inventory_level) AS inventory,
    {r('avg(delivery_time_deviation)', 'avg_delay')}, {r('avg(disruption_likelihood_score)', 'avg_risk')},
    {r('avg(shipping_costs)', 'avg_shipping_cost')} FROM logistics GROUP BY 1""",
)
def daily_supply(spark, folder):
    columns = ["date", "historical_demand", "warehouse_inventory_level", "delivery_time_deviation"]
    rows = views.logistics(spark, folder, *columns, "disruption_likelihood_score", "shipping_costs")
    return rounded(profile.daily_supply(rows))


@query(
    "a17_series_day",
    with_views(DEMAND, SERIES_DAY) + f"""SELECT store_id, product_id, city_id, "date", demand,
    {r('avg_stockout_hours')}, {r('avg_discount')}, is_holiday, has_promotion FROM series_day""",
)
def series_day(spark, folder):
    return rounded(dm.series_day(views.demand(spark, folder)))


@query("a18_group_count", D + "SELECT count(*) AS n_groups FROM (SELECT DISTINCT store_id, product_id FROM demand)")
def group_count(spark, folder):
    return profile.group_count(views.demand(spark, folder, "store_id", "product_id"), ["store_id", "product_id"])


@query(
    "a19_global_means",
    L + f"""SELECT {r('avg(shipping_costs)', 'avg_shipping_cost')}, {r('avg(lead_time_days)', 'avg_lead_time_days')},
    {r('avg(delay_probability)', 'avg_delay_probability')}, {r('avg(delivery_time_deviation)', 'avg_delivery_deviation')}
    FROM logistics""",
)
def global_means(spark, folder):
    rows = views.logistics(spark, folder, "shipping_costs", "lead_time_days", "delay_probability", "delivery_time_deviation")
    return rounded(profile.global_means(rows))


@query("a22_store_city", D + "SELECT store_id, min(city_id) AS city_id, count(DISTINCT city_id) AS n_cities FROM demand GROUP BY 1")
def store_city(spark, folder):
    return dm.store_city(views.demand(spark, folder, "store_id", "city_id"))


@query(
    "a23_a24_series_params",
    P + f"""SELECT store_id, product_id, city_id, {r('avg_daily_demand')}, {r('demand_std')}, total_demand, num_days,
    {r('avg_stockout_hours')}, {r('avg_discount')}, {r('holiday_proportion')}, {r('promotion_proportion')}, {r('demand_cv')}
    FROM params""",
)
def series_params(spark, folder):
    return rounded(params(spark, folder))


@query("a26_top_stores", D + """SELECT store_id, sum(sale_amount) AS total_demand FROM demand GROUP BY 1
    ORDER BY 2 DESC, 1 LIMIT 20""")
def top_stores(spark, folder):
    return dm.top_stores(views.demand(spark, folder, "store_id", "sale_amount"), 20)


@query(
    "a33_histogram",
    D + """, v AS (SELECT CAST(sale_amount AS DOUBLE) AS v FROM demand),
    e AS (SELECT min(v) AS lo, (max(v) - min(v)) / 20 AS w FROM v),
    c AS (SELECT least(CAST(floor((v - lo) / w) AS INTEGER), 19) AS bin, count(*) AS n FROM v, e GROUP BY 1)
    SELECT CAST(b AS INTEGER) AS bin, round(lo + b * w + 3e-8, 6) AS bin_start, round(lo + (b + 1) * w + 3e-8, 6) AS bin_end,
    coalesce(n, 0) AS n_rows FROM generate_series(0, 19) AS s(b) CROSS JOIN e LEFT JOIN c ON c.bin = s.b""",
)
def histogram(spark, folder):
    return rounded(profile.histogram(views.demand(spark, folder, "sale_amount"), "sale_amount", 20))


@query(
    "a34_box_statistics",
    L + """, q AS (SELECT risk_classification AS c, quantile_cont(delivery_time_deviation, 0.25) AS q1,
    quantile_cont(delivery_time_deviation, 0.5) AS median, quantile_cont(delivery_time_deviation, 0.75) AS q3
    FROM logistics GROUP BY 1),
    v AS (SELECT q.*, delivery_time_deviation AS v,
    delivery_time_deviation BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS ok
    FROM logistics JOIN q ON c = risk_classification)
    SELECT c AS risk_classification, round(q1 + 3e-8, 6) AS q1, round(median + 3e-8, 6) AS median, round(q3 + 3e-8, 6) AS q3,
    round(min(v) FILTER (ok) + 3e-8, 6) AS whisker_low, round(max(v) FILTER (ok) + 3e-8, 6) AS whisker_high,
    count(*) FILTER (NOT ok) AS n_outliers FROM v GROUP BY c, q1, median, q3""",
)
def box_statistics(spark, folder):
    rows = views.logistics(spark, folder, "risk_classification", "delivery_time_deviation")
    return rounded(quantiles.box_statistics(rows, "risk_classification", "delivery_time_deviation"))


@query(
    "a39_column_ranges",
    L + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", round(min({c}) + 3e-8, 6) AS lowest, round(max({c}) + 3e-8, 6) AS highest FROM logistics"""
        for c in ["vehicle_gps_latitude", "vehicle_gps_longitude", "shipping_costs"]
    ),
)
def column_ranges(spark, folder):
    columns = ["vehicle_gps_latitude", "vehicle_gps_longitude", "shipping_costs"]
    return rounded(profile.column_ranges(views.logistics(spark, folder, *columns), columns))


@query(
    "a40_table_shape",
    D + """SELECT count(*) AS n_rows, CAST(4 AS BIGINT) AS n_columns, count(DISTINCT store_id) AS n_store_id,
    count(DISTINCT product_id) AS n_product_id FROM demand""",
)
def table_shape(spark, folder):
    rows = views.demand(spark, folder, "store_id", "product_id", "dt", "sale_amount")
    return profile.table_shape(rows, ["store_id", "product_id"])


@query(
    "a41_totals_by_store_and_product",
    D + """, s AS (SELECT sum(sale_amount) AS store_total FROM demand GROUP BY store_id),
    p AS (SELECT sum(sale_amount) AS product_total FROM demand GROUP BY product_id) """
    + _describe_sql("s", ["store_total"]) + " UNION ALL " + _describe_sql("p", ["product_total"]),
)
def totals_by_store_and_product(spark, folder):
    rows = views.demand(spark, folder, "store_id", "product_id", "sale_amount")
    stores = profile.total_by(rows, ["store_id"], "sale_amount", "store_total")
    products = profile.total_by(rows, ["product_id"], "sale_amount", "product_total")
    described = quantiles.describe(stores, ["store_total"]).unionByName(quantiles.describe(products, ["product_total"]))
    return rounded(described)


@query("a41_product_totals", D + "SELECT product_id, sum(sale_amount) AS total_sale_amount FROM demand GROUP BY 1")
def product_totals(spark, folder):
    rows = views.demand(spark, folder, "product_id", "sale_amount")
    return profile.total_by(rows, ["product_id"], "sale_amount", "total_sale_amount")


@query(
    "a42_reference_mean",
    P + f"SELECT count(demand_cv) AS n_rows, {r('avg(demand_cv)', 'mean_value')} FROM params WHERE demand_cv < 0.6",
)
def reference_mean(spark, folder):
    return rounded(profile.reference_mean(params(spark, folder), "demand_cv", F.col("demand_cv") < 0.6))


@query("a07_describe_params", P + _describe_sql("params", ["avg_daily_demand", "demand_std", "total_demand", "demand_cv"]))
def describe_params(spark, folder):
    columns = ["avg_daily_demand", "demand_std", "total_demand", "demand_cv"]
    return rounded(quantiles.describe(params(spark, folder), columns))


@query("o03_sorted_ids", D + "SELECT DISTINCT city_id FROM demand ORDER BY 1")
def sorted_ids(spark, folder):
    return views.demand(spark, folder, "city_id").distinct().orderBy("city_id")


@query("a07_describe_sketch", D + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count({c}) AS "count", {r(f'avg({c})', 'mean')}, {r(f'min({c})', '"min"')}, {r(f'max({c})', '"max"')},
    true AS close FROM demand""" for c in ("sale_amount", "discount")))
def describe_sketch(spark, folder):
    """The one-pass summary; `close`: its quartiles lie between the exact quantiles one percent to either side."""
    columns, sides = ["sale_amount", "discount"], [p + s for p in quantiles.QUARTILES for s in (-0.01, 0.01)]
    rows = views.demand(spark, folder, *columns)
    exact = quantiles.column_quantiles(rows, columns, sides)
    both = quantiles.describe(rows, columns, approximate=True).join(exact, "column")
    close = [F.col(q).between(F.col("quantiles")[2 * i], F.col("quantiles")[2 * i + 1]) for i, q in enumerate(("q25", "q50", "q75"))]
    return rounded(both.select("column", "count", "mean", "min", "max", (close[0] & close[1] & close[2]).alias("close")))
