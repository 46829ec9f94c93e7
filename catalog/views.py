"""SQL text of the domain views, for checking the Spark queries."""

from stockloom.sources.domain_views import QUESTION_FORMS

DEMAND = """
demand AS (
  SELECT l_suppkey AS store_id, s_nationkey AS city_id,
         CAST(replace(p_brand, 'Brand#', '') AS INTEGER) AS product_id,
         CAST(l_shipdate AS DATE) AS dt, l_quantity - 1 AS sale_amount,
         l_linenumber - 1 AS stock_hour6_22_cnt, l_discount AS discount,
         CASE WHEN isodow(l_shipdate) >= 6 THEN 1 ELSE 0 END AS holiday_flag,
         CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS activity_flag,
         l_tax AS precpt, round(l_extendedprice / 10000, 2) AS avg_temperature,
         l_discount * 100 AS avg_humidity, CAST(l_linenumber AS DOUBLE) / 2 AS avg_wind_level
  FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN part ON l_partkey = p_partkey
)"""

LOGISTICS = """
logistics AS (
  SELECT o_orderdate AS "timestamp", CAST(o_orderdate AS DATE) AS "date", s_nationkey AS region_id,
         30 + CAST(s_nationkey AS DOUBLE) * 7 % 20 + CAST(l_suppkey AS DOUBLE) % 10 / 10 AS vehicle_gps_latitude,
         -115 + CAST(s_nationkey AS DOUBLE) * 11 % 45 + CAST(l_suppkey AS DOUBLE) % 7 / 10 AS vehicle_gps_longitude,
         l_quantity AS historical_demand, round(l_discount * 500) AS warehouse_inventory_level,
         l_extendedprice * CAST(0.01 AS DOUBLE) AS shipping_costs,
         CAST(abs(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE))) % 14 + 1 AS DOUBLE)
           AS lead_time_days,
         (CAST(l_linenumber AS DOUBLE) - 4) / 2 AS delivery_time_deviation,
         l_tax * CAST(12.5 AS DOUBLE) AS delay_probability, l_discount * 10 AS disruption_likelihood_score,
         CAST(l_orderkey AS DOUBLE) % 11 AS route_risk_level, l_tax * 10 AS weather_condition_severity,
         CAST(l_linenumber AS DOUBLE) AS traffic_congestion_level,
         nullif(CAST(l_partkey AS DOUBLE) % 10, CAST(0 AS DOUBLE)) AS port_congestion_level,
         greatest(s_acctbal, CAST(0 AS DOUBLE)) / 10000 AS supplier_reliability_score,
         o_orderstatus AS order_fulfillment_status, nullif(l_linestatus, 'F') AS cargo_condition_status,
         o_orderpriority AS risk_classification
  FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN orders ON l_orderkey = o_orderkey
)"""

EVENT_SERIES = """
event_series AS (
  SELECT event_type AS series, CAST(ts AS DATE) AS dt,
         CAST(sum(CAST(value AS DECIMAL(18,4))) AS DOUBLE) AS demand
  FROM events GROUP BY 1, 2
)"""

_forms = "[" + ", ".join("'" + q.replace("'", "''") + "'" for q in QUESTION_FORMS) + "]"
QUESTIONS = f"""
questions AS (
  SELECT conv_id, turn, text FROM conversations WHERE role = 'user'
  UNION ALL
  SELECT o_custkey + 1000000000, o_orderkey,
         replace(replace(replace(({_forms})[CAST(o_orderkey % {len(QUESTION_FORMS)} AS INTEGER) + 1],
           '{{s}}', CAST(o_custkey % (SELECT count(*) FROM supplier) AS VARCHAR)), '{{p}}', CAST(o_orderkey % 25 AS VARCHAR)),
           '{{n}}', CAST(o_orderkey % 900 + 100 AS VARCHAR))
  FROM orders
)"""

SERIES_DAY = """
series_day AS (
  SELECT store_id, product_id, city_id, dt AS "date", sum(sale_amount) AS demand,
         avg(stock_hour6_22_cnt) AS avg_stockout_hours, avg(discount) AS avg_discount,
         max(holiday_flag) AS is_holiday, max(activity_flag) AS has_promotion
  FROM demand GROUP BY ALL
)"""

PARAMS = """
params AS (
  SELECT store_id, product_id, city_id, avg(demand) AS avg_daily_demand, stddev_samp(demand) AS demand_std,
         sum(demand) AS total_demand, count(*) AS num_days, avg(avg_stockout_hours) AS avg_stockout_hours,
         avg(avg_discount) AS avg_discount, avg(is_holiday) AS holiday_proportion,
         avg(has_promotion) AS promotion_proportion,
         coalesce(stddev_samp(demand) / nullif(avg(demand), 0), 0) AS demand_cv
  FROM series_day GROUP BY 1, 2, 3
)"""


def with_views(*views: str) -> str:
    return "WITH RECURSIVE " + ",".join(views) + "\n"
