"""Regions, lanes and the allocation of transfers and production."""

from pyspark.sql import functions as F

from catalog.profile_queries import params
from catalog.registry import query, r, rounded
from catalog.views import DEMAND, LOGISTICS, PARAMS, SERIES_DAY, with_views
from stockloom.functions.geo import great_circle_km
from stockloom.operators import allocation as al
from stockloom.operators import demand as dm
from stockloom.operators import lanes as ln
from stockloom.plans.allocation import allocate, allocate_within
from stockloom.session import settle
from stockloom.sources import domain_views as views

SCENARIO = "weekly_plan"
_pair = [f"avg({c}) AS {c}_mean, stddev_samp({c}) AS {c}_std" for c in ln.MEAN_AND_STD]
_mean = [f"avg({c}) AS {c}_mean" for c in ln.MEAN_ONLY]
REGIONS = f"""
regions AS (SELECT region_id AS city_id, {', '.join(_pair + _mean)}, count(*) AS n_records,
  avg(vehicle_gps_latitude) AS centroid_lat, avg(vehicle_gps_longitude) AS centroid_lon
  FROM logistics WHERE region_id IS NOT NULL GROUP BY 1)"""
STORES = """
store_city AS (SELECT store_id, min(city_id) AS city_id FROM demand GROUP BY 1),
stores AS (SELECT store_id, lead_time_days_mean, delay_probability_mean, shipping_costs_mean
  FROM store_city LEFT JOIN regions USING (city_id))"""
_km = """12742.0::DOUBLE * asin(sqrt(least(1.0::DOUBLE, pow(sin((radians(b.centroid_lat) - radians(a.centroid_lat)) / 2), 2)
  + cos(radians(a.centroid_lat)) * cos(radians(b.centroid_lat)) * pow(sin((radians(b.centroid_lon) - radians(a.centroid_lon)) / 2), 2))))"""
LANES = f"""
distances AS (SELECT a.city_id AS from_city, b.city_id AS to_city, {_km} AS distance, a.shipping_costs_mean AS base_cost
  FROM regions a JOIN regions b ON a.city_id <> b.city_id),
directed AS (SELECT *, base_cost * (0.5::DOUBLE + 0.5::DOUBLE * distance / (SELECT max(distance) FROM distances)) AS cost FROM distances),
lanes AS (SELECT x.from_city, x.to_city, x.distance, (x.cost + y.cost) / 2 AS cost
  FROM directed x JOIN directed y ON x.from_city = y.to_city AND x.to_city = y.from_city)"""
# Pairs of cities that occur: where line items come from and go to.
SEEN = """
city_pairs AS (SELECT DISTINCT s_nationkey AS from_city, c_nationkey AS to_city FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
  JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey WHERE s_nationkey <> c_nationkey),
seen AS (SELECT lanes.* FROM lanes JOIN city_pairs USING (from_city, to_city))"""
TARGETS = """
assembled AS (SELECT store_id, product_id, total_demand_7d, total_demand_7d / 7 AS avg_daily_demand,
  coalesce(demand_std, total_demand_7d / 7 * 0.5::DOUBLE) AS demand_std, coalesce(city_id, 0) AS city_id,
  coalesce(lead_time_days_mean, 5.0::DOUBLE) AS lead_time_days_mean,
  coalesce(delay_probability_mean, 0.7::DOUBLE) AS delay_probability_mean, shipping_costs_mean,
  total_demand_7d * (0.4::DOUBLE + CAST((store_id * 7 + product_id * 13) % 20 AS DOUBLE) / 10) AS current_inventory
  FROM (SELECT *, avg_daily_demand * 7 AS total_demand_7d FROM params) LEFT JOIN stores USING (store_id)),
targets AS (SELECT *, total_demand_7d + safety_stock AS target_inventory FROM (SELECT *,
  1.65::DOUBLE * demand_std * sqrt(lead_time_days_mean) * (1 + delay_probability_mean) AS safety_stock,
  50.0::DOUBLE * (1 + coalesce(shipping_costs_mean, 450.0::DOUBLE) / 1000) AS mfg_unit_cost FROM assembled))"""
_q = "DECIMAL(24,6)"
PLAN = f"""
amounts AS (SELECT store_id, product_id, city_id, CAST(current_inventory AS {_q}) AS current, CAST(target_inventory AS {_q}) AS target
  FROM targets),
balance AS (SELECT *, greatest(current - target, 0) AS surplus, greatest(target - current, 0) AS deficit FROM amounts),
line1 AS (SELECT *, sum(surplus) OVER w AS s_end, sum(deficit) OVER w AS d_end, sum(surplus) OVER g AS s_all, sum(deficit) OVER g AS d_all
  FROM balance WINDOW g AS (PARTITION BY product_id, city_id), w AS (PARTITION BY product_id, city_id ORDER BY store_id ROWS UNBOUNDED PRECEDING)),
cut1 AS (SELECT *, least(s_end - surplus, s_all, d_all) AS s_lo, least(s_end, s_all, d_all) AS s_hi,
  least(d_end - deficit, s_all, d_all) AS d_lo, least(d_end, s_all, d_all) AS d_hi FROM line1),
left_over AS (SELECT store_id, product_id, city_id, current, target, surplus, deficit, s_hi - s_lo AS sent_1, d_hi - d_lo AS got_1,
  surplus - (s_hi - s_lo) AS surplus_2, deficit - (d_hi - d_lo) AS deficit_2 FROM cut1),
makes AS (SELECT product_id, city_id, min(mfg_unit_cost) AS make FROM targets GROUP BY 1, 2),
city_left AS (SELECT product_id, city_id, sum(surplus_2) AS s, sum(deficit_2) AS d FROM left_over GROUP BY 1, 2),
priced_lanes AS (SELECT a.product_id, a.city_id AS from_city, b.city_id AS to_city, make, round(coalesce(cost * 0.1::DOUBLE, 5.0::DOUBLE), 6) AS unit
  FROM city_left a JOIN city_left b ON a.product_id = b.product_id AND a.s > 0 AND b.d > 0
  JOIN makes m ON m.product_id = b.product_id AND m.city_id = b.city_id
  LEFT JOIN lanes ON lanes.from_city = a.city_id AND lanes.to_city = b.city_id),
offers AS (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY unit, from_city, to_city) AS k FROM priced_lanes WHERE unit <= make + 1),
greedy AS (SELECT product_id, CAST(0 AS BIGINT) AS k, map(list(city_id), list(CAST(s AS {_q}))) AS s, map(list(city_id), list(CAST(d AS {_q}))) AS d,
    CAST(NULL AS INTEGER) AS from_city, CAST(NULL AS INTEGER) AS to_city, CAST(0 AS {_q}) AS flow FROM city_left GROUP BY 1
  UNION ALL
  SELECT g.product_id, o.k,
    map_from_entries(list_transform(map_entries(g.s), lambda e: CAST(row(e.key, e.value - CASE WHEN e.key = o.from_city THEN least(g.s[o.from_city], g.d[o.to_city]) ELSE 0 END) AS STRUCT(k INTEGER, v {_q})))),
    map_from_entries(list_transform(map_entries(g.d), lambda e: CAST(row(e.key, e.value - CASE WHEN e.key = o.to_city THEN least(g.s[o.from_city], g.d[o.to_city]) ELSE 0 END) AS STRUCT(k INTEGER, v {_q})))),
    o.from_city, o.to_city, CAST(least(g.s[o.from_city], g.d[o.to_city]) AS {_q})
  FROM greedy g JOIN offers o ON o.product_id = g.product_id AND o.k = g.k + 1),
flows AS (SELECT product_id, from_city, to_city, flow, sum(flow) OVER (PARTITION BY product_id, from_city ORDER BY k) - flow AS s_at,
  sum(flow) OVER (PARTITION BY product_id, to_city ORDER BY k) - flow AS d_at FROM greedy WHERE flow > 0),
line2 AS (SELECT l.*, sum(surplus_2) OVER w AS s_end, sum(deficit_2) OVER w AS d_end, coalesce(o, 0) AS out_all, coalesce(i, 0) AS in_all
  FROM left_over l LEFT JOIN (SELECT product_id, from_city AS city_id, sum(flow) AS o FROM flows GROUP BY 1, 2) USING (product_id, city_id)
  LEFT JOIN (SELECT product_id, to_city AS city_id, sum(flow) AS i FROM flows GROUP BY 1, 2) USING (product_id, city_id)
  WINDOW w AS (PARTITION BY product_id, city_id ORDER BY store_id ROWS UNBOUNDED PRECEDING)),
cut2 AS (SELECT *, least(s_end - surplus_2, out_all) AS s_lo, least(s_end, out_all) AS s_hi,
  least(d_end - deficit_2, in_all) AS d_lo, least(d_end, in_all) AS d_hi FROM line2),
plan AS (SELECT *, sent_1 + (s_hi - s_lo) AS sent, got_1 + (d_hi - d_lo) AS got, deficit_2 - (d_hi - d_lo) AS made,
  current + deficit_2 - (d_hi - d_lo) + got_1 + (d_hi - d_lo) - sent_1 - (s_hi - s_lo) AS final FROM cut2),
far_moves AS (SELECT a.store_id AS from_store, b.store_id AS to_store, f.product_id,
  least(a.s_hi - s_at, b.d_hi - d_at, flow) - greatest(a.s_lo - s_at, b.d_lo - d_at, 0) AS qty
  FROM flows f JOIN cut2 a ON a.product_id = f.product_id AND a.city_id = from_city AND a.s_hi > a.s_lo
  JOIN cut2 b ON b.product_id = f.product_id AND b.city_id = to_city AND b.d_hi > b.d_lo),
moves AS (
  SELECT a.store_id AS from_store, b.store_id AS to_store, a.product_id, least(a.s_hi, b.d_hi) - greatest(a.s_lo, b.d_lo) AS qty, 1 AS tier
  FROM cut1 a JOIN cut1 b ON a.product_id = b.product_id AND a.city_id = b.city_id AND a.s_lo < b.d_hi AND b.d_lo < a.s_hi
  WHERE a.s_hi > a.s_lo AND b.d_hi > b.d_lo
  UNION ALL
  SELECT from_store, to_store, product_id, qty, 2 FROM far_moves WHERE qty > 0)"""
PRICED = """
transfers AS (SELECT m.*, lane_cost, coalesce(lane_cost * 0.1::DOUBLE, 5.0::DOUBLE) AS unit_cost,
  CAST(qty AS DOUBLE) * coalesce(lane_cost * 0.1::DOUBLE, 5.0::DOUBLE) AS cost
  FROM (SELECT moves.*, CASE WHEN f.city_id = t.city_id THEN 20.0::DOUBLE ELSE lanes.cost END AS lane_cost
        FROM moves LEFT JOIN store_city f ON from_store = f.store_id LEFT JOIN store_city t ON to_store = t.store_id
        LEFT JOIN lanes ON lanes.from_city = f.city_id AND lanes.to_city = t.city_id WHERE qty > 0.01) m),
production AS (SELECT p.store_id, p.product_id, made AS qty, mfg_unit_cost, CAST(made AS DOUBLE) * mfg_unit_cost AS cost
  FROM plan p JOIN targets t USING (store_id, product_id) WHERE made > 0.01)"""
_varies = """(coalesce({t}.avg_daily_demand = 0 AND {t}.demand_std > 0, false)
  OR coalesce({t}.demand_std / nullif({t}.avg_daily_demand, 0), 0.5) > 0.7)"""


def _codes(rules: list[tuple[str, str]], default: str) -> str:
    listed = ", ".join(f"CASE WHEN {test} THEN '{name}' END" for name, test in rules)
    found = f"list_filter([{listed}], lambda x: x IS NOT NULL)"
    return f"CASE WHEN len({found}) > 0 THEN {found} ELSE ['{default}'] END"


REASONED = f"""
reasoned AS (SELECT x.*, {_codes([
    ('projected_stockout_at_destination', 'd.current_inventory < d.total_demand_7d'),
    ('excess_inventory_at_source', 's.current_inventory > s.target_inventory'),
    ('safety_stock_violation_prevented', 'd.current_inventory < d.safety_stock'),
    ('high_demand_variability', _varies.format(t='d')),
    ('high_delay_probability', 'd.delay_probability_mean > 0.5'),
    ('transport_cost_acceptable', 'unit_cost < d.mfg_unit_cost'),
  ], 'rebalance_inventory')} AS reason_codes
  FROM transfers x LEFT JOIN targets d ON x.to_store = d.store_id AND x.product_id = d.product_id
  LEFT JOIN targets s ON x.from_store = s.store_id AND x.product_id = s.product_id),
reasoned_made AS (SELECT x.*, {_codes([
    ('manufacture_to_avoid_stockout', 'd.current_inventory < d.total_demand_7d'),
    ('safety_stock_violation_prevented', 'd.current_inventory < d.safety_stock'),
    ('high_demand_variability', _varies.format(t='d')),
    ('high_delay_probability', 'd.delay_probability_mean > 0.5'),
    ('manufacturing_capacity_constrained', 'store_total > 0.9 * 5000'),
  ], 'aggregate_demand_exceeds_inventory')} AS reason_codes
  FROM (SELECT *, sum(qty) OVER (PARTITION BY store_id) AS store_total FROM production) x
  LEFT JOIN targets d USING (store_id, product_id))"""
TO_REGIONS = with_views(LOGISTICS, REGIONS)
TO_LANES = with_views(LOGISTICS, REGIONS, LANES, SEEN)
TO_TARGETS = with_views(DEMAND, SERIES_DAY, PARAMS, LOGISTICS, REGIONS, STORES, TARGETS)
TO_PLAN = with_views(DEMAND, SERIES_DAY, PARAMS, LOGISTICS, REGIONS, STORES, TARGETS, LANES, PLAN)
TO_COSTS = with_views(DEMAND, SERIES_DAY, PARAMS, LOGISTICS, REGIONS, STORES, TARGETS, LANES, PLAN, PRICED, REASONED)


# ---- Spark side: the steps shared by the queries below ----


def regions(spark, folder):
    """Supply parameters per city; the city stands in for the cluster, and mean coordinates for its centre."""
    rows = views.logistics(
        spark, folder, "region_id", "vehicle_gps_latitude", "vehicle_gps_longitude", *ln.MEAN_AND_STD, *ln.MEAN_ONLY
    )
    centre = rows.where("region_id IS NOT NULL").groupBy("region_id").agg(
        F.avg("vehicle_gps_latitude").alias("centroid_lat"), F.avg("vehicle_gps_longitude").alias("centroid_lon")
    )
    return ln.region_params(rows, "region_id").join(centre, "region_id").withColumnRenamed("region_id", "city_id")


def store_city(spark, folder):
    return dm.store_city(views.demand(spark, folder, "store_id", "city_id")).drop("n_cities")


def seen_pairs(spark, folder):
    """Pairs of cities that line items connect: the supplier's and the customer's."""
    t = lambda name: views.table(spark, folder, name)
    items = t("lineitem").select("l_suppkey", "l_orderkey").join(t("supplier").select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
    bought = t("orders").select("o_orderkey", "o_custkey").join(t("customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    both = items.join(bought, F.col("l_orderkey") == F.col("o_orderkey"))
    return both.select(F.col("s_nationkey").alias("from_city"), F.col("c_nationkey").alias("to_city")).distinct()


def city_lanes(spark, folder):
    return ln.city_lanes(seen_pairs(spark, folder), settle(regions(spark, folder)))


def assembled(spark, folder, made=None, cities=None):
    made = regions(spark, folder) if made is None else made
    cities = store_city(spark, folder) if cities is None else cities
    history = params(spark, folder)
    forecast = history.select("store_id", "product_id", (F.col("avg_daily_demand") * 7).alias("total_demand_7d"))
    cover = 0.4 + ((F.col("store_id") * 7 + F.col("product_id") * 13) % 20).cast("double") / 10
    stocked = history.withColumn("current_inventory", F.col("avg_daily_demand") * 7 * cover)
    stores = ln.store_supply(cities, made)
    return al.assemble(forecast, stocked, stores)


def targets(spark, folder):
    return al.with_target(assembled(spark, folder))


def run(spark, folder, capacity=5000.0):
    made, cities = settle(regions(spark, folder)), settle(store_city(spark, folder))
    return allocate(assembled(spark, folder, made, cities), cities, made, ln.longest_distance(made), capacity)


def planned(spark, folder):
    """The plan and its flows between cities."""
    made, cities = settle(regions(spark, folder)), settle(store_city(spark, folder))
    balance = al.balances(settle(al.with_target(assembled(spark, folder, made, cities))))
    return al.plan_flows(balance, made, ln.longest_distance(made))


def plan(spark, folder):
    return planned(spark, folder)[0]


# ---- Regions and lanes ----


@query("a20_a21_region_params", TO_REGIONS + "SELECT city_id, n_records, "
       + ", ".join(r(f"{c}_{n}") for c in ln.MEAN_AND_STD for n in ("mean", "std")) + ", "
       + ", ".join(r(f"{c}_mean") for c in ln.MEAN_ONLY) + f", {r('centroid_lat')}, {r('centroid_lon')} FROM regions")
def region_params(spark, folder):
    return rounded(regions(spark, folder))


@query("a20_j13_params_by_status", with_views(LOGISTICS) + "SELECT order_fulfillment_status, "
       + ", ".join(r(f"{f}({c})", f"{c}_{n}") for c in ln.MEAN_AND_STD for f, n in (("avg", "mean"), ("stddev_samp", "std")))
       + ", " + ", ".join(r(f"avg({c})", f"{c}_mean") for c in ln.MEAN_ONLY)
       + ", count(*) AS n_records FROM logistics WHERE order_fulfillment_status IS NOT NULL GROUP BY 1")
def params_by_status(spark, folder):
    rows = views.logistics(spark, folder, "order_fulfillment_status", *ln.MEAN_AND_STD, *ln.MEAN_ONLY)
    return rounded(ln.region_params(rows, "order_fulfillment_status"))


@query("j02_store_supply", with_views(DEMAND, LOGISTICS, REGIONS, STORES)
       + f"SELECT store_id, city_id, {r('lead_time_days_mean')}, {r('shipping_costs_std')}, n_records "
       "FROM store_city LEFT JOIN regions USING (city_id)")
def store_supply(spark, folder):
    joined = ln.store_supply(store_city(spark, folder), regions(spark, folder))
    return rounded(joined.select("store_id", "city_id", "lead_time_days_mean", "shipping_costs_std", "n_records"))


@query("j04_f01_city_distances", TO_LANES + f"SELECT from_city, to_city, {r('distance')} FROM seen")
def city_distances(spark, folder):
    found = ln.city_distances(seen_pairs(spark, folder), settle(regions(spark, folder)))
    return rounded(found.drop("base_cost", "back_cost"))


@query("f01_shipment_distance", with_views(DEMAND, LOGISTICS, REGIONS) + f"""SELECT b.region_id,
    round(sum({_km}) / 1000 + 3e-8, 4) AS thousand_km, count(*) AS n_rows FROM (SELECT region_id,
    vehicle_gps_latitude AS centroid_lat, vehicle_gps_longitude AS centroid_lon FROM logistics) b
    JOIN regions a ON a.city_id = b.region_id GROUP BY 1""")
def shipment_distance(spark, folder):
    """Distance of every logistics record from the centre of its region, summed per region."""
    rows = views.logistics(spark, folder, "region_id", "vehicle_gps_latitude", "vehicle_gps_longitude")
    centre = regions(spark, folder).select(F.col("city_id").alias("region_id"), "centroid_lat", "centroid_lon")
    km = great_circle_km(
        F.col("centroid_lat"), F.col("centroid_lon"), F.col("vehicle_gps_latitude"), F.col("vehicle_gps_longitude")
    )
    away = rows.join(centre, "region_id").groupBy("region_id")
    return away.agg(F.round(F.sum(km) / 1000 + 3e-8, 4).alias("thousand_km"), F.count("*").alias("n_rows"))


@query("f02_directed_lanes", TO_LANES + f"SELECT from_city, to_city, {r('distance')}, {r('cost')} FROM directed JOIN city_pairs USING (from_city, to_city)")
def directed_lanes(spark, folder):
    made = settle(regions(spark, folder))
    return rounded(ln.directed_lanes(ln.city_distances(seen_pairs(spark, folder), made), ln.longest_distance(made)))


@query("j11_symmetric_lanes", TO_LANES + f"SELECT from_city, to_city, {r('distance')}, {r('cost')} FROM seen")
def symmetric_lanes(spark, folder):
    return rounded(city_lanes(spark, folder))


@query("a35_lane_summary", TO_LANES + " UNION ALL ".join(
    f"SELECT '{c}' AS measure, {r(f'min({c}) FILTER ({c} > 0)', 'lowest')}, {r(f'avg({c}) FILTER ({c} > 0)', 'mean_value')}, "
    f"{r(f'max({c})', 'highest')} FROM seen" for c in ("distance", "cost")))
def lane_summary(spark, folder):
    made = city_lanes(spark, folder)
    rows = [ln.weighted_summary(made, c).select(F.lit(c).alias("measure"), "*") for c in ("distance", "cost")]
    return rounded(rows[0].unionByName(rows[1]))


BLOCKS = """
pairs AS (SELECT a.city_id AS from_city, b.city_id AS to_city, CASE WHEN a.city_id = b.city_id THEN 20.0::DOUBLE ELSE cost END AS c
    FROM store_city a JOIN store_city b ON a.store_id <> b.store_id
    LEFT JOIN seen ON from_city = a.city_id AND to_city = b.city_id WHERE a.city_id = b.city_id OR cost IS NOT NULL)"""
TO_BLOCKS = with_views(DEMAND, LOGISTICS, REGIONS, STORES, LANES, SEEN, BLOCKS)


@query("j05_store_lane_blocks", TO_BLOCKS + f"SELECT from_city, to_city, count(*) AS n_pairs, {r('max(c)', 'cost')} FROM pairs GROUP BY 1, 2")
def store_lane_blocks(spark, folder):
    return rounded(ln.store_lane_blocks(store_city(spark, folder), city_lanes(spark, folder)))


@query("a35_store_lane_summary", TO_BLOCKS + f"SELECT {r('min(c)', 'lowest')}, {r('avg(c)', 'mean_value')}, {r('max(c)', 'highest')} FROM pairs")
def store_lane_summary(spark, folder):
    blocks = ln.store_lane_blocks(store_city(spark, folder), city_lanes(spark, folder))
    return rounded(ln.weighted_summary(blocks, "cost", F.col("n_pairs")))


@query("j06_order_lane_costs", with_views(DEMAND, LOGISTICS, REGIONS, STORES, LANES) + f""",
    pairs AS (SELECT l_suppkey AS from_store, 1 + l_partkey % (SELECT count(*) FROM supplier) AS to_store, count(*) AS n_rows FROM lineitem GROUP BY 1, 2),
    c AS (SELECT pairs.*, CASE WHEN from_store = to_store THEN 0.0::DOUBLE WHEN f.city_id = t.city_id THEN 20.0::DOUBLE ELSE cost END AS lane_cost
    FROM pairs LEFT JOIN store_city f ON from_store = f.store_id LEFT JOIN store_city t ON to_store = t.store_id
    LEFT JOIN lanes ON from_city = f.city_id AND to_city = t.city_id)
    SELECT from_store, to_store, n_rows, {r('lane_cost')},
    {r('CASE WHEN from_store = to_store THEN 0.0::DOUBLE ELSE coalesce(lane_cost * 0.1::DOUBLE, 5.0::DOUBLE) END', 'unit_cost')} FROM c""")
def order_lane_costs(spark, folder):
    """Lane costs of store pairs that occur in the line items (the part number, over all stores, as the other store)."""
    rows = views.table(spark, folder, "lineitem")
    n = views.table(spark, folder, "supplier").agg(F.count("*").alias("_n"))
    other = (1 + F.col("l_partkey") % F.col("_n")).alias("to_store")
    pairs = settle(rows.join(F.broadcast(n)).groupBy(F.col("l_suppkey").alias("from_store"), other).agg(F.count("*").alias("n_rows")))
    stores = settle(store_city(spark, folder))
    lanes = ln.city_lanes(ln.city_pairs(pairs, stores), settle(regions(spark, folder)))
    costs = ln.store_lane_costs(pairs, stores, lanes)
    return rounded(costs.select("from_store", "to_store", "n_rows", "lane_cost", "unit_cost"))


@query("j10_zip_cities", TO_REGIONS + """SELECT a.city_id, b.city_id AS geo_cluster FROM
    (SELECT city_id, row_number() OVER (ORDER BY city_id) AS k FROM regions) a JOIN
    (SELECT city_id, row_number() OVER (ORDER BY centroid_lon, city_id) AS k FROM regions) b USING (k)""")
def zip_cities(spark, folder):
    made = regions(spark, folder)
    clusters = made.withColumnRenamed("city_id", "geo_cluster").select("geo_cluster", "centroid_lon")
    return ln.zip_cities(made.select("city_id"), clusters).select("city_id", "geo_cluster")


@query("m01_fitted_regions", TO_REGIONS + """SELECT count(*) AS n_regions, CAST(sum(n_records) AS BIGINT) AS n_records, true AS fits,
    (SELECT round((var_pop(vehicle_gps_latitude) + var_pop(vehicle_gps_longitude)) * count(*), 2) FROM logistics WHERE region_id IS NOT NULL) AS one_centre
    FROM regions""")
def fitted_regions(spark, folder):
    """As many clusters as there are cities. SQL states their number, that they hold every record, and `one_centre`, the
    squared distances of all points from one centre; `fits`: the fitted centres leave less than a fiftieth of that."""
    rows = views.logistics(
        spark, folder, "region_id", "vehicle_gps_latitude", "vehicle_gps_longitude", *ln.MEAN_AND_STD, *ln.MEAN_ONLY
    ).where("region_id IS NOT NULL")
    k = rows.agg(F.count_distinct("region_id")).first()[0]
    model = ln.fit_regions(rows, k)
    made = ln.region_params(ln.assign_regions(rows, model)).join(ln.centroids(model, rows), "geo_cluster")
    at = rows.select("vehicle_gps_latitude", "vehicle_gps_longitude")
    spread = at.agg((F.var_pop("vehicle_gps_latitude") + F.var_pop("vehicle_gps_longitude")) * F.count("*")).first()[0]
    return made.agg(
        F.count("*").alias("n_regions"), F.sum("n_records").alias("n_records"),
        F.lit(model.summary.trainingCost < spread / 50).alias("fits"), F.round(F.lit(spread), 2).alias("one_centre"),
    )


# ---- Targets and allocation ----


@query("l01_j01_assembled", TO_TARGETS + f"""SELECT store_id, product_id, {r('total_demand_7d')}, {r('avg_daily_demand')},
    {r('demand_std')}, city_id, {r('lead_time_days_mean')}, {r('delay_probability_mean')}, {r('shipping_costs_mean')},
    {r('current_inventory')} FROM assembled""")
def assembled_inputs(spark, folder):
    return rounded(assembled(spark, folder))


@query("l02_f03_f04_targets", TO_TARGETS + f"""SELECT store_id, product_id, {r('safety_stock')}, {r('target_inventory')},
    {r('mfg_unit_cost')} FROM targets""")
def target_stock(spark, folder):
    return rounded(targets(spark, folder).select("store_id", "product_id", "safety_stock", "target_inventory", "mfg_unit_cost"))


@query("l03_j03_priced_transfers", TO_COSTS + f"""SELECT from_store, to_store, product_id, tier, CAST(qty AS DOUBLE) AS qty,
    {r('unit_cost')}, {r('cost')} FROM transfers""")
def priced_transfers(spark, folder):
    shown = run(spark, folder).transfers().select("from_store", "to_store", "product_id", "tier", F.col("qty").cast("double").alias("qty"), "unit_cost", "cost")
    return rounded(shown)


@query("l04_j09_candidate_counts", TO_PLAN + """SELECT product_id, count(*) AS n_stores, count(*) * (count(*) - 1) AS n_candidates,
    count(*) FILTER (surplus > 0) AS n_surplus, count(*) FILTER (deficit > 0) AS n_deficit FROM balance GROUP BY 1""")
def candidate_counts(spark, folder):
    return al.candidate_counts(al.balances(targets(spark, folder)))


@query("l05_moves", TO_PLAN + "SELECT from_store, to_store, product_id, CAST(qty AS DOUBLE) AS qty, tier FROM moves")
def all_moves(spark, folder):
    return al.moves(*planned(spark, folder)).withColumn("qty", F.col("qty").cast("double"))


@query("l05_city_flows", TO_PLAN + "SELECT product_id, from_city, to_city, CAST(flow * 1000000 AS BIGINT) AS flow FROM flows")
def city_flows(spark, folder):
    return planned(spark, folder)[1].select("product_id", "from_city", "to_city", "flow")


@query("l06_production", TO_COSTS + f"SELECT store_id, product_id, CAST(qty AS DOUBLE) AS qty, {r('cost')} FROM production")
def production(spark, folder):
    made = run(spark, folder).production()
    return rounded(made.select("store_id", "product_id", F.col("qty").cast("double").alias("qty"), "cost"))


@query("l07_final_inventory", TO_PLAN + """SELECT store_id, product_id, CAST(round_even(current, 2) AS DOUBLE) AS current,
    CAST(round_even(final, 2) AS DOUBLE) AS final, CAST(round_even(target, 2) AS DOUBLE) AS target FROM plan""")
def final_inventory(spark, folder):
    return al.final_inventory(plan(spark, folder))


@query("l07_stock_totals", TO_PLAN + """SELECT CAST(sum(current) AS DOUBLE) AS current, CAST(sum(final) AS DOUBLE) AS final,
    CAST(sum(target) AS DOUBLE) AS target, CAST(sum(sent) AS DOUBLE) AS sent, CAST(sum(got) AS DOUBLE) AS got,
    CAST(sum(made) AS DOUBLE) AS made FROM plan""")
def stock_totals(spark, folder):
    names = ["current", "final", "target", "sent", "got", "made"]
    return plan(spark, folder).agg(*[F.sum(c).cast("double").alias(c) for c in names])


@query("l08_audit", TO_PLAN + """, summed AS (SELECT store_id, product_id, sum(o) AS o, sum(i) AS i FROM (
      SELECT from_store AS store_id, product_id, qty AS o, 0 AS i FROM moves UNION ALL SELECT to_store, product_id, 0, qty FROM moves) GROUP BY 1, 2),
    state AS (SELECT plan.*, coalesce(o, 0) AS o, coalesce(i, 0) AS i FROM plan LEFT JOIN summed USING (store_id, product_id))
    SELECT rule, count(*) AS n_rows FROM (
    SELECT 'balance' AS rule FROM state WHERE final <> current + made + i - o
    UNION ALL SELECT 'negative' FROM state WHERE made < 0 OR o < 0 OR i < 0 UNION ALL 
    SELECT 'capacity' AS rule FROM plan GROUP BY store_id HAVING sum(made) > 400
    UNION ALL SELECT 'target' FROM plan WHERE final < target
    UNION ALL SELECT 'transfer_limit' FROM plan WHERE sent > current) GROUP BY 1""")
def audit(spark, folder):
    """Uses a small capacity, so that the audit has something to find; all other rules hold."""
    made, flows = planned(spark, folder)
    return al.audit(made, al.moves(made, flows), capacity=400.0).groupBy("rule").agg(F.count("*").alias("n_rows"))


@query("l09_capacity_overflow", TO_PLAN + """SELECT store_id, product_id, CAST(made AS DOUBLE) AS made,
    CAST(total AS DOUBLE) AS store_total, CAST(upto - greatest(upto - made, 400) AS DOUBLE) AS overflow FROM (
    SELECT *, sum(made) OVER (PARTITION BY store_id ORDER BY product_id ROWS UNBOUNDED PRECEDING) AS upto,
    sum(made) OVER (PARTITION BY store_id) AS total FROM plan WHERE made > 0) WHERE upto > 400""")
def capacity_overflow(spark, folder):
    over = al.capacity_overflow(plan(spark, folder), capacity=400.0)
    return over.withColumns({c: F.col(c).cast("double") for c in ("made", "store_total", "overflow")})


CAPACITIES = (400.0, 1100.0)


@query("l05_l08_l09_capped_plans", TO_PLAN + """, loads AS (SELECT store_id, sum(made) AS made FROM plan GROUP BY 1)
    SELECT CAST(capacity AS DOUBLE) AS capacity, CAST(sum(made) AS DOUBLE) AS made, CAST(greatest(sum(made) - count(*) * capacity, 0) AS DOUBLE) AS overflow,
    CAST(0 AS BIGINT) AS n_broken FROM loads, (SELECT CAST(unnest([400, 1100]) AS DECIMAL(24,6)) AS capacity) GROUP BY capacity""")
def capped_plans(spark, folder):
    """Plans for two capacities, one of them too small for all production together. Every store here stocks every product
    and has high targets, so what no plan can place is what all stores together cannot make, and SQL can state it.
    No other rule may break."""
    made, cities = settle(regions(spark, folder)), settle(store_city(spark, folder))
    plans = allocate_within(assembled(spark, folder, made, cities), cities, made, ln.longest_distance(made), CAPACITIES)
    rows = []
    for capacity, made in zip(CAPACITIES, plans):
        broken = made.audit().where("rule <> 'capacity'").agg(F.count("*").alias("n_broken"))
        total = made.plan.agg(F.sum("made").cast("double").alias("made"))
        over = made.overflow().agg(F.coalesce(F.sum("overflow").cast("double"), F.lit(0.0)).alias("overflow"))
        rows.append(total.join(F.broadcast(over)).join(F.broadcast(broken)).withColumn("capacity", F.lit(capacity)))
    return rows[0].unionByName(rows[1]).select("capacity", "made", "overflow", "n_broken")


@query("a31_store_production", TO_PLAN + """SELECT store_id, CAST(sum(made) AS DOUBLE) AS made_total FROM plan
    WHERE made > 0.01 GROUP BY 1""")
def store_production(spark, folder):
    made = al.store_production(plan(spark, folder))
    return made.withColumn("made_total", F.col("made_total").cast("double"))


@query("l10_transfer_reasons", TO_COSTS + "SELECT from_store, to_store, product_id, reason_codes FROM reasoned")
def transfer_reasons(spark, folder):
    return run(spark, folder).transfers().select("from_store", "to_store", "product_id", "reason_codes")


@query("l11_production_reasons", TO_COSTS + "SELECT store_id, product_id, reason_codes FROM reasoned_made")
def production_reasons(spark, folder):
    return run(spark, folder).production().select("store_id", "product_id", "reason_codes")


@query("l12_reason_counts", TO_COSTS + """SELECT reason, count(*) AS n_rows FROM (SELECT unnest(reason_codes) AS reason FROM reasoned
    UNION ALL SELECT unnest(reason_codes) FROM reasoned_made) GROUP BY 1""")
def reason_counts(spark, folder):
    made = run(spark, folder)
    return al.reason_counts(made.transfers().select("reason_codes").unionByName(made.production().select("reason_codes")))


@query("a28_production_by_product", TO_COSTS + f"""SELECT product_id, CAST(sum(qty) AS DOUBLE) AS quantity, {r('sum(cost)', 'cost')},
    list_sort(list_distinct(flatten(list(reason_codes)))) AS reason_codes FROM reasoned_made GROUP BY 1""")
def production_by_product(spark, folder):
    grouped = al.production_by_product(run(spark, folder).production())
    return rounded(grouped.withColumn("quantity", F.col("quantity").cast("double")))


COSTS = """
costs AS (SELECT *, manufacturing_cost + transfer_cost + holding_cost AS total_cost FROM
  (SELECT coalesce(sum(cost), 0) AS manufacturing_cost, CAST(sum(qty) AS DOUBLE) AS manufacturing_units FROM production),
  (SELECT coalesce(sum(cost), 0) AS transfer_cost, CAST(sum(qty) AS DOUBLE) AS transfer_units, count(*) AS total_transfers FROM transfers),
  (SELECT CAST(sum(final) AS DOUBLE) AS holding_cost FROM plan))"""


@query("l13_a29_a30_cost_summary", TO_COSTS.rstrip() + "," + COSTS + """SELECT round(manufacturing_cost, 3) AS manufacturing_cost,
    manufacturing_units, round(transfer_cost, 3) AS transfer_cost, transfer_units, total_transfers, holding_cost,
    round(total_cost, 3) AS total_cost, round(100 * manufacturing_cost / total_cost, 6) AS manufacturing_pct,
    round(100 * transfer_cost / total_cost, 6) AS transfer_pct, round(100 * holding_cost / total_cost, 6) AS holding_pct FROM costs""")
def cost_summary(spark, folder):
    costs = run(spark, folder).costs()
    digits = {c: 3 for c in ("manufacturing_cost", "transfer_cost", "total_cost")}
    digits.update({f"{p}_pct": 6 for p in ("manufacturing", "transfer", "holding")})
    return costs.withColumns({c: F.round(c, n) for c, n in digits.items()})


@query("l13_cost_and_bound", TO_COSTS.rstrip() + "," + COSTS + """,
    cheapest AS (SELECT least(2.0::DOUBLE, 5.0::DOUBLE, min(shipping_costs_mean) / 2 * 0.1::DOUBLE) AS lane FROM regions),
    per_product AS (SELECT product_id, CAST(sum(current) AS DOUBLE) AS stock, CAST(sum(surplus) AS DOUBLE) AS s, CAST(sum(deficit) AS DOUBLE) AS d,
      min(mfg_unit_cost) + 1 AS keep FROM plan JOIN (SELECT store_id, product_id, mfg_unit_cost FROM targets) USING (store_id, product_id) GROUP BY 1),
    bound AS (SELECT sum(stock + keep * greatest(d - s, 0) + least(lane, keep) * (d - greatest(d - s, 0))) AS lower_bound FROM per_product, cheapest)
    SELECT round(total_cost, 2) AS total_cost, round(lower_bound, 2) AS lower_bound,
    round(100 * (total_cost - lower_bound) / total_cost, 6) AS gap_pct FROM costs, bound""")
def cost_and_bound(spark, folder):
    """Cost of the plan next to the cost no plan can undercut."""
    made = run(spark, folder)
    both = made.costs().select("total_cost").join(F.broadcast(made.lower_bound()))
    gap = F.round(100 * (F.col("total_cost") - F.col("lower_bound")) / F.col("total_cost"), 6)
    return both.select(F.round("total_cost", 2).alias("total_cost"), F.round("lower_bound", 2).alias("lower_bound"), gap.alias("gap_pct"))


@query("l14_scenario_delta", TO_COSTS.rstrip() + "," + COSTS + """, state AS (SELECT
    CAST(sum(greatest(need - current, 0)) AS DOUBLE) AS before, CAST(sum(greatest(need - final, 0)) AS DOUBLE) AS after,
    CAST(sum(current) AS DOUBLE) AS stock FROM (SELECT *, CAST(total_demand_7d AS DECIMAL(24,6)) AS need FROM plan
    JOIN (SELECT store_id, product_id, total_demand_7d FROM targets) USING (store_id, product_id)))
    SELECT 'weekly_plan' AS scenario, round(stock + 25 * before, 1) AS baseline_cost, CAST(round_even(before, 0) AS BIGINT) AS baseline_stockouts,
    round(total_cost + 25 * after, 1) AS optimized_cost, CAST(round_even(after, 0) AS BIGINT) AS optimized_stockouts,
    CAST(round_even(before, 0) - round_even(after, 0) AS BIGINT) AS stockout_reduction_units FROM state, costs""")
def scenario_delta(spark, folder):
    compared = run(spark, folder).scenario_record(SCENARIO)
    return compared.select(
        "scenario", F.round("baseline.total_cost", 1).alias("baseline_cost"), F.col("baseline.total_stockouts").alias("baseline_stockouts"),
        F.round("optimized.total_cost", 1).alias("optimized_cost"), F.col("optimized.total_stockouts").alias("optimized_stockouts"),
        "delta.stockout_reduction_units",
    )
