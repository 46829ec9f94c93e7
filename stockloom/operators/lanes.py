"""Regions, city parameters and transport lanes."""

from __future__ import annotations

import numpy as np
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockloom.functions.geo import EARTH_RADIUS_KM, LOCAL_LANE_COST, great_circle_km, lane_cost, unit_lane_cost
from stockloom.session import settle

MEAN_AND_STD = ["shipping_costs", "lead_time_days", "delay_probability", "delivery_time_deviation"]
MEAN_ONLY = [
    "route_risk_level", "disruption_likelihood_score", "supplier_reliability_score",
    "traffic_congestion_level", "weather_condition_severity", "warehouse_inventory_level",
]
# Points whose distances are compared in one piece when the longest is looked for.
AT_ONCE = 4000


def fit_regions(logistics: DataFrame, k: int, seed: int = 42, starts: int = 10) -> KMeansModel:
    """K-means on the raw coordinates: the best of several starts by total squared distance.

    Equal points are counted first and weigh by their number, so what is kept for the repeated passes is
    three columns of the different points and not the rows.
    """
    at = ["vehicle_gps_latitude", "vehicle_gps_longitude"]
    counted = logistics.select(*at).dropna().groupBy(*at).agg(F.count("*").cast("double").alias("_times"))
    points = _points(counted).select("_point", "_times").persist()
    try:
        fits = [
            KMeans(k=k, seed=seed + i, featuresCol="_point", predictionCol="geo_cluster", weightCol="_times").fit(points)
            for i in range(starts)
        ]
        return min(fits, key=lambda m: m.summary.trainingCost)
    finally:
        points.unpersist()


def _points(logistics: DataFrame) -> DataFrame:
    at = ["vehicle_gps_latitude", "vehicle_gps_longitude"]
    return VectorAssembler(inputCols=at, outputCol="_point", handleInvalid="skip").transform(logistics)


def assign_regions(logistics: DataFrame, model: KMeansModel) -> DataFrame:
    return model.transform(_points(logistics)).drop("_point")


def centroids(model: KMeansModel, logistics: DataFrame) -> DataFrame:
    """(geo_cluster, centroid_lat, centroid_lon); k rows."""
    rows = [(i, float(c[0]), float(c[1])) for i, c in enumerate(model.clusterCenters())]
    return logistics.sparkSession.createDataFrame(rows, "geo_cluster int, centroid_lat double, centroid_lon double")


def region_params(logistics: DataFrame, region: str = "geo_cluster") -> DataFrame:
    """Mean (and spread) of the supply columns and the record count per region."""
    both = [f(c).alias(f"{c}_{n}") for c in MEAN_AND_STD for f, n in ((F.avg, "mean"), (F.stddev_samp, "std"))]
    means = [F.avg(c).alias(f"{c}_mean") for c in MEAN_ONLY]
    return (
        logistics.where(F.col(region).isNotNull())
        .groupBy(region)
        .agg(*both, *means, F.count("*").alias("n_records"))
    )


def zip_cities(cities: DataFrame, regions: DataFrame) -> DataFrame:
    """Pair the k-th city id with the k-th region from west to east.

    Both ranks run over tables of one row per city or region; their number is the k of the clustering.
    """
    by_id = F.row_number().over(Window.orderBy("city_id"))
    by_longitude = F.row_number().over(Window.orderBy("centroid_lon", "geo_cluster"))
    ranked = cities.select("city_id").distinct().withColumn("_place", by_id)
    return ranked.join(regions.withColumn("_place", by_longitude), "_place").drop("_place")


def store_supply(store_city: DataFrame, city_params: DataFrame) -> DataFrame:
    """City parameters for every store; stores of an unknown city stay, with nulls."""
    return store_city.select("store_id", "city_id").join(city_params, "city_id", "left")


def all_km(lat1: np.ndarray, lon1: np.ndarray, lat2: np.ndarray, lon2: np.ndarray) -> np.ndarray:
    """Great-circle distance of all pairs of two lists of points, in rows and columns."""
    a, b = np.radians(lat1)[:, None], np.radians(lat2)[None, :]
    north = np.sin((b - a) / 2) ** 2
    east = np.sin((np.radians(lon2)[None, :] - np.radians(lon1)[:, None]) / 2) ** 2
    return 2 * EARTH_RADIUS_KM * np.arcsin(np.sqrt(np.minimum(1.0, north + np.cos(a) * np.cos(b) * east)))


def longest_distance(cities: DataFrame, at_once: int = AT_ONCE) -> float:
    """The greatest distance of any two cities, without forming all pairs.

    The map is cut into cells. Two cells cannot hold the farthest pair if their centres and radii keep all
    their cities closer than some pair already known. What is left is cut finer until few cities remain;
    the driver sees one row per cell that is left, and at most `at_once` cities in the end.
    """
    points = settle(cities.select(F.col("centroid_lat").alias("lat"), F.col("centroid_lon").alias("lon")).dropna().distinct())
    size, known = 8.0, 0.0
    while True:
        few = points.limit(at_once + 1).collect()
        if len(few) <= at_once or size < 1e-6:
            lat, lon = np.array([r["lat"] for r in few], float), np.array([r["lon"] for r in few], float)
            rows = [all_km(lat[i : i + 500], lon[i : i + 500], lat, lon).max(initial=0.0) for i in range(0, len(few), 500)]
            # With more cities than that in the smallest cells, `known` is right to well below a metre.
            return float(max([known, *rows]))
        cell = [F.floor(F.col(c) / size).alias(f"_{c}") for c in ("lat", "lon")]
        ends = [f(c).alias(f"{n}_{c}") for c in ("lat", "lon") for f, n in ((F.min, "low"), (F.max, "high"))]
        cells = points.groupBy(*cell).agg(*ends, F.min(F.struct("lat", "lon")).alias("one")).collect()
        get = lambda name: np.array([r[name] for r in cells], float)
        low_lat, high_lat, low_lon, high_lon = (get(n) for n in ("low_lat", "high_lat", "low_lon", "high_lon"))
        lat, lon = (low_lat + high_lat) / 2, (low_lon + high_lon) / 2
        # The farthest corner of a box from its centre; on a sphere the edges in between are no farther.
        radius = np.max([np.diag(all_km(lat, lon, y, x)) for y in (low_lat, high_lat) for x in (low_lon, high_lon)], axis=0)
        one_lat, one_lon = np.array([r["one"]["lat"] for r in cells], float), np.array([r["one"]["lon"] for r in cells], float)
        known = max(all_km(one_lat[i : i + 500], one_lon[i : i + 500], one_lat, one_lon).max() for i in range(0, len(cells), 500))
        far = np.zeros(len(cells), bool)
        for i in range(0, len(cells), 500):
            reach = all_km(lat[i : i + 500], lon[i : i + 500], lat, lon) + radius[i : i + 500, None] + radius[None, :] + 1e-6
            far[i : i + 500] |= (reach >= known).any(axis=1)
        kept = [(int(np.floor(y / size)), int(np.floor(x / size))) for y, x, f in zip(low_lat, low_lon, far) if f]
        chosen = points.sparkSession.createDataFrame(kept, "_lat long, _lon long")
        named = points.select("*", *cell)
        points = settle(named.join(F.broadcast(chosen), ["_lat", "_lon"], "left_semi").select("lat", "lon"))
        size /= 4


def city_distances(pairs: DataFrame, cities: DataFrame) -> DataFrame:
    """(from_city, to_city, distance, base_cost, back_cost) of the given pairs of cities, by two lookups.

    Only pairs that are asked for are priced, so the number of rows is theirs and not the square of the
    cities. Pairs of a city with itself, and of cities without coordinates, are left out.
    """
    end = [("1", "from_city", "base_cost"), ("2", "to_city", "back_cost")]
    known = pairs.select("from_city", "to_city").where("from_city <> to_city").distinct()
    for n, name, cost in end:
        side = cities.select(
            F.col("city_id").alias(name), F.col("centroid_lat").alias(f"_lat{n}"), F.col("centroid_lon").alias(f"_lon{n}"),
            F.col("shipping_costs_mean").alias(cost),
        )
        known = known.join(side, name)
    distance = great_circle_km(F.col("_lat1"), F.col("_lon1"), F.col("_lat2"), F.col("_lon2"))
    return known.select("from_city", "to_city", distance.alias("distance"), "base_cost", "back_cost")


def directed_lanes(distances: DataFrame, longest: float) -> DataFrame:
    """Cost of each direction: origin's mean shipping cost scaled by the relative distance."""
    cost = lane_cost(F.col("base_cost"), F.col("distance"), F.lit(longest))
    return distances.select("from_city", "to_city", "distance", cost.alias("cost"))


def city_lanes(pairs: DataFrame, cities: DataFrame, longest: float | None = None) -> DataFrame:
    """(from_city, to_city, distance, cost) of the given pairs: the mean cost of both directions."""
    longest = longest_distance(cities) if longest is None else longest
    base = (F.col("base_cost") + F.col("back_cost")) / 2
    priced = city_distances(pairs, cities).withColumn("cost", lane_cost(base, F.col("distance"), F.lit(longest)))
    return priced.select("from_city", "to_city", "distance", "cost")


def city_pairs(pairs: DataFrame, store_city: DataFrame) -> DataFrame:
    """The pairs of cities that occur among pairs of stores (from_store, to_store)."""
    known = pairs.select("from_store", "to_store").distinct()
    for end in ("from", "to"):
        side = store_city.select(F.col("store_id").alias(f"{end}_store"), F.col("city_id").alias(f"{end}_city"))
        known = known.join(side, f"{end}_store")
    return known.select("from_city", "to_city").distinct()


def store_lane_costs(
    pairs: DataFrame, store_city: DataFrame, lanes: DataFrame, local: float = LOCAL_LANE_COST
) -> DataFrame:
    """Lane cost and unit cost of the given (from_store, to_store) pairs.

    Stores get their cities by two lookups, then the city lane. The full store × store table, with its
    square number of rows, is never built. A pair without a lane has a null lane cost and the default unit cost.
    """
    start = store_city.select(F.col("store_id").alias("from_store"), F.col("city_id").alias("from_city"))
    end = store_city.select(F.col("store_id").alias("to_store"), F.col("city_id").alias("to_city"))
    costs = lanes.select("from_city", "to_city", F.col("cost").alias("_lane"))
    known = pairs.join(start, "from_store", "left").join(end, "to_store", "left")
    priced = known.join(costs, ["from_city", "to_city"], "left")
    same = F.col("from_store") == F.col("to_store")
    lane = F.when(same, F.lit(0.0)).when(F.col("from_city") == F.col("to_city"), F.lit(local)).otherwise(F.col("_lane"))
    out = priced.withColumn("lane_cost", lane)
    return out.withColumn("unit_cost", unit_lane_cost(F.col("lane_cost"), same)).drop("_lane")


def store_lane_blocks(store_city: DataFrame, lanes: DataFrame, local: float = LOCAL_LANE_COST) -> DataFrame:
    """Ordered store pairs of the given lanes and within cities, one row per pair of cities: its cost and how
    many store pairs share it.

    This holds what the dense store matrix holds for those cities, because a lane's cost depends on the cities only.
    """
    sizes = store_city.groupBy("city_id").agg(F.count("*").alias("n"))
    start = sizes.select(F.col("city_id").alias("from_city"), F.col("n").alias("_a"))
    end = sizes.select(F.col("city_id").alias("to_city"), F.col("n").alias("_b"))
    between = (
        lanes.join(start, "from_city").join(end, "to_city")
        .select("from_city", "to_city", "cost", (F.col("_a") * F.col("_b")).alias("n_pairs"))
    )
    inside = sizes.where("n > 1").select(
        F.col("city_id").alias("from_city"), F.col("city_id").alias("to_city"),
        F.lit(float(local)).alias("cost"), (F.col("n") * (F.col("n") - 1)).alias("n_pairs"),
    )
    return between.unionByName(inside)


def weighted_summary(lanes: DataFrame, value: str, weight: Column | None = None) -> DataFrame:
    """Lowest and mean positive value and the highest value; `weight` counts how often a row stands."""
    times = F.lit(1) if weight is None else weight
    positive = F.col(value) > 0
    total = F.sum(F.when(positive, F.col(value) * times))
    return lanes.agg(
        F.min(F.when(positive, F.col(value))).alias("lowest"),
        F.try_divide(total, F.sum(F.when(positive, times))).alias("mean_value"),
        F.max(value).alias("highest"),
    )
