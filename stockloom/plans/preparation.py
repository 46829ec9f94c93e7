"""From raw demand and logistics to the tables the later steps read."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from stockloom.operators import demand as dm
from stockloom.operators import lanes as ln
from stockloom.session import settle
from stockloom.sources import sinks


@dataclass(frozen=True)
class Prepared:
    series_day: DataFrame
    series_params: DataFrame
    city_params: DataFrame
    store_params: DataFrame
    longest_km: float

    def city_lanes(self, pairs: DataFrame) -> DataFrame:
        """Lanes of the pairs of cities that are needed."""
        return ln.city_lanes(pairs, self.city_params, self.longest_km)


def prepare(demand: DataFrame, logistics: DataFrame, seed: int = 42, starts: int = 10) -> Prepared:
    """Daily demand and its parameters, regions matched to cities from west to east.

    The number of regions is the number of cities, so every city gets one. The store and city tables are
    stored: they are small, read by all that follows, and costly to derive.
    """
    daily = dm.series_day(demand)
    stores = settle(dm.store_city(demand))
    cities = stores.select("city_id").distinct().where("city_id IS NOT NULL")
    model = ln.fit_regions(logistics, cities.count(), seed, starts)
    regions = ln.region_params(ln.assign_regions(logistics, model)).join(ln.centroids(model, logistics), "geo_cluster")
    city_params = settle(ln.zip_cities(cities, regions))
    return Prepared(
        series_day=daily,
        series_params=dm.with_inventory(dm.series_params(daily)),
        city_params=city_params,
        store_params=ln.store_supply(stores, city_params),
        longest_km=ln.longest_distance(city_params),
    )


def save(prepared: Prepared, folder: str) -> None:
    """Write the prepared tables: the large daily table as date-partitioned parquet, the others as CSV."""
    prepared.series_day.hint("rebalance", "date").write.mode("overwrite").partitionBy("date").parquet(f"{folder}/series_day")
    for name in ("series_params", "city_params", "store_params"):
        sinks.write_table(getattr(prepared, name), f"{folder}/{name}")
