"""Demand per store, product and day, and the parameters derived from it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockloom.functions.values import key_normal, not_below, ratio_or

SERIES = ["store_id", "product_id"]


def series_day(demand: DataFrame) -> DataFrame:
    """One row per store, product, city and day."""
    return (
        demand.where("store_id IS NOT NULL AND product_id IS NOT NULL AND city_id IS NOT NULL AND dt IS NOT NULL")
        .groupBy(*SERIES, "city_id", F.col("dt").alias("date"))
        .agg(
            F.coalesce(F.sum("sale_amount"), F.lit(0.0)).alias("demand"),
            F.avg("stock_hour6_22_cnt").alias("avg_stockout_hours"),
            F.avg("discount").alias("avg_discount"),
            F.max("holiday_flag").alias("is_holiday"),
            F.max("activity_flag").alias("has_promotion"),
        )
    )


def series_params(daily: DataFrame) -> DataFrame:
    """Demand level, spread and context per series. A spread that cannot be computed counts as 0 in the
    coefficient of variation."""
    params = daily.groupBy(*SERIES, "city_id").agg(
        F.avg("demand").alias("avg_daily_demand"),
        F.stddev_samp("demand").alias("demand_std"),
        F.sum("demand").alias("total_demand"),
        F.count("demand").alias("num_days"),
        F.avg("avg_stockout_hours").alias("avg_stockout_hours"),
        F.avg("avg_discount").alias("avg_discount"),
        F.avg("is_holiday").alias("holiday_proportion"),
        F.avg("has_promotion").alias("promotion_proportion"),
    )
    return params.withColumn("demand_cv", ratio_or(F.col("demand_std"), F.col("avg_daily_demand"), 0.0))


def with_inventory(params: DataFrame, cover_days: int = 7) -> DataFrame:
    """Add stock and its distance from a week of demand.

    A `current_inventory` column in the input is used as it is. Without one, stock is simulated around
    the weekly demand with a number that depends on the series key only.
    """
    week = F.col("avg_daily_demand") * cover_days
    if "current_inventory" not in params.columns:
        params = params.withColumn("current_inventory", not_below(week * (1 + 0.3 * key_normal(SERIES))))
    return params.withColumn("inventory_imbalance", F.col("current_inventory") - week)


def top_stores(demand: DataFrame, n: int = 20) -> DataFrame:
    """The stores with the highest total demand."""
    totals = demand.where("store_id IS NOT NULL").groupBy("store_id").agg(F.sum("sale_amount").alias("total_demand"))
    return totals.orderBy(F.desc("total_demand"), "store_id").limit(n)


def store_city(demand: DataFrame) -> DataFrame:
    """One city per store (the lowest id), with the number of different cities seen, which should be 1."""
    return (
        demand.where("store_id IS NOT NULL")
        .groupBy("store_id")
        .agg(F.min("city_id").alias("city_id"), F.count_distinct("city_id").alias("n_cities"))
    )
