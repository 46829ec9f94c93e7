"""Streaming versions of the discovery, selection and daily demand steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DAY = ["store_id", "product_id", "date"]


def running_store_demand(stream: DataFrame) -> DataFrame:
    """Total demand per store so far. State: one row per store."""
    return stream.where("store_id IS NOT NULL").groupBy("store_id").agg(F.sum("sale_amount").alias("total_demand"))


def kept_stores(rows: DataFrame, top: DataFrame) -> DataFrame:
    """Arriving rows of the chosen stores. `top` is read again in every micro-batch, so pass a stored table."""
    return rows.join(top.select("store_id"), "store_id", "left_semi")


def daily_parts(rows: DataFrame, moment: str = "dt") -> DataFrame:
    """What some rows add to the demand per store, product and day. Days are those of the session time zone."""
    dated = rows.withColumn("date", F.col(moment).cast("date"))
    return dated.groupBy(*DAY).agg(F.sum("sale_amount").alias("demand"), F.max("holiday_flag").alias("is_holiday"))


def merged_days(parts: DataFrame) -> DataFrame:
    """Daily demand from the parts of any number of batches, in whatever order the days arrived.

    Files of a backlog are not in the order of their dates, so no date can be closed while files may still
    come: sums are kept as parts, added up when read, and can be merged into fewer parts at any time.
    """
    return parts.groupBy(*DAY).agg(F.sum("demand").alias("demand"), F.max("is_holiday").alias("is_holiday"))
