"""Demand, logistics, daily series and questions expressed over the order/line-item test tables.

Each view is a map from column name to (expression, dimension tables it needs). Only the requested
columns are built, so a query on dates and quantities reads two columns of `lineitem` and joins nothing.
Dimensions are looked up by left join: leaving one out never changes the rows. No join is hinted;
Spark broadcasts a dimension only when its size is below the session's threshold.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockloom.session import scratch_path

Spec = dict[str, tuple[Column, set[str]]]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stream_table(spark: SparkSession, folder: str, name: str, files_per_batch: int | None = None) -> DataFrame:
    """The same table as a file stream. `files_per_batch` bounds what one micro-batch reads."""
    reader = spark.readStream.schema(table(spark, folder, name).schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(f"{folder}/{name}.parquet*")


def _number(column: str) -> Column:
    return F.col(column).cast("double")


def demand_columns() -> Spec:
    c = F.col
    return {
        "store_id": (c("l_suppkey"), set()),
        "city_id": (c("s_nationkey"), {"supplier"}),
        "product_id": (F.replace(c("p_brand"), F.lit("Brand#"), F.lit("")).cast("int"), {"part"}),
        "dt": (c("l_shipdate").cast("date"), set()),
        "sale_amount": (c("l_quantity") - 1, set()),
        "stock_hour6_22_cnt": (c("l_linenumber") - 1, set()),
        "discount": (c("l_discount"), set()),
        "holiday_flag": ((F.weekday("l_shipdate") >= 5).cast("int"), set()),
        "activity_flag": ((c("l_returnflag") == "R").cast("int"), set()),
        "precpt": (c("l_tax"), set()),
        "avg_temperature": (F.round(c("l_extendedprice") / 10000, 2), set()),
        "avg_humidity": (c("l_discount") * 100, set()),
        "avg_wind_level": (_number("l_linenumber") / 2, set()),
    }


def logistics_columns() -> Spec:
    c = F.col
    days = F.abs(F.datediff("l_shipdate", "o_orderdate"))
    return {
        "timestamp": (c("o_orderdate"), {"orders"}),
        "date": (c("o_orderdate").cast("date"), {"orders"}),
        "region_id": (c("s_nationkey"), {"supplier"}),
        "vehicle_gps_latitude": (
            30 + _number("s_nationkey") * 7 % 20 + _number("l_suppkey") % 10 / 10, {"supplier"}),
        "vehicle_gps_longitude": (
            -115 + _number("s_nationkey") * 11 % 45 + _number("l_suppkey") % 7 / 10, {"supplier"}),
        "historical_demand": (c("l_quantity"), set()),
        "warehouse_inventory_level": (F.round(c("l_discount") * 500), set()),
        "shipping_costs": (c("l_extendedprice") * 0.01, set()),
        "lead_time_days": ((days % 14 + 1).cast("double"), {"orders"}),
        "delivery_time_deviation": ((_number("l_linenumber") - 4) / 2, set()),
        "delay_probability": (c("l_tax") * 12.5, set()),
        "disruption_likelihood_score": (c("l_discount") * 10, set()),
        "route_risk_level": (_number("l_orderkey") % 11, set()),
        "weather_condition_severity": (c("l_tax") * 10, set()),
        "traffic_congestion_level": (_number("l_linenumber"), set()),
        "port_congestion_level": (F.nullif(_number("l_partkey") % 10, F.lit(0.0)), set()),
        "supplier_reliability_score": (F.greatest(c("s_acctbal"), F.lit(0.0)) / 10000, {"supplier"}),
        "order_fulfillment_status": (c("o_orderstatus"), {"orders"}),
        "cargo_condition_status": (F.nullif(c("l_linestatus"), F.lit("F")), set()),
        "risk_classification": (c("o_orderpriority"), {"orders"}),
    }


_LOOKUPS = {
    "supplier": ("l_suppkey", "s_suppkey"),
    "part": ("l_partkey", "p_partkey"),
    "orders": ("l_orderkey", "o_orderkey"),
}


def _lineitem_view(
    spark: SparkSession, folder: str, spec: Spec, columns: Sequence[str], rows: DataFrame | None = None
) -> DataFrame:
    rows = table(spark, folder, "lineitem") if rows is None else rows
    needed = set().union(*[spec[name][1] for name in columns])
    for dimension in sorted(needed):
        ours, theirs = _LOOKUPS[dimension]
        side = table(spark, folder, dimension)
        rows = rows.join(side, rows[ours] == side[theirs], "left")
    return rows.select(*[spec[name][0].alias(name) for name in columns])


def demand(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    spec = demand_columns()
    return _lineitem_view(spark, folder, spec, columns or list(spec))


def demand_stream(
    spark: SparkSession, folder: str, *columns: str, read: Callable[[SparkSession, str, str], DataFrame] | None = None
) -> DataFrame:
    """Demand over arriving line items; dimensions are static."""
    spec = demand_columns()
    return _lineitem_view(spark, folder, spec, columns or list(spec), (read or stream_table)(spark, folder, "lineitem"))


def arriving(batches: int, *spread: str) -> Callable[[SparkSession, str, str], DataFrame]:
    """A reader of a table as a stream of so many micro-batches. Rows are dealt to files by a hash of the columns
    `spread`, so every file holds a mix of all dates. A batch has one file, and more where the table is read in more parts
    than there are batches: no task that writes or reads a file gets more the larger the table is."""

    def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
        rows = table(spark, folder, name)
        landed = scratch_path(spark, f"arriving-{name}")
        files = batches * -(-rows.rdd.getNumPartitions() // batches)
        rows.repartition(files, *spread).write.parquet(landed)  # a file per task that has rows
        written = len(spark.read.schema(rows.schema).parquet(landed).inputFiles())
        per_batch = max(1, -(-written // batches))
        return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", per_batch).parquet(landed)

    return read


def logistics(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    spec = logistics_columns()
    return _lineitem_view(spark, folder, spec, columns or list(spec))


def event_series(spark: SparkSession, folder: str) -> DataFrame:
    """A short dense daily series per event type: (series, dt, demand)."""
    events = table(spark, folder, "events")
    day = F.col("ts").cast("date").alias("dt")
    total = F.sum(F.col("value").cast("decimal(18,4)")).cast("double").alias("demand")
    return events.groupBy(F.col("event_type").alias("series"), day).agg(total)


def questions(spark: SparkSession, folder: str, read: Callable[[SparkSession, str, str], DataFrame] = table) -> DataFrame:
    """User turns of `conversations`, plus one question per order whose wording and ids come from the
    order itself (a customer is a conversation, the order key is the turn)."""
    said = read(spark, folder, "conversations").where("role = 'user'").select("conv_id", "turn", "text")
    ask = F.col("o_orderkey") % len(QUESTION_FORMS)
    stores = max(1, table(spark, folder, "supplier").count())  # a number, also where orders arrive as a stream
    ids = {"{s}": F.col("o_custkey") % stores, "{p}": F.col("o_orderkey") % 25, "{n}": F.col("o_orderkey") % 900 + 100}
    text = F.element_at(F.array(*[F.lit(q) for q in QUESTION_FORMS]), (ask + 1).cast("int"))
    for mark, value in ids.items():
        text = F.replace(text, F.lit(mark), value.cast("string"))
    asked = read(spark, folder, "orders").select(
        (F.col("o_custkey") + 1_000_000_000).alias("conv_id"), F.col("o_orderkey").alias("turn"), text.alias("text")
    )
    return said.unionByName(asked)


# Wording of the derived questions: {s} a store, {p} a product, {n} a record number.
QUESTION_FORMS = [
    "Why should I transfer product {p} out of store {s}?",
    "show all",
    "How many transfers do you suggest?",
    "Tell me about m_{n} and M{n}",
    "What was manufactured for product_{p}?",
    "How did the scenario perform?",
    "what was the cost impact",
    "Good morning",
    "your thoughts on store_{s}",
    "What is the weather today?",
    "and product {p}?",
    "Explain T{n} please",
    "list everything",
]

DEMAND_NAMES = (
    "store_id", "city_id", "product_id", "dt", "sale_amount", "stock_hour6_22_cnt", "discount", "holiday_flag",
    "activity_flag", "precpt", "avg_temperature", "avg_humidity", "avg_wind_level",
)
LOGISTICS_NAMES = (
    "timestamp", "date", "region_id", "vehicle_gps_latitude", "vehicle_gps_longitude", "historical_demand",
    "warehouse_inventory_level", "shipping_costs", "lead_time_days", "delivery_time_deviation",
    "delay_probability", "disruption_likelihood_score", "route_risk_level", "weather_condition_severity",
    "traffic_congestion_level", "port_congestion_level", "supplier_reliability_score",
    "order_fulfillment_status", "cargo_condition_status", "risk_classification",
)
