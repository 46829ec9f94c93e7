"""Readers for the demand, logistics, hand-over and result files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockloom import schemas
from stockloom.functions.values import lenient_date, lenient_timestamp, nan_to_null, strict_date, strict_timestamp


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header line and declared types (no inference pass)."""
    return spark.read.schema(schema).option("header", True).option("escape", '"').csv(path)


def read_demand(spark: SparkSession, path: str, lenient: bool = False) -> DataFrame:
    """Demand rows with parsed dates. `lenient` turns a bad date into null instead of failing."""
    raw = read_csv(spark, path, schemas.DEMAND_CSV)
    parse = lenient_date if lenient else strict_date
    return nan_to_null(raw.withColumn("dt", parse(F.col("dt"))))


def read_logistics(spark: SparkSession, path: str, lenient: bool = False) -> DataFrame:
    raw = read_csv(spark, path, schemas.LOGISTICS_CSV)
    parse = lenient_timestamp if lenient else strict_timestamp
    stamped = raw.withColumn("timestamp", parse(F.col("timestamp")))
    return nan_to_null(stamped).withColumn("date", F.col("timestamp").cast("date"))


def parse_hours(demand: DataFrame) -> DataFrame:
    """Turn the two list-in-text columns into arrays and check them against the daily columns.

    `hours_ok` holds when both lists have 24 entries, the hourly sales add up to the daily sale and the
    stock-out flags of hours 6 to 21 add up to the daily count.
    """
    arrays = demand.withColumns(
        {
            "hours_sale": F.from_json("hours_sale", "array<double>"),
            "hours_stock_status": F.from_json("hours_stock_status", "array<int>"),
        }
    )
    sold = F.aggregate("hours_sale", F.lit(0.0), lambda total, x: total + x)
    out = F.aggregate(F.slice("hours_stock_status", 7, 16), F.lit(0), lambda total, x: total + x)
    full_day = (F.size("hours_sale") == 24) & (F.size("hours_stock_status") == 24)
    agree = (F.abs(sold - F.col("sale_amount")) < 1e-6) & (out == F.col("stock_hour6_22_cnt"))
    return arrays.withColumn("hours_ok", F.coalesce(full_day & agree, F.lit(False)))


def read_lane_matrix(spark: SparkSession, path: str) -> DataFrame:
    """A wide store × store matrix (first column is the row label) as (from_id, to_id, cost).

    Lines are cut as text: a matrix has as many columns as stores, which is no schema to plan with. The one
    header line, which starts with a label that is no number, is matched to the cells by their place.
    """
    cells = spark.read.text(path).select(F.split("value", ",").alias("_cells"))
    numbered = F.try_element_at("_cells", F.lit(1)).try_cast("bigint")
    header = cells.where(numbered.isNull()).select(F.posexplode("_cells").alias("_place", "to_id")).where("_place > 0")
    rows = cells.where(numbered.isNotNull()).select(numbered.alias("from_id"), F.posexplode("_cells").alias("_place", "cost"))
    joined = rows.where("_place > 0").join(header, "_place")
    return joined.select("from_id", F.col("to_id").cast("bigint").alias("to_id"), F.col("cost").cast("double").alias("cost"))


def read_lane_tiles(spark: SparkSession, path: str, origins: DataFrame | None = None) -> DataFrame:
    """The lanes of stored tiles as (from_id, to_id, cost); with `origins` (id) only theirs, from their rows of tiles."""
    ids, tiles = spark.read.parquet(f"{path}/ids"), spark.read.parquet(f"{path}/tiles")
    wanted = ids if origins is None else ids.join(origins.select("id"), "id", "left_semi")
    if origins is not None:
        tiles = tiles.join(wanted.select(F.col("block").alias("row_block")).distinct(), "row_block", "left_semi")
    cells = tiles.select("row_block", "column_block", "side", F.explode(F.arrays_zip("places", "costs")).alias("_c"))
    cells = cells.select(
        "row_block", "column_block", (F.col("_c.places") / F.col("side")).cast("int").alias("_row"),
        F.pmod(F.col("_c.places"), F.col("side")).alias("_column"), F.col("_c.costs").alias("cost"),
    )
    row = wanted.select(F.col("id").alias("from_id"), F.col("block").alias("row_block"), F.col("place").alias("_row"))
    column = ids.select(F.col("id").alias("to_id"), F.col("block").alias("column_block"), F.col("place").alias("_column"))
    return cells.join(row, ["row_block", "_row"]).join(column, ["column_block", "_column"]).select("from_id", "to_id", "cost")


def _read_document(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_transfers(spark: SparkSession, path: str) -> DataFrame:
    """One row per transfer, with its place in the document."""
    doc = _read_document(spark, path, schemas.TRANSFER_DOCUMENT)
    return doc.select("scenario", F.posexplode("transfers").alias("position", "t")).select("scenario", "position", "t.*")


def read_manufacturing(spark: SparkSession, path: str) -> DataFrame:
    doc = _read_document(spark, path, schemas.MANUFACTURING_DOCUMENT)
    rows = doc.select("scenario", F.posexplode("manufacturing_actions").alias("position", "m"))
    return rows.select("scenario", "position", "m.*")


def read_scenario(spark: SparkSession, path: str) -> DataFrame:
    return _read_document(spark, path, schemas.SCENARIO_DOCUMENT)


def read_document(spark: SparkSession, path: str, record: T.StructType) -> DataFrame:
    """(scenario, record fields…) of a document written line by line, read by as many tasks as it needs."""
    lines = spark.read.text(path)
    scenario = lines.where(F.col("value").endswith("[")).select(
        F.get_json_object(F.concat("value", F.lit("]}")), "$.scenario").alias("scenario")
    )
    body = lines.where(F.col("value").endswith("}") & (F.col("value") != "]}"))
    records = body.select(F.from_json(F.ltrim(F.col("value"), F.lit(",")), record).alias("_r"))
    return records.join(F.broadcast(scenario)).select("scenario", "_r.*")  # one opening line


def read_records(spark: SparkSession, path: str, record: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Records kept one per line: those that fit the declared types, and the lines of those that do not."""
    parsed = spark.read.text(path).select(
        F.col("value").alias("record"),
        F.from_json("value", T.StructType([*record.fields, T.StructField("_broken", T.StringType())]), {"columnNameOfCorruptRecord": "_broken"}).alias("_r"),
    )
    fits = F.col("_r").isNotNull() & F.col("_r._broken").isNull()
    good = parsed.where(fits).select(*[F.col(f"_r.{f}") for f in record.fieldNames()])
    return good, parsed.where(~fits).select("record")


def quoted_list(text: Column) -> Column:
    """A list written with single quotes, as an array."""
    return F.from_json(F.translate(text, "'", '"'), "array<string>")


def read_result_csv(spark: SparkSession, path: str, schema: T.StructType = schemas.TRANSFERS_CSV) -> DataFrame:
    """A result file whose reason codes are a quoted list in text."""
    return read_csv(spark, path, schema).withColumn("reason_codes", quoted_list(F.col("reason_codes")))


def keep_stores(df: DataFrame, stores: DataFrame) -> DataFrame:
    """Rows of the chosen stores only."""
    return df.join(stores.select("store_id"), "store_id", "left_semi")
