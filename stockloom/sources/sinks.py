"""Writers: CSV, parquet landing, the wide lane matrix and nested result documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockloom.operators.ordered import row_numbers


#: Rows of a CSV file at most. A compressed file is read by one task, so its size must not follow that of its writer's input.
ROWS_PER_FILE = 100_000


def write_table(df: DataFrame, path: str) -> None:
    """CSV with a header, compressed by gzip (readers go by the ending). Arrays and structs are written as JSON text."""
    nested = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType))]
    flat = df.withColumns({c: F.to_json(c) for c in nested}) if nested else df
    packed = flat.write.mode("overwrite").option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")
    packed.option("maxRecordsPerFile", ROWS_PER_FILE).option("header", True).option("escape", '"').csv(path)


def land_demand(spark: SparkSession, source: str, target: str, partition: str = "dt") -> None:
    """Copy a bulk parquet set into date-partitioned parquet.

    Rows go to their date; the rebalance hint then lets adaptive execution cut a large date into as many
    tasks as its size needs and join small ones.
    """
    rows = spark.read.parquet(source)
    rows.hint("rebalance", partition).write.mode("overwrite").partitionBy(partition).parquet(target)


#: Rows and columns of a tile of a lane matrix.
TILE = 512


def write_lane_tiles(lanes: DataFrame, path: str, side: int = TILE) -> None:
    """A (from_id, to_id, cost) table as the tiles of a matrix, the stored form for any number of ids.

    `path/ids` numbers the ids: (id, block, place). `path/tiles` has a row per tile with any lane: (row_block, column_block,
    places, costs), a place being row * side + column inside the tile. No row is longer than a tile, pairs without a
    lane take no room, and readers of some origins or destinations open their blocks only.
    """
    every = lanes.select(F.col("from_id").alias("id")).unionByName(lanes.select(F.col("to_id").alias("id"))).distinct()
    numbered = row_numbers(every, ["id"], "_n").select("id", ((F.col("_n") - 1) / side).cast("int").alias("block"), F.pmod(F.col("_n") - 1, F.lit(side)).cast("int").alias("place"))
    numbered.write.mode("overwrite").parquet(f"{path}/ids")
    ids = lanes.sparkSession.read.parquet(f"{path}/ids")
    row, column = (ids.select(F.col("id").alias(c), F.col("block").alias(f"{n}_block"), F.col("place").alias(f"_{n}")) for c, n in (("from_id", "row"), ("to_id", "column")))
    placed = lanes.join(row, "from_id").join(column, "to_id")
    cell = F.struct((F.col("_row") * side + F.col("_column")).alias("place"), F.col("cost").cast("double").alias("cost"))
    tiles = placed.groupBy("row_block", "column_block").agg(F.array_sort(F.collect_list(cell)).alias("_cells"))
    shown = tiles.select("row_block", "column_block", F.lit(side).alias("side"), F.col("_cells.place").alias("places"), F.col("_cells.cost").alias("costs"))
    shown.repartitionByRange("row_block", "column_block").sortWithinPartitions("row_block", "column_block").write.mode("overwrite").parquet(f"{path}/tiles")


def write_lane_matrix(lanes: DataFrame, path: str) -> None:
    """The labelled wide form of a (from_id, to_id, cost) table as CSV lines: a header of all ids, then a
    line per origin. Pairs that are not in the table get 0. For programs that ask for it; `write_lane_tiles` is the
    form that holds any number of ids.

    A line has a value per id by its nature; lines are made and written by many tasks, and the ids reach them
    as one broadcast row.
    """
    every = lanes.select(F.col("from_id").alias("id")).unionByName(lanes.select(F.col("to_id").alias("id")))
    ids = every.agg(F.array_sort(F.collect_set("id")).alias("_ids"))
    costs = lanes.groupBy("from_id").agg(F.map_from_entries(F.collect_list(F.struct("to_id", "cost"))).alias("_cost"))
    cells = F.transform("_ids", lambda i: F.coalesce(F.try_element_at("_cost", i), F.lit(0.0)).cast("string"))
    body = every.select(F.col("id").alias("from_id")).distinct().join(costs, "from_id", "left").join(F.broadcast(ids))
    line = F.concat_ws(",", F.col("from_id").cast("string"), F.array_join(cells, ","))
    header = ids.select(F.lit(-1).alias("_at"), F.concat_ws(",", F.lit("from_id"), F.array_join("_ids", ",")).alias("value"))
    rows = body.select(F.lit(0).alias("_at"), line.alias("value"))
    header.unionByName(rows).select("value").write.mode("overwrite").text(path)


def write_documents(rows: DataFrame, path: str) -> None:
    """Result records as JSON, one record per line, so that writing scales with the number of tasks."""
    rows.write.mode("overwrite").json(path)


def write_document(rows: DataFrame, path: str, list_name: str, scenario: str, order: str = "position") -> None:
    """One JSON document holding all records in a list by `order`, the form the page layer loads whole.

    It is written as lines in order: an opening line, a line per record, a closing line. The part files one
    after the other are the document, so many tasks write it and its length has no limit.
    """
    first = rows.agg(F.min(order).alias("_first"))
    record = F.to_json(F.struct(*[c for c in rows.columns if c != order]))
    comma = F.when(F.col(order) == F.col("_first"), "").otherwise(",")
    body = rows.join(F.broadcast(first)).select(F.lit(1).alias("_part"), F.col(order).alias("_at"), F.concat(comma, record).alias("value"))
    name = F.to_json(F.struct(F.lit(scenario).alias("scenario")))
    spark = rows.sparkSession
    opening = spark.range(1).select(F.lit(0).alias("_part"), F.lit(0).alias("_at"), F.concat(F.rtrim(name, F.lit("}")), F.lit(f', "{list_name}": [')).alias("value"))
    closing = spark.range(1).select(F.lit(2).alias("_part"), F.lit(0).alias("_at"), F.lit("]}").alias("value"))
    lines = opening.unionByName(body).unionByName(closing).orderBy("_part", "_at")
    lines.select("value").write.mode("overwrite").text(path)
