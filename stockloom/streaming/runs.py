"""Run a stream over what has arrived, and read its result and progress."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stockloom.session import scratch_path


def append_to(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append new rows to a parquet table, exactly once, and stop when all that has arrived is read."""
    query = (
        stream.writeStream.format("parquet").outputMode("append").option("path", path)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query


def each_batch(stream: DataFrame, take: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Hand every micro-batch to `take`. A batch may be handed over again after a failure, under its number."""
    query = (
        stream.writeStream.foreachBatch(take).outputMode(mode)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query


def log_updates(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write the rows that changed in each micro-batch to `path/batch_id=…`.

    A batch that is run again after a failure overwrites its own folder. Only changed rows are written,
    so a batch costs what it changes and not the size of the whole result.
    """
    return each_batch(stream, lambda b, n: b.write.mode("overwrite").parquet(f"{path}/batch_id={n}"), checkpoint, "update")


def log_parts(stream: DataFrame, make: Callable[[DataFrame], DataFrame], path: str, checkpoint: str) -> StreamingQuery:
    """Write what `make` sums up of each micro-batch to `path/batch_id=…`."""
    return each_batch(stream, lambda b, n: make(b).write.mode("overwrite").parquet(f"{path}/batch_id={n}"), checkpoint)


def log_progress(stream: DataFrame, keep: Callable[[DataFrame], DataFrame], path: str, checkpoint: str) -> StreamingQuery:
    """Append the rows `keep` lets through to `path/rows`, by batch, and a line per batch to `path/progress`:
    rows read, rows kept and rows per second. Every batch has its line, however many there are."""

    def take(batch: DataFrame, number: int) -> None:
        spark, start = batch.sparkSession, time.perf_counter()
        # Counted while the batch is written, so it is read once.
        read, kept = Observation(f"read-{number}"), Observation(f"kept-{number}")
        counted = batch.observe(read, F.count(F.lit(1)).alias("n"))
        keep(counted).observe(kept, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{path}/rows/batch_id={number}")
        seconds = time.perf_counter() - start
        told = spark.createDataFrame([(read.get["n"], kept.get["n"], seconds)], "rows_read bigint, rows_kept bigint, seconds double")
        told.coalesce(1).write.mode("overwrite").parquet(f"{path}/progress/batch_id={number}")

    return each_batch(stream, take, checkpoint)


def progress(spark: SparkSession, path: str) -> DataFrame:
    """(batch_id, rows_read, rows_kept, rows_per_second) of all batches of `log_progress`."""
    told = spark.read.parquet(f"{path}/progress")
    return told.select(
        F.col("batch_id").cast("bigint").alias("batch_id"), "rows_read", "rows_kept",
        F.try_divide("rows_read", "seconds").alias("rows_per_second"),
    )


def latest(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The newest row per key of a log of updates."""
    log = spark.read.parquet(path)
    values = [c for c in log.columns if c not in (*keys, "batch_id")]
    newest = log.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch_id").alias("_row"))
    return newest.select(*keys, "_row.*")


def run_append(stream: DataFrame, label: str) -> DataFrame:
    """Append everything that has arrived to a new table in the shared folder and read it."""
    spark = stream.sparkSession
    path = scratch_path(spark, label)
    append_to(stream, path, f"{path}-state")
    return spark.read.schema(stream.schema).parquet(path)


def run_updates(stream: DataFrame, label: str, keys: Sequence[str]) -> DataFrame:
    spark = stream.sparkSession
    path = scratch_path(spark, label)
    log_updates(stream, path, f"{path}-state")
    return latest(spark, path, keys)


def run_parts(stream: DataFrame, make: Callable[[DataFrame], DataFrame], merge: Callable[[DataFrame], DataFrame], label: str) -> DataFrame:
    """Sum up every batch by `make` and merge the parts of all batches by `merge`."""
    spark = stream.sparkSession
    path = scratch_path(spark, label)
    log_parts(stream, make, path, f"{path}-state")
    return merge(spark.read.parquet(path).drop("batch_id"))
