"""Session settings and the shared folder that holds checkpoints and hand-over tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def local_session(cores: str = "8", name: str = "stockloom", extra: dict[str, str] | None = None) -> SparkSession:
    """A local session for tests and the bench. A cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster.

    Only a local session may fall back to a temporary folder: on a cluster that folder would sit on
    one machine, so a missing setting is an error there.
    """
    context = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_SETTING, None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_SETTING} to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="run-")
        spark.conf.set(CHECKPOINT_SETTING, folder)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return os.path.join(shared_folder(spark), f"{label}-{uuid.uuid4().hex}")


_kept: list[str] = []


def settle(df: DataFrame, row_group: int | None = None) -> DataFrame:
    """Write `df` to the shared folder and read it back: cuts the lineage and survives the loss of executors.

    Columnar, so each reader takes the columns it needs, and computed once. `discard` removes the files. `row_group`:
    bytes of a row group, smaller than Parquet's where a table is narrow and much is computed from each row, since
    a row group is the least a task can read.
    """
    path = scratch_path(df.sparkSession, "kept")
    writer = df.write.option("compression", "zstd")
    (writer.option("parquet.block.size", row_group) if row_group else writer).parquet(path)
    _kept.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession) -> None:
    """Delete what `settle` has written in this process. Frames built on it cannot be read any more."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    while _kept:
        place = jvm.org.apache.hadoop.fs.Path(_kept.pop())
        place.getFileSystem(conf).delete(place, True)
