"""What the operators share: column names, byte-wise words, row numbers and hand-over tables."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockloom.session import scratch_path

ROW = "__row"


def col(name: str) -> Column:
    """The column of exactly that name, also when it holds dots or backticks."""
    return F.col("`" + name.replace("`", "``") + "`")


def replace_columns(df: DataFrame, new: dict[str, Column]) -> DataFrame:
    """Add columns at the end; a column of the input that has the name of a new one gives way."""
    taken = {n.lower() for n in new}
    kept = [col(c) for c in df.columns if c.lower() not in taken]
    return df.select(*kept, *[v.alias(k) for k, v in new.items()])


def stored(df: DataFrame, label: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write `df` to the shared folder and read it back.

    This cuts the lineage: an executor lost later never brings the steps before into play again, and two
    readers of the result do its work once. Unlike a checkpoint it is columnar, so each reader takes only
    the columns it needs.
    """
    path = scratch_path(df.sparkSession, label)
    writer = df.write.mode("overwrite")
    writer = writer.option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Give the Python workers this package, once per application, so that it need not be installed there."""
    context = spark.sparkContext
    if getattr(context, "_stockloom_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="ship-"), "stockloom.zip")  # Spark sends it on from here
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, files in os.walk(package):
            for name in files:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.join("stockloom", os.path.relpath(path, package)))
    context.addPyFile(target)
    context._stockloom_shipped = True


def partitions(spark: SparkSession) -> int:
    """The number of shuffle partitions the session is set to, which grows with the input."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def with_row_numbers(df: DataFrame, name: str = ROW) -> DataFrame:
    """Tag each row with a number of its own, the same again when a task of the scan is repeated.

    Needed because ids may be null or repeated; such rows still must not share a task or a result.
    """
    return df.select(F.monotonically_increasing_id().alias(name), *[col(c) for c in df.columns])


def ascii_lower(text: bytes) -> bytes:
    """Lower-case A-Z and nothing else (`bytes.lower` knows no other letters)."""
    return text.lower()


def words_of(text: bytes) -> list[bytes]:
    """Runs of bytes other than blank and 0x09-0x0D, which is what `bytes.split` splits at."""
    return text.split()


def utf8(batch: pa.RecordBatch, name: str) -> Iterator[bytes]:
    """The texts of a batch as UTF-8 bytes, null as empty, one at a time."""
    column = batch.column(batch.schema.get_field_index(name))
    for value in column.cast(pa.large_binary()):
        yield value.as_py() or b""


def arrow_map(
    df: DataFrame, per_batch: Callable[[pa.RecordBatch], dict[str, pa.Array]], carry: Iterable[str],
    added: list[tuple[str, T.DataType]],
) -> DataFrame:
    """Run `per_batch` over Arrow batches; the result has the columns `carry` and then the `added` ones."""
    names = {n.lower() for n, _ in added}
    own = df.columns
    carried = [c for c in carry if c.lower() not in names]
    schema = T.StructType([df.schema[c] for c in carried] + [T.StructField(n, t) for n, t in added])
    places = [own.index(c) for c in carried]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = pa.RecordBatch.from_arrays(batch.columns, own)
            made = per_batch(batch)
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in places] + [made[n] for n, _ in added], schema.names)

    numbered = df.select(*[col(c).alias(f"c{i}") for i, c in enumerate(own)])  # any name is allowed outside
    ship(df.sparkSession)
    return numbered.mapInArrow(run, schema)
