"""Ordered scans (running sums, row numbers) that hold up when one group has most of the rows.

A window over a group puts that whole group into one task. Here a group is cut into chunks that follow
its order: the window runs inside each chunk, a second window runs over one summary row per chunk, and
the two are added.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockloom.session import settle

IDS_PER_CHUNK = 4096


def ordered_chunks(df: DataFrame, order: Sequence[str], chunks: int | None = None) -> DataFrame:
    """Sort-partition the rows by `order` and tag each row with its partition number, `chunk`. `chunks`: that many, where
    there are rows for them, whatever their size.

    Range bounds come from a sample of the rows, so a hot leading key is split like any other. The
    stored table pins the numbers: both reads of the result see the same cut.
    """
    return settle(df.repartitionByRange(*([chunks] if chunks else []), *order).withColumn("chunk", F.spark_partition_id()))


def running_total(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], values: dict[str, str], chunk: str = "chunk"
) -> DataFrame:
    """Add, per value column, `<name>_start` and `<name>_end` (running sum before and after the row) and
    `<name>_total` (sum of the group). `values` maps the new name to the summed column; `chunk` must
    rise with `order` inside a group."""
    keys, order = list(keys), list(order)
    # Both reads below start from this exchange, so `df` is computed and shuffled once.
    df = df.repartition(*keys, chunk)
    parts = df.groupBy(*keys, chunk).agg(*[F.sum(v).alias(f"_{n}_sum") for n, v in values.items()])
    over_chunks = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    before = over_chunks.orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        *keys,
        chunk,
        *[F.coalesce(F.sum(f"_{n}_sum").over(before), F.lit(0)).alias(f"_{n}_before") for n in values],
        *[F.sum(f"_{n}_sum").over(over_chunks).alias(f"{n}_total") for n in values],
    )
    inside = Window.partitionBy(*keys, chunk).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = df.select("*", *[F.sum(v).over(inside).alias(f"_{n}_local") for n, v in values.items()])
    joined = local.join(offsets, [*keys, chunk])
    ends = {f"{n}_end": F.col(f"_{n}_before") + F.col(f"_{n}_local") for n in values}
    starts = {f"{n}_start": F.col(f"{n}_end") - F.col(v) for n, v in values.items()}
    scratch = [f"_{n}_{part}" for n in values for part in ("before", "local")]
    return joined.withColumns(ends).withColumns(starts).drop(*scratch)


def row_numbers(df: DataFrame, order: Sequence[str], name: str = "row_number") -> DataFrame:
    """Number all rows 1..n in the given (unique) order without sorting them in one task."""
    counted = ordered_chunks(df, order).withColumn("_one", F.lit(1).cast("bigint"))
    numbered = running_total(counted, [], order, {"_row": "_one"})
    return numbered.withColumnRenamed("_row_end", name).drop("_row_start", "_row_total", "_one", "chunk")


def id_chunks(df: DataFrame, column: str, width: int = IDS_PER_CHUNK) -> DataFrame:
    """(column, chunk): the different ids in order, `width` to a chunk, however far apart they lie."""
    numbered = row_numbers(df.select(column).where(F.col(column).isNotNull()).distinct(), [column], "_n")
    return settle(numbered.select(column, F.expr(f"(_n - 1) div {width}").alias("chunk")))


def carry_last(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, name: str, chunk: str = "chunk"
) -> DataFrame:
    """Add the last non-null `value` among the rows before each row of its group."""
    keys, order = list(keys), list(order)
    marked = df.withColumn("_value", value).repartition(*keys, chunk)  # shared by both reads below
    inside = Window.partitionBy(*keys, chunk).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    position = F.struct(*order)
    tails = marked.groupBy(*keys, chunk).agg(
        F.max_by("_value", F.when(F.col("_value").isNotNull(), position)).alias("_tail")
    )
    before = Window.partitionBy(*keys).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    carried = tails.select(*keys, chunk, F.last("_tail", ignorenulls=True).over(before).alias("_earlier"))
    local = marked.withColumn("_near", F.last("_value", ignorenulls=True).over(inside))
    return (
        local.join(carried, [*keys, chunk])
        .withColumn(name, F.coalesce("_near", "_earlier"))
        .drop("_value", "_near", "_earlier")
    )
