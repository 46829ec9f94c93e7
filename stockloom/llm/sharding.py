"""Sharding by a two-pass external shuffle.

Pass one scatters all rows by a seeded hash into buckets small enough for the memory of a task, whatever
the size of the input. Pass two brings each bucket into random order by Fisher-Yates (Spark's `shuffle` of
an array) and writes it. The buckets end to end are a random order of all rows; the number of rows before a
bucket turns a place in it into a place in that order, and cutting the order into equal runs gives shards
whose row counts differ by at most one.

Both passes are Spark operations. A bucket is the only thing a task ever holds, and its size is set by
`bucket_bytes`; the table of bucket counts has at most MOST_BUCKETS rows. The order is fixed by being written.

Defined results: a null text counts no bytes. Rows with null or repeated ids and rows repeated in full are
rows like any other, scattered by their place in the input. With fewer rows than shards the last shards stay
empty; an empty table gives no rows. Input columns named `shard` or `slot` are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockloom.llm.common import col, partitions, stored

SHARDS = 40
SEED = 8
BUCKET_BYTES = 8 << 20
#: Buckets grow beyond `bucket_bytes` rather than become more than this; their table may be broadcast (24 MB).
MOST_BUCKETS = 1 << 20


def record_size(text: Column) -> Column:
    """UTF-8 bytes of the text plus 16."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 16


def shuffled_buckets(docs: DataFrame, text: str = "text", seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """All rows as written by the two passes: `row` (the columns of `docs`), `bucket` and `place` in it."""
    total = docs.agg(F.sum(record_size(col(text)))).first()[0] or 0
    n = max(partitions(docs.sparkSession), min(MOST_BUCKETS, math.ceil(total / bucket_bytes)))
    rows = docs.select(F.monotonically_increasing_id().alias("at"), F.struct(*[col(c) for c in docs.columns]).alias("row"))
    scattered = rows.withColumn("bucket", F.pmod(F.xxhash64(F.lit(seed), F.col("at")), F.lit(n)).cast("int")).repartition(n, "bucket")
    # Fisher-Yates starts from a defined order, so a repeated task draws the same one.
    gathered = scattered.groupBy("bucket").agg(F.sort_array(F.collect_list(F.struct("at", "row"))).alias("rows"))
    drawn = gathered.select("bucket", F.posexplode(F.shuffle("rows", F.lit(seed))).alias("place", "one"))
    return stored(drawn.select("bucket", "place", F.col("one.row").alias("row")), "buckets")


def shard(
    docs: DataFrame, shards: int = SHARDS, text: str = "text", seed: int = SEED, bucket_bytes: int = BUCKET_BYTES
) -> DataFrame:
    """The documents with `shard` (0 to shards - 1) and `slot` (from 0, without gaps, in each shard).

    Row counts of shards differ by at most one.
    """
    drawn = shuffled_buckets(docs, text, seed, bucket_bytes)
    counts = drawn.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    upto = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("bucket", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("before"))  # one row per bucket
    total = max(1, drawn.count())
    placed = drawn.join(F.broadcast(before), "bucket")
    at = F.col("before") + F.col("place")
    # Shard s holds the places from ceil(s * total / shards) on.
    first = F.expr(f"(shard * {total} + {shards - 1}) div {shards}")
    own = [c for c in docs.columns if c.lower() not in ("shard", "slot")]
    return (
        placed.select("row", at.alias("at")).withColumn("shard", F.expr(f"at * {shards} div {total}"))
        .withColumn("slot", (F.col("at") - first).cast("long"))
        .select(*[F.col("row").getField(c).alias(c) for c in own], F.col("shard").cast("int").alias("shard"), "slot")
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder of Parquet files per shard, rows in the order of their slots within each file."""
    n = partitions(sharded.sparkSession)
    spread = sharded.repartitionByRange(n, "shard", "slot").sortWithinPartitions("shard", "slot")
    spread.write.mode("overwrite").partitionBy("shard").parquet(path)
