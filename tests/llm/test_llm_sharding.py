"""What holds for any shuffle into shards, and that it is one."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from stockloom.llm import sharding


def table(spark, n):
    return spark.range(n).select(
        F.when(F.col("id") % 5 == 0, None).otherwise(F.col("id") % 50).alias("doc_id"),
        F.when(F.col("id") % 7 == 0, None).otherwise(F.repeat(F.lit("é"), (F.col("id") % 90).cast("int"))).alias("text"),
        F.lit(1).alias("shard"), F.lit("x").alias("at"), F.lit("y").alias("bucket"), F.lit("z").alias("odd.name"),
    )


@pytest.mark.parametrize("n, shards, bucket_bytes", [(1000, 40, 500), (1000, 7, 1 << 20), (10, 40, 100), (1, 3, 1)])
def test_shards_differ_by_one_row_at_most(spark, n, shards, bucket_bytes):
    docs = table(spark, n)
    got = sharding.shard(docs, shards, bucket_bytes=bucket_bytes)
    assert got.columns == ["doc_id", "text", "at", "bucket", "odd.name", "shard", "slot"]
    rows = got.collect()
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert set(slots) <= set(range(shards))
    sizes = [len(slots.get(s, [])) for s in range(shards)]
    assert sum(sizes) == n and max(sizes) - min(sizes) <= 1
    assert Counter((r["doc_id"], r["text"]) for r in rows) == Counter((r["doc_id"], r["text"]) for r in docs.collect())


def test_order_is_random_and_repeatable(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("text").alias("text"))

    def order(seed):
        rows = sharding.shard(docs, 3, seed=seed, bucket_bytes=4000).collect()
        return [r["doc_id"] for r in sorted(rows, key=lambda r: (r["shard"], r["slot"]))]

    first = order(1)
    assert first == order(1) != order(2)
    rising = sum(x < y for x, y in zip(first, first[1:]))
    assert 0.45 < rising / 2999 < 0.55
    means = [sum(first[i : i + 1000]) / 1000 for i in (0, 1000, 2000)]
    assert all(1300 < m < 1700 for m in means)


def test_written_shards(spark, tmp_path):
    sharded = sharding.shard(table(spark, 100), 4, bucket_bytes=300)
    sharding.write_shards(sharded, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.groupBy("shard").count().count() == 4 and back.count() == 100


def test_empty_table(spark):
    assert sharding.shard(table(spark, 0)).count() == 0


def test_plan_has_no_python(spark, capsys):
    sharding.shard(table(spark, 20)).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan


def test_scatter_and_cut_replayed(spark):
    """Buckets by the seeded hash, each one's rows all drawn once, and the cut of the buckets end to end, in plain Python."""
    xxhash = pytest.importorskip("xxhash")
    n, shards, seed, bucket_bytes = 700, 9, 5, 900
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.repeat(F.lit("ab"), (F.col("id") % 30).cast("int")).alias("text")).coalesce(1)
    total_bytes = sum(16 + 2 * (i % 30) for i in range(n))
    buckets = max(4, -(-total_bytes // bucket_bytes))
    start = xxhash.xxh64(seed.to_bytes(4, "little"), seed=42).intdigest()

    def bucket(at):
        h = xxhash.xxh64(at.to_bytes(8, "little"), seed=start).intdigest()
        return (h - (1 << 64) if h >> 63 else h) % buckets

    drawn = sharding.shuffled_buckets(docs, seed=seed, bucket_bytes=bucket_bytes).collect()
    assert all(r["bucket"] == bucket(r["row"]["doc_id"]) for r in drawn)
    places = {}
    for r in drawn:
        places.setdefault(r["bucket"], []).append(r["place"])
    assert all(sorted(p) == list(range(len(p))) for p in places.values()) and len(drawn) == n
    order = [r["row"]["doc_id"] for r in sorted(drawn, key=lambda r: (r["bucket"], r["place"]))]
    want = {}
    for at, doc in enumerate(order):
        shard = at * shards // n
        want[doc] = (shard, at - -(-shard * n // shards))
    got = {r["doc_id"]: (r["shard"], r["slot"]) for r in sharding.shard(docs, shards, seed=seed, bucket_bytes=bucket_bytes).collect()}
    assert got == want
