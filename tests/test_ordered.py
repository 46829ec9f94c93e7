"""Chunked scans and quantiles against brute force, with hot groups and ties."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stockloom.operators import ordered, quantiles


def hot_rows(seed, n=240):
    """(g, id, v): a third of the rows in group 0."""
    rng = random.Random(seed)
    groups = [0 if rng.random() < 0.34 else rng.randint(1, 6) for _ in range(n)]
    return [(g, i, rng.randint(0, 9)) for i, g in enumerate(groups)]


@pytest.mark.parametrize("width", [1, 7, 1000])
def test_running_total_equals_plain_sum(spark, width):
    rows = hot_rows(width)
    df = spark.createDataFrame(rows, "g int, id int, v int")
    df = df.join(ordered.id_chunks(df, "id", width), "id")
    got = {r["id"]: (r["t_start"], r["t_end"], r["t_total"]) for r in ordered.running_total(df, ["g"], ["id"], {"t": "v"}).collect()}
    assert len(got) == len(rows)
    for g, i, v in rows:
        upto = sum(x[2] for x in rows if x[0] == g and x[1] <= i)
        assert got[i] == (upto - v, upto, sum(x[2] for x in rows if x[0] == g))


@pytest.mark.parametrize("width", [1, 5, 1000])
def test_carry_last_equals_plain_scan(spark, width):
    rng = random.Random(width)
    rows = [(g, i, rng.choice([None, None, "a", "b"])) for g, i, _ in hot_rows(3)]
    df = spark.createDataFrame(rows, "g int, id int, x string")
    df = df.join(ordered.id_chunks(df, "id", width), "id")
    got = {r["id"]: r["last"] for r in ordered.carry_last(df, ["g"], ["id"], F.col("x"), "last").collect()}
    for g, i, _ in rows:
        earlier = [x[2] for x in rows if x[0] == g and x[1] < i and x[2] is not None]
        assert got[i] == (earlier[-1] if earlier else None)


def test_chunks_of_ids_far_apart_are_full(spark):
    """20,000 ids up to 10^15, all of one product: few chunks, none longer than the width."""
    ids = spark.range(20_000).select((F.col("id") * 50_000_000_003).alias("store_id"), F.lit(1).alias("product_id"))
    chunks = ordered.id_chunks(ids, "store_id", 1000)
    sizes = {r["chunk"]: (r["count"], r["low"], r["high"]) for r in chunks.groupBy("chunk").agg(
        F.count("*").alias("count"), F.min("store_id").alias("low"), F.max("store_id").alias("high")).collect()}
    assert sorted(sizes) == list(range(20)) and {s[0] for s in sizes.values()} == {1000}
    assert all(sizes[i][2] < sizes[i + 1][1] for i in range(19))


def test_row_numbers_are_dense_and_ordered(spark):
    rows = hot_rows(5)
    numbered = ordered.row_numbers(spark.createDataFrame(rows, "g int, id int, v int").repartition(5), ["g", "id"])
    got = sorted((r["row_number"], r["g"], r["id"]) for r in numbered.collect())
    assert [(n, g, i) for n, (g, i, _) in enumerate(sorted(rows), 1)] == got


@pytest.mark.parametrize("accuracy", [10, 2000])
def test_quantiles_interpolate(spark, monkeypatch, accuracy):
    monkeypatch.setattr(quantiles, "ACCURACY", accuracy)  # with 10 the bands are narrower than the groups
    rng = random.Random(1)
    data = [(rng.choice("aab"), float(rng.choice([0, 0, 0, 1, 2.5, rng.random() * 10]))) for _ in range(301)]
    df = spark.createDataFrame([*data, ("a", None), ("b", float("nan")), (None, 3.0)], "c string, v double")
    probs = [0.01, 0.25, 0.5, 0.75, 0.99]
    got = {r["c"]: r["quantiles"] for r in quantiles.column_quantiles(df, ["v"], probs, ["c"]).collect()}
    assert set(got) == {"a", "b"}
    for c in got:
        assert got[c] == pytest.approx(np.quantile([v for k, v in data if k == c], probs))


def test_quantiles_of_many_rows_use_narrow_bands(spark):
    df = spark.range(60_000).select(F.sin("id").alias("v"), (F.col("id") % 7).cast("double").alias("w"), F.lit(None).cast("double").alias("x"))
    got = {r["column"]: r["quantiles"] for r in quantiles.column_quantiles(df, ["v", "w", "x"], [0.0, 0.1, 0.5, 1.0]).collect()}
    assert set(got) == {"v", "w"}
    assert got["v"] == pytest.approx(np.quantile(np.sin(np.arange(60_000)), [0.0, 0.1, 0.5, 1.0]), abs=1e-12)
    assert got["w"] == [0.0, 0.0, 3.0, 6.0]


def test_describe_matches_numpy_and_single_row(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 3.0), ("a", 10.0), ("b", 5.0)], "c string, v double")
    got = {r["c"]: r for r in quantiles.describe(df, ["v"], ["c"]).collect()}
    assert got["a"]["q25"] == 1.75 and got["a"]["std"] == pytest.approx(np.std([1, 2, 3, 10], ddof=1))
    assert got["b"]["std"] is None and got["b"]["q50"] == 5.0 and got["b"]["count"] == 1


def test_fences_and_winsorize(spark):
    df = spark.createDataFrame([(float(x), None) for x in [*range(1, 21), 100]], "v double, w double")
    row = quantiles.outlier_fences(df, ["v", "w"]).collect()
    assert [r["column"] for r in row] == ["v"]
    assert row[0]["outlier_pct"] == 4.76 and row[0]["q1"] == 6.0 and row[0]["q3"] == 16.0
    clipped = quantiles.winsorize(df, ["v"], 0.0, 0.95)
    assert clipped.agg(F.max("v"), F.count("*")).first()[:] == (20.0, 21)
