"""Copies against a plain inverse of the Poisson distribution."""

import hashlib
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from stockloom.llm import mixing

SCHEMA = "doc_id long, text string, source string"


def unit(*parts):
    return int(hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()[:13], 16) / 2**52


def inverse(mean, u):
    k, p, upto = 0, math.exp(-mean), math.exp(-mean)
    while upto <= u and k < mean + 10 * math.sqrt(mean) + 20:
        k += 1
        p *= mean / k
        upto += p
    return k


def copies(rate, id, text=None):
    if id is None:
        id = "-" + hashlib.md5((text or "").encode()).hexdigest()
    parts = max(1, math.ceil(rate / mixing.PART_MEAN))
    return sum(inverse(rate / parts, unit(mixing.SEED, "count", i, id)) for i in range(1, parts + 1))


def documents(spark):
    rows = [(i, "x" * (i % 7), f"s{i % 3}" if i % 3 else None) for i in range(200)]
    rows += [(None, None, "s1"), (None, "ab", "s1"), (5, "x" * 5, "s2"), (5, "x" * 5, "s2")]
    return rows, spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'old' AS copy", "1 AS `odd.name`")


def rates(rows, weights, epochs=1.0):
    size = Counter()
    for _, text, source in rows:
        size[source] += len(text or "") + 1
    total, weight = sum(size.values()), sum(weights.get(s, 0) for s in size)
    return {s: epochs * total * weights[s] / weight / n for s, n in size.items() if weights.get(s, 0) > 0}


@pytest.mark.parametrize("most_broadcast", [mixing.MOST_BROADCAST, 0])
@pytest.mark.parametrize("weights, epochs", [({None: 1.0, "s1": 5.0, "s2": 0.5}, 1.0), ({"s1": 1.0, "s2": 30.0, "gone": 2.0}, 40.0)])
def test_copies_follow_the_weights(spark, monkeypatch, weights, epochs, most_broadcast):
    monkeypatch.setattr(mixing, "MOST_BROADCAST", most_broadcast)
    rows, docs = documents(spark)
    table = spark.createDataFrame(list(weights.items()), "source string, weight double")
    got = mixing.mix(docs, table, epochs=epochs)
    assert got.columns == ["doc_id", "text", "source", "odd.name", "copy", "rate", "mix_key"]
    found = Counter((r["doc_id"], r["source"], r["copy"]) for r in got.collect())
    rate, want = rates(rows, weights, epochs), Counter()
    for id, text, source in rows:
        for k in range(1, copies(rate[source], id, text) + 1 if source in rate else 1):
            want[id, source, k] += 1
    assert found == want


def test_default_weights_flatten_sizes(spark):
    rows, docs = documents(spark)
    size = Counter()
    for _, text, source in rows:
        size[source] += len(text or "") + 1
    rate = rates(rows, {s: math.sqrt(n) for s, n in size.items()})
    got = {(r["source"], round(r["rate"], 9)) for r in mixing.mix(docs).collect()}
    assert got == {(s, round(r, 9)) for s, r in rate.items()}


def test_means_come_out_and_the_order_is_shuffled(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("abc").alias("text"), F.when(F.col("id") % 4 == 0, "a").otherwise("b").alias("source"))
    equal = spark.createDataFrame([("a", 1.0), ("b", 1.0)], "source string, weight double")
    got = mixing.mix(docs, equal).collect()
    share = Counter(r["source"] for r in got)
    assert abs(share["a"] - 2000) < 5 * math.sqrt(2000) and abs(share["b"] - 2000) < 5 * math.sqrt(2000)
    counts = Counter(Counter(r["doc_id"] for r in got if r["source"] == "a").values())
    assert abs(counts[2] / 1000 - 2 * math.exp(-2)) < 0.06
    ids = [r["doc_id"] for r in got]
    assert sum(x < y for x, y in zip(ids, ids[1:])) < 0.6 * len(ids)
    again = mixing.mix(docs, equal).collect()
    assert [(r["doc_id"], r["copy"]) for r in again] == [(r["doc_id"], r["copy"]) for r in got]


def test_rows_without_id_keep_the_weights(spark):
    long = "y" * 3_000_000
    rows = [(None, f"text {i}", "a") for i in range(1500)] + [(None, f"text {i}", "b") for i in range(500)] + [(None, long, "c")]
    weights = {"a": 1.0, "b": 1.0, "c": 200.0}
    got = mixing.mix(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(list(weights.items()), "source string, weight double"), epochs=0.5)
    rate, found = rates(rows, weights, 0.5), Counter(r["source"] for r in got.select("source").collect())
    assert found == {s: n for s in "abc" if (n := sum(copies(rate[s], id, text) for id, text, source in rows if source == s))}
    for s, n in (("a", 1500), ("b", 500)):
        assert abs(found[s] - n * rate[s]) < 5 * math.sqrt(n * rate[s])


def test_empty_and_useless_weights(spark):
    _, docs = documents(spark)
    assert mixing.mix(docs.limit(0)).count() == 0
    none = spark.createDataFrame([("s1", 0.0), ("s2", None)], "source string, weight double")
    assert mixing.mix(docs, none).count() == 0


def test_plan_has_no_python(spark, capsys):
    mixing.mix(documents(spark)[1]).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and "BroadcastNestedLoop" not in plan
