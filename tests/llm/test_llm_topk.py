"""Every top k against all products."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stockloom.llm import topk


def brute(rows, is_query, k, scale=256):
    good = []
    for id, v in rows:
        if id is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            good.append((id, [math.floor(np.float64(np.float32(x)) * scale) for x in v]))
    out = set()
    for q, qv in {(i, tuple(v)) for i, v in good if is_query(i)}:
        found = [(-sum(a * b for a, b in zip(qv, v)), i) for i, v in good if i != q]
        out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(found)[:k])}
    return out


def result(spark, rows, k=5, step=3, **more):
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "'x' AS norm", "1 AS chunk", "2 AS id")
    got = topk.top_k(table, F.col("id") % step == 0, k, **more).collect()
    out = {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got}
    assert len(out) == len(got)
    return out


def vectors(n, d, spread, seed=2):
    pick = np.random.default_rng(seed)
    rows = pick.normal(size=(n, d)) * np.exp(pick.normal(size=(n, 1)) * spread)
    return [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(rows)]


@pytest.mark.parametrize("spread", [0.0, 1.0, 3.0])
@pytest.mark.parametrize("d", [2, 16])
def test_equals_all_products(spark, monkeypatch, spread, d):
    monkeypatch.setattr(topk, "CHUNK", 64)
    monkeypatch.setattr(topk, "BLOCK", 32)
    monkeypatch.setattr(topk, "BUCKET", 16)
    rows = vectors(300, d, spread)
    assert result(spark, rows) == brute(rows, lambda i: i % 3 == 0, 5)


def test_pruning_drops_candidates_before_the_products(monkeypatch):
    """On vectors in few dimensions most are never multiplied, by length or by coordinate."""
    import pyarrow as pa

    seen = []
    products = topk._products
    monkeypatch.setattr(topk, "_products", lambda q, p, exact: seen.append(len(q) * len(p)) or products(q, p, exact))
    for spread in (0.0, 3.0):
        seen.clear()
        rows = vectors(4000, 3, spread)
        ids, v = [i for i, _ in rows], [[math.floor(x * 256) for x in v] for _, v in rows]
        table = pa.table({"id": ids, "v": pa.array(v, pa.list_(pa.float64()))})
        queries = table.slice(0, 50).append_column("least", pa.array([None] * 50, pa.float64()))
        topk.search(queries, table, 5)
        assert sum(seen) < 0.5 * 50 * 4000


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (1, None), (2, [1.0, None]), (3, [nan, 1.0]), (4, [inf, 1.0]), (None, [5.0, 5.0]), (6, [0.0, 0.0]), (7, []),
        (8, [1.0]), (9, [-1.0, -1.0]), (10, [1.0, 0.0]), (11, [1.0, 0.0]), (11, [1.0, 0.0]), (12, [2.0, 3.0, 4.0]), (12, [2.0, 3.0, 4.0]), (13, [1.0, 0.0]),
    ]
    assert result(spark, rows) == brute(rows, lambda i: i % 3 == 0, 5)


def test_ties_go_to_the_smaller_id(spark):
    rows = [(i, [1.0, 1.0]) for i in range(60)]
    random.Random(1).shuffle(rows)
    assert result(spark, rows) == brute(rows, lambda i: i % 3 == 0, 5)


def test_large_components_stay_exact(spark):
    rows = [(i, [float(np.float32(1e6 + i * 7)), float(np.float32(-3e5 * i))]) for i in range(12)]
    assert result(spark, rows) == brute(rows, lambda i: i % 3 == 0, 5)


def test_empty_table_and_no_queries(spark):
    assert result(spark, []) == set()
    assert result(spark, [(1, [1.0]), (2, [2.0])]) == set()
    assert result(spark, [(0, [1.0])]) == set()
