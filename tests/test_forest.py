"""The forest against a plain tree grown node by node, and that every training row is seen."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from stockloom.operators import forecast as fc
from stockloom.operators import forest


def plain_tree(bins, y, weight, depth, leaf):
    """Predictions of a tree of the least squared error for its own rows, node by node."""
    made = np.empty(len(y))

    def part(rows, left):
        w = weight[rows]
        made[rows] = (w * y[rows]).sum() / w.sum()
        best = (1e-6, None)
        for i in range(len(bins)) if left else ():
            for cut in range(int(bins[i, rows].max())):
                low = bins[i, rows] <= cut
                if w[low].sum() < leaf or w[~low].sum() < leaf:
                    continue
                error = lambda r: (weight[r] * (y[r] - np.average(y[r], weights=weight[r])) ** 2).sum()
                gain = error(rows) - error(rows[low]) - error(rows[~low])
                if gain > best[0] + 1e-9:
                    best = (gain, low)
        if best[1] is not None:
            part(rows[best[1]], left - 1)
            part(rows[~best[1]], left - 1)

    part(np.flatnonzero(weight), depth)
    return made


@pytest.mark.parametrize("depth,leaf", [(0, 1), (3, 1), (4, 7), (6, 3)])
def test_a_tree_equals_one_grown_node_by_node(depth, leaf):
    pick = np.random.default_rng(depth * 10 + leaf)
    bins = pick.integers(0, [[forest.BINS], [5], [2]], (3, 150)).astype(np.uint8)
    y = pick.normal(size=150) + bins[0] / 7 + 3 * (bins[1] == 2) * bins[2]
    weight = pick.poisson(1.0, 150)
    seen = weight > 0
    got = forest._scored(bins, [forest.grow(bins, y, weight, depth, leaf)])
    assert got[seen] == pytest.approx(plain_tree(bins, y, weight, depth, leaf)[seen])


def features(spark, n, rare, series=50):
    """`n` training rows with demand 1, and one held out; the last `rare` rows and the held-out one are of a kind with demand 100."""
    rows = spark.range(n + 1).withColumns({
        "store_id": (F.col("id") % series).cast("int"), "product_id": F.lit(1), "dt": F.date_add(F.lit("2000-01-01").cast("date"), F.floor(F.col("id") / series).cast("int")),
        "is_train": F.col("id") < n, **{c: F.lit(0.0) for c in fc.INPUTS}, "lag_7": (F.col("id") % 97).cast("double"), "roll_7_mean": (F.col("id") % 7919) / 10,
    })
    kind = F.col("id") >= n - rare
    return rows.withColumns({"lag_1": kind.cast("double"), "demand": F.when(kind, 100.0).otherwise(1.0)})


def test_every_training_row_is_seen(spark):
    """30 rows of 60,000 tell the kind; a leaf of 30 needs all of them."""
    made = features(spark, 60_000, 30)
    model = fc.fit_forest(made, trees=1, depth=2, leaf=30)
    assert [round(r["prediction"], 6) for r in fc.predict_holdout(made, model).collect()] == [100.0]
    assert model.rows == 60_000
    assert fc.fit_forest(made.limit(0), trees=2, depth=2).rows == 0


def test_split_points_are_of_all_rows(spark):
    rows = features(spark, 20_000, 1).where("is_train")
    cuts = forest.split_points(rows, ["lag_1", "lag_7", "roll_7_mean", "series_level"])
    assert list(cuts[0]) == [0.5] and len(cuts[3]) == 0
    share = np.array([k / forest.BINS for k in range(1, forest.BINS)])
    for cut, values in ((cuts[1], np.arange(20_000) % 97), (cuts[2], (np.arange(20_000) % 7919) / 10)):
        assert cut == pytest.approx(np.quantile(values, share))


def test_the_same_forest_however_the_rows_lie(spark):
    made = features(spark, 3_000, 200).withColumn("demand", F.col("demand") + F.col("lag_7") / 10)
    one, other = (fc.fit_forest(made.repartition(k), trees=12, depth=4, leaf=20) for k in (1, 3))
    assert len(one.trees) == 12
    for a, b in zip(one.trees, other.trees, strict=True):
        assert all(np.array_equal(x, y) for x, y in zip(a, b, strict=True))
