import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from stockloom.functions import values
from stockloom.operators import demand as dm
from stockloom.operators import profile


def test_duplicates_with_nulls(spark):
    rows = [(1, None), (1, None), (1, "a"), (2, "b"), (2, "b"), (2, "b")]
    assert profile.duplicate_rows(spark.createDataFrame(rows, "k int, x string")).first()[0] == 3
    assert profile.duplicate_rows(spark.createDataFrame(rows[2:4], "k int, x string")).first()[0] == 0


def test_missing_values_only_lists_columns_with_gaps(spark):
    got = profile.missing_values(spark.createDataFrame([(1, None, None), (2, None, 3.0), (3, None, 4.0)], "a int, b string, c double"))
    assert {(r["column"], r["missing_count"], r["missing_pct"]) for r in got.collect()} == {("b", 3, 100.0), ("c", 1, 33.33)}


def test_correlations_over_shared_rows(spark):
    rng = np.random.default_rng(0)
    data = pd.DataFrame(rng.normal(1e6, 1, (500, 3)), columns=list("xyz"))
    data["z"] = data["x"] * 2 + rng.normal(0, 0.1, 500)
    data.loc[::7, "y"] = np.nan
    data["flat"] = 5.0
    got = {(r["a"], r["b"]): r["corr"] for r in profile.correlations(spark.createDataFrame(data).repartition(6), list(data.columns)).collect()}
    assert len(got) == 16
    want = data.corr()
    for a in "xyz":
        for b in "xyz":
            assert got[a, b] == pytest.approx(want.loc[a, b], abs=1e-9)
    assert got["flat", "x"] is None


def test_histogram_lists_empty_bins_and_closes_the_last(spark):
    got = [r["n_rows"] for r in profile.histogram(spark.createDataFrame([(0.0,), (0.1,), (5.0,), (10.0,), (None,)], "v double"), "v", 5).orderBy("bin").collect()]
    assert got == [2, 0, 1, 0, 1]
    flat = profile.histogram(spark.createDataFrame([(3.0,), (3.0,)], "v double"), "v", 4).orderBy("bin").collect()
    assert sum(r["n_rows"] for r in flat) == 2 and flat[0]["bin_start"] == 2.5


def test_value_counts_keep_or_drop_null(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "x string")
    assert [tuple(r) for r in profile.value_counts(df, "x").collect()] == [("a", 2), (None, 1)]
    assert [tuple(r) for r in profile.value_counts(df, "x", keep_null=False).collect()] == [("a", 2)]


def test_parsing_and_rounding(spark):
    df = spark.createDataFrame([("2024-02-30", "x1", 0.125, 0.0), ("2024-02-28", "2.5", 0.375, 2.0)], "d string, n string, h double, z double")
    got = df.select(
        values.lenient_date(F.col("d")), values.lenient_number(F.col("n")), values.half_even(F.col("h"), 2),
        values.ratio_or(F.col("h"), F.col("z"), 0.0), values.not_below(F.col("z") - 1),
    ).collect()
    assert got[0][0] is None and str(got[1][0]) == "2024-02-28"
    assert [r[1] for r in got] == [None, 2.5] and [r[2] for r in got] == [0.12, 0.38]
    assert [r[3] for r in got] == [0.0, 0.1875] and [r[4] for r in got] == [0.0, 1.0]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|CANNOT_PARSE"):
        df.select(values.strict_date(F.col("d"))).collect()


def test_params_of_zero_mean_and_single_day(spark):
    day = spark.createDataFrame([(1, 1, 9, "2024-01-01", 0.0), (1, 1, 9, "2024-01-02", 0.0), (2, 1, 9, "2024-01-01", 4.0)],
                                "store_id int, product_id int, city_id int, date string, demand double")
    for c in ("avg_stockout_hours", "avg_discount", "is_holiday", "has_promotion"):
        day = day.withColumn(c, F.lit(0.0))
    got = {r["store_id"]: r for r in dm.series_params(day).collect()}
    assert got[1]["demand_cv"] == 0.0 and got[2]["demand_std"] is None and got[2]["demand_cv"] == 0.0
    stocked = dm.with_inventory(dm.series_params(day))
    again = dm.with_inventory(dm.series_params(day.repartition(3)))
    assert sorted(map(tuple, stocked.collect())) == sorted(map(tuple, again.collect()))


def test_top_stores_breaks_ties_by_id(spark):
    df = spark.createDataFrame([(3, 5.0), (1, 5.0), (2, 9.0)], "store_id int, sale_amount double")
    assert [r["store_id"] for r in dm.top_stores(df, 2).collect()] == [2, 1]


def test_samples_repeat(spark):
    df = spark.range(1000)
    first = sorted(r[0] for r in values.repeatable_sample(df, ["id"], 50).collect())
    assert first == sorted(r[0] for r in values.repeatable_sample(df.repartition(7), ["id"], 50).collect()) and len(first) == 50
    mean, std = df.select(values.key_normal(["id"]).alias("z")).agg(F.avg("z"), F.stddev("z")).first()
    assert abs(mean) < 0.15 and 0.85 < std < 1.15
