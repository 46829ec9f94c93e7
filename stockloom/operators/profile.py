"""Profiling of demand and logistics tables: totals, coverage, shares, counts, missing values, bins."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockloom.operators.quantiles import describe
from stockloom.session import settle


def total_by(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Sum of a column per key. Map-side combining keeps a hot key cheap."""
    return df.groupBy(*keys).agg(F.sum(value).alias(name))


def coverage(demand: DataFrame) -> DataFrame:
    """Distinct cities, stores, products and days with the date range, in one pass."""
    return demand.agg(
        F.count_distinct("city_id").alias("n_cities"),
        F.count_distinct("store_id").alias("n_stores"),
        F.count_distinct("product_id").alias("n_products"),
        F.count_distinct("dt").alias("n_days"),
        F.min("dt").alias("first_day"),
        F.max("dt").alias("last_day"),
    )


def city_volatility(demand: DataFrame) -> DataFrame:
    """Spread of daily demand per city, described over the cities."""
    daily = total_by(demand, ["dt", "city_id"], "sale_amount", "sale_amount")
    spread = daily.groupBy("city_id").agg(F.stddev_samp("sale_amount").alias("daily_std"))
    return describe(spread, ["daily_std"])


def grain_frequency(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many key combinations have 1, 2, 3 … rows; one line saying 1 means the keys are unique."""
    per_key = df.groupBy(*keys).agg(F.count("*").alias("records_per_day"))
    return per_key.groupBy("records_per_day").agg(F.count("*").alias("frequency"))


def sales_shares(demand: DataFrame) -> DataFrame:
    """Rows, zero-sale rows, stock-out rows and the stock-out rate."""
    out = F.col("stock_hour6_22_cnt") > 0
    return demand.agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col("sale_amount") == 0).alias("zero_sales"),
        F.count_if(out).alias("stockout_days"),
        F.avg(out.cast("int")).alias("stockout_rate"),
    )


def imbalance_shares(params: DataFrame, high_cv: float = 1.0) -> DataFrame:
    """Series with surplus, with shortage, with high variability, and the mean variability."""
    return params.agg(
        F.count("*").alias("n_series"),
        F.count_if(F.col("inventory_imbalance") > 0).alias("n_surplus"),
        F.count_if(F.col("inventory_imbalance") < 0).alias("n_shortage"),
        F.avg("demand_cv").alias("mean_cv"),
        F.count_if(F.col("demand_cv") > high_cv).alias("n_high_cv"),
    )


def mean_by_flag(df: DataFrame, flags: dict[str, Column], value: str) -> DataFrame:
    """Mean of a column for each value of several flags, as (flag, flag_value, mean_value) in one pass."""
    keyed = df.select(F.col(value).alias("_v"), *[e.cast("int").alias(n) for n, e in flags.items()])
    long = keyed.unpivot("_v", list(flags), "flag", "flag_value").where("flag_value IS NOT NULL")
    return long.groupBy("flag", "flag_value").agg(F.avg("_v").alias("mean_value"))


def value_counts(df: DataFrame, column: str, keep_null: bool = True, top: int | None = 20) -> DataFrame:
    """Frequency of each label, most frequent first."""
    rows = df if keep_null else df.where(F.col(column).isNotNull())
    counted = rows.groupBy(column).agg(F.count("*").alias("n_rows")).orderBy(F.desc("n_rows"), column)
    return counted if top is None else counted.limit(top)


def missing_values(df: DataFrame) -> DataFrame:
    """(column, missing_count, missing_pct) of the columns that have missing values; one pass."""
    counts = df.agg(
        F.count("*").alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]
    )
    long = counts.unpivot("_rows", df.columns, "column", "missing_count")
    share = F.bround(F.try_divide(100 * F.col("missing_count"), F.col("_rows")), 2)
    return long.where("missing_count > 0").select("column", "missing_count", share.alias("missing_pct"))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Number of rows that repeat an earlier row in all columns.

    Rows are counted by a 128-bit fingerprint of all columns, so the input is read once and only fingerprints are
    shuffled, after counting in each task. Two different rows share one with a chance of about n * n / 2^129, less than
    one in 10^14 for a trillion rows. Which columns are null goes into the fingerprint, since a hash passes nulls over.
    """
    values = [F.col(c) + F.lit(0.0) if kind in ("double", "float") else F.col(c) for c, kind in df.dtypes]  # one zero only
    nulls = F.concat(*[F.col(c).isNull().cast("int").cast("string") for c in df.columns])
    marked = df.select(F.xxhash64(F.lit(1), nulls, *values).alias("_h1"), F.xxhash64(F.lit(2), *values, nulls).alias("_h2"))
    groups = marked.groupBy("_h1", "_h2").agg(F.count("*").alias("_n"))
    return groups.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"))


def _pair_moments(columns: Sequence[str]) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Per task: count, means and centred second moments of each column pair, over rows having both."""
    left, right = np.triu_indices(len(columns))

    def moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shift = None
        totals = np.zeros((6, len(left)))
        for batch in batches:
            x = batch.to_numpy(dtype=float)
            here = ~np.isnan(x)
            if shift is None:  # values near the first batch's mean keep the sums free of cancellation
                shift = np.where(here, x, 0.0).sum(axis=0) / np.maximum(here.sum(axis=0), 1)
            x, m = np.where(here, x - shift, 0.0), here.astype(float)
            sums, squares = x.T @ m, (x * x).T @ m
            totals += np.stack([
                (m.T @ m)[left, right], sums[left, right], sums.T[left, right],
                squares[left, right], squares.T[left, right], (x.T @ x)[left, right],
            ])
        n, sx, sy, sxx, syy, sxy = totals
        rows = n > 0
        if shift is None or not rows.any():
            return
        n, sx, sy, sxx, syy, sxy = (v[rows] for v in (n, sx, sy, sxx, syy, sxy))
        i, j = left[rows], right[rows]
        yield pd.DataFrame({
            "i": i, "j": j, "n": n, "mx": shift[i] + sx / n, "my": shift[j] + sy / n,
            "cxx": sxx - sx * sx / n, "cyy": syy - sy * sy / n, "cxy": sxy - sx * sy / n,
        })

    return moments


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of all column pairs, over the rows where both are present; one pass.

    A `corr` aggregate per pair costs 15 times the scan for 11 columns, so each task multiplies its Arrow
    batches as matrices and returns one row per pair; the rows of all tasks are merged here. The long
    result holds both orders of a pair and the diagonal.
    """
    values = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(c) for c in columns])
    schema = "i int, j int, n double, mx double, my double, cxx double, cyy double, cxy double"
    parts = settle(values.mapInPandas(_pair_moments(list(columns)), schema))
    centre = parts.groupBy("i", "j").agg(
        (F.sum(F.col("n") * F.col("mx")) / F.sum("n")).alias("ax"),
        (F.sum(F.col("n") * F.col("my")) / F.sum("n")).alias("ay"),
    )
    dx, dy = F.col("mx") - F.col("ax"), F.col("my") - F.col("ay")
    pairs = (
        # One row per pair of listed columns: the broadcast side is bounded by their number.
        parts.join(F.broadcast(centre), ["i", "j"])
        .groupBy("i", "j")
        .agg(
            F.sum(F.col("cxy") + F.col("n") * dx * dy).alias("xy"),
            F.sum(F.col("cxx") + F.col("n") * dx * dx).alias("xx"),
            F.sum(F.col("cyy") + F.col("n") * dy * dy).alias("yy"),
        )
        .select("i", "j", F.try_divide("xy", F.sqrt(F.col("xx") * F.col("yy"))).alias("corr"))
    )
    names = F.array(*[F.lit(c) for c in columns])
    a, b = names[F.col("i")], names[F.col("j")]
    one_way = F.struct(a.alias("a"), b.alias("b"), "corr")
    other_way = F.when(F.col("i") != F.col("j"), F.struct(b.alias("a"), a.alias("b"), "corr"))
    return pairs.select(F.inline(F.array_compact(F.array(one_way, other_way))))


def daily_supply(logistics: DataFrame) -> DataFrame:
    """Demand, inventory, delay, risk and cost per day."""
    return logistics.groupBy("date").agg(
        F.sum("historical_demand").alias("demand"),
        F.sum("warehouse_inventory_level").alias("inventory"),
        F.avg("delivery_time_deviation").alias("avg_delay"),
        F.avg("disruption_likelihood_score").alias("avg_risk"),
        F.avg("shipping_costs").alias("avg_shipping_cost"),
    )


def global_means(logistics: DataFrame) -> DataFrame:
    return logistics.agg(
        F.avg("shipping_costs").alias("avg_shipping_cost"),
        F.avg("lead_time_days").alias("avg_lead_time_days"),
        F.avg("delay_probability").alias("avg_delay_probability"),
        F.avg("delivery_time_deviation").alias("avg_delivery_deviation"),
    )


def column_ranges(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, lowest, highest) of numeric columns."""
    ends = df.agg(*[F.struct(F.min(c).alias("lowest"), F.max(c).alias("highest")).alias(c) for c in columns])
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"{c}.lowest"), F.col(f"{c}.highest")) for c in columns]
    return ends.select(F.inline(F.array(*rows)))


def table_shape(df: DataFrame, entities: Sequence[str] = ()) -> DataFrame:
    """Row count, column count and distinct counts of the entity columns."""
    return df.agg(
        F.count("*").alias("n_rows"),
        F.lit(len(df.columns)).cast("bigint").alias("n_columns"),
        *[F.count_distinct(c).alias(f"n_{c}") for c in entities],
    )


def schema_listing(df: DataFrame) -> DataFrame:
    """(position, column, type) of a table."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, column string, type string")


def group_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*keys).distinct().agg(F.count("*").alias("n_groups"))


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width bins over [min, max]; the last bin is closed and empty bins are listed."""
    values = df.select(F.col(column).cast("double").alias("_v")).where("_v IS NOT NULL")
    ends = values.agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    # A constant column gets bins of total width 1 around its value.
    flat = F.col("_lo") == F.col("_hi")
    low = F.when(flat, F.col("_lo") - 0.5).otherwise(F.col("_lo"))
    width = F.when(flat, F.lit(1.0 / bins)).otherwise((F.col("_hi") - F.col("_lo")) / bins)
    frame = ends.where("_lo IS NOT NULL").select(low.alias("_lo"), width.alias("_w"))
    place = F.least(F.floor((F.col("_v") - F.col("_lo")) / F.col("_w")), F.lit(bins - 1)).cast("int")
    counted = (
        values.join(F.broadcast(frame)).groupBy(place.alias("bin")).agg(F.count("*").alias("n_rows"))
    )
    edges = frame.select(F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), "_lo", "_w")
    return edges.join(counted, "bin", "left").select(
        "bin",
        (F.col("_lo") + F.col("bin") * F.col("_w")).alias("bin_start"),
        (F.col("_lo") + (F.col("bin") + 1) * F.col("_w")).alias("bin_end"),
        F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
    )


def reference_mean(df: DataFrame, column: str, keep: Column | None = None) -> DataFrame:
    """Mean of a column and the number of rows behind it, optionally after a filter."""
    rows = df if keep is None else df.where(keep)
    return rows.agg(F.count(column).alias("n_rows"), F.avg(column).alias("mean_value"))
