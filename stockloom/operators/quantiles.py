"""Exact interpolated quantiles, and the column summaries and fences built on them.

The input is read once: what it takes to compute it (joins, sums) is done once, and the asked columns are stored in
the shared folder as numbers, which is all the passes below read. Two passes follow, and no shuffle of the values. The first takes count, mean, deviation, minimum, maximum and, per
wanted quantile, a narrow band from a sketch whose error in rank is known. The second counts the values below
each band and gathers those inside it, a share of some thousandths of the rows; equal values are counted
before they are shuffled. The ranks inside the band then give the exact values. Where a group has few values
the band is the whole group.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from stockloom.operators.ordered import ordered_chunks, running_total
from stockloom.session import settle

QUARTILES = (0.25, 0.5, 0.75)
#: The sketch is off by at most one in so many ranks; bands reach two such steps to either side.
ACCURACY = 500
#: Bytes in a row group of the stored columns: a hundred thousand rows of ten columns.
ROW_GROUP = 8 << 20


def _value(column: str) -> Column:
    """The column as a double, NaN as null."""
    return F.nanvl(F.col(column).cast("double"), F.lit(None))


def _narrowed(df: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    """The groups, and the columns as `v0`, `v1`, …; rows without a group are left out."""
    kept = df.select(*by, *[_value(c).alias(f"v{i}") for i, c in enumerate(columns)])
    for key in by:
        kept = kept.where(F.col(key).isNotNull())
    return kept


def _first_pass(rows: DataFrame, n: int, probabilities: Sequence[float], by: Sequence[str]) -> DataFrame:
    """One row per group with a struct `s0`, `s1`, … per column: count, mean, std, min, max and the `low` and
    `high` ends of the band of each quantile."""
    step = 2.0 / ACCURACY
    points = [min(1.0, max(0.0, p + side * step)) for p in probabilities for side in (-1, 1)]
    sums, sketches = [], []
    for i in range(n):
        v = f"v{i}"
        sums += [
            F.count(v).alias(f"n{i}"), F.avg(v).alias(f"mean{i}"), F.stddev_samp(v).alias(f"std{i}"), F.min(v).alias(f"min{i}"),
            F.max(v).alias(f"max{i}"),
        ]
        sketches.append(F.percentile_approx(v, points, ACCURACY).alias(f"sketch{i}"))
    # Apart, since an aggregate with sketches runs without generated code, the plain sums with it.
    found = _met(rows.groupBy(*by).agg(*sums), rows.groupBy(*by).agg(*sketches), by)

    def ends(i: int, side: int, whole: str) -> Column:
        few = F.col(f"n{i}") <= 4 * ACCURACY
        each = [F.when(few, F.col(f"{whole}{i}")).otherwise(F.col(f"sketch{i}")[2 * j + side]) for j in range(len(probabilities))]
        return F.array(*each).cast("array<double>")

    return found.select(*by, *[
        F.struct(
            F.col(f"n{i}").alias("count"), F.col(f"mean{i}").alias("mean"), F.col(f"std{i}").alias("std"),
            F.col(f"min{i}").alias("min"), F.col(f"max{i}").alias("max"), ends(i, 0, "min").alias("low"), ends(i, 1, "max").alias("high"),
        ).alias(f"s{i}")
        for i in range(n)
    ])


def _met(rows: DataFrame, groups: DataFrame, by: Sequence[str]) -> DataFrame:
    """Each row with what is known of its group; without groups that is one row."""
    return rows.join(groups, list(by)) if by else rows.join(F.broadcast(groups))


def _second_pass(rows: DataFrame, groups: DataFrame, n: int, m: int, by: Sequence[str]) -> DataFrame:
    """(by…, i, j, value, n): of column i, how often each value inside the band of quantile j occurs, and, as the value
    null, how many values lie below the band. One pass over Arrow batches, counted within each."""
    kinds = [rows.schema[k] for k in by]
    schema = T.StructType([
        *kinds, T.StructField("i", T.IntegerType()), T.StructField("j", T.IntegerType()), T.StructField("value", T.DoubleType()),
        T.StructField("n", T.LongType()),
    ])
    arrow, places = to_arrow_schema(schema), [(i, j) for i in range(n) for j in range(m)]
    values = [f"v{i}" for i in range(n)]
    ends = [F.col(f"s{i}.{side}")[j].alias(f"{side}{i}_{j}") for i, j in places for side in ("low", "high")]
    if by:
        read, known = rows.join(groups, list(by)).select(*by, *values, *ends), None
    else:
        read, known = rows.select(*values), groups.select(*ends).first().asDict()  # one row of band ends
    keys = list(by)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = pa.table([batch.column(k) for k in keys], names=keys) if keys else None
            for i, j in places:
                v = batch.column(f"v{i}").to_numpy(zero_copy_only=False).astype(float)
                low, high = (
                    np.nan if known[f"{side}{i}_{j}"] is None else known[f"{side}{i}_{j}"] for side in ("low", "high")
                ) if known is not None else (
                    batch.column(f"{side}{i}_{j}").to_numpy(zero_copy_only=False).astype(float) for side in ("low", "high")
                )
                below, inside = v < low, (v >= low) & (v <= high)
                if not keys:
                    found, times = np.unique(v[inside], return_counts=True)
                    found, times = np.append(found, np.nan), np.append(times, below.sum())
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(found), i), pa.int32()), pa.array(np.full(len(found), j), pa.int32()),
                        pa.array(found, from_pandas=True), pa.array(times.astype(np.int64)),
                    ], schema=arrow)
                    continue
                for mask, value in ((inside, v), (below, np.full(len(v), np.nan))):
                    part = held.filter(pa.array(mask)).append_column("value", pa.array(value[mask], from_pandas=True))
                    part = part.group_by([*keys, "value"]).aggregate([([], "count_all")]).combine_chunks()
                    size = part.num_rows
                    for piece in part.to_batches():
                        yield pa.RecordBatch.from_arrays([
                            *[piece.column(k) for k in keys], pa.array(np.full(size, i), pa.int32()),
                            pa.array(np.full(size, j), pa.int32()), piece.column("value").cast(pa.float64()), piece.column("count_all"),
                        ], schema=arrow)

    return read.mapInArrow(count, schema)


def _summaries(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """(by…, column, count, mean, std, min, max, quantiles), one row per group and column that has values."""
    return _summarised(settle(_narrowed(df, columns, by), ROW_GROUP), columns, probabilities, by)


def _summarised(
    rows: DataFrame, columns: Sequence[str], probabilities: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """The same from the stored columns."""
    by, keys = list(by), [*by, "column"]
    groups = settle(_first_pass(rows, len(columns), probabilities, by))
    banded = settle(_second_pass(rows, groups, len(columns), len(probabilities), by))
    place = [*by, "i", "j"]
    counted = banded.where("value IS NOT NULL").groupBy(*place, "value").agg(F.sum("n").alias("n"))
    ranked = running_total(ordered_chunks(counted, [*place, "value"]), place, ["value"], {"rank": "n"})
    under = banded.where("value IS NULL").groupBy(*place).agg(F.sum("n").alias("_below"))
    each = F.array(*[
        F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.lit(float(p)).alias("p"), F.col(f"s{i}.count").alias("_count"))
        for i in range(len(columns)) for j, p in enumerate(probabilities)
    ])
    asked = groups.select(*by, F.explode(each).alias("_a")).select(*by, "_a.*").join(under, place, "left").na.fill(0, ["_below"])
    # The wanted place among all values of the column, then inside the band.
    at = F.col("p") * (F.col("_count") - 1)
    asked = asked.select(*place, "p", (at - F.floor(at)).alias("_part"), (F.floor(at) - F.col("_below")).alias("_first"), (F.ceil(at) - F.col("_below")).alias("_second"))
    hits = ranked.join(asked, place)
    pick = lambda name: F.max(F.when((F.col("rank_start") <= F.col(name)) & (F.col(name) < F.col("rank_end")), F.col("value")))
    found = hits.groupBy(*place).agg(pick("_first").alias("_a"), pick("_second").alias("_b"), F.max("_part").alias("_part"))
    value = F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_part")
    listed = found.groupBy(*by, "i").agg(F.array_sort(F.collect_list(F.struct("j", value.alias("q")))).alias("_q"))  # one per quantile
    names = F.array(*[F.lit(c) for c in columns])
    basics = groups.select(*by, F.explode(F.array(*[
        F.struct(F.lit(i).alias("i"), *[F.col(f"s{i}.{c}").alias(c) for c in ("count", "mean", "std", "min", "max")]) for i in range(len(columns))
    ])).alias("_s")).select(*by, "_s.*")
    out = basics.join(listed, [*by, "i"]).withColumn("column", F.element_at(names, F.col("i") + 1))
    return out.select(*keys, "count", "mean", "std", "min", "max", F.transform("_q", lambda q: q["q"]).alias("quantiles"))


def column_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """(by…, column, quantiles array) with linear interpolation between neighbours."""
    return _summaries(df, columns, probabilities, by).select(*by, "column", "quantiles")


def describe(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), approximate: bool = False) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum, one row per column (and group).

    `approximate=True` reads the input once and takes the quartiles from a sketch.
    """
    keys = [*by, "column"]
    if approximate:
        long = _narrowed(df, columns, by).select(*by, *[F.col(f"v{i}").alias(c) for i, c in enumerate(columns)])
        long = long.unpivot(list(by), list(columns), "column", "value").where("value IS NOT NULL")
        out = long.groupBy(*keys).agg(
            F.count("*").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
            F.min("value").alias("min"), F.percentile_approx("value", list(QUARTILES)).alias("quantiles"),
            F.max("value").alias("max"),
        )
    else:
        out = _summaries(df, columns, QUARTILES, by)
    quartiles = [F.col("quantiles")[i].alias(name) for i, name in enumerate(("q25", "q50", "q75"))]
    return out.select(*keys, "count", "mean", "std", "min", *quartiles, "max")


def _wide(quantiles: DataFrame, columns: Sequence[str], names: Sequence[str]) -> DataFrame:
    """One row with a column `<name><i>` per listed column i and quantile."""
    return quantiles.groupBy().agg(*[
        F.max(F.when(F.col("column") == c, F.col("quantiles")[j])).alias(f"{name}{i}")
        for i, c in enumerate(columns) for j, name in enumerate(names)
    ])


def outlier_fences(df: DataFrame, columns: Sequence[str], top: int | None = 15) -> DataFrame:
    """Quartiles, the fences 1.5 interquartile ranges out, and the percentage of values outside."""
    stored = settle(_narrowed(df, columns, ()), ROW_GROUP)
    quartiles = settle(_wide(_summarised(stored, columns, (0.25, 0.75)), columns, ("q1_", "q3_")))
    rows = stored.join(F.broadcast(quartiles))  # one row
    sums, shown = [], []
    for i, c in enumerate(columns):
        q1, q3 = F.col(f"q1_{i}"), F.col(f"q3_{i}")
        reach = 1.5 * (q3 - q1)
        v = F.col(f"v{i}")
        sums += [F.count(v).alias(f"n{i}"), F.count_if((v < q1 - reach) | (v > q3 + reach)).alias(f"out{i}")]
        shown.append(F.struct(
            F.lit(c).alias("column"), q1.alias("q1"), q3.alias("q3"), (q1 - reach).alias("lo"), (q3 + reach).alias("hi"),
            F.bround(100 * F.try_divide(F.col(f"out{i}"), F.col(f"n{i}")), 2).alias("outlier_pct"),
        ))
    counted = rows.agg(*sums).join(F.broadcast(quartiles))
    shares = counted.select(F.explode(F.array(*shown)).alias("_s")).select("_s.*").where("q1 IS NOT NULL")
    ranked = shares.orderBy(F.desc("outlier_pct"), "column")
    return ranked if top is None else ranked.limit(top)


def box_statistics(df: DataFrame, category: str, value: str) -> DataFrame:
    """Per category: quartiles, the most extreme values inside the fences, and the count outside."""
    stored = settle(_narrowed(df, [value], [category]), ROW_GROUP)
    q = settle(_summarised(stored, [value], QUARTILES, [category]).select(
        category, *[F.col("quantiles")[i].alias(n) for i, n in enumerate(("q1", "median", "q3"))]
    ))
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = F.col("v0").between(F.col("q1") - reach, F.col("q3") + reach)
    rows = stored.where("v0 IS NOT NULL")
    found = rows.join(q, category).groupBy(category).agg(
        F.min(F.when(inside, F.col("v0"))).alias("whisker_low"), F.max(F.when(inside, F.col("v0"))).alias("whisker_high"),
        F.count_if(~inside).alias("n_outliers"),
    )
    return q.join(found, category)


def winsorize(df: DataFrame, columns: Sequence[str], low: float = 0.01, high: float = 0.99) -> DataFrame:
    """Clip columns to their own quantiles. All rows stay, and columns derived earlier keep their values."""
    bounds = settle(_wide(column_quantiles(df, columns, (low, high)), columns, ("_lo_", "_hi_")))
    clipped = {c: F.least(F.greatest(F.col(c), F.col(f"_lo_{i}")), F.col(f"_hi_{i}")) for i, c in enumerate(columns)}
    keep_null = {c: F.when(F.col(c).isNotNull(), e) for c, e in clipped.items()}
    return df.join(F.broadcast(bounds)).withColumns(keep_null).drop(*bounds.columns)
