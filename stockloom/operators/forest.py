"""A regression forest over all training rows, grown a tree at a time by many tasks.

Every input is cut into BINS ranges of its own values over all rows, and a row is kept as one byte per input and its
target. Groups of trees are dealt to tasks; a task gets the rows of all series in this form (24 bytes a row with 16 inputs) and grows its
trees level by level: counts and sums of the target per node, input and bin, taken by array steps, give the best split of
each node. No row is left out: a tree weighs the rows by draws from a Poisson distribution of mean one, as a bootstrap does.

A grown tree is four arrays. All trees are held by the driver and sent with the tasks that predict: 14 bytes a node, and
as many nodes as trees times twice the training rows by the rows of a leaf, at most.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from stockloom.operators.quantiles import column_quantiles
from stockloom.session import settle

#: Ranges of values an input is cut into: all its values if there are no more.
BINS = 32
#: Trees grown by one task, which gets the rows once for them.
TREES_PER_TASK = 10

Tree = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]  # input (-1: leaf), last bin to the left, left child, value


@dataclass(frozen=True)
class Forest:
    """`cuts`: per input, the upper ends of all bins but the last. `rows`: training rows the trees have seen."""

    cuts: list[np.ndarray]
    trees: list[Tree]
    rows: int

    def predict(self, values: list[np.ndarray]) -> np.ndarray:
        """The mean of all trees, for columns of inputs."""
        return _scored(_binned(values, self.cuts), self.trees)


def _column(column: pa.Array) -> np.ndarray:
    """As doubles, null as NaN."""
    return column.cast(pa.float64()).to_numpy(zero_copy_only=False)


def _binned(values: list[np.ndarray], cuts: list[np.ndarray]) -> np.ndarray:
    """(input, row): the bin of each value; what is missing is in the last one."""
    return np.array([np.searchsorted(c, v, side="left") for v, c in zip(values, cuts, strict=True)], dtype=np.uint8)


def _scored(bins: np.ndarray, trees: list[Tree]) -> np.ndarray:
    total, rows = np.zeros(bins.shape[1]), np.arange(bins.shape[1])
    for split, cut, left, value in trees:
        at = np.zeros(len(rows), dtype=np.int32)
        moving = rows
        while len(moving):
            here = at[moving]
            moving = moving[split[here] >= 0]
            here = at[moving]
            at[moving] = left[here] + (bins[split[here], moving] > cut[here])
        total += value[at]
    return total / len(trees) if trees else np.full(len(rows), np.nan)


def _few_values(rows: DataFrame, inputs: Sequence[str]) -> dict[int, list[float]]:
    """All values of each input that has BINS at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = [np.empty(0)] * len(inputs)
        for batch in batches:
            seen = [s if len(s) > BINS else np.unique(np.concatenate([s, _column(c)])) for s, c in zip(seen, batch.columns)]
        many = [len(s) > BINS for s in seen]
        yield pa.RecordBatch.from_pydict({
            "input": pa.array(range(len(seen)), pa.int32()), "many": pa.array(many),
            "found": pa.array([[] if m else list(s) for s, m in zip(seen, many)], pa.list_(pa.float64())),
        })

    told = rows.select(*inputs).mapInArrow(run, "input int, many boolean, found array<double>")
    each = told.groupBy("input").agg(F.max("many").alias("many"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("found")))).alias("found"))
    return {r["input"]: r["found"] for r in each.collect() if not r["many"] and len(r["found"]) <= BINS}


def split_points(rows: DataFrame, inputs: Sequence[str]) -> list[np.ndarray]:
    """Per input, the values it may be split at: half-way between neighbours where it has few, else exact quantiles of all rows."""
    few = _few_values(rows, inputs)
    many = [c for i, c in enumerate(inputs) if i not in few]
    found = column_quantiles(rows, many, [k / BINS for k in range(1, BINS)]).collect() if many else []
    quantiles = {r["column"]: r["quantiles"] for r in found}
    between = lambda v: (v[1:] + v[:-1]) / 2
    return [between(np.array(few[i], dtype=float)) if i in few else np.unique(np.array(quantiles[c])) for i, c in enumerate(inputs)]


def _packed(rows: DataFrame, inputs: Sequence[str], target: str, cuts: list[np.ndarray], keys: Sequence[str], order: str) -> DataFrame:
    """(keys…, bins, target): the rows of a series in one row, in their order."""
    fields = [*[rows.schema[k] for k in keys], T.StructField("bins", T.BinaryType()), T.StructField("target", T.BinaryType())]
    kinds = to_arrow_schema(T.StructType(fields))

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by(order).combine_chunks()
        bins = _binned([_column(table[c].combine_chunks()) for c in inputs], cuts)
        own = [table[k].slice(0, 1).combine_chunks() for k in keys]
        return pa.Table.from_arrays([*own, pa.array([bins.tobytes()], pa.binary()), pa.array([_column(table[target].combine_chunks()).tobytes()], pa.binary())], schema=kinds)

    return rows.select(*keys, order, *inputs, target).groupBy(*keys).applyInArrow(run, T.StructType(fields))


def grow(bins: np.ndarray, target: np.ndarray, weight: np.ndarray, depth: int, leaf: int) -> Tree:
    """One tree of the least squared error, from rows (input, row) with weights. A leaf has at least the weight `leaf`."""
    rows = np.flatnonzero(weight)
    bins, weight = bins[:, rows], weight[rows].astype(float)
    sums = weight * target[rows]
    node = np.zeros(len(rows), dtype=np.int64)
    split, cut, left, value = [], [], [], []
    alive, n_nodes = 1, 1
    for level in range(depth + 1):
        count, total = np.bincount(node, weight, alive), np.bincount(node, sums, alive)
        value.append(total / np.maximum(count, 1))
        best, chosen, at = np.zeros(alive), np.full(alive, -1, dtype=np.int8), np.zeros(alive, dtype=np.uint8)
        if level < depth:
            whole = total**2 / np.maximum(count, 1)
            best[:] = 1e-9 * whole  # less is the rounding of sums
            base = node * BINS
            for i in range(len(bins)):
                place = base + bins[i]
                n = np.bincount(place, weight, alive * BINS).reshape(alive, BINS).cumsum(1)[:, :-1]
                s = np.bincount(place, sums, alive * BINS).reshape(alive, BINS).cumsum(1)[:, :-1]
                n_right, s_right = count[:, None] - n, total[:, None] - s
                gain = s**2 / np.maximum(n, 1) + s_right**2 / np.maximum(n_right, 1) - whole[:, None]
                gain[(n < leaf) | (n_right < leaf)] = -1
                k = gain.argmax(1)
                most = gain[np.arange(alive), k]
                better = most > best
                best[better], chosen[better], at[better] = most[better], i, k[better]
        parents = np.cumsum(chosen >= 0) - 1  # each makes two nodes on the next level
        split.append(chosen)
        cut.append(at)
        left.append(np.where(chosen >= 0, n_nodes + 2 * parents, 0).astype(np.int32))
        alive = 2 * int((chosen >= 0).sum())
        n_nodes += alive
        if not alive:
            break
        going = np.flatnonzero(chosen[node] >= 0)
        bins, weight, sums, node = bins[:, going], weight[going], sums[going], node[going]
        node = 2 * parents[node] + (bins[chosen[node], np.arange(len(node))] > at[node])
    return np.concatenate(split), np.concatenate(cut), np.concatenate(left), np.concatenate(value)


def fit(
    rows: DataFrame, inputs: Sequence[str], target: str, keys: Sequence[str], order: str, trees: int, depth: int, leaf: int, seed: int = 42
) -> Forest:
    """The forest of all rows: every split may use every input, and a lone tree sees each row once."""
    cuts = split_points(rows, inputs)
    packed = settle(_packed(rows, inputs, target, cuts, keys, order))
    tasks = -(-trees // TREES_PER_TASK)
    dealt = packed.crossJoin(rows.sparkSession.range(tasks).withColumn("id", F.col("id").cast("int")))
    dealt = dealt.repartitionById(tasks, F.col("id")).select("id", *keys, "bins", "target")
    width, n_keys = len(inputs), len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, found = None, []
        for batch in batches:
            for one, *own, bins, targets in zip(*[c.to_pylist() for c in batch.columns]):
                task = one
                y = np.frombuffer(targets)
                found.append(([(k is not None, k) for k in own], np.frombuffer(bins, dtype=np.uint8).reshape(width, -1), y))
        if task is None:
            return
        found.sort(key=lambda f: f[0])  # the draws follow the place of a row
        bins, y = np.concatenate([f[1] for f in found], axis=1), np.concatenate([f[2] for f in found])
        del found
        for tree in range(task * TREES_PER_TASK, min(trees, (task + 1) * TREES_PER_TASK)):
            draws = np.random.default_rng([seed, tree]).poisson(1.0, len(y)) if trees > 1 else np.ones(len(y))
            made = grow(bins, y, draws, depth, leaf)
            yield pa.RecordBatch.from_pydict({
                "tree": pa.array([tree], pa.int32()), "rows": pa.array([len(y)], pa.int64()),
                **{name: pa.array([part.tobytes()], pa.binary()) for name, part in zip(("split", "cut", "left", "value"), made)},
            })

    grown = settle(dealt.mapInArrow(run, "tree int, rows bigint, split binary, cut binary, left binary, value binary"))
    kinds = np.int8, np.uint8, np.int32, np.float64
    told = grown.orderBy("tree").collect()
    return Forest(cuts, [tuple(np.frombuffer(r[n], dtype=k) for n, k in zip(("split", "cut", "left", "value"), kinds)) for r in told], told[0]["rows"] if told else 0)


def predict(rows: DataFrame, forest: Forest, inputs: Sequence[str], name: str = "prediction") -> DataFrame:
    """`rows` with the column `name`."""
    sent = rows.sparkSession.sparkContext.broadcast(forest)
    schema = T.StructType([*rows.schema.fields, T.StructField(name, T.DoubleType())])
    kinds, places = to_arrow_schema(schema), [rows.columns.index(c) for c in inputs]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = sent.value.predict([_column(batch.columns[i]) for i in places])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, from_pandas=True)], schema=kinds)

    return rows.mapInArrow(run, schema)
