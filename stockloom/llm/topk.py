"""Exact top-k search by inner product: norm buckets with coordinate and length pruning.

Vectors are grouped by length into buckets, since a product is large only if lengths or direction are. A
query q that already knows k products of at least t can only gain from a vector p with q.p >= t, so within
a bucket whose longest vector has length l it needs a cosine of at least t / (|q| l), the local threshold:

* above 1, the whole bucket is skipped;
* length pruning takes the vectors with |p| >= t / |q|, a prefix of the bucket in order of length;
* coordinate pruning takes the vectors whose component along the query's largest one is in the range that
  the threshold allows (the angle between them is at most the sum of two known angles), a run of the bucket
  in order of that component.

The smaller of the two sets is verified by its products. The longest vectors give each block of queries its
first threshold, and the threshold rises from bucket to bucket.

Queries are a stated set, cut into blocks; candidates are cut into chunks of similar length. A task takes
one block and one chunk, both of bounded size, and returns k rows per query; a chunk whose longest vector is
too short for every query of a block is not sent there at all. Neither side passes through the driver.

Components become floor(scale * x); products are exact integers (64-bit floats hold them exactly while they
are below 2^53, which is checked; otherwise Python's integers are used, and a score beyond a long is held
at its end).

Defined results: rows whose id or vector is null, or whose vector holds a null or non-finite component, take
no part. A shorter vector counts as filled up with zeros. A row is no candidate for a query of its own id.
Repeated rows are candidates each for itself; as queries they count once, and of different vectors with one
id the smallest (component by component) asks. Ties go to the smaller id. Fewer than k candidates give fewer
rows; an empty table gives none. Extra columns are not used.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockloom.llm.common import col, ship, stored

#: Queries of a block, candidates of a chunk, candidates of a bucket within it.
BLOCK, CHUNK, BUCKET = 8192, 2048, 512
#: Vectors whose lengths differ by more than this factor never share a chunk.
RATIO = 1.25
#: Queries whose products with a bucket are formed at a time.
STRIDE = 1024
EXACT = float(1 << 53)


def scaled(docs: DataFrame, id: str, vector: str, scale: int) -> DataFrame:
    """Rows (`id`, `v` as doubles holding whole numbers, `norm`) of the vectors that take part."""
    parts = F.transform(col(vector), lambda x: x.cast("double"))
    rows = docs.select(col(id).cast("long").alias("id"), parts.alias("x")).filter("id is not null and x is not null")
    finite = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(finite).select("id", F.transform("x", lambda x: _floor(x * scale)).alias("v"))
    return rows.withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)))


def _floor(x: Column) -> Column:
    """floor as a double: beyond 2^53 every double is whole, so the cast to a long never overflows."""
    return F.when(F.abs(x) < EXACT, F.floor(x).cast("double")).otherwise(x)


def _matrix(table: pa.Table, width: int) -> np.ndarray:
    """The vectors of a table as rows, filled up with zeros."""
    column = table["v"].combine_chunks()
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.values.to_numpy()[column.offsets[0].as_py() :]
    if len(sizes) and (sizes == width).all():
        return flat[: len(sizes) * width].reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    for i, (at, n) in enumerate(zip(np.cumsum(sizes) - sizes, sizes)):
        out[i, :n] = flat[at : at + n]
    return out


def _width(table: pa.Table) -> int:
    return int(np.diff(table["v"].combine_chunks().offsets.to_numpy()).max(initial=0))


def _products(q: np.ndarray, p: np.ndarray, exact: bool) -> np.ndarray:
    if exact:
        return q @ p.T
    whole = np.array([[int(x) for x in row] for row in q], dtype=object).dot(np.array([[int(x) for x in row] for row in p], dtype=object).T)
    return np.clip(whole, -(1 << 63), (1 << 63) - 1)


class Best:
    """The k best (score, id) of each query so far."""

    def __init__(self, n: int, k: int, least: np.ndarray):
        self.k, self.rows = k, [[] for _ in range(n)]
        self.least = least  # score a candidate must reach

    def offer(self, i: int, scores: np.ndarray, ids: np.ndarray) -> None:
        good = np.flatnonzero(scores >= self.least[i])
        if not len(good):
            return
        if len(good) > 4 * self.k and scores.dtype != object:
            kth = np.partition(scores[good], -self.k)[-self.k]
            good = good[scores[good] >= kth]
        rows = self.rows[i] + list(zip(scores[good].tolist(), (-ids[good]).tolist()))
        rows.sort(reverse=True)
        self.rows[i] = rows[: self.k]
        if len(self.rows[i]) == self.k:
            self.least[i] = max(self.least[i], self.rows[i][-1][0])


def search(queries: pa.Table, candidates: pa.Table, k: int) -> pa.Table:
    """The k best candidates of the chunk for each query of the block, as far as they can matter."""
    width = max(_width(queries), _width(candidates), 1)
    q, p = _matrix(queries, width), _matrix(candidates, width)
    q_ids, p_ids = queries["id"].to_numpy(), candidates["id"].to_numpy()
    q_norm, p_norm = np.sqrt((q * q).sum(axis=1)), np.sqrt((p * p).sum(axis=1))
    exact = bool(q_norm.max(initial=0) * p_norm.max(initial=0) < EXACT / 4)
    least = queries["least"].to_numpy(zero_copy_only=False).astype(float)
    best = Best(len(q), k, np.where(np.isnan(least), -np.inf, least))
    order = np.argsort(-p_norm, kind="stable")
    axis = np.abs(q).argmax(axis=1)
    for start in range(0, len(order), BUCKET):
        rows = order[start : start + BUCKET]
        _bucket(q, q_ids, q_norm, axis, p[rows], p_ids[rows], p_norm[rows], best, exact)
    found = [(q_ids[i], -minus, score) for i, rows in enumerate(best.rows) for score, minus in rows]
    columns = list(zip(*found)) or [(), (), ()]
    return pa.table({"query_id": pa.array(columns[0], pa.int64()), "vec_id": pa.array(columns[1], pa.int64()), "score": pa.array([int(s) for s in columns[2]], pa.int64())})


def _bucket(q, q_ids, q_norm, axis, p, p_ids, p_norm, best: Best, exact: bool) -> None:
    """One bucket, longest vector first, against all queries."""
    slack = 1e-9  # of rounding in norms and angles, on the safe side
    with np.errstate(divide="ignore", invalid="ignore"):
        need = best.least / q_norm  # length a vector must have to reach the score
        local = need / p_norm[0]  # the local cosine threshold
    need = np.where(q_norm > 0, need, np.where(best.least > 0, np.inf, -np.inf))
    local = np.where((q_norm > 0) & (p_norm[0] > 0), local, np.where(best.least > 0, np.inf, -np.inf))
    alive = np.flatnonzero(local <= 1 + slack)
    # Length pruning: all vectors from the longest down to the one that is just long enough.
    by_length = np.searchsorted(-p_norm, -(need * (1 - slack) - slack), side="right")
    by_length = np.where(best.least > 0, by_length, len(p))
    # Coordinate pruning: the range of the unit vectors' component along the query's largest one.
    unit = p / np.where(p_norm > 0, p_norm, 1)[:, None]
    coordinate = np.argsort(unit, axis=0, kind="stable")
    ordered = np.take_along_axis(unit, coordinate, axis=0)
    whole = []
    for i in alive:
        if best.least[i] > 0:
            a = axis[i]
            angle = np.arccos(np.clip(q[i, a] / q_norm[i], -1, 1))
            most = np.arccos(min(local[i], 1.0))
            low, high = np.cos(min(np.pi, angle + most)) - 1e-7, np.cos(max(0.0, angle - most)) + 1e-7
            s, e = np.searchsorted(ordered[:, a], low, side="left"), np.searchsorted(ordered[:, a], high, side="right")
            if 4 * (e - s) < by_length[i]:
                rows = np.sort(coordinate[s:e, a])
                rows = rows[(rows < by_length[i]) & (p_ids[rows] != q_ids[i])]
                if len(rows):
                    best.offer(i, _products(q[i : i + 1], p[rows], exact)[0], p_ids[rows])
                continue
        whole.append(i)
    for s in range(0, len(whole), STRIDE):
        some = np.array(whole[s : s + STRIDE])
        reach = int(by_length[some].max())
        if not reach:
            continue
        scores = _products(q[some], p[:reach], exact)
        worth = (scores >= best.least[some][:, None]).any(axis=1)
        for j in np.flatnonzero(worth):
            i = some[j]
            others = p_ids[:reach] != q_ids[i]
            best.offer(i, scores[j][others], p_ids[:reach][others])


def _search_groups(k: int):
    def run(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        if not queries.num_rows or not candidates.num_rows:
            return pa.table({n: pa.array([], pa.int64()) for n in ("query_id", "vec_id", "score")})
        return search(queries, candidates.rename_columns([c.removeprefix("p_") for c in candidates.column_names]), k)

    return run


def _cells(queries: DataFrame, candidates: DataFrame, k: int) -> DataFrame:
    """Every block against its chunks: the k best of each cell."""
    left = queries.groupBy("block", "chunk")
    named = candidates.select(*[F.col(c).alias(f"p_{c}") for c in ("block", "chunk", "id", "v")])
    right = named.groupBy("p_block", "p_chunk")
    return left.cogroup(right).applyInArrow(_search_groups(k), "query_id long, vec_id long, score long")


def _best(rows: DataFrame, k: int) -> DataFrame:
    """The k best rows per query. Spark keeps k per query and task before it shuffles them."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = rows.withColumn("rank", F.row_number().over(order).cast("int")).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, id: str = "vec_id", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): the k largest products of every query row (where `is_query`, a
    condition on the column `id`, holds) with all other rows."""
    spark = vectors.sparkSession
    ship(spark)
    # Lengths in steps of RATIO; the step of the longest is the largest number. Zero vectors come last.
    step = F.when(F.col("norm") > 0, F.floor(F.log(F.col("norm")) / float(np.log(RATIO)))).otherwise(-10_000).cast("int")
    rows = stored(scaled(vectors, id, vector, scale).withColumn("step", step).withColumn("row", F.monotonically_increasing_id()), "vectors")
    # At most one row per step of the range of doubles, i.e. some 6,400.
    steps = rows.groupBy("step").agg(F.count(F.lit(1)).alias("n"), F.max("norm").alias("longest")).collect()
    if not steps:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    plan, first = [], 0
    for s in sorted(steps, key=lambda s: -s["step"]):
        cuts = -(-s["n"] // CHUNK)
        plan.append((s["step"], first, cuts, s["longest"]))
        first += cuts
    plan = F.broadcast(spark.createDataFrame(plan, "step int, first long, cuts long, longest double"))
    asked = rows.filter(is_query).groupBy("id").agg(F.min("v").alias("v"), F.min_by("norm", "v").alias("q_norm"))
    blocks = -(-asked.count() // BLOCK)
    asked = asked.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(max(1, blocks))).cast("int"))
    chunks = rows.join(plan, "step").withColumn("chunk", F.col("first") + F.pmod(F.xxhash64("row"), F.col("cuts")))
    chunks = chunks.select("id", "v", "chunk", "longest")

    # The longest vectors give every query its first threshold.
    every = F.explode(F.sequence(F.lit(0), F.lit(max(0, blocks - 1)))).alias("block")
    seeds = chunks.filter("chunk = 0").select("id", "v", every, "chunk")
    start = asked.select("id", "v", "block", F.lit(0).cast("long").alias("chunk"), F.lit(None).cast("double").alias("least"))
    seeded = stored(_cells(start, seeds, k), "seeded")
    least = seeded.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least")).filter(f"n >= {k}")
    known = stored(asked.join(least, asked["id"] == least["query_id"], "left").select("id", "v", "block", "q_norm", "least"), "queries")

    # A block needs the chunks whose longest vector can still reach the least demanding of its queries.
    lengths = chunks.filter("chunk > 0").groupBy("chunk").agg(F.max("longest").alias("longest"))
    reach = F.when(F.col("least") > 0, F.col("least") / F.col("q_norm")).otherwise(0.0)
    demands = known.groupBy("block").agg(F.min(F.coalesce(reach, F.lit(0.0))).alias("reach"))
    wanted = demands.join(lengths, lengths["longest"] * (1 + 1e-9) >= demands["reach"]).select("block", "chunk")
    wanted = stored(wanted, "cells")
    left = known.join(wanted, "block").select("id", "v", "block", "chunk", F.col("least").cast("double").alias("least"))
    right = chunks.join(wanted, "chunk").select("id", "v", "block", "chunk")
    rest = _cells(left, right, k)
    return _best(seeded.unionByName(rest), k)
