"""Questions that all documents put to the whole corpus, by runs and buckets.

Some operators need, for millions of pieces of every document (grams, words, suffixes), a fact about the same
piece in all other documents. One row per piece and document would be many times the text. So documents are
dealt to runs of bounded size; a run collects its different pieces once, in sorted arrays, one row per run and
bucket of pieces (`ask`). A bucket sees the pieces of all runs, settles them and writes one row back per run
(`answer`). Each run then takes its answers to its documents (`resolve`). All three are grouped by Spark; a
task holds one run or one bucket, never a corpus-wide table, and the arrays are packed bytes in both
directions.

A run is chosen by a hash of id and text, so one source, one id or many copies of one text with different
ids do not gather in a run.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockloom.llm.common import col, ship

Arrays = dict[str, bytes]


def dealt(docs: DataFrame, id: str, text: str, runs: int) -> DataFrame:
    """Rows (`run`, `id` as long, `text`)."""
    rows = docs.select(col(id).cast("long").alias("id"), col(text).alias("text"))
    return rows.select(F.pmod(F.xxhash64("id", "text"), F.lit(runs)).cast("int").alias("run"), "id", "text")


def in_order(table: pa.Table) -> pa.Table:
    """The documents of a run in an order that does not depend on how they arrived."""
    return table.sort_by([("id", "ascending"), ("text", "ascending")])


def texts(table: pa.Table) -> Iterator[bytes]:
    for value in table["text"].cast(pa.large_binary()):
        yield value.as_py() or b""


def ask(rows: DataFrame, collect: Callable[[pa.Table], Iterator[tuple[int, Arrays]]], columns: list[str]) -> DataFrame:
    """Rows (`run`, `bucket`, columns…) from what `collect` finds in each run."""
    schema = pa.schema([("run", pa.int32()), ("bucket", pa.int32())] + [(c, pa.binary()) for c in columns])

    def run(table: pa.Table) -> Iterator[pa.RecordBatch]:
        number = table["run"][0].as_py()
        for bucket, arrays in collect(table):
            yield pa.RecordBatch.from_pylist([{"run": number, "bucket": bucket, **arrays}], schema)

    ship(rows.sparkSession)
    return rows.groupBy("run").applyInArrow(_as_iterator(run), _ddl("run int, bucket int", columns))


def answer(asked: DataFrame, settle: Callable[[int, list[int], list[Arrays]], Iterator[Arrays]], columns: list[str], back: list[str]) -> DataFrame:
    """Rows (`run`, `bucket`, back…): `settle` gets a bucket's number, its runs and their arrays and yields
    one set of arrays per run, in the same order."""
    schema = pa.schema([("run", pa.int32()), ("bucket", pa.int32())] + [(c, pa.binary()) for c in back])

    def run(table: pa.Table) -> Iterator[pa.RecordBatch]:
        table = table.sort_by("run")
        bucket, runs = table["bucket"][0].as_py(), table["run"].to_pylist()
        asked_arrays = [dict(zip(columns, row)) for row in zip(*[table[c].to_pylist() for c in columns])]
        for number, arrays in zip(runs, settle(bucket, runs, asked_arrays)):
            yield pa.RecordBatch.from_pylist([{"run": number, "bucket": bucket, **arrays}], schema)

    ship(asked.sparkSession)
    return asked.groupBy("bucket").applyInArrow(_as_iterator(run), _ddl("run int, bucket int", back))


def resolve(rows: DataFrame, answers: DataFrame, use: Callable[[pa.Table, dict[int, Arrays]], pa.Table], back: list[str], schema: str) -> DataFrame:
    """Whatever `use` makes of a run's documents and its answers by bucket."""

    def run(table: pa.Table, replies: pa.Table) -> pa.Table:
        lists = [replies[c].to_pylist() for c in back]
        by_bucket = {b: dict(zip(back, row)) for b, row in zip(replies["reply_bucket"].to_pylist(), zip(*lists))}
        out = use(table, by_bucket)
        pa.default_memory_pool().release_unused()
        return out

    named = answers.select(F.col("run").alias("reply_run"), F.col("bucket").alias("reply_bucket"), *back)
    ship(rows.sparkSession)
    return rows.groupBy("run").cogroup(named.groupBy("reply_run")).applyInArrow(run, schema)


def _ddl(first: str, columns: list[str]) -> str:
    return ", ".join([first, *[f"{c} binary" for c in columns]])


def _as_iterator(run: Callable[[pa.Table], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function of a whole group in the form that Spark feeds batch by batch and reads batch by batch."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(pa.Table.from_batches(list(batches)))
        pa.default_memory_pool().release_unused()  # a worker goes on to the next group with what it needs

    # Spark picks the streaming form by the annotations.
    over.__annotations__ = {"batches": Iterator[pa.RecordBatch], "return": Iterator[pa.RecordBatch]}
    return over
