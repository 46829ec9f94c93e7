"""Registration of queries next to the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run

    return register


# Added before rounding to 6 digits. A mean of few-digit numbers often ends in an exact …5, where the last
# bit of a sum decides the direction; after the shift such values are nowhere near a tie.
NUDGE = "3e-8"


def rounded(df: DataFrame) -> DataFrame:
    """Round floating columns to 6 digits, so that sums taken in a different order compare equal."""

    def show(f: T.StructField) -> Column:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            return F.round(F.col(f.name) + float(NUDGE), 6).alias(f.name)
        return F.col(f.name)

    return df.select(*[show(f) for f in df.schema.fields])


def r(expression: str, name: str | None = None) -> str:
    """SQL counterpart of `rounded` for one column."""
    return f"round({expression} + {NUDGE}, 6) AS {name or expression}"
