"""Column expressions for parsing, filling, clipping and rounding."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def strict_date(text: Column) -> Column:
    """A date; text that is no date is an error."""
    return F.to_date(text)


def lenient_date(text: Column) -> Column:
    """A date; text that is no date becomes null."""
    return F.try_to_timestamp(text).cast("date")


def strict_timestamp(text: Column) -> Column:
    return F.to_timestamp(text)


def lenient_timestamp(text: Column) -> Column:
    return F.try_to_timestamp(text)


def lenient_number(text: Column) -> Column:
    """A double; text that is no number becomes null."""
    return text.try_cast("double")


def ratio_or(numerator: Column, denominator: Column, default: float) -> Column:
    """numerator / denominator, or the default when the result is missing or not finite."""
    return F.coalesce(F.try_divide(numerator, denominator), F.lit(float(default)))


def not_below(value: Column, floor: float = 0.0) -> Column:
    """Clip from below; a null stays null."""
    return F.when(value.isNotNull(), F.greatest(value, F.lit(floor)))


def half_even(value: Column, digits: int) -> Column:
    """Round half to even."""
    return F.bround(value, digits)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Replace NaN by null in all floating columns, once, at load."""
    floating = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None)) for c in floating}) if floating else df


def calendar_parts(df: DataFrame, moment: str) -> DataFrame:
    """Add date, hour, dayofweek (Monday = 0) and month of a timestamp or date column."""
    at = F.col(moment)
    return df.withColumns(
        {"date": at.cast("date"), "hour": F.hour(at), "dayofweek": F.weekday(at), "month": F.month(at)}
    )


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def other_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if not isinstance(f.dataType, T.NumericType)]


def horizontal_sum(columns: Sequence[str]) -> Column:
    """Sum across columns of a row; missing values count as 0."""
    total = F.lit(0.0)
    for c in columns:
        total = total + F.coalesce(F.col(f"`{c}`"), F.lit(0.0))
    return total


def inventory_status(gap: Column) -> Column:
    """Surplus, Shortage or Balanced, from inventory minus demand (a missing gap counts as Balanced)."""
    return F.when(gap > 0, "Surplus").when(gap < 0, "Shortage").otherwise("Balanced")


def repeatable_sample(df: DataFrame, key: Sequence[str], n: int = 5000, seed: int = 42) -> DataFrame:
    """At most n rows, the same on every run and on any engine: the smallest MD5 of the key as text."""
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in key], F.lit(str(seed)))
    return df.orderBy(F.md5(text), *key).limit(n)


def key_uniform(key: Sequence[str], seed: int = 42) -> Column:
    """A number in [0, 1) that depends on the key only, whatever the partitioning."""
    steps = 1_000_000
    return F.pmod(F.xxhash64(*key, F.lit(seed)), F.lit(steps)) / F.lit(float(steps))


def key_normal(key: Sequence[str], seed: int = 42) -> Column:
    """A standard normal number that depends on the key only (two uniforms, polar form)."""
    first = F.greatest(key_uniform(key, seed), F.lit(1e-6))
    return F.sqrt(-2 * F.log(first)) * F.cos(2 * F.pi() * key_uniform(key, seed + 1))
