"""Scans bounded by the integer day key, and by exact time on top of it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callmart.context import RunContext
from callmart.functions.calendar import minus


def scan_day(df: DataFrame, ctx: RunContext, lag_days: int = 1, column: str = "part_date") -> DataFrame:
    """One day's partition, by default the day before the run."""
    return df.where(F.col(column) == F.lit(ctx.day_key(lag_days)))


def scan_range(
    df: DataFrame, ctx: RunContext, from_days: int, to_days: int = 1, column: str = "part_date"
) -> DataFrame:
    """The days from ``from_days`` to ``to_days`` before the run, both included."""
    return df.where(F.col(column).between(ctx.day_key(from_days), ctx.day_key(to_days)))


def recent(
    df: DataFrame,
    ctx: RunContext,
    ts: str,
    span: str,
    loose_days: int,
    column: str = "part_date",
) -> DataFrame:
    """Rows of the last ``span``. The day-key bound prunes partitions, the time bound is exact."""
    return df.where(
        (F.col(column) > F.lit(ctx.day_key(loose_days)))
        & F.col(ts).between(minus(ctx.now, span), ctx.now)
    )


def exclude_like(df: DataFrame, column: str, patterns: list[str]) -> DataFrame:
    """Rows that match none of the LIKE patterns; a missing value matches nothing and is dropped."""
    keep = reduce(Column.__and__, [~F.col(column).like(p) for p in patterns])
    return df.where(keep)


def in_list(df: DataFrame, column: str, values: list) -> DataFrame:
    return df.where(F.col(column).isin(values))


def active(df: DataFrame, flags: list[str], known: list[str]) -> DataFrame:
    """Rows whose flags are all 1 and whose ``known`` columns are present."""
    tests = [F.col(f) == 1 for f in flags] + [F.col(c).isNotNull() for c in known]
    return df.where(reduce(Column.__and__, tests))
