"""One row per key, and duplicate removal.

Row selection is a ``row_number`` filter: Spark keeps only the wanted rows of each key in every
task before the shuffle, so a hot key sends a handful of rows per task and no more. The order
always ends in a tie key that is unique, so reruns pick the same row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_per(df: DataFrame, keys: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows of each key in the given order."""
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_position", position).where(F.col("_position") <= n).drop("_position")


def latest_per(df: DataFrame, keys: list[str], ts: str, tie: str) -> DataFrame:
    """The newest row of each key."""
    return top_per(df, keys, [F.col(ts).desc(), F.col(tie).desc()])


def first_per(df: DataFrame, keys: list[str], ts: str, tie: str) -> DataFrame:
    """The oldest row of each key; a row without a time counts as the newest."""
    return top_per(df, keys, [F.col(ts).asc_nulls_last(), F.col(tie).asc()])


def dedupe(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Distinct rows, or distinct combinations of ``keys``."""
    return df.select(*keys).distinct() if keys else df.distinct()
