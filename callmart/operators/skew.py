"""Frequent keys by a sketch, and joins that salt them.

A sketch of frequent items keeps a bounded number of counters in each task, and the tasks' sketches are merged; a key that holds more than
a small share of the rows is always among them. That is one pass over one column, without a shuffle of its values. Rows of
such a key are dealt over salts, and the other side's rows of it are repeated for each salt. The salt is a column, so later joins by the same
key and salt find the rows in place.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Counters of a sketch: a key's count is off by at most this part of the rows.
TRACKED = 10_000
#: Most keys that are salted. With shares from 1 / 1000 on there are no more.
LISTED = 1_000
SALT = "_salt"


def heavy_keys(df: DataFrame, column: str, parts: int | None = None) -> dict:
    """For each key that holds over one ``parts``-th of the rows, how many times over it does.

    ``parts`` is four times the session's shuffle partitions by default, and ``LISTED`` at most. A missing key is not counted.
    """
    spark = df.sparkSession
    parts = min(LISTED, parts or 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    known = df.where(F.col(column).isNotNull())
    sketch = F.expr(f"approx_top_k(`{column}`, {LISTED}, {TRACKED})")
    found = known.agg(F.count(F.lit(1)).alias("n"), sketch.alias("top")).first()
    if not found["n"]:
        return {}
    share = found["n"] / parts
    return {r["item"]: math.ceil(r["count"] / share) for r in found["top"] if r["count"] > share}


def _salts(key: Column, heavy: Mapping) -> Column:
    """How many salts a key has: one for most."""
    if not heavy:
        return F.lit(1)
    counts = F.create_map(*[F.lit(x) for pair in heavy.items() for x in pair])
    return F.coalesce(F.try_element_at(counts, key), F.lit(1))


def salted(df: DataFrame, column: str, heavy: Mapping, apart: Column, out: str = SALT) -> DataFrame:
    """Add the salt of each row: by ``apart``, which tells rows of one key apart, and always 0 for a key that is not heavy."""
    return df.withColumn(out, F.pmod(F.xxhash64(apart), _salts(F.col(column), heavy)).cast("int"))


def spread(df: DataFrame, column: str, heavy: Mapping, out: str = SALT) -> DataFrame:
    """Repeat the rows of each heavy key for all of its salts."""
    return df.withColumn(out, F.explode(F.sequence(F.lit(0), _salts(F.col(column), heavy) - 1)))
