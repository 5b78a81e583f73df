"""Features of earlier rows of the same key."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callmart.operators.ordered import HOT_ROWS, Hot, find_hot, running


def lag_features(
    df: DataFrame,
    keys: list[str],
    ts: str,
    tie: str | list[str],
    columns: Mapping[str, str],
    hot: Hot | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Values of the previous row of the same key, all from one sort."""
    order = [ts, tie] if isinstance(tie, str) else [ts, *tie]
    return running(df, keys, order, prevs=columns, hot=hot, hot_rows=hot_rows)


def rank_by_recency(
    df: DataFrame, keys: list[str], ts: str, tie: str, out: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Number the rows of each key from the newest, keeping all of them."""
    return running(df, keys, [f"{ts} desc", f"{tie} desc"], sums={out: "1"}, hot_rows=hot_rows)


def asof_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    left_ts: str,
    right_ts: str,
    right_tie: str,
    columns: list[str],
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Each left row with the newest right row of its key at or before it.

    Both sides go through one ordered pass; no pairs are formed. A left row without an earlier
    right row keeps missing values.
    """
    states = right.where(F.col(right_ts).isNotNull()).select(
        *keys,
        F.col(right_ts).alias("_at"),
        F.lit(0).alias("_side"),
        F.col(right_tie).alias("_tie"),
        F.lit(0).cast("long").alias("_apart"),
        F.struct(*columns).alias("_state"),
    )
    asking = left.select(
        *keys,
        F.col(left_ts).alias("_at"),
        F.lit(1).alias("_side"),
        # Left rows of one instant get one answer; the hash only lets a crowd of them be split.
        F.xxhash64(*left.columns).alias("_apart"),
        F.struct(*[c for c in left.columns if c not in keys]).alias("_row"),
    )
    merged = states.unionByName(asking, allowMissingColumns=True)
    hot = find_hot(left.select(*keys).unionByName(right.select(*keys)), keys, hot_rows)
    order = ["_at", "_side", "_tie", "_apart"]
    done = running(merged, keys, order, lasts={"_found": "_state"}, hot=hot, hot_rows=hot_rows)
    return done.where("_side = 1").select(
        *[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in left.columns],
        *[F.col(f"_found.{c}").alias(c) for c in columns],
    )
