"""Running values per key, and positions in a global order, on any skew.

``Window.partitionBy(key)`` puts all rows of a key into one task. That is the right plan until a
key is very big, so keys are counted first, all of them:

* ordinary keys use the plain window: one shuffle, one sort;
* rows of hot keys are range-partitioned by key *and* order, which cuts a big key into pieces of
  similar size. Each piece runs the same window on its own, and a table of piece totals (one row
  per piece and hot key) supplies what came before.

Both branches give the same values, so results do not depend on which one a key took.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callmart.session import stage

# A key with more rows than this may be too much for one task.
HOT_ROWS = 1_000_000
# Hot rows are cut finer than a task's worth, so that the pieces spread evenly over the tasks.
PIECES_PER_TASK = 8
# Most pieces the hot rows are cut into; beyond it the pieces grow.
HOT_PIECES = 20_000

_POSITION_BITS = 33  # monotonically_increasing_id: partition above, row number below


def same_keys(left: DataFrame, right: DataFrame, keys: Mapping[str, str] | list[str]) -> Column:
    """Null-safe equality of the key columns of two frames."""
    pairs = keys.items() if isinstance(keys, Mapping) else [(k, k) for k in keys]
    return reduce(Column.__and__, [left[a].eqNullSafe(right[b]) for a, b in pairs])


@dataclass(frozen=True)
class Hot:
    """Keys too big for one task (None when there are none) and how many rows they hold."""

    keys: DataFrame | None
    rows: int


def find_hot(df: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS, weight: str = "1") -> Hot:
    """All keys with more than ``hot_rows`` rows, from one count that combines inside each task.

    A row stands for ``weight`` rows, a SQL expression: rows that were counted before need not be read again.

    However many there are, they stay a table: it is written out, and only their number of rows comes back. Operators
    count for themselves; a pipeline that uses one key several times counts once and passes it on.
    """
    n = "_hot_rows"
    found = stage(df.groupBy(*keys).agg(F.expr(f"sum({weight})").alias(n)).where(F.col(n) > hot_rows), "hot-keys")
    rows = found.agg(F.sum(n)).first()[0]
    return Hot(found.select(*keys), rows) if rows else Hot(None, 0)


def _ordering(order: list[str]) -> list[Column]:
    """``["ts desc", "id"]`` as sort columns."""
    words = [o.split() for o in order]
    return [F.col(w[0]).desc() if w[-1].lower() == "desc" else F.col(w[0]).asc() for w in words]


def _local(keys: list[str], order: list[str], sums, maxes, lasts, prevs) -> list[str]:
    """The running columns within one window, as SQL."""
    spec = f"partition by {', '.join(keys)} order by {', '.join(order)}"
    upto = f"({spec} rows between unbounded preceding and current row)"
    return (
        [f"sum({e}) over {upto} as {out}" for out, e in sums.items()]
        + [f"max({e}) over {upto} as {out}" for out, e in maxes.items()]
        + [f"last({e}, true) over {upto} as {out}" for out, e in lasts.items()]
        + [f"lag({e}) over ({spec}) as {out}" for out, e in prevs.items()]
    )


def _plain(df, keys, order, weight, hot, hot_rows, sums, maxes, lasts, prevs) -> DataFrame:
    """The running columns with one window over each key."""
    return df.selectExpr("*", *_local(keys, order, sums, maxes, lasts, prevs))


def _pieced(df, keys, order, weight, hot, hot_rows, sums, maxes, lasts, prevs) -> DataFrame:
    """The same columns for hot keys, piece by piece."""
    pieces = min(HOT_PIECES, hot.rows * weight // max(1, hot_rows // PIECES_PER_TASK) + 2)
    cut = df.repartitionByRange(pieces, *keys, *_ordering(order))
    cut = stage(cut.withColumn("_piece", F.spark_partition_id()), "hot")
    within = [*keys, "_piece"]
    spec = f"partition by {', '.join(within)} order by {', '.join(order)}"
    local = cut.selectExpr(
        "*",
        *_local(within, order, sums, maxes, lasts, prevs),
        *[f"{e} as _own_{out}" for out, e in prevs.items()],
        f"row_number() over ({spec}) as _row_of_piece",
        f"lead(1) over ({spec}) is null as _end_of_piece",
    )

    by_piece = f"partition by {', '.join(keys)} order by _piece"
    earlier = f"({by_piece} rows between unbounded preceding and 1 preceding)"
    before = local.where("_end_of_piece").selectExpr(
        *[f"{k} as _k_{k}" for k in within],
        *[f"sum({out}) over {earlier} as _b_{out}" for out in sums],
        *[f"max({out}) over {earlier} as _b_{out}" for out in maxes],
        *[f"last({out}, true) over {earlier} as _b_{out}" for out in lasts],
        *[f"lag(_own_{out}) over ({by_piece}) as _b_{out}" for out in prevs],
    )
    # One row per piece and hot key.
    joined = local.join(before, same_keys(local, before, {k: f"_k_{k}" for k in within}), "left")
    return joined.selectExpr(
        *df.columns,
        *[f"coalesce(_b_{out} + {out}, {out}, _b_{out}) as {out}" for out in sums],
        *[f"greatest(_b_{out}, {out}) as {out}" for out in maxes],
        *[f"coalesce({out}, _b_{out}) as {out}" for out in lasts],
        *[f"if(_row_of_piece = 1, _b_{out}, {out}) as {out}" for out in prevs],
    )


def paths(
    df: DataFrame, keys: list[str], hot: Hot, hot_rows: int = HOT_ROWS, gather: bool = False
) -> list[tuple[DataFrame, Callable[..., DataFrame]]]:
    """The rows of ordinary and of hot keys, each with the function that runs over them.

    That function takes (rows, order, sums=, maxes=, lasts=, prevs=, weight=) as ``running`` does.
    An operator with several passes takes each path to its end before uniting them, so that rows
    stay partitioned between passes. ``gather`` shuffles the rows of ordinary keys by key at once, for an operator that
    groups them by key and more first.
    """
    gathered = lambda rows: rows.repartition(*keys) if gather else rows

    def runner(how):
        def run(rows, order, *, sums=None, maxes=None, lasts=None, prevs=None, weight=1):
            parts = (dict(sums or {}), dict(maxes or {}), dict(lasts or {}), dict(prevs or {}))
            return how(rows, keys, order, weight, hot, hot_rows, *parts)

        return run

    if hot.keys is None:
        return [(gathered(df), runner(_plain))]
    listed = hot.keys.select(*[F.col(k).alias(f"_h_{k}") for k in keys])
    on = same_keys(df, listed, {k: f"_h_{k}" for k in keys})
    return [
        (gathered(df.join(listed, on, "left_anti")), runner(_plain)),
        (df.join(listed, on, "left_semi"), runner(_pieced)),
    ]


def running(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    *,
    sums: Mapping[str, str] | None = None,
    maxes: Mapping[str, str] | None = None,
    lasts: Mapping[str, str] | None = None,
    prevs: Mapping[str, str] | None = None,
    hot: Hot | None = None,
    weight: int = 1,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add running sums and maxima, the last known value so far, and the previous row's value.

    Each maps a new column to a SQL expression over the row. ``order`` (``"ts"`` or ``"ts desc"``)
    must end in a unique key wherever tied rows would get different values. ``weight`` is how many
    rows there are here for one row that ``hot`` counted.
    """
    hot = hot or find_hot(df, keys, hot_rows)
    done = [
        run(rows, order, sums=sums, maxes=maxes, lasts=lasts, prevs=prevs, weight=weight)
        for rows, run in paths(df, keys, hot, hot_rows)
    ]
    return reduce(DataFrame.unionByName, done)


def row_index(
    df: DataFrame, order: list[Column], segment: list[str] | None = None
) -> DataFrame:
    """Add ``row_index`` (1-based, in ``order``) and ``row_total``, per segment if one is given.

    A global sort range-partitions the rows; the row's place inside its partition plus the sizes
    of the partitions before it is its place overall. No task ever holds more than one range.
    The sorted rows are staged, because both passes must see the same partitions.
    """
    spark = df.sparkSession
    segment = segment or []
    placed = stage(
        df.orderBy(*segment, *order).withColumn("_place", F.monotonically_increasing_id()), "sorted"
    )
    piece = F.shiftright("_place", _POSITION_BITS).cast("int")
    within = F.col("_place").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    placed = placed.withColumn("_piece", piece).withColumn("_place", within)

    # One row for each partition of the sort, and for each segment that begins in it.
    parts = placed.groupBy("_piece", *segment).agg(F.count(F.lit(1)).alias("_rows"), F.min("_place").alias("_low"))
    if not segment:
        sizes = sorted((r["_piece"], r["_rows"]) for r in parts.collect())
        starts, total = [], 0
        for number, size in sizes:
            starts.append((number, total))
            total += size
        starts = spark.createDataFrame(starts, "_piece int, _start long")
        placed = placed.join(F.broadcast(starts), "_piece")
        placed = placed.withColumn("row_index", F.col("_start") + F.col("_place") + 1)
        return placed.withColumn("row_total", F.lit(total).cast("long")).drop("_piece", "_place", "_start")

    # Where a segment's rows of a partition begin within the segment: what its earlier partitions hold.
    whole = Window.partitionBy(*segment)
    earlier = whole.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(
        *[F.col(s).alias(f"_s_{s}") for s in segment],
        F.col("_piece").alias("_p"),
        "_low",
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start"),
        F.sum("_rows").over(whole).alias("row_total"),
    )
    on = same_keys(placed, starts, {s: f"_s_{s}" for s in segment}) & (placed["_piece"] == starts["_p"])
    return placed.join(starts, on).select(
        *df.columns, (F.col("_start") + F.col("_place") - F.col("_low") + 1).alias("row_index"), "row_total"
    )
