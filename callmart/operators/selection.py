"""Rows at given ranks of an order, by counting ranges: no sort of the table and no shuffle of its rows.

A rank lies between two rows of a sample, with a margin that nearly always holds and is checked by counting. The rows in
between are sampled in the same way, until few enough are left to be sorted. Each round is two passes that send back counts and
a sample of bounded size.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

#: Rows of a sample, and rows that are few enough to be sorted on the driver: some columns each.
SAMPLE = 20_000

_KEY = "_key"


def ascending(df: DataFrame, descending: str, ties: Sequence[str]) -> Column:
    """A key whose ascending order is the descending order of a number, then the ascending order of the ties.

    As in a descending sort, NaN comes first and a missing number last.
    """
    if not isinstance(df.schema[descending].dataType, NumericType):
        raise TypeError(f"{descending} is no number")
    x = F.col(descending).cast("double") if df.schema[descending].dataType.typeName() in ("float", "double") else F.col(descending)
    nan = F.isnan(x) if df.schema[descending].dataType.typeName() in ("float", "double") else F.lit(False)
    place = F.when(x.isNull(), 2).when(nan, 0).otherwise(1)
    # 0.0 - x and not -x: there is one zero.
    value = F.when(place == 1, F.lit(0) - x)
    return F.struct(place.alias("place"), value.alias("value"), *[F.col(t).alias(f"t{i}") for i, t in enumerate(ties)])


def _literal(df: DataFrame, key: Row) -> Column:
    kind = df.schema[_KEY].dataType
    return F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(key, kind, strict=True)])


def _sample(df: DataFrame, size: int) -> list[Row]:
    """Keys in order, at most ``size``: those of the least hashes, which is an even sample of different keys."""
    taken = df.select(_KEY).orderBy(F.xxhash64(_KEY)).limit(size)
    return [r[0] for r in taken.orderBy(_KEY).collect()]


def _counts(df: DataFrame, keys: list[Row]) -> list[int]:
    """How many rows lie at or before each key."""
    found = df.agg(*[F.count_if(F.col(_KEY) <= _literal(df, k)).alias(f"c{i}") for i, k in enumerate(keys)]).first()
    return list(found)


def at_ranks(
    df: DataFrame, key: Column, ranks: Sequence[int], sample: int = SAMPLE, total: int | None = None
) -> dict[int, Row] | None:
    """The keys of the rows of the given ranks (from 1) in the order of ``key``, or None if a row behind one has its key too.

    ``df`` is read several times, so it should be a table; ``total`` is its number of rows, if known.
    """
    keyed = df.select(key.alias(_KEY))
    found: dict[int, Row] = {}
    # Ranks that lie among the same rows are looked for together: (rows, how many lie before them, their number, ranks).
    waiting = [(keyed, 0, keyed.count() if total is None else total, sorted({*ranks}))]
    while waiting:
        rows, before, total, wanted = waiting.pop()
        if total <= sample:
            listed = [r[0] for r in rows.orderBy(_KEY).collect()]
            # Rows of one key are never parted, so the next row is in the list as well.
            if any(listed[r - before - 1] in listed[r - before : r - before + 1] for r in wanted):
                return None
            found.update({r: listed[r - before - 1] for r in wanted})
            continue
        keys = _sample(rows, sample)
        if len(set(keys)) == 1:
            return None  # rows of one key, as many as a sample
        margin = 4 * math.sqrt(len(keys)) + 2
        # Some cuts anywhere, so that the rows left become fewer in any case.
        places = {len(keys) * i // 8 for i in range(8)}
        for r in wanted:
            middle = (r - before) / total * len(keys)
            places |= {math.floor(middle - margin), round(middle), math.ceil(middle + margin)}
        cuts = sorted(p for p in places if 0 <= p < len(keys))
        counts = [before, *(before + c for c in _counts(rows, [keys[p] for p in cuts])), before + total]
        for i in range(len(counts) - 1):
            inside = [r for r in wanted if counts[i] < r <= counts[i + 1]]
            if not inside:
                continue
            part = rows
            if i:
                part = part.where(F.col(_KEY) > _literal(rows, keys[cuts[i - 1]]))
            if i < len(cuts):
                part = part.where(F.col(_KEY) <= _literal(rows, keys[cuts[i]]))
            size = counts[i + 1] - counts[i]
            if size == total:
                return None  # most rows have one key
            waiting.append((part, counts[i], size, inside))
    return found


def bands(df: DataFrame, by: str, ties: Sequence[str], count: int, out: str, sample: int = SAMPLE) -> DataFrame | None:
    """``df``, a table, with its rows' bands of equal size by descending ``by``; None if its order is not unique at a band's end.

    Band b ends with the row of rank ``b * n div count``.
    """
    key = ascending(df, by, ties)
    total = df.count()
    ends = [b * total // count for b in range(1, count)]
    found = at_ranks(df, key, [e for e in ends if e], sample, total)
    if found is None:
        return None
    keyed = df.withColumn(_KEY, key)
    above = [F.lit(1) if not e else (F.col(_KEY) > _literal(keyed, found[e])).cast("int") for e in ends]
    band = F.lit(1)
    for a in above:
        band = band + a
    return keyed.withColumn(out, band.cast("int")).drop(_KEY)
