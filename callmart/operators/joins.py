"""Joins, each with the number of rows it may produce.

No broadcast is forced: Spark broadcasts a side only when its known or measured size is under the
session's threshold. ``hint`` overrides that for a caller who knows better.

Beyond that size both sides are shuffled by the key, and one key (often the missing one) may hold a
large part of the left rows. Adaptive execution splits such a partition, but only where both inputs
come straight from a shuffle of their own, which a side that was just grouped or ranked by the same
key does not. The joins here therefore compare null-safe against a right side without missing keys:
the result of ``=``, on fresh shuffles of both sides. The right side is small by then, one row per
key. ``in_place`` asks for a plain ``=`` that reuses the partitioning the rows already have; it is
for keys known to be neither missing nor hot.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callmart.operators.dedupe import latest_per
from callmart.operators.ordered import same_keys

Keys = list[str] | Mapping[str, str]


def _pairs(on: Keys) -> dict[str, str]:
    return dict(on) if isinstance(on, Mapping) else {k: k for k in on}


def _right(dim: DataFrame, on: dict[str, str], columns: list[str] | None, hint: str | None) -> DataFrame:
    """The right side with its keys out of the way of the left side's names."""
    keep = columns if columns is not None else [c for c in dim.columns if c not in on.values()]
    out = dim.select(*[F.col(b).alias(f"_on_{i}") for i, b in enumerate(on.values())], *keep)
    return out.hint(hint) if hint else out


def _known(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.where(" and ".join(f"`{c}` is not null" for c in columns))


def _join(
    left: DataFrame, right: DataFrame, on: dict[str, str], how: str, null_safe: bool = False,
    in_place: bool = False, also: Column | None = None,
) -> DataFrame:
    """Join on ``_on_0``, ``_on_1``… of the right side, which stay in the result."""
    named = {a: f"_on_{i}" for i, a in enumerate(on)}
    if in_place:
        condition = reduce(Column.__and__, [left[a] == right[b] for a, b in named.items()])
    else:
        if not null_safe:
            right = _known(right, list(named.values()))
            left = _known(left, list(named)) if how in ("inner", "left_semi") else left
        condition = same_keys(left, right, named)
    return left.join(right, condition if also is None else condition & also, how)


def lookup(
    df: DataFrame,
    dim: DataFrame,
    on: Keys,
    columns: list[str] | None = None,
    *,
    how: str = "left",
    null_safe: bool = False,
    in_place: bool = False,
    latest_by: tuple[str, str] | None = None,
    hint: str | None = None,
) -> DataFrame:
    """Add columns of ``dim``. One row per input row when ``dim`` has one row per key.

    ``latest_by=(time, tie)`` makes that so by keeping the newest row of each key. ``how`` may be
    ``inner`` to drop rows without a match. Several rows per key multiply, by design of the caller.
    """
    on = _pairs(on)
    if latest_by:
        dim = latest_per(dim, list(on.values()), *latest_by)
    right = _right(dim, on, columns, hint)
    joined = _join(df, right, on, how, null_safe, in_place)
    return joined.drop(*[f"_on_{i}" for i in range(len(on))])


def attach(df: DataFrame, features: DataFrame, keys: list[str], hint: str | None = None) -> DataFrame:
    """Join features back by all their keys, missing keys matching each other. Keeps the row count."""
    return lookup(df, features, keys, null_safe=True, hint=hint)


def enrich(df: DataFrame, steps: list[tuple[DataFrame, Keys, list[str]]]) -> DataFrame:
    """A chain of lookups, each able to use columns the one before added."""
    return reduce(lambda out, step: lookup(out, step[0], step[1], step[2]), steps, df)


def star_join(fact: DataFrame, dims: list[tuple[DataFrame, Keys, list[str]]], how: str = "inner") -> DataFrame:
    """Join a fact with its dimensions; dimensions sharing a key share one shuffle of the fact."""
    return reduce(lambda out, d: lookup(out, d[0], d[1], d[2], how=how), dims, fact)


def _match(df: DataFrame, keys_df: DataFrame, on: Keys, how: str, null_safe: bool) -> DataFrame:
    """Semi or anti join. Keys are made distinct inside each task before they move."""
    on = _pairs(on)
    return _join(df, _right(keys_df, on, [], None).distinct(), on, how, null_safe)


def restrict_to(df: DataFrame, keys_df: DataFrame, on: Keys, null_safe: bool = False) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``keys_df``; never multiplies."""
    return _match(df, keys_df, on, "left_semi", null_safe)


def missing_rows(df: DataFrame, keys_df: DataFrame, on: Keys, null_safe: bool = False) -> DataFrame:
    """Rows of ``df`` whose key does not occur in ``keys_df``."""
    return _match(df, keys_df, on, "left_anti", null_safe)


def outer_merge(a: DataFrame, b: DataFrame, keys: list[str], null_safe: bool = False) -> DataFrame:
    """Full outer join with one set of key columns.

    Both sides must have one row per key, which is also what keeps any key from being hot. Rows
    with a missing key stay apart unless ``null_safe`` makes missing keys match each other.
    """
    right = b.select(*[F.col(c).alias(f"_b_{c}") for c in b.columns])
    left = a.withColumn("_in_a", F.lit(1))
    on = {k: f"_b_{k}" for k in keys}
    plain = reduce(Column.__and__, [left[x] == right[y] for x, y in on.items()])
    joined = left.join(right, same_keys(left, right, on) if null_safe else plain, "full")
    from_a = F.col("_in_a").isNotNull()
    return joined.select(
        *[F.when(from_a, F.col(k)).otherwise(F.col(f"_b_{k}")).alias(k) for k in keys],
        *[c for c in a.columns if c not in keys],
        *[F.col(f"_b_{c}").alias(c) for c in b.columns if c not in keys],
    )


def latest_if_before(
    df: DataFrame, states: DataFrame, key: Keys, ts: str, state_ts: str, tie: str, columns: list[str]
) -> DataFrame:
    """The key's newest state, given only to rows at or after it."""
    on = _pairs(key)
    newest = latest_per(states, list(on.values()), state_ts, tie)
    wanted = list(dict.fromkeys([*columns, state_ts]))
    right = newest.select(
        *[F.col(k).alias(f"_on_{i}") for i, k in enumerate(on.values())],
        *[F.col(c).alias(f"_v_{c}") for c in wanted],
    )
    joined = _join(df, right, on, "left", also=F.col(ts) >= F.col(f"_v_{state_ts}"))
    return joined.select(*df.columns, *[F.col(f"_v_{c}").alias(c) for c in columns])


def lookup_fallback(
    df: DataFrame, dim: DataFrame, first_keys: Keys, second_keys: Keys, column: str, out: str
) -> DataFrame:
    """The same lookup by one key set, then by another; the first hit wins."""
    by_first = dim.withColumnRenamed(column, "_first")
    by_second = dim.withColumnRenamed(column, "_second")
    found = lookup(lookup(df, by_first, first_keys, ["_first"]), by_second, second_keys, ["_second"])
    return found.withColumn(out, F.coalesce("_first", "_second")).drop("_first", "_second")


def kv_param(
    header: DataFrame, params: DataFrame, key: str, rules: list[str], columns: list[str]
) -> DataFrame:
    """Header rows of the given rules with one named parameter from a key-value table."""
    wanted = params.where(F.col("key") == F.lit(key)).select("id", *columns)
    return header.where(F.col("ruleid").isin(rules)).join(wanted, "id")
