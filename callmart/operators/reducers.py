"""Bloom filters: drop rows of a big table that cannot match, inside its scan, before anything is ranked, grouped or shuffled.

A filter is a table of 64-bit words of a bit array. It has at most ``hashes * bits / 64`` rows whatever the number of keys, so
it can always be sent to all tasks. Keys that are not in it are dropped for certain; some others pass, and the
join behind the filter decides. With more keys than ``bits / 8`` it lets more and more pass, and nothing else changes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callmart.session import stage

#: Bits for each hash: at most 131,072 words, and one key in forty passes wrongly with a million keys (two hashes).
BITS = 1 << 23
HASHES = 2

_WORD_BITS = 64


def _place(key: Column, number: int, bits: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(number), key), F.lit(bits))


def bloom(keys: DataFrame, column: str | Column, bits: int = BITS, hashes: int = HASHES) -> DataFrame:
    """The filter of a key column, built once and written out. A missing key is a key of its own."""
    key = F.col(column) if isinstance(column, str) else column
    places = F.array(*[F.struct(F.lit(i).alias("fn"), _place(key, i, bits).alias("at")) for i in range(hashes)])
    bit = F.expr(f"shiftleft(1L, cast(at % {_WORD_BITS} as int))")
    words = keys.select(F.inline(places)).groupBy("fn", F.shiftright("at", 6).alias("word")).agg(F.bit_or(bit).alias("set"))
    return stage(words, "bloom")


def may_match(df: DataFrame, column: str | Column, words: DataFrame, bits: int = BITS, hashes: int = HASHES) -> DataFrame:
    """Rows of ``df`` whose key may be in the filter. The key must have the type that the filter was built from."""
    key = F.col(column) if isinstance(column, str) else column
    for i in range(hashes):
        # At most bits / 64 rows.
        part = F.broadcast(words.where(F.col("fn") == i).select(F.col("word").alias(f"_word_{i}"), F.col("set").alias(f"_set_{i}")))
        at = _place(key, i, bits)
        inside = F.getbit(F.col(f"_set_{i}"), (at % _WORD_BITS).cast("int")) == 1
        df = df.join(part, (F.shiftright(at, 6) == F.col(f"_word_{i}")) & inside, "left_semi")
    return df


def met_by(df: DataFrame, column: str, words: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """``may_match`` for a filter of ``keys[key]``; keys of another type, which a join would convert, keep every row."""
    same = df.schema[column].dataType == keys.schema[key].dataType
    return may_match(df, column, words) if same else df
