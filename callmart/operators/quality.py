"""Row counts, null profiles and comparison of a target with its source."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table with its row count."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        out = one if out is None else out.unionByName(one)
    return out


def profile(df: DataFrame) -> DataFrame:
    """Type, rows and missing values of every column, from one pass over the table."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count(F.when(F.col(c).isNull(), 1)).alias(f"_n_{i}") for i, c in enumerate(df.columns)],
    )
    lines = F.array(
        *[
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("column_type"),
                F.col("_rows").alias("rows"),
                F.col(f"_n_{i}").alias("nulls"),
            )
            for i, f in enumerate(df.schema)
        ]
    )
    return counts.select(F.inline(lines))


def reconcile(src: DataFrame, tgt: DataFrame, keys: list[str]) -> DataFrame:
    """Rows on both sides and distinct keys missing on either, from one grouping by key.

    Counts per key are combined inside each task first, so a hot key costs one row per task.
    """
    both = src.select(*keys, F.lit(1).alias("_s"), F.lit(0).alias("_t")).unionByName(
        tgt.select(*keys, F.lit(0).alias("_s"), F.lit(1).alias("_t"))
    )
    per_key = both.groupBy(*keys).agg(F.sum("_s").alias("_s"), F.sum("_t").alias("_t"))
    return per_key.agg(
        F.coalesce(F.sum("_s"), F.lit(0)).alias("source_rows"),
        F.coalesce(F.sum("_t"), F.lit(0)).alias("target_rows"),
        F.count(F.when(F.col("_t") == 0, 1)).alias("missing_in_target"),
        F.count(F.when(F.col("_s") == 0, 1)).alias("missing_in_source"),
    )
