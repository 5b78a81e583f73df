"""Reading parquet tables and naming them for SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def load(spark: SparkSession, folder: str, name: str, schema: StructType | None = None) -> DataFrame:
    """A parquet file or directory as a table; a given schema saves the inference."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(f"{folder.rstrip('/')}/{name}")


def register(spark: SparkSession, folder: str, names: list[str], suffix: str = "") -> None:
    """Make tables readable by SQL text as temporary views."""
    for name in names:
        load(spark, folder, name + suffix).createOrReplaceTempView(name)


def require_columns(df: DataFrame, columns: list[str], what: str) -> DataFrame:
    """Check a pipeline boundary by column name."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks columns: {', '.join(missing)}")
    return df


def align_to(df: DataFrame, schema: StructType, defaults: dict | None = None) -> DataFrame:
    """Select the columns of ``schema`` by name and type, with constants for absent ones."""
    from pyspark.sql import functions as F

    defaults = defaults or {}
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(defaults.get(f.name)))
            .cast(f.dataType)
            .alias(f.name)
            for f in schema
        ]
    )
