"""Delivery of a ranked table in consecutive slices, each once: a ledger says which are there, so a rerun loads the others."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from callmart.operators.ordered import row_index
from callmart.session import new_path, stage
from callmart.sources.sinks import refresh_partitions

LEDGER_SCHEMA = "export string, chunk_no bigint, rows bigint, key_hash bigint, loaded_at timestamp_ntz"

#: Loads one slice: its rows and its number. It must replace what an earlier, broken load of the slice has left.
Load = Callable[[DataFrame, int], None]

#: Loads several slices at once: their rows with ``chunk_no``, and their numbers. Replaces what it finds of any of them.
LoadMany = Callable[[DataFrame, list[int]], None]

#: Most slices that are loaded at once.
MOST_SLICES = 1_024


def key_hash(*keys: str) -> Column:
    """A number that a slice's keys make in any order: 60 bits of their digests, XORed."""
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    return F.bit_xor(F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint"))


def _numbered(df: DataFrame, order: list[Column], size: int) -> DataFrame:
    return row_index(df, order).withColumn("chunk_no", F.expr(f"(row_index - 1) div {int(size)}")).drop("row_index", "row_total")


def sliced(df: DataFrame, order: list[Column], size: int) -> DataFrame:
    """``df`` with ``chunk_no``, written out by it, so that a slice is read without the others."""
    rows = _numbered(df, order, size)
    path = new_path(df.sparkSession, "slices")
    rows.write.partitionBy("chunk_no").parquet(path)
    return df.sparkSession.read.schema(rows.schema).parquet(path)


def slice_plan(slices: DataFrame, keys: list[str]) -> DataFrame:
    """chunk_no, rows and key_hash of each slice."""
    return slices.groupBy("chunk_no").agg(F.count(F.lit(1)).alias("rows"), key_hash(*keys).alias("key_hash"))


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger, empty if nothing was loaded yet."""
    try:
        return spark.read.schema(LEDGER_SCHEMA).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER_SCHEMA)


def missing_slices(plan: DataFrame, ledger: DataFrame, export: str) -> DataFrame:
    """Slices of ``plan`` that the ledger does not list with the same rows and keys."""
    done = ledger.where(F.col("export") == export).select("chunk_no", "rows", "key_hash").distinct()
    return plan.join(done, ["chunk_no", "rows", "key_hash"], "left_anti")


def deliver(
    df: DataFrame, order: list[Column], size: int, keys: list[str], load: Load, ledger_path: str, export: str,
    clock: Callable[[], datetime] = datetime.now,
) -> int:
    """Load the slices of ``df`` that are not loaded yet, one after the other, and return their number.

    A slice is entered in the ledger once its load has returned. After a failure the same call goes on with the slice that failed;
    a slice whose rows have changed since is loaded again. ``order`` must be unique, or a slice may change between calls. Only the slices'
    numbers, row counts and hashes come to the driver.
    """
    spark = df.sparkSession
    slices = sliced(df, order, size)
    todo = _todo(slices, keys, ledger_path, export)
    for one in todo:
        load(slices.where(F.col("chunk_no") == one[0]).drop("chunk_no"), one[0])
        _enter(spark, ledger_path, export, [one], clock)
    return len(todo)


def deliver_together(
    df: DataFrame, order: list[Column], size: int, keys: list[str], load: LoadMany, ledger_path: str, export: str,
    clock: Callable[[], datetime] = datetime.now, most: int = MOST_SLICES,
) -> int:
    """``deliver`` for many small slices: several are loaded by one job, first one, then twice as many each time up to ``most``.

    A target that fails at once has cost one slice of work, and the number of jobs grows with a ``most``-th of the slices. The slices of a load are
    entered in the ledger together once it has returned; after a failure the same call goes on with the load that failed.
    """
    spark = df.sparkSession
    # In order, so a load's filter leaves out all files but those of its own range.
    slices = stage(_numbered(df, order, size), "slices")
    todo = _todo(slices, keys, ledger_path, export)
    begin, at_once = 0, 1
    while begin < len(todo):
        batch = todo[begin : begin + at_once]
        numbers = [chunk_no for chunk_no, _, _ in batch]
        load(slices.where(F.col("chunk_no").isin(numbers)), numbers)
        _enter(spark, ledger_path, export, batch, clock)
        begin, at_once = begin + len(batch), min(2 * at_once, most)
    return len(todo)


def _todo(slices: DataFrame, keys: list[str], ledger_path: str, export: str) -> list[tuple[int, int, int]]:
    """(chunk_no, rows, key_hash) of the slices that are not loaded yet, in order."""
    todo = missing_slices(slice_plan(slices, keys), read_ledger(slices.sparkSession, ledger_path), export)
    return sorted(tuple(r) for r in todo.select("chunk_no", "rows", "key_hash").collect())


def _enter(spark: SparkSession, path: str, export: str, done: list[tuple[int, int, int]], clock: Callable[[], datetime]) -> None:
    entries = [(export, *one, clock()) for one in done]
    spark.createDataFrame(entries, LEDGER_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def to_folder(path: str) -> Load:
    """Loads a slice into a folder of its own below ``path``."""

    def load(rows: DataFrame, chunk_no: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path.rstrip('/')}/chunk_no={chunk_no}")

    return load


def to_folders(path: str) -> LoadMany:
    """Loads slices into folders of their own below ``path``, in one job."""
    return lambda rows, _: refresh_partitions(rows, path, "chunk_no")
