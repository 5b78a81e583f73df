"""Partition refresh, rebuilds, published views, warehouse export and the run log."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# States of a run.
STARTED, FINISHED, ERROR = "STARTED", "FINISHED", "ERROR"

RUN_LOG_SCHEMA = (
    "job string, run_id string, status string, logged_at timestamp_ntz, source_rows bigint, "
    "target_rows bigint, max_source_date timestamp_ntz, error_text string"
)


def _packed(df: DataFrame, columns: list[str]) -> DataFrame:
    """Bring rows of a partition together for writing; adaptive execution splits big partitions.

    Worth its shuffle when many days are written at once, as every task would else open a file in
    every day.
    """
    return df.hint("rebalance", *columns)


def refresh_partitions(df: DataFrame, path: str, column: str = "part_date", pack: bool = False) -> None:
    """Replace the partitions that occur in ``df`` and leave all others alone."""
    (
        (_packed(df, [column]) if pack else df)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(column)
        .parquet(path)
    )


def write_day(df: DataFrame, path: str, day: int, column: str = "part_date") -> None:
    """Replace exactly one day's partition, also when the day has no rows now."""
    rows = df.where(F.col(column) == day).drop(column) if column in df.columns else df
    rows.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{column}={day}")


def rebuild(
    df: DataFrame,
    path: str,
    partition_by: list[str] | None = None,
    sort_by: list[str] | None = None,
    pack: bool = False,
    cluster: bool = False,
) -> None:
    """Replace a whole table, optionally partitioned, with rows sorted inside each file.

    With ``cluster`` the rows are dealt by ranges of the sort columns first: files hold ranges that do not overlap within
    a partition, so the statistics of a file rule out most keys. A range of one frequent key is cut
    by the sort columns behind it.
    """
    if cluster and sort_by:
        df = df.repartitionByRange(*(partition_by or []), *sort_by)
    elif pack and partition_by:
        df = _packed(df, partition_by)
    if sort_by:
        # Spark sorts by the partition columns for the writer; put them first to sort once.
        df = df.sortWithinPartitions(*(partition_by or []), *sort_by)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def rebuild_bucketed(df: DataFrame, table: str, keys: list[str], buckets: int) -> None:
    """Replace a catalogued table in ``buckets`` of its keys, sorted by them: two such tables join without a shuffle.

    Each bucket is one file. A key that holds a large part of the rows makes its bucket as large, so take keys that tell rows
    apart, such as (phone, client).
    """
    (
        df.repartition(buckets, *keys)
        .write.mode("overwrite")
        .bucketBy(buckets, *keys)
        .sortBy(*keys)
        .saveAsTable(table)
    )


def publish_view(df: DataFrame, name: str, comments: Mapping[str, str]) -> DataFrame:
    """A view with a fixed column list and a comment on every column."""
    view = df.select(*[F.col(c).alias(c, metadata={"comment": text}) for c, text in comments.items()])
    view.createOrReplaceTempView(name)
    return view


def jdbc_sink(
    df: DataFrame, url: str, table: str, properties: Mapping[str, str] | None = None,
    batch_rows: int = 10_000, connections: int = 16,
) -> None:
    """Truncate a warehouse table and load it over a bounded number of parallel connections."""
    (
        df.write.format("jdbc")
        .mode("overwrite")
        .option("truncate", "true")
        .option("batchsize", batch_rows)
        .option("numPartitions", connections)
        .options(url=url, dbtable=table, **dict(properties or {}))
        .save()
    )


def run_log(
    spark: SparkSession,
    path: str,
    job: str,
    run_id: str,
    status: str,
    logged_at: datetime,
    source_rows: int = 0,
    target_rows: int = 0,
    max_source_date: datetime | None = None,
    error: str | None = None,
) -> None:
    """Append one row about a run: started, finished with counts, or failed with the error's text."""
    text = error or None
    row = (job, run_id, status, logged_at, source_rows, target_rows, max_source_date, text)
    spark.createDataFrame([row], RUN_LOG_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def logged_run(spark: SparkSession, path: str, job: str, run_id: str, work, clock=datetime.now):
    """Run ``work`` between a STARTED row and a FINISHED or ERROR row.

    ``work`` returns (source rows, target rows, newest source date). An error is logged and raised.
    """
    run_log(spark, path, job, run_id, STARTED, clock())
    try:
        source_rows, target_rows, newest = work()
    except Exception as error:
        run_log(spark, path, job, run_id, ERROR, clock(), error=str(error))
        raise
    run_log(spark, path, job, run_id, FINISHED, clock(), source_rows, target_rows, newest)
