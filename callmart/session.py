"""Session settings and the shared folder that staged tables go to."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join input even when a later operator then needs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Rows already partitioned by some of the join keys stay where they are. Keys too big for that
    # never arrive that way: ``operators.ordered`` splits them.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings every operator here relies on."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder for staged tables, one that all executors share.

    ``spark.checkpoint.dir``, else the checkpoint folder that was set on the session's context, else a
    folder in the warehouse.
    """
    folder = (
        spark.conf.get("spark.checkpoint.dir", None)
        or spark.sparkContext.getCheckpointDir()
        or spark.conf.get("spark.sql.warehouse.dir")
    )
    return f"{folder.rstrip('/')}/callmart/{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, label: str = "table") -> str:
    """A path in the shared folder that nothing has written to yet."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where two passes must see the very same rows in the very same partitions (row
    positions) and where several consumers would otherwise recompute a long plan. The copy is
    columnar, pruned on read, and survives the loss of executors.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear_staged(spark: SparkSession) -> None:
    """Delete this application's staged tables; call once their readers are done."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(shared_dir(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
