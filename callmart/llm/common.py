"""Pieces that several operators of this folder share."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from callmart.session import stage

#: What separates words everywhere in this folder: blank, and the five control characters from tab to CR.
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def texts(docs: DataFrame, *more: Column) -> DataFrame:
    """doc_id and the whole text as UTF-8 bytes (a missing text is empty), and ``more``."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"),
        *more,
    )


def crc_fold(doc_id: Column | str, folds: int) -> Column:
    """CRC-32 of the id as decimal text, modulo ``folds``; a missing id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % folds


def python_fold(doc_id: int, folds: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % folds


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, training: Column, rows: int, max_bytes: int, required: bool = False
) -> list[tuple[bytes, int]]:
    """At most ``rows`` labelled texts and ``max_bytes`` of text, for fitting a model on the driver.

    Rows are taken in the order of a hash of the id, so that the sample is even over the corpus and
    the same on every run. A text that does not fit any more is passed over, and the next ones are tried. If labelled
    texts exist and none fits, the sample is empty, or an error if it is ``required``. Both bounds are parameters of the models that call this. The ids are
    chosen on the narrow label table, so one pass over the documents is enough.
    """
    order = F.xxhash64("doc_id")
    chosen = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & training)
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max(label).cast("int").alias("label"))
        .orderBy(order, "doc_id")
        .limit(rows)
    )
    # At most ``rows`` rows of two numbers.
    found = texts(docs).join(F.broadcast(chosen), "doc_id").withColumn("order", order)
    found = found.withColumn("bytes", F.octet_length("text").cast("long")).withColumn("row", F.monotonically_increasing_id())
    found = stage(found.withColumn("tie", F.xxhash64("text")), "sample")
    by = ["order", "doc_id", "bytes", "tie", "row"]
    total, taken, first = 0, [], None
    for r in found.select(*by).orderBy(*by).limit(2 * rows).collect():
        if total + r["bytes"] <= max_bytes:
            total += r["bytes"]
            taken.append((r["row"],))
        elif required and not taken:
            first = first or r
    if not taken:
        if first:
            raise ValueError(f"no labelled text fits into {max_bytes} bytes; the first one has {first['bytes']}")
        return []
    kept = found.join(F.broadcast(docs.sparkSession.createDataFrame(taken, "row long")), "row").orderBy(*by)
    return [(bytes(r["text"]), r["label"]) for r in kept.select("text", "label").collect()]


def batches_of(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches that hold a row."""
    return (b for b in rows if b.num_rows)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * z))
