"""Line dedup: lines that many documents have stay in one of them only.

Every text is exploded into its lines, and a line long enough goes on as two hashes of its normalised form, never as text.
The documents of each hash are counted distinct, in two steps that combine inside each task, so a line of all documents is a
few rows. Hashes over the threshold are joined back to the narrow (row, place, hash) rows, adaptive execution splits the
common ones, and each text is put together again, by position, from the places that stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callmart.llm.common import SPACES

LEAST_CHARS = 40
LEAST_DOCUMENTS = 5

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """What lines are compared by: white space off both ends, A to Z in lower case."""
    return F.translate(F.btrim(line, F.lit(SPACES)), _UPPER, _LOWER)


def _lines(docs: DataFrame) -> DataFrame:
    """doc_id, a hash that tells rows of one id apart, and the lines. A missing text is one empty line."""
    text = F.coalesce(F.col("text"), F.lit(""))
    doc_id = F.col("doc_id").cast("long")
    return docs.select(doc_id.alias("doc_id"), F.xxhash64(doc_id, text).alias("row_key"), F.split(text, "\n", -1).alias("lines"))


def common_lines(docs: DataFrame, least_chars: int = LEAST_CHARS, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """doc_id, row_key and ``places`` (from 0) of the lines that a row loses; rows that lose none are not listed."""
    placed = _lines(docs).where("doc_id is not null").select("doc_id", "row_key", F.posexplode("lines").alias("place", "line"))
    # A line shorter than that before its ends are cut can only get shorter.
    keyed = placed.where(F.length("line") >= least_chars).select("doc_id", "row_key", "place", line_key(F.col("line")).alias("key"))
    keyed = keyed.where(F.length("key") >= least_chars)
    # Two hashes from different seeds, 128 bits.
    keyed = keyed.select("doc_id", "row_key", "place", F.xxhash64("key").alias("a"), F.xxhash64(F.lit(1), "key").alias("b"))
    common = (
        keyed.groupBy("a", "b")
        .agg(F.count_distinct("doc_id").alias("documents"), F.max("doc_id").alias("holder"))
        .where(F.col("documents") >= least_documents)
        .select(F.col("a").alias("_a"), F.col("b").alias("_b"), "holder")
    )
    lost = keyed.join(common, (F.col("a") == F.col("_a")) & (F.col("b") == F.col("_b"))).where("doc_id < holder")
    return lost.groupBy("doc_id", "row_key").agg(F.collect_set("place").alias("places"))


def drop_common_lines(
    docs: DataFrame, least_chars: int = LEAST_CHARS, least_documents: int = LEAST_DOCUMENTS
) -> DataFrame:
    """Every document without the lines that many documents share.

    A line's key is the line without white space at its ends, A to Z lower-cased. All lines of a key of at least
    ``least_chars`` code points that at least ``least_documents`` documents hold go, except in the largest doc_id that holds it.
    Returns doc_id, n_lines, n_dropped and ``kept``, the other lines joined by line feeds.

    Missing and empty texts are one empty line, which stays. Rows without doc_id are not counted and keep all lines. Rows
    that share a doc_id are one document to the counts, and each is cut by itself; equal rows get equal results. An empty
    table gives an empty one. Columns other than doc_id and text are not read.
    """
    lost = common_lines(docs, least_chars, least_documents).withColumnsRenamed({"doc_id": "_doc_id", "row_key": "_row_key"})
    rows = _lines(docs)
    found = rows.join(lost, (rows["doc_id"] == lost["_doc_id"]) & (rows["row_key"] == lost["_row_key"]), "left")
    n = F.size("lines")
    stay = F.array_except(F.sequence(F.lit(0), n - 1), F.col("places"))
    kept = F.array_join(F.transform(stay, lambda place: F.get("lines", place)), "\n")
    return found.select(
        "doc_id",
        n.cast("long").alias("n_lines"),
        F.coalesce(F.size("places"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("places").isNull(), F.array_join("lines", "\n")).otherwise(kept).alias("kept"),
    )
