"""From a raw corpus to packed training sequences: five stages, each written as Parquet and read by the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callmart.llm import nearcopies, packing, substrings, surrogates, toxicity
from callmart.llm.common import read_table
from callmart.llm.queries import DEMO_KEY
from callmart.session import configure, stage

VOCABULARY = "word_bpe_49k.json"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, fitted on the labelled ones among them, does not reject."""
    labels = read_table(spark, sf_dir, "labels")
    return toxicity.keep_clean(docs, toxicity.train(docs, labels, F.lit(True), required=True))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id: found by BK-trees over SimHash fingerprints, 0.8 or more of their 5-word shingles in common."""
    return nearcopies.keep_first(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that earlier documents have; texts without any stay as they are."""
    return substrings.without_repeats(docs)


def replace_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with surrogates in place of private data."""
    return surrogates.replace_private(docs, DEMO_KEY).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each piece of a document, with its place in a training sequence."""
    return packing.pack_documents(docs, public_tokenizers.path(VOCABULARY))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_copies),
    ("substrings", cut_repeats),
    ("private_data", replace_private),
    ("packing", pack),
]

#: No SQL can fit a model, link fingerprints or tokenise; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    configure(spark)
    docs = read_table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
