"""P6: from the feature table to ranked, banded and stamped scores."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callmart.context import RunContext
from callmart.fixed_values import DAILY_MODEL_FEATURES
from callmart.functions.calendar import iso_weekday
from callmart.functions.phone import clean_phone, valid_phone
from callmart.operators.scoring import assemble, score, score_bands, score_segments, shape_output, stamp_run
from callmart.session import stage
from callmart.sources.sinks import write_day

KEEP = ["phone_number", "cuid"]


def model_rows(features: DataFrame, ctx: RunContext, names: list[str] = DAILY_MODEL_FEATURES) -> DataFrame:
    """Valid phones with the model's features, gaps filled, and the weekday of the run."""
    rows = valid_phone(features.withColumn("phone_number", F.col("phone_number").cast("string")))
    rows = assemble(rows, names, KEEP).na.fill(0, names).na.fill(-1, ["cuid"])
    return rows.withColumn("weekday", iso_weekday(ctx.now))


def scored(features: DataFrame, scorer: Any, ctx: RunContext, names: list[str] = DAILY_MODEL_FEATURES) -> DataFrame:
    """(phone, client, score)."""
    return score(model_rows(features, ctx, names), scorer, [*names, "weekday"]).select(*KEEP, "score")


def output_rows(banded: DataFrame, ctx: RunContext) -> DataFrame:
    """The seven columns of a score row."""
    names = {"phone_number": "PHONE_NUMBER", "cuid": "ID_CUID", "score": "SCORE", "band": "SCORE_GROUP"}
    return shape_output(stamp_run(banded, ctx), names)


def score_output(features: DataFrame, scorer: Any, ctx: RunContext) -> DataFrame:
    """Daily scores: ten equal bands by descending score, ties by phone and client."""
    return output_rows(score_bands(scored(features, scorer, ctx), tie=KEEP), ctx)


def write_counted_scores(features: DataFrame, scorer: Any, ctx: RunContext, path: str) -> tuple[int, int]:
    """As ``write_scores``, and return the rows of the features and of the day that was written.

    Rows of stored tables are counted by the footers of their files, so nothing is read or scored twice. (Metrics observed in
    the write would do, but in Spark 4.1 they leave the session unable to ship a model that was fitted in it.)
    """
    write_scores(features, scorer, ctx, path)
    written = features.sparkSession.read.parquet(f"{path.rstrip('/')}/part_date={ctx.day_key()}")
    return features.count(), written.count()


def write_scores(features: DataFrame, scorer: Any, ctx: RunContext, path: str) -> None:
    """Score and replace today's partition of the score table."""
    write_day(score_output(features, scorer, ctx), path, ctx.day_key())


def segment_output(
    features: DataFrame, segments: Mapping[str, tuple[Column, Any, list[str]]], tie: list[str] = KEEP
) -> DataFrame:
    """Monthly scores: each segment with its own model and its own ten bands."""
    rows = valid_phone(features.withColumn("phone_number", clean_phone("phone_number")))
    return score_bands(score_segments(rows, segments, KEEP), tie=tie, segment=["segment"])


def monthly_output(
    features: DataFrame, segments: Mapping[str, tuple[Column, Any, list[str]]], ctx: RunContext
) -> DataFrame:
    """The seven columns of a score row for each segment and its rows, in a ``segment`` of their own.

    Gaps in a segment's features become 0 and a missing client -1 before it is scored, as in the daily run.
    """
    names = list(dict.fromkeys(f for _, _, own in segments.values() for f in own if f in features.columns))
    filled = features.na.fill(0, [n for n in names if n not in KEEP]).na.fill(-1, ["cuid"])
    if "weekday" not in filled.columns:
        filled = filled.withColumn("weekday", iso_weekday(ctx.now))
    banded = stage(segment_output(filled, segments), "banded")
    parts = [output_rows(banded.where(F.col("segment") == name), ctx).withColumn("segment", F.lit(name)) for name in segments]
    return reduce(DataFrame.unionByName, parts)


def write_monthly(
    features: DataFrame, segments: Mapping[str, tuple[Column, Any, list[str]]], ctx: RunContext, path: str
) -> None:
    """Score all segments, and replace today's partition of each segment's own table, ``<path>/<segment>``."""
    rows = stage(monthly_output(features, segments, ctx), "monthly")
    for name in segments:
        write_day(rows.where(F.col("segment") == name).drop("segment"), f"{path.rstrip('/')}/{name}", ctx.day_key())
