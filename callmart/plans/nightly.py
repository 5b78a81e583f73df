"""One night: yesterday's calls and their features, the daily feature table, and today's scores.

Each step replaces exactly what it owns (a day, a table), so a night that failed half way is simply
run again.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callmart.context import RunContext
from callmart.functions.phone import valid_phone
from callmart.operators.delivery import Load, deliver
from callmart.operators.quality import reconcile
from callmart.operators.scans import scan_range
from callmart.operators.trailing import Trailing
from callmart.plans.call_features import stored_since
from callmart.plans.call_log import HISTORY_DAYS, first_source, second_source
from callmart.plans.daily_features import COMMENTS, LOOSE_DAYS, SPAN, daily_features
from callmart.plans.day_table import features_of_day, write_day_rows
from callmart.plans.schemas import CALL_LOG
from callmart.plans.scores import KEEP, write_counted_scores
from callmart.sources.sinks import logged_run, publish_view, rebuild, write_day
from callmart.sources.tables import load, require_columns

CALLS, FEATURES, SCORES, RUNS = "calls", "daily_features", "scores", "runs"
CALL_DAYS, CALL_FEATURES, DELIVERIES = "call_days", "call_features", "deliveries"
SLICE_ROWS = 2_000_000


def refresh_calls(tables: Mapping[str, DataFrame], ctx: RunContext, root: str) -> None:
    """Replace yesterday's partition of the first source's calls."""
    day = ctx.day_key(1)
    write_day(first_source(tables, ctx, 1, 1, narrow=True), f"{root}/{CALLS}", day)


def kept_log(spark: SparkSession, tables: Mapping[str, DataFrame], contacts: DataFrame, ctx: RunContext, root: str) -> DataFrame:
    """A year of both sources: the stored days of the first, the second as it arrives."""
    stored = scan_range(load(spark, root, CALLS, CALL_LOG), ctx, HISTORY_DAYS)
    return stored.unionByName(second_source(tables["second_calls"], contacts, ctx))


def refresh_call_features(
    spark: SparkSession, tables: Mapping[str, DataFrame], contacts: DataFrame, ctx: RunContext, root: str,
    windows: Mapping[str, Trailing] | None = None,
) -> None:
    """Add yesterday to the table of days, and replace yesterday's partition of the call features.

    Half a year of history is read from the table of days; the first night of a new table needs its
    days before (``day_table.backfill_day_rows``).
    """
    log = kept_log(spark, tables, contacts, ctx, root)
    write_day_rows(log, ctx, f"{root}/{CALL_DAYS}")
    features = features_of_day(log, load(spark, root, CALL_DAYS), ctx, windows)
    write_day(features, f"{root}/{CALL_FEATURES}", ctx.day_key(1), "partition_date")


def refresh_features(
    spark: SparkSession, log: DataFrame, contacts: DataFrame, types: DataFrame, messages: DataFrame,
    ctx: RunContext, root: str, span: str = SPAN, loose_days: int = LOOSE_DAYS,
) -> DataFrame:
    """Rebuild the feature table and publish it under its documented columns."""
    rebuild(daily_features(log, contacts, types, messages, ctx, span, loose_days), f"{root}/{FEATURES}")
    return publish_view(load(spark, root, FEATURES), FEATURES, COMMENTS)


def score_night(
    spark: SparkSession, scorer: Any, ctx: RunContext, root: str, clock: Callable[[], datetime] = datetime.now
) -> None:
    """Score the stored features into today's partition, between two rows of the run log.

    Source and target rows are counted by the footers of the stored tables; the newest source date is that of the
    stored calls of a year.
    """

    def work():
        features = require_columns(load(spark, root, FEATURES), KEEP, "the feature table")
        read, written = write_counted_scores(features, scorer, ctx, f"{root}/{SCORES}")
        stored = stored_since(load(spark, root, CALLS, CALL_LOG), ctx, HISTORY_DAYS)
        newest = stored.agg(F.max("dtime_call_start")).first()[0]
        return read, written, newest

    logged_run(spark, f"{root}/{RUNS}", "answer_score", str(ctx.day_key()), work, clock)


def deliver_scores(
    spark: SparkSession, load_slice: Load, ctx: RunContext, root: str, size: int = SLICE_ROWS, clock: Callable[[], datetime] = datetime.now
) -> int:
    """Hand today's scores over in slices that are each loaded once; after a failure the same call goes on.

    Before the first slice the scores are held against the features: every valid phone and client must have a score, and no other.
    """
    scores = load(spark, root, SCORES).where(F.col("part_date") == ctx.day_key())
    scored = scores.select(F.col("PHONE_NUMBER").alias("phone_number"), F.col("ID_CUID").alias("cuid"))
    features = valid_phone(load(spark, root, FEATURES).select(*KEEP)).na.fill(-1, ["cuid"])
    apart = reconcile(features, scored, KEEP).first()
    if apart["missing_in_target"] or apart["missing_in_source"]:
        raise ValueError(f"the scores are not those of the feature table: {apart.asDict()}")
    order = [F.col("SCORE").desc(), F.col("PHONE_NUMBER").asc(), F.col("ID_CUID").asc()]
    ledger = f"{root}/{DELIVERIES}"
    return deliver(scores, order, size, ["PHONE_NUMBER", "ID_CUID"], load_slice, ledger, f"answer_score {ctx.day_key()}", clock)
