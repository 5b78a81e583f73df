"""Calls summed by pair and day, stored by day, so that a night reads half a year of history as one row per pair and day.

A window of months behind yesterday's calls holds whole days, except at its two ends: yesterday itself, and the day that the
window begins in. Whole days are taken from the table, the few days with an end in them call by call, and both go
through the same sweep, where a day's row is an event that lies in a window as a whole.

A row holds its day's own sums, not totals from the beginning: a day that is run again replaces its partition and nothing
else, where totals of all later days would have to be written anew. Rows are stored under the day their calls are stored
under (``part_date``), which may be some days from the day the calls began; a pair's day may therefore have several rows, which add up.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callmart.context import RunContext
from callmart.functions.calendar import day_key
from callmart.functions.phone import pair_key
from callmart.operators.joins import lookup, restrict_to
from callmart.operators.trailing import Trailing
from callmart.plans.call_features import (
    LAST_SUCCESS,
    LOOSE_DAYS,
    TIES,
    TS,
    WHO_KEY,
    WINDOWS,
    measures,
    stored_since,
    trailing_features,
    with_previous_call,
)
from callmart.plans.call_log import HISTORY_DAYS
from callmart.sources.sinks import refresh_partitions, write_day

# What a later call needs to know of the one before it.
CARRIED = list(dict.fromkeys([TS, *TIES, "talk_duration", "code_call_result_type", "interaction_type_code"]))
KNOWN_PHONE = f"{WHO_KEY} like 'p%'"


def day_rows(calls: DataFrame) -> DataFrame:
    """One row per pair, day of the start and stored day: sums of all measures, last success, and the newest call.

    Calls without a start have no day and are left out. The sums are combined inside each task, so a pair with very many calls is one row a task.
    """
    keyed = calls.where(F.col(TS).isNotNull()).withColumn(WHO_KEY, pair_key())
    newest = F.max(F.struct(*CARRIED)).alias("newest")
    sums = [F.expr(f"sum({e})").alias(name) for name, e in measures().items()]
    started = F.to_date(TS).alias("start_day")
    return keyed.groupBy(WHO_KEY, started, "part_date").agg(*sums, F.expr(f"max({LAST_SUCCESS}) as last_success"), newest)


def write_day_rows(calls: DataFrame, ctx: RunContext, path: str, lag_days: int = 1) -> None:
    """Replace one stored day's partition of the table, by default yesterday's."""
    day = ctx.day_key(lag_days)
    write_day(day_rows(calls.where(F.col("part_date") == day)), path, day)


def backfill_day_rows(calls: DataFrame, path: str) -> None:
    """Replace the partitions of all stored days that ``calls`` has; each is what its own night would write."""
    refresh_partitions(day_rows(calls), path, pack=True)


def window_starts(day: date, windows: Mapping[str, Trailing], calls: DataFrame) -> dict[str, date]:
    """The day that each window behind a call of ``day`` begins in; it is the same for every time of that day."""
    backs = sorted({w.back for w in windows.values() if w.back})
    if any(b.split()[1].upper().rstrip("S") not in ("DAY", "WEEK", "MONTH", "YEAR") for b in backs):
        raise ValueError("windows of less than a day begin on no common day")
    # Month ends are clamped as the sweep clamps them.
    spans = [F.expr(f"cast(timestamp_ntz '{day} 00:00:00' - interval {b} as date) as _{i}") for i, b in enumerate(backs)]
    row = calls.sparkSession.range(1).select(*spans).first() if backs else []
    return dict(zip(backs, row, strict=True))


def _near(days: list[date]) -> Column:
    """Stored days that may hold calls which began on one of ``days``."""
    key = lambda d, k: int((d + timedelta(days=k)).strftime("%Y%m%d"))
    tests = [F.col("part_date").between(key(d, -LOOSE_DAYS), key(d, LOOSE_DAYS)) for d in days]
    found = tests[0]
    for test in tests[1:]:
        found = found | test
    return found & F.to_date(TS).isin(days)


def history(calls: DataFrame, table: DataFrame, day: date, windows: Mapping[str, Trailing]) -> DataFrame:
    """Measured events for the windows behind the calls of ``day``: calls of the days with a window's end, one event for each other day of a pair."""
    starts = window_starts(day, windows, calls)
    ends = sorted({day, *starts.values()})
    whole = F.col("start_day") < day
    if all(w.back for w in windows.values()):
        whole = whole & (F.col("start_day") > ends[0]) & (F.col("part_date") >= int((ends[0] - timedelta(days=LOOSE_DAYS)).strftime("%Y%m%d")))
    names = list(measures())
    days = table.where(whole & ~F.col("start_day").isin(ends)).select(
        WHO_KEY, F.col("start_day").cast("timestamp_ntz").alias(TS), *names, "last_success"
    )
    exact = calls.withColumn(WHO_KEY, pair_key()).where(_near(ends))
    exact = exact.selectExpr(WHO_KEY, TS, *[f"cast({e} as bigint) as {name}" for name, e in measures().items()], f"{LAST_SUCCESS} as last_success")
    return exact.unionByName(days).where(KNOWN_PHONE)


def features_of_day(
    calls: DataFrame, table: DataFrame, ctx: RunContext, windows: Mapping[str, Trailing] | None = None, lag_days: int = 1
) -> DataFrame:
    """Previous-call and trailing features of the calls that began on one day, yesterday by default.

    The same rows as ``call_features`` gives for that day, from the day's calls, those of the days in which a window
    begins, and the table of days. ``table`` must hold every stored day that the windows and the kept year reach before that day.
    """
    windows = windows or WINDOWS
    day = ctx.as_of.date() - timedelta(days=lag_days)
    wanted = calls.withColumn(WHO_KEY, pair_key()).where(_near([day]))

    # The newest call before that day, of the pairs that were called.
    called = wanted.select(WHO_KEY).distinct()
    kept = stored_since(table, ctx, max(lag_days, HISTORY_DAYS)).where(F.col("start_day") < day)
    before = restrict_to(kept.select(WHO_KEY, "newest"), called, [WHO_KEY]).groupBy(WHO_KEY).agg(F.max("newest").alias("newest")).select(WHO_KEY, "newest.*")
    both = wanted.unionByName(before, allowMissingColumns=True)
    previous = with_previous_call(both, [WHO_KEY]).where(F.to_date(TS) == day).withColumn("partition_date", day_key(TS))

    events = restrict_to(history(calls, table, day, windows), called, [WHO_KEY])
    features = trailing_features(wanted, [WHO_KEY], dict(windows), events=events)
    return lookup(previous, features, [WHO_KEY, TS]).drop(WHO_KEY)
