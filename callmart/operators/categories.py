"""Counts per category, averages and rule sums. All combine inside each task before the shuffle."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callmart.fixed_values import DAY_PARTS, WEEKDAYS
from callmart.functions.decode import SUCCESS


def _text(value: str) -> str:
    """A SQL text literal."""
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def count_by_category(c: str, values: Mapping[str, str], where: str = "true") -> list[Column]:
    """A conditional count per listed value; ``values`` maps the value to its column name."""
    return [F.expr(f"count_if({c} = {_text(v)} and {where}) as {name}") for v, name in values.items()]


def slot_names(success: bool) -> tuple[dict[str, str], dict[str, str]]:
    """Column names of the day-part and weekday counts."""
    mid = "_successful" if success else ""
    parts = {p: f"cnt_{p.lower()}{mid}_calls" for p in DAY_PARTS}
    days = {d: f"{d.lower()}{mid}_calls" for d in WEEKDAYS}
    return parts, days


def slot_counts(part: str = "day_part", weekday: str = "weekday", ok: str = SUCCESS) -> list[Column]:
    """Counts by day part and weekday: of all calls, then of answered ones."""
    out = []
    for success in (False, True):
        parts, days = slot_names(success)
        where = ok if success else "true"
        out += count_by_category(part, parts, where) + count_by_category(weekday, days, where)
    return out


def direction_counts(ok: str = SUCCESS) -> list[Column]:
    """Outbound and inbound counts, of all calls and of answered ones."""
    kind = "interaction_type_code"
    return count_by_category(
        kind, {"OUTBOUND": "cnt_out_calls_6m", "INBOUND": "cnt_in_calls_6m"}
    ) + count_by_category(
        kind, {"OUTBOUND": "cnt_success_out_calls_6m", "INBOUND": "cnt_success_in_calls_6m"}, ok
    )


def collapse_legs(df: DataFrame) -> DataFrame:
    """Legs of one call (same day, phone, hour, source and result) as one row."""
    return df.groupBy("part_date", "phone_number", "h_date", "call_source", "code_call_result_type").agg(
        F.min("dtime_call_start").alias("dtime_call_start"),
        F.max("dtime_call_end").alias("dtime_call_end"),
        F.max("weekday").alias("weekday"),
        F.max("talk_duration").alias("talk_duration"),
        F.max("interaction_type_code").alias("interaction_type_code"),
    )


def pivot_counts(df: DataFrame, keys: list[str], c: str, values: Mapping[str, str]) -> DataFrame:
    """Row counts per key, one column per listed category."""
    return df.groupBy(*keys).agg(*count_by_category(c, values))


def rule_counts(
    df: DataFrame, keys: list[str], counts: Mapping[str, str], flags: Mapping[str, str]
) -> DataFrame:
    """One row per key: alerts per counted rule, and 0/1 for each flagged rule."""
    sums = [
        F.sum(F.when(F.col("ruleid") == rule, 1).otherwise(0)).alias(name) for rule, name in counts.items()
    ]
    seen = [
        F.max(F.when(F.col("ruleid") == rule, 1).otherwise(0)).alias(name) for rule, name in flags.items()
    ]
    return df.groupBy(*keys).agg(*sums, *seen)
