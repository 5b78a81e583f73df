"""Dates and times. Timestamps carry no zone; sessions run in UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from callmart.context import RunContext
from callmart.fixed_values import DAY_PART_HOURS, NIGHT

_SECONDS = {"seconds": 1, "minutes": 60, "hours": 3600}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_to_local(c: Column | str, hours: int = 6) -> Column:
    """Epoch seconds to a wall-clock timestamp a fixed number of hours ahead of UTC."""
    return (F.timestamp_seconds(_col(c) + F.lit(hours * 3600))).cast("timestamp_ntz")


def epoch_ms_to_ts(c: Column | str) -> Column:
    """Epoch milliseconds to a timestamp in whole seconds."""
    return F.timestamp_seconds(F.floor(_col(c) / F.lit(1000))).cast("timestamp_ntz")


def weekday_name(c: Column | str) -> Column:
    """Full English name of the day."""
    return F.date_format(_col(c), "EEEE")


def iso_weekday(c: Column | str) -> Column:
    """1 for Monday to 7 for Sunday."""
    return F.weekday(_col(c)) + F.lit(1)


def day_part(hour: Column | str) -> Column:
    """Part of the day an hour belongs to; an unknown hour counts as night."""
    hour = _col(hour)
    part = F
    for name, (first, last) in DAY_PART_HOURS.items():
        part = part.when(hour.between(first, last), F.lit(name))
    return part.otherwise(F.lit(NIGHT))


def day_key(c: Column | str) -> Column:
    """``yyyyMMdd`` as an integer."""
    c = _col(c)
    return F.year(c) * F.lit(10000) + F.month(c) * F.lit(100) + F.dayofmonth(c)


def start_of_day(c: Column | str) -> Column:
    return F.date_trunc("DAY", _col(c)).cast("timestamp_ntz")


def minus(c: Column | str, span: str) -> Column:
    """``c`` minus a span such as ``6 MONTHS`` or ``21 DAYS``, time of day kept.

    A month span clamps to the last day of a shorter month.
    """
    return _col(c) - F.expr(f"INTERVAL {span}")


def elapsed(start: Column | str, end: Column | str, unit: str = "seconds") -> Column:
    """Time from ``start`` to ``end``: calendar days, whole seconds, or fractional minutes, hours."""
    start, end = _col(start), _col(end)
    if unit == "days":
        return F.datediff(end, start)
    seconds = F.unix_timestamp(end.cast("timestamp")) - F.unix_timestamp(start.cast("timestamp"))
    return seconds if unit == "seconds" else seconds / F.lit(float(_SECONDS[unit]))


def age_years(birth: Column | str, ctx: RunContext) -> Column:
    """Whole years of 365 days since birth."""
    days = F.datediff(ctx.now, _col(birth))
    return (F.signum(days) * F.floor(F.abs(days) / F.lit(365))).cast("int")


def days_since(c: Column | str, ctx: RunContext, default: int = -1) -> Column:
    """Calendar days from ``c`` to the run, or ``default`` when it never happened."""
    return F.coalesce(F.datediff(ctx.now, _col(c)), F.lit(default))
