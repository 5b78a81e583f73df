"""Codes, flags, defaults and first-known values."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from callmart.fixed_values import ANSWERED
from callmart.functions.calendar import _col


def decode(
    c: Column | str,
    mapping: Mapping[Any, Any] | None = None,
    ranges: Mapping[tuple, Any] | None = None,
    default: Any = None,
) -> Column:
    """Label of a code, by value and then by inclusive range."""
    c = _col(c)
    out = F
    for code, label in (mapping or {}).items():
        out = out.when(c == F.lit(code), F.lit(label))
    for (low, high), label in (ranges or {}).items():
        out = out.when(c.between(low, high), F.lit(label))
    return out.otherwise(F.lit(default))


def ordinal(c: Column | str, values: Sequence[str], default: int = -1) -> Column:
    """1-based position of a category in a fixed list."""
    position = F.array_position(F.array(*[F.lit(v) for v in values]), _col(c)).cast("int")
    return F.when(position > 0, position).otherwise(F.lit(default))


def one_hot(c: Column | str, values: Mapping[str, str], other: str | None = None) -> list[Column]:
    """A 0/1 column per value, compared in upper case; ``other`` also catches a missing value."""
    c = F.upper(_col(c))
    flags = [F.when(c == v.upper(), 1).otherwise(0).alias(name) for v, name in values.items()]
    if other:
        known = c.isin([v.upper() for v in values])
        flags.append(F.when(known, 0).otherwise(1).alias(other))
    return flags


def outside_set_flag(c: Column | str, values: Iterable[str]) -> Column:
    """1 outside the set, 0 inside, missing when unknown."""
    c = _col(c)
    return F.when(c.isNotNull(), F.when(c.isin(list(values)), 0).otherwise(1))


def zero_when(c: Column | str, condition: Column) -> Column:
    return F.when(condition, F.lit(0)).otherwise(_col(c))


def first_known(*columns: Column | str) -> Column:
    """First value that is not missing; list the most trusted source first."""
    return F.coalesce(*[_col(c) for c in columns])


def latest_status(ended: Column, began: Column, *fallbacks: Column) -> Column:
    """Marital status from the latest divorce and marriage dates, else the first fallback."""
    by_date = (
        F.when(ended > began, F.lit("DIVORCED"))
        .when(began.isNotNull(), F.lit("MARRIED"))
        .when(ended.isNotNull(), F.lit("DIVORCED"))
    )
    return F.coalesce(by_date, *fallbacks)


# Whether a call was answered: there was talk, or the result says so. Never missing.
SUCCESS = f"(coalesce(talk_duration > 0, false) or code_call_result_type <=> '{ANSWERED}')"


def is_success() -> Column:
    """``SUCCESS`` over the columns of the call log."""
    return F.expr(SUCCESS)


def safe_rate(part: Column | str, whole: Column | str) -> Column:
    """``part / whole`` as a double, 0 when nothing was counted."""
    return F.coalesce(F.try_divide(_col(part).cast("double"), _col(whole).cast("double")), F.lit(0.0))


def nan_to_zero(c: Column | str) -> Column:
    return F.nanvl(_col(c).cast("double"), F.lit(0.0))
