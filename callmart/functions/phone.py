"""Phone numbers as join keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callmart.functions.calendar import _col


def phone_key(c: Column | str, digits: int = 10) -> Column:
    """The last characters of a number; a shorter number stays whole."""
    return F.right(_col(c), F.lit(digits))


def clean_phone(c: Column | str) -> Column:
    """The number as text, without spaces."""
    return F.replace(F.trim(_col(c).cast("string")), F.lit(" "), F.lit(""))


def phone_suffix_match(a: Column | str, b: Column | str, digits: int = 7) -> Column:
    """Whether two numbers end in the same digits once dashes are removed."""
    tail = lambda c: F.right(F.replace(_col(c), F.lit("-"), F.lit("")), F.lit(digits))
    return tail(a) == tail(b)


def valid_phone(df: DataFrame, column: str = "phone_number") -> DataFrame:
    """Rows whose number has 10 or 11 characters; a missing number is not valid."""
    return df.where(F.length(column).isin(10, 11))


def counterparty(outbound: Column, contact: Column, target: Column, source: Column) -> Column:
    """The other side's number: who was called, or who called in."""
    return F.when(outbound, F.coalesce(contact, target)).otherwise(source)


def pair_key(phone: str = "phone_number", client: str = "cuid") -> Column:
    """Phone and client as one text that is never missing and distinguishes missing from empty.

    Joining and partitioning by it treats missing parts as equal, and unlike a null-safe
    comparison of two columns it lets windows and joins share one shuffle.
    """
    part = lambda prefix, c: f"coalesce(concat('{prefix}', cast({c} as string)), '')"
    return F.expr(f"concat({part('p', phone)}, '|', {part('c', client)})")
