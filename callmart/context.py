"""The run context: one fixed clock reading shared by every operator of a run."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class RunContext:
    """``as_of`` is read once, so a run that crosses midnight still sees a single day."""

    as_of: datetime

    def day_key(self, days_back: int = 0) -> int:
        """``yyyyMMdd`` of ``as_of`` minus whole days: a literal, so partitions prune statically."""
        return int((self.as_of - timedelta(days=days_back)).strftime("%Y%m%d"))

    @property
    def now(self) -> Column:
        """``as_of`` as a zone-free timestamp literal."""
        return F.lit(self.as_of.isoformat(sep=" ")).cast("timestamp_ntz")

    def midnight(self, days_back: int) -> str:
        """Start of the day ``day_key(days_back)`` as a timestamp in SQL."""
        return f"timestamp_ntz '{(self.as_of - timedelta(days=days_back)).date()} 00:00:00'"
