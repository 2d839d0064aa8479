"""Time helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000


def floor_days_between(start, end) -> Column:
    """Whole days from ``start`` to ``end``, rounded down (2 h over midnight
    -> 0, -12 h -> -1), as BIGINT.  Exact integer arithmetic on microseconds."""
    start = F.col(start) if isinstance(start, str) else start
    end = F.col(end) if isinstance(end, str) else end
    us = F.timestamp_diff("MICROSECOND", start, end)
    return F.call_function("div", us - F.pmod(us, F.lit(MICROS_PER_DAY)), F.lit(MICROS_PER_DAY)).cast("bigint")
