"""Time and calendar expressions."""

from __future__ import annotations

import math
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNITS = {"s": 1, "sec": 1, "second": 1, "seconds": 1,
          "m": 60, "min": 60, "minute": 60, "minutes": 60, "t": 60,
          "h": 3600, "hour": 3600, "hours": 3600,
          "d": 86400, "day": 86400, "days": 86400}


def interval_seconds(interval: str | int) -> int:
    """'15min', '15 minutes', '1h', 900 -> seconds."""
    if isinstance(interval, int):
        return interval
    m = re.fullmatch(r"\s*(\d+)\s*([A-Za-z]+)\s*", str(interval))
    if not m or m.group(2).lower() not in _UNITS:
        raise ValueError(f"bad interval {interval!r}")
    return int(m.group(1)) * _UNITS[m.group(2).lower()]


def time_floor(ts: Column, interval: str | int) -> Column:
    """Floor a TIMESTAMP_NTZ to the interval, aligned to the epoch (B1)."""
    return F.window(ts, f"{interval_seconds(interval)} seconds").start


def add_seconds(ts: Column, seconds: Column | int) -> Column:
    s = seconds if isinstance(seconds, Column) else F.lit(seconds)
    return F.timestamp_add("SECOND", s, ts)


def weekday_mon0(ts: Column) -> Column:
    """Day of week, Monday = 0 (G2); Spark's dayofweek is Sunday = 1."""
    return F.weekday(ts)


def cyclic(x: Column, period: int, fn: str) -> Column:
    """sin / cos(2 pi x / period) (G3), evaluated as (2 pi * x) / period."""
    arg = F.lit(2 * math.pi) * x / F.lit(period)
    return F.sin(arg) if fn == "sin" else F.cos(arg)


def calendar_columns(ts: Column) -> dict[str, Column]:
    """hour, minute, day_of_week, is_weekend, month and the four cyclic codes."""
    hour = F.hour(ts)
    dow = weekday_mon0(ts)
    return {
        "hour": hour,
        "minute": F.minute(ts),
        "day_of_week": dow,
        "is_weekend": (dow >= 5).cast("int"),
        "month": F.month(ts),
        "hour_sin": cyclic(hour, 24, "sin"),
        "hour_cos": cyclic(hour, 24, "cos"),
        "day_sin": cyclic(dow, 7, "sin"),
        "day_cos": cyclic(dow, 7, "cos"),
    }


def whole_days_between(start: Column, end: Column) -> Column:
    """Whole days from start to end."""
    return F.timestamp_diff("DAY", start, end)
