"""Calendar and cyclic-time expressions (all built-in, codegen-friendly)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weekday names in Monday-first order (Monday = 0).
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]

# Periods of the cyclic encodings (month, day of month, weekday).
PERIODS = {"month": 12, "date": 31, "day": 7}

# Output pattern of the epoch -> local-time string.
TIME_PATTERN = "yyyy-MM-dd HH:mm:ss"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def calendar_parts(ts) -> dict[str, Column]:
    """Calendar strings of a timestamp (or ``yyyy-MM-dd HH:mm:ss`` string):
    zero-padded year/month/date/hour and the English weekday name."""
    t = _c(ts)
    return {
        "year": F.date_format(t, "yyyy"),
        "month": F.date_format(t, "MM"),
        "date": F.date_format(t, "dd"),
        "day": F.date_format(t, "EEEE"),
        "hour": F.date_format(t, "HH"),
    }


def weekday_index(day_name) -> Column:
    """English weekday name -> 0..6 with Monday = 0; unknown names -> null."""
    pos = F.array_position(F.array(*[F.lit(d) for d in WEEKDAYS]), _c(day_name))
    return F.when(pos > 0, (pos - 1).cast("int"))


def weekday_of(ts) -> Column:
    """0..6 weekday of a timestamp, Monday = 0."""
    return (F.dayofweek(_c(ts)) + 5) % 7


def cyclic(value, period: float) -> tuple[Column, Column]:
    """(sin, cos) of 2*pi*value/period."""
    angle = F.lit(2.0 * math.pi) * _c(value).cast("double") / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def cyclic_features(month, date, day_index, prefix: str = "") -> dict[str, Column]:
    """The six cyclic features of the rank models (month, date, weekday)."""
    out = {}
    for name, col, period in (("month", month, PERIODS["month"]),
                              ("date", date, PERIODS["date"]),
                              ("day", day_index, PERIODS["day"])):
        s, c = cyclic(col, period)
        out[f"{prefix}{name}_sin"] = s
        out[f"{prefix}{name}_cos"] = c
    return out
