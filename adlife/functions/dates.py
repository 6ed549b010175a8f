"""Date helpers on ISO text and epoch milliseconds, independent of the session time zone."""

from __future__ import annotations

import calendar

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from adlife import config
from adlife.functions.parse import _col


def _epoch_ntz() -> Column:
    # a SQL literal: independent of the Python process and session time zones
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")


def days_between(start, end) -> Column:
    """Days from ``start`` to ``end`` (ISO text); -1 when ``end`` is the date sentinel."""
    start, end = _col(start), _col(end)
    return (F.when(end == F.lit(config.NULL_DATE), F.lit(config.NULL_INT))
            .otherwise(F.datediff(F.to_date(end), F.to_date(start))))


def dates_between(start, end) -> Column:
    """Inclusive ``array<string>`` of ISO dates; empty when ``end`` < ``start``."""
    s, e = F.to_date(_col(start)), F.to_date(_col(end))
    days = F.sequence(s, e, F.expr("INTERVAL 1 DAY"))
    return (F.when(e >= s, F.transform(days, lambda d: F.date_format(d, "yyyy-MM-dd")))
            .otherwise(F.array().cast("array<string>")))


def month_end(month: str) -> str:
    """Last ISO date of an ISO month."""
    year, m = int(month[:4]), int(month[5:7])
    return f"{month}-{calendar.monthrange(year, m)[1]:02d}"


def months_between(start: str, end: str) -> list[str]:
    """ISO months from that of ``start`` to that of ``end`` (ISO dates or months), inclusive."""
    a, b = (int(x[:4]) * 12 + int(x[5:7]) - 1 for x in (start, end))
    return [f"{k // 12:04d}-{k % 12 + 1:02d}" for k in range(a, b + 1)]


def epoch_ms_to_local_date(ms, zone: str = "UTC") -> Column:
    """Epoch milliseconds -> ISO date on the wall clock of ``zone``."""
    utc_wall = F.timestamp_add("MILLISECOND", _col(ms), _epoch_ntz())
    local = F.convert_timezone(F.lit("UTC"), F.lit(zone), utc_wall)
    return F.date_format(local, "yyyy-MM-dd")


def wall_clock_to_epoch_ms(ts) -> Column:
    """TIMESTAMP_NTZ (UTC wall clock) -> epoch milliseconds."""
    return F.timestamp_diff("MILLISECOND", _epoch_ntz(), _col(ts))


def iso_shift(day: str, days: int) -> str:
    """Parameter arithmetic on an ISO date (driver-side, on parameters only)."""
    return (_dt.date.fromisoformat(day) + _dt.timedelta(days=days)).isoformat()
