"""Time helpers: interval strings and instants as BIGINT microseconds."""

from __future__ import annotations

import datetime as _dt
import re

_UNITS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 7 * 86_400_000_000,
}


def interval_micros(value) -> int:
    """'10 minutes', '3 days', '1 hour 30 minutes', a timedelta, or an int
    (already microseconds) -> microseconds."""
    if isinstance(value, bool):
        raise TypeError("interval must not be bool")
    if isinstance(value, int):
        return value
    if isinstance(value, _dt.timedelta):
        return (value.days * 86_400 + value.seconds) * 1_000_000 + value.microseconds
    parts = re.findall(r"(-?\d+)\s*([a-z]+?)s?\b", str(value).strip().lower())
    if not parts:
        raise ValueError(f"cannot parse interval {value!r}")
    total = 0
    for n, unit in parts:
        if unit not in _UNITS:
            raise ValueError(f"unknown interval unit {unit!r} in {value!r}")
        total += int(n) * _UNITS[unit]
    return total


def interval_string(micros: int) -> str:
    """Microseconds -> an interval string Spark's window functions accept."""
    return f"{int(micros)} microseconds"


def instant_micros(value) -> int:
    """An instant as microseconds since the epoch (UTC).

    Accepts an int (microseconds), a datetime (naive means UTC) or an ISO
    string such as '2024-01-15' or '2024-01-15 06:00:00'.
    """
    if isinstance(value, bool):
        raise TypeError("instant must not be bool")
    if isinstance(value, int):
        return value
    if isinstance(value, str):
        value = _dt.datetime.fromisoformat(value)
    if isinstance(value, _dt.date) and not isinstance(value, _dt.datetime):
        value = _dt.datetime(value.year, value.month, value.day)
    if value.tzinfo is None:
        value = value.replace(tzinfo=_dt.timezone.utc)
    delta = value - _dt.datetime(1970, 1, 1, tzinfo=_dt.timezone.utc)
    return (delta.days * 86_400 + delta.seconds) * 1_000_000 + delta.microseconds
