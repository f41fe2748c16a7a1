"""Interval strings such as ``"5 minutes"`` or ``"1 hour"`` to microseconds."""

from __future__ import annotations

import datetime as _dt
import math

_UNITS_US = {
    "microsecond": 1, "millisecond": 1_000, "second": 1_000_000,
    "minute": 60_000_000, "hour": 3_600_000_000, "day": 86_400_000_000,
    "week": 7 * 86_400_000_000,
}


def interval_us(value: str | int | float | _dt.timedelta, zero: bool = False) -> int:
    """Length of an interval in microseconds.

    Accepts a ``timedelta``, a number of seconds, or the ``"<n> <unit>"``
    strings Spark's ``window()`` takes (units second .. week, singular or
    plural).
    """
    if isinstance(value, _dt.timedelta):
        return int(round(value.total_seconds() * 1_000_000))
    if isinstance(value, (int, float)):
        return int(round(value * 1_000_000))
    total = 0
    parts = value.strip().lower().split()
    if len(parts) % 2:
        raise ValueError(f"not an interval: {value!r}")
    for num, unit in zip(parts[::2], parts[1::2]):
        unit = unit.rstrip("s") if unit.endswith("s") else unit
        if unit not in _UNITS_US:
            raise ValueError(f"unknown interval unit in {value!r}")
        total += int(float(num) * _UNITS_US[unit])
    if total < 0 or total == 0 and not zero:
        raise ValueError(f"interval must be positive: {value!r}")
    return total


def interval_str(us: int) -> str:
    """Microseconds back to a string ``window()`` accepts."""
    return f"{us} microseconds"


def pane_us(size, slide) -> int:
    """Pane length for a sliding window: gcd(size, slide)."""
    return math.gcd(interval_us(size), interval_us(slide))
