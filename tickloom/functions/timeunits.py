"""Ticks: 64-bit counts of a time unit since 1970-01-01 UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Ticks per second of each unit.
TICKS_PER_SECOND = {"ms": 1_000, "us": 1_000_000, "ns": 1_000_000_000}


def _ticks_per_second(unit: str) -> int:
    try:
        return TICKS_PER_SECOND[unit]
    except KeyError:
        raise ValueError(f"unknown time unit: {unit!r}") from None


def floor_div(x: Column, width: Column | int) -> Column:
    """Integer division rounding down, also for negative ``x``."""
    width = F.lit(width).cast("bigint") if isinstance(width, int) else width
    exact = x - F.pmod(x, width)
    return F.call_function("div", exact, width)


def convert_ticks(ticks: Column, source: str, target: str) -> Column:
    """Ticks of one unit in another; a coarser unit rounds down."""
    have, want = _ticks_per_second(source), _ticks_per_second(target)
    if want >= have:
        return ticks * F.lit(want // have).cast("bigint")
    return floor_div(ticks, have // want)


def ticks_of_timestamp(timestamp: Column, unit: str = "us") -> Column:
    """Ticks of a timestamp that carries a zone."""
    return convert_ticks(F.unix_micros(timestamp), "us", unit)


def ticks_of_local_timestamp(timestamp: Column, unit: str = "us") -> Column:
    """Ticks of a zoneless timestamp read as UTC, whatever the session zone."""
    days = F.unix_date(timestamp.cast("date")).cast("bigint")
    minutes = (F.hour(timestamp) * 60 + F.minute(timestamp)).cast("bigint")
    seconds = F.extract(F.lit("SECOND"), timestamp)
    micros = (seconds * 1_000_000).cast("bigint")
    return convert_ticks(days * 86_400_000_000 + minutes * 60_000_000 + micros, "us", unit)


def timestamp_of_ticks(ticks: Column, unit: str = "us") -> Column:
    return F.timestamp_micros(convert_ticks(ticks, unit, "us"))
