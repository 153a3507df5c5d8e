"""Time helpers shared by batch and streaming code. Sessions run in UTC."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: the text form of times in reports.
TIME_TEXT = "yyyy-MM-dd HH:mm:ss"

_UNIT_MICROS = {
    "millisecond": 1_000, "second": 1_000_000, "minute": 60_000_000,
    "hour": 3_600_000_000, "day": 86_400_000_000,
}


def duration_micros(text: str) -> int:
    """``"5 minutes"`` to microseconds."""
    amount, unit = text.split()
    return int(amount) * _UNIT_MICROS[unit.rstrip("s")]


def micros(time: Column) -> Column:
    return F.unix_micros(time.cast("timestamp"))


def millis(time: Column) -> Column:
    return F.unix_millis(time.cast("timestamp"))


def from_micros(value: Column) -> Column:
    """Microseconds to a timestamp without zone, the type of batch inputs."""
    return F.timestamp_micros(value).cast("timestamp_ntz")


def time_text(time: Column) -> Column:
    return F.date_format(time, TIME_TEXT)
