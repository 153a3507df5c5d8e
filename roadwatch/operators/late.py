"""Exact late-data handling on a table that keeps its arrival order.

Before a row arrives the watermark is the highest time among earlier arrivals
minus the delay. A row is late once its window's end plus the allowed lateness
is not after that watermark.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.times import duration_micros, micros
from ..sources.stored import stored
from .running import count_rows, highest, running
from .windows import with_window


def mark_late(df: DataFrame, time: str, order: str, size: str, *, delay: str,
              lateness: str, width: int | None = None) -> DataFrame:
    """Add the window bounds, ``is_late`` and ``is_refire``.

    ``is_refire`` marks rows that come after their window's end has passed but
    within the allowed lateness: each makes its window fire again.
    """
    seen = running(df.withColumn("__t", micros(F.col(time))), [], order,
                   {"__max": highest(F.col("__t"))}, width=width, inclusive=False)
    marked = with_window(seen, time, size)
    watermark = F.col("__max") - duration_micros(delay)
    end = micros(F.col("window_end"))
    return marked.withColumns({
        "is_late": F.coalesce(end + duration_micros(lateness) <= watermark, F.lit(False)),
        "is_refire": F.coalesce((end <= watermark)
                                & (end + duration_micros(lateness) > watermark), F.lit(False)),
    }).drop("__t", "__max")


def without_time(df: DataFrame, time: str) -> DataFrame:
    """Rows without a time: they are in no window, so ``mark_late`` leaves them out."""
    return df.where(F.col(time).isNull())


def late_side(marked: DataFrame) -> DataFrame:
    return marked.where("is_late").drop("is_late", "is_refire")


def on_time(marked: DataFrame) -> DataFrame:
    return marked.where("not is_late").drop("is_late")


def refires(marked: DataFrame, keys: Sequence[str], order: str, *,
            width: int | None = None) -> DataFrame:
    """The repeated results: the window's count at each row allowed in late."""
    group = [*keys, "window_start", "window_end"]
    # Marking is an ordered step over all rows, not to be repeated: its flags are stored.
    kept = stored(on_time(marked).select(*group, order, "is_refire"), "on-time")
    counted = running(kept, group, order, {"so_far": count_rows()}, width=width)
    return counted.where("is_refire").drop("is_refire")
