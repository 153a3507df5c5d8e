"""Time windows. The same code serves batch and streaming DataFrames.

The time column may be event time or, for processing-time windows, the column
that holds the arrival time. Every aggregate here combines before the shuffle,
so a hot key or a window over all keys sends one row per task and window.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .running import Agg


def time_window(time: str, size: str, slide: str | None = None) -> Column:
    return F.window(time, size, slide) if slide else F.window(time, size)


def windowed(df: DataFrame, time: str, size: str, slide: str | None, keys: Sequence[str],
             aggs: Mapping[str, Agg]) -> DataFrame:
    """Aggregate per key and window; an empty key list gives windows over all rows.

    Spark copies a row to its size / slide windows and combines the copies
    before the shuffle. Folding rows into panes first was measured on 20 million
    rows: slightly faster at six windows per row, slower at two and three.
    """
    values = {name: f"__v_{name}" for name in aggs}
    rows = df.withColumns({values[n]: agg.column for n, agg in aggs.items()})
    windows = rows.groupBy(time_window(time, size, slide).alias("__w"), *keys).agg(
        *[aggs[n].fold(c).alias(c) for n, c in values.items()])
    return windows.select(
        F.col("__w.start").alias("window_start"), F.col("__w.end").alias("window_end"), *keys,
        *[aggs[n].result(F.col(c)).alias(n) for n, c in values.items()])


def with_window(df: DataFrame, time: str, size: str, slide: str | None = None) -> DataFrame:
    """Add flat window bounds to every row; a row appears once per window it is in."""
    return (df.withColumn("__w", time_window(time, size, slide))
            .withColumns({"window_start": F.col("__w.start"), "window_end": F.col("__w.end")})
            .drop("__w"))
